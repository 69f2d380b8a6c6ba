"""Stage tables and summaries under one manifest.

A manifest is one small JSON file that names, for every table, the folders of
each key bucket. A commit writes new folders first and then a new manifest,
renamed into place, so all tables of a commit appear at once or not at all.
Readers hold the manifest they opened: later commits never touch its folders.
An upsert rewrites only the buckets of its keys. `vacuum` removes folders that
no kept manifest names.

Keys are dealt by hash into a fixed number of buckets; a large bucket has many
files. Key columns carry Parquet Bloom filters, so a point read opens one
bucket and skips files without the key. One writer at a time: a second one that
started from the same manifest is refused when it commits.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pactum.sources.stage_store import BUCKET, key_bucket

WHOLE = "whole"  # the only bucket of a table without a key


class Conflict(RuntimeError):
    """Another writer committed since this one read the manifest."""


class Files:
    """The few file operations a manifest needs, on any file system Spark can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.context = spark.sparkContext
        self.hadoop = self.context._jvm.org.apache.hadoop.fs
        self.system = self.path(root).getFileSystem(self.context._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.hadoop.Path(name)

    def names(self, folder: str) -> list[str]:
        return [s.getPath().getName() for s in self.status(folder)]

    def status(self, folder: str) -> list:
        at = self.path(folder)
        return list(self.system.listStatus(at)) if self.system.exists(at) else []

    def read(self, name: str) -> str:
        stream = self.system.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """Write a new file so that it appears whole; fails if it is there already."""
        part = f"{name}.{uuid.uuid4().hex}.part"
        stream = self.system.create(self.path(part), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        files = self.hadoop.FileContext.getFileContext(
            self.path(name).makeQualified(self.system.getUri(), self.system.getWorkingDirectory()).toUri(),
            self.context._jsc.hadoopConfiguration())
        plain = self.context._gateway.new_array(self.context._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            files.rename(self.path(part), self.path(name), plain)
        except Exception as problem:
            self.delete(part)
            if self.system.exists(self.path(name)):
                raise Conflict(name) from problem
            raise

    def delete(self, name: str) -> None:
        self.system.delete(self.path(name), True)


@dataclass
class Table:
    """A table of one manifest: its schema, its key, and the folders of each bucket."""

    schema: str
    key: str | None
    parts: dict[str, list[str]] = field(default_factory=dict)

    def columns(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))

    def kind(self) -> str:
        """Names and types of the columns; whether they may be null is no difference."""
        return self.columns().simpleString()


@dataclass(frozen=True)
class Change:
    """New rows of a table. With a key they replace the rows of their keys (and of ``gone``
    keys, which lose theirs); without one they replace the table."""

    rows: DataFrame
    key: str | None = "processo_id"
    gone: DataFrame | None = None


class Snapshots:
    """The tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.files = Files(spark, root)

    # -- manifests --------------------------------------------------------------------------
    def _versions(self) -> list[int]:
        names = self.files.names(f"{self.root}/manifests")
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _name(self, version: int) -> str:
        return f"{self.root}/manifests/{version:012d}.json"

    def version(self) -> int:
        """The current version; 0 before the first commit."""
        return max(self._versions(), default=0)

    def manifest(self, version: int | None = None) -> dict[str, Table]:
        version = self.version() if version is None else version
        if not version:
            return {}
        stored = json.loads(self.files.read(self._name(version)))
        return {name: Table(**t) for name, t in stored.items()}

    # -- reading ----------------------------------------------------------------------------
    def read(self, name: str, version: int | None = None, buckets: Iterable[str] | None = None) -> DataFrame:
        """The rows of a table, or of some of its buckets, in one version."""
        return self._rows(self.manifest(version)[name], buckets)

    def _rows(self, table: Table, buckets: Iterable[str] | None = None) -> DataFrame:
        schema = table.columns()
        chosen = table.parts if buckets is None else {b: table.parts.get(b, []) for b in buckets}
        paths = [p for own in chosen.values() for p in own]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def bucket_of(self, value: str) -> str:
        """The bucket of a key; computed by Spark while it plans, without a job."""
        one = self.spark.range(1).select(key_bucket_of(F.lit(value), self.buckets))
        return str(one.first()[0])

    def read_key(self, name: str, value: str, version: int | None = None) -> DataFrame:
        """The rows of one key, from its bucket's files only."""
        table = self.manifest(version)[name]
        return self._rows(table, [self.bucket_of(value)]).where(F.col(table.key) == value)

    # -- writing ----------------------------------------------------------------------------
    def commit(self, changes: dict[str, Change]) -> int:
        """Apply all changes and switch to them at once; returns the new version."""
        seen = self.version()
        tables = self.manifest(seen)
        for name, change in changes.items():
            tables[name] = self._applied(name, tables.get(name), change)
        stored = {name: vars(t) for name, t in tables.items()}
        self.files.create(self._name(seen + 1), json.dumps(stored))
        return seen + 1

    def _applied(self, name: str, old: Table | None, change: Change) -> Table:
        new = Table(change.rows.schema.json(), change.key)
        new.parts = self._written(name, change.rows, change.key)
        if old is None or change.key is None:
            return new
        if old.kind() != new.kind() or old.key != new.key:
            raise ValueError(f"rows do not fit the stored table {name}")
        keys = self._rows(new).select(change.key)
        touched = set(new.parts)
        if change.gone is not None:
            gone = change.gone.select(change.key).distinct()
            keys = keys.unionByName(gone)
            # At most as many rows as there are buckets.
            touched |= {str(r[0]) for r in gone.select(
                key_bucket(change.key, self.buckets)).distinct().collect()}
        touched &= set(old.parts)
        rest = self._rows(old, touched).join(keys.distinct(), change.key, "left_anti").select(
            *change.rows.columns)
        kept = self._written(name, rest, change.key) if touched else {}
        parts = {b: p for b, p in old.parts.items() if b not in touched}
        for own in (kept, new.parts):
            for bucket, paths in own.items():
                parts[bucket] = parts.get(bucket, []) + paths
        return Table(old.schema, old.key, parts)

    def _written(self, name: str, rows: DataFrame, key: str | None) -> dict[str, list[str]]:
        path = f"{self.root}/data/{name}/{uuid.uuid4().hex}"
        if key is None:
            rows.write.parquet(path)
            return {WHOLE: [path]}
        dealt = rows.withColumn(BUCKET, key_bucket(key, self.buckets)).hint("rebalance", BUCKET)
        dealt.write.partitionBy(BUCKET).option(f"parquet.bloom.filter.enabled#{key}", "true").parquet(path)
        found = [n for n in self.files.names(path) if n.startswith(f"{BUCKET}=")]
        return {n.partition("=")[2]: [f"{path}/{n}"] for n in found}

    def vacuum(self, keep: int = 1, older_than_s: int = 3600) -> int:
        """Delete what the last ``keep`` manifests do not name; returns the number of folders.

        Folders younger than ``older_than_s`` stay, as a commit may be about to name them.
        """
        if keep < 1:
            raise ValueError("at least the current manifest is kept")
        versions = self._versions()
        named = {"/".join(p.split("/")[:-1]) if f"/{BUCKET}=" in p else p
                 for v in versions[-keep:] for t in self.manifest(v).values()
                 for own in t.parts.values() for p in own}
        for v in versions[:-keep]:
            self.files.delete(self._name(v))
        before = self.files.context._jvm.System.currentTimeMillis() - 1000 * older_than_s
        gone = 0
        for name in self.files.names(f"{self.root}/data"):
            for status in self.files.status(f"{self.root}/data/{name}"):
                path = f"{self.root}/data/{name}/{status.getPath().getName()}"
                if path not in named and status.getModificationTime() <= before:
                    self.files.delete(path)
                    gone += 1
        return gone


def key_bucket_of(value, buckets: int):
    return F.pmod(F.xxhash64(value), F.lit(buckets)).cast("int").alias(BUCKET)
