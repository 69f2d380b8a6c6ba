"""Stage tables: every stage's rows as one Parquet table, written once and re-read.

A table cuts lineage, survives lost executors, and lets later stages prune
columns and push filters to the stored data.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactum.session import checkpoint_dir

BUCKETS = 256
BUCKET = "key_bucket"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a stage's rows to the shared folder and return the stored table."""
    path = f"{checkpoint_dir(df.sparkSession)}/pactum/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def key_bucket(key: str = "processo_id", buckets: int = BUCKETS):
    """A stable bucket of the key: a partition column for point reads and upserts."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


VERSION = "version"


def _next_version(spark: SparkSession, path: str) -> int:
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return 1  # nothing stored yet
    return (stored.agg(F.max(VERSION)).first()[0] or 0) + 1


def write_stage(df: DataFrame, root: str, stage: str, buckets: int = BUCKETS) -> None:
    """Upsert: the rows of every key in ``df`` replace that key's stored rows.

    A write adds a version and touches no stored file, so a failed write leaves
    the table as it was. Rows are dealt by key bucket; a bucket that is too
    large for one task is split by size at run time. One writer at a time.
    """
    path = f"{root}/{stage}"
    version = _next_version(df.sparkSession, path)
    (
        df.withColumn(BUCKET, key_bucket(buckets=buckets))
        .hint("rebalance", BUCKET)
        .write.mode("overwrite")
        .partitionBy(BUCKET)
        .parquet(f"{path}/{VERSION}={version}")
    )


def _newest(rows: DataFrame) -> DataFrame:
    """The rows of each key's last version."""
    last = rows.groupBy(F.col("processo_id").alias("_key")).agg(F.max(VERSION).alias("_last"))
    current = F.col("processo_id").eqNullSafe(F.col("_key")) & (F.col(VERSION) == F.col("_last"))
    return rows.join(last, current, "left_semi").drop(VERSION, BUCKET)


def read_stage(spark: SparkSession, root: str, stage: str) -> DataFrame:
    return _newest(spark.read.parquet(f"{root}/{stage}"))


def compact_stage(spark: SparkSession, root: str, stage: str, target: str,
                  buckets: int = BUCKETS) -> None:
    """Write the current rows as the first version of the stage under another root."""
    write_stage(read_stage(spark, root, stage), target, stage, buckets)


def read_process(spark: SparkSession, root: str, stage: str, pid: str, buckets: int = BUCKETS):
    """One process's rows; only its bucket's files are read."""
    bucket = F.pmod(F.xxhash64(F.lit(pid)), F.lit(buckets)).cast("int")
    return _newest(spark.read.parquet(f"{root}/{stage}").where(
        (F.col(BUCKET) == bucket) & (F.col("processo_id") == pid)))


def write_summary(row: DataFrame, path: str) -> None:
    """A one-row result as one JSON document."""
    row.coalesce(1).write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """An export as CSV part files with a header each."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_sheets(sheets: dict[str, DataFrame], root: str) -> dict[str, str]:
    """Report sheets as CSV folders; one failing sheet does not stop the others.

    Returns the cause of each sheet that failed.
    """
    failed = {}
    for name, df in sheets.items():
        try:
            write_csv(df, f"{root}/{name}")
        except Exception as problem:
            failed[name] = str(problem)
    return failed


def append_rows(df: DataFrame, path: str) -> None:
    """Append to a stored list; refuses rows of another shape."""
    spark = df.sparkSession
    try:
        stored = spark.read.parquet(path).schema
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = None  # nothing stored yet
    shape = [(f.name, f.dataType) for f in df.schema]
    if stored is not None and [(f.name, f.dataType) for f in stored] != shape:
        raise ValueError(f"rows do not fit the stored list at {path}")
    df.write.mode("append").parquet(path)


def read_documents(spark: SparkSession, pattern: str) -> DataFrame:
    """JSON documents, one per file, as (name, body); many files read in parallel."""
    return spark.read.text(pattern, wholetext=True).select(
        F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("name"),
        F.col("value").alias("body"))


def read_discovery(spark: SparkSession, pattern: str, schema) -> DataFrame:
    """Links of discovery documents (``processos`` arrays), with their position."""
    docs = read_documents(spark, pattern)
    parsed = docs.select("name", F.from_json("body", schema).alias("d"))
    return parsed.select("name", F.posexplode("d.processos").alias("pos", "p")).select(
        "name", "pos", "p.*")
