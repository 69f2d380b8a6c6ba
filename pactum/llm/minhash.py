"""Near-duplicate documents: MinHash bands, signature and set checks, connected components.

Equal shingle sets are one class from the start, so copies never meet each
other again. Classes that share a band fall into one bucket. A bucket is first
linked as a star around the member with the most neighbours over all bands,
which in a group of edited copies is their origin. Buckets that still hold
several components are then compared across components in blocks of bounded
size, without ever listing the pairs of a group. Every link is confirmed on the
full shingle sets.
"""

from __future__ import annotations

from decimal import Decimal
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactum.llm.common import released, store, text_slices
from pactum.llm.components import components

HASHES = 128
BAND_ROWS = 4  # 32 bands: a pair at similarity 0.8 shares none with probability 5e-8
#: Five standard errors of a signature's estimate lie below this distance at 0.8.
SIGNATURE_SLACK = 0.2
#: Shingles in one block of a bucket.
BLOCK_SHINGLES = 200_000

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits (the finaliser of a 64-bit generator)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: list[str], width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingles of each text; A-Z lower-cased, words parted by ASCII space."""
    split = [t.encode().lower().split() for t in texts]
    words = [w for own in split for w in own]
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    found, at = [], 0
    for own in split:
        n = len(own)
        h = hashes[at:at + n]
        at += n
        size = min(width, n)
        if not n:
            found.append(h)
            continue
        mixed = np.full(n - size + 1, size, np.uint64)
        for k in range(size):
            mixed = _mix(mixed * _ODD + h[k:n - size + 1 + k])
        found.append(np.unique(mixed))
    return found


@lru_cache(maxsize=4)
def _functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7)
    a = rng.integers(1, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a[:, None], rng.integers(0, 1 << 63, count, dtype=np.uint64)[:, None]


def signature(shingles: np.ndarray, count: int = HASHES) -> np.ndarray:
    """The minimum of each universal hash (a x + b, upper half) over the set."""
    a, b = _functions(count)
    least = np.full(count, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 512):
        np.minimum(least, (shingles[None, i:i + 512] * a + b).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype("<u4")


def signatures(docs: DataFrame, width: int, hashes: int = HASHES) -> DataFrame:
    """(doc_id, n_shingles, set_key, signature) of every row; null texts read as empty."""

    def run(batches):
        for part, texts in text_slices(batches):
            sets = shingle_sets(texts, width)
            yield pa.RecordBatch.from_arrays([
                part.column(0),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                pa.array([signature(s, hashes).tobytes() if len(s) else None for s in sets],
                         pa.binary()),
            ], names=["doc_id", "n_shingles", "set_key", "signature"])

    return docs.select("doc_id", "text").mapInArrow(
        released(run), "doc_id long, n_shingles long, set_key binary, signature binary")


def _profiles(docs: DataFrame, nodes: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(id, n_shingles, signature, shingles) of the named nodes; the sets are made anew from the texts."""

    def run(batches):
        for part, texts in text_slices(batches):
            sets = [s.tobytes() for s in shingle_sets(texts, width)]
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array([xxhash.xxh3_128_digest(s) for s in sets], pa.binary()),
                pa.array(sets, pa.binary())], names=["id", "set_key", "shingles"])

    named = docs.select("doc_id", "text").join(
        ids.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi")
    made = named.mapInArrow(released(run), "id long, set_key binary, shingles binary")
    single = made.groupBy("id", "set_key").agg(F.first("shingles").alias("shingles"))
    return nodes.join(single, ["id", "set_key"]).select("id", "n_shingles", "signature", "shingles")


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def _confirm(links: DataFrame, profiles: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that the signatures allow and the full sets confirm."""
    side = ("signature", "shingles")
    both = links
    for end in ("a", "b"):
        both = both.join(profiles.select(
            F.col("id").alias(end), *[F.col(c).alias(f"{end}_{c}") for c in side]), end)
    both = both.select("a", "b", *[f"{end}_{c}" for c in side for end in ("a", "b")])

    def run(batches):
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[i].as_buffer(), "<u4") for c in (2, 3))
                keep.append(np.mean(x == y) >= percent / 100 - SIGNATURE_SLACK and _similar(
                    *(np.frombuffer(batch.column(c)[i].as_buffer(), np.uint64) for c in (4, 5)),
                    percent))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(released(run), "a long, b long")


_WIDE = "decimal(38,0)"
_SPAN, _TOP = Decimal(1 << 64), Decimal((1 << 63) - 1)


def _packed(score, node) -> Column:
    """One number that orders by score, then by the smaller node; a hash aggregate can hold it."""
    return (score.cast(_WIDE) * F.lit(_SPAN) + (F.lit(_TOP) - node.cast(_WIDE))).cast(_WIDE)


def _unpacked(packed: Column) -> Column:
    return (F.lit(_TOP) - F.pmod(packed, F.lit(_SPAN))).cast("long")


def _stars(members: DataFrame) -> DataFrame:
    """(a, b): each member of a bucket and the bucket's centre."""
    scores = members.groupBy("id").agg(F.sum("size").alias("score"))
    centres = members.join(scores, "id").groupBy("bucket").agg(
        F.max(_packed(F.col("score"), F.col("id"))).alias("top"))
    return members.join(centres.select("bucket", _unpacked(F.col("top")).alias("b")), "bucket").where(
        "id != b").select(F.col("id").alias("a"), "b").distinct()


def _across(members: DataFrame, labels: DataFrame, profiles: DataFrame, percent: int) -> DataFrame:
    """Links between different components that share a bucket.

    Of buckets with the same members only that of the first band is looked at.
    The largest component of a bucket is never compared with itself; all others
    are compared with it and with each other, in groups of bounded size. A
    group returns at most as many links as join its components.
    """
    found = members.join(labels.select(F.col("node").alias("id"), "component"), "id", "left").select(
        "bucket", "band", "id", F.coalesce("component", "id").alias("component"))
    mixed = found.groupBy("bucket").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("band").alias("band"),
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("id")).alias("x"),
        F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y")).where("lo != hi")
    mixed = mixed.groupBy("n", "x", "y").agg(F.min_by("bucket", "band").alias("bucket"))
    open_ = store(found.join(mixed.select("bucket"), "bucket").join(
        profiles.select("id", "n_shingles"), "id"), "open_buckets")
    main = open_.groupBy("bucket", "component").agg(F.count("*").alias("n")).groupBy("bucket").agg(
        _unpacked(F.max(_packed(F.col("n"), F.col("component")))).alias("main"))
    sided = open_.join(main, "bucket").withColumn("rest", F.col("component") != F.col("main"))
    weight = lambda own: F.ceil(
        F.coalesce(F.sum(F.when(own, F.col("n_shingles"))), F.lit(0)) / BLOCK_SHINGLES)
    blocks = sided.groupBy("bucket").agg(
        weight(F.lit(True)).alias("blocks"), weight(F.col("rest")).alias("rests"),
        weight(~F.col("rest")).alias("mains"))
    placed = sided.drop("n_shingles", "main").join(blocks, "bucket").withColumn(
        "block", F.pmod(F.xxhash64("id"), F.when(F.col("rest"), F.col("rests")).otherwise(
            F.col("mains"))))

    def pair(kind, i, j):
        return F.struct(F.lit(kind).alias("kind"), i.cast("long").alias("i"), j.cast("long").alias("j"))

    block, zero = F.col("block"), F.lit(0)
    upto = lambda n: F.sequence(zero.cast("long"), F.col(n) - 1)
    groups = F.when(F.col("blocks") == 1, F.array(pair("all", zero, zero))).when(
        F.col("rest"),
        F.concat(
            F.transform(upto("rests"), lambda k: pair("rest", F.least(block, k), F.greatest(block, k))),
            F.when(F.col("mains") > 0, F.transform(upto("mains"), lambda k: pair("main", block, k)))
            .otherwise(F.array().cast("array<struct<kind:string,i:long,j:long>>"))),
    ).otherwise(F.transform(upto("rests"), lambda k: pair("main", k, block)))
    dealt = placed.select("bucket", "band", "id", "component", "rest", "block",
                          F.explode(groups).alias("group"))
    filled = dealt.join(profiles.select("id", "signature", "shingles"), "id").groupBy(
        "bucket", "band", "group").agg(F.collect_list(
            F.struct("id", "component", "rest", "block", "signature", "shingles")).alias("rows"))

    def run(batches):
        for batch in batches:
            for band, group, rows in zip(*(batch.column(c) for c in range(3))):
                links = _compare(band.as_py(), group.as_py(), rows.as_py(), percent)
                yield pa.RecordBatch.from_pydict(
                    {"a": pa.array([a for a, _ in links], pa.int64()),
                     "b": pa.array([b for _, b in links], pa.int64())})

    return filled.select("band", "group", "rows").mapInArrow(released(run), "a long, b long")


def _compare(band: int, group: dict, rows: list[dict], percent: int) -> list[tuple[int, int]]:
    """Links that join components of a group; a pair is looked at in its first common band only."""
    rows = sorted(rows, key=lambda r: r["id"])
    signs = np.array([np.frombuffer(r["signature"], "<u4") for r in rows])
    sets = [np.frombuffer(r["shingles"], np.uint64) for r in rows]
    rest = np.array([r["rest"] for r in rows])
    block = np.array([r["block"] for r in rows])
    place = np.arange(len(rows))
    root: dict[int, int] = {}

    def find(c):
        while root.get(c, c) != c:
            c = root[c]
        return c

    links = []
    for i in np.flatnonzero(rest):
        if group["kind"] == "main":
            other = ~rest
        else:
            other = ~rest | (place > i)
            if group["kind"] == "rest" and group["i"] != group["j"]:
                other &= block != block[i]
        others = np.flatnonzero(other)
        same = signs[others] == signs[i]
        earlier = same[:, :band * BAND_ROWS].reshape(len(others), band, BAND_ROWS).all(axis=2).any(axis=1)
        close = same.mean(axis=1) >= percent / 100 - SIGNATURE_SLACK
        for k in others[~earlier & close]:
            a, b = find(rows[i]["component"]), find(rows[k]["component"])
            if a != b and _similar(sets[i], sets[k], percent):
                root[max(a, b)] = min(a, b)
                links.append((rows[i]["id"], rows[k]["id"]))
    return links


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text).

    A text with fewer than ``width`` words is one shingle; an empty or null text
    has none and is linked with nothing. Rows that share an id are one node:
    what is linked with one of them is linked with all. A row with a null id
    cannot be named, so it is linked with nothing, has a null component and is
    kept. Other columns are not read.
    """
    base = store(signatures(docs, width), "signatures")
    classes = base.where("n_shingles > 0 and doc_id is not null").groupBy("set_key").agg(
        F.min("doc_id").alias("id"))
    nodes = store(
        base.withColumnRenamed("doc_id", "id").join(classes, ["set_key", "id"], "left_semi"), "nodes")

    bands = F.transform(
        F.sequence(F.lit(0), F.lit(HASHES // BAND_ROWS - 1)),
        lambda i: F.xxhash64(i, F.substring(
            F.col("signature"), i * (4 * BAND_ROWS) + 1, F.lit(4 * BAND_ROWS))))
    rows = nodes.select("id", F.posexplode(bands).alias("band", "bucket"))
    shared = rows.groupBy("bucket").agg(
        F.count("*").alias("size"), F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo != hi")
    members = store(rows.join(shared.select("bucket", "size"), "bucket"), "members")
    profiles = store(_profiles(docs, nodes, members, width), "profiles")

    labels = components(_confirm(_stars(members), profiles, percent))
    more = _across(members, labels, profiles, percent)
    labels = components(labels.toDF("a", "b").union(more))

    named = classes.join(labels.withColumnRenamed("node", "id"), "id", "left").select(
        "set_key", F.coalesce("component", "id").alias("component_id"))
    return base.select("doc_id", "n_shingles", "set_key").join(named, "set_key", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose document is the first of its group; columns unchanged."""
    gone = near_duplicates(docs, width, percent).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")
