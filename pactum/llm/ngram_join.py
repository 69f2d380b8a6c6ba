"""Grouped prefix join of n-gram sets by Jaccard similarity, and its connected groups.

Two sets as similar as asked share a gram among their first few in any common
order (the prefix). The order puts grams that are frequent among first prefixes
last, so passages that many texts share are rarely looked up. Documents with
equal prefix and size form one group; groups meet at the grams of their
prefixes, a pair of groups is filtered by size, and its members are filtered
by the parity bits of their sets, which never reject a similar pair, before the
full sets decide.

Equal sets are one member from the start. A group is linked to its first member,
and the groups of a gram to the busiest among them. Only where a bucket still
holds several components are their members compared across components. In
buckets of up to 64 members, pairs are also filtered by the places of the gram.
Larger buckets never list their pairs: their members meet in blocks of bounded
size that hold ids and bits but no sets, first along a spanning forest of likely
links, then whatever is still apart.

Handling: null, empty and wordless texts have an empty set and link with
nothing; a text shorter than a gram is one gram. Repeated rows are equal sets.
Rows that share an id count as linked. A row without an id is linked with
nothing and has no component. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactum.llm.common import FILTER_WORDS, by_key, membership, store, text_slices
from pactum.llm.components import components
from pactum.llm.minhash import shingle_sets

#: A gram in more first prefixes than this goes to the end of the order.
FREQUENT = 16
#: First prefixes are this much longer, since frequent grams make room later.
LONGER = 1.25
#: Members of a bucket whose pairs may be listed.
SMALL = 64
#: Bytes of one block of a bucket, and those of a member besides its bits.
BLOCK_BYTES, ROW_BYTES = 600_000, 200


def prefix_size(n, percent: int):
    """Grams of which a similar set of any size must share one."""
    return n - -(-n * percent // 100) + 1


def close_enough(x: int, y: int, apart: int, percent: int) -> bool:
    """Whether sets of these sizes that differ in ``apart`` grams are similar (all counts exact)."""
    return (100 + percent) * apart <= (100 - percent) * (x + y)


def parity_bits(grams: np.ndarray) -> np.ndarray:
    """One bit per slot: whether the set holds an odd number of its grams.

    Sets differ in at least as many grams as their bits do. There are one to two
    slots for each gram.
    """
    slots = max(64, 1 << int(len(grams) - 1).bit_length())
    odd = np.bincount((grams & np.uint64(slots - 1)).astype(np.int64), minlength=slots) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Parity bits for fewer slots."""
    while len(bits) > words:
        bits = bits[:len(bits) // 2] ^ bits[len(bits) // 2:]
    return bits


def _arrays(sets: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
    flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def _keys(sets: list[np.ndarray]) -> pa.Array:
    return pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())


def _first_pass(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, n, set_key, first): set sizes and keys, and the first grams by hash alone."""

    def run(batches):
        for part, texts in text_slices(batches):
            sets = shingle_sets(texts, width)
            first = [s[:int(LONGER * prefix_size(len(s), percent))] if len(s) else s for s in sets]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(s) for s in sets], pa.int64()), _keys(sets), _arrays(first)],
                names=["doc_id", "n", "set_key", "first"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n long, set_key binary, first array<long>")


def _second_pass(docs: DataFrame, bits: np.ndarray, width: int, percent: int) -> DataFrame:
    """(id, set_key, prefix, prefix_key, bits): prefixes in the order that puts frequent grams last."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def late(grams):
        place = grams & np.uint64(64 * FILTER_WORDS - 1)
        word = shared.value[(place >> np.uint64(6)).astype(np.int64)]
        return (word >> (place & np.uint64(63))) & np.uint64(1) == 1

    def run(batches):
        for part, texts in text_slices(batches):
            sets = shingle_sets(texts, width)
            prefixes = []
            for s in sets:
                behind = late(s)
                prefixes.append(np.concatenate([s[~behind], s[behind]])[:prefix_size(len(s), percent)]
                                if len(s) else s)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), _keys(sets), _arrays(prefixes), _keys(prefixes),
                 pa.array([parity_bits(s).tobytes() if len(s) else b"" for s in sets], pa.binary())],
                names=["id", "set_key", "prefix", "prefix_key", "bits"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "id long, set_key binary, prefix array<long>, prefix_key binary, bits binary")


def _likely(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that sizes and parity bits allow."""
    both = pairs
    for end in ("a", "b"):
        both = both.join(by_key(members.select(
            F.col("id").alias(end), F.col("n").alias(f"{end}_n"), F.col("bits").alias(f"{end}_bits"))), end)

    def run(batches):
        for batch in batches:
            sizes = list(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()))
            keep = []
            for i, (x, y) in enumerate(sizes):
                p, q = (np.frombuffer(batch.column(c)[i].as_buffer(), np.uint64) for c in (4, 5))
                words = min(len(p), len(q))
                apart = int(np.bitwise_count(folded(p, words) ^ folded(q, words)).sum())
                keep.append(close_enough(x, y, max(apart, abs(x - y)), percent))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "a_n", "b_n", "a_bits", "b_bits").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, docs: DataFrame, members: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs whose full sets are similar; only the sets of their members are made again."""
    pairs = store(pairs.distinct(), "pairs")
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()

    def make(batches):
        for part, texts in text_slices(batches):
            sets = shingle_sets(texts, width)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), _keys(sets), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["id", "set_key", "grams"])

    texts = docs.select("doc_id", "text").join(
        by_key(ids.withColumnRenamed("id", "doc_id")), "doc_id", "left_semi")
    sets = store(texts.mapInArrow(make, "id long, set_key binary, grams binary").join(
        by_key(members.select("id", "set_key")), ["id", "set_key"], "left_semi").dropDuplicates(["id", "set_key"]), "sets")

    def run(batches):
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[i].as_buffer(), np.uint64) for c in (2, 3))
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(close_enough(len(x), len(y), len(x) + len(y) - 2 * common, percent))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    both = pairs
    for end in ("a", "b"):
        both = both.join(by_key(sets.select(F.col("id").alias(end), F.col("grams").alias(f"{end}_grams"))), end)
    return both.select("a", "b", "a_grams", "b_grams").mapInArrow(run, "a long, b long")


def _busiest(groups: DataFrame, key: str) -> DataFrame:
    """(key, centre): the group of each bucket that stands in most buckets, the smallest of equals.

    Score and id are one number each, so the aggregate keeps fixed-width values.
    """
    scores = groups.groupBy("group").agg(F.count("*").alias("score"))
    scored = groups.join(by_key(scores), "group")
    top = scored.groupBy(key).agg(F.max("score").alias("score"))
    return scored.join(by_key(top), [key, "score"]).groupBy(key).agg(F.min("group").alias("centre"))


def _open_buckets(spread: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members of small and of large buckets that hold several components.

    Of large buckets with the same members one is kept.
    """
    labels = store(labels, "labels")
    placed = spread.join(by_key(labels.select(F.col("node").alias("id"), "component")), "id", "left").select(
        "bucket", "place", "id", "n", F.coalesce("component", "id").alias("component"))
    found = placed.groupBy("bucket").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("rows"),
        F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y")).where("lo != hi")
    once = found.where(F.col("rows") > SMALL).groupBy("rows", "x", "y").agg(F.min("bucket").alias("bucket"))
    kept = found.where(F.col("rows") <= SMALL).select("bucket", "rows").union(once.select("bucket", "rows"))
    open_ = store(placed.join(by_key(kept), "bucket"), "open_buckets")
    return open_.where(F.col("rows") <= SMALL), open_.where(F.col("rows") > SMALL)


def _listed(small: DataFrame, percent: int) -> DataFrame:
    """Pairs of small buckets that sizes allow, and the places of a gram that is their first common one."""
    side = lambda end: small.select("bucket", *[
        F.col(c).alias(f"{end}_{c}") for c in ("id", "place", "n", "component")])
    both = side("a").join(by_key(side("b")), "bucket")
    behind = F.least(F.col("a_n") - F.col("a_place"), F.col("b_n") - F.col("b_place"))
    return both.where(
        (F.col("a_id") < F.col("b_id")) & (F.col("a_component") != F.col("b_component"))
        & (100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n"))
        & ((100 + percent) * behind >= percent * (F.col("a_n") + F.col("b_n")))).select(
        F.col("a_id").alias("a"), F.col("b_id").alias("b")).distinct()


def _blocks(placed: DataFrame) -> DataFrame:
    """Members of open buckets, dealt into groups of at most two blocks.

    The largest component of a bucket is never compared with itself: its blocks
    meet those of the other members only, which also meet each other.
    """
    sizes = placed.groupBy("bucket", "component").agg(F.count("*").alias("rows"))
    most = sizes.groupBy("bucket").agg(F.max("rows").alias("rows"))
    main = sizes.join(by_key(most), ["bucket", "rows"]).groupBy("bucket").agg(F.min("component").alias("main"))
    sided = placed.join(by_key(main), "bucket").withColumn("rest", F.col("component") != F.col("main"))
    held = F.lit(ROW_BYTES) + F.col("n") / 4
    number = lambda own: F.ceil(F.sum(F.when(own, held)) / BLOCK_BYTES)
    counts = sided.groupBy("bucket").agg(
        number(F.col("rest")).alias("rests"), number(~F.col("rest")).alias("mains"))
    at = sided.join(by_key(counts), "bucket").withColumn("block", F.pmod(
        F.xxhash64("id"), F.when(F.col("rest"), F.col("rests")).otherwise(F.col("mains"))))
    block = F.col("block")
    pair = lambda i, j: F.struct(i.cast("long").alias("i"), j.cast("long").alias("j"))
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    # Blocks of the main component are numbered below zero.
    groups = F.when(F.col("rest"), F.concat(
        F.transform(upto("rests"), lambda k: pair(F.least(block, k), F.greatest(block, k))),
        F.transform(upto("mains"), lambda k: pair(-1 - k, block)))).otherwise(
        F.transform(upto("rests"), lambda k: pair(-1 - block, k)))
    return at.select("bucket", "id", "n", "component", "rest", F.col("block"), F.explode(groups).alias("pair"))


def _across(placed: DataFrame, members: DataFrame, percent: int, forest: bool) -> DataFrame:
    """Likely pairs of different components that share a bucket; a forest of them if asked."""
    rows = _blocks(placed).join(by_key(members.select("id", "n", "bits")), ["id", "n"])
    filled = rows.groupBy("bucket", "pair").agg(F.collect_list(
        F.struct("n", "id", "component", "rest", "block", "bits")).alias("rows"))

    def run(batches):
        for batch in batches:
            for pair, own in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = _compare(pair, own.as_py(), percent, forest)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    return filled.select("pair", "rows").mapInArrow(run, "a long, b long")


def _compare(pair: dict, rows: list[dict], percent: int, forest: bool) -> list[tuple[int, int]]:
    rows.sort(key=lambda r: r["n"])
    n = np.array([r["n"] for r in rows])
    component = np.array([r["component"] for r in rows])
    side = np.array([r["block"] if r["rest"] else -1 - r["block"] for r in rows])
    bits = [np.frombuffer(r["bits"], np.uint64) for r in rows]
    root: dict[int, int] = {}

    def find(c):
        while root.get(c, c) != c:
            root[c] = c = root.get(root[c], root[c])
        return c

    found = []
    lengths = np.array([len(b) for b in bits])  # ascending, as sizes are
    stacked: dict[int, np.ndarray] = {}
    for i in range(len(rows)):
        # Similar sets that are larger: sizes within the ratio, other component, other side if two meet.
        end = np.searchsorted(n, n[i] * 100 // percent, "right")
        others = np.arange(i + 1, end)
        ok = component[others] != component[i]
        if pair["i"] != pair["j"]:
            ok &= side[others] != side[i]
        others = others[ok]
        if not len(others):
            continue
        words = len(bits[i])
        if words not in stacked:
            stacked = {words: np.array([folded(b, words) for b in bits if len(b) >= words])}
        skipped = np.searchsorted(lengths, words)
        apart = np.bitwise_count(stacked[words][others - skipped] ^ bits[i]).sum(axis=1)
        near = (100 + percent) * np.maximum(apart, n[others] - n[i]) <= (100 - percent) * (n[others] + n[i])
        for k in others[near]:
            a, b = find(int(component[i])), find(int(component[k]))
            if forest:
                if a == b:
                    continue
                root[max(a, b)] = min(a, b)
            found.append((rows[i]["id"], rows[k]["id"]))
    return found


def similar_groups(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text)."""
    base = store(_first_pass(docs, width, percent), "sets")
    named = base.where("n > 0 AND doc_id IS NOT NULL").select("doc_id", "n", "set_key")
    classes = named.groupBy("set_key").agg(F.min("doc_id").alias("id"), F.first("n").alias("n"))

    often = base.select(F.explode("first").alias("gram")).groupBy("gram").count().where(
        F.col("count") > FREQUENT)
    late = np.array(membership(often, F.col("gram")).first()["bits"], np.int64).view(np.uint64)
    members = store(
        _second_pass(docs, late, width, percent).join(by_key(classes), ["set_key", "id"]).dropDuplicates(
            ["set_key", "id"]), "members")

    # Groups of equal prefix and size, named by their first member.
    groups = members.groupBy("prefix_key", "n").agg(F.min("id").alias("group"))
    grouped = store(members.select("id", "prefix_key", "n").join(by_key(groups), ["prefix_key", "n"]).select(
        "id", "n", "group").distinct(), "groups")
    postings = members.join(by_key(grouped.where("id = group").select("id")), "id", "left_semi").select(
        F.col("id").alias("group"), F.posexplode("prefix").alias("place", "bucket"))
    shared = postings.groupBy("bucket").agg(F.count("*").alias("groups")).where("groups > 1")
    buckets = store(postings.join(by_key(shared.select("bucket")), "bucket"), "buckets")

    # Each group to the busiest group of its grams, each member to its group's first.
    stars = buckets.join(by_key(_busiest(buckets, "bucket")), "bucket").where("group != centre").select(
        F.col("group").alias("a"), F.col("centre").alias("b"))
    inside = grouped.where("id != group").select(F.col("id").alias("a"), F.col("group").alias("b"))
    verify = lambda pairs: _verified(pairs, docs, members, width, percent)
    links = store(verify(_likely(stars.union(inside).distinct(), members, percent)), "links")

    # Buckets with several components: grams with the members of their groups, and the groups themselves.
    several = grouped.groupBy("group").count().where("count > 1").select("group")
    spread = store(buckets.join(by_key(grouped), "group").select("bucket", "place", "id", "n").union(
        grouped.join(by_key(several), "group").select(
            F.xxhash64(F.lit("group"), "group").alias("bucket"), F.lit(0).alias("place"), "id", "n")), "spread")
    small, large = _open_buckets(spread, components(links))
    more = store(verify(_likely(_listed(small, percent), members, percent).union(
        _across(large, members, percent, True))), "links")
    links = links.union(more)
    if large.take(1):
        _, large = _open_buckets(spread, components(links))
        links = links.union(store(verify(_across(large, members, percent, False)), "links"))

    # Rows that share an id are linked with each other.
    twice = named.groupBy("doc_id").agg(F.min("set_key").alias("lo"), F.max("set_key").alias("hi")).where("lo != hi")
    same = named.join(by_key(twice.select("doc_id")), "doc_id", "left_semi").join(
        by_key(classes.select("set_key", "id")), "set_key").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    labels = components(links.union(same))
    at = classes.join(by_key(labels.withColumnRenamed("node", "id")), "id", "left").select(
        "set_key", F.coalesce("component", "id").alias("component_id"))
    return base.select("doc_id", F.col("n").alias("n_shingles"), "set_key").join(by_key(at), "set_key", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
