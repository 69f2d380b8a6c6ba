"""Best-fit packing into sequences of several permitted lengths.

Texts are measured in characters (code points) and cut into pieces no longer
than the largest length. Best-fit decreasing needs only how many pieces there
are of each length, so the packing is planned over that histogram, which has at
most as many rows as the largest length: pieces of one length fill whole runs
of equal bins at once. The plan is exact best fit over the whole table; each
piece then finds its bin by its rank among the pieces of its length.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pactum.llm.common import store

CAPACITIES = (2048, 4096, 8192, 16384)
#: Pieces of one length that one task ranks.
CHUNK = 200_000


def cost(capacity: int, largest: int) -> float:
    """Work for a sequence: linear layers, attention that grows with the square, a fixed start."""
    return capacity + capacity * capacity / (4 * largest) + 16


@dataclass
class Plan:
    """Runs of pieces (by position: longer lengths first, then rank) and runs of bins."""

    length: list[int] = field(default_factory=list)
    first: list[int] = field(default_factory=list)  # position of the run's first piece
    per_bin: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    offset: list[int] = field(default_factory=list)
    bins: list[tuple[int, int, int]] = field(default_factory=list)  # (first bin, count, used)
    n_bins: int = 0


class _Open:
    """Runs of open bins by the space they have left."""

    def __init__(self):
        self.spaces: list[int] = []
        self.runs: dict[int, list[tuple[int, int, int]]] = {}

    def add(self, space: int, run: tuple[int, int, int]) -> None:
        if space not in self.runs:
            self.runs[space] = []
            insort(self.spaces, space)
        self.runs[space].append(run)

    def tightest(self, length: int) -> int | None:
        at = bisect_left(self.spaces, length)
        return self.spaces[at] if at < len(self.spaces) else None

    def take(self, space: int) -> tuple[int, int, int]:
        run = self.runs[space].pop()
        if not self.runs[space]:
            del self.runs[space]
            self.spaces.pop(bisect_left(self.spaces, space))
        return run


def _fill(capacity: int, length: int, counts: dict[int, int], lengths: list[int]) -> int:
    """Content of a new bin if it is filled greedily from what is still to be placed."""
    space, own = capacity, length
    while True:
        n = min(counts.get(own, 0), space // own)
        space -= n * own
        at = bisect_left(lengths, min(own, space + 1)) - 1
        if at < 0 or not space:
            return capacity - space
        own = lengths[at]


def _cheapest(length, counts, lengths, capacities) -> int:
    """The permitted length with the least cost for each character it will hold."""
    def price(c):
        filled = _fill(c, length, counts, lengths)
        final = next(x for x in capacities if x >= filled)
        return cost(final, capacities[-1]) / filled

    return min((c for c in capacities if c >= length), key=lambda c: (price(c), c))


def best_fit(histogram: dict[int, int], capacities: tuple[int, ...] = CAPACITIES) -> Plan:
    """Pack pieces, longest first, each into the open bin that it leaves the least space in.

    Where none fits, bins of the cheapest permitted length are opened for all
    pieces of that length. A step uses up a run of bins or a length, so the plan
    has a few rows per length, however many pieces there are.
    """
    capacities = tuple(sorted(capacities))
    plan, open_ = Plan(), _Open()
    counts = dict(histogram)
    lengths = sorted(counts)
    position = 0
    for length in reversed(lengths):
        left = counts[length]
        while left:
            space = open_.tightest(length)
            if space is None:
                counts[length] = left
                space = _cheapest(length, counts, lengths, capacities)
                fresh = -(-left // (space // length))
                open_.add(space, (plan.n_bins, fresh, 0))
                plan.n_bins += fresh
            first, n, used = open_.take(space)
            each = space // length
            taken = min(left, n * each)
            full, rest = divmod(taken, each)
            for bins, per, at in ((full, each, first), (1, rest, first + full)):
                if not bins or not per:
                    continue
                for name, value in (("length", length), ("first", position), ("per_bin", per),
                                    ("bin", at), ("offset", used)):
                    getattr(plan, name).append(value)
                position += bins * per
                if space > per * length:
                    open_.add(space - per * length, (at, bins, used + per * length))
                else:
                    plan.bins.append((at, bins, used + per * length))
            spare = n - full - (1 if rest else 0)
            if spare:
                open_.add(space, (first + n - spare, spare, used))
            left -= taken
        lengths.pop()
        counts.pop(length)
    plan.bins += [run for runs in open_.runs.values() for run in runs]
    plan.bins.sort()
    return plan


def cut(docs: DataFrame, largest: int) -> DataFrame:
    """(doc_id, tie, piece, start, length): pieces of each text, one of length 0 for an empty text."""
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sized = docs.select("doc_id", F.xxhash64(body).alias("tie"), F.length(body).alias("n"),
                        F.monotonically_increasing_id().alias("row"))
    last = F.greatest(F.lit(0), F.ceil(F.col("n") / largest).cast("int") - 1)
    return sized.select("doc_id", "tie", "row", "n", F.explode(F.sequence(F.lit(0), last)).alias(
        "piece")).select(
        "doc_id", "tie", "row", "piece", (F.col("piece") * largest).alias("start"),
        F.least(F.lit(largest), F.col("n") - F.col("piece") * largest).alias("length"))


def place(pieces: DataFrame, capacities: tuple[int, ...] = CAPACITIES) -> DataFrame:
    """Add bin_id, bin_size and bin_offset to pieces (doc_id, piece, row, length).

    ``row`` tells repeated rows apart. Lengths range from 0 to the largest
    capacity; a piece of length 0 needs no bin and gets nulls.
    """
    capacities = tuple(sorted(capacities))
    largest = capacities[-1]
    counts = pieces.groupBy("length").agg(F.count("*").alias("n"))
    found = counts.where("length > 0").collect()  # at most ``largest`` rows
    histogram = {r["length"]: r["n"] for r in found}
    plan = best_fit(histogram, capacities)
    longer = np.zeros(largest + 1, np.int64)  # pieces before the first of each length
    total = 0
    for length in sorted(histogram, reverse=True):
        longer[length] = total
        total += histogram[length]

    # Rank within a length: numbered inside salted chunks, shifted by the chunks before.
    salts = pieces.join(F.broadcast(counts), "length").withColumn(  # at most ``largest`` rows
        "chunk", F.pmod(F.xxhash64("row", "piece"), F.ceil(F.col("n") / CHUNK)))
    chunks = salts.groupBy("length", "chunk").agg(F.count("*").alias("size"))
    earlier = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    shifts = chunks.select("length", "chunk", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias(
        "shift"))
    inside = Window.partitionBy("length", "chunk").orderBy("doc_id", "tie", "piece", "row")
    ranked = salts.withColumn("i", F.row_number().over(inside)).join(
        shifts, ["length", "chunk"]).withColumn("rank", F.col("i") - 1 + F.col("shift"))
    kept = ranked.select("doc_id", "tie", "piece", "start", "length", "rank")

    first, length_, per, bin_, offset = (np.array(x, np.int64) for x in (
        plan.first, plan.length, plan.per_bin, plan.bin, plan.offset))
    bin_first = np.array([b for b, _, _ in plan.bins], np.int64)
    sizes = np.array(capacities, np.int64)
    bin_size = sizes[np.searchsorted(sizes, np.array([u for _, _, u in plan.bins], np.int64))]

    def run(batches):
        for batch in batches:
            own = batch.column(4).to_numpy()
            rank = batch.column(5).to_numpy()
            none = own == 0
            if not len(first):
                ids = sizes_ = offsets = np.zeros(len(own), np.int64)
            else:
                position = longer[own] + rank
                at = np.maximum(np.searchsorted(first, position, "right") - 1, 0)
                nth = position - first[at]
                ids = bin_[at] + nth // per[at]
                offsets = offset[at] + nth % per[at] * own
                sizes_ = bin_size[np.maximum(np.searchsorted(bin_first, ids, "right") - 1, 0)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(5)]
                + [pa.array(c, pa.int64(), mask=none) for c in (ids, sizes_, offsets)],
                names=["doc_id", "tie", "piece", "start", "length", "bin_id", "bin_size", "bin_offset"])

    return kept.mapInArrow(
        run, "doc_id long, tie long, piece int, start int, length int, "
        "bin_id long, bin_size long, bin_offset long")


def pack(docs: DataFrame, capacities: tuple[int, ...] = CAPACITIES) -> DataFrame:
    """(doc_id, piece, start, length, bin_id, bin_size, bin_offset) for every piece of every row.

    Reads doc_id and text only. Null and empty texts are one piece of length 0
    without a bin. A text longer than the largest capacity is cut into full
    pieces and a rest. Repeated rows are packed as often as they stand; ids may
    be null. Pieces of equal length are interchangeable, ties go by doc_id.
    """
    pieces = store(cut(docs, max(capacities)), "pieces")
    return place(pieces, capacities).drop("tie")


def sequences(docs: DataFrame, capacities: tuple[int, ...] = CAPACITIES) -> DataFrame:
    """(bin_id, bin_size, used, doc_ids, text): the packed sequences themselves.

    ``text`` is the pieces in bin order without separators; ``doc_ids`` names
    the document of each piece. Empty texts are in no sequence.
    """
    pieces = store(cut(docs, max(capacities)), "pieces")
    placed = place(pieces, capacities).where("length > 0")
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select("doc_id", F.xxhash64(body).alias("tie"), body.alias("text")).groupBy(
        "doc_id", "tie").agg(F.first("text").alias("text"))
    p, t = placed.alias("p"), texts.alias("t")
    filled = p.join(t, (F.col("p.tie") == F.col("t.tie")) & F.col("p.doc_id").eqNullSafe(
        F.col("t.doc_id"))).select(
        "bin_id", "bin_size", F.struct(
            F.col("bin_offset").alias("at"), F.col("p.doc_id").alias("doc_id"), "length",
            F.substr("text", F.col("start") + 1, F.col("length")).alias("text")).alias("part"))
    bins = filled.groupBy("bin_id", "bin_size").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    return bins.select(
        "bin_id", "bin_size",
        F.aggregate("parts", F.lit(0), lambda a, x: a + x["length"]).alias("used"),
        F.transform("parts", lambda x: x["doc_id"]).alias("doc_ids"),
        F.array_join(F.transform("parts", lambda x: x["text"]), "").alias("text"))
