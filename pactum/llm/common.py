"""Helpers of the text operators: table access, stored stages, bounded text slices, word codes."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactum.sources.stage_store import store

__all__ = ["documents", "store", "text_slices", "Memo", "ragged_append", "ragged_gather",
           "membership", "may_hold", "released", "by_key"]

#: Characters of text that a Python worker handles at once; one longer text is handled alone.
SLICE_CHARS = 4_000_000


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def by_key(df: DataFrame) -> DataFrame:
    """``df`` for a join that moves both sides by key, whatever sizes Spark expects.

    It sizes a stored table by its files, where arrays and binary values count as a few bytes of a
    row, and rows of an explode as their input; such a table would go to the driver whole.
    """
    return df.hint("merge")


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_CHARS
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Cut Arrow batches into row slices of bounded text size; null texts read as empty."""
    for batch in batches:
        texts = batch.column(column)
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(
            zero_copy_only=False)
        first, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield _cut(batch, column, first, i)
                first, held = i, 0
            held += int(size)
        if first < batch.num_rows:
            yield _cut(batch, column, first, batch.num_rows)


def _cut(batch, column, first, last):
    part = batch.slice(first, last - first)
    return part, [t if t is not None else "" for t in part.column(column).to_pylist()]


def released(run: Callable) -> Callable:
    """``run`` over batches; freed memory then goes back to the system.

    Idle workers wait beside the stages that follow, with all that their
    allocators still hold.
    """
    def whole(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)

    return whole


class Memo:
    """Codes of units, and arrays with one value per code, kept from slice to slice.

    ``extend`` gets the new units, in the order of their codes. Beyond ``keep``
    units all are forgotten and counted anew, which bounds the memory and
    changes no result.
    """

    KEEP = 700_000

    def __init__(self, extend: Callable[[list], None], clear: Callable[[], None],
                 keep: int | None = None):
        self.code: dict[Hashable, int] = {}
        self.extend, self.clear, self.keep = extend, clear, keep or self.KEEP

    def codes(self, units: list) -> np.ndarray:
        found = np.fromiter(map(self.code.get, units, repeat(-1)), np.int64, len(units))
        missing = np.flatnonzero(found < 0)
        if not len(missing):
            return found
        new = list(dict.fromkeys(map(units.__getitem__, missing.tolist())))
        if self.code and len(self.code) + len(new) > self.keep:
            self.code.clear()
            self.clear()
            return self.codes(units)
        self.code.update(zip(new, range(len(self.code), len(self.code) + len(new))))
        self.extend(new)
        found[missing] = np.fromiter(
            map(self.code.__getitem__, map(units.__getitem__, missing.tolist())), np.int64,
            len(missing))
        return found


def ragged_append(values, offsets, more, more_offsets):
    """Two ragged arrays as one."""
    return (np.concatenate([values, more]),
            np.concatenate([offsets, offsets[-1] + more_offsets[1:]]))


def ragged_gather(values: np.ndarray, offsets: np.ndarray, pick: np.ndarray):
    """Concatenate the rows ``pick`` of a ragged array; also their lengths."""
    lengths = (offsets[1:] - offsets[:-1])[pick]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    shift = np.repeat(offsets[:-1][pick] - (ends - lengths), lengths)
    return values[shift + np.arange(total)], lengths


#: 64-bit words of a membership filter: 1 MB, whatever the number of members.
FILTER_WORDS = 1 << 17


def _bit(hash_: Column, words: int) -> tuple[Column, Column]:
    place = F.pmod(hash_, F.lit(64 * words))
    return F.floor(place / 64).cast("int"), (place % 64).cast("int")


def membership(rows: DataFrame, hash_: Column, words: int = FILTER_WORDS) -> DataFrame:
    """One row ``bits``: an array of fixed size in which the bit of every member's hash is set.

    Broadcasting it is bounded by ``words``. It only thins out what an exact
    join then decides; the fuller it is, the less it thins out. Where the array
    stands beside rows as a column, it is copied for each of them.
    """
    word, bit = _bit(hash_, words)
    one = F.lit(1).cast("long")
    used = rows.select(word.alias("id"), F.call_function("shiftleft", one, bit).alias("mask")).groupBy(
        "id").agg(F.bit_or("mask").alias("mask"))
    slots = rows.sparkSession.range(words).select(F.col("id").cast("int").alias("id"))
    masks = slots.join(used, "id", "left").select(
        F.struct("id", F.coalesce("mask", F.lit(0).cast("long")).alias("mask")).alias("slot"))
    return masks.agg(F.transform(F.array_sort(F.collect_list("slot")), lambda s: s["mask"]).alias("bits"))


def may_hold(bits: Column, hash_: Column, words: int = FILTER_WORDS) -> Column:
    """False only where the hash is no member's."""
    word, bit = _bit(hash_, words)
    return F.call_function("shiftright", F.get(bits, word), bit).bitwiseAND(
        F.lit(1).cast("long")) == 1
