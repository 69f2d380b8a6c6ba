"""Order MinHash fingerprints of texts, and the likeness of neighbouring texts.

The k-mers (code points) of a text are numbered by occurrence, so a repeated
k-mer counts as often as it stands. A hash deals the numbered k-mers into bins;
in each bin the smallest few are selected, put back into text order, and the
tuple of their hashes is the bin's entry in the signature. Two signatures agree
in a bin only if the selected k-mers are the same and stand in the same order:
the measure falls with edit distance, not only with shared content.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pactum.llm.common import store, text_slices

KMER = 5
BINS = 128
TUPLE = 2

_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def fingerprint(text: str) -> np.ndarray:
    """One 16-bit entry per bin, 0 where the bin got no k-mer.

    A text shorter than a k-mer is one k-mer; an empty text has empty bins only.
    """
    out = np.zeros(BINS, np.uint16)
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    n = len(points)
    if not n:
        return out
    size = min(KMER, n)
    h = points[:n - size + 1].astype(np.uint64)
    for k in range(1, size):
        h *= _BASE
        h += points[k:n - size + 1 + k]
    h = _mix(h + np.uint64(size))

    # Sort keys hold the place in their lower bits: equal k-mers stand together, in text order.
    low = np.uint64(max(20, int(n).bit_length()))
    place = np.arange(len(h), dtype=np.uint64)
    mask = (np.uint64(1) << low) - np.uint64(1)
    keys = np.sort((h & ~mask) | place)
    again = (keys[1:] >> low) == (keys[:-1] >> low)
    if again.any():
        again = np.concatenate([[False], again])
        at = np.arange(len(h))
        first = np.maximum.accumulate(np.where(again, 0, at))
        late = np.flatnonzero(again)
        where = (keys[late] & mask).astype(np.int64)
        number = (late - first[late]).astype(np.uint64)
        h[where] = _mix(h[where] + number * np.uint64(0xA24BAED4963EE407))

    # The bin is the upper bits of the hash: after this sort each bin's smallest stand first.
    keys = np.sort((h & ~mask) | place)
    edges = np.searchsorted(keys, _EDGES)
    counts = np.minimum(np.diff(np.append(edges, len(h))), TUPLE)
    slots = np.minimum(edges[:, None] + _SLOTS, len(h) - 1)
    there = _SLOTS < counts[:, None]
    places = np.where(there, (keys & mask).astype(np.int64)[slots], len(h))
    places.sort(axis=1)
    values = np.where(there, h[np.minimum(places, len(h) - 1)], np.uint64(0))
    entry = np.zeros(BINS, np.uint64)
    for k in range(TUPLE):
        entry = _mix(entry * _BASE + values[:, k] + np.uint64(1))
    entry = (entry >> np.uint64(48)).astype(np.uint16)
    filled = counts > 0
    out[filled] = np.maximum(entry[filled], 1)
    return out


_SLOTS = np.arange(TUPLE)
_EDGES = np.arange(BINS, dtype=np.uint64) * np.uint64((1 << 64) // BINS)


def likeness(x: np.ndarray, y: np.ndarray) -> float:
    """Share of equal entries among the bins that either text fills; 1 for two empty texts."""
    filled = (x != 0) | (y != 0)
    total = int(filled.sum())
    return float((x == y)[filled].sum() / total) if total else 1.0


def packed(x: np.ndarray) -> bytes:
    return x.astype(">u2").tobytes()


def edited(text: str, other: str) -> str:
    """``text`` with its second half replaced by as many first characters of ``other``, or all."""
    half = len(text) // 2
    return text[:len(text) - half] + other[:half]


_ROW = ("n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, "
        "near_edited double, near_next double")
_MADE = [n.split()[0] for n in _ROW.split(", ")]


def _compare(text: str, own: np.ndarray, other: str, others: np.ndarray) -> tuple:
    changed = edited(text, other)
    mark = fingerprint(changed)
    return (len(text), hashlib.sha256(changed.encode()).digest(), packed(own), packed(mark),
            likeness(own, mark), likeness(own, others))


def _rows(found: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)


_KEY = [pa.field("doc_id", pa.int64()), pa.field("tie", pa.int64()), pa.field("nth", pa.int64())]
_VALUES = [pa.field("n_chars", pa.int64()), pa.field("edited_sha256", pa.binary()),
           pa.field("fingerprint", pa.binary()), pa.field("edited_fingerprint", pa.binary()),
           pa.field("near_edited", pa.float64()), pa.field("near_next", pa.float64())]
_CHAIN = pa.schema([*_KEY, pa.field("kind", pa.int32()), pa.field("text", pa.string()), *_VALUES])
_DONE, _HEAD, _TAIL = 0, 1, 2
_NOTHING = (None,) * len(_VALUES)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare each row of a sorted part with the next one; hand out the part's first and last text."""
    last = None
    for part, texts in text_slices(batches):
        keys = list(zip(*(part.column(i).to_pylist() for i in range(3))))
        found = []
        for key, text in zip(keys, texts):
            mark = fingerprint(text)
            if last is None:
                found.append((*key, _HEAD, text, *_NOTHING))
            else:
                found.append((*last[0], _DONE, None, *_compare(*last[1:], text, mark)))
            last = (key, text, mark)
        yield _rows(found, _CHAIN)
    if last is not None:
        yield _rows([(*last[0], _TAIL, last[1], *_NOTHING)], _CHAIN)


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last row of each part, with the first text of the part that follows."""
    for part in batches:
        found = [(i, *_compare(a, fingerprint(a), b, fingerprint(b)))
                 for i, a, b in zip(*(part.column(c).to_pylist() for c in range(3)))]
        if found:
            yield _rows(found, pa.schema([_KEY[0], *_VALUES]))


def neighbour_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint every text and its edited text, and compare with the next document.

    ``docs`` has doc_id and text; other columns are not read. Null texts read as
    empty. Rows are ordered by doc_id (null first), then by a hash of the text;
    equal rows follow each other. After the last row comes the first, so a
    single row is its own neighbour. The texts are range-partitioned and sorted
    once, with a row number as last key so that no repeated row fills a part.
    Only the first and last text of each part, two per task, meet in one task.
    """
    keyed = docs.select(
        "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"),
        F.monotonically_increasing_id().alias("nth"), F.coalesce("text", F.lit("")).alias("text"))
    order = ["doc_id", "tie", "nth"]
    schema = f"doc_id long, tie long, nth long, kind int, text string, {_ROW}"
    walked = store(
        keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_walk, schema),
        "fingerprints")
    ends = walked.where(F.col("kind") != _DONE)
    along = Window.orderBy(*order, "kind")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tails = ends.select(
        "doc_id", "kind", "text",
        F.coalesce(F.lead("text").over(along), F.first("text").over(whole)).alias("other"),
    ).where(F.col("kind") == _TAIL).drop("kind")
    closed = tails.mapInArrow(_close, f"doc_id long, {_ROW}")
    rows = walked.where(F.col("kind") == _DONE).select("doc_id", *_MADE).union(closed)
    digests = ("edited_sha256", "fingerprint", "edited_fingerprint")
    return rows.withColumns({c: F.lower(F.hex(c)) for c in digests})
