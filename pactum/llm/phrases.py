"""Phrase collocations from a weighted de Bruijn graph.

Texts are cut into pieces and words. Every word starts one gram: the five words
from it, or fewer at a piece's end. Five-word grams are the edges of a graph
whose nodes are the four words that neighbouring edges share; the shorter ones
are the corrections at piece ends. The count of a node is its outgoing flow plus
its corrections, and the counts of three, two and one words follow in the same
way from the level above. A node with one edge in, one edge out and no
correction is inside an unary path: such paths are compacted, and no phrase
inside one is a candidate of its own.

A first pass counts words and word pairs by hash and keeps two bits of every
hash that is frequent enough. A gram ends where a pair is surely too rare for any
candidate, so the second pass counts few long grams. The bit array has a fixed
size and never loses a frequent pair; all reported counts are exact.

Handling: a null text is empty, a null language is `und`, and empty texts and
tables give no rows. Repeated rows count each time, ids are not read. Ties are
ordered by phrase. Other columns are not read.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pactum.llm.common import FILTER_WORDS, Memo, membership, store, text_slices

LONGEST = 5
LEAST = 100
TOP = 2000
#: Characters of text read at once, words remembered, and hashes summed before they leave a task.
SLICE, WORDS, HASHES = 2_000_000, 400_000, 2_500_000
#: Parts of a language that are ranked before the language is.
SALTS = 64

_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_MARK = b"."
_ENDS = b".,;:!?\n\x0b\x0c\r"
_CLEAN = bytes.maketrans(_UPPER + _ENDS, _LOWER + _MARK * len(_ENDS))
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _ODD
    return h ^ (h >> np.uint64(29))


class _Slices:
    """Words of text slices as arrays: their code, their language, piece ends, hashes."""

    def __init__(self):
        self.hash = np.empty(0, np.uint64)
        self.memo = Memo(self._extend, self._clear, WORDS)

    def _extend(self, new: list[bytes]) -> None:
        more = np.fromiter(map(xxhash.xxh3_64_intdigest, new), np.uint64, len(new))
        self.hash = np.concatenate([self.hash, more])

    def _clear(self) -> None:
        self.hash = np.empty(0, np.uint64)

    def read(self, batches):
        """(words, codes, language of each word, language names, word and pair hashes, inside)."""
        for part, texts in text_slices(batches, limit=SLICE):
            split = [t.encode().translate(_CLEAN).replace(_MARK, b" . ").split() + [_MARK] for t in texts]
            words = list(chain.from_iterable(split))
            langs = ["und" if x is None else x for x in part.column("lang").to_pylist()]
            names = list(dict.fromkeys(langs))
            own = np.repeat([names.index(x) for x in langs], [len(s) for s in split])
            salt = np.array([xxhash.xxh3_64_intdigest(x.encode()) for x in names], np.uint64)[own]
            codes = self.memo.codes(words)
            inside = codes != self.memo.code[_MARK]
            single = _mix(self.hash[codes] * _ODD + salt)
            pair = _mix(single[:-1] * _ODD + self.hash[codes[1:]])
            yield words, codes, own, names, single, pair, inside


def _hashed_counts(docs: DataFrame) -> DataFrame:
    """(hash, n) of words and word pairs, partly summed."""

    def summed(parts):
        hashes, n = np.unique(np.concatenate(parts), return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(hashes.view(np.int64)), pa.array(n.astype(np.int64))], ["hash", "n"])

    def run(batches):
        held = []
        for _, _, _, _, single, pair, inside in _Slices().read(batches):
            held += [single[inside], pair[inside[:-1] & inside[1:]]]
            if sum(map(len, held)) > HASHES:
                yield summed(held)
                held = []
        if held:
            yield summed(held)

    return docs.mapInArrow(run, "hash long, n long")


#: A hash has one bit by its low digits and one by those behind.
_BEHIND = 23


def _bit(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes & np.uint64(64 * FILTER_WORDS - 1)
    return (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def _held(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return _bit(bits, hashes) & _bit(bits, hashes >> np.uint64(_BEHIND))


def _reach(linked: np.ndarray) -> np.ndarray:
    """Words of the gram that starts at each word."""
    size, going = np.ones(len(linked), np.int64), linked.copy()
    for k in range(1, LONGEST):
        size += going
        going[:len(going) - k] &= linked[k:]
        going[len(going) - k:] = False
    return size


def _grams(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """(lang, size, gram, n), partly summed: one gram per word; size 0 holds the number of words."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        for words, codes, own, names, single, pair, inside in _Slices().read(batches):
            linked = np.zeros(len(codes), bool)
            linked[:-1] = inside[:-1] & inside[1:] & _held(shared.value, pair)
            size = _reach(linked)
            starts = np.flatnonzero(inside & ((size > 1) | _held(shared.value, single)))
            size = size[starts]
            padded = np.concatenate([codes, np.zeros(LONGEST, np.int64)])
            word = [np.where(size > k, padded[starts + k], 0) for k in range(LONGEST)]
            keys = (word[0] << 32 | word[1], word[2] << 32 | word[3],
                    word[4] << 16 | size, own[starts])
            order = np.lexsort(keys)
            new = np.ones(len(order), bool)
            if len(order):
                new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
            first = np.flatnonzero(new)
            n = np.diff(np.append(first, len(order)))
            at, sizes, lang = starts[order[first]], size[order[first]], own[starts[order[first]]]
            totals = np.bincount(own[inside], minlength=len(names))
            yield pa.RecordBatch.from_arrays([
                pa.array([names[i] for i in lang.tolist()] + names, pa.string()),
                pa.array(np.concatenate([sizes, np.zeros(len(names), np.int64)]).astype(np.int32)),
                pa.array([b" ".join(words[i:i + m]).decode() for i, m in zip(at.tolist(), sizes.tolist())]
                         + [""] * len(names), pa.string()),
                pa.array(np.concatenate([n, totals]).astype(np.int64)),
            ], ["lang", "size", "gram", "n"])

    return docs.mapInArrow(run, "lang string, size int, gram string, n long")


def _front(size: int) -> F.Column:
    return F.substring_index("gram", " ", size)


def _back(size: int) -> F.Column:
    return F.substring_index("gram", " ", -size)


def gram_counts(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """((lang, size, gram, f) of grams of 1 to 5 words, (lang, n) words of each language).

    Counts of at least ``least`` are exact and complete.
    """
    texts = docs.select("text", "lang")
    frequent = _hashed_counts(texts).groupBy("hash").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    both = frequent.select(F.explode(F.array(
        "hash", F.shiftrightunsigned("hash", _BEHIND))).alias("hash"))
    bits = np.array(membership(both, F.col("hash")).first()["bits"], np.int64).view(np.uint64)
    grams = store(
        _grams(texts, bits).groupBy("lang", "size", "gram").agg(F.sum("n").alias("f")), "grams")
    level = grams.where(F.col("size") == LONGEST)
    levels = [level]
    for size in range(LONGEST - 1, 0, -1):
        flow = level.select("lang", _front(size).alias("gram"), "f")
        ends = grams.where(F.col("size") == size).select("lang", "gram", "f")
        level = store(flow.unionByName(ends).groupBy("lang", "gram").agg(F.sum("f").alias("f")).select(
            "lang", F.lit(size).alias("size"), "gram", "f"), f"grams_of_{size}")
        levels.append(level)
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    return (store(found.where(F.col("f") >= least), "frequent_grams"),
            grams.where("size = 0").select("lang", F.col("f").alias("n")))


def unary_nodes(counts: DataFrame) -> DataFrame:
    """(lang, gram) of nodes with one edge in, one edge out and no piece end: flow in = count = flow out."""
    edges = counts.where(F.col("size") == LONGEST)
    ends = edges.select("lang", _front(LONGEST - 1).alias("gram"), "f", F.lit(1).alias("way")).union(
        edges.select("lang", _back(LONGEST - 1).alias("gram"), "f", F.lit(0).alias("way")))
    flows = ends.groupBy("lang", "gram").agg(
        F.max(F.when(F.col("way") == 1, F.col("f"))).alias("out"),
        F.max(F.when(F.col("way") == 0, F.col("f"))).alias("in"))
    nodes = counts.where(F.col("size") == LONGEST - 1).join(flows, ["lang", "gram"])
    return nodes.where("f = out AND f = in").select("lang", "gram")


def compacted_paths(counts: DataFrame) -> DataFrame:
    """(lang, phrase, f): unary paths as one edge each; edges beside no unary node stay as they are.

    Each edge knows the edge behind its last node, and how far it has read;
    a round doubles that. Paths that close on themselves have no first edge and
    are left out.
    """
    edges = counts.where(F.col("size") == LONGEST).select("lang", "gram", "f")
    nodes = unary_nodes(counts)
    heads = edges.withColumn("node", _front(LONGEST - 1)).join(
        nodes.withColumnRenamed("gram", "node"), ["lang", "node"], "left_anti").select("lang", "gram", "f")
    behind = edges.select("lang", F.col("gram").alias("next"), _front(LONGEST - 1).alias("node"),
                          _back(1).alias("tail"))
    inner = edges.withColumn("node", _back(LONGEST - 1)).join(
        nodes.withColumnRenamed("gram", "node"), ["lang", "node"], "left_semi")
    jumps = store(inner.join(behind, ["lang", "node"]).select("lang", "gram", "next", "tail"), "jumps")
    walks = store(heads.select("lang", "f", F.col("gram").alias("phrase"), F.col("gram").alias("at")), "walks")
    while True:
        step = jumps.select("lang", F.col("gram").alias("at"), "next", "tail")
        moved = walks.join(step, ["lang", "at"], "left")
        walks = store(moved.select(
            "lang", "f", F.concat_ws(" ", "phrase", "tail").alias("phrase"),
            F.coalesce("next", "at").alias("at"), F.col("next").isNotNull().alias("going")), "walks")
        if not walks.where("going").take(1):
            return walks.select("lang", "phrase", "f")
        walks = walks.drop("going")
        on = jumps.select("lang", F.col("gram").alias("next"), F.col("next").alias("far"),
                          F.col("tail").alias("more"))
        jumps = store(jumps.join(on, ["lang", "next"], "left").select(
            "lang", "gram", F.coalesce("far", "next").alias("next"),
            F.concat_ws(" ", "tail", "more").alias("tail")), "jumps")


def candidates(counts: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, size, gram, f) of two to five words that no longer candidate holds equally often.

    A longer candidate of equal count holds one of one word more that also has
    that count, so only neighbours on the next level are looked at.
    """
    often = counts.where((F.col("f") >= least) & (F.col("size") > 1))
    path = unary_nodes(counts).select("lang", "gram", F.lit(LONGEST - 1).alias("size"))
    open_ = often.join(path, ["lang", "gram", "size"], "left_anti")
    longer = often.where("size > 2").select("lang", "f", F.explode(F.array(
        F.expr("substring_index(gram, ' ', size - 1)"),
        F.expr("substring_index(gram, ' ', 1 - size)"))).alias("gram"))
    return open_.join(longer, ["lang", "gram", "f"], "left_anti").select("lang", "size", "gram", "f")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's best phrases of ``docs`` (text, lang)."""
    counts, words = gram_counts(docs, least)
    cuts = candidates(counts, least).withColumn("k", F.explode(F.expr("sequence(1, size - 1)"))).select(
        "lang", F.col("gram").alias("phrase"), F.col("f").alias("a"), "k",
        F.expr("substring_index(gram, ' ', k)").alias("front"),
        F.expr("substring_index(gram, ' ', k - size)").alias("back"))
    side = lambda name, f: counts.select("lang", F.col("gram").alias(name), F.col("f").alias(f))
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    scored = cuts.join(side("front", "l"), ["lang", "front"]).join(side("back", "r"), ["lang", "back"]).join(
        words, "lang").withColumn("above", (whole("a") * whole("n")).cast("decimal(38,0)")).withColumn(
        "score", F.expr("CAST((above * 1000BD) AS decimal(38,0)) div "
                        "CAST((CAST(l AS decimal(19,0)) * CAST(r AS decimal(19,0))) AS decimal(38,0))"))
    best = scored.groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = best.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    part = part.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top).drop("rank", "salt")
    ranked = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
