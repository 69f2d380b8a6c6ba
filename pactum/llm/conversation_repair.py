"""Repair of conversation structure by weighted interval parsing.

A conversation is well formed if the initials of its roles read `(s?(ua)+)?`.
The repair grammar is in Chomsky normal form: its symbols N(p, q) say that a
span of rows, edited, leads the pattern from place p to place q, with rules
N(p, q) -> N(p, r) N(r, q). A span of one row derives from keeping, re-roling
or deleting it; insertions are closed over on both sides of every row. A cell
holds the least (cost, audit) of its symbol, and spans are combined bottom-up by
their length. As every place r stands between any two neighbours, each way to
cut a span gives the same cells, so a span is cut once, into halves.

Rows stay in Spark: they are put in order once by a range sort, their codes
(role initial and fault) are gathered in chunks of bounded size, chunks are
parsed in parallel, and the cells of a conversation that lies in several chunks
are combined level by level. No task holds a whole conversation; only its audit
is one value, since that is the result.

Handling: null roles and texts read as one space, as do null ids and turns in
the damage code; a null id names a conversation of its own. Rows of one turn
stand in the order of role, then MD5 of the text. An empty role counts as
illegal and cannot be kept. Repeated rows stay repeated (and are duplicates). A
conversation without rows has zeros, an empty audit and the hash of the empty
string. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache, partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactum.llm.common import store

CHUNK_BITS = 9  # rows of a chunk
FAN_BITS = 8  # chunks combined at once, level by level

# Places in the pattern `(s?(ua)+)?`: start, after s, after u, after ua.
START, AFTER_S, AFTER_U, DONE = range(4)
ENDS = (START, DONE)
STEPS = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U,
         (DONE, "u"): AFTER_U, (AFTER_U, "a"): DONE}
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
INSERT, REROLE, DELETE, TRUNCATED = 2, 2, 3, 1

Cells = dict  # (p, q) -> (cost, audit, path); path: (chunk, p, letters) of each chunk


def _less(found: Cells, pair, cell) -> None:
    if pair not in found or cell[:2] < found[pair][:2]:
        found[pair] = cell


def combine(left: Cells, right: Cells) -> Cells:
    """The cells of two neighbouring spans, by the rules N(p, q) -> N(p, r) N(r, q)."""
    found: Cells = {}
    for (p, r), (cost, audit, path) in left.items():
        for (at, q), (more, rest, way) in right.items():
            if at == r:
                _less(found, (p, q), (cost + more, audit + rest, path + way))
    return found


def _closure() -> Cells:
    """Spans without rows: nothing, or user and assistant rows inserted."""
    found = {(p, p): (0, "", ()) for p in range(4)}
    for _ in range(4):
        step = {(p, q): (INSERT, "I", ()) for (p, letter), q in STEPS.items() if letter in ROLES}
        for pair, cell in combine(found, step).items():
            _less(found, pair, cell)
    return found


INSERTED = _closure()


@lru_cache(maxsize=None)
def one_row(code: str) -> Cells:
    """Cells of one row. ``code``: initial s, u, a or x; capital if the row is truncated;
    d if it must be deleted."""
    found = {(p, p): (DELETE, "D", ()) for p in range(4)}
    if code != "d":
        extra = TRUNCATED if code.isupper() else 0
        for (p, letter), q in STEPS.items():
            if letter == code.lower():
                _less(found, (p, q), (extra, "K", ()))
            if letter in ROLES:
                _less(found, (p, q), (REROLE + extra, "R", ()))
    return combine(combine(INSERTED, found), INSERTED)


@lru_cache(maxsize=1 << 14)
def _short_span(codes: str) -> Cells:
    if len(codes) == 1:
        return one_row(codes)
    half = 1 << (len(codes) - 1).bit_length() - 1
    return combine(_short_span(codes[:half]), _short_span(codes[half:]))


def by_length(spans: list[Cells]) -> Cells:
    """Combine neighbouring spans, shorter ones first."""
    while len(spans) > 1:
        spans = [combine(*spans[i:i + 2]) if i + 1 < len(spans) else spans[i]
                 for i in range(0, len(spans), 2)]
    return spans[0]


def parse(codes: str, chunk: int = 0) -> Cells:
    """Cells of a span of rows; short spans recur and are remembered."""
    cells = by_length([_short_span(codes[i:i + 8]) for i in range(0, len(codes), 8)])
    return {(p, q): (cost, audit, ((chunk, p, len(audit)),)) for (p, q), (cost, audit, _) in cells.items()}


# -- rows ------------------------------------------------------------------------------------
def _blank(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the damage that a hash of `conv_id:turn` decides."""
    code = F.crc32(F.concat(_blank("conv_id"), F.lit(":"), _blank("turn"))) % 20
    text = F.when(code == 1, "").when(code == 2, F.translate(_blank("text"), ".!?", "")).otherwise(
        _blank("text"))
    rows = conversations.where(code != 0).select(
        "conv_id", "turn", F.when(code == 4, "user").otherwise(_blank("role")).alias("role"),
        text.alias("text"), F.when(code == 3, 2).otherwise(1).alias("times"))
    return rows.select("conv_id", "turn", "role", "text", F.explode(
        F.sequence(F.lit(1), "times")).alias("copy")).drop("copy")


def _placed(rows: DataFrame) -> DataFrame:
    """The rows, stored in order; ``at`` grows along the order and splits hot conversations."""
    keys = ["conv_id", "turn", "role", F.md5("text"), "salt"]
    salted = rows.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("salt"))
    ordered = salted.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return store(ordered.drop("salt").withColumn("at", F.monotonically_increasing_id()), "placed")


def _coded(placed: DataFrame) -> DataFrame:
    """(conv_id, turn, at, code, fault): what the parser needs of a row, without its text."""
    blank = ~F.rlike("text", F.lit(r"[^\x20\x09-\x0D]"))
    cut = ~F.rlike("text", F.lit(r"[.!?][\x20\x09-\x0D]*\z"))
    slim = placed.select("conv_id", "turn", "at", "role", F.md5("text").alias("digest"),
                         blank.alias("blank"), cut.alias("cut"))
    first = slim.where("not blank").groupBy("conv_id", "role", "digest").agg(F.min("at").alias("at"))
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    fault = F.when(F.col("blank"), "blank").when(F.col("new").isNull(), "duplicate").when(
        F.col("cut"), "truncated")
    return slim.join(first.select("at", F.lit(True).alias("new")), "at", "left").select(
        "conv_id", "turn", "at", fault.alias("fault"), letter.alias("letter"),
        F.when(fault.isin("blank", "duplicate"), "d").when(F.col("cut"), F.upper(letter))
        .otherwise(letter).alias("code"))


_CELL = "struct<p:int,q:int,cost:long,audit:string,path:array<struct<chunk:long,p:int,letters:long>>>"


def _spans(conv_type: str) -> str:
    return (f"conv_id {conv_type}, span long, first string, last string, illegal long, "
            f"cells array<{_CELL}>")


def _packed(cells: Cells) -> list[dict]:
    return [{"p": p, "q": q, "cost": cost, "audit": audit,
             "path": [dict(zip(("chunk", "p", "letters"), x)) for x in path]}
            for (p, q), (cost, audit, path) in cells.items()]


def _unpacked(cells: list[dict]) -> Cells:
    return {(c["p"], c["q"]): (c["cost"], c["audit"], tuple(tuple(x.values()) for x in c["path"]))
            for c in cells}


_ARROW_CELLS = pa.list_(pa.struct({
    "p": pa.int32(), "q": pa.int32(), "cost": pa.int64(), "audit": pa.string(),
    "path": pa.list_(pa.struct({"chunk": pa.int64(), "p": pa.int32(), "letters": pa.int64()}))}))
_ARROW = {"span": pa.int64(), "first": pa.string(), "last": pa.string(), "illegal": pa.int64(),
          "cells": _ARROW_CELLS}


def _batch(ids: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [ids, *[pa.array([r[i] for r in rows], kind) for i, kind in enumerate(_ARROW.values())]],
        names=["conv_id", *_ARROW])


def _breaks(letters: str) -> int:
    return sum(letters[i:i + 2] not in LEGAL for i in range(len(letters) - 1))


def _chunks(coded: DataFrame) -> DataFrame:
    """Cells of every chunk of at most 512 rows of a conversation."""
    row = F.sort_array(F.collect_list(F.struct("at", "code", "letter")))
    chunks = coded.groupBy("conv_id", F.shiftright("at", CHUNK_BITS).alias("span")).agg(row.alias("rows"))
    joined = chunks.select("conv_id", "span", F.array_join("rows.code", "").alias("codes"),
                           F.array_join("rows.letter", "").alias("letters"))

    def run(batches):
        for batch in batches:
            rows = []
            for span, codes, letters in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                rows.append((span, letters[0], letters[-1], _breaks(letters), _packed(parse(codes, span))))
            yield _batch(batch.column(0), rows)

    return joined.mapInArrow(run, _spans(coded.schema["conv_id"].dataType.simpleString()))


def _joined(spans: DataFrame) -> DataFrame:
    """Neighbouring spans of a conversation of ``count`` spans, at most 256 at once, as one."""
    higher = F.when(F.col("count") <= 1 << FAN_BITS, 0).otherwise(F.shiftright("span", FAN_BITS))
    group = spans.groupBy("conv_id", higher.cast("long").alias("span")).agg(
        F.sort_array(F.collect_list(F.struct("span", "first", "last", "illegal", "cells"))).alias("parts"))

    def run(batches):
        for batch in batches:
            rows = []
            for span, parts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                seams = sum(a["last"] + b["first"] not in LEGAL for a, b in zip(parts, parts[1:]))
                cells = by_length([_unpacked(x["cells"]) for x in parts])
                rows.append((span, parts[0]["first"], parts[-1]["last"],
                             seams + sum(x["illegal"] for x in parts), _packed(cells)))
            yield _batch(batch.column(0), rows)

    return group.mapInArrow(run, _spans(spans.schema["conv_id"].dataType.simpleString()))


def _parsed(coded: DataFrame) -> DataFrame:
    """One row per conversation: illegal, cost, audit, and which part of it edits which chunk."""
    spans, whole = store(_chunks(coded), "spans"), []
    while True:
        counts = spans.groupBy(F.col("conv_id").alias("key")).count().where("count > 1")
        many = store(counts, "conversations_in_spans")
        if not many.take(1):
            break
        own = F.col("conv_id").eqNullSafe(F.col("key"))
        whole.append(spans.join(many, own, "left_anti"))
        spans = store(_joined(spans.join(many, own)), "spans")
    for part in whole:
        spans = spans.unionByName(part)

    ends = F.filter("cells", lambda c: (c["p"] == START) & c["q"].isin(*ENDS))
    best = F.array_min(F.transform(ends, lambda c: F.struct(c["cost"], c["audit"], c["path"])))
    return spans.select("conv_id", "illegal", best.alias("best")).select("conv_id", "illegal", "best.*")


def _edits(parsed: DataFrame) -> DataFrame:
    """(conv_id, at, place, edits): the edits of each chunk, placed before its rows."""
    ends = F.expr("transform(path, (x, i) -> aggregate(slice(path, 1, i), 0L, (n, y) -> n + y.letters))")
    parts = parsed.select("conv_id", "audit", F.explode(F.arrays_zip("path", ends.alias("skip"))).alias("x"))
    return parts.select(
        "conv_id", F.shiftleft("x.path.chunk", CHUNK_BITS).alias("at"), F.col("x.path.p").alias("place"),
        F.expr("substr(audit, x.skip + 1, x.path.letters)").alias("edits"))


class _Writer:
    """Applies edits to the rows of one conversation, in order."""

    def __init__(self, line):
        self.place, self.edits, self.line = START, iter(()), line

    def _put(self, letter: str, role: str, text: str, edit: str) -> None:
        self.place = STEPS[self.place, letter]
        self.line(role, text, edit)

    def _next_role(self) -> str:
        return "a" if self.place == AFTER_U else "u"

    def chunk(self, place: int, edits: str) -> None:
        self.finish()
        self.place, self.edits = place, iter(edits)

    def row(self, role: str, text: str) -> None:
        for edit in self.edits:
            if edit == "I":
                self._insert()
                continue
            if edit == "K":
                self._put(role[0], role, text, edit)
            elif edit == "R":
                letter = self._next_role()
                self._put(letter, ROLES[letter], text, edit)
            return

    def _insert(self) -> None:
        letter = self._next_role()
        self._put(letter, ROLES[letter], "", "I")

    def finish(self) -> None:
        """Insertions after the last row."""
        for _ in self.edits:
            self._insert()


def _applied(placed: DataFrame, edits: DataFrame, sink, schema: str) -> DataFrame:
    """Rows and edits of each conversation, side by side in order, streamed through ``sink``."""
    both = placed.select("conv_id", "at", F.lit(1).alias("kind"), "role", "text").unionByName(
        edits.select("conv_id", "at", F.lit(0).alias("kind"), F.col("place").cast("string").alias("role"),
                     F.col("edits").alias("text")))

    def run(batches):
        current, writer, out = None, None, sink()
        for batch in batches:
            for key, kind, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4))):
                if writer is None or key != current:
                    if writer:
                        writer.finish()
                        out.end(current)
                    current, writer = key, _Writer(partial(out.line, key))
                if kind:
                    writer.row(role, text)
                else:
                    writer.chunk(int(role), text)
            yield from out.ready()
        if writer:
            writer.finish()
            out.end(current)
        yield from out.ready()

    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", "at", "kind")
    return ordered.mapInArrow(run, schema)


class _Digest:
    """SHA-256 of each conversation's lines; only the state of one hash is held."""

    def __init__(self):
        self.hash, self.first, self.found = hashlib.sha256(), True, []

    def line(self, key, role, text, edit):
        self.hash.update(("" if self.first else "\n").encode() + f"{role}:{text}".encode())
        self.first = False

    def end(self, key):
        self.found.append((key, self.hash.hexdigest()))
        self.hash, self.first = hashlib.sha256(), True

    def ready(self):
        found, self.found = self.found, []
        if found:
            keys, values = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(values)], ["conv_id", "repaired_sha256"])


class _Rows:
    """The repaired rows themselves."""

    def __init__(self):
        self.found, self.place = [], 0

    def line(self, key, role, text, edit):
        self.found.append((key, self.place, role, text, edit))
        self.place += 1

    def end(self, key):
        self.place = 0

    def ready(self):
        found, self.found = self.found, []
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in zip(*found)], ["conv_id", "place", "role", "text", "edit"])


def repair(rows: DataFrame) -> DataFrame:
    """Repaired conversations: (conv_id, place, role, text, edit) of every row that remains.

    ``rows`` (conv_id, turn, role, text) without null roles or texts; see the module for the rest.
    """
    placed = _placed(rows)
    kind = rows.schema["conv_id"].dataType.simpleString()
    return _applied(placed, _edits(_parsed(_coded(placed))), _Rows,
                    f"conv_id {kind}, place long, role string, text string, edit string")


def report(conversations: DataFrame) -> DataFrame:
    """One row per conversation with its faults, the least cost, the audit and a digest of the repair."""
    placed = _placed(damaged(conversations))
    coded = store(_coded(placed), "coded")
    kind = conversations.schema["conv_id"].dataType.simpleString()
    parsed = store(_parsed(coded), "parsed")
    digests = _applied(placed, _edits(parsed), _Digest, f"conv_id {kind}, repaired_sha256 string")

    wide = lambda c: F.col(c).cast("decimal(38,0)")
    turns = coded.select("conv_id", "turn").distinct().groupBy("conv_id").agg(
        (F.max(wide("turn")) - F.min(wide("turn")) + 1 - F.count("turn")).cast("long").alias("gaps"))
    faults = coded.groupBy("conv_id").agg(*[
        F.count_if(F.col("fault").eqNullSafe(f)).alias(f) for f in ("blank", "duplicate", "truncated")])
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    parts = conversations.select("conv_id").distinct()
    for part in (turns, faults, parsed.drop("path"), digests):
        parts = parts.unionByName(part, allowMissingColumns=True)
    return parts.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
