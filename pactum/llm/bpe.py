"""Byte-pair encoding and decoding with a pair occurrence index.

The distinct pieces of a slice of a partition are laid out as one array of
symbols. An index maps each pair that has a merge to all its positions. The
active ranks are applied in ascending order: every position of the pair is
merged at once and the pairs that arise beside it enter the index under their
own ranks. A merge can only create pairs of later ranks, so one ascending pass
yields what merging each piece on its own yields.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactum.llm.common import Memo, ragged_append, ragged_gather, text_slices

_MARKS = tuple(".,;:!?")
_GAP = regex.compile(r"(?<=\S)(?= \S)")


#: Larger slices than elsewhere: an active rank is applied once to all its places.
SLICE_CHARS = 12_000_000


class Vocabulary:
    """Merges, ids and special tokens of a byte-level vocabulary file."""

    def __init__(self, path: str):
        import public_tokenizers

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids = spec["model"]["vocab"]
        letters = _byte_letters()
        self.size = 1 + max([*ids.values(), *(t["id"] for t in spec["added_tokens"])])
        self.first = np.array([ids[letters[b]] for b in range(256)], np.int64)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" "))
                  for m in spec["model"]["merges"]]
        self.left = np.array([ids[a] for a, _ in merges], np.int64)
        self.right = np.array([ids[b] for _, b in merges], np.int64)
        self.merged = np.array([ids[a + b] for a, b in merges], np.int64)
        keys = self.left * self.size + self.right
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        byte_of = {c: b for b, c in letters.items()}
        self.bytes_of: list[bytes] = [b""] * self.size
        for token, i in ids.items():
            self.bytes_of[i] = bytes(byte_of[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.cut = regex.compile("(" + "|".join(
            regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")"
        ) if self.special else None
        self.pieces = regex.compile(public_tokenizers.PATTERN)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge ranks of pairs, -1 where there is none."""
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.order[at], -1)


def _byte_letters() -> dict[int, str]:
    """Byte-level letters: printable bytes stand for themselves, the rest follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in set(plain))
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class PairIndex:
    """Positions of each mergeable pair, by rank."""

    def __init__(self):
        self.lists: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []

    def add(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        keep = ranks >= 0
        ranks, positions = ranks[keep], positions[keep]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = np.flatnonzero(np.diff(ranks)) + 1
        starts = np.concatenate([[0], cuts])
        for rank, own in zip(ranks[starts].tolist(), np.split(positions, cuts)):
            if rank not in self.lists:
                self.lists[rank] = []
                heapq.heappush(self.active, rank)
            self.lists[rank].append(own)

    def pop(self) -> tuple[int, np.ndarray]:
        rank = heapq.heappop(self.active)
        found = self.lists.pop(rank)
        return rank, np.unique(np.concatenate(found)) if len(found) > 1 else found[0]


def merge_pieces(pieces: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all pieces as a ragged array: (ids, offsets)."""
    sizes = np.array([len(p) for p in pieces], np.int64)
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    symbol = vocab.first[np.frombuffer(b"".join(pieces), np.uint8)]
    after = np.arange(1, total + 1)
    before = np.arange(-1, total - 1)
    after[ends[sizes > 0] - 1] = -1
    before[(ends - sizes)[sizes > 0]] = -1
    alive = np.ones(total, bool)

    index = PairIndex()
    heads = np.flatnonzero(after >= 0)
    index.add(vocab.ranks(symbol[heads], symbol[after[heads]]), heads)
    while index.active:
        rank, at = index.pop()
        left, right = vocab.left[rank], vocab.right[rank]
        follow = after[at]
        at = at[alive[at] & (follow >= 0) & (symbol[at] == left) & (symbol[follow] == right)]
        if left == right and len(at) > 1:
            at = _every_other(at, after)
        if not len(at):
            continue
        gone = after[at]
        symbol[at] = vocab.merged[rank]
        alive[gone] = False
        beyond = after[gone]
        after[at] = beyond
        has = beyond >= 0
        before[beyond[has]] = at[has]
        head = before[at]
        head = head[head >= 0]
        tail = at[has]
        heads = np.concatenate([head, tail])
        index.add(vocab.ranks(symbol[heads], symbol[after[heads]]), heads)
    running = np.concatenate([[0], np.cumsum(alive)])
    return symbol[alive], running[np.concatenate([[0], ends])]


def _every_other(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of positions that overlap in a run of equal symbols, the first, third, fifth ..."""
    joined = np.concatenate([[False], at[1:] == after[at[:-1]]])
    starts = np.flatnonzero(~joined)
    place = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
    return at[place % 2 == 0]


class Encoder:
    """Encodes texts; the ids of units seen before are remembered.

    A unit starts before a single blank between two words, a place that no piece
    of the vocabulary's pattern ever spans, so units are encoded independently.
    Inner units are held without that blank.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.vocab = Vocabulary(path)
        self.splitter = Tokenizer.from_file(path).pre_tokenizer
        self.memo = Memo(self._extend, self._clear)
        self._clear()

    def _clear(self):
        self.ids, self.offsets = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def _pieces(self, unit: str) -> list[str]:
        """Letters and digits beyond the old blocks depend on the Unicode release: ask the library."""
        if unit.isascii() or max(unit) < "\u0500":
            if unit[1:].isalpha() and unit[0] == " ":
                return [unit]
            if unit[-1:] in _MARKS and unit[1:-1].isalpha() and unit[0] == " ":
                return [unit[:-1], unit[-1]]
            return self.vocab.pieces.findall(unit)
        return [unit[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(unit)]

    def _extend(self, units: list):
        pieces: dict[str, int] = {}
        inside: list[int] = []
        sizes = np.zeros(len(units) + 1, np.int64)
        for i, unit in enumerate(units):
            own = self._pieces(" " + unit if isinstance(unit, str) else unit[0])
            sizes[i + 1] = len(own)
            inside += [pieces.setdefault(p, len(pieces)) for p in own]
        ids, offsets = merge_pieces([p.encode() for p in pieces], self.vocab)
        ids, lengths = ragged_gather(ids, offsets, np.array(inside, np.int64))
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(sizes)]
        self.ids, self.offsets = ragged_append(self.ids, self.offsets, ids, ends)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of texts as a ragged array: (ids, offsets)."""
        vocab = self.vocab
        units: list = []
        counts = np.zeros(len(texts) + 1, np.int64)
        marks: list[tuple[int, int]] = []
        for i, text in enumerate(texts):
            had = len(units)
            if vocab.special and any(t in text for t in vocab.special):
                for part in vocab.cut.split(text):
                    if part in vocab.special:
                        marks.append((len(units), vocab.special[part]))
                        units.append(("",))
                    elif part:
                        _add_units(part, units)
            elif text:
                _add_units(text, units)
            counts[i + 1] = len(units) - had
        codes = self.memo.codes(units)  # first: it extends the arrays
        ids, lengths = ragged_gather(self.ids, self.offsets, codes)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        for at, special in reversed(marks):
            ids = np.insert(ids, ends[at], special)
            ends[at + 1:] += 1
        return ids, ends[np.cumsum(counts)]


def _add_units(text: str, units: list) -> None:
    """Append the first unit as a tuple of its text, the others without their blank."""
    if len(text.split()) == text.count(" ") + text.count("\n") + 1:
        first, *rest = text.split(" ")
        units.append((first,))
        units += rest
    else:
        first, *rest = _GAP.split(text)
        units.append((first,))
        units += [u[1:] for u in rest]


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def decode(ids: np.ndarray, vocab: Vocabulary) -> str:
    return b"".join(map(vocab.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


def _over_texts(docs: DataFrame, text: str, carry: list[str], extra: dict, work) -> DataFrame:
    kept = docs.select(*carry, F.col(text).cast("string").alias("_text"))
    schema = kept.select(
        *carry, *[F.lit(None).cast(t).alias(n) for n, (t, _) in extra.items()]).schema

    def run(batches):
        for part, texts in text_slices(batches, "_text", SLICE_CHARS):
            made = [pa.array(c, t) for c, (_, t) in zip(work(texts), extra.values())]
            yield pa.RecordBatch.from_arrays(
                [part.column(i) for i in range(len(carry))] + made, names=schema.names)

    return kept.mapInArrow(run, schema)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encode_texts(docs: DataFrame, text: str = "text", path: str | None = None,
                 carry: list[str] | None = None) -> DataFrame:
    """Add ``ids`` (array of int) to the carried columns; a null or empty text has no ids.

    Rows are independent of each other, so null or repeated ids and ties need no
    rule. ``path`` must name the same vocabulary file on every machine.
    """
    path = path or default_vocabulary()
    carry = [c for c in docs.columns if c not in (text, "ids")] if carry is None else carry

    def work(texts):
        ids, ends = encoder(path).encode(texts)
        return [[ids[a:b] for a, b in zip(ends[:-1], ends[1:])]]

    return _over_texts(docs, text, carry, {"ids": ("array<int>", pa.list_(pa.int32()))}, work)


def decode_ids(rows: DataFrame, ids: str = "ids", path: str | None = None) -> DataFrame:
    """Replace ``ids`` by the decoded ``text``; null ids decode to an empty text.

    An id that the vocabulary lacks is an error of the input and raises.
    """
    path = path or default_vocabulary()
    carry = [c for c in rows.columns if c not in (ids, "text")]
    kept = rows.select(*carry, F.col(ids).alias("_ids"))
    schema = kept.select(*carry, F.lit("").cast("string").alias("text")).schema

    def run(batches):
        vocab = encoder(path).vocab
        for batch in batches:
            texts = [decode(np.array(v or [], np.int64), vocab)
                     for v in batch.column("_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(carry))] + [pa.array(texts, pa.string())],
                names=schema.names)

    return kept.mapInArrow(run, schema)


def round_trip_digest(docs: DataFrame, text: str = "text", path: str | None = None,
                      carry: list[str] | None = None) -> DataFrame:
    """Encode, then decode the ids, in one pass; keep the token count and a digest of either side."""
    path = path or default_vocabulary()
    carry = [c for c in docs.columns if c != text] if carry is None else carry

    def work(texts):
        vocab = encoder(path).vocab
        ids, ends = encoder(path).encode(texts)
        counts, encoded, decoded = [], [], []
        for first, last in zip(ends[:-1], ends[1:]):
            own = ids[first:last]
            counts.append(len(own))
            encoded.append(hashlib.sha256(own.astype("<u4").tobytes()).hexdigest())
            decoded.append(hashlib.sha256(decode(own, vocab).encode()).hexdigest())
        return counts, encoded, decoded

    extra = {"n_tokens": ("long", pa.int64()), "ids_sha256": ("string", pa.string()),
             "decoded_sha256": ("string", pa.string())}
    return _over_texts(docs, text, carry, extra, work)
