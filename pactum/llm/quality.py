"""Quality rules: base counts of a text and its fertility under public vocabularies.

Fertility says how well a vocabulary knows a text: characters per token, the
share of tokens that fall back to single bytes, and the entropy of the text's
tokens. Mojibake, encoded blobs and noise cost many tokens per character and
many byte fallbacks; loops of few tokens have a low entropy. A text is rejected
when a measure leaves the band of its language, or of its script where the
language has no band of its own.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactum.llm.common import Memo, ragged_append, ragged_gather, released, text_slices

SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
#: Memory of a worker: words remembered, and characters of text handled at once.
KEEP_WORDS, SLICE_CHARS = 150_000, 1_000_000

#: First code point of each script block, in ascending order; what lies between counts as "other".
SCRIPTS = [
    (0x00, "other"), (0x41, "latin"), (0x5B, "other"), (0x61, "latin"), (0x7B, "other"),
    (0xC0, "latin"), (0x250, "other"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "other"),
    (0x590, "hebrew"), (0x600, "arabic"), (0x700, "other"), (0x900, "devanagari"),
    (0x980, "other"), (0xE00, "thai"), (0xE80, "other"), (0x1E00, "latin"), (0x1F00, "greek"),
    (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"),
    (0xAC00, "hangul"), (0xD7B0, "other"),
]
SCRIPT_STARTS = np.array([s for s, _ in SCRIPTS])
SCRIPT_NAMES = sorted({n for _, n in SCRIPTS})
SCRIPT_OF_BLOCK = np.array([SCRIPT_NAMES.index(n) for _, n in SCRIPTS])


@dataclass(frozen=True)
class Band:
    """Accepted range of the fertility measures."""

    min_piece_chars: float = 0.9
    max_piece_chars: float = 9.0
    min_byte_chars: float = 0.8
    max_fallback: float = 0.10
    min_entropy: float = 3.0


#: The languages' lower bounds lie between prose, which has at least 1.8 to 2.1 characters per token
#: of the byte vocabulary, and shouted or symbol-ridden text, which has at most 1.5 to 1.8.
#: By language; "*name" is the band of a script, "*" that of everything else. A
#: script whose letters a vocabulary mostly lacks falls back by nature.
BANDS = {
    "en": Band(min_piece_chars=1.3, min_byte_chars=1.85),
    "de": Band(min_piece_chars=1.3, min_byte_chars=1.85),
    "fr": Band(min_piece_chars=1.2, min_byte_chars=1.7),
    "es": Band(min_piece_chars=1.2, min_byte_chars=1.72),
    "*latin": Band(min_piece_chars=1.1, min_byte_chars=1.0),
    "*cyrillic": Band(min_piece_chars=1.1, min_byte_chars=0.5, max_fallback=0.2),
    "*greek": Band(min_piece_chars=0.7, min_byte_chars=0.4, max_fallback=0.4),
    "*han": Band(min_piece_chars=0.25, min_byte_chars=0.25, max_fallback=0.95),
    "*kana": Band(min_piece_chars=0.3, min_byte_chars=0.25, max_fallback=0.9),
    "*hangul": Band(min_piece_chars=0.25, min_byte_chars=0.25, max_fallback=0.98),
    "*": Band(min_piece_chars=0.3, min_byte_chars=0.25, max_fallback=0.98),
}

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, script string, piece_chars double, byte_chars double, "
    "fallback_share double, token_entropy double"
)


@dataclass(frozen=True)
class Vocabularies:
    """Files of the two public vocabularies; None finds them in the installed package."""

    pieces: str | None = None
    bytes_: str | None = None

    def paths(self) -> tuple[str, str]:
        import public_tokenizers

        return (self.pieces or public_tokenizers.path("piece_bpe_32k.model"),
                self.bytes_ or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@lru_cache(maxsize=2)
def _load(paths: tuple[str, str]):
    import base64

    import public_tokenizers
    import sentencepiece
    import tiktoken

    pieces = sentencepiece.SentencePieceProcessor(model_file=paths[0])
    with open(paths[1], "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                              special_tokens={})
    fallback = np.array([pieces.is_byte(i) for i in range(pieces.get_piece_size())])
    return pieces, plain, fallback


class _Words:
    """Token ids, token counts and scripts of the words seen so far."""

    def __init__(self, paths):
        self.pieces, self.plain, self.fallback = _load(paths)
        self.memo = Memo(self._extend, self._clear, KEEP_WORDS)
        self._clear()

    def _clear(self):
        self.ids, self.offsets = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.plain_counts, self.scripts = np.zeros(0, np.int32), np.zeros(0, np.int8)

    def _extend(self, words: list[bytes]):
        texts = [w.decode() for w in words]
        ids = self.pieces.encode(texts, num_threads=1)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        flat = np.fromiter(chain.from_iterable(ids), np.int32, offsets[-1])
        self.ids, self.offsets = ragged_append(self.ids, self.offsets, flat, offsets)
        counts = [len(self.plain.encode_ordinary(" " + t)) for t in texts]
        first = np.fromiter((ord(t[0]) for t in texts), np.int64, len(texts))
        script = SCRIPT_OF_BLOCK[np.searchsorted(SCRIPT_STARTS, first, "right") - 1]
        self.plain_counts = np.append(self.plain_counts, np.array(counts, np.int32))
        self.scripts = np.append(self.scripts, script.astype(np.int8))


def repeated_words(codes: np.ndarray, size: int) -> int:
    """Words that lie in a 3-word window found twice or more."""
    if len(codes) < 4:
        return 0
    if size < 1 << 21:
        keys = (codes[:-2] * size + codes[1:-1]) * size + codes[2:]
    else:
        pairs = np.unique(codes[:-2] * size + codes[1:-1], return_inverse=True)[1]
        keys = pairs * size + codes[2:]
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    if not same.any():
        return 0
    hit = np.zeros(len(keys), bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    covered = np.zeros(len(codes), bool)
    covered[:-2] |= hit
    covered[1:-1] |= hit
    covered[2:] |= hit
    return int(covered.sum())


def _measure(texts, langs, words: _Words, bands):
    split = [t.encode().split() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in split])]).astype(np.int64)
    codes = words.memo.codes(list(chain.from_iterable(split)))
    ids, sizes = ragged_gather(words.ids, words.offsets, codes)
    id_ends = np.concatenate([[0], np.cumsum(sizes)])[offsets]
    fallback, plain, script = words.fallback[ids], words.plain_counts[codes], words.scripts[codes]
    rows = []
    for i, (text, lang) in enumerate(zip(texts, langs)):
        own = codes[offsets[i]:offsets[i + 1]]
        n = len(own)
        chars = len(text) - sum(map(text.count, SPACES))
        lines = [x for x in text.split("\n") if x.strip(SPACES)]
        repeats = repeated_words(own, len(words.memo.code))
        failed = n < MIN_WORDS or 100 * repeats > 50 * n
        row = [n, chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeats,
               failed]
        if not n:
            rows.append((*row, False, None, None, None, None, None))
            continue
        first, last = offsets[i], offsets[i + 1]
        tokens = slice(id_ends[i], id_ends[i + 1])
        total = id_ends[i + 1] - id_ends[i]
        counts = np.bincount(ids[tokens])
        counts = counts[counts > 0]
        share = float(fallback[tokens].mean())
        entropy = float(np.log2(total) - (counts * np.log2(counts)).sum() / total)
        name = SCRIPT_NAMES[int(np.bincount(script[first:last]).argmax())]
        by_piece, by_plain = chars / int(total), chars / int(plain[first:last].sum())
        band = bands.get(lang) or bands.get(f"*{name}") or bands["*"]
        fits = (
            band.min_piece_chars <= by_piece <= band.max_piece_chars
            and by_plain >= band.min_byte_chars
            and share <= band.max_fallback
            and entropy >= band.min_entropy
        )
        rows.append((*row, not failed and fits, name, by_piece, by_plain, share, entropy))
    return rows


def quality(
    docs: DataFrame, text: str = "text", lang: str | None = "lang",
    vocabularies: Vocabularies = Vocabularies(), bands: dict[str, Band] = BANDS,
    carry: list[str] | None = None,
) -> DataFrame:
    """Measure and judge every row; ``carry`` names the columns that are kept beside the measures.

    A null or empty text has no words: its counts are 0, its measures null, it
    fails. A null or unknown language takes the band of the text's script. Each
    row stands for itself, so ids may be null or repeat and no row meets another.
    Input columns named like a measure are replaced by it.
    """
    measures = [f.strip().rsplit(" ", 1) for f in SCHEMA.split(",")]
    names = {text, *(n for n, _ in measures)}
    carry = [c for c in docs.columns if c not in names] if carry is None else carry
    paths = vocabularies.paths()
    kept = docs.select(*carry, F.col(text).cast("string").alias("_text"),
                       (F.col(lang).cast("string") if lang in docs.columns else F.lit(None).cast(
                           "string")).alias("_lang"))
    schema = kept.select(*carry, *[F.lit(None).cast(t).alias(n) for n, t in measures]).schema
    types = [{"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(),
              "double": pa.float64()}[t] for _, t in measures]

    def run(batches):
        words = _Words(paths)  # of this task alone: an idle worker holds no words
        for part, texts in text_slices(batches, "_text", SLICE_CHARS):
            rows = _measure(texts, part.column("_lang").to_pylist(), words, bands)
            found = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
            yield pa.RecordBatch.from_arrays(
                [part.column(i) for i in range(len(carry))] + found, names=schema.names)

    return kept.mapInArrow(released(run), schema)


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The rows that pass, with their own columns."""
    inner = docs.select(F.struct(*docs.columns).alias("row"), F.col("text"), (
        F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")).alias("lang"))
    return quality(inner, carry=["row"], **options).where("kept").select("row.*")
