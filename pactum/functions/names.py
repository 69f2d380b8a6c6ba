"""Party names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pactum import constants as K
from pactum.functions.text import drop, grab, squeeze, strip


def normalise_name(c: Column) -> Column:
    """Upper-case text with punctuation as blanks, for loose comparison."""
    return F.upper(squeeze(F.translate(c, ".,;:-/\\", " " * 7)))


def clean_party(c: Column) -> Column:
    """A party name without line breaks, trailing punctuation and legal tails."""
    name = F.regexp_replace(strip(c), rf"[{K.WS}]*\n[{K.WS}]*", " ")
    name = F.rtrim(strip(name), F.lit(".,;:-"))
    for tail in K.PARTY_TAILS:
        name = drop(name, tail, "i")
    return strip(name)


def split_parties(c: Column) -> Column:
    """``A e B`` to (contratante, contratada); no split gives (text, null)."""
    first, second = grab(c, K.PARTY_SPLIT, 1, "is"), grab(c, K.PARTY_SPLIT, 2, "is")

    def tidy(x: Column) -> Column:
        return F.rtrim(squeeze(x), F.lit(".,;"))

    return F.struct(
        F.when(first.isNotNull(), tidy(first)).otherwise(strip(c)).alias("contratante"),
        tidy(second).alias("contratada"),
    )
