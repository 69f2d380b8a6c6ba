"""Brazilian money text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pactum import constants as K
from pactum.functions.text import grab, squeeze, strip

_DIGITS = r"\d+(?:_\d+)*"
_NUMBER = rf"\A[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?\z"
_SPECIAL = r"(?i)\A[+-]?(?:inf|infinity|nan)\z"


def parse_brl(c: Column) -> Column:
    """``R$ 1.234,56`` or plain number text to a double; null when not a number."""
    bare = F.replace(F.replace(strip(c), F.lit("R$"), F.lit("")), F.lit(" "), F.lit(""))
    comma = F.replace(F.replace(bare, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    number = strip(F.when(bare.contains(","), comma).otherwise(bare))
    ok = number.rlike(_NUMBER) | number.rlike(_SPECIAL)
    return F.when(ok, F.replace(number, F.lit("_"), F.lit("")).try_cast("double"))


def find_currency(c: Column) -> Column:
    marked = squeeze(grab(c, K.CURRENCY_MARKED, 0))
    bare = grab(c, K.CURRENCY_BARE, 0)
    return F.coalesce(marked, F.concat(F.lit("R$ "), bare))
