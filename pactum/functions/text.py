"""Text helpers shared by every stage."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pactum import constants as K


def guarded(pattern: str) -> str:
    """The pattern behind a look at the next letter, where the letters a match can begin with are known.

    Its alternatives, slow where case folds, are then tried at few places.
    """
    letters = K.FIRST_LETTERS.get(pattern)
    return f"(?=[{letters}])(?:{pattern})" if letters else pattern


def jre(pattern: str, flags: str = "") -> str:
    """A pattern with Unicode-aware classes, and lines that end at ``\\n`` only.

    ``i`` turns on Unicode case folding, ``s`` dot-all, ``m`` multi-line.
    """
    return f"(?{flags}{'u' if 'i' in flags else ''}dU){guarded(pattern)}"


def inline(pattern: str, flags: str = "") -> str:
    """The same flags scoped to a group, for use inside a larger pattern."""
    return f"(?{flags}{'u' if 'i' in flags else ''}dU:{guarded(pattern)})"


def has(c: Column, pattern: str, flags: str = "") -> Column:
    return c.rlike(jre(pattern, flags))


def grab(c: Column, pattern: str, group: int = 1, flags: str = "") -> Column:
    """A capture group of the first match; null where nothing (or '') matched.

    The text is searched once: `nullif` would repeat the search inside branches.
    """
    found = F.array(F.regexp_extract(c, jre(pattern, flags), group))
    return F.get(F.array_remove(found, F.lit("")), F.lit(0))


def bind(c: Column, use) -> Column:
    """``use(c)`` with ``c`` computed once, also inside branches."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def drop(c: Column, pattern: str, flags: str = "") -> Column:
    return F.regexp_replace(c, jre(pattern, flags), "")


def strip(c: Column) -> Column:
    """Remove Unicode white space at both ends."""
    return F.btrim(c, F.lit(K.WS_CHARS))


def squeeze(c: Column) -> Column:
    """Collapse runs of white space to one blank and strip."""
    return F.trim(F.regexp_replace(F.translate(c, K.WS_CHARS, " " * len(K.WS_CHARS)), " {2,}", " "))


def truthy(c: Column) -> Column:
    """Neither null nor empty (never null itself)."""
    return F.coalesce(c != "", F.lit(False))


def filled(c: Column) -> Column:
    """The text itself, or null where it is empty."""
    return F.nullif(c, F.lit(""))


def text_or_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def quoted(c: Column) -> Column:
    """A value as a quoted literal, ``None`` for null; used in explanations."""
    body = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for raw, shown in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        body = F.replace(body, F.lit(raw), F.lit(shown))
    single = F.concat(F.lit("'"), F.replace(body, F.lit("'"), F.lit("\\'")), F.lit("'"))
    double = F.concat(F.lit('"'), body, F.lit('"'))
    use_double = c.contains("'") & ~c.contains('"')
    return F.when(c.isNull(), "None").when(use_double, double).otherwise(single)


def quoted_list(values: Column) -> Column:
    """An array of plain names as ``['a', 'b']``."""
    return F.concat(
        F.lit("["),
        F.array_join(F.transform(values, lambda v: F.concat(F.lit("'"), v, F.lit("'"))), ", "),
        F.lit("]"),
    )


def clean_text(c: Column) -> Column:
    return F.btrim(squeeze(c), F.lit(".-_"))


def word_count(c: Column) -> Column:
    """Runs without white space; printable ASCII is one range and is tried before the long class."""
    return F.when(truthy(c), F.regexp_count(c, F.lit(rf"(?:[!-~]++|[^{K.WS}])++"))).otherwise(F.lit(0))


def printable_chars(c: Column) -> Column:
    return F.length(F.regexp_replace(c, K.PRINTABLE_COMPLEMENT, ""))


def quality_flags(chars: Column, ratio: Column) -> Column:
    """Failed quality checks, from stripped length and printable ratio."""
    short = F.format_string(f"low_char_count:%d<{K.MIN_TEXT_CHARS}", chars)
    garbled = F.format_string(f"low_printable_ratio:%.2f<{K.MIN_PRINTABLE_RATIO}", ratio)
    return F.array_compact(
        F.array(
            F.when(chars < K.MIN_TEXT_CHARS, short),
            F.when(ratio < K.MIN_PRINTABLE_RATIO, garbled),
        )
    )


def match_start(c: Column, pattern: str, flags: str = "") -> Column:
    """0-based code-point offset of the first match, null where none.

    The first place of the matched words is the match itself, as long as the
    pattern looks neither back nor ahead; instr counts code points.
    """
    return bind(grab(c, pattern, 0, flags), lambda found: F.instr(c, found) - 1)


#: Stands for a mention of an identifier; a control character that texts do not use.
MENTION = "\x01"


def _plain(c: Column) -> Column:
    return F.when(F.contains(c, F.lit(MENTION)), F.replace(c, F.lit(MENTION), F.lit(" "))).otherwise(c)


def _folded(c: Column) -> Column:
    """In lower case, of unchanged length: the one letter whose lower case is longer becomes a plain one."""
    return F.lower(F.replace(c, F.lit("\u0130"), F.lit("I")))


def _in_either_case(text: Column, identifier: Column, use) -> Column:
    """``use`` of both in one case; an identifier without letters needs no folding."""
    cased = F.rlike(identifier, F.lit(r"[A-Za-z]|[^\x00-\x7f]"))
    text, identifier = _plain(text), _plain(identifier)
    return F.when(~cased, use(text, identifier)).otherwise(use(_folded(text), _folded(identifier)))


def mentions_marked(text: Column, identifier: Column) -> Column:
    """The text with each mention of the identifier, in either case, replaced by ``MENTION``.

    Everything else keeps its length, so the pieces between marks give the
    mentions' offsets; a constant pattern can then be used for every row. A text
    without the identifier, or an empty identifier, gives no mark.
    """
    return _in_either_case(text, identifier, lambda t, i: F.replace(t, i, F.lit(MENTION)))


def first_mention(text: Column, identifier: Column) -> Column:
    """0-based offset of the first of these mentions, -1 where none."""
    def before(t: Column, i: Column) -> Column:
        # A literal pattern is searched by leaps, unlike the places of a substring.
        quoted_ = F.concat(F.lit(r"\Q"), F.replace(i, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
        return bind(F.split(t, quoted_, 2), lambda p: F.when(F.size(p) > 1, F.length(F.get(p, F.lit(0)))).otherwise(-1))

    return F.when(identifier == "", -1).otherwise(_in_either_case(text, identifier, before))
