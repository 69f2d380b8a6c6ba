"""Fields of gazette search results and mastheads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pactum import constants as K
from pactum.functions.dates import masthead
from pactum.functions.text import MENTION, bind, grab, has, mentions_marked, text_or_blank


def classify_content(snippet: Column, pid: Column) -> Column:
    """Structured block of *this* identifier, an approval act, or unknown."""
    anchored = rf"Processo\s+{MENTION}\s+1-Objeto:.*?2-Partes:"
    return (
        F.when(has(mentions_marked(snippet, pid), anchored, "is"), K.HINT_STRUCTURED)
        .when(has(snippet, K.ADDENDUM_WORDS, "i"), K.HINT_ADDENDUM)
        .otherwise(K.HINT_UNKNOWN)
    )


def publication_metadata(text: Column) -> Column:
    names = ["publication_date", "edition_number", "page_number"]
    return F.struct(
        *[
            text_or_blank(grab(text, K.PUB_METADATA, i, "i")).alias(name)
            for i, name in enumerate(names, 1)
        ]
    )


def edition_number(text: Column, found: Column | None = None) -> Column:
    """Edition near the first masthead; without a masthead there is none."""
    def edition(words: Column) -> Column:
        # The first place of the matched words is the first match itself.
        zone = F.substr(text, F.instr(text, words), F.lit(K.EDITION_ZONE_CHARS))
        return bind(zone, lambda z: F.coalesce(grab(z, K.EDITION, 1), grab(z, K.EDITION, 2)))

    return bind(masthead(text) if found is None else found, edition)


def contains_id(text: Column, pid: Column) -> Column:
    """Does the text hold the identifier, whatever the case?"""
    return F.contains(F.lower(text_or_blank(text)), F.lower(pid))


def matched_variation(text: Column, variations: Column) -> Column:
    """The first spelling that occurs in the text, '' if none does."""
    low = F.lower(text_or_blank(text))
    hits = F.filter(variations, lambda v: F.contains(low, F.lower(v)) & (v != ""))
    return F.coalesce(F.try_element_at(hits, F.lit(1)), F.lit(""))
