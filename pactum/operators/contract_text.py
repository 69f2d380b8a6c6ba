"""Contract text to structured rows."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactum import constants as K
from pactum.functions.dates import opening_date
from pactum.functions.names import clean_party
from pactum.functions.text import bind, drop, grab, has, jre, squeeze, strip, truthy
from pactum.operators.gazette_text import parse_gazette
from pactum.operators.rules import names_where

KEY = "processo_id"
MARK = "￿"  # a Unicode noncharacter, never part of a text
APPENDIX_HEADING = rf"^({'|'.join(re.escape(k) for k in K.APPENDIX_KEYWORDS)})"
DIGITS = r"[\p{Nd}¹²³⁰⁴-⁹₀-₉]"


def remove_noise(df: DataFrame, text: str, out: str = "clean_text") -> DataFrame:
    """Drop signatures, barcodes, page marks and letterheads; name what was dropped."""
    df = df.withColumn("_n0", F.col(text))
    for i, (pattern, flags, _) in enumerate(K.NOISE_PATTERNS):
        before = F.col(f"_n{i}")
        after, words = drop(before, pattern, flags), K.NOISE_WORDS.get(pattern)
        if words:
            held = reduce(or_, [F.contains(before, F.lit(w)) for w in words])
            after = F.when(held, after).otherwise(before)
        df = df.withColumn(f"_n{i + 1}", after)
    n = len(K.NOISE_PATTERNS)
    hits = [(category, F.col(f"_n{i}") != F.col(f"_n{i + 1}"))
            for i, (_, _, category) in enumerate(K.NOISE_PATTERNS)]
    return df.withColumns(
        {
            out: strip(F.regexp_replace(F.col(f"_n{n}"), r"\n{3,}", "\n\n")),
            "noise_removed": F.sort_array(F.array_distinct(names_where(hits))),
        }
    ).drop(*[f"_n{i}" for i in range(n + 1)])


def contract_type(text: Column) -> Column:
    zone = F.substring(text, 1, K.TYPE_ZONE_CHARS)
    return (
        F.when(has(zone, K.CONTRACT_TYPE_ADDENDUM, "i"), "addendum")
        .when(has(zone, K.CONTRACT_TYPE_CONTRACT, "i"), "contract")
        .otherwise("unknown")
    )


def parties_in_prose(text: Column, zone: Column) -> Column:
    """Both parties from an opening sentence; the first kind that occurs decides."""
    kinds = [(text, K.PROSE_OPENING_DATE, "is"), (text, K.PROSE_ONE_SIDE, "is"),
             (zone, K.PROSE_BETWEEN, "i")]
    found = None
    for where, pattern, flags in kinds:
        hiring = grab(where, pattern, 1, flags)
        pair = F.struct(
            clean_party(hiring).alias("contratante"),
            clean_party(grab(where, pattern, 2, flags)).alias("contratada"))
        found = F.when(hiring.isNotNull(), pair) if found is None else found.when(
            hiring.isNotNull(), pair)
    return found


def extract_header(df: DataFrame, text: str = "clean_text") -> DataFrame:
    """Add ``header``: number, identifier, signing date, parties and object."""
    t = F.col(text)
    df = df.withColumn("_zone", F.substring(t, 1, K.HEADER_ZONE_CHARS))
    zone = F.col("_zone")
    df = df.withColumns(
        {
            "_hiring": clean_party(grab(zone, K.HEADER_CONTRATANTE)),
            "_hired": clean_party(grab(zone, K.HEADER_CONTRATADA)),
        }
    )
    incomplete = ~truthy(F.col("_hiring")) | ~truthy(F.col("_hired"))
    df = df.withColumn("_prose", F.when(incomplete, parties_in_prose(t, zone)))

    def party(label: str, side: str) -> Column:
        given = F.col(label)
        return F.when(truthy(given), given).otherwise(F.coalesce(F.col(f"_prose.{side}"), given))

    header = F.struct(
        grab(t, K.HEADER_NUMBER).alias("contract_number"),
        strip(grab(t, K.HEADER_PROCESSO, 1, "i")).alias("processo_id_in_document"),
        F.coalesce(grab(zone, K.HEADER_DATE_LABEL), opening_date(zone)).alias("signing_date"),
        party("_hiring", "contratante").alias("contratante"),
        party("_hired", "contratada").alias("contratada"),
        F.substring(squeeze(grab(t, K.HEADER_OBJECT, 1, "is")), 1, K.OBJECT_CHARS).alias(
            "object_summary"),
    )
    return df.withColumn("header", header).drop("_zone", "_hiring", "_hired", "_prose")


def pieces_at(text: Column, heading: str, flags: str) -> Column:
    """The text before the first heading, then one piece per heading."""
    return F.split(F.regexp_replace(text, jre(heading, flags), f"{MARK}$0"), MARK)


def headed(pieces: Column) -> Column:
    return bind(pieces, lambda p: F.slice(p, F.lit(2), F.greatest(F.size(p) - 1, F.lit(0))))


def paragraphs(body: Column) -> Column:
    def one(piece: Column) -> Column:
        heading = strip(F.regexp_extract(piece, jre(K.PARAGRAPH_HEADING, "m"), 1))
        rest = F.substring(strip(piece), F.length(heading) + 1, F.length(piece))
        return F.struct(
            heading.alias("header"),
            F.regexp_replace(strip(rest), r"\A[–\-: \n]+", "").alias("content"))

    return F.transform(headed(pieces_at(body, K.PARAGRAPH_HEADING, "m")), one)


def segment_clauses(pieces: Column) -> Column:
    """Clauses with ordinal, title, text up to the first appendix, and paragraphs."""
    heading = jre(K.CLAUSE_HEADING, "mi")

    def cut(piece: Column) -> Column:
        rest = F.substring(piece, F.length(F.regexp_extract(piece, heading, 0)) + 1, F.length(piece))
        return F.struct(
            *[strip(F.regexp_extract(piece, heading, i)).alias(n)
              for i, n in ((2, "number"), (3, "title"), (1, "full_title"))],
            strip(drop(strip(rest), rf"{APPENDIX_HEADING}.*\z", "mis")).alias("content"),
        )

    return F.transform(
        F.transform(headed(pieces), cut),
        lambda c: F.struct(
            c["number"], c["title"], c["full_title"], c["content"],
            paragraphs(c["content"]).alias("paragraphs")))


def detect_appendices(pieces: Column) -> Column:
    """Appendices after the last clause heading; many digits make a table.

    The sample after a heading may run into the following appendices, each at
    least as long as its keyword, so a bounded number of them completes it.
    """
    following = K.APPENDIX_SAMPLE_CHARS // min(len(k) for k in K.APPENDIX_KEYWORDS) + 2

    def one(parts: Column, piece: Column, i: Column) -> Column:
        line = F.regexp_extract(piece, r"\A([^\n]*)\n", 1)
        ends = piece.contains("\n")
        header = strip(F.when(ends, line).otherwise(F.substring(piece, 1, 80)))
        skip = F.when(ends, F.length(line) + 1).otherwise(F.length(header))
        rest = F.array_join(F.slice(parts, i + 1, F.lit(following)), "")
        sample = F.substring(rest, skip + 1, F.lit(K.APPENDIX_SAMPLE_CHARS))
        digits = F.length(sample) - F.length(F.regexp_replace(sample, DIGITS, ""))
        dense = digits / F.greatest(F.length(sample), F.lit(1)) > K.APPENDIX_DIGIT_RATIO
        return F.struct(
            (i + 1).alias("index"), header.alias("header"),
            F.when(dense, "table").otherwise("text").alias("type"))

    found = headed(pieces_at(F.element_at(pieces, -1), APPENDIX_HEADING, "mi"))
    # Bound, as the text would be cut into parts anew for each of them.
    return bind(found, lambda parts: F.transform(parts, lambda piece, i: one(parts, piece, i)))


def with_structure(df: DataFrame, text: str = "clean_text") -> DataFrame:
    """Add nested ``clauses`` and ``appendices``."""
    df = df.withColumn("_pieces", pieces_at(F.col(text), K.CLAUSE_HEADING, "mi"))
    return df.withColumns(
        {
            "clauses": segment_clauses(F.col("_pieces")),
            "appendices": detect_appendices(F.col("_pieces")),
        }
    ).drop("_pieces")


def embedded_publication(df: DataFrame, text: str = "clean_text") -> DataFrame:
    """Add ``embedded_publication`` and ``embedded_parsed`` from a gazette extract
    inside the contract; only texts with a trigger are parsed."""
    t, given = F.col(text), F.col("_gazette").isNotNull()
    df = df.withColumn("_gazette", F.when(has(t, K.EMBEDDED_TRIGGER, "i"), t))
    df = parse_gazette(df.withColumn("_owner", F.when(given, F.col(KEY))), "_gazette", "_owner")
    parsed = F.col("parsed")
    date = F.coalesce(parsed["publication_date"], parsed["signing_date_in_pub"])
    found = F.col("_gazette").isNotNull() & truthy(date)
    block = F.struct(
        found.alias("found"),
        *[F.when(found, value).alias(name) for name, value in (
            ("processo_id_in_pub", parsed["processo_id_in_text"]), ("publication_date", date),
            ("edition", parsed["edition"]), ("contratante_pub", parsed["contratante"]),
            ("contratada_pub", parsed["contratada"]))],
    )
    return df.withColumns(
        {"embedded_publication": block, "embedded_parsed": F.when(found, parsed)}
    ).drop("_gazette", "_owner", "parsed")


def _cleaned(docs: DataFrame) -> DataFrame:
    return remove_noise(docs.where(truthy(F.col("raw_text"))), "raw_text").drop("raw_text")


def preprocess_contracts(docs: DataFrame) -> DataFrame:
    """Contract texts as structured rows; a bad text gives warnings, never an error."""
    df = _cleaned(docs)
    df = df.withColumn("document_type", contract_type(F.col("clean_text")))
    df = embedded_publication(with_structure(extract_header(df)))
    header = F.col("header")
    warnings = names_where(
        [(f"missing_header_field:{n}", ~truthy(header[n]))
         for n in ("signing_date", "contratante", "contratada")]
        + [("no_clauses_detected", F.size("clauses") == 0)])
    return df.withColumn("warnings", warnings).drop("clean_text")


def embedded_extracts(docs: DataFrame) -> DataFrame:
    """The extract found inside each contract text, for which its header and clauses are not read.

    Texts without one stay as rows: a filter on the cleaned text would be pushed below the dealing
    out of its source, and the few tasks that scan it would clean every text.
    """
    return embedded_publication(_cleaned(docs)).select(KEY, "embedded_publication", "embedded_parsed")


def embedded_as_publication(preprocessed: DataFrame) -> DataFrame:
    """Extracts found inside contracts, shaped as structured publications."""
    parsed = F.col("embedded_parsed")
    names = ["publication_date", "signing_date_in_pub", "contract_number", "contratante",
             "contratada", "object_summary", "value", "edition", "document_type"]
    return preprocessed.where("embedded_publication.found").select(
        KEY, F.lit(K.SOURCE_EMBEDDED).alias("source"), F.lit(1).cast("bigint").alias("primary_index"),
        *[parsed[n].alias(n) for n in names],
        F.lit(1).cast("bigint").alias("documents_found"),
        F.lit(1).cast("bigint").alias("documents_parsed"))
