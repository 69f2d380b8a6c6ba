"""Gazette text to structured publications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactum import constants as K
from pactum.functions.dates import masthead, masthead_date
from pactum.functions.gazette import edition_number
from pactum.functions.ids import normalise_pid
from pactum.functions.names import split_parties
from pactum.functions.text import (
    MENTION,
    bind,
    first_mention,
    grab,
    has,
    match_start,
    mentions_marked,
    squeeze,
    strip,
    truthy,
)
from pactum.operators.rules import names_where
from pactum.operators.runs import skip_reason
from pactum.sources.adapter import dealt
from pactum.sources.stage_store import store

KEY = "processo_id"
FIELDS = [
    "processo_id_in_text", "publication_date", "signing_date_in_pub", "contract_number",
    "contratante", "contratada", "object_summary", "value", "edition", "document_type",
]


def window(text: Column, start: Column, back: int, forward: int) -> Column:
    """Characters around a 0-based offset, cut at the beginning of the text."""
    low = F.greatest(start - back, F.lit(0))
    return F.substring(text, low + 1, start + forward - low)


def has_trigger(block: Column) -> Column:
    """Does a trigger occur? It is first searched as it is mostly spelled, without folding case."""
    return F.rlike(block, F.lit(f"(?=[E1])(?:{K.BLOCK_TRIGGER})")) | has(block, K.BLOCK_TRIGGER, "i")


def anchored_start(text: Column, pid: Column) -> Column:
    """Offset of the first mention of the identifier that lies near a trigger, else -1.

    Mostly that is the first mention. Otherwise the text between mentions gives
    their offsets; one pass over the mentions stops testing at the first that
    qualifies.
    """
    def near(start: Column) -> Column:
        return bind(window(text, start, K.BLOCK_BACK_CHARS, K.BLOCK_FORWARD_CHARS), has_trigger)

    def step(acc: Column, piece: Column) -> Column:
        start = acc["pos"] + F.length(piece)
        return F.struct(
            (start + F.length(pid)).alias("pos"),
            F.when(acc["hit"] >= 0, acc["hit"]).when(near(start), start).otherwise(-1).alias("hit"),
        )

    def walk(pieces: Column) -> Column:
        before = F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0)))
        initial = F.struct(F.lit(0).alias("pos"), F.lit(-1).alias("hit"))
        return F.aggregate(before, initial, step, lambda acc: acc["hit"])

    any_mention = bind(F.split(mentions_marked(text, pid), MENTION), walk)
    return bind(first_mention(text, pid), lambda first: F.when(first < 0, -1).when(
        near(first), first).otherwise(any_mention))


def with_block(df: DataFrame, text: str, pid: str) -> DataFrame:
    """Add ``_block``: the extract that belongs to the identifier."""
    t = F.col(text)
    df = df.withColumn("_core", normalise_pid(F.col(pid)))
    df = df.withColumn("_hit", anchored_start(t, F.col("_core")))
    trigger = F.when(F.col("_hit") < 0, match_start(t, K.BLOCK_TRIGGER, "i"))
    df = df.withColumn("_trigger", trigger)
    block = (
        F.when(
            F.col("_hit") >= 0,
            window(t, F.col("_hit"), K.BLOCK_BACK_CHARS, K.BLOCK_FORWARD_CHARS))
        .when(
            F.col("_trigger").isNotNull(),
            window(t, F.col("_trigger"), K.TRIGGER_BACK_CHARS, K.TRIGGER_FORWARD_CHARS))
        .otherwise(t)
    )
    return df.withColumn("_block", block).drop("_core", "_hit", "_trigger")


def block_type(block: Column) -> Column:
    return (
        F.when(has(block, K.GAZETTE_TYPE_ADDENDUM, "i"), "addendum")
        .when(has(block, K.GAZETTE_TYPE_CONTRACT, "i"), "contract")
        .otherwise("unknown")
    )


def parse_gazette(df: DataFrame, text: str = "raw_text", pid: str = KEY) -> DataFrame:
    """Add ``parsed``: the fields of the publication, and ``missing:`` warnings.

    Labelled blocks and numbered blocks (``1-Objeto … 5-Valor``) differ in where
    parties, object and value stand; date and edition come from the masthead.
    A null text gives null fields.
    """
    df = with_block(df, text, pid)
    block, full = F.col("_block"), F.col(text)
    df = df.withColumns({"_numbered": has(block, K.NUMBERED_MARK, "i"), "_masthead": masthead(full)})
    numbered = F.col("_numbered")
    labelled_date, numbered_date = grab(block, K.GAZETTE_SIGNING), grab(block, K.NUMBERED_DATE, 1, "i")
    parties = F.when(numbered, squeeze(grab(block, K.NUMBERED_PARTIES, 1, "is"))).otherwise(
        strip(grab(block, K.LABELLED_PARTIES, 1, "i")))
    subject = F.when(numbered, grab(block, K.NUMBERED_OBJECT, 1, "is")).otherwise(
        grab(block, K.LABELLED_OBJECT, 1, "is"))
    df = df.withColumns(
        {
            "_pid": strip(grab(block, K.GAZETTE_PROCESSO, 1, "i")),
            "_signed": F.when(numbered, F.coalesce(numbered_date, labelled_date)).otherwise(
                F.coalesce(labelled_date, numbered_date)),
            "_parties": parties,
            "_published": masthead_date(full, F.col("_masthead")),
        }
    )
    df = df.withColumn("_split", split_parties(F.col("_parties")))
    hiring = F.when(F.col("_parties").isNotNull(), F.col("_split.contratante"))
    hired = F.when(F.col("_parties").isNotNull(), F.col("_split.contratada"))
    required = {
        "publication_date": F.col("_published"), "signing_date_in_pub": F.col("_signed"),
        "contratante": hiring, "contratada": hired,
    }
    parsed = F.struct(
        normalise_pid(F.coalesce(F.col("_pid"), F.col(pid))).alias("processo_id_in_text"),
        F.col("_published").alias("publication_date"),
        F.col("_signed").alias("signing_date_in_pub"),
        grab(block, K.GAZETTE_NUMBER, 1, "i").alias("contract_number"),
        hiring.alias("contratante"),
        hired.alias("contratada"),
        F.substring(squeeze(subject), 1, K.OBJECT_CHARS).alias("object_summary"),
        F.when(numbered, grab(block, K.NUMBERED_VALUE, 1, "i")).otherwise(
            grab(block, K.LABELLED_VALUE, 1, "i")).alias("value"),
        edition_number(full, F.col("_masthead")).alias("edition"),
        block_type(block).alias("document_type"),
        names_where([(f"missing:{n}", ~truthy(c)) for n, c in required.items()]).alias("warnings"),
    )
    return df.withColumn("parsed", parsed).drop(
        "_block", "_numbered", "_pid", "_signed", "_parties", "_published", "_split", "_masthead")


def with_date_fallback(df: DataFrame, meta_date: str) -> DataFrame:
    """Use the search result's date where the text has no masthead date."""
    date, given = F.col("parsed.publication_date"), F.col(meta_date)
    use = ~truthy(date) & truthy(given)
    return df.withColumn(
        "parsed",
        F.col("parsed")
        .withField("publication_date", F.when(use, given).otherwise(date))
        .withField(
            "warnings",
            F.when(use, F.array_append(
                F.col("parsed.warnings"), F.lit("publication_date:from_searcher_metadata")))
            .otherwise(F.col("parsed.warnings"))),
    )


def parsed_documents(docs: DataFrame) -> DataFrame:
    """Every stored document, parsed where usable; texts do not travel further."""
    gated = skip_reason(docs)
    usable = F.col("skip_reason").isNull()
    text = gated.withColumn("_text", F.when(usable, F.col("raw_text"))).drop("raw_text")
    return with_date_fallback(parse_gazette(text, "_text"), "meta_date").drop("_text")


def consolidate(parsed: DataFrame) -> DataFrame:
    """One structured publication per process, from its primary document.

    The primary is the first structured document, else the first usable one. A
    process without a usable document gives no row. Its other documents stay
    rows of `parsed_documents`, keyed by process and index.
    """
    return _publication(_primary(parsed, "document_index", "parsed"))


def primary_publications(docs: DataFrame) -> DataFrame:
    """`consolidate` of stored documents, of which only each process's primary one is parsed.

    The primary is known before any text is read; the others give counts only. Usable texts are
    dealt out before, in a stated number of parts, as adaptive execution would choose in few tasks.
    """
    usable = F.when(F.col("skip_reason").isNull(), F.col("raw_text")).alias("raw_text")
    rows = skip_reason(docs).select(KEY, "document_index", "content_hint", "meta_date", "skip_reason", usable)
    texts = _primary(rows.repartition(dealt(docs.sparkSession), KEY), "document_index", "meta_date", "raw_text").select(
        KEY, "_best.*", "documents_found", "documents_parsed")
    parsed = with_date_fallback(parse_gazette(texts, "raw_text"), "meta_date").drop("raw_text")
    # Stored, since every field taken out of the rows would otherwise repeat the parse.
    return _publication(store(parsed, "primary_documents").select(
        KEY, F.struct("document_index", "parsed").alias("_best"), "documents_found", "documents_parsed"))


def _primary(docs: DataFrame, *columns: str) -> DataFrame:
    """These columns of each process's primary document, as ``_best``, and the numbers of its documents."""
    usable = F.col("skip_reason").isNull()
    order = F.struct(
        (F.coalesce("content_hint", F.lit("unknown")) != K.HINT_STRUCTURED).alias("tier"),
        F.col("document_index"))
    best = F.min_by(F.struct(*columns), F.when(usable, order))
    return docs.groupBy(KEY).agg(
        best.alias("_best"), F.count("*").alias("documents_found"),
        F.count_if(usable).alias("documents_parsed")).where("documents_parsed > 0")


def _publication(primary: DataFrame) -> DataFrame:
    return primary.select(
        KEY,
        F.lit(K.SOURCE_GAZETTE).alias("source"),
        F.col("_best.document_index").alias("primary_index"),
        *[F.col(f"_best.parsed.{f}").alias(f) for f in FIELDS if f != "processo_id_in_text"],
        "documents_found", "documents_parsed",
    )


def publication_warnings(parsed: DataFrame) -> DataFrame:
    """Distinct warnings per process and where each first occurs: document, then place in it.

    Ordered by these two, a process's rows are its warnings in reading order.
    """
    listed = F.when(
        F.col("skip_reason").isNotNull(), F.array(F.col("skip_warning"))
    ).otherwise(F.col("parsed.warnings"))
    rows = parsed.select(KEY, "document_index", F.posexplode(listed).alias("_at", "warning"))
    return rows.groupBy(KEY, "warning").agg(
        F.min(F.struct("document_index", "_at")).alias("_first")
    ).select(KEY, "warning", F.col("_first.document_index").alias("first_document"),
             F.col("_first._at").alias("first_place"))


def prefer_embedded(gazette: DataFrame, embedded: DataFrame) -> DataFrame:
    """One publication per process; one found inside the contract wins."""
    both = gazette.unionByName(embedded, allowMissingColumns=True)
    rest = [c for c in both.columns if c != KEY]
    rank = F.when(F.col("source") == K.SOURCE_EMBEDDED, 0).otherwise(1)
    return both.groupBy(KEY).agg(F.min_by(F.struct(*rest), rank).alias("_p")).select(KEY, "_p.*")
