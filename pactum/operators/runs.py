"""Run log, work selection, failures and tallies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactum import constants as K
from pactum.functions.gazette import contains_id
from pactum.functions.text import (
    filled,
    printable_chars,
    quality_flags,
    strip,
    text_or_blank,
    truthy,
    word_count,
)
from pactum.operators.ranking import pick_first

KEY = "processo_id"


# -- work selection -----------------------------------------------------------------
def seen_outcomes(log: DataFrame, stage: str, *outcomes: str) -> DataFrame:
    """One row per process of a stage with a flag per outcome ever logged."""
    return (
        log.where(F.col("stage") == stage)
        .groupBy(KEY)
        .agg(*[F.max(F.col("outcome") == o).alias(f"was_{o}") for o in outcomes])
    )


def skip_decisions(
    pids: DataFrame, log: DataFrame, embedded: DataFrame, extracted: DataFrame, force: bool = False
) -> DataFrame:
    """Why each process is skipped by the gazette search, or that it is processed."""
    seen = seen_outcomes(log, "stage3", "completed", "partial")
    flagged = (
        pids.select(KEY).distinct()
        .join(embedded.select(KEY).distinct().withColumn("is_embedded", F.lit(True)), KEY, "left")
        .join(seen, KEY, "left")
        .join(extracted.select(KEY).distinct().withColumn("is_extracted", F.lit(True)), KEY, "left")
    )
    held = F.lit(not force)
    decision = (
        F.when(F.col("is_embedded"), "embedded")
        .when(held & F.col("was_completed") & F.col("is_extracted"), "completed")
        .when(held & F.col("was_partial"), "partial")
        .otherwise("process")
    )
    return flagged.select(KEY, decision.alias("decision"))


def pending(pids: DataFrame, log: DataFrame, stage: str, rerun_failed: bool = False) -> DataFrame:
    """Processes still to do; ``rerun_failed`` re-admits completed ones that failed before."""
    seen = seen_outcomes(log, stage, "completed", "failed")
    done = F.coalesce("was_completed", F.lit(False))
    again = F.lit(rerun_failed) & F.coalesce("was_failed", F.lit(False))
    return pids.select(KEY).distinct().join(seen, KEY, "left").where(~done | again).select(KEY)


def extraction_pending(pids: DataFrame, log: DataFrame, extracted: DataFrame) -> DataFrame:
    """Neither completed nor already holding a raw document."""
    done = log.where((F.col("stage") == "stage2") & (F.col("outcome") == "completed"))
    finished = done.select(KEY).unionByName(extracted.select(KEY))
    return pids.select(KEY).distinct().join(finished, KEY, "left_anti")


# -- stored records -------------------------------------------------------------------
def with_quality(df: DataFrame, text: str) -> DataFrame:
    """Add total_chars, printable_ratio, quality_passes and quality_flags of a text."""
    t = F.col(text)
    df = df.withColumns(
        {"total_chars": F.length(strip(t)), "_ratio": F.try_divide(printable_chars(t), F.length(t))})
    ratio = F.when(F.col("total_chars") > 0, F.col("_ratio")).otherwise(0.0)
    df = df.withColumn("quality_flags", quality_flags(F.col("total_chars"), ratio))
    return df.withColumns(
        {
            "printable_ratio": F.round(ratio, 3),
            "quality_passes": F.size("quality_flags") == 0,
        }
    ).drop("_ratio")


def publication_records(hits: DataFrame, texts: DataFrame) -> DataFrame:
    """Search hits with their extracted text; missing texts leave a stub."""
    found = texts.select(
        KEY, "document_index", F.lit(True).alias("_got"), "raw_text", "extraction_error",
        "quality_passes")
    joined = hits.join(found, [KEY, "document_index"], "left")
    text = text_or_blank(F.col("raw_text"))
    return joined.select(
        *[F.col(c) for c in hits.columns],
        text.alias("raw_text"),
        F.length(text).alias("text_length"),
        F.coalesce("quality_passes", F.lit(False)).alias("quality_passes"),
        F.when(F.col("_got").isNull(), F.array(F.lit("download_failed")))
        .otherwise(F.array().cast("array<string>")).alias("quality_flags"),
        F.when(F.col("_got").isNull(), "PDF download failed")
        .otherwise(F.col("extraction_error")).alias("extraction_error"),
        (truthy(text) & contains_id(text, F.col(KEY))).alias("processo_found_in_text"),
    )


def contract_records(links: DataFrame, texts: DataFrame) -> DataFrame:
    """Links with their extracted contract text and its measures.

    A text is measured once, not once a link, and where only measures are read
    the join moves and sorts no text.
    """
    method = F.coalesce("extraction_method", F.lit("unknown"))
    measured = with_quality(texts, "raw_text").withColumns(
        {
            "extraction_method": method,
            "fallback_used": F.coalesce("extraction_method", F.lit("pymupdf")) != "pymupdf",
            "total_words": word_count(F.col("raw_text")),
        }
    )
    return links.join(measured, KEY)


def choose_extraction(candidates: DataFrame) -> DataFrame:
    """The text to keep per document: good digital layer, else column OCR, else none.

    A poor digital layer is dropped, a poor OCR text is kept.
    """
    ranked = with_quality(candidates.where(F.col("text").isNotNull()), "text")
    usable = ranked.where(
        (F.col("source") == "ocr_columns")
        | ((F.col("source") == "digital") & F.col("quality_passes")))
    best = pick_first(
        usable, ["doc_id"], F.when(F.col("source") == "digital", 0).otherwise(1))
    docs = candidates.select("doc_id").distinct()
    return docs.join(best, "doc_id", "left").select(
        "doc_id",
        F.col("source").isNotNull().alias("success"),
        F.coalesce("source", F.lit("failed")).alias("source"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("total_chars", F.lit(0)).alias("total_chars"),
        F.coalesce("quality_passes", F.lit(False)).alias("quality_passes"),
        F.coalesce("quality_flags", F.array().cast("array<string>")).alias("quality_flags"),
    )


def no_document(text):
    """A page that says it has no document; the messages are case-sensitive."""
    flag = F.lit(False)
    for message in K.NO_DOCUMENT_MESSAGES:
        flag = flag | F.coalesce(F.contains(text, F.lit(message)), F.lit(False))
    return flag


def skip_reason(docs: DataFrame) -> DataFrame:
    """Add why a publication record is unusable, null for usable ones."""
    ok = F.coalesce("quality_passes", F.lit(False))
    reason = F.when(
        ~ok, F.coalesce(filled(F.col("extraction_error")), F.lit("quality_failed"))
    ).when(~truthy(F.col("raw_text")), "empty_raw_text")
    return docs.withColumn("skip_reason", reason).withColumn(
        "skip_warning",
        F.when(
            F.col("skip_reason").isNotNull(),
            F.concat(F.lit("document_"), F.col("document_index").cast("string"),
                     F.lit("_skipped:"), F.col("skip_reason")),
        ),
    )


def best_raw_publication(docs: DataFrame) -> DataFrame:
    """The text to cross-check: structured and good, else good, else the first."""
    ok = F.coalesce("quality_passes", F.lit(False))
    tier = (
        F.when(ok & (F.col("content_hint") == K.HINT_STRUCTURED), 0).when(ok, 1).otherwise(2))
    rows = docs.select(KEY, "document_index", filled(F.col("raw_text")).alias("raw_text"),
                       tier.alias("tier"))
    return pick_first(rows, [KEY], F.struct("tier", "document_index"))


# -- parts of one contract -----------------------------------------------------------------
def merge_parts(parts: DataFrame) -> DataFrame:
    """Successful parts of a contract joined in order: one row per contract.

    A contract is one document, so its parts meet in one row, as its text does.
    """
    ordered = F.sort_array(F.collect_list(F.struct("part", "text")))
    return parts.where("success").groupBy(KEY).agg(ordered.alias("_parts")).select(
        KEY,
        F.array_join(F.transform("_parts", lambda p: p["text"]), K.PART_SEPARATOR).alias("text"))


def merged_measures(parts: DataFrame) -> DataFrame:
    """Pages, size and text quality of the merged text, without building it."""
    gap = len(K.PART_SEPARATOR)
    text = F.col("text")
    lead = F.length(text) - F.length(F.regexp_replace(text, rf"\A[{K.WS}]+", ""))
    tail = F.length(text) - F.length(F.regexp_replace(text, rf"[{K.WS}]+\z", ""))
    ok = F.col("success")
    rows = parts.withColumns(
        {
            "_len": F.length(text),
            "_print": printable_chars(text),
            "_edge": F.struct(lead.alias("lead"), tail.alias("tail"), F.length(text).alias("len")),
        }
    )
    merged = rows.groupBy(KEY).agg(
        F.count_if(ok).alias("_m"),
        F.sum(F.when(ok, F.col("pages"))).alias("page_count"),
        F.sum("pdf_size_bytes").alias("pdf_size_bytes"),
        F.sum(F.when(ok, F.col("_len"))).alias("_chars"),
        F.sum(F.when(ok, F.col("_print"))).alias("_print"),
        F.min_by("_edge", F.when(ok, F.col("part"))).alias("_first"),
        F.max_by("_edge", F.when(ok, F.col("part"))).alias("_last"),
    ).where("_m > 0")
    first, last, several = F.col("_first"), F.col("_last"), F.col("_m") > 1
    glue = (F.col("_m") - 1) * gap
    # A blank first or last part lets the strip reach the separator's two line breaks.
    head = first["lead"] + F.when(several & (first["lead"] == first["len"]), 2).otherwise(0)
    foot = last["tail"] + F.when(several & (last["tail"] == last["len"]), 2).otherwise(0)
    single_blank = ~several & (first["lead"] == first["len"])
    total = F.when(single_blank, 0).otherwise(F.col("_chars") + glue - head - foot)
    ratio = F.when(total > 0, F.try_divide(F.col("_print") + glue, F.col("_chars") + glue)).otherwise(0.0)
    return merged.withColumns({"total_chars": total, "_ratio": ratio}).select(
        KEY, "page_count", "pdf_size_bytes", "total_chars",
        F.round("_ratio", 3).alias("printable_ratio"),
        quality_flags(F.col("total_chars"), F.col("_ratio")).alias("quality_flags"),
        (F.size(quality_flags(F.col("total_chars"), F.col("_ratio"))) == 0).alias("quality_passes"))


# -- outcomes and tallies ----------------------------------------------------------------
def publication_outcomes(pids: DataFrame, docs: DataFrame) -> DataFrame:
    """Outcome of the gazette stage per process, from its stored documents."""
    counts = docs.groupBy(KEY).agg(
        F.count("*").alias("documents"),
        F.count_if(F.col("extraction_error").isNull()).alias("successful"))
    joined = pids.select(KEY).distinct().join(counts, KEY, "left")
    documents = F.coalesce("documents", F.lit(0))
    successful = F.coalesce("successful", F.lit(0))
    outcome = (
        F.when(documents == 0, "no_results")
        .when(documents == successful, "completed")
        .otherwise("partial"))
    return joined.select(
        KEY, outcome.alias("outcome"), successful.alias("successful"),
        (documents - successful).alias("failed"))


def stage3_tally(decisions: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Totals of one gazette run: skipped processes by reason, others by outcome."""
    joined = decisions.join(outcomes.select(KEY, "outcome"), KEY, "left")
    run = F.col("decision") == "process"
    counted = {
        "success": run & (F.col("outcome") == "completed"),
        "no_results": run & (F.col("outcome") == "no_results"),
        "partial": run & (F.col("outcome") == "partial"),
        "skipped": ~run,
        "embedded": F.col("decision") == "embedded",
    }
    return joined.agg(
        F.count("*").alias("total"), *[F.count_if(c).alias(n) for n, c in counted.items()])


def latest_outcomes(log: DataFrame) -> DataFrame:
    return log.groupBy("stage", KEY).agg(F.max_by("outcome", "seq").alias("outcome"))


def run_log_events(log: DataFrame) -> DataFrame:
    """Processes and events per stage and outcome."""
    return log.groupBy("stage", "outcome").agg(
        F.count_distinct(KEY).alias("items"), F.count("*").alias("events"))


def stage_run_tally(log: DataFrame) -> DataFrame:
    """Processes per stage by their latest outcome, one column per outcome."""
    outcomes = ["completed", "failed", "skipped", "no_document", "no_results", "partial", "embedded"]
    return latest_outcomes(log).groupBy("stage").agg(
        F.count("*").alias("total"),
        *[F.count_if(F.col("outcome") == o).alias(o) for o in outcomes])


def stage_progress(log: DataFrame) -> DataFrame:
    """Status and percentage per stage."""
    per_item = log.groupBy("stage", KEY).agg(
        F.max(F.col("outcome") == "completed").alias("done"),
        F.count_if(F.col("outcome") == "failed").alias("failures"))
    counts = per_item.groupBy("stage").agg(
        F.count("*").alias("total"), F.count_if("done").alias("completed"),
        F.sum("failures").alias("failed_count"))
    total, completed = F.col("total"), F.col("completed")
    status = (
        F.when((F.col("failed_count") > 0) & (completed == 0), "FAILED")
        .when((total > 0) & (completed >= total), "COMPLETE")
        .when(completed > 0, "IN_PROGRESS")
        .otherwise("NOT_STARTED"))
    return counts.select(
        "*", status.alias("status"),
        F.when(total > 0, F.round(completed / total * 100, 1)).otherwise(0.0).alias("progress_pct"))


def stage_errors(log: DataFrame) -> DataFrame:
    """Failures of the extraction, gazette and compliance stages."""
    return log.where(
        (F.col("outcome") == "failed") & F.col("stage").isin("stage2", "stage3", "stage4")
    ).select(
        "stage", "seq", text_or_blank(F.col(KEY)).alias(KEY),
        text_or_blank(F.col("error")).alias("error"),
        text_or_blank(F.col("logged_at")).alias("at"))


def error_totals(errors: DataFrame) -> DataFrame:
    return errors.groupBy("stage").agg(F.count("*").alias("n"))


def error_preview(errors: DataFrame, stage: str, n: int = 20) -> DataFrame:
    return errors.where(F.col("stage") == stage).orderBy("seq").limit(n)


# -- failure ledger --------------------------------------------------------------------
def new_failures(log: DataFrame) -> DataFrame:
    """Failure records of logged failures, as they are appended to the ledger."""
    return log.where("outcome = 'failed'").select(
        text_or_blank(F.col(KEY)).alias(KEY), text_or_blank(F.col("stage")).alias("stage"),
        F.lit("ExtractionFailedError").alias("error_type"),
        text_or_blank(F.col("error")).alias("error_msg"),
        F.col("logged_at").alias("failed_at"), F.lit(0).alias("retry_count"),
        F.lit(False).alias("resolved"))


def resolve_failures(ledger: DataFrame, resolutions: DataFrame) -> DataFrame:
    """Current state of the ledger: a resolution covers earlier failures of its key."""
    last = resolutions.groupBy(KEY, "stage").agg(F.max("seq").alias("_resolved_to"))
    return ledger.join(last, [KEY, "stage"], "left").withColumn(
        "resolved",
        F.col("resolved") | F.coalesce(F.col("seq") <= F.col("_resolved_to"), F.lit(False)),
    ).drop("_resolved_to")


def count_unresolved(ledger: DataFrame, stage: str | None = None) -> DataFrame:
    rows = ledger if stage is None else ledger.where(F.col("stage") == stage)
    return rows.agg(F.count_if(~F.coalesce("resolved", F.lit(False))).alias("unresolved"))


def latest_run(runs: DataFrame) -> DataFrame:
    """The newest output of each stage."""
    return runs.groupBy("stage").agg(
        F.max_by(F.struct("path", "modified_at"), F.struct("modified_at", "seq")).alias("_r")
    ).select("stage", "_r.path", "_r.modified_at")
