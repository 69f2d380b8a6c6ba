"""Stored documents, artifact index and pipeline stage of every process."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from pactum import constants as K
from pactum.functions.ids import pid_slashless
from pactum.operators.rules import lookup

KEY = "processo_id"
COMPLIANCE_DOCUMENT = StructType(
    [
        StructField("processo_id", StringType()),
        StructField(
            "overall",
            StructType(
                [StructField("status", StringType()), StructField("review_reason", StringType())]),
        ),
    ]
)


def parse_documents(docs: DataFrame, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Stored JSON texts as rows, and the unreadable or empty ones set aside."""
    keys = F.json_object_keys("body")
    checked = docs.withColumn("_readable", F.coalesce(F.size(keys) > 0, F.lit(False)))
    good = checked.where("_readable").select(
        "name", F.from_json("body", schema).alias("_doc")).select("name", "_doc.*")
    return good, checked.where("NOT _readable").select("name", "body")


def document_error(artifact: Column, body: Column) -> Column:
    """Does a stored document report an error?"""
    reason = F.get_json_object(body, "$.overall.review_reason")
    status = F.get_json_object(body, "$.overall.status")
    undecided = (artifact == "compliance") & (status == "INCONCLUSIVE") & F.contains(
        F.lower(reason), F.lit("error"))
    return F.coalesce(F.array_contains(F.json_object_keys(body), "error"), F.lit(False)) | F.coalesce(
        undecided, F.lit(False))


def pipeline_stage() -> Column:
    """First match from the most advanced stage down."""
    return (
        F.when(F.col("has_conformity"), "SCORED")
        .when(F.col("has_compliance"), "COMPLIANCE")
        .when(F.col("has_preprocessed") & F.col("has_pub_structured"), "PREPROCESSED")
        .when(F.col("has_pub_raw"), "PUB_FOUND")
        .when(F.col("has_raw"), "EXTRACTED")
        .otherwise("DISCOVERED")
    )


def state_index(links: DataFrame, artifacts: DataFrame) -> DataFrame:
    """One row per discovered process with its artifacts, stage and error flag.

    Links and artifacts are stacked and grouped once, so a process named by very
    many links is counted map-side and no row is multiplied.
    """
    found = links.select(
        F.col(KEY), F.lit("link").alias("artifact"), F.lit(False).alias("is_error")
    ).where(F.coalesce(F.col(KEY) != "", F.lit(False)))
    stored = artifacts.select(
        KEY, "artifact", document_error(F.col("artifact"), F.col("body")).alias("is_error"))
    kind = F.col("artifact")
    grouped = found.unionByName(stored).groupBy(KEY).agg(
        F.count_if(kind == "link").alias("n_links"),
        *[F.coalesce(F.max(kind == a), F.lit(False)).alias(f"has_{a}") for a in K.ARTIFACTS],
        *[F.coalesce(F.max((kind == a) & F.col("is_error")), F.lit(False)).alias(f"_err_{a}")
          for a in K.ARTIFACTS],
    )
    latest = (
        F.when(F.col("has_conformity"), F.col("_err_conformity"))
        .when(F.col("has_compliance"), F.col("_err_compliance"))
        .when(F.col("has_preprocessed"), F.col("_err_preprocessed"))
        .when(F.col("has_pub_raw"), F.col("_err_pub_raw"))
        .when(F.col("has_raw"), F.col("_err_raw"))
        .otherwise(False)
    )
    return grouped.where("n_links > 0").select(
        pid_slashless(F.col(KEY)).alias("pid_safe"),
        KEY,
        pipeline_stage().alias("pipeline_stage"),
        *[f"has_{a}" for a in K.ARTIFACTS],
        latest.alias("error_flag"),
        "n_links",
    )


def stage_counts(state: DataFrame) -> DataFrame:
    """Links and processes per stage, zero-filled, as one row per stage."""
    stage = F.col("pipeline_stage")
    totals = state.agg(
        *[F.coalesce(F.sum(F.when(stage == s, F.col("n_links"))), F.lit(0)).alias(f"{s}_links")
          for s in K.STAGES],
        *[F.count_if(stage == s).alias(f"{s}_pids") for s in K.STAGES],
    )
    rows = F.array(
        *[F.struct(F.lit(s).alias("pipeline_stage"), F.col(f"{s}_links").alias("links"),
                   F.col(f"{s}_pids").alias("pids")) for s in K.STAGES])
    return totals.select(F.inline(rows))


def missing_phase(stage: Column) -> Column:
    return lookup(stage, K.MISSING_PHASE, "")


def incomplete(state: DataFrame) -> DataFrame:
    return state.where(~F.col("pipeline_stage").isin("SCORED", "COMPLIANCE")).select(
        KEY, "pipeline_stage", missing_phase(F.col("pipeline_stage")).alias("fase_faltante"))


def process_detail(pid: str, artifacts: DataFrame) -> DataFrame:
    """All stored documents of one process, null where absent; the filter is pushed down."""
    mine = artifacts.where(F.col(KEY) == pid)
    return mine.agg(
        *[F.max(F.when(F.col("artifact") == a, F.col("body"))).alias(a) for a in K.ARTIFACTS])
