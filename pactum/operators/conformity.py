"""Conformity stage: R003, R004, weighted score, gating and status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactum import constants as K
from pactum.functions.money import parse_brl
from pactum.functions.text import filled, truthy
from pactum.operators.rules import (
    diagnostic_impact,
    final_status,
    gated_score,
    gating_flag,
    gating_review,
    r003_identifier,
    r004_value,
    rule_status,
    skipped_rule,
    value_gap,
    verdict_score,
    weighted_score,
)

KEY = "processo_id"


def safe_get(path: str, default) -> Column:
    """Nested field, or the default where any step of the path is null."""
    return F.coalesce(F.col(path), F.lit(default))


def fallback_join(
    compliance: DataFrame, contracts: DataFrame, publications: DataFrame
) -> DataFrame:
    """Compliance rows with the fields R003 and R004 need."""
    left = contracts.select(
        KEY,
        F.lit(True).alias("_contract"),
        F.col("header.contract_number").alias("contract_number_contract"),
        F.coalesce(filled(F.col("header.value")), filled(F.col("value"))).alias("contract_value"),
    )
    right = publications.select(
        KEY,
        F.lit(True).alias("_publication"),
        F.col("contract_number").alias("contract_number_publication"),
        F.col("value").alias("publication_value"),
    )
    return (
        compliance.join(left, KEY, "left")
        .join(right, KEY, "left")
        .withColumn(
            "fallback_used", F.col("_contract").isNotNull() | F.col("_publication").isNotNull())
        .drop("_contract", "_publication")
    )


def score_conformity(joined: DataFrame, carry: list[str] = ()) -> DataFrame:
    """One scored row per compliance row; ``carry`` columns pass through."""
    df = joined.withColumns(
        {
            "_v1": safe_get("r001_timeliness.verdict", "INCONCLUSIVE"),
            "_v2": safe_get("r002_party_match.verdict", "INCONCLUSIVE"),
            "_level": safe_get("extraction_diagnostic.agreement_level", "SKIPPED"),
            "_missing": F.coalesce(
                (F.col("overall.status") == "INCONCLUSIVE")
                & (F.col("overall.review_reason") == "no_publication_found"),
                F.lit(False)),
            "_cv": parse_brl(F.col("contract_value")),
            "_pv": parse_brl(F.col("publication_value")),
        }
    )
    level, missing = F.col("_level"), F.col("_missing")
    divergent = F.upper(level) == "DIVERGENT"
    r003 = r003_identifier(F.col("contract_number_contract"), F.col("contract_number_publication"))
    c, p = F.col("_cv"), F.col("_pv")
    df = df.withColumns(
        {
            "_r003": F.when(divergent, skipped_rule()).otherwise(r003),
            "_r004": F.when(divergent, skipped_rule()).otherwise(
                r004_value(c, p, value_gap(c, p))),
        }
    )
    verdicts = {
        "R001": F.col("_v1"), "R002": F.col("_v2"),
        "R003": F.col("_r003.verdict"), "R004": F.col("_r004.verdict"),
    }
    df = df.withColumns({f"_s{rule}": verdict_score(verdicts[rule]) for rule in K.RULES})
    scores = {rule: F.col(f"_s{rule}") for rule in K.RULES}
    df = df.withColumns(
        {
            "conformity_score": F.when(missing, 0.0).otherwise(
                gated_score(weighted_score(scores), level)),
            "flags": F.array_compact(
                F.array(gating_flag(level), F.when(missing, "MISSING_PUBLICATION"))),
        }
    )
    flags = F.col("flags")
    advice = F.array_compact(
        F.array(*[F.when(F.array_contains(flags, flag), text)
                  for flag, text in K.RECOMMENDATIONS.items()]))
    status = final_status(F.col("conformity_score"), level, missing)
    used = ["contract_number_contract", "contract_number_publication",
            "contract_value", "publication_value"]
    breakdown = F.create_map(
        *[
            x
            for rule in K.RULES
            for x in (
                F.lit(rule),
                F.struct(
                    scores[rule].cast("double").alias("score"),
                    F.lit(K.WEIGHTS[rule]).alias("weight"),
                    verdicts[rule].alias("verdict"),
                ),
            )
        ]
    )
    return df.select(
        KEY,
        F.struct(level.alias("agreement_level"), diagnostic_impact(level).alias("impact")).alias(
            "diagnostic"),
        F.struct(
            F.col("overall.status").alias("epic4_overall_status"),
            rule_status(verdicts["R001"]).alias("epic4_r001_status"),
            rule_status(verdicts["R002"]).alias("epic4_r002_status"),
            F.create_map(*[x for n in used for x in (F.lit(n), truthy(F.col(n)))]).alias(
                "fallback_fields_used"),
        ).alias("source_summary"),
        breakdown.alias("score_breakdown"),
        F.struct(
            F.col("_r003").dropFields("difference_percentage").alias("R003"),
            F.col("_r004").alias("R004"),
        ).alias("rule_details"),
        "conformity_score",
        status.alias("overall_status"),
        "flags",
        (gating_review(level) | missing).alias("requires_review"),
        advice.alias("recommendations"),
        "fallback_used",
        *carry,
    )


def conformity_summary(conformity: DataFrame) -> DataFrame:
    """Counts per status, mean score, flagged rows and fallback use."""
    status = F.col("overall_status")
    known = ["CONFORME", "PARCIAL", "NÃO CONFORME"]
    return conformity.agg(
        F.count("*").alias("total_contracts"),
        F.count_if(status == "CONFORME").alias("conformes"),
        F.count_if(status == "PARCIAL").alias("parciais"),
        F.count_if(status == "NÃO CONFORME").alias("nao_conformes"),
        F.count_if(~F.coalesce(status.isin(*known), F.lit(False))).alias("incomplete"),
        F.coalesce(F.round(F.avg("conformity_score"), 2), F.lit(0.0)).alias("average_score"),
        F.count_if(F.size("flags") > 0).alias("flagged_count"),
        F.count_if(F.col("fallback_used")).alias("fallback_usage"),
    )


def conformity_export(conformity: DataFrame) -> DataFrame:
    """The nine-column export of scored rows."""
    return conformity.select(
        KEY,
        F.col("diagnostic.agreement_level").alias("agreement_level"),
        *[F.col("score_breakdown")[rule]["verdict"].alias(rule) for rule in K.RULES],
        "conformity_score",
        "overall_status",
        F.array_join("flags", "|").alias("flags"),
    ).select(*K.CONFORMITY_CSV_COLUMNS)
