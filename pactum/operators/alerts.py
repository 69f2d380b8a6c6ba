"""Alert stage: classification, queue, executive summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactum import constants as K
from pactum.operators.rules import failed_rules, lookup

KEY = "processo_id"
QUEUE_COLUMNS = [
    KEY, "alert_level", "reason", "conformity_score", "failed_rules", "flags", "action",
    "priority_score",
]


def alert_context() -> Column:
    """The compliance fields an alert may show as evidence."""
    return F.struct(
        F.col("overall.review_reason").alias("review_reason"),
        F.col("extraction_diagnostic.divergence_detail").alias("divergence_detail"),
        F.col("r001_timeliness.verdict").alias("r001"),
        F.col("r002_party_match.verdict").alias("r002"),
    )


def alert_join(conformity: DataFrame, compliance: DataFrame) -> DataFrame:
    """Stored conformity rows with the compliance context of the same process."""
    return conformity.join(compliance.select(KEY, alert_context().alias("context")), KEY, "left")


def alert_reason(flags: Column, status: Column, review: Column) -> Column:
    return (
        F.when(F.array_contains(flags, "MISSING_PUBLICATION"), "MISSING_PUBLICATION")
        .when(F.array_contains(flags, "DIAGNOSTIC_DIVERGENCE"), "DIAGNOSTIC_DIVERGENCE")
        .when(status == "NÃO CONFORME", "NON_CONFORME")
        .when(status.isin("PARCIAL", "INCOMPLETE") | review, "NEEDS_REVIEW")
        .otherwise("CONFORME")
    )


def evidence(reason: Column, context: Column, level: Column, review: Column) -> Column:
    """What supports the reason, as JSON text (a string or an object)."""

    def text(value: Column) -> Column:
        return F.concat(F.lit('"'), value, F.lit('"'))

    def keep_nulls(*fields: Column) -> Column:
        return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})

    why = F.when(context.isNull(), "no_publication_found").otherwise(
        F.coalesce(context["review_reason"], F.lit("None")))
    return (
        F.when(reason == "MISSING_PUBLICATION", text(why))
        .when(
            reason == "DIAGNOSTIC_DIVERGENCE",
            F.coalesce(F.to_json(context["divergence_detail"]), F.lit("{}")))
        .when(
            reason == "NON_CONFORME",
            keep_nulls(context["r001"].alias("r001"), context["r002"].alias("r002")))
        .when(
            reason == "NEEDS_REVIEW",
            keep_nulls(level.alias("agreement_level"), review.alias("requires_review")))
        .otherwise(text(F.lit("conforme")))
    )


def classify_alerts(joined: DataFrame) -> DataFrame:
    """One alert per conformity row."""
    review = F.coalesce("requires_review", F.lit(False))
    status = F.coalesce("overall_status", F.lit("INCOMPLETE"))
    flags = F.coalesce("flags", F.array().cast("array<string>"))
    df = joined.withColumns(
        {
            "requires_review": review,
            "overall_status": status,
            "flags": flags,
            "reason": alert_reason(flags, status, review),
            "failed_rules": failed_rules(
                {rule: F.col("score_breakdown")[rule]["verdict"] for rule in K.RULES}),
        }
    )
    reason = F.col("reason")
    level = (
        F.when(reason == "CONFORME", "OK")
        .when(reason == "NEEDS_REVIEW", "REVIEW")
        .otherwise("FAILED")
    )
    return df.select(
        KEY,
        level.alias("alert_level"),
        "reason",
        F.struct(
            "failed_rules",
            "recommendations",
            lookup(reason, K.ALERT_ACTIONS, None).alias("action"),
            evidence(
                reason, F.col("context"), F.col("diagnostic.agreement_level"),
                F.col("requires_review"),
            ).alias("evidence"),
        ).alias("reason_details"),
        "overall_status",
        F.coalesce("conformity_score", F.lit(0.0)).alias("conformity_score"),
        "flags",
        "failed_rules",
    )


def level_priority(level: Column) -> Column:
    return lookup(level, K.LEVEL_PRIORITY, 3)


def queue_order() -> list[Column]:
    """Severity, then lower score, then identifier."""
    return [level_priority(F.col("alert_level")), F.col("conformity_score"), F.col(KEY)]


def alert_queue(alerts: DataFrame) -> DataFrame:
    """Open alerts with their action and priority score, unsorted."""
    return alerts.where(F.coalesce("alert_level", F.lit("OK")) != "OK").select(
        KEY, "alert_level", "reason", "conformity_score", "failed_rules", "flags",
        F.col("reason_details.action").alias("action"),
        (level_priority(F.col("alert_level")) * 1000.0 - F.col("conformity_score")).alias(
            "priority_score"),
    )


def queue_top(alerts: DataFrame, n: int = 5) -> DataFrame:
    """The head of the queue; a top-k, so no full sort."""
    return alert_queue(alerts).orderBy(*queue_order()).limit(n)


def percent(count: Column, total: Column) -> Column:
    return F.when(total > 0, F.round(count / total * 100.0, 2)).otherwise(0.0)


def level_counts(alerts: DataFrame) -> DataFrame:
    level = F.col("alert_level")
    return alerts.agg(
        F.count("*").alias("total_contracts"),
        F.count_if(level == "OK").alias("ok"),
        F.count_if(level == "REVIEW").alias("review"),
        F.count_if(level == "FAILED").alias("failed"),
        *[
            F.count_if(F.array_contains("failed_rules", rule)).alias(f"failed_{rule}")
            for rule in K.RULES
        ],
    )


def executive_summary(alerts: DataFrame) -> DataFrame:
    """Counts, rates and failed-rule counts, zero-filled, in one pass."""
    counts = level_counts(alerts)
    total = F.col("total_contracts")
    return counts.select(
        "*",
        *[percent(F.col(n), total).alias(f"{n}_pct") for n in ("ok", "review", "failed")],
    )


def alerts_by_reason(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy(F.coalesce("reason", F.lit("UNKNOWN")).alias("reason")).agg(
        F.count("*").alias("n"))


def alerts_summary(alerts: DataFrame) -> DataFrame:
    """Run summary; anything that is neither OK nor REVIEW counts as failed."""
    level = F.coalesce("alert_level", F.lit(""))
    return alerts.agg(
        F.count("*").alias("total_contracts"),
        F.count_if(level == "OK").alias("ok"),
        F.count_if(level == "REVIEW").alias("review"),
        F.count_if(~level.isin("OK", "REVIEW")).alias("failed"),
        F.count_if(F.coalesce("alert_level", F.lit("OK")) != "OK").alias("queue_size"),
    )


def alert_run_summary(alerts: DataFrame, top: int = 5) -> DataFrame:
    """One row: totals, rates, counts per reason and per failed rule, and the head of the queue.

    Reasons are a fixed set and the head is a top-k, so both lists are bounded.
    """
    totals = alerts_summary(alerts)
    rates = executive_summary(alerts).drop("total_contracts", "ok", "review", "failed")
    reasons = alerts_by_reason(alerts).agg(F.array_sort(F.collect_list(
        F.struct("reason", "n"))).alias("by_reason"))
    head = queue_top(alerts, top).agg(F.array_sort(F.collect_list(F.struct(
        level_priority(F.col("alert_level")).alias("level"), "conformity_score", KEY))).alias("_head"))
    rows = totals.crossJoin(rates).crossJoin(reasons).crossJoin(head)  # one row each
    return rows.withColumn("top_priority", F.transform("_head", lambda a: a[KEY])).drop("_head")


def ordered_alerts(alerts: DataFrame) -> DataFrame:
    """Queue order first, then OK alerts by identifier; needs one alert per process."""
    ok = F.col("alert_level") == "OK"
    return alerts.orderBy(
        ok.cast("int"),
        F.when(~ok, level_priority(F.col("alert_level"))),
        F.when(~ok, F.col("conformity_score")),
        KEY,
    )


def alert_export(alerts: DataFrame) -> DataFrame:
    return alerts.withColumns(
        {n: F.array_join(n, "|") for n in ("flags", "failed_rules")}
    ).select(*K.ALERT_CSV_COLUMNS)


def queue_export(alerts: DataFrame) -> DataFrame:
    return alert_queue(alerts).withColumns(
        {n: F.array_join(n, "|") for n in ("flags", "failed_rules")}
    ).select(*K.QUEUE_CSV_COLUMNS)
