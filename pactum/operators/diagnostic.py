"""Cross-check of two independent extractions of the same fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pactum import constants as K
from pactum.functions.dates import parse_dmy
from pactum.functions.names import normalise_name
from pactum.functions.text import quoted, truthy

DETAIL = "map<string,string>"


def values_match(left: Column, right: Column, kind: str) -> Column:
    """Both null match; one null does not; dates as dates, names loosely."""
    if kind == "date":
        same = parse_dmy(left).eqNullSafe(parse_dmy(right))
    else:
        same = (left == right) | (normalise_name(left) == normalise_name(right))
    return (
        F.when(left.isNull() & right.isNull(), True)
        .when(left.isNull() | right.isNull(), False)
        .otherwise(same)
    )


def agreement_level(checks: Column) -> Column:
    """Level from an array of (field, match, critical) checks."""
    critical = F.exists(
        checks,
        lambda x: ~x["match"] & x["critical"] & x["field"].isin(*K.CRITICAL_FIELDS),
    )
    return (
        F.when(critical, "DIVERGENT")
        .when(F.exists(checks, lambda x: ~x["match"]), "PARTIAL")
        .otherwise("CONFIRMED")
    )


def answered(answer: Column, field_map: list) -> Column:
    """The answer's fields as texts; null where absent or null."""
    return F.struct(
        *[F.try_variant_get(answer, f"$.{key}", "string").alias(field)
          for field, _, key, _, _ in field_map])


def field_checks(given: Column, deterministic: dict[str, str], field_map: list) -> Column:
    """One (field, det, llm, match, critical) check per entry of the field map."""

    def check(field: str, det_key: str, _: str, kind: str, critical: bool) -> Column:
        left, right = F.col(deterministic[det_key]), given[field]
        return F.struct(
            F.lit(field).alias("field"),
            left.alias("det"),
            right.alias("llm"),
            values_match(left, right, kind).alias("match"),
            F.lit(critical).alias("critical"),
        )

    return F.array(*[check(*entry) for entry in field_map])


def compared(answer: Column, checks: Column) -> Column:
    """The diagnostic of one side; null where there is no JSON object to compare."""
    divergent = F.filter(checks, lambda x: ~x["match"])
    detail = F.map_from_entries(
        F.transform(
            divergent,
            lambda x: F.struct(
                x["field"],
                F.concat(F.lit("det: "), quoted(x["det"]), F.lit(" — llm: "), quoted(x["llm"])),
            ),
        )
    )
    level = agreement_level(checks)
    return F.when(
        answer.isNotNull(),
        F.struct(
            level.alias("agreement_level"),
            F.transform(F.filter(checks, lambda x: x["match"]), lambda x: x["field"]).alias(
                "fields_confirmed"),
            F.transform(divergent, lambda x: x["field"]).alias("fields_divergent"),
            detail.alias("divergence_detail"),
            (level != "CONFIRMED").alias("auditor_action_required"),
        ),
    )


def answer_warning(response: Column, diagnostic: Column, side: str) -> Column:
    return F.when(~truthy(response), f"diagnostic:{side}_llm_unavailable").when(
        diagnostic.isNull(), f"diagnostic:{side}_llm_parse_error"
    )


def merge_diagnostics(contract: Column, publication: Column, forced_skip: Column) -> Column:
    """One diagnostic from both sides; a null side is left out.

    The publication's detail wins where both sides name a field.
    """
    none = F.array().cast("array<string>")

    def both(name: str) -> Column:
        return F.concat(F.coalesce(contract[name], none), F.coalesce(publication[name], none))

    def either(level: str) -> Column:
        return F.coalesce(contract["agreement_level"] == level, F.lit(False)) | F.coalesce(
            publication["agreement_level"] == level, F.lit(False))

    absent = contract.isNull() & publication.isNull()
    level = (
        F.when(absent, "SKIPPED")
        .when(either("DIVERGENT"), "DIVERGENT")
        .when(either("PARTIAL"), "PARTIAL")
        .otherwise("CONFIRMED")
    )
    empty = F.create_map().cast(DETAIL)
    second = F.coalesce(publication["divergence_detail"], empty)
    first = F.map_filter(
        F.coalesce(contract["divergence_detail"], empty),
        lambda k, _: ~F.map_contains_key(second, k),
    )
    return F.struct(
        F.when(forced_skip, "SKIPPED").otherwise(level).alias("agreement_level"),
        F.sort_array(F.array_distinct(both("fields_confirmed"))).alias("fields_confirmed"),
        F.sort_array(F.array_distinct(both("fields_divergent"))).alias("fields_divergent"),
        F.map_concat(first, second).alias("divergence_detail"),
        (~absent & (level != "CONFIRMED")).alias("auditor_action_required"),
    )
