"""The four audit rules and their scoring, as column expressions.

Rules take parsed dates, amounts and answers next to their texts: callers stage
those as columns, so a value used by many branches is computed once per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pactum import constants as K
from pactum.functions.text import quoted, quoted_list, strip, text_or_blank, truthy

LIMIT = K.PUBLICATION_DEADLINE_DAYS


def names_where(pairs: list[tuple[str, Column]]) -> Column:
    """The names whose condition holds, in the given order."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in pairs]))


def rule_result(verdict, explanation, confidence, review, reason=None, days=None) -> Column:
    def as_col(x, kind):
        return (x if isinstance(x, Column) else F.lit(x)).cast(kind)

    return F.struct(
        as_col(verdict, "string").alias("verdict"),
        as_col(explanation, "string").alias("explanation"),
        as_col(confidence, "string").alias("confidence"),
        as_col(review, "boolean").alias("requires_review"),
        as_col(days, "int").alias("days_delta"),
        as_col(reason, "string").alias("inconclusive_reason"),
    )


def undecided(reason: str, explanation, confidence="n/a", days=None) -> Column:
    return rule_result("INCONCLUSIVE", explanation, confidence, True, reason, days)


def timeliness(s: Column, p: Column, signed: Column, published: Column, divergent: Column) -> Column:
    """R001: published within the legal limit after signing.

    Takes both date texts and their parsed values, so parsing happens once.
    """
    delta = F.datediff(published, signed)
    diverged = F.array_intersect(
        F.array(F.lit("signing_date"), F.lit("publication_date")), divergent
    )
    missing = names_where([("signing_date", ~truthy(s)), ("publication_date", ~truthy(p))])
    published_after = F.concat(
        F.format_string("Contract published %d day(s) after signing (", delta),
        s, F.lit(" → "), p, F.lit("). "),
    )
    return (
        F.when(
            F.size(diverged) > 0,
            undecided(
                "divergent_date",
                F.concat(
                    F.lit("Date field(s) "), quoted_list(diverged),
                    F.lit(" showed disagreement between deterministic extraction and LLM "
                          "diagnostic. Auditor must verify the correct date before "
                          "evaluating timeliness."),
                ),
            ),
        )
        .when(
            F.size(missing) > 0,
            undecided(
                "missing_date",
                F.concat(
                    F.lit("Cannot evaluate timeliness: "), quoted_list(missing),
                    F.lit(" is missing. Check extraction quality for this contract."),
                ),
            ),
        )
        .when(
            signed.isNull(),
            undecided("unparseable_date", F.concat(
                F.lit("signing_date '"), s, F.lit("' could not be parsed as DD/MM/YYYY."))),
        )
        .when(
            published.isNull(),
            undecided("unparseable_date", F.concat(
                F.lit("publication_date '"), p, F.lit("' could not be parsed as DD/MM/YYYY."))),
        )
        .when(
            delta < 0,
            undecided(
                "negative_delta",
                F.concat(
                    F.lit("Publication date ("), p, F.lit(") is before signing date ("), s,
                    F.format_string(") by %d days. ", F.abs(delta)),
                    F.lit("This indicates a data quality issue — verify both dates."),
                ),
                "low",
                delta,
            ),
        )
        .when(
            delta <= LIMIT,
            rule_result(
                "PASS",
                F.concat(published_after, F.lit(f"Within the {LIMIT}-day legal limit.")),
                "high", False, days=delta,
            ),
        )
        .otherwise(
            rule_result(
                "FAIL",
                F.concat(
                    published_after,
                    F.format_string(
                        f"Exceeds the {LIMIT}-day legal limit by %d day(s).", delta - LIMIT),
                ),
                "high", True, days=delta,
            )
        )
    )


def json_truth(node: Column) -> Column:
    """Truth of a JSON value: empty, zero and null are false, all else is true."""
    kind = F.schema_of_variant(node)
    text = F.try_variant_get(node, "$", "string")
    return F.coalesce(
        F.when(kind == "BOOLEAN", F.try_variant_get(node, "$", "boolean"))
        .when(kind == "VOID", F.lit(False))
        .when(kind == "STRING", text != "")
        .when(kind.startswith("ARRAY"), F.to_json(node) != "[]")
        .when(kind.startswith("OBJECT"), F.to_json(node) != "{}")
        .otherwise(F.try_variant_get(node, "$", "double") != 0.0),
        F.lit(False),
    )


def json_text(node: Column, default: str) -> Column:
    """Text of a JSON value: ``default`` where the key is absent, 'None' for null."""
    return (
        F.when(node.isNull(), F.lit(default))
        .when(F.is_variant_null(node), "None")
        .otherwise(F.try_variant_get(node, "$", "string"))
    )


def parse_object(response: Column) -> Column:
    """The response as a variant when it is a JSON object, else null."""
    node = F.try_parse_json(response)
    return F.when(F.schema_of_variant(node).startswith("OBJECT"), node)


def diverged_parties(divergent: Column) -> Column:
    parties = F.array(*[F.lit(name) for name in K.PARTY_FIELDS])
    return F.sort_array(F.array_intersect(divergent, parties))


def match_answer(answer: Column) -> Column:
    """The six answers of a party comparison, read from its JSON object."""

    def node(key: str) -> Column:
        return F.try_variant_get(answer, f"$.{key}", "variant")

    return F.struct(
        F.lower(json_text(node("confidence"), "low")).alias("confidence"),
        json_text(node("overall_verdict"), "").alias("overall"),
        json_truth(node("contratante_match")).alias("hiring_ok"),
        json_truth(node("contratada_match")).alias("hired_ok"),
        json_text(node("contratante_explanation"), "").alias("hiring_why"),
        json_text(node("contratada_explanation"), "").alias("hired_why"),
    )


def party_match(
    value: dict[str, Column], answer: Column, parsed: Column, said: Column, divergent: Column
) -> Column:
    """R002: both parties named alike.

    ``value`` maps the four roles to names, ``answer`` is the raw response,
    ``parsed`` its JSON object or null, ``said`` the fields of `match_answer`.
    """
    roles = ["contract_contratante", "pub_contratante", "contract_contratada", "pub_contratada"]
    missing = names_where([(role, ~truthy(value[role])) for role in roles])
    diverged = diverged_parties(divergent)
    hiring_ok, hired_ok = said["hiring_ok"], said["hired_ok"]
    conf, overall = said["confidence"], F.upper(said["overall"])

    def side(label: str, left: str, right: str, ok: Column, why: str) -> list[Column]:
        return [
            F.lit(f"{label}: "), quoted(value[left]), F.lit(" ↔ "), quoted(value[right]),
            F.lit(" → "), F.when(ok, "match").otherwise("MISMATCH"), F.lit(". "), said[why],
        ]

    summary = F.concat(
        *side("Contratante", roles[0], roles[1], hiring_ok, "hiring_why"),
        F.lit(" | "),
        *side("Contratada", roles[2], roles[3], hired_ok, "hired_why"),
    )
    return (
        F.when(
            F.size(diverged) > 0,
            undecided(
                "divergent_party",
                F.concat(
                    F.lit("Party field(s) "), quoted_list(diverged),
                    F.lit(" showed disagreement between deterministic extraction and LLM "
                          "diagnostic. Auditor must verify the correct party names before "
                          "evaluating match."),
                ),
            ),
        )
        .when(
            F.size(missing) > 0,
            undecided(
                "missing_party",
                F.concat(
                    F.lit("Cannot evaluate party match: "), quoted_list(missing),
                    F.lit(" is missing. Check extraction quality for this contract and its "
                          "publication."),
                ),
            ),
        )
        .when(
            answer.isNull(),
            undecided(
                "llm_unavailable",
                "LLM party comparison was not available (API call returned None). "
                "Auditor must manually compare party names.",
            ),
        )
        .when(
            parsed.isNull(),
            undecided(
                "llm_parse_error",
                F.concat(
                    F.lit("LLM returned a response that could not be parsed as JSON. "
                          "Raw response (first 200 chars): "),
                    quoted(F.substring(answer, 1, 200)),
                ),
            ),
        )
        .when(
            conf == "low",
            undecided(
                "llm_low_confidence",
                F.concat(
                    F.lit("LLM expressed low confidence in the party name comparison. "
                          "Contratante: "),
                    said["hiring_why"], F.lit(" | Contratada: "), said["hired_why"],
                    F.lit(". Auditor must verify party names manually."),
                ),
                "low",
            ),
        )
        .when(
            (overall == "PASS") & hiring_ok & hired_ok, rule_result("PASS", summary, conf, False)
        )
        .when(
            (overall == "FAIL") | ~hiring_ok | ~hired_ok, rule_result("FAIL", summary, conf, True)
        )
        .otherwise(
            undecided(
                "llm_unexpected_verdict",
                F.concat(
                    F.lit("LLM returned unexpected verdict '"), said["overall"], F.lit("'. "),
                    summary,
                ),
                conf,
            )
        )
    )


def score_result(verdict: str, score: int, explanation, pct: Column | float | None = None) -> Column:
    pct_col = pct if isinstance(pct, Column) else F.lit(pct)
    text = explanation if isinstance(explanation, Column) else F.lit(explanation)
    return F.struct(
        F.lit(verdict).alias("verdict"),
        F.lit(score).alias("score"),
        pct_col.cast("double").alias("difference_percentage"),
        text.alias("explanation"),
    )


def skipped_rule() -> Column:
    return score_result("SKIPPED", 50, "Skipped due to extraction diagnostic divergence.")


def r003_identifier(contract_number: Column, publication_number: Column) -> Column:
    """R003: the same contract number on both sides, whatever the case."""
    c, p = strip(text_or_blank(contract_number)), strip(text_or_blank(publication_number))
    return (
        F.when(
            (c == "") | (p == ""),
            score_result(
                "INCOMPLETE", 50, "Missing contract number in contract or publication source."),
        )
        .when(
            F.lower(c) == F.lower(p),
            score_result("PASS", 100, "Contract numbers match (case-insensitive)."),
        )
        .otherwise(
            score_result("FAIL", 0, F.concat(
                F.lit("Contract numbers differ: "), quoted(c), F.lit(" vs "), quoted(p),
                F.lit("."))),
        )
    )


def value_gap(c: Column, p: Column) -> Column:
    """Difference in percent of the contract value; null for a zero contract."""
    return F.when(c != 0.0, F.round(F.abs(c - p) / F.abs(c) * 100, 6))


def r004_value(c: Column, p: Column, pct: Column) -> Column:
    """R004: the same value on both sides, within one percent at most."""
    return (
        F.when(
            c.isNull() | p.isNull(),
            score_result(
                "INCOMPLETE", 50, "Missing or invalid value in contract or publication source."),
        )
        .when((c == 0.0) & (p == 0.0), score_result("PASS", 100, "Both values are zero.", 0.0))
        .when(
            c == 0.0,
            score_result("FAIL", 0, "Contract value is zero and publication value is non-zero."),
        )
        .when(pct == 0.0, score_result("PASS", 100, "Values are identical.", pct))
        .when(pct <= 1.0, score_result("PARTIAL", 75, "Values differ by up to 1%.", pct))
        .otherwise(score_result("FAIL", 0, "Values differ by more than 1%.", pct))
    )


def lookup(key: Column, table: dict[str, object], default) -> Column:
    """A small fixed table as a chain of conditions."""
    chain = None
    for name, value in table.items():
        chain = F.when(key == name, F.lit(value)) if chain is None else chain.when(
            key == name, F.lit(value))
    return chain.otherwise(F.lit(default))


def verdict_score(verdict: Column) -> Column:
    return lookup(F.upper(strip(verdict)), K.VERDICT_SCORES, K.DEFAULT_VERDICT_SCORE)


def weighted_score(scores: dict[str, Column]) -> Column:
    """Weighted sum in integer tenths, so no float rounding can occur."""
    tenths = {rule: round(weight * 10) for rule, weight in K.WEIGHTS.items()}
    total = None
    for rule in K.RULES:
        term = scores[rule] * tenths[rule]
        total = term if total is None else total + term
    return total / F.lit(10.0)


def agreement_key(level: Column) -> Column:
    return F.upper(strip(F.when(truthy(level), level).otherwise("SKIPPED")))


def gated_score(score: Column, level: Column) -> Column:
    """Score after the extraction diagnostic: zeroed, capped or kept."""
    key = agreement_key(level)
    return (
        F.when(key == "DIVERGENT", 0.0)
        .when(key == "PARTIAL", F.least(score, F.lit(K.PARTIAL_SCORE_CAP)))
        .otherwise(score)
    )


def gating_flag(level: Column) -> Column:
    """The flag the diagnostic raises, null for none."""
    flags = {"DIVERGENT": "DIAGNOSTIC_DIVERGENCE", "PARTIAL": "DIAGNOSTIC_PARTIAL",
             "SKIPPED": "DIAGNOSTIC_SKIPPED"}
    return lookup(agreement_key(level), flags, None)


def gating_review(level: Column) -> Column:
    return agreement_key(level).isin("DIVERGENT", "PARTIAL")


def final_status(score: Column, level: Column, missing_publication: Column) -> Column:
    return (
        F.when(missing_publication | (agreement_key(level) == "DIVERGENT"), "INCOMPLETE")
        .when(score >= 90, "CONFORME")
        .when((score >= 60) & (score <= 89), "PARCIAL")
        .otherwise("NÃO CONFORME")
    )


def rule_status(verdict: Column) -> Column:
    key = F.upper(strip(F.when(truthy(verdict), verdict).otherwise("INCONCLUSIVE")))
    return lookup(key, K.RULE_STATUS, "INCOMPLETE")


def diagnostic_impact(level: Column) -> Column:
    return lookup(agreement_key(level), K.DIAGNOSTIC_IMPACT, "PARCIAL")


def overall_status(r001: Column, r002: Column, level: Column) -> Column:
    """Compliance status, review switch and reason from both verdicts."""
    failed = (r001 == "FAIL") | (r002 == "FAIL")
    reasons = names_where(
        [
            ("r001_inconclusive", r001 == "INCONCLUSIVE"),
            ("r002_inconclusive", r002 == "INCONCLUSIVE"),
            ("diagnostic_divergent", level == "DIVERGENT"),
        ]
    )
    unsure = F.size(reasons) > 0
    partial = level == "PARTIAL"
    return F.struct(
        F.when(failed, "FAIL").when(unsure, "INCONCLUSIVE").otherwise("PASS").alias("status"),
        (failed | unsure | partial).alias("requires_review"),
        F.when(failed, "one_or_more_rules_failed")
        .when(unsure, F.array_join(reasons, ","))
        .when(partial, "diagnostic_partial")
        .alias("review_reason"),
    )


def failed_rules(verdicts: dict[str, Column]) -> Column:
    return names_where([(rule, F.upper(verdicts[rule]) == "FAIL") for rule in K.RULES])


def primary_violation(verdicts: dict[str, Column]) -> Column:
    return F.coalesce(
        *[F.when(verdicts[rule] == "FAIL", F.lit(rule)) for rule in K.RULES], F.lit("")
    )


def severity(score: Column) -> Column:
    return F.when(score >= 90, "BAIXA").when(score >= 60, "MÉDIA").otherwise("ALTA")
