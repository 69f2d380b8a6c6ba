"""Queries over the evaluate path: compliance → conformity → alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from pactum import constants as K
from pactum.functions.dates import parse_dmy
from pactum.functions.money import parse_brl
from pactum.functions.names import normalise_name
from pactum.operators import alerts as A
from pactum.operators import compliance as C
from pactum.operators import conformity as S
from pactum.operators import rules as R
from pactum.operators.diagnostic import values_match
from pactum.operators.ranking import global_rank, last_per_process, written
from pactum.plans.check_sql import brl_sql, date_sql, joined_list, name_sql, same_sql, score_sql
from pactum.plans.registry import query

KEY = "processo_id"


def joined(column: str):
    return F.array_join(column, "|")


# -- projections and joins ---------------------------------------------------------
@query("contract_det_fields", "SELECT processo_id, contract_number, signing_date, contratante, contratada FROM contracts")
def contract_det_fields(t):
    return C.contract_fields(t.contracts)


@query("publication_det_fields", """
SELECT p.processo_id, p.contract_number, p.publication_date,
  CASE WHEN c.emb_found AND c.emb_contratante <> '' THEN c.emb_contratante ELSE p.contratante END AS contratante,
  CASE WHEN c.emb_found AND c.emb_contratada <> '' THEN c.emb_contratada ELSE p.contratada END AS contratada
FROM publications p LEFT JOIN contracts c ON c.processo_id = p.processo_id""")
def publication_det_fields(t):
    return C.publication_fields(t.publications, t.contracts)


@query("join_contract_publication", """
SELECT processo_id, pub AS has_publication, source AS publication_source, c_num AS c_contract_number,
  c_date AS c_signing_date, c_hiring AS c_contratante, c_hired AS c_contratada,
  p_num AS p_contract_number, p_date AS p_publication_date, p_hiring AS p_contratante,
  p_hired AS p_contratada FROM k_joined""")
def join_contract_publication(t):
    return C.join_contract_publication(t.contracts, t.publications)


@query("skipped_contracts", """
SELECT DISTINCT trim(processo_id) AS processo_id FROM links WHERE trim(processo_id) <> ''
  AND trim(processo_id) NOT IN (SELECT processo_id FROM contracts)""")
def skipped_contracts(t):
    pids = t.links.select(F.trim(KEY).alias(KEY)).where(F.col(KEY) != "")
    return C.skipped_contracts(pids, t.contracts)


@query("diagnostic_inputs", """
SELECT processo_id, has_contract_text AS has_raw_contract, has_publication_text AS has_raw_publication,
  NOT (has_contract_text AND has_publication_text) AS diagnostic_skipped,
  CASE WHEN NOT has_contract_text AND NOT has_publication_text THEN 'diagnostic:skipped:missing_raw_files:raw_contract,raw_publication'
    WHEN NOT has_contract_text THEN 'diagnostic:skipped:missing_raw_files:raw_contract'
    WHEN NOT has_publication_text THEN 'diagnostic:skipped:missing_raw_files:raw_publication' END AS diagnostic_warning
FROM k_joined WHERE pub""")
def diagnostic_inputs(t):
    pairs = C.join_contract_publication(t.contracts, t.publications).where("has_publication")
    return C.diagnostic_inputs(pairs, t.raw_texts).select(
        KEY, "has_raw_contract", "has_raw_publication", "diagnostic_skipped", "diagnostic_warning")


def _diagnosed(t):
    pairs = C.join_contract_publication(t.contracts, t.publications)
    pairs = C.diagnostic_inputs(pairs, t.raw_texts)
    return C.add_diagnostics(pairs.join(C.answers_by_kind(t.answers), KEY, "left"))


@query("compare_extractions", f"""
SELECT processo_id, cd_level AS contract_level, {joined_list('list_sort(cd_good)')} AS contract_confirmed,
  {joined_list('list_sort(cd_bad)')} AS contract_divergent, pd_level AS publication_level,
  {joined_list('list_sort(pd_good)')} AS publication_confirmed,
  {joined_list('list_sort(pd_bad)')} AS publication_divergent FROM k_diag""")
def compare_extractions(t):
    out = _diagnosed(t)
    cols = [F.col(KEY)]
    for side in ("contract", "publication"):
        diag = F.col(f"{side}_diag")
        cols.append(diag["agreement_level"].alias(f"{side}_level"))
        for kind in ("confirmed", "divergent"):
            cols.append(
                F.coalesce(F.array_join(F.sort_array(diag[f"fields_{kind}"]), "|"), F.lit(""))
                .alias(f"{side}_{kind}"))
    return out.select(*cols)


@query("merge_diagnostics", f"""
SELECT processo_id, level AS agreement_level, {joined_list('good')} AS fields_confirmed,
  {joined_list('bad')} AS fields_divergent, len(bad) AS details,
  level IN ('DIVERGENT', 'PARTIAL') AS auditor_action_required FROM k_merged""")
def merge_diagnostics(t):
    d = F.col("diagnostic")
    return _diagnosed(t).select(
        KEY, d["agreement_level"].alias("agreement_level"),
        F.array_join(d["fields_confirmed"], "|").alias("fields_confirmed"),
        F.array_join(d["fields_divergent"], "|").alias("fields_divergent"),
        F.size(d["divergence_detail"]).cast("bigint").alias("details"),
        d["auditor_action_required"].alias("auditor_action_required"))


@query("agreement_level", "SELECT coalesce(level, '') AS agreement_level, count(*) AS n FROM k_merged GROUP BY 1")
def agreement_level(t):
    level = F.col("extraction_diagnostic.agreement_level")
    return t.compliance.groupBy(level.alias("agreement_level")).agg(F.count("*").alias("n"))


@query("fallback_join", """
SELECT o.processo_id, c_num AS contract_number_contract, p_num AS contract_number_publication,
  coalesce(nullif(header_value, ''), nullif(top_value, '')) AS contract_value, p_value AS publication_value,
  true AS fallback_used FROM k_overall o""")
def fallback_join(t):
    return S.fallback_join(t.compliance.select(KEY), t.contracts, t.publications)


@query("fallback_fields", """
SELECT processo_id, coalesce(c_num <> '', false) AS contract_number_contract,
  coalesce(p_num <> '', false) AS contract_number_publication,
  c_value IS NOT NULL AS contract_value, coalesce(p_value <> '', false) AS publication_value FROM k_values""")
def fallback_fields(t):
    used = F.col("source_summary.fallback_fields_used")
    names = ["contract_number_contract", "contract_number_publication", "contract_value",
             "publication_value"]
    return t.conformity.select(KEY, *[used[n].alias(n) for n in names])


@query("safe_get", """
SELECT c.processo_id, coalesce(o.source, 'unknown') AS publication_source,
  coalesce(o.v1, 'INCONCLUSIVE') AS r001_verdict FROM contracts c LEFT JOIN k_overall o ON o.processo_id = c.processo_id""")
def safe_get(t):
    return t.compliance.select(
        KEY, S.safe_get("inputs.publication_source", "unknown").alias("publication_source"),
        S.safe_get("r001_timeliness.verdict", "INCONCLUSIVE").alias("r001_verdict"))


# -- scalar functions -----------------------------------------------------------------
@query("parse_dmy", f"SELECT processo_id, CAST({date_sql('signing_date')} AS VARCHAR) AS signed FROM contracts")
def q_parse_dmy(t):
    return t.contracts.select(KEY, parse_dmy(F.col("header.signing_date")).cast("string").alias("signed"))


@query("days_delta", f"""
SELECT c.processo_id, CAST(({date_sql('p.publication_date')}) - ({date_sql('c.signing_date')}) AS BIGINT) AS days_delta
FROM contracts c JOIN publications p ON p.processo_id = c.processo_id""")
def days_delta(t):
    pubs = t.publications.select(KEY, "publication_date")
    return t.contracts.join(pubs, KEY).select(
        KEY,
        F.datediff(parse_dmy(F.col("publication_date")), parse_dmy(F.col("header.signing_date")))
        .cast("bigint").alias("days_delta"))


@query("parse_brl", f"SELECT processo_id, {brl_sql('value')} AS amount FROM publications")
def q_parse_brl(t):
    return t.publications.select(KEY, parse_brl(F.col("value")).alias("amount"))


@query("normalise_name", f"SELECT processo_id, {name_sql('contratada')} AS contratada, {name_sql('contratante')} AS contratante FROM publications")
def q_normalise_name(t):
    return t.publications.select(KEY, *[normalise_name(F.col(n)).alias(n) for n in ("contratada", "contratante")])


@query("compare_values", f"""
SELECT c.processo_id, {same_sql('c.signing_date', 'p.publication_date', 'date')} AS same_date,
  {same_sql('c.contratada', 'p.contratada', 'name')} AS same_name,
  {same_sql('c.contract_number', 'p.contract_number', 'name')} AS same_number
FROM contracts c JOIN publications p ON p.processo_id = c.processo_id""")
def compare_values(t):
    pairs = C.join_contract_publication(
        t.contracts.withColumn("embedded_publication", F.struct(
            F.lit(False).alias("found"), F.lit("").alias("contratante_pub"),
            F.lit("").alias("contratada_pub"))),
        t.publications).where("has_publication")
    return pairs.select(
        KEY,
        values_match(F.col("c_signing_date"), F.col("p_publication_date"), "date").alias("same_date"),
        values_match(F.col("c_contratada"), F.col("p_contratada"), "name").alias("same_name"),
        values_match(F.col("c_contract_number"), F.col("p_contract_number"), "name").alias("same_number"))


@query("verdict_to_numeric", f"""
SELECT processo_id, {score_sql('v1')} AS r001, {score_sql('v2')} AS r002, {score_sql('v3')} AS r003,
  {score_sql('v4')} AS r004 FROM k_verdicts""")
def verdict_to_numeric(t):
    b = F.col("score_breakdown")
    return t.conformity.select(
        KEY, *[R.verdict_score(b[r]["verdict"]).cast("bigint").alias(r.lower()) for r in K.RULES])


@query("weighted_score", "SELECT processo_id, CAST(weighted AS DOUBLE) AS weighted FROM k_scored")
def weighted_score(t):
    b = F.col("score_breakdown")
    return t.conformity.select(
        KEY, R.weighted_score({r: b[r]["score"].cast("int") for r in K.RULES}).alias("weighted"))


@query("map_rule_status", """
SELECT processo_id, CASE v1 WHEN 'PASS' THEN 'CONFORME' WHEN 'FAIL' THEN 'NÃO CONFORME' ELSE 'INCOMPLETE' END AS r001_status,
  CASE v2 WHEN 'PASS' THEN 'CONFORME' WHEN 'FAIL' THEN 'NÃO CONFORME' ELSE 'INCOMPLETE' END AS r002_status FROM k_compliance""")
def map_rule_status(t):
    s = F.col("source_summary")
    return t.conformity.select(
        KEY, s["epic4_r001_status"].alias("r001_status"), s["epic4_r002_status"].alias("r002_status"))


@query("map_diagnostic", """
SELECT processo_id, level AS agreement_level, CASE level WHEN 'CONFIRMED' THEN 'CONFORME'
  WHEN 'DIVERGENT' THEN 'INCOMPLETE' ELSE 'PARCIAL' END AS impact FROM k_merged""")
def map_diagnostic(t):
    return t.conformity.select(KEY, "diagnostic.agreement_level", "diagnostic.impact")


# -- rules ------------------------------------------------------------------------
@query("r001_timeliness", """
SELECT processo_id, v1 AS verdict, r1_days AS days_delta, r1_reason AS inconclusive_reason, v1 <> 'PASS' AS requires_review,
  CASE WHEN r1_reason = 'negative_delta' THEN 'low' WHEN r1_reason IS NULL THEN 'high' ELSE 'n/a' END AS confidence
FROM k_asked""")
def r001_timeliness(t):
    r = F.col("r001_timeliness")
    return t.compliance.select(
        KEY, r["verdict"].alias("verdict"), r["days_delta"].cast("bigint").alias("days_delta"),
        *[r[n].alias(n) for n in ("inconclusive_reason", "requires_review", "confidence")])


@query("r002_party_match", """
SELECT processo_id, v2 AS verdict, r2_reason AS inconclusive_reason, v2 <> 'PASS' AS requires_review,
  CASE WHEN r2_reason IS NULL OR r2_reason IN ('llm_low_confidence', 'llm_unexpected_verdict') THEN r2_conf ELSE 'n/a' END AS confidence
FROM k_compliance""")
def r002_party_match(t):
    r = F.col("r002_party_match")
    return t.compliance.select(
        KEY, *[r[n].alias(n) for n in ("verdict", "inconclusive_reason", "requires_review", "confidence")])


@query("diverged_parties", """
SELECT processo_id, array_to_string(list_sort(list_filter(bad, lambda x: x IN ('contratante', 'contratada', 'contratante_in_pub', 'contratada_in_pub'))), '|') AS parties
FROM k_merged WHERE len(bad) > 0""")
def diverged_parties(t):
    d = F.col("extraction_diagnostic.fields_divergent")
    return t.compliance.where(F.size(d) > 0).select(
        KEY, F.array_join(R.diverged_parties(d), "|").alias("parties"))


@query("r003_identifier", """
SELECT processo_id, v3 AS verdict, CASE v3 WHEN 'PASS' THEN 100 WHEN 'FAIL' THEN 0 ELSE 50 END AS score FROM k_verdicts""")
def r003_identifier(t):
    r = F.col("rule_details.R003")
    return t.conformity.select(KEY, r["verdict"].alias("verdict"), r["score"].cast("bigint").alias("score"))


@query("r004_value", """
SELECT processo_id, v4 AS verdict, CASE v4 WHEN 'PASS' THEN 100 WHEN 'PARTIAL' THEN 75 WHEN 'FAIL' THEN 0 ELSE 50 END AS score,
  CAST(pct AS DOUBLE) AS difference_percentage FROM k_verdicts""")
def r004_value(t):
    r = F.col("rule_details.R004")
    return t.conformity.select(
        KEY, r["verdict"].alias("verdict"), r["score"].cast("bigint").alias("score"),
        r["difference_percentage"].alias("difference_percentage"))


@query("diagnostic_gating", f"""
SELECT processo_id, CAST(score AS DOUBLE) AS score, {joined_list('flags')} AS flags, review AS requires_review FROM k_gated""")
def diagnostic_gating(t):
    return t.conformity.select(
        KEY, F.col("conformity_score").alias("score"), joined("flags").alias("flags"), "requires_review")


@query("final_status", "SELECT processo_id, CAST(score AS DOUBLE) AS conformity_score, final AS overall_status FROM k_conformity")
def final_status(t):
    return t.conformity.select(KEY, "conformity_score", "overall_status")


@query("overall_status", "SELECT processo_id, status, status_review AS requires_review, review_reason FROM k_overall")
def overall_status(t):
    return t.compliance.select(KEY, "overall.*")


_CONFORMITY = f"""
SELECT processo_id, level AS agreement_level, status AS compliance_status, v1 AS "R001", v2 AS "R002", v3 AS "R003", v4 AS "R004",
  CAST(score AS DOUBLE) AS conformity_score, final AS overall_status, {joined_list('flags')} AS flags, review AS requires_review,
  (CASE WHEN NOT pub THEN 1 ELSE 0 END + CASE WHEN level IN ('DIVERGENT', 'PARTIAL') THEN 1 ELSE 0 END) AS n_recommendations
FROM k_conformity"""


@query("conformity_row", _CONFORMITY)
def conformity_row(t):
    b = F.col("score_breakdown")
    return t.conformity.select(
        KEY, F.col("diagnostic.agreement_level"),
        F.col("source_summary.epic4_overall_status").alias("compliance_status"),
        *[b[r]["verdict"].alias(r) for r in K.RULES],
        "conformity_score", "overall_status", joined("flags").alias("flags"), "requires_review",
        F.size("recommendations").cast("bigint").alias("n_recommendations"))


@query("conformity_summary", """
SELECT count(*) AS total_contracts, count(*) FILTER (final = 'CONFORME') AS conformes, count(*) FILTER (final = 'PARCIAL') AS parciais,
  count(*) FILTER (final = 'NÃO CONFORME') AS nao_conformes, count(*) FILTER (final = 'INCOMPLETE') AS incomplete,
  round(avg(score), 2) AS average_score, count(*) FILTER (len(flags) > 0) AS flagged_count, count(*) AS fallback_usage FROM k_conformity""")
def conformity_summary(t):
    return S.conformity_summary(t.conformity)


@query("export_conformity_csv", f"""
SELECT processo_id, level AS agreement_level, v1 AS "R001", v2 AS "R002", v3 AS "R003", v4 AS "R004",
  CAST(score AS DOUBLE) AS conformity_score, final AS overall_status, {joined_list('flags')} AS flags FROM k_conformity""")
def export_conformity_csv(t):
    return S.conformity_export(t.conformity)


# -- alerts -----------------------------------------------------------------------
@query("alert_join", """
SELECT processo_id, final AS overall_status, review_reason, len(bad) AS details, v1 AS r001, v2 AS r002 FROM k_conformity""")
def alert_join(t):
    c = F.col("context")
    return A.alert_join(t.conformity.drop("context"), t.compliance).select(
        KEY, "overall_status", c["review_reason"].alias("review_reason"),
        F.size(c["divergence_detail"]).cast("bigint").alias("details"),
        c["r001"].alias("r001"), c["r002"].alias("r002"))


@query("failed_rules", f"SELECT processo_id, {joined_list('failed')} AS failed_rules FROM k_alerts")
def failed_rules(t):
    return t.alerts.select(KEY, joined("failed_rules").alias("failed_rules"))


@query("classify_alert", f"""
SELECT processo_id, alert_level, reason, action, final AS overall_status, CAST(score AS DOUBLE) AS conformity_score,
  {joined_list('flags')} AS flags, {joined_list('failed')} AS failed_rules,
  CASE reason WHEN 'MISSING_PUBLICATION' THEN '"' || review_reason || '"' WHEN 'CONFORME' THEN '"conforme"'
    WHEN 'NON_CONFORME' THEN '{{"r001":"' || v1 || '","r002":"' || v2 || '"}}'
    WHEN 'NEEDS_REVIEW' THEN '{{"agreement_level":"' || level || '","requires_review":' || review || '}}' END AS evidence
FROM k_alerts""")
def classify_alert(t):
    d = F.col("reason_details")
    return t.alerts.select(
        KEY, "alert_level", "reason", d["action"].alias("action"), "overall_status",
        "conformity_score", joined("flags").alias("flags"), joined("failed_rules").alias("failed_rules"),
        F.when(F.col("reason") != "DIAGNOSTIC_DIVERGENCE", d["evidence"]).alias("evidence"))


@query("alerts_by_reason", "SELECT reason, count(*) AS n FROM k_alerts GROUP BY reason")
def alerts_by_reason(t):
    return A.alerts_by_reason(t.alerts)


_PCT = "CASE WHEN count(*) > 0 THEN round(count(*) FILTER (alert_level = '{}') / count(*) * 100.0, 2) ELSE 0.0 END AS {}_pct"
_FAILED = ", ".join(f"count(*) FILTER (list_contains(failed, '{r}')) AS \"failed_{r}\"" for r in K.RULES)


@query("executive_summary", f"""
SELECT count(*) AS total_contracts, count(*) FILTER (alert_level = 'OK') AS ok, count(*) FILTER (alert_level = 'REVIEW') AS review,
  count(*) FILTER (alert_level = 'FAILED') AS failed, {_FAILED}, {_PCT.format('OK', 'ok')}, {_PCT.format('REVIEW', 'review')},
  {_PCT.format('FAILED', 'failed')} FROM k_alerts""")
def executive_summary(t):
    return A.executive_summary(t.alerts)


@query("alert_percent", f"""
SELECT {_PCT.format('OK', 'ok')}, {_PCT.format('REVIEW', 'review')}, {_PCT.format('FAILED', 'failed')} FROM k_alerts""")
def alert_percent(t):
    return A.executive_summary(t.alerts).select("ok_pct", "review_pct", "failed_pct")


@query("alerts_summary", """
SELECT count(*) AS total_contracts, count(*) FILTER (alert_level = 'OK') AS ok, count(*) FILTER (alert_level = 'REVIEW') AS review,
  count(*) FILTER (alert_level NOT IN ('OK', 'REVIEW')) AS failed, count(*) FILTER (alert_level <> 'OK') AS queue_size FROM k_alerts""")
def alerts_summary(t):
    return A.alerts_summary(t.alerts)


@query("alert_run_summary", f"""
SELECT t.*, r.by_reason, h.top_priority FROM (
 SELECT count(*) AS total_contracts, count(*) FILTER (alert_level = 'OK') AS ok, count(*) FILTER (alert_level = 'REVIEW') AS review,
  count(*) FILTER (alert_level NOT IN ('OK', 'REVIEW')) AS failed, count(*) FILTER (alert_level <> 'OK') AS queue_size,
  {_FAILED}, {_PCT.format('OK', 'ok')}, {_PCT.format('REVIEW', 'review')}, {_PCT.format('FAILED', 'failed')} FROM k_alerts) t,
 (SELECT string_agg(reason || '=' || n, '|' ORDER BY reason) AS by_reason FROM (
  SELECT reason, count(*) AS n FROM k_alerts GROUP BY reason) x) r,
 (SELECT string_agg(processo_id, '|' ORDER BY prio, score, processo_id) AS top_priority FROM (
  SELECT * FROM k_queue ORDER BY prio, score, processo_id LIMIT 5) y) h""")
def alert_run_summary(t):
    reasons = F.transform("by_reason", lambda r: F.concat_ws("=", r["reason"], r["n"]))
    return A.alert_run_summary(t.alerts).withColumns(
        {"by_reason": F.array_join(reasons, "|"), "top_priority": F.array_join("top_priority", "|")})


_QUEUE = f"""processo_id, alert_level, reason, CAST(score AS DOUBLE) AS conformity_score, {joined_list('failed')} AS failed_rules,
  {joined_list('flags')} AS flags, action, CAST(prio * 1000.0 - score AS DOUBLE) AS priority_score"""


@query("alert_queue", f"SELECT {_QUEUE} FROM k_queue ORDER BY prio, score, processo_id")
def alert_queue(t):
    return A.queue_export(t.alerts).orderBy(*A.queue_order())


@query("export_queue_csv", f"SELECT {_QUEUE} FROM k_queue")
def export_queue_csv(t):
    return A.queue_export(t.alerts)


@query("export_alerts_csv", f"""
SELECT processo_id, alert_level, reason, final AS overall_status, CAST(score AS DOUBLE) AS conformity_score,
  {joined_list('flags')} AS flags, {joined_list('failed')} AS failed_rules FROM k_alerts""")
def export_alerts_csv(t):
    return A.alert_export(t.alerts)


@query("queue_top5", f"SELECT {_QUEUE} FROM k_queue ORDER BY prio, score, processo_id LIMIT 5")
def queue_top5(t):
    return A.queue_top(t.alerts).withColumns({n: joined(n) for n in ("flags", "failed_rules")})


@query("queue_rank", """
SELECT processo_id, alert_level, CAST(score AS DOUBLE) AS conformity_score,
  row_number() OVER (ORDER BY prio, score, processo_id) AS queue_rank FROM k_queue""")
def queue_rank(t):
    queue = A.alert_queue(t.alerts).select(KEY, "alert_level", "conformity_score")
    return global_rank(queue, A.queue_order(), "queue_rank")


@query("all_alerts_ordered", """
SELECT processo_id, alert_level, row_number() OVER (ORDER BY alert_level = 'OK',
  CASE WHEN alert_level = 'FAILED' THEN 1 WHEN alert_level = 'REVIEW' THEN 2 END,
  CASE WHEN alert_level <> 'OK' THEN score END, processo_id) AS position FROM k_alerts""")
def all_alerts_ordered(t):
    ok = F.col("alert_level") == "OK"
    order = [
        ok.cast("int"),
        F.when(~ok, A.level_priority(F.col("alert_level"))),
        F.when(~ok, F.col("conformity_score")),
        F.col(KEY),
    ]
    alerts = t.alerts.select(KEY, "alert_level", "conformity_score")
    early = alerts.where(F.pmod(F.xxhash64(KEY), F.lit(20)) == 0).withColumn("alert_level", F.lit("FAILED"))
    last = last_per_process(written(early, 1).unionByName(written(alerts, 2)))
    ranked = global_rank(last, order, "position")
    return ranked.select(KEY, "alert_level", "position")


@query("queue_plus_ok", """
SELECT 1 AS block, processo_id, alert_level FROM k_alerts WHERE alert_level <> 'OK'
UNION ALL SELECT 2 AS block, processo_id, alert_level FROM k_alerts WHERE alert_level = 'OK'""")
def queue_plus_ok(t):
    queue = A.alert_queue(t.alerts).select(F.lit(1).alias("block"), KEY, "alert_level")
    tail = t.alerts.where("alert_level = 'OK'").select(F.lit(2).alias("block"), KEY, "alert_level")
    return queue.unionByName(tail)


@query("alert_level_lookup", """
SELECT c.processo_id, coalesce(a.alert_level, '') AS alert_level FROM seed c2
JOIN (SELECT pid AS processo_id FROM seed) c ON c.processo_id = c2.pid LEFT JOIN k_alerts a ON a.processo_id = c.processo_id""")
def alert_level_lookup(t):
    levels = t.alerts.select(KEY, "alert_level")
    pids = t.view("seed").select(F.col("pid").alias(KEY))
    return pids.join(levels, KEY, "left").select(
        KEY, F.coalesce("alert_level", F.lit("")).alias("alert_level"))
