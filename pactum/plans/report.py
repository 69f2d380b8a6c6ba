"""Queries over the state index and the report."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from pactum import constants as K
from pactum.functions.dates import parse_dmy
from pactum.operators import report as P
from pactum.operators import report_totals as T
from pactum.operators import state as S
from pactum.operators.rules import primary_violation as first_failure
from pactum.operators.rules import severity as severity_of
from pactum.plans.check_sql import CHECK_VIEWS, joined_list
from pactum.plans.registry import QUERIES, query
from pactum.session import checkpoint_dir
from pactum.sources.snapshots import Snapshots

KEY = "processo_id"
GENERATED = "2026-01-31T12:00:00"


_HAS = [f"has_{a}" for a in K.ARTIFACTS]


@query("state_index_join", f"SELECT pid_safe, processo_id, pipeline_stage, {', '.join(_HAS)}, error_flag, n_links FROM k_state")
def state_index_join(t):
    return t.state


@query("pipeline_stage", "SELECT processo_id, pipeline_stage FROM k_state")
def pipeline_stage(t):
    return t.state.select(KEY, "pipeline_stage")


@query("error_flag", "SELECT processo_id, error_flag FROM k_state")
def error_flag(t):
    return t.state.select(KEY, "error_flag")


_STAGE_ROWS = ", ".join(f"('{s}')" for s in K.STAGES)


@query("stage_counts", f"""
SELECT s.stage AS pipeline_stage, CAST(coalesce(sum(k.n_links), 0) AS BIGINT) AS links, count(k.processo_id) AS pids
FROM (VALUES {_STAGE_ROWS}) s(stage) LEFT JOIN k_state k ON k.pipeline_stage = s.stage GROUP BY s.stage""")
def stage_counts(t):
    return S.stage_counts(t.state)


_PHASE = "CASE pipeline_stage " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in K.MISSING_PHASE.items()) + " ELSE '' END"


@query("incomplete_contracts", f"""
SELECT processo_id, pipeline_stage, {_PHASE} AS fase_faltante FROM k_state WHERE pipeline_stage NOT IN ('SCORED', 'COMPLIANCE')""")
def incomplete_contracts(t):
    return S.incomplete(t.state)


@query("processo_detail", f"""
SELECT {', '.join(f"max(CASE WHEN artifact = '{a}' THEN body END) AS {a}" for a in K.ARTIFACTS)}
FROM artifact_docs WHERE processo_id = (SELECT pid FROM seed WHERE pid = 'GARBAGE-99')""")
def processo_detail(t):
    return S.process_detail("GARBAGE-99", t.lookups.read_key("artifacts", "GARBAGE-99"))


_BASE = f"""processo_id, pipeline_stage, company_name, contract_value, contract_date, publication_date, days_to_publish,
  overall_status, conformity_score, agreement_level, R001_verdict AS "R001_verdict", R002_verdict AS "R002_verdict",
  R003_verdict AS "R003_verdict", R004_verdict AS "R004_verdict", {joined_list('flags')} AS flags, requires_review, primary_violation, severity, error_flag"""


@query("report_join", f"SELECT {_BASE} FROM k_report")
def report_join(t):
    return _base(t.report_rows)


def _base(rows):
    return rows.select(
        KEY, "pipeline_stage", "company_name", "contract_value", "contract_date", "publication_date",
        F.col("days_to_publish").cast("bigint").alias("days_to_publish"), "overall_status",
        "conformity_score", "agreement_level", *[f"{r}_verdict" for r in K.RULES],
        F.array_join("flags", "|").alias("flags"), "requires_review", "primary_violation", "severity",
        "error_flag")


@query("days_to_publish", "SELECT processo_id, days_to_publish FROM k_report")
def days_to_publish(t):
    pubs = t.publications.select(KEY, "publication_date")
    contracts = t.contracts.select(KEY, F.col("header.signing_date").alias("signed"))
    days = F.datediff(parse_dmy(F.col("publication_date")), parse_dmy(F.col("signed"))).cast("bigint")
    return t.state.select(KEY).join(pubs, KEY, "left").join(contracts, KEY, "left").select(
        KEY, days.alias("days_to_publish"))


@query("primary_violation", """
SELECT processo_id, CASE WHEN v1 = 'FAIL' THEN 'R001' WHEN v2 = 'FAIL' THEN 'R002' WHEN v3 = 'FAIL' THEN 'R003' WHEN v4 = 'FAIL' THEN 'R004' ELSE '' END AS primary_violation
FROM k_conformity""")
def primary_violation(t):
    b = F.col("score_breakdown")
    return t.conformity.select(
        KEY, first_failure({r: b[r]["verdict"] for r in K.RULES}).alias("primary_violation"))


@query("severity", "SELECT processo_id, CASE WHEN score >= 90 THEN 'BAIXA' WHEN score >= 60 THEN 'MÉDIA' ELSE 'ALTA' END AS severity FROM k_conformity")
def severity(t):
    return t.conformity.select(KEY, severity_of(F.col("conformity_score")).alias("severity"))


_COVERAGE = """count(*) AS total_discovered, count(*) FILTER (has_raw) AS total_extracted, count(*) FILTER (has_pub_raw) AS total_pub_found,
  count(*) FILTER (has_preprocessed AND has_pub_structured) AS total_preprocessed, count(*) FILTER (is_scored) AS total_analyzed,
  CASE WHEN count(*) > 0 THEN count(*) FILTER (is_scored) / count(*) ELSE 0.0 END AS coverage_rate"""
_RATES = ", ".join(f"count(*) FILTER (is_scored AND overall_status = '{s}') AS \"{s}\"" for s in K.STATUSES) + """,
  count(*) FILTER (is_scored AND overall_status = 'CONFORME') / count(*) FILTER (is_scored) AS overall_conformity_rate,
  CAST(avg(conformity_score) FILTER (is_scored) AS DOUBLE) AS average_score"""
_MEANS = ", ".join(f"CAST(avg(s{i}) FILTER (is_scored) AS DOUBLE) AS \"R00{i}\"" for i in range(1, 5))


@query("coverage_report", f"SELECT {_COVERAGE} FROM k_report")
def coverage_report(t):
    return P.aggregate_report(t.report_rows).select(
        "total_discovered", "total_extracted", "total_pub_found", "total_preprocessed",
        "total_analyzed", "coverage_rate")


@query("conformity_rates", f"SELECT {_RATES} FROM k_report")
def conformity_rates(t):
    return P.aggregate_report(t.report_rows).select(
        *K.STATUSES, "overall_conformity_rate", "average_score")


@query("rule_averages", f"SELECT {_MEANS} FROM k_report")
def rule_averages(t):
    return P.aggregate_report(t.report_rows).select(*K.RULES)


@query("aggregate_report", f"SELECT {_COVERAGE}, {_RATES}, {_MEANS} FROM k_report")
def aggregate_report(t):
    return P.aggregate_report(t.report_rows)


@query("top_flags", """
SELECT flag, count(*) AS n FROM (SELECT unnest(flags) AS flag FROM k_report) x GROUP BY flag ORDER BY n DESC, flag LIMIT 10""")
def top_flags(t):
    return P.top_flags(t.report_rows)


_WANTED = "overall_status IN ('PARCIAL', 'NÃO CONFORME') AND conformity_score BETWEEN 20 AND 80 AND contains(lower(company_name), '7')"


def _filtered(t):
    return P.analytics_filter(t.report_rows, ["PARCIAL", "NÃO CONFORME"], "7", 20, 80)


@query("analytics_filter", f"SELECT processo_id, overall_status, conformity_score FROM k_report WHERE {_WANTED}")
def analytics_filter(t):
    return _filtered(t).select(KEY, "overall_status", "conformity_score")


@query("analytics_view", "SELECT processo_id, company_name, contract_value, overall_status, conformity_score, pipeline_stage FROM k_report")
def analytics_view(t):
    return P.analytics_view(t.report_rows)


_EXPORT = f"""processo_id, agreement_level, R001_verdict AS "R001", R002_verdict AS "R002", R003_verdict AS "R003", R004_verdict AS "R004",
  CAST(conformity_score AS VARCHAR) AS conformity_score, overall_status, {joined_list('flags')} AS flags, pipeline_stage, company_name, contract_value,
  contract_date, publication_date, coalesce(CAST(days_to_publish AS VARCHAR), '') AS days_to_publish, primary_violation, severity,
  CASE WHEN requires_review THEN 'TRUE' ELSE 'FALSE' END AS requires_review, '{GENERATED}' AS report_generated_at"""


@query("export_report_csv", f"SELECT {_EXPORT} FROM k_report")
def export_report_csv(t):
    return P.report_export(t.report_rows, GENERATED)


@query("export_filtered", f"SELECT {_EXPORT} FROM k_report WHERE {_WANTED}")
def export_filtered(t):
    return P.report_export(_filtered(t), GENERATED)


_DETAIL = ", ".join(f'{e} AS "{n}"' for e, n in zip(
    ["processo_id", "company_name", "contract_value", "overall_status", "conformity_score", "agreement_level",
     "R001_verdict", "R002_verdict", "R003_verdict", "R004_verdict", "days_to_publish", "primary_violation", "severity",
     "requires_review", "coalesce(array_to_string(flags, ', '), '')"], K.DETAIL_SHEET_COLUMNS))


@query("report_sheet_detail", f"SELECT {_DETAIL} FROM k_report")
def report_sheet_detail(t):
    return P.detail_sheet(t.report_rows)


@query("report_sheet_non_conforming", f"""
SELECT {_DETAIL} FROM (SELECT r.*, a.alert_level FROM k_report r LEFT JOIN k_alerts a ON a.processo_id = r.processo_id) x
WHERE overall_status IN ('NÃO CONFORME', 'PARCIAL') OR alert_level = 'FAILED'""")
def report_sheet_non_conforming(t):
    return P.detail_sheet(P.non_conforming(t.report_rows, t.alerts))


@query("non_conforming", """
SELECT r.processo_id, r.overall_status FROM k_report r LEFT JOIN k_alerts a ON a.processo_id = r.processo_id
WHERE r.overall_status IN ('NÃO CONFORME', 'PARCIAL') OR a.alert_level = 'FAILED'""")
def non_conforming(t):
    return P.non_conforming(t.report_rows, t.alerts).select(KEY, "overall_status")


@query("report_sheet_incomplete", f"""
SELECT processo_id AS "Processo ID", company_name AS "Empresa", pipeline_stage AS "Etapa Pipeline", {_PHASE} AS "Fase Faltante"
FROM k_report WHERE pipeline_stage NOT IN ('SCORED', 'COMPLIANCE')""")
def report_sheet_incomplete(t):
    return P.incomplete_sheet(t.report_rows)


@query("report_sheet_errors", """
SELECT processo_id AS "Processo ID", company_name AS "Empresa", pipeline_stage AS "Etapa Pipeline", error_flag AS "Flag de Erro" FROM k_report WHERE error_flag""")
def report_sheet_errors(t):
    return P.error_sheet(t.report_rows)


@query("error_rows", "SELECT processo_id, pipeline_stage FROM k_state WHERE error_flag")
def error_rows(t):
    return t.state.where("error_flag").select(KEY, "pipeline_stage")


CHECK_VIEWS["k_aggregate"] = f"SELECT {_COVERAGE}, {_RATES}, {_MEANS} FROM k_report"


@query("report_sheet_metrics", f"""
SELECT 'Relatório gerado em' AS metrica, '{GENERATED}' AS valor UNION ALL SELECT 'Analista', 'Sistema' UNION ALL SELECT 'Versão', '1.0.0'
UNION ALL SELECT 'Contratos Descobertos', CAST(total_discovered AS VARCHAR) FROM k_aggregate UNION ALL SELECT 'Contratos Extraídos', CAST(total_extracted AS VARCHAR) FROM k_aggregate
UNION ALL SELECT 'Publicações Encontradas', CAST(total_pub_found AS VARCHAR) FROM k_aggregate UNION ALL SELECT 'Contratos Analisados', CAST(total_analyzed AS VARCHAR) FROM k_aggregate
UNION ALL SELECT 'Taxa de Cobertura', printf('%.1f%%', coverage_rate * 100) FROM k_aggregate UNION ALL SELECT 'Taxa de Conformidade', printf('%.1f%%', overall_conformity_rate * 100) FROM k_aggregate
UNION ALL SELECT 'Score Médio', printf('%.1f', average_score) FROM k_aggregate
{' '.join(f"UNION ALL SELECT '{s}', CAST({chr(34)}{s}{chr(34)} AS VARCHAR) FROM k_aggregate" for s in K.STATUSES)}
{' '.join(f"UNION ALL SELECT 'Média {r}', printf('%.1f', {chr(34)}{r}{chr(34)}) FROM k_aggregate" for r in K.RULES)}""")
def report_sheet_metrics(t):
    return P.metrics_sheet(P.aggregate_report(t.report_rows), GENERATED)


@query("report_sheet_metadata", f"""
SELECT 'Sistema' AS parametro, 'pactum' AS valor UNION ALL SELECT 'Analista', 'Sistema' UNION ALL SELECT 'Data de Geração', '{GENERATED}'
UNION ALL SELECT 'Total de Contratos', CAST(count(*) AS VARCHAR) FROM k_report UNION ALL SELECT 'Contratos Analisados', CAST(count(*) FILTER (is_scored) AS VARCHAR) FROM k_report""")
def report_sheet_metadata(t):
    return P.metadata_sheet(P.aggregate_report(t.report_rows), GENERATED)


@query("report_sheets", """
SELECT 'metrics' AS sheet, 18 AS n UNION ALL SELECT 'detail', count(*) FROM k_report
UNION ALL SELECT 'non_conforming', count(*) FROM k_report r LEFT JOIN k_alerts a ON a.processo_id = r.processo_id
  WHERE r.overall_status IN ('NÃO CONFORME', 'PARCIAL') OR a.alert_level = 'FAILED'
UNION ALL SELECT 'incomplete', count(*) FROM k_report WHERE pipeline_stage NOT IN ('SCORED', 'COMPLIANCE')
UNION ALL SELECT 'errors', count(*) FROM k_report WHERE error_flag UNION ALL SELECT 'metadata', 5""")
def report_sheets(t):
    """Rows per sheet of one report; each sheet is a DataFrame of its own."""
    rows = t.report_rows
    aggregate = P.aggregate_report(rows)
    sheets = {
        "metrics": P.metrics_sheet(aggregate, GENERATED),
        "detail": P.detail_sheet(rows),
        "non_conforming": P.detail_sheet(P.non_conforming(rows, t.alerts)),
        "incomplete": P.incomplete_sheet(rows),
        "errors": P.error_sheet(rows),
        "metadata": P.metadata_sheet(aggregate, GENERATED),
    }
    counts = None
    for name, sheet in sheets.items():
        one = sheet.agg(F.count("*").alias("n")).select(F.lit(name).alias("sheet"), "n")
        counts = one if counts is None else counts.unionByName(one)
    return counts


# -- totals kept from changes ---------------------------------------------------------------
def _kept(t) -> Snapshots:
    """Counts after two commits: drafts of some rows and rows of unknown processes come first, the
    second one replaces, adds and drops; made once for a set of tables."""
    if "kept_totals" not in vars(t):
        snapshots = Snapshots(t.spark, f"{checkpoint_dir(t.spark)}/pactum/{uuid.uuid4().hex}/totals", 16)
        rows, turn = t.report_rows, F.pmod(F.xxhash64(KEY), F.lit(10))
        draft = rows.where(turn == 0).withColumns({
            "overall_status": F.lit(K.STATUSES[0]), "conformity_score": F.lit(1.5), "is_scored": F.lit(True),
            "flags": F.array(F.lit("draft"))})
        unknown = rows.where(turn == 1).withColumn(KEY, F.concat(F.lit("unknown "), KEY))
        T.upsert_report(snapshots, rows.where(turn > 1).unionByName(draft).unionByName(unknown))
        T.upsert_report(snapshots, rows.where(turn < 2), unknown)
        t.kept_totals = snapshots
    return t.kept_totals


@query("aggregate_report_kept", QUERIES["aggregate_report"].check)
def aggregate_report_kept(t):
    return T.totals(_kept(t).read(T.COUNTS))


@query("top_flags_kept", QUERIES["top_flags"].check)
def top_flags_kept(t):
    return T.flag_totals(_kept(t).read(T.COUNTS))


@query("report_rows_kept", f"SELECT {_BASE} FROM k_report")
def report_rows_kept(t):
    return _base(_kept(t).read(T.ROWS))
