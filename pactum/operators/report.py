"""Report rows, aggregates, sheets and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactum import constants as K
from pactum.functions.dates import parse_dmy
from pactum.functions.text import text_or_blank
from pactum.operators.ranking import last_per_process
from pactum.operators.rules import primary_violation, severity
from pactum.operators.state import missing_phase

KEY = "processo_id"


def report_rows(
    state: DataFrame, conformity: DataFrame, metadata: DataFrame, publications: DataFrame,
    contracts: DataFrame,
) -> DataFrame:
    """One row per discovered process; unscored processes keep blank scores.

    A process that stands on a side more than once counts with its last row, so
    no join multiplies rows.
    """
    conformity, metadata, publications, contracts = map(
        last_per_process, (conformity, metadata, publications, contracts))
    scored = conformity.select(
        KEY, F.lit(True).alias("is_scored"), "score_breakdown", "overall_status",
        "conformity_score", "flags", "recommendations", "requires_review",
        F.col("diagnostic.agreement_level").alias("agreement_level"))
    joined = (
        state.join(scored, KEY, "left")
        .join(metadata.select(KEY, "company_name", "contract_value"), KEY, "left")
        .join(publications.select(KEY, "publication_date"), KEY, "left")
        .join(contracts.select(KEY, F.col("header.signing_date").alias("contract_date")), KEY, "left")
    )
    none = F.array().cast("array<string>")
    score = F.coalesce("conformity_score", F.lit(0.0))
    breakdown = F.col("score_breakdown")
    verdicts = {r: text_or_blank(breakdown[r]["verdict"]) for r in K.RULES}
    return joined.select(
        KEY, "pid_safe", "pipeline_stage",
        *[text_or_blank(F.col(c)).alias(c)
          for c in ("company_name", "contract_value", "contract_date", "publication_date")],
        F.datediff(parse_dmy(F.col("publication_date")), parse_dmy(F.col("contract_date"))).alias(
            "days_to_publish"),
        text_or_blank(F.col("overall_status")).alias("overall_status"),
        score.alias("conformity_score"),
        text_or_blank(F.col("agreement_level")).alias("agreement_level"),
        *[F.coalesce(breakdown[r]["score"], F.lit(0.0)).alias(f"{r}_score") for r in K.RULES],
        *[verdicts[r].alias(f"{r}_verdict") for r in K.RULES],
        F.coalesce("flags", none).alias("flags"),
        F.coalesce("recommendations", none).alias("recommendations"),
        F.coalesce("requires_review", F.lit(False)).alias("requires_review"),
        primary_violation(verdicts).alias("primary_violation"),
        severity(score).alias("severity"),
        "error_flag", "has_raw", "has_pub_raw", "has_preprocessed", "has_pub_structured",
        F.coalesce("is_scored", F.lit(False)).alias("is_scored"),
    )


def _rate(part, whole):
    return F.when(whole > 0, part / whole).otherwise(0.0)


def aggregate_report(rows: DataFrame) -> DataFrame:
    """Coverage, status counts, rates and rule means, in one pass."""
    scored, status = F.col("is_scored"), F.col("overall_status")
    sums = rows.agg(
        F.count("*").alias("total_discovered"),
        F.count_if("has_raw").alias("total_extracted"),
        F.count_if("has_pub_raw").alias("total_pub_found"),
        F.count_if(F.col("has_preprocessed") & F.col("has_pub_structured")).alias(
            "total_preprocessed"),
        F.count_if(scored).alias("total_analyzed"),
        *[F.count_if(scored & (status == s)).alias(f"n_{i}") for i, s in enumerate(K.STATUSES)],
        F.coalesce(F.sum(F.when(scored, F.col("conformity_score"))), F.lit(0.0)).alias("_scores"),
        *[F.coalesce(F.sum(F.when(scored, F.col(f"{r}_score"))), F.lit(0.0)).alias(f"_{r}")
          for r in K.RULES],
    )
    return rates(sums)


def rates(sums: DataFrame) -> DataFrame:
    """The report of one row of counts (``total_…``, ``n_…``) and sums (``_scores``, ``_R…``)."""
    analyzed = F.col("total_analyzed")
    return sums.select(
        "total_discovered", "total_extracted", "total_pub_found", "total_preprocessed",
        "total_analyzed",
        _rate(analyzed, F.col("total_discovered")).alias("coverage_rate"),
        *[F.col(f"n_{i}").alias(s) for i, s in enumerate(K.STATUSES)],
        _rate(F.col("n_0"), analyzed).alias("overall_conformity_rate"),
        _rate(F.col("_scores"), analyzed).alias("average_score"),
        *[_rate(F.col(f"_{r}"), analyzed).alias(r) for r in K.RULES],
    )


def top_flags(rows: DataFrame, n: int = 10) -> DataFrame:
    """Most frequent flags; ties by name."""
    return (
        rows.select(F.explode("flags").alias("flag"))
        .groupBy("flag")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "flag")
        .limit(n)
    )


def analytics_filter(
    rows: DataFrame, statuses: list[str], company: str = "", low: float = 0, high: float = 100
) -> DataFrame:
    kept = rows.where(F.col("overall_status").isin(*statuses)).where(
        F.col("conformity_score").between(low, high))
    if company:
        kept = kept.where(F.contains(F.lower("company_name"), F.lit(company.lower())))
    return kept


def analytics_view(rows: DataFrame) -> DataFrame:
    return rows.select(
        KEY, "company_name", "contract_value", "overall_status", "conformity_score",
        "pipeline_stage")


def report_export(rows: DataFrame, generated_at: str) -> DataFrame:
    """The nineteen-column export, all text."""
    return rows.select(
        KEY, "agreement_level",
        *[F.col(f"{r}_verdict").alias(r) for r in K.RULES],
        F.col("conformity_score").cast("string").alias("conformity_score"),
        "overall_status",
        F.array_join("flags", "|").alias("flags"),
        "pipeline_stage", "company_name", "contract_value", "contract_date", "publication_date",
        text_or_blank(F.col("days_to_publish").cast("string")).alias("days_to_publish"),
        "primary_violation", "severity",
        F.when(F.col("requires_review"), "TRUE").otherwise("FALSE").alias("requires_review"),
        F.lit(generated_at).alias("report_generated_at"),
    ).select(*K.REPORT_CSV_COLUMNS)


# -- sheets -----------------------------------------------------------------------------
def detail_sheet(rows: DataFrame) -> DataFrame:
    source = [
        F.col(KEY), F.col("company_name"), F.col("contract_value"), F.col("overall_status"),
        F.col("conformity_score"), F.col("agreement_level"),
        *[F.col(f"{r}_verdict") for r in K.RULES],
        F.col("days_to_publish"), F.col("primary_violation"), F.col("severity"),
        F.col("requires_review"), F.array_join("flags", ", "),
    ]
    return rows.select(*[c.alias(n) for c, n in zip(source, K.DETAIL_SHEET_COLUMNS)])


def non_conforming(rows: DataFrame, alerts: DataFrame) -> DataFrame:
    levels = alerts.select(KEY, "alert_level")
    return rows.join(levels, KEY, "left").where(
        F.col("overall_status").isin("NÃO CONFORME", "PARCIAL")
        | F.coalesce(F.col("alert_level") == "FAILED", F.lit(False))).drop("alert_level")


def incomplete_sheet(rows: DataFrame) -> DataFrame:
    stage = F.col("pipeline_stage")
    return rows.where(~stage.isin("SCORED", "COMPLIANCE")).select(
        F.col(KEY).alias("Processo ID"), F.col("company_name").alias("Empresa"),
        stage.alias("Etapa Pipeline"), missing_phase(stage).alias("Fase Faltante"))


def error_sheet(rows: DataFrame) -> DataFrame:
    return rows.where("error_flag").select(
        F.col(KEY).alias("Processo ID"), F.col("company_name").alias("Empresa"),
        F.col("pipeline_stage").alias("Etapa Pipeline"), F.col("error_flag").alias("Flag de Erro"))


def metrics_sheet(
    report: DataFrame, generated_at: str, analyst: str = "", version: str = "1.0.0"
) -> DataFrame:
    """Eighteen metric/value rows of the aggregate report."""

    def one(name: str):
        return F.format_string("%.1f", F.col(name))

    def percent(name: str):
        return F.format_string("%.1f%%", F.col(name) * 100)

    def whole(name: str):
        return F.col(name).cast("string")

    pairs = [
        ("Relatório gerado em", F.lit(generated_at)), ("Analista", F.lit(analyst or "Sistema")),
        ("Versão", F.lit(version)),
        ("Contratos Descobertos", whole("total_discovered")),
        ("Contratos Extraídos", whole("total_extracted")),
        ("Publicações Encontradas", whole("total_pub_found")),
        ("Contratos Analisados", whole("total_analyzed")),
        ("Taxa de Cobertura", percent("coverage_rate")),
        ("Taxa de Conformidade", percent("overall_conformity_rate")),
        ("Score Médio", one("average_score")),
        *[(s, whole(s)) for s in K.STATUSES],
        *[(f"Média {r}", one(r)) for r in K.RULES],
    ]
    cells = F.array(*[F.struct(F.lit(n).alias("metrica"), v.alias("valor")) for n, v in pairs])
    return report.select(F.inline(cells))


def metadata_sheet(
    report: DataFrame, generated_at: str, analyst: str = "", system: str = "pactum"
) -> DataFrame:
    pairs = [
        ("Sistema", F.lit(system)),
        ("Analista", F.lit(analyst or "Sistema")), ("Data de Geração", F.lit(generated_at)),
        ("Total de Contratos", F.col("total_discovered").cast("string")),
        ("Contratos Analisados", F.col("total_analyzed").cast("string")),
    ]
    cells = F.array(*[F.struct(F.lit(n).alias("parametro"), v.alias("valor")) for n, v in pairs])
    return report.select(F.inline(cells))
