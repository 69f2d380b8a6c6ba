"""Discovery stage: identifiers, links, suppliers and search hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactum.functions.gazette import classify_content, publication_metadata
from pactum.functions.ids import company_id, find_cnpj
from pactum.functions.money import find_currency
from pactum.functions.text import clean_text, filled, strip, truthy
from pactum.operators.ranking import pick_first, pick_last, running_index

KEY = "processo_id"


def discovered_ids(links: DataFrame) -> DataFrame:
    """Distinct identifiers with the position of their first link."""
    pid = strip(F.col(KEY))
    return (
        links.select(pid.alias(KEY), "pos")
        .where(truthy(F.col(KEY)))
        .groupBy(KEY)
        .agg(F.min("pos").alias("first_pos"))
    )


def discovery_metadata(links: DataFrame) -> DataFrame:
    """Supplier data per identifier; the last link wins."""
    rows = links.select(
        strip(F.col(KEY)).alias(KEY), "pos", "company_name", "company_cnpj", "contract_value",
        "discovery_path",
    ).where(truthy(F.col(KEY)))
    return pick_last(rows, [KEY], F.col("pos")).drop("pos")


def first_non_empty(primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """The primary source, or the fallback where the primary has no row."""
    return fallback if primary.isEmpty() else primary


def pid_work_item(pids: DataFrame, pid: str) -> DataFrame:
    """One identifier as a work item, also when discovery does not know it."""
    wanted = pids.select(KEY).where(F.col(KEY) == pid)
    asked = pids.sparkSession.range(1).select(F.lit(pid).alias(KEY))
    return wanted.unionByName(asked).distinct()


def first_cell(cells: Column, find) -> Column:
    found = F.filter(F.transform(cells, lambda c: find(strip(c))), lambda x: x.isNotNull())
    return F.try_element_at(found, F.lit(1))


def supplier_rows(grid: DataFrame) -> DataFrame:
    """Grid rows (``cells``: array of texts) as suppliers; unusable rows are left out."""
    cells = F.col("cells")
    return (
        grid.where(F.size(cells) >= 2)
        .select(
            "pos",
            clean_text(cells[0]).alias("company_name"),
            first_cell(cells, find_cnpj).alias("company_cnpj"),
            first_cell(cells, find_currency).alias("total_value"),
        )
        .where(F.length("company_name") > 2)
        .withColumn("company_id", company_id(F.col("company_name"), F.col("company_cnpj")))
    )


def payees(rows: DataFrame) -> DataFrame:
    """``<id> - <name>`` grid rows as suppliers, the first row per identifier."""
    payee = strip(F.col("payee"))
    parts = F.split(payee, " - ", 2)
    alnum = F.regexp_replace(payee, "[^A-Za-z0-9]", "")
    separated = F.size(parts) == 2
    raw_id = F.when(separated, strip(parts[0])).otherwise(F.upper(F.substring(alnum, 1, 30)))
    name = F.when(separated, strip(F.get(parts, F.lit(1)))).otherwise(payee)
    parsed = (
        rows.where(truthy(payee) & ~F.upper(payee).startswith("TOTAL"))
        .select("pos", raw_id.alias("_id"), name.alias("company_name"),
                strip(F.col("total")).alias("total_value"))
        .where(truthy(F.col("_id")) & truthy(F.col("company_name")))
        .select(
            "pos",
            F.upper(F.regexp_replace("_id", "[^A-Za-z0-9]", "")).alias("company_id"),
            "company_name",
            "total_value",
        )
    )
    digits = F.length(F.regexp_replace("company_id", r"\D", ""))
    return pick_first(parsed, ["company_id"], F.col("pos")).withColumn(
        "company_cnpj", F.when(digits == 14, F.col("company_id")))


def harvest_links(leaf_rows: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Contract rows of each supplier leaf, each identifier once per leaf."""
    rows = leaf_rows.withColumn(KEY, strip(F.col(KEY))).where(
        truthy(F.col(KEY)) & (F.upper(KEY) != "TOTAL"))
    first = pick_first(rows, ["leaf_id", KEY], F.struct("scroll", "pos")).drop("scroll")
    return first.join(suppliers, "leaf_id", "left").select(
        KEY, strip(F.col("url")).alias("url"), "company_name",
        F.regexp_replace("company_id", r"\D", "").alias("company_cnpj"),
        F.coalesce("total", F.lit("")).alias("contract_value"), "leaf_id")


def companies_from_links(links: DataFrame) -> DataFrame:
    """Suppliers of the links: first data seen, contract count, first position."""
    cnpj, name = filled(F.col("company_cnpj")), F.col("company_name")
    first = F.min_by(F.struct("company_name", "company_cnpj", "contract_value"), F.col("pos"))
    return (
        links.where(truthy(name))
        .groupBy(F.coalesce(cnpj, name).alias("company_id"))
        .agg(F.count("*").alias("total_contracts"), first.alias("_f"),
             F.min("pos").alias("first_pos"))
        .select("company_id", F.col("_f.company_name"), F.col("_f.company_cnpj"),
                F.col("_f.contract_value").alias("total_value"), "total_contracts", "first_pos")
    )


def top_companies(companies: DataFrame, n: int = 10) -> DataFrame:
    return companies.orderBy(F.desc("total_contracts"), "first_pos").limit(n)


def discovery_summary(links: DataFrame, errors: DataFrame) -> DataFrame:
    """Totals of a discovery run, as one row."""
    found = links.agg(F.count("*").alias("total_processos"))
    firms = companies_from_links(links).agg(F.count("*").alias("total_companies"))
    failed = errors.agg(F.count("*").alias("errors_count"))
    parts = [
        frame.select(F.lit(name).alias("name"), F.col(name).alias("n"))
        for frame, name in ((firms, "total_companies"), (found, "total_processos"),
                            (failed, "errors_count"))
    ]
    stacked = parts[0].unionByName(parts[1]).unionByName(parts[2])
    names = ["total_companies", "total_processos", "errors_count"]
    return stacked.agg(*[F.max(F.when(F.col("name") == n, F.col("n"))).alias(n) for n in names])


def keep_discovery(summary: DataFrame, minimum: int) -> DataFrame:
    """Guard against saving a run that found fewer contracts than plausible."""
    return summary.withColumn("save", F.col("total_processos") >= minimum)


def first_variation_hits(rows: DataFrame) -> DataFrame:
    """All hits of the first spelling that had any, per process."""
    best = rows.groupBy(KEY).agg(F.min("variation_rank").alias("variation_rank"))
    return rows.join(best, [KEY, "variation_rank"], "left_semi")


def search_hits(rows: DataFrame) -> DataFrame:
    """Result rows as hits with a running index over pages."""
    meta = publication_metadata(F.col("meta_text"))
    numbered = running_index(rows, KEY, "page", "slot", "document_index", "total_documents")
    return numbered.withColumn("_meta", meta).select(
        KEY, "page", "slot", "document_index", "total_documents",
        F.col("_meta.publication_date"), F.col("_meta.edition_number"),
        F.col("_meta.page_number"),
        classify_content(F.col("snippet"), F.col(KEY)).alias("content_hint"))
