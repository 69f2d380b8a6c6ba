"""Queries over discovery: links, suppliers, identifiers and search hits."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from pactum import constants as K
from pactum.functions.gazette import (
    classify_content,
    contains_id,
    matched_variation,
    publication_metadata,
)
from pactum.functions.ids import (
    company_id,
    detect_format,
    find_cnpj,
    id_variations,
    normalise_pid,
    pid_from_file_name,
    pid_slashless,
    pid_wordlike,
)
from pactum.functions.money import find_currency
from pactum.functions.text import clean_text, strip
from pactum.operators import discovery as D
from pactum.operators.id_search import ids_in_texts
from pactum.plans.registry import query
from pactum.session import checkpoint_dir
from pactum.sources.json_arrays import read_array, write_arrays

KEY = "processo_id"

_PIDS = "SELECT DISTINCT trim(processo_id) AS processo_id FROM links WHERE trim(processo_id) <> ''"


@query("scan_discovery_ids", """
SELECT trim(processo_id) AS processo_id, min(pos) AS first_pos FROM links WHERE trim(processo_id) <> '' GROUP BY 1""")
def scan_discovery_ids(t):
    return D.discovered_ids(t.links)


@query("scan_links", """
SELECT pos, processo_id, url, company_name, company_cnpj, contract_value, path_text AS discovery_path, discovered_at FROM links""")
def scan_links(t):
    return t.links.select(
        "pos", KEY, "url", "company_name", "company_cnpj", "contract_value",
        F.array_join("discovery_path", " > ").alias("discovery_path"), "discovered_at")


@query("scan_document_array", "SELECT pos, processo_id, url, company_name, contract_value, path_text AS discovery_path FROM links")
def scan_document_array(t):
    """Links stored as a few large documents, one array each, and read back in pieces."""
    root = f"{checkpoint_dir(t.spark)}/pactum/{uuid.uuid4().hex}/discovery"
    names = ["pos", KEY, "url", "company_name", "contract_value", "discovery_path"]
    rows = t.links.select(F.pmod(F.xxhash64("pos"), F.lit(4)).alias("document"), *names)
    write_arrays(rows, "document", "pos", root)
    schema = rows.select(*names).schema
    found = read_array(t.spark, f"{root}/document=*/*.txt").where("problem IS NULL")
    return found.select(F.from_json("body", schema).alias("d")).select("d.*").withColumn(
        "discovery_path", F.array_join("discovery_path", " > "))


@query("scan_pids_with_fallback", "SELECT pos, processo_id FROM links WHERE processo_id <> ''")
def scan_pids_with_fallback(t):
    files = t.contracts.select(F.lit(0).cast("bigint").alias("pos"), pid_from_file_name(
        F.concat(pid_wordlike(F.col(KEY)), F.lit("_preprocessed.json"))).alias(KEY))
    return D.first_non_empty(t.links.select("pos", KEY).where(F.col(KEY) != ""), files)


@query("pid_from_file_name", r"""
SELECT processo_id, CASE WHEN regexp_matches(stem, '_\d+$')
    THEN replace(regexp_replace(stem, '_\d+$', ''), '_', '-') || '/' || regexp_extract(stem, '_(\d+)$', 1)
    ELSE replace(stem, '_', '-') END AS rebuilt
FROM (SELECT processo_id, regexp_replace(processo_id, '[^\w\-]', '_', 'g') AS stem FROM contracts) x""")
def q_pid_from_file_name(t):
    name = F.concat(pid_wordlike(F.col(KEY)), F.lit("_preprocessed.json"))
    return t.contracts.select(KEY, pid_from_file_name(name).alias("rebuilt"))


@query("scan_discovery_meta", """
SELECT trim(processo_id) AS processo_id, arg_max(coalesce(company_name, '?'), pos) AS company_name, arg_max(coalesce(company_cnpj, '?'), pos) AS company_cnpj,
  arg_max(contract_value, pos) AS contract_value, arg_max(path_text, pos) AS discovery_path FROM links WHERE trim(processo_id) <> '' GROUP BY 1""")
def scan_discovery_meta(t):
    return D.discovery_metadata(t.links).select(
        KEY, *[F.coalesce(c, F.lit("?")).alias(c) for c in ("company_name", "company_cnpj")],
        "contract_value", F.array_join("discovery_path", " > ").alias("discovery_path"))


@query("scan_pid_filter", "SELECT pid AS processo_id FROM seed WHERE pid = 'GARBAGE-49'")
def scan_pid_filter(t):
    return D.pid_work_item(t.lookups.read_key("links", "GARBAGE-49"), "GARBAGE-49")


@query("scan_discovery_summary", """
SELECT (SELECT count(*) FROM (SELECT DISTINCT coalesce(nullif(company_cnpj, ''), company_name) FROM links WHERE company_name <> '') x) AS total_companies,
  (SELECT count(*) FROM links) AS total_processos, (SELECT count(*) FROM discovery_errors) AS errors_count""")
def scan_discovery_summary(t):
    summary = D.discovery_summary(t.links, t.view("discovery_errors"))
    return D.first_non_empty(summary, summary.limit(0))


@query("scan_embedded_flag", f"SELECT p.processo_id FROM ({_PIDS}) p JOIN contracts c ON c.processo_id = p.processo_id WHERE c.emb_found")
def scan_embedded_flag(t):
    embedded = t.contracts.where("embedded_publication.found").select(KEY)
    return D.discovered_ids(t.links).select(KEY).join(embedded, KEY, "left_semi")


def _grid(t):
    return t.view("grid_rows").select("pos", F.split("cells", r"\|").alias("cells"))


_CELL = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
_NAME = r"regexp_replace(trim(regexp_replace(string_split(cells, '|')[1], '\s+', ' ', 'g')), '^[.\-_]+|[.\-_]+$', '', 'g')"
_CNPJ = (r"coalesce(nullif(regexp_extract(cells, '\d{2}\.\d{3}\.\d{3}/\d{4}-\d{2}'), ''), "
         r"regexp_replace(nullif(regexp_extract(cells, '\b\d{14}\b'), ''), '(\d{2})(\d{3})(\d{3})(\d{4})(\d{2})', '\1.\2.\3/\4-\5'))")
_MONEY = (r"coalesce(nullif(regexp_replace(regexp_extract(cells, 'R\$\s*[\d.,]+'), '\s+', ' ', 'g'), ''), "
          r"'R$ ' || nullif(regexp_extract(cells, '\d{1,3}(?:\.\d{3})*,\d{2}'), ''))")


@query("parse_supplier_rows", f"""
SELECT pos, company_name, company_cnpj, total_value, CASE WHEN company_cnpj <> '' THEN regexp_replace(company_cnpj, '\\D', '', 'g')
   ELSE substr(regexp_replace(upper(company_name), '[^a-zA-Z0-9]', '', 'g'), 1, 30) END AS company_id
FROM (SELECT pos, {_NAME} AS company_name, {_CNPJ} AS company_cnpj, {_MONEY} AS total_value FROM grid_rows
      WHERE contains(cells, '|')) x WHERE length(company_name) > 2""")
def parse_supplier_rows(t):
    return D.supplier_rows(_grid(t))


@query("find_cnpj", f"SELECT pos, {_CNPJ} AS cnpj FROM grid_rows")
def q_find_cnpj(t):
    return t.view("grid_rows").select("pos", find_cnpj(F.col("cells")).alias("cnpj"))


@query("find_currency", f"SELECT pos, {_MONEY} AS amount FROM grid_rows")
def q_find_currency(t):
    return t.view("grid_rows").select("pos", find_currency(F.col("cells")).alias("amount"))


@query("company_id", f"""
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN lpad(CAST(c_custkey AS VARCHAR), 14, '0')
  ELSE substr(regexp_replace(upper(c_name), '[^a-zA-Z0-9]', '', 'g'), 1, 30) END AS company_id FROM customer""")
def q_company_id(t):
    number = F.when(F.col("c_custkey") % 3 == 0, F.lpad(F.col("c_custkey").cast("string"), 14, "0"))
    return t.base("customer").select("c_custkey", company_id(F.col("c_name"), number).alias("company_id"))


@query("clean_text", f"SELECT pos, {_NAME} AS name FROM grid_rows")
def q_clean_text(t):
    return _grid(t).select("pos", clean_text(F.col("cells")[0]).alias("name"))


_PAYEE = """
SELECT pos, upper(regexp_replace(CASE WHEN contains(payee, ' - ') THEN trim(split_part(payee, ' - ', 1))
    ELSE upper(substr(regexp_replace(payee, '[^A-Za-z0-9]', '', 'g'), 1, 30)) END, '[^A-Za-z0-9]', '', 'g')) AS company_id,
  CASE WHEN contains(payee, ' - ') THEN trim(substr(payee, strpos(payee, ' - ') + 3)) ELSE payee END AS company_name, total
FROM payee_rows WHERE NOT starts_with(upper(payee), 'TOTAL')"""


@query("parse_favorecido", f"""
SELECT company_id, min(pos) AS pos, arg_min(company_name, pos) AS company_name, arg_min(total, pos) AS total_value,
  CASE WHEN length(regexp_replace(company_id, '\\D', '', 'g')) = 14 THEN company_id END AS company_cnpj
FROM ({_PAYEE}) x GROUP BY company_id""")
def parse_favorecido(t):
    return D.payees(t.view("payee_rows"))


@query("harvest_contract_rows", """
SELECT r.processo_id, r.url, c.c_name AS company_name, lpad(CAST(r.leaf_id AS VARCHAR), 14, '0') AS company_cnpj, r.total AS contract_value, r.leaf_id
FROM (SELECT leaf_id, processo_id, arg_min(url, scroll * 1000000000 + pos) AS url, arg_min(total, scroll * 1000000000 + pos) AS total FROM leaf_rows
      WHERE processo_id <> '' AND upper(processo_id) <> 'TOTAL' GROUP BY 1, 2) r JOIN customer c ON c.c_custkey = r.leaf_id""")
def harvest_contract_rows(t):
    suppliers = t.base("customer").select(
        F.col("c_custkey").alias("leaf_id"), F.col("c_name").alias("company_name"),
        F.lpad(F.col("c_custkey").cast("string"), 14, "0").alias("company_id"))
    return D.harvest_links(t.view("leaf_rows"), suppliers)


_FIRMS = """
SELECT coalesce(nullif(company_cnpj, ''), company_name) AS company_id, arg_min(company_name, pos) AS company_name,
  arg_min(coalesce(company_cnpj, '?'), pos) AS company_cnpj, arg_min(contract_value, pos) AS total_value,
  count(*) AS total_contracts, min(pos) AS first_pos FROM links WHERE company_name <> '' GROUP BY 1"""


def _firms(t):
    return D.companies_from_links(t.links).withColumn(
        "company_cnpj", F.coalesce("company_cnpj", F.lit("?")))


@query("companies_from_links", _FIRMS)
def companies_from_links(t):
    return _firms(t)


@query("top_companies", f"SELECT * FROM ({_FIRMS}) x ORDER BY total_contracts DESC, first_pos LIMIT 10")
def top_companies(t):
    return D.top_companies(_firms(t))


@query("discovery_summary", """
SELECT (SELECT count(DISTINCT coalesce(nullif(company_cnpj, ''), company_name)) FROM links WHERE company_name <> '') AS total_companies,
  (SELECT count(*) FROM links) AS total_processos, (SELECT count(*) FROM discovery_errors) AS errors_count,
  (SELECT count(*) FROM links) >= 40 AS save""")
def discovery_summary(t):
    return D.keep_discovery(D.discovery_summary(t.links, t.view("discovery_errors")), 40)


@query("discovery_outputs", f"""
SELECT 'links' AS output, count(*) AS n FROM links UNION ALL SELECT 'companies', count(*) FROM ({_FIRMS}) x
UNION ALL SELECT 'errors', count(*) FROM discovery_errors""")
def discovery_outputs(t):
    outputs = {"links": t.links, "companies": _firms(t), "errors": t.view("discovery_errors")}
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(n).alias("output"), "n")
              for n, df in outputs.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("remaining_companies", """
SELECT c_custkey AS company_id, c_name AS company_name FROM customer WHERE c_custkey NOT IN (SELECT company_id FROM finished_suppliers)""")
def remaining_companies(t):
    firms = t.base("customer").select(
        F.col("c_custkey").alias("company_id"), F.col("c_name").alias("company_name"))
    return firms.join(t.view("finished_suppliers"), "company_id", "left_anti")


# -- identifiers --------------------------------------------------------------------------
_FORMAT = r"""CASE WHEN regexp_full_match(pid, '[A-Z]+-[A-Z]+-\d{4}/\d+') THEN 'B' WHEN regexp_full_match(pid, '\d+/\d+\.\d+/\d{4}') THEN 'C'
  WHEN regexp_full_match(pid, '\d+\.\d+/\d{4}(-\d+)?') THEN 'A' ELSE 'UNKNOWN' END"""
_SPELL = rf"""
SELECT k, pid, CASE fmt
  WHEN 'A' THEN list_transform([a || '.' || b || '/' || y || c, a || '.' || b || '/' || y, a || b || '/' || y || c, a || b || '/' || y,
     z1 || '/' || y || c, z1 || '/' || y, z2 || '/' || y || c, z2 || '/' || y], lambda v: v)
  WHEN 'B' THEN [pid, replace(pid, '-', ''), replace(replace(pid, '-', ''), '/', '')]
  WHEN 'C' THEN [pid, '0' || pid, replace(pid, '/', '')] ELSE [pid] END AS v FROM (
 SELECT *, regexp_replace(z1, '^0', '') AS z2 FROM (
  SELECT k, pid, {_FORMAT} AS fmt, split_part(pid, '.', 1) AS a, split_part(split_part(pid, '.', 2), '/', 1) AS b,
    substr(split_part(pid, '/', 2), 1, 4) AS y, regexp_extract(pid, '-\d+$') AS c,
    regexp_replace(split_part(pid, '.', 1) || split_part(split_part(pid, '.', 2), '/', 1), '^0', '') AS z1 FROM seed) p) q"""
_KEEP = "list_filter(v, lambda x, i: list_position(v, x) = i)"


@query("detect_id_format", f"SELECT pid AS processo_id, {_FORMAT} AS format FROM seed")
def detect_id_format(t):
    return t.view("seed").select(F.col("pid").alias(KEY), detect_format(F.col("pid")).alias("format"))


@query("id_variations", f"SELECT pid AS processo_id, array_to_string({_KEEP}, ' ') AS variations FROM ({_SPELL}) s")
def q_id_variations(t):
    return t.view("seed").select(
        F.col("pid").alias(KEY), F.array_join(id_variations(F.col("pid")), " ").alias("variations"))


@query("ordered_dedupe", f"SELECT pid AS processo_id, len({_KEEP}) AS spellings FROM ({_SPELL}) s")
def ordered_dedupe(t):
    return t.view("seed").select(
        F.col("pid").alias(KEY), F.size(id_variations(F.col("pid"))).cast("bigint").alias("spellings"))


@query("normalise_pid", "SELECT processo_id AS pid, processo_id AS core FROM contracts")
def q_normalise_pid(t):
    suffixed = F.concat(F.col(KEY), F.lit(".- CO 01/2024"))
    return t.contracts.select(F.col(KEY).alias("pid"), normalise_pid(suffixed).alias("core"))


@query("sanitize_pid", r"""
SELECT pid AS processo_id, replace(replace(pid, '/', '_'), '\', '_') AS slashless, regexp_replace(pid, '[^\w\-]', '_', 'g') AS wordlike FROM seed""")
def sanitize_pid(t):
    p = F.col("pid")
    return t.view("seed").select(
        p.alias(KEY), pid_slashless(p).alias("slashless"), pid_wordlike(p).alias("wordlike"))


@query("variation_match", f"""
SELECT processo_id, document_index, hit <> '' AS found, hit = '' AS possible_mismatch, hit AS matched_variation FROM (
 SELECT d.processo_id, d.document_index, coalesce(list_filter({_KEEP}, lambda x: contains(lower(d.raw_text), lower(x)))[1], '') AS hit
 FROM gazette_docs d JOIN ({_SPELL}) s ON s.pid = d.processo_id) y""")
def variation_match(t):
    hit = matched_variation(F.col("raw_text"), id_variations(F.col(KEY)))
    return t.gazette_docs.select(KEY, "document_index", hit.alias("matched_variation")).select(
        KEY, "document_index", (F.col("matched_variation") != "").alias("found"),
        (F.col("matched_variation") == "").alias("possible_mismatch"), "matched_variation")


_PAGES = "SELECT processo_id || '#' || document_index AS page, raw_text FROM gazette_docs"


@query("variation_match_any", f"""
SELECT page, id, matched_variation FROM (
 SELECT page, id, v AS matched_variation, row_number() OVER (PARTITION BY page, id ORDER BY nth) AS rn FROM (
  SELECT DISTINCT page, lower(raw_text) AS body, substr(lower(raw_text), unnest(range(1, length(raw_text) + 1)), 8) AS start
  FROM ({_PAGES}) d) g
 JOIN (SELECT pid AS id, unnest(list_transform(keep, lambda x: lower(x))) AS v, unnest(range(len(keep))) AS nth
   FROM (SELECT DISTINCT pid, {_KEEP} AS keep FROM ({_SPELL}) s) k) w ON g.start = left(w.v, 8) AND contains(g.body, w.v)) y
WHERE rn = 1""")
def variation_match_any(t):
    """Every process identifier in every gazette text, not only in those of its own process."""
    page = F.concat(KEY, F.lit("#"), F.col("document_index").cast("string"))
    texts = t.gazette_docs.select(page.alias("page"), "raw_text")
    return ids_in_texts(texts, t.view("seed").select(F.col("pid").alias(KEY)), "page", "raw_text")


@query("literal_id_in_text", "SELECT processo_id, document_index, contains(lower(raw_text), lower(processo_id)) AS found FROM gazette_docs")
def literal_id_in_text(t):
    return t.gazette_docs.select(
        KEY, "document_index", contains_id(F.col("raw_text"), F.col(KEY)).alias("found"))


# -- search hits ---------------------------------------------------------------------------
_HINT = r"""CASE WHEN contains(snippet, 'Processo ' || processo_id || ' 1-Objeto:') AND contains(snippet, '2-Partes:') THEN 'structured_contract'
  WHEN regexp_matches(snippet, '(?i)\b(APROVO|AUTORIZO)\b') THEN 'possible_addendum' ELSE 'unknown' END"""
_META = r"'publicado\s+em:\s*(\d{2}/\d{2}/\d{4})\s*-\s*Edi[cç][aã]o\s+(\d+)\s*-\s*P[áa]g\.\s*(\d+)'"


@query("classify_content", f"SELECT processo_id, page, slot, {_HINT} AS content_hint FROM result_rows")
def q_classify_content(t):
    return t.view("result_rows").select(
        KEY, "page", "slot", classify_content(F.col("snippet"), F.col(KEY)).alias("content_hint"))


@query("parse_pub_metadata", f"""
SELECT processo_id, page, slot, regexp_extract(meta_text, {_META}, 1) AS publication_date, regexp_extract(meta_text, {_META}, 2) AS edition_number,
  regexp_extract(meta_text, {_META}, 3) AS page_number FROM result_rows""")
def parse_pub_metadata(t):
    return t.view("result_rows").withColumn("m", publication_metadata(F.col("meta_text"))).select(
        KEY, "page", "slot", "m.publication_date", "m.edition_number", "m.page_number")


@query("first_hit_search", """
SELECT r.processo_id, r.page, r.slot, r.variation_rank FROM result_rows r JOIN
 (SELECT processo_id, min(variation_rank) AS best FROM result_rows GROUP BY 1) b ON b.processo_id = r.processo_id AND b.best = r.variation_rank""")
def first_hit_search(t):
    return D.first_variation_hits(t.view("result_rows")).select(KEY, "page", "slot", "variation_rank")


@query("collect_search_hits", f"""
SELECT processo_id, page, slot, row_number() OVER (PARTITION BY processo_id ORDER BY page, slot) AS document_index,
  count(*) OVER (PARTITION BY processo_id) AS total_documents, regexp_extract(meta_text, {_META}, 1) AS publication_date,
  regexp_extract(meta_text, {_META}, 2) AS edition_number, regexp_extract(meta_text, {_META}, 3) AS page_number, {_HINT} AS content_hint FROM result_rows""")
def collect_search_hits(t):
    return D.search_hits(t.view("result_rows"))


@query("document_index", """
SELECT processo_id, page, slot, row_number() OVER (PARTITION BY processo_id ORDER BY page, slot) AS document_index FROM result_rows""")
def document_index(t):
    from pactum.operators.ranking import running_index

    rows = t.view("result_rows").select(KEY, "page", "slot")
    return running_index(rows, KEY, "page", "slot", "document_index", "n").drop("n")


@query("pid_list", f"{_PIDS} ORDER BY 1")
def pid_list(t):
    return D.discovered_ids(t.links).select(KEY).orderBy(KEY)
