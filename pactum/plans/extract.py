"""Queries that turn contract and gazette texts into rows."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import functions as F

from pactum import constants as K
from pactum.functions.dates import masthead_date, opening_date
from pactum.functions.gazette import edition_number
from pactum.functions.names import clean_party, split_parties
from pactum.operators import audit as A
from pactum.operators import contract_text as T
from pactum.operators import gazette_text as G
from pactum.operators import requests as Q
from pactum.operators.ranking import pick_first
from pactum.plans.check_sql import CHECK_VIEWS
from pactum.plans.registry import query
from pactum.session import checkpoint_dir
from pactum.sources.snapshots import Snapshots

KEY = "processo_id"


def rx(text: str, pattern: str, group: int = 1, flags: str = "") -> str:
    """A capture in RE2; only group 1 is read, so look-aheads become plain groups."""
    plain = pattern.replace("(?=", "(?:").replace("'", "''").replace(r"(\w+)", r"([\w\pL]+)")
    head = f"(?{flags})" if flags else ""
    return f"nullif(regexp_extract({text}, '{head}{plain}', {group}), '')"


def test(text: str, pattern: str, flags: str = "") -> str:
    head = f"(?{flags})" if flags else ""
    return f"regexp_matches({text}, '{head}{pattern}')"


_MONTHS = " ".join(f"WHEN '{n}' THEN '{m}'" for n, m in K.MONTHS_PT.items())


def prose(text: str, pattern: str, other: str = "NULL") -> str:
    day, year = rx(text, pattern, 1, "i"), rx(text, pattern, 3, "i")
    month = f"(CASE lower({rx(text, pattern, 2, 'i')}) {_MONTHS} ELSE {other} END)"
    return f"(lpad({day}, 2, '0') || '/' || {month} || '/' || {year})"


def trim(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def squeeze(x: str) -> str:
    return trim(f"regexp_replace({x}, '\\s+', ' ', 'g')")


_USABLE = "quality_passes AND raw_text <> ''"
_ZONE = (f"substr(t, strpos(t, {rx('t', K.MASTHEAD_DATE, 0, 'i')}), {K.EDITION_ZONE_CHARS})")
CHECK_VIEWS.update({
    "k_docs": f"""
SELECT processo_id, document_index, content_hint, meta_date, quality_passes, extraction_error, {_USABLE} AS usable,
  CASE WHEN {_USABLE} THEN raw_text END AS t FROM gazette_docs""",
    "k_fields": f"""
SELECT *, {test('t', K.NUMBERED_MARK, 'i')} AS numbered, {trim(rx('t', K.GAZETTE_PROCESSO, 1, 'i'))} AS proc,
  {rx('t', K.GAZETTE_SIGNING)} AS d_label, {rx('t', K.NUMBERED_DATE, 1, 'i')} AS d_number,
  CASE WHEN {test('t', K.NUMBERED_MARK, 'i')} THEN {squeeze(rx('t', K.NUMBERED_PARTIES, 1, 'is'))} ELSE {trim(rx('t', K.LABELLED_PARTIES, 1, 'i'))} END AS parties,
  CASE WHEN {test('t', K.NUMBERED_MARK, 'i')} THEN {rx('t', K.NUMBERED_OBJECT, 1, 'is')} ELSE {rx('t', K.LABELLED_OBJECT, 1, 'is')} END AS subject
FROM k_docs""",
    "k_parsed": f"""
SELECT processo_id, document_index, content_hint, meta_date, usable, quality_passes, extraction_error,
  regexp_replace(coalesce(proc, processo_id), '(?i){K.PID_SUFFIX}', '') AS processo_id_in_text,
  {prose('t', K.MASTHEAD_DATE)} AS masthead,
  CASE WHEN numbered THEN coalesce(d_number, d_label) ELSE coalesce(d_label, d_number) END AS signing_date_in_pub,
  {rx('t', K.GAZETTE_NUMBER, 1, 'i')} AS contract_number,
  coalesce(regexp_replace({rx('parties', K.PARTY_SPLIT, 1, 'is')}, '[.,;]+$', ''), parties) AS contratante,
  regexp_replace({squeeze(rx('parties', K.PARTY_SPLIT, 2, 'is'))}, '[.,;]+$', '') AS contratada,
  substr({squeeze('subject')}, 1, 400) AS object_summary,
  CASE WHEN numbered THEN {rx('t', K.NUMBERED_VALUE, 1, 'i')} ELSE {rx('t', K.LABELLED_VALUE, 1, 'i')} END AS value,
  coalesce({rx(_ZONE, K.EDITION, 1)}, {rx(_ZONE, K.EDITION, 2)}) AS edition,
  CASE WHEN t IS NULL THEN 'unknown' WHEN {test('t', K.GAZETTE_TYPE_ADDENDUM, 'i')} THEN 'addendum' WHEN {test('t', K.GAZETTE_TYPE_CONTRACT, 'i')} THEN 'contract' ELSE 'unknown' END AS document_type
FROM k_fields""",
    "k_dated": """
SELECT *, coalesce(masthead, nullif(meta_date, '')) AS publication_date FROM k_parsed""",
    "k_primary": """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY processo_id ORDER BY content_hint <> 'structured_contract', document_index) AS rn
  FROM k_dated WHERE usable) x WHERE rn = 1""",
})
_NAMES = ("signing_date_in_pub, contract_number, contratante, contratada, object_summary, value, "
          "edition, document_type")


@query("parse_publication", f"SELECT processo_id, document_index, processo_id_in_text, masthead AS publication_date, {_NAMES} FROM k_parsed WHERE usable")
def parse_publication(t):
    docs = t.gazette_docs.where("quality_passes AND raw_text <> ''").select(
        KEY, "document_index", "raw_text")
    return G.parse_gazette(docs).select(
        KEY, "document_index", *[F.col(f"parsed.{n}").alias(n) for n in G.FIELDS])


@query("publication_date_fallback", """
SELECT processo_id, document_index, publication_date, masthead IS NULL AND publication_date IS NOT NULL AS from_metadata FROM k_dated WHERE usable""")
def publication_date_fallback(t):
    warned = F.array_contains("parsed.warnings", "publication_date:from_searcher_metadata")
    return t.parsed_documents.where("skip_reason IS NULL").select(
        KEY, "document_index", F.col("parsed.publication_date").alias("publication_date"),
        warned.alias("from_metadata"))


_COUNTS = "(SELECT processo_id, count(*) AS documents_found, count(*) FILTER (usable) AS documents_parsed FROM k_dated GROUP BY 1)"
_STRUCTURED = f"""
SELECT p.processo_id, '{K.SOURCE_GAZETTE}' AS source, p.document_index AS primary_index, p.publication_date, {_NAMES}, c.documents_found, c.documents_parsed
FROM k_primary p JOIN {_COUNTS} c ON c.processo_id = p.processo_id"""


@query("preprocess_publications", _STRUCTURED)
def preprocess_publications(t):
    return G.consolidate(t.parsed_documents)


@query("consolidate_publications", f"""
SELECT d.processo_id, d.document_index, d.usable, c.documents_found, c.documents_parsed
FROM k_dated d JOIN {_COUNTS} c ON c.processo_id = d.processo_id WHERE c.documents_parsed > 0""")
def consolidate_publications(t):
    header = G.consolidate(t.parsed_documents).select(KEY, "documents_found", "documents_parsed")
    return t.parsed_documents.select(
        KEY, "document_index", F.col("skip_reason").isNull().alias("usable")).join(header, KEY)


_REASON = "CASE WHEN NOT quality_passes THEN coalesce(nullif(extraction_error, ''), 'quality_failed') ELSE 'empty_raw_text' END"


@query("publication_warnings", f"""
SELECT processo_id, warning, min(document_index) AS first_document, CAST(arg_min(place, document_index) AS INTEGER) AS first_place FROM (
 SELECT processo_id, document_index, warning, row_number() OVER (PARTITION BY processo_id, document_index ORDER BY nth) - 1 AS place FROM (
  SELECT processo_id, document_index, 0 AS nth, 'document_' || document_index || '_skipped:' || {_REASON} AS warning FROM k_dated WHERE NOT usable
  UNION ALL SELECT processo_id, document_index, 1, 'missing:publication_date' FROM k_dated WHERE usable AND masthead IS NULL
  UNION ALL SELECT processo_id, document_index, 2, 'missing:signing_date_in_pub' FROM k_dated WHERE usable AND signing_date_in_pub IS NULL
  UNION ALL SELECT processo_id, document_index, 3, 'missing:contratante' FROM k_dated WHERE usable AND coalesce(contratante, '') = ''
  UNION ALL SELECT processo_id, document_index, 4, 'missing:contratada' FROM k_dated WHERE usable AND coalesce(contratada, '') = ''
  UNION ALL SELECT processo_id, document_index, 5, 'publication_date:from_searcher_metadata' FROM k_dated WHERE usable AND masthead IS NULL AND publication_date IS NOT NULL
 ) w) x GROUP BY 1, 2""")
def publication_warnings(t):
    return G.publication_warnings(t.parsed_documents)


@query("primary_publication", "SELECT processo_id, document_index, content_hint FROM k_primary")
def primary_publication(t):
    usable = t.gazette_docs.where("quality_passes AND raw_text <> ''").select(
        KEY, "document_index", "content_hint")
    order = F.struct((F.col("content_hint") != K.HINT_STRUCTURED).alias("tier"), F.col("document_index"))
    return pick_first(usable, [KEY], order)


_PADDED = "repeat('. ', 500) || raw_text || repeat(' .', 600)"


@query("locate_extrato", f"""
SELECT processo_id, document_index, md5(CASE WHEN z < 0 THEN t ELSE substr(t, CAST(greatest(z - 600, 0) + 1 AS BIGINT), CAST(z + 800 - greatest(z - 600, 0) AS BIGINT)) END) AS block_md5
FROM (SELECT processo_id, document_index, t, strpos(lower(t), lower(processo_id)) - 1 AS z
  FROM (SELECT processo_id, document_index, {_PADDED} AS t FROM gazette_docs) x) y""")
def locate_extrato(t):
    padded = F.concat(F.repeat(F.lit(". "), 500), F.col("raw_text"), F.repeat(F.lit(" ."), 600))
    docs = t.gazette_docs.select(KEY, "document_index", padded.alias("text"))
    return G.with_block(docs, "text", KEY).select(
        KEY, "document_index", F.md5("_block").alias("block_md5"))


@query("month_pt_date", f"""
SELECT k.processo_id, {prose('k.raw_text', K.HEADER_DATE_PROSE, "'??'")} AS prose_date, {prose('k.raw_text', K.MASTHEAD_DATE)} AS masthead_date FROM contract_docs k""")
def month_pt_date(t):
    text = F.col("raw_text")
    return t.contract_docs.select(
        KEY, opening_date(text).alias("prose_date"), masthead_date(text).alias("masthead_date"))


@query("edition_number", f"""
SELECT processo_id, document_index, coalesce({rx(_ZONE, K.EDITION, 1)}, {rx(_ZONE, K.EDITION, 2)}) AS edition
FROM (SELECT processo_id, document_index, raw_text AS t FROM gazette_docs) x""")
def q_edition_number(t):
    return t.gazette_docs.select(
        KEY, "document_index", edition_number(F.col("raw_text")).alias("edition"))


@query("split_parties", f"""
SELECT processo_id, document_index, coalesce(regexp_replace({rx('parties', K.PARTY_SPLIT, 1, 'is')}, '[.,;]+$', ''), parties) AS contratante,
  regexp_replace({rx('parties', K.PARTY_SPLIT, 2, 'is')}, '[.,;]+$', '') AS contratada
FROM (SELECT pid AS processo_id, n AS document_index, hiring || ' e ' || hired || '.' AS parties FROM gazette_seed) x""")
def q_split_parties(t):
    both = F.concat(F.col("hiring"), F.lit(" e "), F.col("hired"), F.lit("."))
    return t.view("gazette_seed").select(
        F.col("pid").alias(KEY), F.col("n").alias("document_index"), split_parties(both).alias("s")
    ).select(KEY, "document_index", "s.*")


@query("clean_party", """
SELECT pid AS processo_id, hired AS cleaned FROM seed""")
def q_clean_party(t):
    raw = F.concat(F.lit("\n "), F.regexp_replace("hired", " ", " \n"), F.lit(", inscrita no CNPJ 1 e"))
    return t.view("seed").select(F.col("pid").alias(KEY), clean_party(raw).alias("cleaned"))


@query("document_type", f"""
SELECT processo_id, CASE WHEN {test('substr(raw_text, 1, 800)', K.CONTRACT_TYPE_ADDENDUM, 'i')} THEN 'addendum'
  WHEN {test('substr(raw_text, 1, 800)', K.CONTRACT_TYPE_CONTRACT, 'i')} THEN 'contract' ELSE 'unknown' END AS document_type FROM contract_docs""")
def document_type(t):
    return t.contract_docs.select(KEY, T.contract_type(F.col("raw_text")).alias("document_type"))


# -- contract texts -------------------------------------------------------------------------
def _noise() -> dict[str, str]:
    views, before = {}, "SELECT processo_id, k, raw_text AS n0 FROM contract_docs"
    views["k_noise0"] = before
    for i, (pattern, flags, _) in enumerate(K.NOISE_PATTERNS):
        head = f"(?{flags})" if flags else ""
        views[f"k_noise{i + 1}"] = (
            f"SELECT *, regexp_replace(n{i}, '{head}{pattern}', '', 'g') AS n{i + 1} FROM k_noise{i}")
    n = len(K.NOISE_PATTERNS)
    cats = ", ".join(f"CASE WHEN n{i} <> n{i + 1} THEN '{c}' END"
                     for i, (_, _, c) in enumerate(K.NOISE_PATTERNS))
    views["k_clean"] = (
        f"SELECT processo_id, {trim(f'''regexp_replace(n{n}, chr(10) || '{{3,}}', chr(10) || chr(10), 'g')''')} AS c, "
        f"array_to_string(list_sort(list_distinct(list_filter([{cats}], lambda x: x IS NOT NULL))), '|') AS noise_removed FROM k_noise{n}")
    return views


CHECK_VIEWS.update(_noise())
CHECK_VIEWS["k_pieces"] = (
    f"SELECT processo_id, string_split(regexp_replace(c, '(?im){K.CLAUSE_HEADING}', chr(1) || '\\1', 'g'), chr(1)) AS pieces FROM k_clean")
CHECK_VIEWS["k_clauses"] = f"""
SELECT processo_id, CAST(generate_subscripts(pieces[2:], 1) AS BIGINT) AS clause, unnest(pieces[2:]) AS p FROM k_pieces"""
_KEYS = "|".join(K.APPENDIX_KEYWORDS)
CHECK_VIEWS["k_bodies"] = f"""
SELECT processo_id, clause, {trim(rx('p', K.CLAUSE_HEADING, 2, 'im'))} AS number, {trim(rx('p', K.CLAUSE_HEADING, 3, 'im'))} AS title,
  {trim(f'''regexp_replace({trim(f"substr(p, length(regexp_extract(p, '(?im){K.CLAUSE_HEADING}')) + 1)")}, '(?ims)^(?:{_KEYS}).*\\z', '')''')} AS content FROM k_clauses"""
CHECK_VIEWS["k_marked_paragraphs"] = f"""
SELECT processo_id, clause, string_split(regexp_replace(content, '(?m){K.PARAGRAPH_HEADING.replace("|" + chr(92) + "bÚnico" + chr(92) + "b|" + chr(92) + "búnico" + chr(92) + "b", "|Único|único")}', chr(1) || '\\1', 'g'), chr(1)) AS parts FROM k_bodies"""
CHECK_VIEWS["k_appendices"] = f"""
SELECT processo_id, CAST(generate_subscripts(parts[2:], 1) AS BIGINT) AS index, unnest(parts[2:]) AS a, array_to_string(parts[2:], '') AS rest FROM (
 SELECT processo_id, string_split(regexp_replace(pieces[-1], '(?im)^({_KEYS})', chr(1) || '\\1', 'g'), chr(1)) AS parts FROM k_pieces) x"""


def _clean(t):
    return T.remove_noise(t.contract_docs, "raw_text").drop("raw_text")


@query("remove_noise", "SELECT processo_id, noise_removed, md5(c) AS clean_md5 FROM k_clean")
def remove_noise(t):
    return _clean(t).select(
        KEY, F.array_join("noise_removed", "|").alias("noise_removed"), F.md5("clean_text").alias("clean_md5"))


_H = "substr(c, 1, 2000)"


@query("extract_header", f"""
SELECT processo_id, {rx('c', K.HEADER_NUMBER)} AS contract_number, {trim(rx('c', K.HEADER_PROCESSO, 1, 'i'))} AS processo_id_in_document,
  coalesce({rx(_H, K.HEADER_DATE_LABEL)}, {prose(_H, K.HEADER_DATE_PROSE, "'??'")}) AS signing_date,
  substr({squeeze(rx('c', K.HEADER_OBJECT, 1, 'is'))}, 1, 400) AS object_summary FROM k_clean""")
def extract_header(t):
    h = F.col("header")
    return T.extract_header(_clean(t)).select(
        KEY, *[h[n].alias(n) for n in ("contract_number", "processo_id_in_document", "signing_date", "object_summary")])


@query("parties_from_prose", """
SELECT pid AS processo_id, hiring AS contratante, hired AS contratada FROM seed""")
def parties_from_prose(t):
    return T.extract_header(_clean(t)).select(KEY, "header.contratante", "header.contratada")


@query("segment_clauses", "SELECT processo_id, clause, number, title, content FROM k_bodies")
def segment_clauses(t):
    rows = t.preprocessed.select(KEY, F.posexplode("clauses").alias("i", "c"))
    return rows.select(
        KEY, (F.col("i") + 1).cast("bigint").alias("clause"), "c.number", "c.title", "c.content")


@query("clause_paragraphs", """
SELECT processo_id, clause, CAST(generate_subscripts(parts[2:], 1) AS BIGINT) AS paragraph, regexp_replace(unnest(parts[2:]), '\\s+$', '') AS text FROM k_marked_paragraphs""")
def clause_paragraphs(t):
    rows = t.preprocessed.select(KEY, F.posexplode("clauses").alias("i", "c")).select(
        KEY, "i", F.posexplode("c.paragraphs").alias("j", "p"))
    text = F.concat(F.col("p.header"), F.lit(" – "), F.col("p.content"))
    return rows.select(
        KEY, (F.col("i") + 1).cast("bigint").alias("clause"),
        (F.col("j") + 1).cast("bigint").alias("paragraph"), text.alias("text"))


@query("detect_appendices", """
SELECT processo_id, index, regexp_extract(a, '^([^\\n]*)', 1) AS header,
 CASE WHEN length(regexp_replace(s, '[^0-9]', '', 'g')) / greatest(length(s), 1) > 0.15 THEN 'table' ELSE 'text' END AS type
FROM (SELECT *, substr(rest, strpos(rest, a) + strpos(a, chr(10)), 200) AS s FROM k_appendices) x""")
def detect_appendices(t):
    return t.preprocessed.select(KEY, F.explode("appendices").alias("a")).select(
        KEY, F.col("a.index").cast("bigint").alias("index"), "a.header", "a.type")


_TRIG = f"CASE WHEN {test('c', K.EMBEDDED_TRIGGER, 'i')} THEN c END"


@query("embedded_publication", f"""
SELECT processo_id, t IS NOT NULL AS found, {prose('t', K.MASTHEAD_DATE)} AS publication_date,
  CASE WHEN t IS NOT NULL THEN '218' END AS edition FROM (SELECT processo_id, {_TRIG} AS t FROM k_clean) x""")
def embedded_publication(t):
    e = F.col("embedded_publication")
    return T.embedded_publication(_clean(t)).select(
        KEY, *[e[n].alias(n) for n in ("found", "publication_date", "edition")])


@query("preprocess_contracts")
def preprocess_contracts(t):
    return t.preprocessed.select(
        KEY, "document_type", "header.*", F.size("clauses").alias("clauses"),
        F.size("appendices").alias("appendices"), F.array_join("noise_removed", "|").alias("noise_removed"),
        F.col("embedded_publication.found").alias("embedded_found"),
        F.array_join("warnings", "|").alias("warnings"))


@query("embedded_to_publication", f"""
SELECT coalesce(p.processo_id, e.processo_id) AS processo_id, CASE WHEN e.processo_id IS NOT NULL THEN '{K.SOURCE_EMBEDDED}' ELSE '{K.SOURCE_GAZETTE}' END AS source,
  CASE WHEN e.processo_id IS NOT NULL THEN 1 ELSE p.documents_found END AS documents_found,
  CASE WHEN e.processo_id IS NOT NULL THEN '03/03/2026' ELSE p.publication_date END AS publication_date
FROM ({_STRUCTURED}) p FULL JOIN (SELECT processo_id FROM k_clean WHERE {test('c', K.EMBEDDED_TRIGGER, 'i')}) e ON e.processo_id = p.processo_id""")
def embedded_to_publication(t):
    return t.structured.select(KEY, "source", "documents_found", "publication_date")


# -- requests ------------------------------------------------------------------------------
@query("llm_request_batch", """
SELECT processo_id, kind FROM (SELECT processo_id, 'contract' AS kind FROM raw_presence WHERE contract_text <> '' AND publication_text <> ''
 UNION ALL SELECT processo_id, 'publication' AS kind FROM raw_presence WHERE contract_text <> '' AND publication_text <> ''
 UNION ALL SELECT processo_id, 'r002' AS kind FROM k_asked WHERE pub AND parties AND level <> 'DIVERGENT') x""")
def llm_request_batch(t):
    requests = Q.extraction_requests(t.raw_texts).unionByName(Q.party_requests(t.compliance))
    return requests.select(KEY, "kind")


# -- from texts to alerts --------------------------------------------------------------------
def _from_texts() -> dict[str, str]:
    """The audit rules over fields that SQL reads from the texts, instead of over structured rows."""
    trigger = test("c", K.EMBEDDED_TRIGGER, "i")
    own = {"contracts": "x_contracts", "publications": "x_publications", "raw_presence": "x_presence"}
    views = {
        "x_docs": f"""
SELECT processo_id, 1 AS document_index, NULL AS content_hint, NULL AS meta_date, true AS quality_passes,
  NULL AS extraction_error, {trigger} AS usable, CASE WHEN {trigger} THEN c END AS whole,
  CASE WHEN {trigger} THEN substr(c, greatest(z - {K.BLOCK_BACK_CHARS}, 0) + 1, z + {K.BLOCK_FORWARD_CHARS} - greatest(z - {K.BLOCK_BACK_CHARS}, 0)) END AS t
FROM (SELECT *, strpos(lower(c), lower(processo_id)) - 1 AS z FROM k_clean) k""",
        "x_fields": CHECK_VIEWS["k_fields"].replace("k_docs", "x_docs"),
        "x_parsed": CHECK_VIEWS["k_parsed"].replace("k_fields", "x_fields").replace(
            prose("t", K.MASTHEAD_DATE), prose("whole", K.MASTHEAD_DATE)),
        "x_embedded": """
SELECT *, coalesce(masthead, signing_date_in_pub) AS dated FROM x_parsed WHERE usable AND coalesce(masthead, signing_date_in_pub) IS NOT NULL""",
        "x_contracts": f"""
SELECT k.processo_id, {rx('k.c', K.HEADER_NUMBER)} AS contract_number,
  coalesce({rx("substr(k.c, 1, 2000)", K.HEADER_DATE_LABEL)}, {prose("substr(k.c, 1, 2000)", K.HEADER_DATE_PROSE, "'??'")}) AS signing_date,
  s.hiring AS contratante, s.hired AS contratada, NULL AS header_value, NULL AS value,
  e.processo_id IS NOT NULL AS emb_found, e.contratante AS emb_contratante, e.contratada AS emb_contratada
FROM k_clean k JOIN seed s ON s.pid = k.processo_id LEFT JOIN x_embedded e ON e.processo_id = k.processo_id""",
        "x_publications": f"""
SELECT coalesce(e.processo_id, p.processo_id) AS processo_id,
  CASE WHEN e.processo_id IS NOT NULL THEN '{K.SOURCE_EMBEDDED}' ELSE '{K.SOURCE_GAZETTE}' END AS source,
  CASE WHEN e.processo_id IS NOT NULL THEN e.masthead ELSE p.publication_date END AS publication_date,
  CASE WHEN e.processo_id IS NOT NULL THEN e.contract_number ELSE p.contract_number END AS contract_number,
  CASE WHEN e.processo_id IS NOT NULL THEN e.contratante ELSE p.contratante END AS contratante,
  CASE WHEN e.processo_id IS NOT NULL THEN e.contratada ELSE p.contratada END AS contratada,
  CASE WHEN e.processo_id IS NOT NULL THEN e.value ELSE p.value END AS value
FROM x_embedded e FULL JOIN k_primary p ON p.processo_id = e.processo_id""",
        "x_presence": """
SELECT c.processo_id, c.raw_text AS contract_text, b.raw_text AS publication_text FROM contract_docs c LEFT JOIN (
  SELECT processo_id, raw_text FROM (SELECT *, row_number() OVER (PARTITION BY processo_id ORDER BY CASE WHEN quality_passes AND
    content_hint = 'structured_contract' THEN 0 WHEN quality_passes THEN 1 ELSE 2 END, document_index) AS rn FROM gazette_docs) r
  WHERE rn = 1) b ON b.processo_id = c.processo_id""",
    }
    chain = ["k_joined", "k_usable", "k_diag", "k_merged", "k_r001", "k_asked", "k_r002", "k_r002b", "k_compliance",
             "k_overall", "k_values", "k_rules", "k_verdicts", "k_scored", "k_gated", "k_conformity", "k_reason", "k_alerts"]
    for name in chain:
        text = re.sub(r"\b(FROM|JOIN)\s+(\w+)", lambda m: f"{m[1]} {own.get(m[2], 'x' + m[2] if m[2] in chain else m[2])}",
                      CHECK_VIEWS[name])
        views[f"x{name}"] = text
    return views


CHECK_VIEWS.update(_from_texts())


@query("audit_from_text", """
SELECT processo_id, alert_level, reason, CAST(score AS DOUBLE) AS conformity_score, final AS overall_status FROM xk_alerts""")
def audit_from_text(t):
    """Two runs over the stored texts: the second one finds a tenth of them changed back."""
    snapshots = Snapshots(t.spark, f"{checkpoint_dir(t.spark)}/pactum/{uuid.uuid4().hex}/audit", 16)
    texts = A.Texts(t.contract_docs, t.gazette_docs, t.answers)
    touched = F.pmod(F.xxhash64(KEY), F.lit(10)) == 0
    cut = F.when(touched, F.concat(F.lit("RASCUNHO "), F.right("raw_text", F.lit(80)))).otherwise(F.col("raw_text"))
    A.audit_changes(A.Texts(texts.contracts.withColumn("raw_text", cut), texts.gazette, texts.answers), snapshots)
    A.audit_changes(texts, snapshots)
    return A.stored_alerts(snapshots)
