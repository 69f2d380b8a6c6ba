"""Queries over run logs, work selection, stored records and the failure ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from pactum.functions.text import word_count
from pactum.operators import discovery as D
from pactum.operators import runs as R
from pactum.operators import state as S
from pactum.plans.registry import query

KEY = "processo_id"
_PIDS = "(SELECT DISTINCT trim(processo_id) AS processo_id FROM links WHERE trim(processo_id) <> '')"
# Python-style white space for RE2
_WS = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_NWS = _WS.replace("[", "[^", 1)


def pids(t):
    return D.discovered_ids(t.links).select(KEY)


# -- documents -----------------------------------------------------------------------
_READABLE = "CASE WHEN json_valid(body) THEN len(json_keys(body)) > 0 ELSE false END"


@query("scan_stage_documents", f"""
SELECT name, body ->> 'processo_id' AS processo_id, body ->> '$.overall.status' AS status, body ->> '$.overall.review_reason' AS review_reason
FROM (SELECT name, CASE WHEN {_READABLE} THEN CAST(body AS JSON) END AS body FROM stage_documents) x WHERE body IS NOT NULL""")
def scan_stage_documents(t):
    good, _ = S.parse_documents(t.view("stage_documents"), S.COMPLIANCE_DOCUMENT)
    return good.select("name", KEY, "overall.status", "overall.review_reason")


@query("quarantined_documents", f"SELECT name, body FROM stage_documents WHERE NOT ({_READABLE})")
def quarantined_documents(t):
    return S.parse_documents(t.view("stage_documents"), S.COMPLIANCE_DOCUMENT)[1]


@query("scan_best_raw_publication", """
SELECT processo_id, document_index, tier, nullif(raw_text, '') AS raw_text FROM (
 SELECT *, row_number() OVER (PARTITION BY processo_id ORDER BY tier, document_index) AS rn FROM (
  SELECT *, CASE WHEN quality_passes AND content_hint = 'structured_contract' THEN 0 WHEN quality_passes THEN 1 ELSE 2 END AS tier FROM gazette_docs) a) b
WHERE rn = 1""")
def scan_best_raw_publication(t):
    return R.best_raw_publication(t.gazette_docs)


_REASON = """CASE WHEN NOT quality_passes THEN coalesce(nullif(extraction_error, ''), 'quality_failed') WHEN raw_text = '' THEN 'empty_raw_text' END"""


@query("quality_gate", f"""
SELECT processo_id, document_index, {_REASON} AS skip_reason,
  'document_' || document_index || '_skipped:' || {_REASON} AS skip_warning FROM gazette_docs""")
def quality_gate(t):
    return R.skip_reason(t.gazette_docs).select(KEY, "document_index", "skip_reason", "skip_warning")


# -- work selection ------------------------------------------------------------------
_DECISION = f"""
SELECT p.processo_id, CASE WHEN e.processo_id IS NOT NULL THEN 'embedded' WHEN c.processo_id IS NOT NULL AND x.processo_id IS NOT NULL THEN 'completed'
  WHEN a.processo_id IS NOT NULL THEN 'partial' ELSE 'process' END AS decision
FROM {_PIDS} p LEFT JOIN (SELECT processo_id FROM contracts WHERE emb_found) e ON e.processo_id = p.processo_id
LEFT JOIN (SELECT DISTINCT processo_id FROM run_log WHERE stage = 'stage3' AND outcome = 'completed') c ON c.processo_id = p.processo_id
LEFT JOIN (SELECT DISTINCT processo_id FROM run_log WHERE stage = 'stage3' AND outcome = 'partial') a ON a.processo_id = p.processo_id
LEFT JOIN (SELECT DISTINCT processo_id FROM gazette_docs) x ON x.processo_id = p.processo_id"""


def _decisions(t):
    embedded = t.contracts.where("embedded_publication.found")
    return R.skip_decisions(pids(t), t.run_log, embedded, t.gazette_docs)


@query("skip_rules", _DECISION)
def skip_rules(t):
    return _decisions(t)


@query("pending_compliance", f"""
SELECT processo_id FROM {_PIDS} p WHERE processo_id NOT IN (SELECT processo_id FROM run_log WHERE stage = 'stage4' AND outcome = 'completed')""")
def pending_compliance(t):
    return R.pending(pids(t), t.run_log, "stage4")


@query("pending_with_rerun", f"""
SELECT processo_id FROM {_PIDS} p WHERE processo_id NOT IN (SELECT processo_id FROM run_log WHERE stage = 'stage4' AND outcome = 'completed')
  OR processo_id IN (SELECT processo_id FROM run_log WHERE stage = 'stage4' AND outcome = 'failed')""")
def pending_with_rerun(t):
    return R.pending(pids(t), t.run_log, "stage4", rerun_failed=True)


@query("work_difference", f"""
SELECT processo_id FROM {_PIDS} p EXCEPT SELECT processo_id FROM run_log WHERE stage = 'stage4' AND outcome = 'completed'""")
def work_difference(t):
    done = t.run_log.where("stage = 'stage4' AND outcome = 'completed'").select(KEY)
    return pids(t).join(done, KEY, "left_anti")


@query("extraction_pending", f"""
SELECT processo_id FROM {_PIDS} p WHERE processo_id NOT IN (SELECT processo_id FROM run_log WHERE stage = 'stage2' AND outcome = 'completed')
  AND processo_id NOT IN (SELECT processo_id FROM artifacts WHERE artifact = 'raw')""")
def extraction_pending(t):
    raw = t.view("artifacts").where("artifact = 'raw'")
    return R.extraction_pending(pids(t), t.run_log, raw)


# -- stored records ------------------------------------------------------------------
@query("publication_record", """
SELECT h.processo_id, h.n AS document_index, coalesce(length(d.raw_text), 0) AS text_length, coalesce(d.quality_passes, false) AS quality_passes,
  CASE WHEN d.processo_id IS NULL THEN 'download_failed' ELSE '' END AS quality_flags,
  CASE WHEN d.processo_id IS NULL THEN 'PDF download failed' ELSE d.extraction_error END AS extraction_error,
  coalesce(d.raw_text <> '' AND contains(lower(d.raw_text), lower(h.processo_id)), false) AS processo_found_in_text
FROM (SELECT s.pid AS processo_id, l.n, l.sk FROM order_lines l JOIN seed s ON s.k = l.k) h
LEFT JOIN gazette_docs d ON d.processo_id = h.processo_id AND d.document_index = h.n AND coalesce(d.meta_date, '') <> ''""")
def publication_record(t):
    docs = t.gazette_docs
    hits = t.view("gazette_seed").select(
        F.col("pid").alias(KEY), F.col("n").alias("document_index"))
    got = docs.where(F.coalesce("meta_date", F.lit("")) != "")
    return R.publication_records(hits, got).select(
        KEY, "document_index", F.col("text_length").cast("bigint").alias("text_length"), "quality_passes",
        F.array_join("quality_flags", "|").alias("quality_flags"), "extraction_error",
        "processo_found_in_text")


@query("contract_raw_record", f"""
SELECT l.processo_id, l.pos, l.company_name, true AS fallback_used, 'ocr' AS extraction_method, length(trim(d.raw_text, chr(10) || ' ')) AS total_chars,
  len(regexp_extract_all(d.raw_text, '{_NWS}+')) AS total_words
FROM links l JOIN contract_docs d ON d.processo_id = l.processo_id""")
def contract_raw_record(t):
    texts = t.contract_docs.withColumn("extraction_method", F.lit("ocr"))
    return R.contract_records(t.links, texts).select(
        KEY, "pos", "company_name", "fallback_used", "extraction_method",
        F.col("total_chars").cast("bigint").alias("total_chars"),
        F.col("total_words").cast("bigint").alias("total_words"))


_STRIPPED = f"regexp_replace(text, '^{_WS}+|{_WS}+$', '', 'g')"


@query("text_quality_length", f"""
SELECT doc_id, length({_STRIPPED}) AS total_chars, length({_STRIPPED}) < 500 AS short FROM documents""")
def text_quality_length(t):
    q = R.with_quality(t.base("documents"), "text")
    short = F.exists("quality_flags", lambda f: f.startswith("low_char_count"))
    return q.select("doc_id", F.col("total_chars").cast("bigint").alias("total_chars"), short.alias("short"))


_KEPT = "length(text) - length(regexp_replace(text, '[ \\n\\r\\t]', '', 'g'))"
_SEEN = "length(regexp_replace(regexp_replace(text, '[ \\n\\r\\t]', '', 'g'), '[\\p{C}\\p{Z}]', '', 'g'))"


def _quality(table: str) -> str:
    return f"""SELECT *, concat_ws('|', CASE WHEN total_chars < 500 THEN 'low_char_count:' || total_chars || '<500' END,
  CASE WHEN ratio < 0.7 THEN printf('low_printable_ratio:%.2f<0.7', ratio) END) AS quality_flags FROM (
  SELECT *, CASE WHEN total_chars > 0 THEN (kept + seen) / size ELSE 0.0 END AS ratio FROM (
   SELECT *, length({_STRIPPED}) AS total_chars, {_KEPT} AS kept, {_SEEN} AS seen, length(text) AS size FROM {table}) q1) q2"""


@query("text_quality", f"""
SELECT doc_id, CAST(total_chars AS INTEGER) AS total_chars, round(ratio, 3) AS printable_ratio, quality_flags = '' AS quality_passes, quality_flags
FROM ({_quality('documents')}) x""")
def text_quality(t):
    return R.with_quality(t.base("documents"), "text").select(
        "doc_id", "total_chars", "printable_ratio", "quality_passes",
        F.array_join("quality_flags", "|").alias("quality_flags"))


@query("choose_extraction", f"""
SELECT d.doc_id, u.source IS NOT NULL AS success, coalesce(u.source, 'failed') AS source, md5(coalesce(u.text, '')) AS text,
  CAST(coalesce(u.total_chars, 0) AS INTEGER) AS total_chars, coalesce(u.quality_flags = '', false) AS quality_passes,
  coalesce(u.quality_flags, '') AS quality_flags
FROM (SELECT DISTINCT doc_id FROM page_candidates) d LEFT JOIN (
 SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY source = 'ocr_columns') AS nth
 FROM ({_quality('page_candidates')}) x WHERE text IS NOT NULL AND (source = 'ocr_columns' OR quality_flags = '')) u
ON u.doc_id = d.doc_id AND u.nth = 1""")
def choose_extraction(t):
    return R.choose_extraction(t.view("page_candidates")).withColumns(
        {"text": F.md5("text"), "quality_flags": F.array_join("quality_flags", "|")})


@query("word_count", f"SELECT doc_id, len(regexp_extract_all(text, '{_NWS}+')) AS words FROM documents")
def q_word_count(t):
    return t.base("documents").select("doc_id", word_count(F.col("text")).cast("bigint").alias("words"))


@query("no_document_flag", """
SELECT processo_id, document_index, contains(raw_text, 'Não há documento associado') OR contains(raw_text, 'Documento não encontrado') AS no_document
FROM (SELECT processo_id, document_index, CASE WHEN extraction_error IS NOT NULL THEN 'Aviso: Documento não encontrado.' ELSE raw_text END AS raw_text FROM gazette_docs) x""")
def no_document_flag(t):
    page = F.when(F.col("extraction_error").isNotNull(), "Aviso: Documento não encontrado.").otherwise(
        F.col("raw_text"))
    return t.gazette_docs.select(KEY, "document_index", R.no_document(page).alias("no_document"))


_SEP = "chr(10) || chr(10) || '--- DOCUMENT PART SEPARATOR ---' || chr(10) || chr(10)"


@query("document_parts_merge", f"""
SELECT processo_id, md5(string_agg(text, {_SEP} ORDER BY part)) AS text_md5, count(*) AS parts
FROM contract_parts WHERE success GROUP BY processo_id""")
def document_parts_merge(t):
    merged = R.merge_parts(t.view("contract_parts"))
    gap = F.regexp_count("text", F.lit("--- DOCUMENT PART SEPARATOR ---"))
    return merged.select(
        KEY, F.md5("text").alias("text_md5"), (gap + 1).cast("bigint").alias("parts"))


@query("merged_document_measures", f"""
SELECT processo_id, page_count, pdf_size_bytes, length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) AS total_chars,
  length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) >= 500 AS quality_passes FROM (
 SELECT processo_id, CAST(sum(pages) FILTER (success) AS BIGINT) AS page_count, CAST(sum(pdf_size_bytes) AS BIGINT) AS pdf_size_bytes,
  string_agg(text, {_SEP} ORDER BY part) FILTER (success) AS text FROM contract_parts GROUP BY processo_id) x WHERE text IS NOT NULL""")
def merged_document_measures(t):
    return R.merged_measures(t.view("contract_parts")).select(
        KEY, "page_count", "pdf_size_bytes", F.col("total_chars").cast("bigint").alias("total_chars"),
        "quality_passes")


# -- outcomes and tallies --------------------------------------------------------------
_OUTCOME = f"""
SELECT p.processo_id, CASE WHEN d.n IS NULL THEN 'no_results' WHEN d.n = d.ok THEN 'completed' ELSE 'partial' END AS outcome,
  coalesce(d.ok, 0) AS successful, coalesce(d.n - d.ok, 0) AS failed
FROM {_PIDS} p LEFT JOIN (SELECT processo_id, count(*) AS n, count(*) FILTER (extraction_error IS NULL) AS ok FROM gazette_docs GROUP BY 1) d
  ON d.processo_id = p.processo_id"""


@query("publication_outcome", _OUTCOME)
def publication_outcome(t):
    return R.publication_outcomes(pids(t), t.gazette_docs)


@query("stage3_tally", f"""
SELECT count(*) AS total, count(*) FILTER (decision = 'process' AND outcome = 'completed') AS success,
  count(*) FILTER (decision = 'process' AND outcome = 'no_results') AS no_results, count(*) FILTER (decision = 'process' AND outcome = 'partial') AS partial,
  count(*) FILTER (decision <> 'process') AS skipped, count(*) FILTER (decision = 'embedded') AS embedded
FROM ({_DECISION}) a JOIN ({_OUTCOME}) b ON b.processo_id = a.processo_id""")
def stage3_tally(t):
    return R.stage3_tally(_decisions(t), R.publication_outcomes(pids(t), t.gazette_docs))


@query("run_log_events", "SELECT stage, outcome, count(DISTINCT processo_id) AS items, count(*) AS events FROM run_log GROUP BY 1, 2")
def run_log_events(t):
    return R.run_log_events(t.run_log)


_OUTCOMES = ["completed", "failed", "skipped", "no_document", "no_results", "partial", "embedded"]


@query("stage_run_tally", f"""
SELECT stage, count(*) AS total, {', '.join(f"count(*) FILTER (outcome = '{o}') AS {o}" for o in _OUTCOMES)}
FROM (SELECT stage, processo_id, arg_max(outcome, seq) AS outcome FROM run_log GROUP BY 1, 2) x GROUP BY stage""")
def stage_run_tally(t):
    return R.stage_run_tally(t.run_log)


@query("stage_progress", """
SELECT stage, total, completed, failed_count, CASE WHEN failed_count > 0 AND completed = 0 THEN 'FAILED' WHEN completed >= total THEN 'COMPLETE'
  WHEN completed > 0 THEN 'IN_PROGRESS' ELSE 'NOT_STARTED' END AS status, round(completed / total * 100, 1) AS progress_pct
FROM (SELECT stage, count(DISTINCT processo_id) AS total, count(DISTINCT CASE WHEN outcome = 'completed' THEN processo_id END) AS completed,
  count(*) FILTER (outcome = 'failed') AS failed_count FROM run_log GROUP BY stage) x""")
def stage_progress(t):
    return R.stage_progress(t.run_log)


_ERRORS = "SELECT stage, seq, processo_id, coalesce(error, '') AS error, logged_at AS \"at\" FROM run_log WHERE outcome = 'failed'"


@query("scan_stage_errors", _ERRORS)
def scan_stage_errors(t):
    return R.stage_errors(t.run_log)


@query("union_errors", f"SELECT stage, processo_id, error, \"at\" FROM ({_ERRORS}) x")
def union_errors(t):
    per_stage = [R.stage_errors(t.run_log.where(F.col("stage") == s)) for s in ("stage2", "stage3", "stage4")]
    return per_stage[0].unionByName(per_stage[1]).unionByName(per_stage[2]).drop("seq")


@query("errors_csv", f"SELECT stage, processo_id, error, \"at\" FROM ({_ERRORS}) x")
def errors_csv(t):
    return R.stage_errors(t.run_log).select("stage", KEY, "error", "at")


@query("error_totals", f"SELECT stage, count(*) AS n FROM ({_ERRORS}) x GROUP BY stage")
def error_totals(t):
    return R.error_totals(R.stage_errors(t.run_log))


@query("error_preview", f"SELECT * FROM ({_ERRORS}) x WHERE stage = 'stage3' ORDER BY seq LIMIT 20")
def error_preview(t):
    return R.error_preview(R.stage_errors(t.run_log), "stage3")


# -- failure ledger ----------------------------------------------------------------------
@query("failed_items_append", """
SELECT processo_id, stage, 'ExtractionFailedError' AS error_type, coalesce(error, '') AS error_msg, logged_at AS failed_at, 0 AS retry_count, false AS resolved
FROM run_log WHERE outcome = 'failed'""")
def failed_items_append(t):
    return R.new_failures(t.run_log)


_LEDGER = """
SELECT f.seq, f.processo_id, f.stage, f.resolved OR coalesce(f.seq <= r.upto, false) AS resolved FROM failed_items f
LEFT JOIN (SELECT processo_id, stage, max(seq) AS upto FROM resolutions GROUP BY 1, 2) r ON r.processo_id = f.processo_id AND r.stage = f.stage"""


@query("failed_items_resolve", _LEDGER)
def failed_items_resolve(t):
    return R.resolve_failures(t.view("failed_items"), t.view("resolutions")).select(
        "seq", KEY, "stage", "resolved")


@query("count_unresolved", f"SELECT count(*) FILTER (NOT resolved) AS unresolved FROM ({_LEDGER}) x")
def count_unresolved(t):
    return R.count_unresolved(R.resolve_failures(t.view("failed_items"), t.view("resolutions")))


@query("latest_run_per_stage", """
SELECT stage, arg_max(path, (modified_at, seq)) AS path, max(modified_at) AS modified_at FROM stage_runs GROUP BY stage""")
def latest_run_per_stage(t):
    return R.latest_run(t.view("stage_runs"))
