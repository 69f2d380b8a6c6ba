"""Audit tables derived from the generic driver tables.

The driver's tables (orders, lineitem, customer, events, documents) hold no
contracts, so each audit table is a view over them, in SQL that Spark and a
second engine both run: integer arithmetic, ``||``, ``lpad`` and date addition
only. Every row of the source tables takes part.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from pactum import constants as K

BASE = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
        "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def s(x: str) -> str:
    return f"CAST({x} AS STRING)"


def pad(x: str, n: int) -> str:
    return f"lpad({s(x)}, {n}, '0')"


def dmy(d: str) -> str:
    return f"({pad(f'day({d})', 2)} || '/' || {pad(f'month({d})', 2)} || '/' || {s(f'year({d})')})"


def whole(x: str, by: int) -> str:
    """Integer division of a non-negative number."""
    return f"CAST(floor({x} / {by}) AS BIGINT)"


def brl(cents: str) -> str:
    """Cents as ``1.234,56``."""
    units = f"(({cents} - {cents} % 100) / 100)"
    return (
        f"(CASE WHEN {cents} >= 100000000 THEN {s(whole(cents, 100000000))} || '.' || "
        f"{pad(f'{whole(cents, 100000)} % 1000', 3)} || '.' || {pad(f'{whole(cents, 100)} % 1000', 3)} "
        f"WHEN {cents} >= 100000 THEN {s(whole(cents, 100000))} || '.' || "
        f"{pad(f'{whole(cents, 100)} % 1000', 3)} "
        f"ELSE {s(f'CAST({units} AS BIGINT)')} END || ',' || {pad(f'{cents} % 100', 2)})"
    )


def month_name(d: str) -> str:
    names = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(K.MONTHS_PT, 1))
    return f"(CASE month({d}) {names} END)"


def lines(*parts: str) -> str:
    """SQL text expressions, one per line of the result."""
    return " || chr(10) || ".join(parts)


PID = f"""
 CASE WHEN k % 50 = 49 THEN 'GARBAGE-' || {s('k')}
      WHEN k % 3 = 0 THEN (CASE WHEN k % 2 = 0 THEN 'FIL-PRO-' ELSE 'TUR-PRO-' END)
           || {s('year(d)')} || '/' || {pad('k', 10)}
      WHEN k % 3 = 1 THEN {pad('k % 7000', 6)} || '.' || {pad('k', 10)} || '/' || {s('year(d)')}
           || (CASE WHEN k % 4 = 0 THEN '' ELSE '-' || {pad('k % 97', 2)} END)
      ELSE {s('k % 90 + 10')} || '/' || {pad('k', 10)} || '.' || {pad('k % 1000', 3)}
           || '/' || {s('year(d)')} END"""

GAZETTE_A = lines(
    "'DISTRIBUIDORA DE FILMES S/A - FILMES'", "'EXTRATO DE INSTRUMENTO CONTRATUAL'",
    "'Processo Instrutivo: ' || pid || '.- CO 01/2024.'", "'Contrato nº: ' || num || '.'",
    "'Data da Assinatura: ' || signed || '.'",
    "'Partes: ' || hiring || ' e ' || hired || '.'",
    "'Objeto: Contratação de empresa especializada em lote ' || " + s("k") + " || '.'",
    "'Valor Total: R$ ' || money", "'Vigência: 24 meses.'", "'Nota de Empenho: 2024NE00006'",
)
GAZETTE_B = (
    "'Processo ' || pid || ' 1-Objeto: operação do lote ' || " + s("k") +
    " || ' 2-Partes: ' || hiring || ' e ' || hired || ' 3-Instrumento: Contrato nº ' || num || "
    "' 4-Data: ' || signed || ' 5-Valor: R$ ' || money || chr(10)"
)
GAZETTE_C = lines(
    "'Segunda-feira, ' || " + s("day(pub)") + " || ' de ' || " + month_name("pub") +
    " || ' de ' || " + s("year(pub)"),
    "'Diário Oficial do Município'", "'D.O. — Edição ' || " + s("k % 800 + 100"), "''",
    "'SECRETARIA MUNICIPAL'",
    "(CASE WHEN n % 2 = 0 THEN 'EXTRATO DE TERMO ADITIVO' "
    "ELSE 'EXTRATO DE INSTRUMENTO CONTRATUAL' END)",
    "'Processo Instrutivo: ' || pid", "'Contrato nº: ' || num || '.'",
    "'Data da Assinatura: ' || signed || '.'",
    "'Partes: ' || hiring || ' e ' || hired || '.'",
    "'Objeto: Operação do lote ' || " + s("k") + " || '.'", "'Valor Total: R$ ' || money",
)
CONTRACT_TEXT = lines(
    "(CASE WHEN k % 6 = 0 THEN 'SEGUNDO TERMO ADITIVO AO CONTRATO Nº ' ELSE 'CONTRATO Nº ' END)"
    " || num",
    "''", "'Página 1 de ' || " + s("k % 20 + 1"), "'Processo Instrutivo: ' || pid || '.- CO 01/2024.'",
    "(CASE WHEN k % 4 = 0 THEN 'Aos ' || " + s("day(d)") + " || ' dias do mês de ' || " +
    month_name("d") + " || ' do ano de ' || " + s("year(d)") +
    " ELSE 'Data da Assinatura: ' || signed || '.' END)",
    "(CASE WHEN k % 5 = 0 THEN 'Aos 17 dias do mês de abril do ano de 2025, na Rua Central, 307, a '"
    " || hiring || ', inscrita no CNPJ 00.000.000/0001-00, neste ato, e a empresa ' || hired || ', e'"
    " ELSE 'CONTRATANTE: ' || hiring || ' e' || chr(10) || 'CONTRATADA: ' || hired || ', inscrita' END)",
    "'FILCAP' || " + pad("k % 1000000000", 9), "''",
    "'CLÁUSULA PRIMEIRA - OBJETO'", "''",
    "'Constitui objeto do presente a contratação do lote ' || " + s("k") + " || '.'", "''",
    "'Parágrafo Primeiro – Situado no endereço ' || " + s("ck") + " || '.'",
    "'Parágrafo Segundo – É vedada a cessão a terceiros.'", "''",
    "'CLÁUSULA SEGUNDA – PRAZO'", "''", "'O prazo é de ' || " + s("k % 36 + 1") + " || ' meses.'",
    "''", "'CLÁUSULA TERCEIRA - VALOR'", "''", "'O valor total é de R$ ' || money || '.'", "''",
    "'LISTAGEM DE BENS'", "'ITEM QTDE'", pad("k", 10) + " || ' ' || " + pad("k * 7", 12),
    "'ANEXO I - NOTAS'", "'Texto das notas do anexo.'",
    "(CASE WHEN k % 8 = 0 THEN chr(10) || 'Terça-feira, 3 de março de 2026' || chr(10) || "
    "'D.O. Nº 218' || chr(10) || 'EXTRATO DE CONTRATO' || chr(10) || "
    "'Processo Instrutivo: ' || pid || chr(10) || 'Contrato nº: ' || num || chr(10) || "
    "'Data da Assinatura: ' || signed || chr(10) || 'Partes: ' || hiring || ' e ' || hired || "
    "chr(10) || 'Objeto: Lote.' || chr(10) || 'Valor Total: R$ ' || money ELSE '' END)",
)

SQL: dict[str, str] = {
    "numbered_orders": """
SELECT o_orderkey AS k, o_custkey AS ck, CAST(o_orderdate AS DATE) AS d,
       CAST(round(o_totalprice * 100) AS BIGINT) AS cents, o_orderstatus AS status,
       o_orderpriority AS priority
FROM orders""",
    "seed": f"""
SELECT o.k, o.ck, o.d, o.cents, o.status, o.priority, {PID} AS pid,
       'SECRETARIA MUNICIPAL DE ' || c.c_mktsegment AS hiring,
       upper(c.c_name) || ' LTDA' AS hired,
       {pad('o.k', 7)} || '/' || {s('year(o.d)')} AS num
FROM numbered_orders o JOIN customer c ON c.c_custkey = o.ck""",
    # -- discovery ------------------------------------------------------------------
    "link_rows": f"""
SELECT k * 2 AS pos, CASE WHEN k % 101 = 0 THEN '  ' WHEN k % 13 = 0 THEN ' ' || pid || ' '
            ELSE pid END AS processo_id, 1 AS seen, k, ck, cents, hired, hiring FROM seed
UNION ALL
SELECT k * 2 + 100001 AS pos, pid AS processo_id, 2 AS seen, k, ck, cents, hired, hiring
FROM seed WHERE status = 'P'""",
    "links": f"""
SELECT pos, processo_id, 'https://portal.example/contrato/' || {s('k')} AS url,
       CASE WHEN ck % 17 = 0 THEN NULL WHEN ck % 23 = 0 THEN '' ELSE hired END AS company_name,
       CASE WHEN ck % 5 = 0 THEN NULL WHEN ck % 7 = 0 THEN '' ELSE {pad('ck', 14)} END AS company_cnpj,
       CASE WHEN seen = 2 THEN 'R$ 0,00' ELSE 'R$ ' || {brl('cents')} END AS contract_value,
       hired || ' > ' || hiring || ' > UG ' || {s('k % 40')} AS path_text,
       '2026-01-15T10:00:00' AS discovered_at
FROM link_rows""",
    "discovery_errors": """
SELECT event_id AS pos, 'timeout on row ' || CAST(user_id AS STRING) AS error
FROM events WHERE event_type = 'error'""",
    "grid_rows": f"""
SELECT c_custkey AS pos,
       CASE WHEN c_custkey % 31 = 0 THEN c_name
            WHEN c_custkey % 37 = 0 THEN '-' || '|' || 'x'
            ELSE ' .' || c_name || '  S/A- ' || '|' ||
             (CASE WHEN c_custkey % 3 = 0 THEN 'CNPJ {'12.345.678/0001-'}' || {pad('c_custkey % 90', 2)}
                   WHEN c_custkey % 3 = 1 THEN 'id ' || {pad('c_custkey', 14)} ELSE 'sem registro' END)
             || '|' ||
             (CASE WHEN c_custkey % 4 = 0 THEN 'total R$   ' || {brl('CAST(round(abs(c_acctbal) * 100) AS BIGINT)')}
                   WHEN c_custkey % 4 = 1 THEN {brl('CAST(round(abs(c_acctbal) * 100) AS BIGINT)')}
                   ELSE 'n/d' END) END AS cells
FROM customer""",
    "payee_rows": f"""
SELECT o_orderkey AS pos,
       CASE WHEN o_custkey % 41 = 0 THEN 'Total geral'
            WHEN o_custkey % 6 = 0 THEN 'Órgão ' || c_name || ' sem separador de nome longo'
            ELSE {pad('o_custkey', 14)} || ' - ' || c_name || ' - ME' END AS payee,
       {brl('CAST(round(o_totalprice * 100) AS BIGINT)')} AS total
FROM orders JOIN customer ON c_custkey = o_custkey""",
    "leaf_rows": f"""
SELECT ck AS leaf_id, k AS pos, 1 AS scroll,
       CASE WHEN k % 83 = 0 THEN 'Total' WHEN k % 89 = 0 THEN '' ELSE pid END AS processo_id,
       'https://portal.example/p/' || {s('k')} AS url, {brl('cents')} AS total FROM seed
UNION ALL
SELECT ck AS leaf_id, k AS pos, 2 AS scroll, pid AS processo_id,
       'https://portal.example/p/' || {s('k')} AS url, {brl('cents')} AS total
FROM seed WHERE status = 'O'""",
    # -- gazette search ---------------------------------------------------------------
    "order_lines": """
SELECT l_orderkey AS k, CAST(l_linenumber AS BIGINT) AS n, min(l_partkey) AS pk,
       max(l_suppkey) AS sk, count(*) AS copies
FROM lineitem GROUP BY l_orderkey, l_linenumber""",
    "result_rows": f"""
SELECT s.pid AS processo_id, l.n AS page, i.l_partkey * 1000000 + i.l_suppkey * 100
         + CAST(i.l_quantity AS BIGINT) AS slot,
       i.l_suppkey % 3 + 1 AS variation_rank,
       'publicado em: ' || {dmy('s.d')} || ' - Edição ' || {s('i.l_partkey % 900')} || ' - Pág. '
         || {s('i.l_suppkey')} AS meta_text,
       CASE WHEN i.l_partkey % 3 = 0 THEN 'Processo ' || s.pid || ' 1-Objeto: lote 2-Partes: A e B'
            WHEN i.l_partkey % 3 = 1 THEN 'autorizo o pagamento' ELSE 'Processo outro' END AS snippet
FROM lineitem i JOIN seed s ON s.k = i.l_orderkey
     JOIN order_lines l ON l.k = i.l_orderkey AND l.n = i.l_linenumber""",
    # -- documents of one process --------------------------------------------------------
    "gazette_seed": f"""
SELECT s.k, s.pid, s.hired, s.num, l.n, l.pk, l.sk, s.d AS d,
       CASE WHEN l.pk % 9 = 0 THEN 'COMLURB' ELSE s.hiring END AS hiring,
       s.d + CAST(s.k % 45 - 3 AS INT) AS pub, {dmy('s.d')} AS signed, {brl('s.cents')} AS money
FROM order_lines l JOIN seed s ON s.k = l.k""",
    "gazette_docs": f"""
SELECT pid AS processo_id, n AS document_index,
       CASE WHEN pk % 3 = 0 THEN '{K.HINT_STRUCTURED}' WHEN pk % 3 = 1 THEN '{K.HINT_ADDENDUM}'
            ELSE '{K.HINT_UNKNOWN}' END AS content_hint,
       CASE WHEN sk % 5 = 0 THEN NULL ELSE {dmy('pub')} END AS meta_date,
       {s('pk % 900')} AS edition_number, {s('sk')} AS page_number,
       'https://gazette.example/' || {s('k')} || '/' || {s('n')} AS source_url,
       (pk % 7 <> 0) AS quality_passes,
       CASE WHEN pk % 14 = 0 THEN 'PDF download failed' WHEN pk % 21 = 0 THEN '' ELSE NULL END
         AS extraction_error,
       CASE WHEN pk % 11 = 0 THEN '' WHEN pk % 4 = 0 THEN {GAZETTE_A}
            WHEN pk % 4 = 1 THEN {GAZETTE_B} WHEN pk % 4 = 2 THEN {GAZETTE_C}
            ELSE 'Processo outro 12/2024' || chr(10) || {GAZETTE_A} END AS raw_text
FROM gazette_seed""",
    "contract_docs": f"""
SELECT processo_id, k, raw_text FROM (
  SELECT pid AS processo_id, k, {CONTRACT_TEXT} AS raw_text
  FROM (SELECT *, {dmy('d')} AS signed, {brl('cents')} AS money FROM seed) x) y""",
    "contract_parts": f"""
SELECT s.pid AS processo_id, l.n AS part, (l.pk % 10 <> 0) AS success,
       CASE WHEN l.pk % 6 = 0 THEN '   ' ELSE 'Parte ' || {s('l.n')} || ' do contrato ' || s.num
            || (CASE WHEN l.sk % 2 = 0 THEN ' ' || chr(9) ELSE '' END) END AS text,
       l.pk % 4 + 1 AS pages, l.pk * 100 AS pdf_size_bytes
FROM order_lines l JOIN seed s ON s.k = l.k""",
    # -- structured stage tables ---------------------------------------------------------
    "contracts": f"""
SELECT pid AS processo_id, k,
       CASE WHEN k % 6 = 0 THEN 'addendum' ELSE 'contract' END AS document_type,
       CASE WHEN k % 41 = 0 THEN NULL WHEN k % 43 = 0 THEN '' ELSE num END AS contract_number,
       CASE WHEN k % 53 = 0 THEN NULL WHEN k % 59 = 0 THEN '31/02/2024'
            WHEN k % 61 = 0 THEN ' ' || {dmy('d')} || ' ' ELSE {dmy('d')} END AS signing_date,
       CASE WHEN k % 67 = 0 THEN NULL ELSE hiring END AS contratante, hired AS contratada,
       CASE WHEN k % 29 = 0 THEN NULL WHEN k % 31 = 0 THEN '' ELSE 'R$ ' || {brl('cents')} END
         AS header_value,
       CASE WHEN k % 29 = 0 THEN {s('k')} || '.50' WHEN k % 31 = 0 THEN '0,00' ELSE NULL END AS value,
       (k % 8 = 0) AS emb_found,
       CASE WHEN k % 16 = 0 THEN lower(hiring) WHEN k % 8 = 0 THEN '' ELSE NULL END AS emb_contratante,
       CASE WHEN k % 24 = 0 THEN lower(hired) ELSE NULL END AS emb_contratada
FROM seed WHERE NOT (status = 'P' AND priority = '1-URGENT')""",
    "publications": f"""
SELECT pid AS processo_id,
       CASE WHEN k % 8 = 0 THEN '{K.SOURCE_EMBEDDED}' ELSE '{K.SOURCE_GAZETTE}' END AS source,
       CASE WHEN k % 71 = 0 THEN NULL WHEN k % 73 = 0 THEN 'sem data'
            ELSE {dmy('(d + CAST(k % 45 - 3 AS INT))')} END AS publication_date,
       CASE WHEN k % 11 = 0 THEN '999/' || {s('year(d)')} WHEN k % 12 = 0 THEN ' ' || num || ' '
            ELSE num END AS contract_number,
       CASE WHEN k % 19 = 0 THEN 'COMPANHIA MUNICIPAL' ELSE lower(hiring) END AS contratante,
       CASE WHEN k % 79 = 0 THEN '' WHEN k % 2 = 0 THEN replace(hired, ' LTDA', ', Ltda.')
            ELSE hired END AS contratada,
       CASE WHEN k % 7 = 0 THEN 'R$ ' || {brl('(cents + CAST(floor(cents / 200) AS BIGINT))')}
            WHEN k % 7 = 1 THEN 'R$ ' || {brl('(cents + CAST(floor(cents / 20) AS BIGINT))')}
            WHEN k % 37 = 0 THEN 'a definir'
            WHEN k % 31 = 0 THEN '0,00' ELSE {brl('cents')} END AS value,
       {s('k % 800 + 100')} AS edition
FROM seed WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = k)""",
    "raw_presence": """
SELECT pid AS processo_id, CASE WHEN k % 17 = 0 THEN NULL WHEN k % 18 = 0 THEN ''
         ELSE 'texto do contrato' END AS contract_text,
       CASE WHEN k % 19 = 0 THEN '' ELSE 'texto da publicação' END AS publication_text
FROM seed WHERE priority <> '2-HIGH'""",
    "answer_rows": f"""
SELECT pid AS processo_id, 'contract' AS kind,
       CASE WHEN k % 46 = 0 THEN NULL WHEN k % 47 = 0 THEN 'not json' WHEN k % 48 = 0 THEN '[1, 2]'
       ELSE '{{"processo_id": "' || pid || '", "contract_number": "' ||
            (CASE WHEN k % 20 = 0 THEN '777/2000' ELSE num END) || '", "signing_date": "' ||
            {dmy('d')} || '", "contratante": ' ||
            (CASE WHEN k % 21 = 0 THEN 'null' ELSE '"' || hiring || '."' END) ||
            ', "contratada": "' || lower(hired) || '"}}' END AS response FROM seed
UNION ALL
SELECT pid AS processo_id, 'publication' AS kind,
       CASE WHEN k % 51 = 0 THEN '' WHEN k % 52 = 0 THEN '{{bad' ELSE
       '{{"processo_id_in_pub": "' || pid || '", "contract_number_in_pub": "' || num ||
       '", "publication_date": "' || {dmy('(d + CAST(k % 45 - 3 AS INT))')} ||
       '", "contratante_in_pub": "' || hiring || '", "contratada_in_pub": "' ||
       (CASE WHEN k % 22 = 0 THEN 'OUTRA EMPRESA' ELSE hired END) || '"}}' END AS response FROM seed
UNION ALL
SELECT pid AS processo_id, 'r002' AS kind,
       CASE WHEN k % 55 = 0 THEN NULL WHEN k % 56 = 0 THEN 'oops' WHEN k % 57 = 0 THEN '"text"' ELSE
       '{{"contratante_match": ' || (CASE WHEN k % 19 = 0 THEN 'false' ELSE 'true' END) ||
       ', "contratada_match": ' || (CASE WHEN k % 26 = 0 THEN 'false' ELSE 'true' END) ||
       ', "overall_verdict": "' || (CASE WHEN k % 19 = 0 OR k % 26 = 0 THEN 'FAIL'
            WHEN k % 58 = 0 THEN 'MAYBE' ELSE 'pass' END) || '"' ||
       (CASE WHEN k % 60 = 0 THEN '' ELSE ', "confidence": "' || (CASE WHEN k % 14 = 0 THEN 'Low'
            WHEN k % 15 = 0 THEN 'medium' ELSE 'high' END) || '"' END) ||
       ', "contratante_explanation": "a", "contratada_explanation": "b"}}' END AS response FROM seed""",
    # -- runs --------------------------------------------------------------------------
    "run_log": """
SELECT e.event_id AS seq, s.pid AS processo_id,
       CASE WHEN e.user_id % 3 = 0 THEN 'stage2' WHEN e.user_id % 3 = 1 THEN 'stage3'
            ELSE 'stage4' END AS stage,
       CASE WHEN e.event_type = 'signup' THEN 'completed' WHEN e.event_type = 'error' THEN 'failed'
            WHEN e.event_type = 'click' THEN 'no_results'
            WHEN e.event_type = 'view' AND e.user_id % 3 = 0 THEN 'no_document'
            WHEN e.event_type = 'view' AND e.user_id % 3 = 1 THEN 'partial'
            WHEN e.event_type = 'view' THEN 'skipped'
            WHEN e.user_id % 3 = 1 THEN 'embedded' ELSE 'completed' END AS outcome,
       CASE WHEN e.event_type <> 'error' THEN NULL WHEN e.user_id % 4 = 0 THEN NULL
            ELSE 'erro ' || CAST(e.user_id AS STRING) END AS error,
       CAST(date_trunc('second', e.ts) AS STRING) AS logged_at,
       CASE WHEN e.event_type = 'view' THEN e.user_id % 9 ELSE NULL END AS successful,
       CASE WHEN e.event_type = 'view' THEN e.user_id % 4 + 1 ELSE NULL END AS failed
FROM events e JOIN seed s ON s.k = e.event_id - e.event_id % 3""",
    "failed_items": """
SELECT seq, processo_id, stage, 'TransientError' AS error_type, coalesce(error, '') AS error_msg,
       logged_at AS failed_at, seq % 5 AS retry_count, seq % 11 = 0 AS resolved
FROM run_log WHERE outcome = 'failed'""",
    "resolutions": """
SELECT processo_id, stage, seq, logged_at AS resolved_at FROM run_log WHERE outcome = 'completed'""",
    "stage_runs": """
SELECT event_id AS seq, event_type AS stage, 'logs/run_' || CAST(event_id AS STRING) || '.log' AS path,
       CAST(date_trunc('second', ts) AS STRING) AS modified_at FROM events""",
    "probes": """
SELECT 'portal_' || CAST(user_id % 4 AS STRING) AS portal, event_id AS seq, ts,
       event_type <> 'error' AS search_form, user_id % 10 <> 0 AS results_table,
       CASE WHEN event_type = 'view' THEN NULL ELSE value > 5 END AS pdf_link FROM events""",
    "stage_documents": f"""
SELECT 'compliance/' || replace(pid, '/', '_') || '_compliance.json' AS name,
       CASE WHEN k % 33 = 0 THEN '' WHEN k % 34 = 0 THEN '{{"processo_id": ' WHEN k % 35 = 0 THEN '{{}}'
       ELSE '{{"processo_id": "' || pid || '", "overall": {{"status": "' ||
         (CASE WHEN k % 2 = 0 THEN 'PASS' ELSE 'INCONCLUSIVE' END) || '", "review_reason": ' ||
         (CASE WHEN k % 5 = 0 THEN '"parse_error"' ELSE 'null' END) || '}}' ||
         (CASE WHEN k % 36 = 0 THEN ', "error": "x"' ELSE '' END) || '}}' END AS body
FROM seed""",
    "artifacts": """
SELECT pid AS processo_id, 'raw' AS artifact, k FROM seed WHERE status <> 'O' OR priority = '3-MEDIUM'
UNION ALL SELECT pid AS processo_id, 'pub_raw' AS artifact, k FROM seed WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = k)
UNION ALL SELECT processo_id, 'preprocessed' AS artifact, k FROM contracts
UNION ALL SELECT pid AS processo_id, 'pub_structured' AS artifact, k FROM seed WHERE status <> 'F' AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = k)
UNION ALL SELECT processo_id, 'compliance' AS artifact, k FROM contracts WHERE signing_date IS NOT NULL AND document_type = 'contract'
UNION ALL SELECT processo_id, 'conformity' AS artifact, k FROM contracts WHERE contratante IS NOT NULL AND document_type = 'contract' AND contract_number IS NOT NULL""",
    "artifact_docs": """
SELECT processo_id, artifact, k,
       '{"processo_id": "' || processo_id || '"' ||
       (CASE WHEN artifact = 'compliance' THEN ', "overall": {"status": "' ||
          (CASE WHEN k % 2 = 0 THEN 'PASS' ELSE 'INCONCLUSIVE' END) || '", "review_reason": ' ||
          (CASE WHEN k % 5 = 0 THEN '"Parse_Error"' ELSE 'null' END) || '}' ELSE '' END) ||
       (CASE WHEN k % 27 = 0 AND artifact <> 'conformity' THEN ', "error": "x"' ELSE '' END) || '}' AS body
FROM artifacts""",
    "finished_suppliers": """
SELECT DISTINCT o_custkey AS company_id FROM orders
WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""",
    "page_candidates": """
SELECT doc_id, 'digital' AS source, CASE WHEN lang = 'fr' THEN NULL ELSE text END AS text FROM documents
UNION ALL
SELECT doc_id, 'ocr_columns' AS source, CASE WHEN lang = 'es' THEN NULL ELSE text END AS text FROM documents"""
}


def ordered(names: list[str], views: dict[str, str]) -> list[str]:
    """The named views and all they read, dependencies first."""
    out: list[str] = []

    def visit(name: str) -> None:
        if name in out:
            return
        text = re.sub(r"'[^']*'", "''", views[name])
        words = set(re.findall(r"\b(?:FROM|JOIN|from|join)\s+([a-z][a-z_0-9]*)\b", text))
        for other in sorted(words & set(views)):
            if other != name:
                visit(other)
        out.append(name)

    for name in names:
        visit(name)
    return out


_VIEWS: dict[tuple[str, str], dict[str, str]] = {}


def _registered(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Temporary view names already made for this session and folder."""
    return _VIEWS.setdefault((spark.sparkContext.applicationId, sf_dir), {})


#: Tables dealt out before anything long is derived from their rows. Their source may be one Parquet
#: row group, which one task reads and, without a shuffle, would carry to the end. Processes lie by
#: their identifier, so the stage tables made from them meet without moving their rows again.
SPREAD = {"seed": "pid", "lineitem": "l_orderkey"}
#: Unions of spread tables whose rows all move again, read in as many tasks as one of their parts.
GATHERED = {"link_rows", "artifacts"}
#: Up to so many targets of a shuffle, Spark's writer opens one file for each of them in every task.
FILE_PER_TARGET = 200


def dealt(spark: SparkSession) -> int:
    """Enough partitions for every core, whatever the layout of the files.

    The number is stated, so adaptive execution does not join the narrow rows to few tasks. Joins
    of the rows take it over; where it is large it exceeds ``FILE_PER_TARGET``, so that a shuffle
    between such tables does not open its square of files.
    """
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(shuffled, 4 * spark.sparkContext.defaultParallelism)
    return parts if parts <= FILE_PER_TARGET // 2 else max(parts, FILE_PER_TARGET + 1)


def _view(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Register one base or derived table as a lazy view, after all it reads."""
    made = _registered(spark, sf_dir)
    if name in made:
        return made[name]
    alias = f"pactum_{abs(hash(sf_dir))}_{name}"
    if name in SQL:
        def inner(match: re.Match) -> str:
            other = match.group(2)
            known = other in SQL or other in BASE
            return f"{match.group(1)} {_view(spark, sf_dir, other) if known else other}"

        df = spark.sql(re.sub(r"\b(FROM|JOIN)\s+([a-z][a-z_0-9]*)\b", inner, SQL[name]))
    else:
        df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if name in SPREAD:
        df = df.repartition(dealt(spark), SPREAD[name])
    elif name in GATHERED:
        df = df.coalesce(dealt(spark))
    df.createOrReplaceTempView(alias)
    made[name] = alias
    return alias


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One base or derived table as a lazy DataFrame over the driver's Parquet files."""
    return spark.table(_view(spark, sf_dir, name))
