"""The audit rules once more in plain SQL, for checking the Spark plans.

Written for DuckDB over the same derived tables; independent of the operators.
"""

from __future__ import annotations

from pactum import constants as K


def trim_sql(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def date_sql(x: str) -> str:
    t = trim_sql(x)
    return (f"CASE WHEN regexp_full_match({t}, '\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}') "
            f"THEN CAST(try_strptime({t}, '%d/%m/%Y') AS DATE) END")


def name_sql(x: str) -> str:
    return (f"upper({trim_sql(f'''regexp_replace(regexp_replace({x}, '[.,;:/\\\\-]', ' ', 'g'), '\\s+', ' ', 'g')''')})")


def brl_sql(x: str) -> str:
    bare = f"replace(replace({trim_sql(x)}, 'R$', ''), ' ', '')"
    return (f"TRY_CAST(CASE WHEN contains({bare}, ',') THEN replace(replace({bare}, '.', ''), ',', '.') "
            f"ELSE {bare} END AS DOUBLE)")


def same_sql(left: str, right: str, kind: str) -> str:
    if kind == "date":
        same = f"({date_sql(left)}) IS NOT DISTINCT FROM ({date_sql(right)})"
    else:
        same = f"{name_sql(left)} = {name_sql(right)}"
    return (f"CASE WHEN {left} IS NULL AND {right} IS NULL THEN true "
            f"WHEN {left} IS NULL OR {right} IS NULL THEN false ELSE {same} END")


def score_sql(v: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {n}" for k, n in K.VERDICT_SCORES.items())
    return f"(CASE {v} {cases} ELSE {K.DEFAULT_VERDICT_SCORE} END)"


def object_sql(x: str) -> str:
    """A text as JSON when it is an object, else null."""
    return (f"CASE WHEN json_valid({x}) THEN CASE WHEN json_type(CAST({x} AS JSON)) = 'OBJECT' "
            f"THEN CAST({x} AS JSON) END END")


def compare_sql(field_map: list, answer: str, det: dict[str, str], out: str) -> str:
    """Sorted lists of confirmed and divergent fields, and the level, of one side."""
    tests = {
        field: same_sql(det[det_key], f"({answer} ->> '{answer_key}')", kind)
        for field, det_key, answer_key, kind, _ in field_map
    }
    no = ", ".join(f"CASE WHEN NOT ({t}) THEN '{f}' END" for f, t in tests.items())
    yes = ", ".join(f"CASE WHEN ({t}) THEN '{f}' END" for f, t in tests.items())
    bad = f"list_filter([{no}], lambda x: x IS NOT NULL)"
    good = f"list_filter([{yes}], lambda x: x IS NOT NULL)"
    critical = ", ".join(f"'{f}'" for f in K.CRITICAL_FIELDS)
    return f"""CASE WHEN {answer} IS NOT NULL THEN {bad} END AS {out}_bad,
  CASE WHEN {answer} IS NOT NULL THEN {good} END AS {out}_good,
  CASE WHEN {answer} IS NULL THEN NULL WHEN list_has_any({bad}, [{critical}]) THEN 'DIVERGENT'
       WHEN len({bad}) > 0 THEN 'PARTIAL' ELSE 'CONFIRMED' END AS {out}_level"""


def joined_list(x: str) -> str:
    return f"coalesce(array_to_string({x}, '|'), '')"


def failed_list(prefix: str = "v") -> str:
    items = ", ".join(f"CASE WHEN {prefix}{i} = 'FAIL' THEN 'R00{i}' END" for i in range(1, 5))
    return f"list_filter([{items}], lambda x: x IS NOT NULL)"


CHECK_VIEWS: dict[str, str] = {
    "k_answers": """
SELECT processo_id, max(CASE WHEN kind = 'contract' THEN response END) AS a_contract,
       max(CASE WHEN kind = 'publication' THEN response END) AS a_publication,
       max(CASE WHEN kind = 'r002' THEN response END) AS a_r002
FROM answer_rows GROUP BY processo_id""",
    "k_joined": f"""
SELECT c.processo_id, c.contract_number AS c_num, c.signing_date AS c_date,
       c.contratante AS c_hiring, c.contratada AS c_hired, c.header_value, c.value AS top_value,
       p.processo_id IS NOT NULL AS pub, p.source, p.publication_date AS p_date,
       p.contract_number AS p_num, p.value AS p_value,
       CASE WHEN c.emb_found AND c.emb_contratante <> '' AND p.processo_id IS NOT NULL
            THEN c.emb_contratante ELSE p.contratante END AS p_hiring,
       CASE WHEN c.emb_found AND c.emb_contratada <> '' AND p.processo_id IS NOT NULL
            THEN c.emb_contratada ELSE p.contratada END AS p_hired,
       coalesce(r.contract_text <> '', false) AS has_contract_text,
       coalesce(r.publication_text <> '', false) AS has_publication_text,
       a.a_contract, a.a_publication, a.a_r002
FROM contracts c LEFT JOIN publications p ON p.processo_id = c.processo_id
LEFT JOIN raw_presence r ON r.processo_id = c.processo_id
LEFT JOIN k_answers a ON a.processo_id = c.processo_id""",
    "k_usable": f"""
SELECT *, pub AND has_contract_text AND has_publication_text AS usable,
       CASE WHEN pub AND has_contract_text AND has_publication_text THEN {object_sql('a_contract')} END AS j_contract,
       CASE WHEN pub AND has_contract_text AND has_publication_text THEN {object_sql('a_publication')} END AS j_publication
FROM k_joined""",
    "k_diag": f"""
SELECT *, {compare_sql(K.CONTRACT_FIELD_MAP, 'j_contract',
        {'processo_id': 'processo_id', 'contract_number': 'c_num', 'signing_date': 'c_date',
         'contratante': 'c_hiring', 'contratada': 'c_hired'}, 'cd')},
  {compare_sql(K.PUBLICATION_FIELD_MAP, 'j_publication',
        {'processo_id': 'processo_id', 'contract_number': 'p_num', 'publication_date': 'p_date',
         'contratante': 'p_hiring', 'contratada': 'p_hired'}, 'pd')}
FROM k_usable""",
    "k_merged": f"""
SELECT *, list_sort(list_distinct(coalesce(cd_bad, []) || coalesce(pd_bad, []))) AS bad,
       list_sort(list_distinct(coalesce(cd_good, []) || coalesce(pd_good, []))) AS good,
       CASE WHEN NOT usable OR (cd_level IS NULL AND pd_level IS NULL) THEN 'SKIPPED'
            WHEN cd_level = 'DIVERGENT' OR pd_level = 'DIVERGENT' THEN 'DIVERGENT'
            WHEN cd_level = 'PARTIAL' OR pd_level = 'PARTIAL' THEN 'PARTIAL' ELSE 'CONFIRMED' END AS level,
       {date_sql('c_date')} AS signed, {date_sql('p_date')} AS published,
       coalesce(c_hiring <> '' AND p_hiring <> '' AND c_hired <> '' AND p_hired <> '', false) AS parties
FROM k_diag""",
    "k_r001": f"""
SELECT *, date_diff('day', signed, published) AS delta,
       CASE WHEN NOT pub THEN 'no_publication_found'
            WHEN list_has_any(bad, ['signing_date', 'publication_date']) THEN 'divergent_date'
            WHEN coalesce(c_date, '') = '' OR coalesce(p_date, '') = '' THEN 'missing_date'
            WHEN signed IS NULL OR published IS NULL THEN 'unparseable_date'
            WHEN published < signed THEN 'negative_delta' END AS r1_reason
FROM k_merged""",
    "k_asked": f"""
SELECT *, CASE WHEN r1_reason IS NOT NULL THEN 'INCONCLUSIVE' WHEN delta <= 20 THEN 'PASS' ELSE 'FAIL' END AS v1,
       CASE WHEN r1_reason IS NULL OR r1_reason = 'negative_delta' THEN delta END AS r1_days,
       CASE WHEN parties AND level <> 'DIVERGENT' THEN a_r002 END AS r2_text,
       CASE WHEN parties AND level <> 'DIVERGENT' THEN {object_sql('a_r002')} END AS r2
FROM k_r001""",
    "k_r002": """
SELECT *, lower(coalesce(r2 ->> 'confidence', 'low')) AS r2_conf,
       upper(coalesce(r2 ->> 'overall_verdict', '')) AS r2_says,
       coalesce((r2 ->> 'contratante_match') = 'true', false)
         AND coalesce((r2 ->> 'contratada_match') = 'true', false) AS r2_both
FROM k_asked""",
    "k_r002b": """
SELECT *, CASE WHEN NOT pub THEN 'no_publication_found'
      WHEN list_has_any(bad, ['contratante', 'contratada', 'contratante_in_pub', 'contratada_in_pub'])
        THEN 'divergent_party'
      WHEN NOT parties THEN 'missing_party' WHEN r2_text IS NULL THEN 'llm_unavailable'
      WHEN r2 IS NULL THEN 'llm_parse_error' WHEN r2_conf = 'low' THEN 'llm_low_confidence'
      WHEN r2_says = 'FAIL' OR NOT r2_both OR r2_says = 'PASS' THEN NULL
      ELSE 'llm_unexpected_verdict' END AS r2_reason
FROM k_r002""",
    "k_compliance": """
SELECT *, CASE WHEN r2_reason IS NOT NULL THEN 'INCONCLUSIVE'
      WHEN r2_says = 'PASS' AND r2_both THEN 'PASS' ELSE 'FAIL' END AS v2
FROM k_r002b""",
    "k_overall": """
SELECT *, CASE WHEN NOT pub THEN 'INCONCLUSIVE' WHEN v1 = 'FAIL' OR v2 = 'FAIL' THEN 'FAIL'
      WHEN v1 = 'INCONCLUSIVE' OR v2 = 'INCONCLUSIVE' OR level = 'DIVERGENT' THEN 'INCONCLUSIVE'
      ELSE 'PASS' END AS status,
   CASE WHEN NOT pub THEN 'no_publication_found' WHEN v1 = 'FAIL' OR v2 = 'FAIL' THEN 'one_or_more_rules_failed'
      WHEN v1 = 'INCONCLUSIVE' OR v2 = 'INCONCLUSIVE' OR level = 'DIVERGENT' THEN
        array_to_string(list_filter([CASE WHEN v1 = 'INCONCLUSIVE' THEN 'r001_inconclusive' END,
          CASE WHEN v2 = 'INCONCLUSIVE' THEN 'r002_inconclusive' END,
          CASE WHEN level = 'DIVERGENT' THEN 'diagnostic_divergent' END], lambda x: x IS NOT NULL), ',')
      WHEN level = 'PARTIAL' THEN 'diagnostic_partial' END AS review_reason,
   NOT pub OR v1 <> 'PASS' OR v2 <> 'PASS' OR level IN ('DIVERGENT', 'PARTIAL') AS status_review
FROM k_compliance""",
    "k_values": f"""
SELECT *, coalesce(nullif(header_value, ''), nullif(top_value, '')) AS c_value,
       {brl_sql("coalesce(nullif(header_value, ''), nullif(top_value, ''))")} AS cv, {brl_sql('p_value')} AS pv,
       lower({trim_sql("coalesce(c_num, '')")}) AS n1, lower({trim_sql("coalesce(p_num, '')")}) AS n2
FROM k_overall""",
    "k_rules": """
SELECT *, CASE WHEN cv <> 0 AND level <> 'DIVERGENT' THEN round(abs(cv - pv) / abs(cv) * 100, 6)
            WHEN cv = 0 AND pv = 0 AND level <> 'DIVERGENT' THEN 0.0 END AS pct,
       CASE WHEN level = 'DIVERGENT' THEN 'SKIPPED' WHEN n1 = '' OR n2 = '' THEN 'INCOMPLETE'
            WHEN n1 = n2 THEN 'PASS' ELSE 'FAIL' END AS v3
FROM k_values""",
    "k_verdicts": """
SELECT *, CASE WHEN level = 'DIVERGENT' THEN 'SKIPPED' WHEN cv IS NULL OR pv IS NULL THEN 'INCOMPLETE'
            WHEN pct = 0 THEN 'PASS' WHEN pct <= 1 THEN 'PARTIAL' ELSE 'FAIL' END AS v4
FROM k_rules""",
    "k_scored": f"""
SELECT *, {score_sql('v1')} AS s1, {score_sql('v2')} AS s2, {score_sql('v3')} AS s3, {score_sql('v4')} AS s4,
       (4 * {score_sql('v1')} + 3 * {score_sql('v2')} + 2 * {score_sql('v3')} + {score_sql('v4')}) / 10.0 AS weighted
FROM k_verdicts""",
    "k_gated": """
SELECT *, CASE WHEN NOT pub OR level = 'DIVERGENT' THEN 0.0 WHEN level = 'PARTIAL' THEN least(weighted, 85.0)
            ELSE weighted END AS score,
       list_filter([CASE level WHEN 'DIVERGENT' THEN 'DIAGNOSTIC_DIVERGENCE' WHEN 'PARTIAL' THEN 'DIAGNOSTIC_PARTIAL'
            WHEN 'SKIPPED' THEN 'DIAGNOSTIC_SKIPPED' END, CASE WHEN NOT pub THEN 'MISSING_PUBLICATION' END],
            lambda x: x IS NOT NULL) AS flags,
       level IN ('DIVERGENT', 'PARTIAL') OR NOT pub AS review
FROM k_scored""",
    "k_conformity": """
SELECT *, CASE WHEN NOT pub OR level = 'DIVERGENT' THEN 'INCOMPLETE' WHEN score >= 90 THEN 'CONFORME'
            WHEN score BETWEEN 60 AND 89 THEN 'PARCIAL' ELSE 'NÃO CONFORME' END AS final
FROM k_gated""",
    "k_reason": """
SELECT *, CASE WHEN list_contains(flags, 'MISSING_PUBLICATION') THEN 'MISSING_PUBLICATION'
            WHEN list_contains(flags, 'DIAGNOSTIC_DIVERGENCE') THEN 'DIAGNOSTIC_DIVERGENCE'
            WHEN final = 'NÃO CONFORME' THEN 'NON_CONFORME'
            WHEN final IN ('PARCIAL', 'INCOMPLETE') OR review THEN 'NEEDS_REVIEW' ELSE 'CONFORME' END AS reason
FROM k_conformity""",
    "k_alerts": f"""
SELECT *, CASE reason WHEN 'CONFORME' THEN 'OK' WHEN 'NEEDS_REVIEW' THEN 'REVIEW' ELSE 'FAILED' END AS alert_level,
       CASE reason WHEN 'MISSING_PUBLICATION' THEN 'extract_publication' WHEN 'DIAGNOSTIC_DIVERGENCE' THEN 'manual_audit'
            WHEN 'NON_CONFORME' THEN 'investigate_rule_failures' WHEN 'NEEDS_REVIEW' THEN 'review_before_approval'
            ELSE 'no_action' END AS action,
       {failed_list()} AS failed
FROM k_reason""",
    "k_queue": """
SELECT *, CASE alert_level WHEN 'FAILED' THEN 1 WHEN 'REVIEW' THEN 2 ELSE 3 END AS prio
FROM k_alerts WHERE alert_level <> 'OK'""",
    "k_artifacts": """
SELECT processo_id, artifact, coalesce(list_contains(json_keys(body), 'error'), false)
  OR (artifact = 'compliance' AND body ->> '$.overall.status' = 'INCONCLUSIVE'
      AND coalesce(contains(lower(body ->> '$.overall.review_reason'), 'error'), false)) AS is_error FROM artifact_docs""",
    "k_found": """
SELECT l.processo_id, l.n_links, {} FROM (SELECT processo_id, count(*) AS n_links FROM links WHERE processo_id <> '' GROUP BY 1) l
{}""".format(
        ", ".join(f"a_{a}.processo_id IS NOT NULL AS has_{a}, coalesce(a_{a}.is_error, false) AS err_{a}" for a in K.ARTIFACTS),
        " ".join(f"LEFT JOIN (SELECT * FROM k_artifacts WHERE artifact = '{a}') a_{a} ON a_{a}.processo_id = l.processo_id" for a in K.ARTIFACTS)),
    "k_state": """
SELECT *, replace(processo_id, '/', '_') AS pid_safe, CASE WHEN has_conformity THEN 'SCORED' WHEN has_compliance THEN 'COMPLIANCE' WHEN has_preprocessed AND has_pub_structured THEN 'PREPROCESSED'
   WHEN has_pub_raw THEN 'PUB_FOUND' WHEN has_raw THEN 'EXTRACTED' ELSE 'DISCOVERED' END AS pipeline_stage,
  CASE WHEN has_conformity THEN err_conformity WHEN has_compliance THEN err_compliance WHEN has_preprocessed THEN err_preprocessed
   WHEN has_pub_raw THEN err_pub_raw WHEN has_raw THEN err_raw ELSE false END AS error_flag FROM k_found""",
    "k_meta": """
SELECT trim(processo_id) AS processo_id, arg_max(coalesce(company_name, ''), pos) AS company_name, arg_max(contract_value, pos) AS contract_value
FROM links WHERE trim(processo_id) <> '' GROUP BY 1""",
    "k_report": """
SELECT k.processo_id, k.pipeline_stage, k.error_flag, k.has_raw, k.has_pub_raw, k.has_preprocessed, k.has_pub_structured,
  coalesce(m.company_name, '') AS company_name, coalesce(m.contract_value, '') AS contract_value, coalesce(c.signing_date, '') AS contract_date,
  coalesce(p.publication_date, '') AS publication_date, date_diff('day', {}, {}) AS days_to_publish,
  coalesce(s.final, '') AS overall_status, CAST(coalesce(s.score, 0.0) AS DOUBLE) AS conformity_score, coalesce(s.level, '') AS agreement_level,
  coalesce(s.v1, '') AS R001_verdict, coalesce(s.v2, '') AS R002_verdict, coalesce(s.v3, '') AS R003_verdict, coalesce(s.v4, '') AS R004_verdict,
  s.s1, s.s2, s.s3, s.s4, coalesce(s.flags, []) AS flags, coalesce(s.review, false) AS requires_review,
  CASE WHEN s.v1 = 'FAIL' THEN 'R001' WHEN s.v2 = 'FAIL' THEN 'R002' WHEN s.v3 = 'FAIL' THEN 'R003' WHEN s.v4 = 'FAIL' THEN 'R004' ELSE '' END AS primary_violation,
  CASE WHEN s.score >= 90 THEN 'BAIXA' WHEN s.score >= 60 THEN 'MÉDIA' ELSE 'ALTA' END AS severity, s.processo_id IS NOT NULL AS is_scored
FROM k_state k LEFT JOIN k_meta m ON m.processo_id = k.processo_id LEFT JOIN contracts c ON c.processo_id = k.processo_id
LEFT JOIN publications p ON p.processo_id = k.processo_id LEFT JOIN k_conformity s ON s.processo_id = k.processo_id""".format(
        date_sql("c.signing_date"), date_sql("p.publication_date")),
}
