"""Word lists, tables, limits, tags, patterns and message formats.

Everything here must equal what users of the audit process already rely on
(verdict names, status labels, thresholds, gazette and contract patterns), so
it is stated as plain text in natural order.
"""

from __future__ import annotations

# -- limits ------------------------------------------------------------------
PUBLICATION_DEADLINE_DAYS = 20
MIN_TEXT_CHARS = 500
MIN_PRINTABLE_RATIO = 0.70
TYPE_ZONE_CHARS = 800
HEADER_ZONE_CHARS = 2000
EDITION_ZONE_CHARS = 500
OBJECT_CHARS = 400
BLOCK_BACK_CHARS = 600
BLOCK_FORWARD_CHARS = 800
TRIGGER_BACK_CHARS = 100
TRIGGER_FORWARD_CHARS = 1500
REQUEST_TEXT_CHARS = 4000
APPENDIX_SAMPLE_CHARS = 200
APPENDIX_DIGIT_RATIO = 0.15
SLUG_CHARS = 30
PARTIAL_SCORE_CAP = 85.0

# -- rules, verdicts, statuses -----------------------------------------------
RULES = ["R001", "R002", "R003", "R004"]
WEIGHTS = {"R001": 0.40, "R002": 0.30, "R003": 0.20, "R004": 0.10}
VERDICT_SCORES = {"PASS": 100, "FAIL": 0, "INCONCLUSIVE": 50, "INCOMPLETE": 50, "PARTIAL": 75}
DEFAULT_VERDICT_SCORE = 50
RULE_STATUS = {"PASS": "CONFORME", "FAIL": "NÃO CONFORME", "INCONCLUSIVE": "INCOMPLETE"}
DIAGNOSTIC_IMPACT = {
    "CONFIRMED": "CONFORME",
    "PARTIAL": "PARCIAL",
    "DIVERGENT": "INCOMPLETE",
    "SKIPPED": "PARCIAL",
}
STATUSES = ["CONFORME", "PARCIAL", "NÃO CONFORME", "INCOMPLETE"]
LEVEL_PRIORITY = {"FAILED": 1, "REVIEW": 2, "OK": 3}
PARTY_FIELDS = ["contratada", "contratada_in_pub", "contratante", "contratante_in_pub"]
CRITICAL_FIELDS = ["signing_date", "processo_id", "contract_number"]

ALERT_ACTIONS = {
    "MISSING_PUBLICATION": "extract_publication",
    "DIAGNOSTIC_DIVERGENCE": "manual_audit",
    "NON_CONFORME": "investigate_rule_failures",
    "NEEDS_REVIEW": "review_before_approval",
    "CONFORME": "no_action",
}
RECOMMENDATIONS = {
    "MISSING_PUBLICATION": "Run publication extraction/preprocessing before conformity scoring.",
    "DIAGNOSTIC_DIVERGENCE": "Manual audit required due to divergent extraction diagnostic.",
    "DIAGNOSTIC_PARTIAL": "Review partially divergent extracted fields before approval.",
}

# (field, key in the deterministic side, key in the answer, kind, critical)
CONTRACT_FIELD_MAP = [
    ("signing_date", "signing_date", "signing_date", "date", True),
    ("processo_id", "processo_id", "processo_id", "name", True),
    ("contract_number", "contract_number", "contract_number", "name", True),
    ("contratante", "contratante", "contratante", "name", False),
    ("contratada", "contratada", "contratada", "name", False),
]
PUBLICATION_FIELD_MAP = [
    ("publication_date", "publication_date", "publication_date", "date", True),
    ("processo_id_in_pub", "processo_id", "processo_id_in_pub", "name", True),
    ("contract_number_in_pub", "contract_number", "contract_number_in_pub", "name", True),
    ("contratante_in_pub", "contratante", "contratante_in_pub", "name", False),
    ("contratada_in_pub", "contratada", "contratada_in_pub", "name", False),
]

# -- stages --------------------------------------------------------------------
STAGES = ["SCORED", "COMPLIANCE", "PREPROCESSED", "PUB_FOUND", "EXTRACTED", "DISCOVERED"]
ARTIFACTS = ["raw", "pub_raw", "preprocessed", "pub_structured", "compliance", "conformity"]
MISSING_PHASE = {
    "DISCOVERED": "Extração de Contrato",
    "EXTRACTED": "Extração de Publicação",
    "PUB_FOUND": "Pré-processamento",
    "PREPROCESSED": "Análise de Conformidade",
}
SOURCE_GAZETTE = "doweb"
SOURCE_EMBEDDED = "embedded"
HINT_STRUCTURED = "structured_contract"
HINT_ADDENDUM = "possible_addendum"
HINT_UNKNOWN = "unknown"
NO_DOCUMENT_MESSAGES = ["Não há documento associado", "Documento não encontrado"]
PART_SEPARATOR = "\n\n--- DOCUMENT PART SEPARATOR ---\n\n"

# -- report labels ---------------------------------------------------------------
CONFORMITY_CSV_COLUMNS = [
    "processo_id", "agreement_level", "R001", "R002", "R003", "R004",
    "conformity_score", "overall_status", "flags",
]
ALERT_CSV_COLUMNS = [
    "processo_id", "alert_level", "reason", "overall_status", "conformity_score",
    "flags", "failed_rules",
]
QUEUE_CSV_COLUMNS = [
    "processo_id", "alert_level", "reason", "conformity_score", "failed_rules",
    "flags", "action", "priority_score",
]
REPORT_CSV_COLUMNS = [
    "processo_id", "agreement_level", "R001", "R002", "R003", "R004",
    "conformity_score", "overall_status", "flags", "pipeline_stage", "company_name",
    "contract_value", "contract_date", "publication_date", "days_to_publish",
    "primary_violation", "severity", "requires_review", "report_generated_at",
]
DETAIL_SHEET_COLUMNS = [
    "Processo ID", "Empresa", "Valor Contrato", "Status", "Score", "Nível Diagnóstico",
    "R001", "R002", "R003", "R004", "Dias p/ Publicar", "Violação Principal",
    "Severidade", "Requer Revisão", "Flags",
]

# -- calendar ----------------------------------------------------------------------
MONTHS_PT = {
    "janeiro": "01", "fevereiro": "02", "março": "03", "abril": "04",
    "maio": "05", "junho": "06", "julho": "07", "agosto": "08",
    "setembro": "09", "outubro": "10", "novembro": "11", "dezembro": "12",
}

# -- character classes ----------------------------------------------------------------
# White space of a Unicode-aware text strip/split, usable in Java and RE2 alike.
WS = (r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
      r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
WS_CHARS = "".join(
    chr(c) for c in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
                     *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
PRINTABLE_COMPLEMENT = r"[\p{C}\p{Z}&&[^ \n\r\t]]"

# -- identifiers --------------------------------------------------------------------
ID_FORMAT_A = r"^\d+\.\d+/\d{4}(?:-\d+)?$"
ID_FORMAT_B = r"^[A-Z]+-[A-Z]+-\d{4}/\d+$"
ID_FORMAT_C = r"^\d+/\d+\.\d+/\d{4}$"
PID_SUFFIX = r"\s*\.\s*[-–]?\s*(?:CO|TP|TA)\s*\d.*$"
CNPJ_FORMATTED = r"\d{2}\.\d{3}\.\d{3}/\d{4}-\d{2}"
CNPJ_BARE = r"\b\d{14}\b"
CURRENCY_MARKED = r"R\$\s*[\d.,]+"
CURRENCY_BARE = r"\d{1,3}(?:\.\d{3})*,\d{2}"
PUB_METADATA = (r"publicado\s+em:\s*(\d{2}/\d{2}/\d{4})\s*-\s*Edi[cç][aã]o\s+(\d+)"
                r"\s*-\s*P[áa]g\.\s*(\d+)")
ADDENDUM_WORDS = r"\b(APROVO|AUTORIZO)\b"

# -- contract text: noise, in order of removal ------------------------------------------
# (pattern, flags, category); flags: i ignore case, s dot-all, m multi-line
NOISE_PATTERNS = [
    (r"Assinado com senha por .{5,120}?\d{2}/\d{2}/\d{4} às \d{2}:\d{2}:\d{2}\.?",
     "s", "per_page_signatures"),
    (r"Documento N[oº°][:.]\s*\d{5,}-\d{4}\s*[-–]\s*consulta .{0,120}",
     "i", "per_page_signatures"),
    (r"https?://acesso\.processo\.rio/sigaex/public/app/autenticar\S*",
     "i", "per_page_signatures"),
    (r"\b[A-Z]{2,6}[A-Z]{2,4}\d{6,12}\b", "", "barcodes"),
    (r"P[aá]gina\s+\d+\s+de\s+\d+", "i", "page_markers"),
    (r"^\s*\d+\s+de\s+\d+\s*$", "m", "page_markers"),
    (r"(?:^.{5,80}$\n){1,5}(?:Tel\..{0,60}|CEP.{0,40})\n?", "m", "per_page_letterhead"),
]

# -- contract text: type and header ---------------------------------------------------------
CONTRACT_TYPE_ADDENDUM = r"TERMO\s+ADITIVO|ADITAMENTO|APOSTILAMENTO"
CONTRACT_TYPE_CONTRACT = (r"CONTRATO\s+N[oº°]|TERMO\s+DE\s+CONTRATO|TERMO\s+DE\s+COLABORA"
                          r"|TERMO\s+DE\s+EXECU|CONTRATO\s+DE\s+PATROC")
HEADER_NUMBER = r"(?:Contrato|CONTRATO)\s*[Nnº°oO.]*\s*[:\-]?\s*(\d{4,}[/\\]\d{4})"
HEADER_PROCESSO = (
    r"(?:Processo\s+(?:Instrutivo|Administrativo|n[oº°]?)?"
    r"|PROCESSO\s+(?:INSTRUTIVO|ADMINISTRATIVO|N[Oº°]?)?)"
    r"\s*[:\-]?\s*([\w\-.]+/\d{4,}(?:/\d+)?(?:\s*[-–.]\s*(?:CO|TP|TA)\s*\d+/\d+)?)")
HEADER_DATE_LABEL = (r"(?:Data\s+da\s+[Aa]ssinatura|DATA\s+DA\s+ASSINATURA)\s*[:\-]?\s*"
                     r"(\d{1,2}/\d{1,2}/\d{4})")
HEADER_DATE_PROSE = (r"Aos\s+(\d{1,2})\s+dias\s+do\s+m[eê]s\s+de\s+(\w+)"
                     r"\s+do\s+ano\s+de\s+(\d{4})")
HEADER_CONTRATANTE = r"(?:CONTRATANTE|contratante)\s*[:,]\s*([A-ZÁÉÍÓÚ][^\n,;]{5,120})"
HEADER_CONTRATADA = r"(?:CONTRATADA|contratada)\s*[:,]\s*([A-ZÁÉÍÓÚ][^\n,;]{5,120})"
HEADER_OBJECT = (
    r"(?:objeto\s*(?:do\s+presente)?|OBJETO)\s*[:\-]?\s*(.+?)"
    r"(?=\n\s*(?:Valor|VALOR|Vig[eê]n|Prazo|PRAZO|Data\s+da"
    r"|Par[aá]grafo\s+[Pp]rimeiro|CL[AÁ]USULA))")
# Prose openers that name both parties, first matching one wins.
PROSE_OPENING_DATE = (
    r"Aos\s+\d{1,2}\s+dias\s+do\s+m[eê]s.{0,200}?,\s+[ao]\s+"
    r"([A-ZÁÉÍÓÚ][^\n,]{5,120}(?:\n[A-Z][^\n,]{3,80})?)"
    r"(?:,\s+inscrit[ao]|,\s+CNPJ|,\s+representad).{0,800}?e\s+[ao]\s+empresa\s+"
    r"([A-ZÁÉÍÓÚ][^\n,]{5,120}(?:\n[A-Z][^\n,]{3,80})?)")
PROSE_ONE_SIDE = (
    r"de\s+um\s+lado[,.]?\s+[ao]\s+([A-ZÁÉÍÓÚ][^\n]{5,150}?)"
    r"(?:,\s+inscrit[ao]|,\s+CNPJ|,\s+neste\s+ato|\.\s+).{0,600}?"
    r"(?:[,;]\s+e\s+(?:[ao]\s+empresa\s+)?|\be\s+[ao]\s+empresa\s+)"
    r"([A-ZÁÉÍÓÚ][^,\n]{5,150})")
PROSE_BETWEEN = (
    r"entre\s+(?:si\s+)?(?:celebram\s+)?[ao]\s+([A-ZÁÉÍÓÚ][^,\n]{10,120})"
    r"(?:,\s+|\s+e\s+[ao]\s+(?:empresa\s+)?)([A-ZÁÉÍÓÚ][^,\n]{10,120})")
PARTY_TAILS = [r"\s*,?\s*inscrit[ao].{0,200}$", r"\s*,?\s*CNPJ.{0,100}$", r"\s+e\s*$"]

# -- contract text: structure ------------------------------------------------------------
CLAUSE_HEADING = r"^(CL[AÁ]USULA\s+([A-ZÁÉÍÓÚÀÂÊÔÃÕÜÇ\s]+?)\s*[–\-]\s*(.+?))$"
PARAGRAPH_HEADING = (r"^(Par[aá]grafo\s+(?:[A-ZÁÉÍÓÚ][a-záéíóúàâêôãõüç]+"
                     r"|\d+[oº°]?|\bÚnico\b|\búnico\b))")
APPENDIX_KEYWORDS = [
    "LISTAGEM", "QUADRO", "ANEXO", "TABELA", "CRONOGRAMA", "TERMO DE REFER",
    "MODELO", "PLANILHA", "ESPECIFICA", "PROPOSTA", "DECLARA",
]
EMBEDDED_TRIGGER = (
    r"EXTRATO\s+DE\s+INSTRUMENTO\s+CONTRATUAL|EXTRATO\s+INSTRUMENTO\s+CONTRATUAL"
    r"|EXTRATO\s+DE\s+INSTRUMENTO\s+CONTRATO|EXTRATO\s+DE\s+CONTRATO"
    r"|EXTRATO\s+DO\s+CONTRATO|EXTRATO\s+DE\s+TERMO\s+ADITIVO"
    r"|EXTRATO\s+DE\s+TERMO\s+DE\s+EXECU|D\.O\.RIO\b")

# -- gazette text ---------------------------------------------------------------------------
BLOCK_TRIGGER = (
    r"EXTRATO\s+DE\s+INSTRUMENTO\s+CONTRATUAL|EXTRATO\s+INSTRUMENTO\s+CONTRATUAL"
    r"|EXTRATO\s+DE\s+INSTRUMENTO\s+CONTRATO|EXTRATO\s+DE\s+CONTRATO"
    r"|EXTRATO\s+DO\s+CONTRATO|EXTRATO\s+DE\s+TERMO\s+ADITIVO"
    r"|EXTRATO\s+DE\s+TERMO\s+DE\s+EXECU|1\s*[-–]\s*Objeto\s*[:\-]")
MASTHEAD_DATE = (r"(?:Segunda|Terça|Quarta|Quinta|Sexta|Sábado|Domingo)(?:-feira)?,?\s+"
                 r"(\d{1,2})\s+de\s+(\w+)\s+de\s+(\d{4})")
EDITION = r"[Nn][oº°]\s*(\d{3,})|[Ee]di[cç][aã]o\s+[Nn]?[oº°]?\s*(\d{3,})"
GAZETTE_PROCESSO = HEADER_PROCESSO
GAZETTE_NUMBER = (
    r"(?:Contrato\s+n[oº°]*"
    r"|Instrumento[:\s]+(?:Termo\s+Aditivo\s+\S+\s+ao\s+)?[Cc]ontrato\s+n[oº°]*"
    r"|CONTRATO\s+N[Oº°]*)\s*[:\-]?\s*(\d{3,}[/\\]\d{4})")
GAZETTE_SIGNING = (r"(?:Data\s+da\s+[Aa]ssinatura|DATA\s+DA\s+ASSINATURA|Data[:\s]+\d)"
                   r"\s*[:\-]?\s*(\d{1,2}/\d{1,2}/\d{4})")
NUMBERED_DATE = r"4\s*[-–]\s*Data\s*[:\-]?\s*(\d{1,2}/\d{1,2}/\d{4})"
LABELLED_PARTIES = r"(?:Partes|PARTES)\s*[:\-]\s*(.+?)(?=\n|Objeto|OBJETO|$)"
LABELLED_OBJECT = (r"(?:Objeto|OBJETO)\s*[:\-]\s*(.+?)"
                   r"(?=\n(?:Valor|VALOR|Vig[eê]ncia|Nota|Fundamento|$)|\z)")
LABELLED_VALUE = r"(?:Valor\s+Total|VALOR\s+TOTAL|Valor|VALOR)\s*[:\-]?\s*R\$\s*([\d.,]+)"
NUMBERED_MARK = r"1\s*[-–]\s*Objeto\s*[:\-]"
NUMBERED_OBJECT = r"1\s*[-–]\s*Objeto\s*[:\-]\s*(.+?)(?=2\s*[-–]\s*Partes|$)"
NUMBERED_PARTIES = r"2\s*[-–]\s*Partes\s*[:\-]\s*(.+?)(?=3\s*[-–]|$)"
NUMBERED_VALUE = r"5\s*[-–]\s*Valor\s*[:\-]?\s*R\$\s*([\d.,]+)"
GAZETTE_TYPE_ADDENDUM = (r"EXTRATO\s+DE\s+TERMO\s+ADITIVO|EXTRATO\s+ADITIVO"
                         r"|Termo\s+Aditivo|ADITAMENTO")
GAZETTE_TYPE_CONTRACT = (
    r"EXTRATO\s+DE\s+(?:INSTRUMENTO\s+)?CONTRATUAL?|EXTRATO\s+D[OE]\s+CONTRATO"
    r"|EXTRATO\s+DE\s+INSTRUMENTO\s+CONTRATO|EXTRATO\s+DE\s+TERMO\s+DE\s+EXECU")
PARTY_SPLIT = r"(.{10,}?)\s+e\s+(.+)"

# -- search helps -----------------------------------------------------------------------------
# The letters, in both cases, that every match of a pattern begins with. None of them has a
# third spelling in Unicode case folding, as I, K and S have, unless that is listed too.
FIRST_LETTERS = {
    CONTRACT_TYPE_ADDENDUM: "TtAa",
    CONTRACT_TYPE_CONTRACT: "CcTt",
    HEADER_NUMBER: "C",
    HEADER_PROCESSO: "Pp",
    HEADER_DATE_LABEL: "D",
    HEADER_DATE_PROSE: "Aa",
    HEADER_CONTRATANTE: "Cc",
    HEADER_CONTRATADA: "Cc",
    HEADER_OBJECT: "Oo",
    PROSE_OPENING_DATE: "Aa",
    PROSE_ONE_SIDE: "Dd",
    PROSE_BETWEEN: "Ee",
    EMBEDDED_TRIGGER: "EeDd",
    BLOCK_TRIGGER: "Ee1",
    MASTHEAD_DATE: "SsTtQqDd\u017f",
    EDITION: "NnEe",
    GAZETTE_NUMBER: "CcIi\u0130\u0131",
    GAZETTE_SIGNING: "D",
    NUMBERED_DATE: "4",
    LABELLED_PARTIES: "Pp",
    LABELLED_OBJECT: "Oo",
    LABELLED_VALUE: "Vv",
    NUMBERED_MARK: "1",
    NUMBERED_OBJECT: "1",
    NUMBERED_PARTIES: "2",
    NUMBERED_VALUE: "5",
    GAZETTE_TYPE_ADDENDUM: "EeTtAa",
    GAZETTE_TYPE_CONTRACT: "Ee",
    PUB_METADATA: "Pp",
    NOISE_PATTERNS[1][0]: "Dd",
    NOISE_PATTERNS[2][0]: "Hh",
    NOISE_PATTERNS[3][0]: "A-Z",
    NOISE_PATTERNS[4][0]: "Pp",
}
# Words of which every match of a pattern holds one, as written; other texts need no search.
NOISE_WORDS = {
    NOISE_PATTERNS[0][0]: ["Assinado com senha por "],
    NOISE_PATTERNS[6][0]: ["Tel.", "CEP"],
}
