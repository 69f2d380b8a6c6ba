"""Identifiers, names, text quality and both text parsers."""

import pytest
from pyspark.sql import functions as F

from pactum import constants as K
from pactum.functions import ids, names
from pactum.functions import text as X
from pactum.functions.dates import masthead_date
from pactum.functions.gazette import classify_content, publication_metadata
from pactum.operators.contract_text import preprocess_contracts, remove_noise
from pactum.operators.diagnostic import values_match
from pactum.operators.gazette_text import parse_gazette, with_block
from pactum.operators.runs import merge_parts, merged_measures, with_quality
from pactum.constants import PART_SEPARATOR

LABELLED = """\
COMPANHIA DE FILMES S/A - FILMES
EXTRATO DE INSTRUMENTO CONTRATUAL
Processo Instrutivo: ABC-PRO-2023/00482.- CO 01/2024.
Contrato nº: 2403453/2024.
Data da Assinatura: 16/09/2024.
Partes: Companhia de Filmes S.A - FILMES e Luz Vital Exibições LTDA.
Objeto: Contratação de empresa especializada.
Valor Total: R$ 1.216.829,52
Vigência: 24 meses.
"""
NUMBERED = ("Processo TUR-PRO-2025/01221 1-Objeto: operação do Centro 2-Partes: TURISMO e EMPRESA "
            "XPTO LTDA 3-Instrumento: Contrato nº 059/2023 4-Data: 03/02/2026 5-Valor: R$ 287.000,00\n")
MASTHEAD = "Segunda-feira, 30 de Setembro de 2024\nD.O. — Edição 136\n\n"
CONTRACT = """CONTRATO Nº 2403453/2024

Página 3 de 14
Processo Instrutivo: ABC-PRO-2023/00482.- CO 01/2024.
Data da Assinatura: 16/09/2024.
Partes: CONTRATANTE: COMPANHIA DE FILMES S/A - FILMES e
CONTRATADA: LUZ VITAL EXIBIÇÕES LTDA.

CLÁUSULA PRIMEIRA - OBJETO

Constitui objeto do presente a contratação de empresa.

Parágrafo Primeiro – Situado na entrada principal.

Parágrafo Segundo – É vedada a cessão.

CLÁUSULA SEGUNDA – PRAZO

O prazo é de 24 meses.

LISTAGEM DE BENS
1 22 333 4444 55555
QUADRO FUNCIONAL
Gerente
"""


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(column.alias("x")).head()[0]


@pytest.mark.parametrize(
    "pid, fmt, spellings",
    [
        ("006800.000136/2026-28", "A",
         ["006800.000136/2026-28", "006800.000136/2026", "006800000136/2026-28",
          "006800000136/2026", "06800000136/2026-28", "06800000136/2026", "6800000136/2026-28",
          "6800000136/2026"]),
        ("TUR-PRO-2025/01221", "B", ["TUR-PRO-2025/01221", "TURPRO2025/01221", "TURPRO202501221"]),
        ("12/500.078/2021", "C", ["12/500.078/2021", "012/500.078/2021", "12500.0782021"]),
        ("GARBAGE-ID", "UNKNOWN", ["GARBAGE-ID"]),
    ],
)
def test_identifier_spellings(spark, pid, fmt, spellings):
    assert one(spark, ids.detect_format(F.col("p")), p=pid) == fmt
    assert one(spark, ids.id_variations(F.col("p")), p=pid) == spellings


def test_identifier_helpers(spark):
    assert one(spark, ids.normalise_pid(F.col("p")), p="ABC-PRO-2023/00482.- CO 01/2024") == "ABC-PRO-2023/00482"
    assert one(spark, ids.pid_from_file_name(F.col("p")), p="ABC_PRO_2023_00482_preprocessed.json") == "ABC-PRO-2023/00482"
    assert one(spark, ids.find_cnpj(F.col("p")), p="x 12345678000195 y") == "12.345.678/0001-95"
    assert one(spark, ids.company_id(F.col("p"), F.lit(None).cast("string")), p="Ação & Cia.") == "AOCIA"


@pytest.mark.parametrize(
    "left, right, kind, same",
    [("ARTE E CULTURA LTDA", "Arte e Cultura Ltda.", "name", True), ("S/A", "S A", "name", True),
     ("X", "Y", "name", False), (None, None, "name", True), (None, "x", "name", False),
     ("1/2/2024", "01/02/2024", "date", True), ("zz", "yy", "date", True),
     ("zz", "01/02/2024", "date", False)],
)
def test_values_match(spark, left, right, kind, same):
    assert one(spark, values_match(F.col("a"), F.col("b"), kind), a=left, b=right) is same


def test_party_names(spark):
    assert one(spark, names.clean_party(F.col("p")), p="COMPANHIA - FILMES e") == "COMPANHIA - FILMES"
    assert one(spark, names.clean_party(F.col("p")), p="LUZ\nVITAL LTDA, inscrita no CNPJ 1") == "LUZ VITAL LTDA"
    assert one(spark, names.clean_party(F.col("p")), p="ARTE E CULTURA LTDA") == "ARTE E CULTURA LTDA"
    assert tuple(one(spark, names.split_parties(F.col("p")), p="TURISMO e EMPRESA X")) == ("TURISMO e EMPRESA X", None)


def test_content_hint_and_metadata(spark):
    def hint(text, pid="TUR-PRO-2025/01221"):
        return one(spark, classify_content(F.col("s"), F.col("p")), s=text, p=pid)

    assert hint(NUMBERED) == "structured_contract"
    assert hint(NUMBERED, "OUT-PRO-2025/1") == "unknown"
    assert hint("Autorizo o ato") == "possible_addendum"
    assert hint("x+y(", "a+b(") == "unknown"
    meta = one(spark, publication_metadata(F.col("t")), t="publicado em: 03/02/2026 - Edição 218 - Pág. 38")
    assert tuple(meta) == ("03/02/2026", "218", "38")
    assert tuple(one(spark, publication_metadata(F.col("t")), t="nada")) == ("", "", "")


def test_quoted_and_strip(spark):
    assert one(spark, X.quoted(F.col("t")), t="d'or") == '"d\'or"'
    assert one(spark, X.quoted(F.col("t")), t=None) == "None"
    assert one(spark, X.strip(F.col("t")), t="  a b  \n") == "a b"
    assert one(spark, X.word_count(F.col("t")), t=" um dois três ") == 3


def test_quality(spark):
    rows = [("long", "palavra " * 80), ("short", "oi"), ("empty", ""), ("garbled", "\x00\x01" * 400)]
    df = with_quality(spark.createDataFrame(rows, "k string, t string"), "t")
    got = {r.k: r for r in df.collect()}
    assert got["long"].quality_passes and got["long"].printable_ratio == 1.0
    assert got["short"].quality_flags == ["low_char_count:2<500"]
    assert len(got["empty"].quality_flags) == 2 and got["empty"].printable_ratio == 0.0
    assert got["garbled"].quality_flags == ["low_printable_ratio:0.00<0.7"]


def test_parse_gazette_formats(spark):
    docs = spark.createDataFrame(
        [("ABC-PRO-2023/00482", LABELLED), ("TUR-PRO-2025/01221", NUMBERED),
         ("ABC-PRO-2023/00482", MASTHEAD + LABELLED)], "processo_id string, raw_text string")
    a, b, c = [r.parsed for r in parse_gazette(docs).select("parsed").collect()]
    assert (a.processo_id_in_text, a.contract_number, a.signing_date_in_pub) == (
        "ABC-PRO-2023/00482", "2403453/2024", "16/09/2024")
    assert (a.contratante, a.contratada) == ("Companhia de Filmes S.A - FILMES", "Luz Vital Exibições LTDA")
    assert (a.value, a.edition, a.document_type) == ("1.216.829,52", None, "contract")
    assert a.warnings == ["missing:publication_date"]
    assert (b.object_summary, b.value, b.signing_date_in_pub) == ("operação do Centro", "287.000,00", "03/02/2026")
    assert (c.publication_date, c.edition) == ("30/09/2024", "136")


def test_block_takes_the_mention_near_a_trigger(spark):
    pid = "ABC-PRO-2023/00482"
    far = f"citado {pid} " + "x" * 2000 + "\U0001F600" * 50 + LABELLED
    block = with_block(spark.createDataFrame([(pid, far)], "p string, t string"), "t", "p").head()._block
    at = far.index(pid, 100)
    assert block == far[at - 600:at + 800]


def test_first_mention_is_where_the_marks_begin(spark):
    rows = [("ab", "xxAByy"), ("a.b", "axb a.b"), ("12", "é İ 12"), (r"q\Ez", r"..Q\EZ"), ("É1", "...é1 É1"), ("", "t"), ("no", "t")]
    df = spark.createDataFrame(rows, "i string, t string")
    marked, at = X.mentions_marked(F.col("t"), F.col("i")), X.first_mention(F.col("t"), F.col("i"))
    for r in df.select("t", marked.alias("m"), at.alias("at")).collect():
        assert r.at == r.m.find(X.MENTION)


def test_a_later_mention_near_a_trigger_is_taken(spark):
    text = "P-1 " + "x " * 600 + "extrato  de contrato p-1" + " y" * 500
    block = with_block(spark.createDataFrame([("P-1", text)], "p string, t string"), "t", "p").head()._block
    start = text.index("p-1")
    assert block == text[start - K.BLOCK_BACK_CHARS:start + K.BLOCK_FORWARD_CHARS]


def test_preprocess_contract(spark):
    text = CONTRACT + "\n" + MASTHEAD + LABELLED
    df = preprocess_contracts(spark.createDataFrame(
        [("ABC-PRO-2023/00482", CONTRACT), ("E", text), ("N", "sem nada")],
        "processo_id string, raw_text string"))
    rows = {r.processo_id: r for r in df.collect()}
    plain = rows["ABC-PRO-2023/00482"]
    assert plain.document_type == "contract" and plain.noise_removed == ["page_markers"]
    assert plain.header.contratante == "COMPANHIA DE FILMES S/A - FILMES"
    assert plain.header.contratada == "LUZ VITAL EXIBIÇÕES LTDA"
    assert plain.header.object_summary == "Constitui objeto do presente a contratação de empresa."
    assert [c.number for c in plain.clauses] == ["PRIMEIRA", "SEGUNDA"]
    assert [p.content for p in plain.clauses[0].paragraphs] == ["Situado na entrada principal.", "É vedada a cessão."]
    assert plain.clauses[1].content == "O prazo é de 24 meses."
    assert [(a.header, a.type) for a in plain.appendices] == [("LISTAGEM DE BENS", "table"), ("QUADRO FUNCIONAL", "text")]
    assert not plain.embedded_publication.found and plain.warnings == []
    assert rows["E"].embedded_publication.found
    assert rows["E"].embedded_publication.publication_date == "30/09/2024"
    assert rows["N"].warnings[-1] == "no_clauses_detected"


def test_merged_parts_equal_the_plain_join(spark):
    cases = {
        "a": ["  um ", "dois\n", " tres\t"], "b": ["   ", "x", "  "], "c": ["  só  "], "d": ["  "],
        "e": ["p" * 300, "q" * 300], "many": [f"parte {i} " for i in range(150)],
    }
    rows = [(k, i, True, t, 2, 10) for k, parts in cases.items() for i, t in enumerate(parts, 1)]
    rows.append(("a", 9, False, "fora", 5, 10))
    parts = spark.createDataFrame(
        rows, "processo_id string, part bigint, success boolean, text string, pages bigint, pdf_size_bytes bigint")
    merged = merge_parts(parts).collect()
    texts = {r.processo_id: r.text for r in merged}
    assert len(merged) == len(cases)
    want = {k: PART_SEPARATOR.join(v) for k, v in cases.items()}
    assert texts == want
    got = {r.processo_id: r for r in merged_measures(parts).collect()}
    for key, text in want.items():
        assert got[key].total_chars == len(text.strip()), key
        assert got[key].quality_passes == (len(text.strip()) >= 500)
    assert (got["a"].page_count, got["a"].pdf_size_bytes) == (6, 40)


def test_guarded_patterns_match_as_plain_ones(spark):
    words = ["ſegunda-feira, 3 de março de 2026", "Sábado 1 de maio de 2020", "ınstrumento: contrato nº 123/2024",
             "İNSTRUMENTO contrato n 1234/2024", "extrato do contrato", "d.o.rio", "1 - objeto: a 2 - partes: b e c 3-",
             "4-data: 1/2/2024 5-valor r$ 3,00", "PARTES: A e B", "objeto: x\nvalor", "VALOR TOTAL: R$ 2", "Edição 123",
             "no 1234", "entre si celebram a Companhia Municipal, Empresa de Filmes", "Termo Aditivo", "aditamento",
             "de um lado, a Companhia Municipal, neste ato, e a empresa Filmes Ltda", "CONTRATO Nº 12345/2024",
             "Processo n 12/2024", "Aos 3 dias do mês de maio do ano de 2024", "Contratante: Companhia Municipal",
             "Data da Assinatura: 1/2/2024", "publicado em: 01/02/2024 - Edição 12 - Pág. 3", "OBJETO: lote\nValor",
             "Aos 3 dias do mês de maio, a Companhia Municipal, CNPJ 1, e a empresa Filmes Ltda",
             "Documento Nº: 12345-2024 - consulta x", "https://acesso.processo.rio/sigaex/public/app/autenticar?a",
             "FILCAP123456789", "Página 1 de 3", "CONTRATANTE: Companhia", "CONTRATADA: Empresa Filmes", "Contratada: Empresa Filmes"]
    texts = spark.createDataFrame([(f"ação {w}.", ) for w in words] + [("x " + " ".join(words),)], "t string")
    for pattern in K.FIRST_LETTERS:
        for flags in ("", "i", "is"):
            plain = f"(?{flags}{'u' if 'i' in flags else ''}dU){pattern}"
            row = texts.select(
                F.count_if(F.regexp_extract("t", X.jre(pattern, flags), 0) != F.regexp_extract("t", plain, 0)).alias("other"),
                F.count_if(F.rlike("t", F.lit(plain))).alias("hits")).first()
            assert row["other"] == 0, pattern
        assert row["hits"] > 0, pattern


def test_noise_is_searched_only_in_texts_that_can_hold_it(spark):
    signed = "Assinado com senha por FULANO DE TAL 01/02/2024 às 10:11:12."
    heads = ["Rua Central\nTel. 123\nfim", "Rua Central\nCEP 20000\nfim", "Rua Central\nTEL 1\nfim", signed, "nada", None]
    rows = spark.createDataFrame([(t,) for t in heads], "raw_text string")
    got = [r["clean_text"] for r in remove_noise(rows, "raw_text").collect()]
    assert got == ["fim", "fim", "Rua Central\nTEL 1\nfim", "", "nada", None]
    plan = remove_noise(rows, "raw_text")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Contains(") == 3


def test_capture_searches_once_inside_branches(spark):
    rows = spark.createDataFrame([("Sábado, 3 de março de 2026", False)], "t string, skip boolean")
    got = rows.select(F.when(F.col("skip"), "").otherwise(masthead_date(F.col("t"))).alias("d"))
    assert got.first()["d"] == "03/03/2026"
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("regexp_extract(t") == 1
