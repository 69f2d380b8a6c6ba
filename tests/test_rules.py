"""Rule cases: dates, parties, identifiers, values, scores, alerts."""

import pytest
from pyspark.sql import functions as F

from pactum.functions.dates import parse_dmy
from pactum.functions.money import parse_brl
from pactum.operators import rules as R


def evaluate(spark, column, row, schema):
    return spark.createDataFrame([row], schema).select(column.alias("x")).head()[0]


def r001(spark, signing, published, divergent=()):
    df = spark.createDataFrame(
        [(signing, published, list(divergent))], "s string, p string, d array<string>")
    df = df.withColumns({"a": parse_dmy(F.col("s")), "b": parse_dmy(F.col("p"))})
    return df.select(R.timeliness(*[F.col(c) for c in "spabd"]).alias("r")).head().r


@pytest.mark.parametrize(
    "signing, published, verdict, delta, reason",
    [
        ("03/02/2026", "10/02/2026", "PASS", 7, None),
        ("01/01/2026", "25/01/2026", "FAIL", 24, None),
        ("01/01/2026", "21/01/2026", "PASS", 20, None),
        ("01/01/2026", "22/01/2026", "FAIL", 21, None),
        ("16/09/2024", "30/09/2024", "PASS", 14, None),
        ("10/01/2026", "03/01/2026", "INCONCLUSIVE", -7, "negative_delta"),
        (None, "03/01/2026", "INCONCLUSIVE", None, "missing_date"),
        ("03/01/2026", "", "INCONCLUSIVE", None, "missing_date"),
        ("31/02/2026", "03/03/2026", "INCONCLUSIVE", None, "unparseable_date"),
        ("3/1/2026", "2026-01-05", "INCONCLUSIVE", None, "unparseable_date"),
    ],
)
def test_timeliness(spark, signing, published, verdict, delta, reason):
    r = r001(spark, signing, published)
    assert (r.verdict, r.days_delta, r.inconclusive_reason) == (verdict, delta, reason)
    assert r.requires_review == (verdict != "PASS")


def test_timeliness_gate_and_text(spark):
    r = r001(spark, "03/02/2026", "10/02/2026", ["signing_date", "contratada"])
    assert r.inconclusive_reason == "divergent_date" and "['signing_date']" in r.explanation
    r = r001(spark, "01/01/2026", "25/01/2026")
    assert "24 day(s)" in r.explanation and "by 4 day(s)" in r.explanation


def r002(spark, response, names=("A", "a", "B", "b"), divergent=()):
    df = spark.createDataFrame(
        [(*names, response, list(divergent))],
        "n1 string, n2 string, n3 string, n4 string, r string, d array<string>")
    df = df.withColumn("j", R.parse_object(F.col("r"))).withColumn("m", R.match_answer(F.col("j")))
    roles = ["contract_contratante", "pub_contratante", "contract_contratada", "pub_contratada"]
    value = {role: F.col(f"n{i}") for i, role in enumerate(roles, 1)}
    return df.select(R.party_match(value, *[F.col(c) for c in "rjmd"]).alias("x")).head().x


def answer(first="true", second="true", verdict="PASS", confidence='"high"'):
    return (f'{{"contratante_match": {first}, "contratada_match": {second}, '
            f'"overall_verdict": "{verdict}", "confidence": {confidence}}}')


@pytest.mark.parametrize(
    "response, verdict, reason",
    [
        (answer(), "PASS", None),
        (answer(confidence='"Medium"'), "PASS", None),
        (answer(second="false", verdict="FAIL"), "FAIL", None),
        (answer(first="false"), "FAIL", None),
        (answer(first='"false"'), "PASS", None),
        (answer(first="0"), "FAIL", None),
        (answer(first="[]"), "FAIL", None),
        (answer(verdict="MAYBE"), "INCONCLUSIVE", "llm_unexpected_verdict"),
        (answer(confidence='"LOW"'), "INCONCLUSIVE", "llm_low_confidence"),
        (answer(confidence="null"), "PASS", None),
        ('{"overall_verdict": "PASS"}', "INCONCLUSIVE", "llm_low_confidence"),
        (None, "INCONCLUSIVE", "llm_unavailable"),
        ("not json", "INCONCLUSIVE", "llm_parse_error"),
        ("[1]", "INCONCLUSIVE", "llm_parse_error"),
    ],
)
def test_party_match(spark, response, verdict, reason):
    r = r002(spark, response)
    assert (r.verdict, r.inconclusive_reason) == (verdict, reason)


def test_party_match_gates(spark):
    assert r002(spark, answer(), ("A", "", "B", None)).explanation.startswith(
        "Cannot evaluate party match: ['pub_contratante', 'pub_contratada']")
    r = r002(spark, answer(), divergent=["signing_date", "contratante_in_pub"])
    assert r.inconclusive_reason == "divergent_party"


@pytest.mark.parametrize(
    "left, right, verdict",
    [("12/2024", " 12/2024 ", "PASS"), ("ab/1", "AB/1", "PASS"), ("1/2024", "2/2024", "FAIL"),
     (None, "1/2024", "INCOMPLETE"), ("1/2024", "  ", "INCOMPLETE")],
)
def test_identifier(spark, left, right, verdict):
    got = evaluate(spark, R.r003_identifier(F.col("l"), F.col("r")), (left, right), "l string, r string")
    assert got.verdict == verdict


@pytest.mark.parametrize(
    "left, right, verdict, pct",
    [("1000,00", "1000,00", "PASS", 0.0), ("1000,00", "1009,00", "PARTIAL", 0.9),
     ("1000,00", "1010,00", "PARTIAL", 1.0), ("1000,00", "1011,00", "FAIL", 1.1),
     ("0,00", "100,00", "FAIL", None), ("0,00", "0", "PASS", 0.0), ("x", "1", "INCOMPLETE", None),
     ("nan", "1", "FAIL", None)],
)
def test_value(spark, left, right, verdict, pct):
    df = spark.createDataFrame([(left, right)], "l string, r string")
    df = df.select(parse_brl(F.col("l")).alias("c"), parse_brl(F.col("r")).alias("p"))
    c, p = F.col("c"), F.col("p")
    got = df.select(R.r004_value(c, p, R.value_gap(c, p)).alias("x")).head().x
    assert got.verdict == verdict
    if left != "nan":
        assert got.difference_percentage == pct


@pytest.mark.parametrize(
    "text, amount",
    [("R$ 1.216.829,52", 1216829.52), (" 1234.5 ", 1234.5), ("1e3", 1000.0), ("1_000", 1000.0),
     ("", None), ("a definir", None), ("1__0", None), ("-5,5", -5.5), (None, None)],
)
def test_brl(spark, text, amount):
    assert evaluate(spark, parse_brl(F.col("t")), (text,), "t string") == amount


@pytest.mark.parametrize(
    "score, level, missing, status, gated",
    [(100.0, "CONFIRMED", False, "CONFORME", 100.0), (100.0, "PARTIAL", False, "PARCIAL", 85.0),
     (100.0, "DIVERGENT", False, "INCOMPLETE", 0.0), (100.0, None, True, "INCOMPLETE", 100.0),
     (60.0, "SKIPPED", False, "PARCIAL", 60.0), (57.5, "SKIPPED", False, "NÃO CONFORME", 57.5),
     (90.0, "SKIPPED", False, "CONFORME", 90.0), (89.5, "CONFIRMED", False, "NÃO CONFORME", 89.5)],
)
def test_gate_and_status(spark, score, level, missing, status, gated):
    df = spark.createDataFrame([(score, level, missing)], "s double, l string, m boolean")
    df = df.withColumn("g", R.gated_score(F.col("s"), F.col("l")))
    row = df.select("g", R.final_status(F.col("g"), F.col("l"), F.col("m")).alias("f")).head()
    assert (row.f, row.g) == (status, gated)


def test_scores_are_exact(spark):
    verdicts = ["PASS", "FAIL", "INCONCLUSIVE", "PARTIAL", " pass ", "SKIPPED", None]
    df = spark.createDataFrame([(v,) for v in verdicts], "v string")
    got = [r[0] for r in df.select(R.verdict_score(F.col("v"))).collect()]
    assert got == [100, 0, 50, 75, 100, 50, 50]
    total = R.weighted_score({r: F.lit(n) for r, n in zip(("R001", "R002", "R003", "R004"), (50, 75, 100, 75))})
    assert evaluate(spark, total, (1,), "x int") == 70.0


@pytest.mark.parametrize(
    "v1, v2, level, expected",
    [("PASS", "PASS", "CONFIRMED", ("PASS", False, None)),
     ("PASS", "PASS", "PARTIAL", ("PASS", True, "diagnostic_partial")),
     ("FAIL", "INCONCLUSIVE", "DIVERGENT", ("FAIL", True, "one_or_more_rules_failed")),
     ("INCONCLUSIVE", "INCONCLUSIVE", "DIVERGENT",
      ("INCONCLUSIVE", True, "r001_inconclusive,r002_inconclusive,diagnostic_divergent"))],
)
def test_overall(spark, v1, v2, level, expected):
    got = evaluate(
        spark, R.overall_status(F.col("a"), F.col("b"), F.col("c")), (v1, v2, level),
        "a string, b string, c string")
    assert tuple(got) == expected
