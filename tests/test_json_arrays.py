"""Elements of JSON arrays read in pieces, against a plain parser."""

import json
import random

import pytest
from pyspark.sql import functions as F

from pactum.sources.json_arrays import read_array, write_arrays


def documents():
    rng = random.Random(4)
    odd = ['}', '{', '"', '\\', '\\"}', '[{', ']}', 'é日', '\n', ', {"a": 1}', '', '\\\\']

    def value(level):
        kind = rng.randrange(6 if level < 3 else 3)
        if kind < 3:
            return [rng.choice(odd) * rng.randrange(4), rng.randrange(100), None][kind]
        if kind == 3:
            return [value(level + 1) for _ in range(rng.randrange(4))]
        return {rng.choice(odd) + str(i): value(level + 1) for i in range(rng.randrange(4))}

    def items(n):
        return [{"i": i, rng.choice(odd): value(0), "z": value(0)} for i in range(n)]

    yield {"total": 3, "meta": {"a": {"b": [1, {"c": 2}]}}, "list": [1, 2], "processos": items(400), "end": {"x": [{}]}}
    yield {"other": [{"i": -1}, {"i": -2}], "processos": items(3), "processos2": [{"i": -3}]}
    yield {"processos": []}
    yield {"processos": items(1)}


@pytest.mark.parametrize("indent", [None, 2])
def test_elements_equal_a_plain_parser(spark, tmp_path, indent):
    docs = list(documents())
    for i, doc in enumerate(docs):
        (tmp_path / f"{i}.json").write_text(json.dumps(doc, indent=indent, ensure_ascii=i % 2 == 0) + "\n" * (i % 2))
    (tmp_path / "9.json").write_text("")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        got = read_array(spark, f"{tmp_path}/*.json").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    for i, doc in enumerate(docs):
        rows = sorted((r.element, r.body, r.problem) for r in got if r.path.endswith(f"{i}.json"))
        assert [json.loads(r[1]) for r in rows] == doc["processos"]
        assert {r[2] for r in rows} <= {None}


def test_a_document_that_is_an_array(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": [1, {"b": "}"}]}, {}, {"c": 3}]')
    got = sorted((r.element, r.body) for r in read_array(spark, str(tmp_path / "a.json"), None).collect())
    assert [json.loads(b) for _, b in got] == [{"a": [1, {"b": "}"}]}, {}, {"c": 3}]


def test_broken_elements_are_set_aside(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{"processos": [{"i": 1}, {"i": 2, bad}, 17, {"i": 3}, {"i": [4, 5}, {"i": 6')
    (tmp_path / "b.json").write_text('{"processos": [{"i": 1}, {"i": "' + "x" * 500 + '"}, {"i": {"k": 3')
    rows = read_array(spark, f"{tmp_path}/*.json", max_chars=300).collect()
    kinds = lambda name: sorted(
        (r.element, r.problem or "", r.body) for r in rows if r.path.endswith(name))
    first = kinds("a.json")
    assert (0, "", '{"i": 1}') in first and (1, "unreadable", '{"i": 2, bad}') in first
    assert (2, "stray", "17") in first and (2, "", '{"i": 3}') in first
    assert [k for k in first if k[0] > 2] and all(k[1] for k in first if k[0] > 2)
    assert [(e, p) for e, p, _ in kinds("b.json")] == [(0, ""), (1, "oversized"), (2, "truncated")]


def test_one_document_is_read_by_many_tasks(spark, tmp_path):
    rows = spark.range(20_000).select(F.lit(0).alias("doc"), "id", F.repeat(F.lit("} "), 20).alias("text"))
    write_arrays(rows, "doc", "id", f"{tmp_path}/out")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        raw = spark.read.option("lineSep", "}").text(f"{tmp_path}/out")
        assert raw.rdd.getNumPartitions() > 5
        got = read_array(spark, f"{tmp_path}/out/*/*.txt")
        assert got.where("problem IS NULL").select(F.get_json_object("body", "$.id")).distinct().count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
