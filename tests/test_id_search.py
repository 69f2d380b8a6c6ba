"""Identifiers in texts beside a test of all pairs."""

import random

from pactum.operators import id_search
from pyspark.sql import functions as F

IDS = ["FIL-PRO-2023/00482", "TUR-PRO-2023/482", "000520.0000000520/1997-33", "000520.0000000520/1997", "520.520/1997",
       "12/0000000012.012/1999", "GARBAGE-49", "GARBAGE-490", "X", "é/Ç1", "--", "0", "", None, "FIL-PRO-2023/00482"]


def pairs(spark, texts, ids):
    spelled = {}
    for r in id_search.spellings(ids).collect():
        spelled.setdefault(r.id, []).append((r["rank"], r.spelling))
    found = set()
    for page, text in texts:
        for key, own in spelled.items():
            hits = [s for _, s in sorted(own) if text is not None and any(c.isalnum() for c in s) and s in text.lower()]
            if hits:
                found.add((page, key, hits[0]))
    return found


def test_search_equals_all_pairs(spark):
    rng = random.Random(6)
    ids = spark.createDataFrame([(i,) for i in IDS], "processo_id string")
    shapes = [s for r in id_search.spellings(ids).collect() for s in (r.spelling, r.spelling.upper())]
    texts = [(0, None), (1, ""), (2, "nothing"), (3, "processo " * 3000 + "FILPRO2023/00482 fim"), (4, "é/ç1"), (5, "-- --")]
    for i in range(6, 400):
        words = [rng.choice(["", "1", "x", "0", ".", "/", "A-"]) + rng.choice(shapes) + rng.choice(["", "7", "/", "-1", "z"])
                 for _ in range(rng.randint(1, 3))]
        texts.append((i, rng.choice([" ", "", "\n"]).join(words)[rng.choice([0, 0, 1]):]))
    df = spark.createDataFrame(texts, "page long, body string")
    got = id_search.ids_in_texts(df.withColumn("part", F.lit(1)).repartition(3), ids, "page", "body").collect()
    assert len(got) == len({tuple(r) for r in got})
    assert {tuple(r) for r in got} == pairs(spark, texts, ids)


def test_search_in_nothing(spark):
    ids = spark.createDataFrame([("A-1",)], "processo_id string")
    empty = spark.createDataFrame([], "page long, body string")
    assert id_search.ids_in_texts(empty, ids, "page", "body").count() == 0
    texts = spark.createDataFrame([(1, "A-1")], "page long, body string")
    assert id_search.ids_in_texts(texts, ids.limit(0), "page", "body").count() == 0


def test_what_is_stored_grows_with_distinct_runs(spark, monkeypatch):
    """Pages that share their words are not each cut into the parts that spellings ask for."""
    stored, write = {}, id_search.store

    def counted(df, name):
        kept = write(df, name)
        stored[name] = kept.count()
        return kept

    monkeypatch.setattr(id_search, "store", counted)
    ids = spark.createDataFrame([(f"GARBAGE-{i}",) for i in (1, 12, 123, 1234, 12345)], "processo_id string")
    words = " ".join(f"palavra{i:05d}" for i in range(40))
    texts = spark.createDataFrame([(i, f"{words} garbage-12345") for i in range(50)], "page long, body string")
    assert id_search.ids_in_texts(texts, ids, "page", "body").count() == 250
    assert max(stored.values()) <= 50  # pages, runs, parts and leads; not pages times parts
