"""Totals kept from changes equal a full recount."""

import random

import pytest

from pactum import constants as K
from pactum.operators.report import aggregate_report, top_flags
from pactum.operators.report_totals import COUNTS, ROWS, flag_totals, totals, upsert_report
from pactum.sources.snapshots import Snapshots

SCHEMA = ("processo_id string, has_raw boolean, has_pub_raw boolean, has_preprocessed boolean, has_pub_structured boolean, "
          "is_scored boolean, overall_status string, conformity_score double, "
          + ", ".join(f"{r}_score double" for r in K.RULES) + ", flags array<string>")


def report(rng, keys):
    rows = []
    for key in keys:
        scored = rng.random() < 0.7
        rows.append((
            key, *[rng.choice([True, False, None]) for _ in range(4)], scored,
            rng.choice(K.STATUSES) if scored else "", rng.choice([0.1, 33.3, 66.7, 100.0]),
            *[rng.choice([0.0, 50.0, 0.7]) for _ in K.RULES],
            rng.choice([None, [], ["a"], ["a", "b", "b"], [f"f{rng.randrange(15)}"]])))
    return rows


def same(spark, snapshots, now):
    rows = spark.createDataFrame(list(now.values()), SCHEMA)
    counts = snapshots.read(COUNTS)
    want, got = aggregate_report(rows).head().asDict(), totals(counts).head().asDict()
    assert got == pytest.approx(want)
    assert flag_totals(counts).collect() == top_flags(rows).collect()
    assert counts.where("n <= 0").count() == 0
    assert snapshots.read(ROWS).count() == len(now)


def test_upserts_equal_a_recount(spark, tmp_path):
    rng = random.Random(2)
    snapshots = Snapshots(spark, str(tmp_path / "s"), 8)
    now = {r[0]: r for r in report(rng, [f"p{i}" for i in range(200)])}
    upsert_report(snapshots, spark.createDataFrame(list(now.values()), SCHEMA))
    same(spark, snapshots, now)
    changed = {r[0]: r for r in report(rng, [f"p{i}" for i in range(190, 230)])}
    gone = ["p1", "p2", "p2", "p195", "never"]
    upsert_report(snapshots, spark.createDataFrame(list(changed.values()), SCHEMA),
                  spark.createDataFrame([(g,) for g in gone], "processo_id string"))
    now = {k: r for k, r in (now | changed).items() if k not in ("p1", "p2")}
    same(spark, snapshots, now)
    upsert_report(snapshots, spark.createDataFrame([], SCHEMA))
    same(spark, snapshots, now)


def test_an_upsert_of_one_process_touches_one_bucket(spark, tmp_path):
    rng = random.Random(3)
    snapshots = Snapshots(spark, str(tmp_path / "s"), 8)
    upsert_report(snapshots, spark.createDataFrame(report(rng, [f"p{i}" for i in range(300)]), SCHEMA))
    before = snapshots.manifest()
    upsert_report(snapshots, spark.createDataFrame(report(rng, ["p7"]), SCHEMA))
    after = snapshots.manifest()
    for name in (ROWS, COUNTS):
        moved = [b for b, paths in after[name].parts.items() if paths != before[name].parts.get(b)]
        assert len(moved) == 1
