"""Ranking under skew, stage tables, streaming jobs and the registered queries."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

import compare
import __spark_entry__ as entry
from pactum import schemas
from pactum.operators.contract_text import detect_appendices
from pactum.operators.discovery import discovery_metadata
from pactum.operators.evaluate import compliance_stage
from pactum.operators.gazette_text import consolidate, parsed_documents, primary_publications
from pactum.operators.ranking import (
    global_rank,
    last_per_process,
    pick_first,
    running_index,
    written,
)
from pactum.operators.report import report_rows
from pactum.operators.runs import contract_records, resolve_failures
from pactum.operators.state import COMPLIANCE_DOCUMENT, parse_documents
from pactum.sources import stage_store as store
from pactum.plans.registry import QUERIES
from pactum.sources.domain import Tables, tables
from pactum.sources.snapshots import Change, Conflict, Snapshots
from pactum.streaming import drift, failures, scoring


def folder():
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp")


def test_global_rank_is_total_and_gapless(spark):
    rows = [(i % 3, f"k{(i * 7919) % 5000:05d}", i) for i in range(5000)]
    df = spark.createDataFrame(rows, "g int, k string, i int").repartition(7)
    got = global_rank(df, [F.col("g"), F.col("k"), F.col("i")], "rank").collect()
    assert [r.rank for r in sorted(got, key=lambda r: (r.g, r.k, r.i))] == list(range(1, 5001))


def test_running_index_with_a_hot_key(spark):
    rows = [("hot", p, s) for p in range(2500) for s in range(2)] + [("cold", 1, 1), ("cold", 3, 1)]
    df = spark.createDataFrame(rows, "k string, page bigint, slot bigint")
    got = running_index(df, "k", "page", "slot", "n", "total", pages_per_chunk=100).collect()
    hot = sorted((r.page, r.slot, r.n, r.total) for r in got if r.k == "hot")
    assert [x[2] for x in hot] == list(range(1, 5001)) and {x[3] for x in hot} == {5000}
    assert sorted(r.n for r in got if r.k == "cold") == [1, 2]


def test_pick_first_keeps_nulls(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, None), ("b", 1, "y")], "k string, o int, v string")
    got = {r.k: (r.o, r.v) for r in pick_first(df, ["k"], F.col("o")).collect()}
    assert got == {"a": (1, None), "b": (1, "y")}


def test_stage_upsert_of_one_key_keeps_all_others(spark):
    root = folder()
    df = spark.createDataFrame([(f"p{i}", "old") for i in range(1000)], "processo_id string, v string")
    store.write_stage(df, root, "s", 8)
    store.write_stage(df.where("processo_id = 'p7'").withColumn("v", F.lit("new")), root, "s", 8)
    store.write_stage(spark.createDataFrame([("q", "first")], df.schema), root, "s", 8)
    got = {r.processo_id: r.v for r in store.read_stage(spark, root, "s").collect()}
    assert len(got) == 1001 and got["p7"] == "new" and list(got.values()).count("old") == 999
    assert [r.v for r in store.read_process(spark, root, "s", "p7", 8).collect()] == ["new"]
    target = folder()
    store.compact_stage(spark, root, "s", target, 8)
    assert {r.processo_id: r.v for r in store.read_stage(spark, target, "s").collect()} == got


def test_last_row_of_a_process_wins(spark):
    rows = spark.createDataFrame(
        [("a", "x", 1), ("a", "y", 2), ("b", "z", 1)], "processo_id string, v string, written_at int")
    for df in (rows, rows.orderBy(F.desc("v"))):
        assert {r.processo_id: r.v for r in last_per_process(df).collect()} == {"a": "y", "b": "z"}
    with pytest.raises(ValueError):
        last_per_process(rows.drop("written_at"))


def test_report_rows_do_not_multiply(spark, sf_dir):
    t = tables(spark, sf_dir)
    sides = (t.state, t.conformity.union(t.conformity), discovery_metadata(t.links), t.publications,
             t.contracts.union(t.contracts))
    assert report_rows(sides[0], *[written(s, 1) for s in sides[1:]]).count() == t.state.count()


def test_append_refuses_other_shapes(spark):
    path = folder() + "/list"
    store.append_rows(spark.range(3), path)
    store.append_rows(spark.range(2), path)
    assert spark.read.parquet(path).count() == 5
    with pytest.raises(ValueError):
        store.append_rows(spark.range(1).withColumn("x", F.lit(1)), path)


def test_documents_from_files(spark):
    root = folder()
    bodies = {"a_x.json": '{"processo_id": "A", "overall": {"status": "PASS"}}', "b_x.json": "{}",
              "c_x.json": '{"processo_id": ', "d.json": '{"processo_id": "D"}'}
    for name, body in bodies.items():
        with open(os.path.join(root, name), "w", encoding="utf-8") as f:
            f.write(body)
    good, bad = parse_documents(store.read_documents(spark, f"{root}/*_x.json"), COMPLIANCE_DOCUMENT)
    assert [(r.processo_id, r.overall.status) for r in good.collect()] == [("A", "PASS")]
    assert sorted(r.name for r in bad.collect()) == ["b_x.json", "c_x.json"]
    with open(os.path.join(root, "links.json"), "w", encoding="utf-8") as f:
        f.write('{"processos": [{"processo_id": "P1", "extra": 1, "discovery_path": ["a"]}, {"processo_id": "P2"}]}')
    links = store.read_discovery(spark, f"{root}/links.json", schemas.DISCOVERY)
    assert [(r.pos, r.processo_id) for r in links.orderBy("pos").collect()] == [(0, "P1"), (1, "P2")]


def test_resolution_only_covers_earlier_failures(spark):
    ledger = spark.createDataFrame(
        [(1, "p", "s3", False), (9, "p", "s3", False), (2, "q", "s3", True), (3, "q", "s4", False)],
        "seq bigint, processo_id string, stage string, resolved boolean")
    done = spark.createDataFrame([("p", "s3", 5)], "processo_id string, stage string, seq bigint")
    got = {r.seq: r.resolved for r in resolve_failures(ledger, done).collect()}
    assert got == {1: True, 9: False, 2: True, 3: False}


def plain_changes(baseline, probe):
    return [name for name, state in probe.items()
            if baseline.get(name) is not None and bool(state) != bool(baseline[name])]


def plain_drift(rows):
    baseline, out = {}, {}
    for portal, ts, seq, selectors in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        if portal not in baseline:
            baseline[portal], changed = selectors, []
        else:
            changed = plain_changes(baseline[portal], selectors)
            if changed:
                baseline[portal] = selectors
        out[seq] = "|".join(sorted(changed))
    return out


def probe_rows(n=600):
    rng = random.Random(7)
    start = 1_700_000_000
    rows = []
    for i in range(n):
        keys = rng.sample(["form", "table", "link"], rng.randint(1, 3))
        portal = "hot" if rng.random() < 0.7 else f"p{rng.randint(0, 2)}"
        rows.append((portal, start + rng.randint(0, 20 * 3600), i, {k: rng.random() < 0.8 for k in keys}))
    return rows


def probes(spark, rows):
    return spark.createDataFrame(
        rows, "portal string, t bigint, seq bigint, selectors map<string,boolean>"
    ).withColumn("ts", F.timestamp_seconds("t"))


def test_selector_drift_equals_a_plain_walk(spark):
    rows = probe_rows()
    got = {r.seq: "|".join(sorted(filter(None, r.changed.split("|"))))
           for r in drift.selector_drift(probes(spark, rows)).collect()}
    assert got == plain_drift(rows)


def drift_found(rows):
    return {r.seq: "|".join(sorted(filter(None, r.changed.split("|")))) for r in rows}


def test_drift_over_many_levels_and_one_hot_portal(spark, monkeypatch):
    """Small chunks and fans: the tables are composed over several levels."""
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.9 else f"p{i % 3}", 1_700_000_000 + rng.randint(0, 400), i,
             {k: rng.choice([True, True, False, None]) for k in rng.sample("abc", rng.randint(0, 3))}) for i in range(500)]
    monkeypatch.setattr(drift, "CHUNK_BITS", 2)
    monkeypatch.setattr(drift, "FAN_BITS", 1)
    assert drift_found(drift.selector_drift(probes(spark, rows).repartition(6)).collect()) == plain_drift(rows)


def test_hot_portal_is_spread_over_tasks(spark):
    rows = [("hot", 1_700_000_000 + i, i, {"a": i % 7 > 1}) for i in range(4000)]
    # So few rows would otherwise be put together in one task.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = drift._placed(probes(spark, rows).withColumn("probe", drift.probe_text(F.col("selectors"))))
        sizes = [r["count"] for r in placed.groupBy(F.shiftright("at", 33)).count().collect()]
        chunks = drift._chunks(placed, spark.createDataFrame([], drift.BASELINES))
        assert len(sizes) >= 3 and max(sizes) < 2000
        assert chunks.count() >= 4000 >> drift.CHUNK_BITS
        assert chunks.agg(F.max(F.size("probes"))).first()[0] <= 1 << drift.CHUNK_BITS
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_drift_goes_on_from_baselines(spark):
    rows = sorted(probe_rows(80), key=lambda r: (r[1], r[2]))
    text = lambda part: probes(spark, part).withColumn("probe", drift.probe_text(F.col("selectors")))
    first, baselines = drift.drift_scan(text(rows[:40]))
    second, after = drift.drift_scan(text(rows[40:]), baselines)
    assert drift_found(first.collect() + second.collect()) == plain_drift(rows)
    untouched, same = drift.drift_scan(text([]), after)
    assert untouched.count() == 0 and sorted(same.collect()) == sorted(after.collect())


def test_drift_stream_goes_on_and_repeats_batches_alike(spark):
    rows, src, out = sorted(probe_rows(60), key=lambda r: (r[1], r[2])), folder(), folder()
    for part in (rows[:25], rows[25:26], rows[26:]):
        probes(spark, part).select("portal", "ts", "seq", "selectors").write.mode("append").parquet(src)
        stream = spark.readStream.schema(
            "portal string, ts timestamp, seq bigint, selectors map<string,boolean>").parquet(src)
        drift.start_drift(stream, out, src + "_cp").awaitTermination(240)
    assert drift_found(drift.read_drifts(spark, out).collect()) == plain_drift(rows)
    # The last batch is run again, as after a failure before its commit was noted.
    for name in ("2", ".2.crc"):
        os.remove(f"{src}_cp/commits/{name}")
    stream = spark.readStream.schema(
        "portal string, ts timestamp, seq bigint, selectors map<string,boolean>").parquet(src)
    drift.start_drift(stream, out, src + "_cp").awaitTermination(240)
    assert drift_found(drift.read_drifts(spark, out).collect()) == plain_drift(rows)


def test_failure_rate_stream(spark):
    src = folder()
    df = spark.createDataFrame(
        [("s3", "2024-01-01 00:10:00"), ("s3", "2024-01-01 00:50:00"), ("s4", "2024-01-01 01:10:00")],
        "stage string, at string").select("stage", F.to_timestamp("at").alias("failed_at"))
    df.write.mode("append").parquet(src)
    stream = spark.readStream.schema("stage string, failed_at timestamp").parquet(src)
    query = (
        failures.failure_rate(stream).writeStream.outputMode("complete").format("memory")
        .queryName("rates").trigger(availableNow=True).start())
    query.awaitTermination(60)
    assert sorted((r.stage, r.failures) for r in spark.table("rates").collect()) == [("s3", 2), ("s4", 1)]


def scored(spark, t, parts, snapshots):
    """The stream over some arrivals, each followed by a run from the checkpoint."""
    src = folder()
    for part in parts:
        part.write.mode("append").parquet(src)
        stream = spark.readStream.schema(part.schema).parquet(src)
        scoring.start_scoring(stream, snapshots, src + "_cp").awaitTermination(300)
    return {r.processo_id: (r.alert_level, r.conformity_score) for r in snapshots.read("alerts").collect()}


def scoring_tables(spark, t):
    snapshots = Snapshots(spark, folder(), 8)
    scoring.publish_inputs(snapshots, t.contracts, t.raw_texts, t.answers)
    return snapshots


def test_late_failures_are_dropped_across_restarts(spark):
    """A failure whose window was closed in an earlier run does not count; an open window goes on."""
    src, out = folder(), folder() + "/rates"
    runs = [[("a", "00:10"), ("a", "00:20"), ("b", "03:30")],  # closes everything up to 02:30
            [("a", "00:50"), ("b", "03:40"), ("b", "02:40")],  # the first is late, the last is not
            [("c", "09:00"), (None, "03:59"), ("a", None)]]
    seen = []
    for part in runs:
        spark.createDataFrame([(s, f"2024-01-01 {m}:00" if m else None) for s, m in part], "stage string, m string").select(
            "stage", F.to_timestamp("m").alias("failed_at")).write.mode("append").parquet(src)
        stream = spark.readStream.schema("stage string, failed_at timestamp").parquet(src)
        failures.start_failure_rate(stream, out, src + "_cp").awaitTermination(120)
        seen.append({(r.stage, r.window_start.hour): r.failures for r in failures.read_failure_rate(spark, out).collect()})
    assert seen[0] == {("a", 0): 2} and seen[1] == {("a", 0): 2}
    assert seen[2] == {("a", 0): 2, ("b", 2): 1, ("b", 3): 2, (None, 3): 1}


def test_a_point_read_opens_one_bucket(spark, sf_dir):
    t = tables(spark, sf_dir)
    one = t.lookups.read_key("artifacts", "GARBAGE-99")
    bucket = f"key_bucket={t.lookups.bucket_of('GARBAGE-99')}/"
    assert one.count() > 0 and all(bucket in name for name in one.inputFiles())
    assert sorted(map(str, one.collect())) == sorted(map(str, t.view("artifact_docs").where(
        "processo_id = 'GARBAGE-99'").collect()))


def test_incremental_scoring_equals_batch(spark, sf_dir):
    t = tables(spark, sf_dir)
    half = F.pmod(F.xxhash64("processo_id"), F.lit(2))
    got = scored(spark, t, [t.publications.where(half == i) for i in (0, 1)], scoring_tables(spark, t))
    published = t.alerts.join(t.publications.select("processo_id"), "processo_id", "left_semi")
    assert got == {r.processo_id: (r.alert_level, r.conformity_score) for r in published.collect()}


def test_streamed_scores_do_not_depend_on_batches(spark, sf_dir):
    t = tables(spark, sf_dir)
    one = t.publications.join(t.contracts.select("processo_id"), "processo_id", "left_semi").where(
        "publication_date is not null").orderBy("processo_id").limit(1)
    late = one.withColumn("publication_date", F.lit("31/12/2030"))
    alerts = [scored(spark, t, order, scoring_tables(spark, t))
              for order in ((one, late), (late, one), (one.union(late),))]
    assert len(alerts[0]) == 1 and alerts[0] == alerts[1] == alerts[2]


def test_a_batch_reads_the_buckets_of_its_processes(spark, sf_dir):
    """However many processes were scored before, a batch of one opens one bucket."""
    t = tables(spark, sf_dir)
    snapshots = scoring_tables(spark, t)
    one = t.publications.join(t.contracts.select("processo_id"), "processo_id", "left_semi").orderBy(
        "processo_id").limit(1)
    key = one.first().processo_id
    seen = []
    read = snapshots.read
    snapshots.read = lambda name, version=None, buckets=None: seen.append(buckets) or read(name, version, buckets)
    scored(spark, t, [one], snapshots)
    assert [b for b in seen if b is not None] == [[snapshots.bucket_of(key)]] * 3
    assert set(snapshots.manifest()["alerts"].parts) == {snapshots.bucket_of(key)}


# -- snapshots -----------------------------------------------------------------------------
def values(rows):
    return sorted((r.processo_id, r.v) for r in rows.collect())


def test_snapshot_upsert_rewrites_the_buckets_of_its_keys(spark):
    tables_ = Snapshots(spark, folder(), 8)
    df = spark.range(200).selectExpr("concat('p', id) AS processo_id", "'old' AS v")
    assert tables_.version() == 0 and tables_.commit({"s": Change(df)}) == 1
    before = tables_.manifest()["s"].parts
    new = spark.createDataFrame([("p7", "new"), ("q", "first")], df.schema)
    tables_.commit({"s": Change(new, gone=spark.createDataFrame([("p8",), ("none",)], "processo_id string"))})
    after = tables_.manifest()["s"].parts
    touched = {tables_.bucket_of(k) for k in ("p7", "q", "p8")}
    assert all(after[b] == before[b] for b in set(before) - touched - {tables_.bucket_of("none")})
    got = dict(values(tables_.read("s")))
    assert len(got) == 200 and got["p7"] == "new" and got["q"] == "first" and "p8" not in got
    assert values(tables_.read_key("s", "p7")) == [("p7", "new")] and values(tables_.read_key("s", "p8")) == []
    assert values(tables_.read("s", version=1)) == values(df)  # a reader of the old version still sees it
    assert all(len(own) <= 2 for own in after.values())


def test_a_failure_between_two_tables_changes_nothing(spark):
    tables_ = Snapshots(spark, folder(), 4)
    df = spark.createDataFrame([("a", "1")], "processo_id string, v string")
    tables_.commit({"x": Change(df), "y": Change(df), "sum": Change(df, None)})
    broken = df.select("processo_id", F.raise_error(F.lit("lost")).cast("string").alias("v"))
    with pytest.raises(Exception, match="lost"):
        tables_.commit({"x": Change(df.withColumn("v", F.lit("2"))), "y": Change(broken)})
    assert tables_.version() == 1 and values(tables_.read("x")) == values(tables_.read("y")) == [("a", "1")]
    assert tables_.vacuum(older_than_s=0) >= 1 and values(tables_.read("x")) == [("a", "1")]
    with pytest.raises(ValueError):
        tables_.commit({"x": Change(df.withColumn("w", F.lit(1)))})


def test_two_writers_of_one_version_conflict(spark):
    root = folder()
    first, second = Snapshots(spark, root, 4), Snapshots(spark, root, 4)
    df = spark.createDataFrame([("a", "1")], "processo_id string, v string")
    second.version = lambda: 0  # it looked before the first one committed
    first.commit({"x": Change(df)})
    with pytest.raises(Conflict):
        second.commit({"x": Change(df.withColumn("v", F.lit("2")))})
    assert values(first.read("x")) == [("a", "1")]


def test_vacuum_keeps_what_kept_versions_name(spark):
    tables_ = Snapshots(spark, folder(), 4)
    df = spark.range(40).selectExpr("concat('p', id) AS processo_id", "'0' AS v")
    for k in range(4):
        tables_.commit({"x": Change(df.withColumn("v", F.lit(str(k)))), "sum": Change(df.limit(k + 1), None)})
    assert tables_.vacuum(keep=2, older_than_s=0) > 0
    assert tables_.read("x", 3).count() == tables_.read("x", 4).count() == 40
    assert tables_.read("sum", 3).count() == 3 and tables_.vacuum(keep=2, older_than_s=0) == 0
    empty = Snapshots(spark, folder(), 4)
    empty.commit({"x": Change(df.limit(0))})
    assert empty.read("x").count() == 0 and empty.read_key("x", "p1").count() == 0


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "processo_id" and df.limit(1).count() == 1


def test_every_check_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize(
    "name",
    ["r001_timeliness", "r002_party_match", "conformity_row", "classify_alert", "queue_rank",
     "state_index_join", "report_join", "skip_rules", "collect_search_hits", "companies_from_links",
     "parse_publication", "preprocess_publications", "segment_clauses", "executive_summary"],
)
def test_query_matches_its_check(spark, sf_dir, name):
    con = compare.connect(sf_dir)
    got = compare.spark_rows(entry.queries()[name](spark, sf_dir))
    assert got == compare.check_rows(con, entry.oracle_sql()[name])


def test_each_contract_gets_one_row_and_one_status(spark, sf_dir):
    t = tables(spark, sf_dir)
    n = t.contracts.count()
    row = t.conformity.agg(
        F.count("*").alias("n"), F.count_distinct("processo_id").alias("d"),
        F.count_if(F.col("overall_status").isin("CONFORME", "PARCIAL", "NÃO CONFORME", "INCOMPLETE")).alias("s"),
    ).head()
    assert (row.n, row.d, row.s) == (n, n, n)


def test_rows_of_one_row_group_are_spread_over_many_tasks(spark):
    t = tables(spark, "/root/testdata/sf0.01")
    for rows in (t.contract_docs, t.view("gazette_docs"), t.contracts, t.answers):
        shares = [r["n"] for r in rows.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert len(shares) >= 8
        assert max(shares) < sum(shares) / 4


def test_stage_tables_meet_without_moving_their_rows(spark, sf_dir):
    """Only publications, which are kept by their lines, are dealt by process again."""
    t = tables(spark, sf_dir)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = compliance_stage(t.contracts, t.publications, t.raw_texts, t.answers)
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(processo_id") <= 1


def test_contract_texts_are_measured_before_the_join(spark):
    links = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "processo_id string, pos long")
    texts = spark.createDataFrame(
        [("a", " x y\x1cz \n", "ocr"), ("b", None, None)],
        "processo_id string, raw_text string, extraction_method string")
    found = contract_records(links, texts)
    assert found.select("pos", "total_chars", "total_words", "extraction_method").orderBy("pos").collect() == [
        (1, 5, 3, "ocr"), (2, 5, 3, "ocr"), (3, None, 0, "unknown")]
    assert found.where("pos = 1").first()["raw_text"] == " x y\x1cz \n"
    narrow = found.select("pos", "total_chars", "total_words")
    plan = narrow._jdf.queryExecution().optimizedPlan().toString()
    assert "raw_text" not in plan.partition("Join")[0]


def test_unions_of_spread_tables_take_no_more_tasks_than_one(spark, sf_dir):
    t = tables(spark, sf_dir)
    one = t.view("seed").rdd.getNumPartitions()
    assert t.links.rdd.getNumPartitions() <= one
    assert t.view("artifact_docs").rdd.getNumPartitions() <= one


def test_a_sink_commits_its_own_table_only(spark, sf_dir):
    entry.queries()
    t = Tables(spark, sf_dir)
    rows = QUERIES["sink_raw"].build(t)
    QUERIES["sink_publications"].build(t)
    assert [set(s.manifest()) for s in t.published_tables.values()] == [{"raw"}, {"publications"}]
    assert rows.count() == t.contract_docs.count()
    assert not {"preprocessed", "parsed_documents", "compliance"} & set(vars(t))


def test_summaries_are_all_published_and_read(spark, sf_dir):
    names = {"alerts_summary", "conformity_summary", "queue", "aggregate", "state_index"}
    t = Tables(spark, sf_dir)
    rows = QUERIES["sink_summaries"].build(t)
    assert [set(s.manifest()) for s in t.published_tables.values()] == [names]
    counted = {r.summary: r["count"] for r in rows.groupBy("summary").count().collect()}
    assert set(counted) == names
    assert counted["state_index"] == t.state.count() and counted["queue"] == QUERIES["export_queue_csv"].build(t).count()


def test_structured_publications_need_no_other_parse(spark, sf_dir):
    entry.queries()
    t, whole = Tables(spark, sf_dir), Tables(spark, sf_dir)
    assert whole.parsed_documents.count() and whole.preprocessed.count()
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(t.structured) == rows(whole.structured)
    assert not {"preprocessed", "parsed_documents"} & set(vars(t))


def test_primary_document_is_chosen_before_its_text_is_parsed(spark):
    texts = {1: "Processo Instrutivo: A/2024\nEXTRATO DE CONTRATO\nData da Assinatura: 01/02/2024",
             2: "Terça-feira, 3 de março de 2026\nEXTRATO DE CONTRATO\nValor Total: R$ 2,00"}
    rows = [("a", i, hint, "09/09/2023", ok, None, texts.get(i % 3, "")) for i, (hint, ok) in enumerate([
        ("structured_contract", True), ("unknown", True), ("structured_contract", True), (None, True),
        ("structured_contract", False)])]
    rows += [("b", 1, None, None, None, None, texts[1]), ("c", 4, None, "", True, "", texts[1]), (None, 2, None, None, True, None, texts[2])]
    docs = spark.createDataFrame(
        rows, "processo_id string, document_index long, content_hint string, meta_date string, "
              "quality_passes boolean, extraction_error string, raw_text string")
    got = sorted(map(str, primary_publications(docs).collect()))
    assert got == sorted(map(str, consolidate(parsed_documents(docs)).collect()))
    assert len(got) == 3 and "03/03/2026" in got[1] + got[2]


def test_appendices_are_cut_out_of_the_text_once(spark):
    df = spark.createDataFrame([("CLÁUSULA X - Y",)], "pieces string").select(F.split("pieces", "-").alias("pieces"))
    plan = df.select(detect_appendices(F.col("pieces")).alias("found"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LISTAGEM") == 1
