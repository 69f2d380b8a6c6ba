"""Selector drift: does a page probe differ from the stored baseline?

The first probe of a portal becomes its baseline. A later probe drifts when a
selector known to the baseline has another state; only then does it replace the
baseline. Selectors unknown to the baseline are ignored.

A baseline is therefore one of the distinct probes seen so far, and there are
few of those (a handful of yes/no selectors). So a stretch of a portal's
timeline is a small table: the baseline after it for every baseline before it.
Such tables compose, which makes the walk a prefix scan: probes are put in order
by one range sort and cut into chunks of bounded size, repeats of the probe
before are left out, chunk tables are composed level by level up to one per
portal, and the true baselines go down the same levels again. A portal with most
of the probes is spread over all tasks, and no task holds more than a chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pactum.sources.stage_store import store

CHUNK_BITS = 7  # probes of a chunk
FAN_BITS = 6  # tables composed at once
NONE = ""  # no baseline yet
SELECTORS = "map<string,boolean>"
BASELINES = "portal string, probe string"


def probe_text(selectors: Column) -> Column:
    """Selectors as JSON in name order, so equal probes are equal texts."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(selectors))))


def changed_selectors(baseline: Column, probe: Column) -> Column:
    """Names, in order, of the selectors whose state in the baseline is another one."""
    on = lambda state: F.coalesce(state, F.lit(False))
    differs = lambda e: baseline[e["key"]].isNotNull() & (on(e["value"]) != baseline[e["key"]])
    return F.transform(F.filter(F.map_entries(probe), differs), lambda e: e["key"])


def _state(text: Column) -> Column:
    return F.struct(text.alias("probe"), F.from_json(text, SELECTORS).alias("selectors"))


def _next(baseline: Column, probe: Column) -> Column:
    """The baseline after a probe."""
    drifts = F.size(changed_selectors(baseline["selectors"], probe["selectors"])) > 0
    return F.when((baseline["probe"] == NONE) | drifts, probe).otherwise(baseline)


def _after(table: Column, baseline: Column) -> Column:
    return F.element_at(F.map_from_entries(table), baseline)


def _placed(probes: DataFrame) -> DataFrame:
    """(portal, ts, seq, probe, at), stored in order; ``at`` grows along each timeline."""
    rows = probes.select("portal", "ts", "seq", "probe")
    keys = ["portal", "ts", "seq", "probe"]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return store(ordered.withColumn("at", F.monotonically_increasing_id()), "probes")


def _chunks(placed: DataFrame, baselines: DataFrame) -> DataFrame:
    """(portal, node, probes, table): chunks without repeats, and what they make of each baseline."""
    chunk = F.shiftright("at", CHUNK_BITS)
    rows = placed.select("portal", chunk.alias("node"), "at", "probe")
    before = F.lag("probe").over(Window.partitionBy("portal", "node").orderBy("at"))
    fresh = rows.withColumn("before", before).where("before IS NULL OR before <> probe")
    chunks = fresh.groupBy("portal", "node").agg(
        F.sort_array(F.collect_list(F.struct("at", "probe"))).alias("probes"))
    states = rows.select("portal", "probe").unionByName(baselines.select("portal", "probe")).distinct()
    starts = states.groupBy("portal").agg(F.collect_set("probe").alias("starts"))
    walk = lambda start: F.aggregate(
        F.transform("probes", lambda p: _state(p["probe"])), _state(start), _next)
    table = F.transform(
        F.array_append("starts", F.lit(NONE)),
        lambda s: F.struct(s.alias("before"), walk(s)["probe"].alias("after")))
    return chunks.join(starts, "portal").select("portal", "node", "probes", table.alias("table"))


def _composed(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes with their parents, and the parents with the composed tables."""
    counts = nodes.groupBy("portal").count()
    parent = F.when(F.col("count") <= 1 << FAN_BITS, 0).otherwise(F.shiftright("node", FAN_BITS))
    nodes = nodes.join(counts, "portal").withColumn("parent", parent.cast("long")).drop("count")
    groups = nodes.groupBy("portal", "parent").agg(
        F.sort_array(F.collect_list(F.struct("node", "table"))).alias("parts"))
    first = F.col("parts")[0]["table"]
    table = F.transform(first, lambda e: F.struct(e["before"].alias("before"), F.aggregate(
        F.slice("parts", 2, 1 << 30), e["after"], lambda v, c: _after(c["table"], v)).alias("after")))
    return nodes, groups.select("portal", F.col("parent").alias("node"), table.alias("table"))


def _starts_below(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """(portal, node, start) of the children of nodes whose start is known."""
    groups = nodes.groupBy("portal", "parent").agg(
        F.sort_array(F.collect_list(F.struct("node", "table"))).alias("parts"))
    known = above.select("portal", F.col("node").alias("parent"), "start")
    none = F.array().cast("array<struct<node:bigint,start:string>>")
    walk = F.aggregate(
        "parts", F.struct(F.col("start").alias("now"), none.alias("found")),
        lambda acc, c: F.struct(
            _after(c["table"], acc["now"]).alias("now"),
            F.array_append(acc["found"], F.struct(c["node"].alias("node"), acc["now"].alias("start"))).alias("found")))
    return groups.join(known, ["portal", "parent"]).select(
        "portal", F.explode(walk["found"]).alias("x")).select("portal", "x.node", "x.start")


def drift_scan(probes: DataFrame, baselines: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Drift of every probe ``(portal, ts, seq, probe)``, and each portal's baseline afterwards.

    ``baselines`` (portal, probe) are what the portals start from; portals without one
    start from their first probe. Portals that have a baseline but no probe keep it.
    """
    if baselines is None:
        baselines = probes.sparkSession.createDataFrame([], BASELINES)
    placed = _placed(probes)
    level = store(_chunks(placed, baselines), "chunks")
    chunks, levels = level, []
    level = level.select("portal", "node", "table")
    while level.groupBy("portal").count().where("count > 1").take(1):
        nodes, above = _composed(level)
        levels.append(store(nodes, "level"))
        level = store(above, "level")
    begin = level.join(baselines.withColumnRenamed("probe", "start"), "portal", "left").withColumn(
        "start", F.coalesce("start", F.lit(NONE)))
    ends = begin.select("portal", _after(F.col("table"), F.col("start")).alias("probe"))
    known = begin.select("portal", "node", "start")
    for nodes in reversed(levels):
        known = store(_starts_below(nodes, known), "starts")

    nothing = F.array().cast("array<struct<at:bigint,changed:array<string>>>")

    def step(acc, p):
        probe = _state(p["probe"])
        changed = F.when(acc["now"]["probe"] != NONE, changed_selectors(acc["now"]["selectors"], probe["selectors"]))
        return F.struct(
            _next(acc["now"], probe).alias("now"),
            F.when(F.size(changed) > 0, F.array_append(acc["found"], F.struct(
                p["at"].alias("at"), changed.alias("changed")))).otherwise(acc["found"]).alias("found"))

    walk = F.aggregate("probes", F.struct(_state(F.col("start")).alias("now"), nothing.alias("found")), step)
    drifts = chunks.select("portal", "node", "probes").join(known, ["portal", "node"]).select(
        F.explode(walk["found"]).alias("x")).select("x.at", F.array_join("x.changed", "|").alias("changed"))
    rows = placed.join(drifts, "at", "left").select(
        "portal", "ts", "seq", F.col("changed").isNotNull().alias("drifted"),
        F.coalesce("changed", F.lit("")).alias("changed"))
    kept = baselines.join(ends, "portal", "left_anti").select("portal", "probe")
    return rows, ends.unionByName(kept)


def selector_drift(probes: DataFrame) -> DataFrame:
    """(portal, ts, seq, drifted, changed) of every probe ``(portal, ts, seq, selectors map)``."""
    return drift_scan(probes.withColumn("probe", probe_text(F.col("selectors"))))[0]


def start_drift(probes: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Drift of streamed probes ``(portal, ts, seq, selectors map)``, batch by batch.

    The baselines after a batch are stored beside its rows, one per portal. A
    batch starts from those of the batch before, so running it again gives the
    same rows; it overwrites its own folders only. Probes of a batch are ordered
    by time; a probe that comes in a later batch than its time counts there.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = store(batch.select("portal", "ts", "seq", probe_text(F.col("selectors")).alias("probe")), "batch")
        before = None
        if batch_id:
            before = spark.read.schema(BASELINES).parquet(f"{out}/baselines/batch={batch_id - 1}")
        drifts, baselines = drift_scan(rows, before)
        drifts.write.mode("overwrite").parquet(f"{out}/drifts/batch={batch_id}")
        baselines.write.mode("overwrite").parquet(f"{out}/baselines/batch={batch_id}")

    return (
        probes.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_drifts(spark, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/drifts").drop("batch")
