"""The aggregate report kept up to date from changes alone.

Report rows are dealt into slots by process. Each slot keeps how many of its
rows show each value of each measure: discovered, extracted, a status, a score,
a flag. An upsert takes the counts of the rows it replaces back and adds those
of the new rows, so it reads the old rows of its own processes and the counts of
their slots, whatever the size of the report. All counts are whole numbers, so
what is taken back leaves no trace; scores are counted by value and summed only
when the report is made. Rows and counts switch in one commit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactum import constants as K
from pactum.operators.report import rates
from pactum.sources.snapshots import Change, Snapshots
from pactum.sources.stage_store import key_bucket, store

KEY = "processo_id"
ROWS, COUNTS = "report_rows", "report_counts"
SLOTS = 4096
PER_ROW = {
    "total_discovered": "true", "total_extracted": "has_raw", "total_pub_found": "has_pub_raw",
    "total_preprocessed": "has_preprocessed AND has_pub_structured", "total_analyzed": "is_scored",
}
STATUS, SCORE, FLAG = "status", "score", "flag"


def _shown(rows: DataFrame) -> Column:
    """What a row counts for: (measure, value) pairs; a null condition counts for nothing."""
    def pair(when, measure: str, value=""):
        value = F.lit(value) if isinstance(value, str) else value.cast("string")
        return F.when(when, F.struct(F.lit(measure).alias("measure"), value.alias("value")))

    scored = F.col("is_scored")
    single = [pair(F.expr(c), name) for name, c in PER_ROW.items()]
    single += [pair(scored, STATUS, F.col("overall_status")), pair(scored, SCORE, F.col("conformity_score"))]
    single += [pair(scored, r, F.col(f"{r}_score")) for r in K.RULES]
    flags = F.transform(F.coalesce("flags", F.array().cast("array<string>")), lambda f: F.struct(
        F.lit(FLAG).alias("measure"), f.alias("value")))
    return F.concat(F.array_compact(F.array(*single)), flags)


def counted(rows: DataFrame, sign: int = 1) -> DataFrame:
    """(slot, measure, value, n) of report rows."""
    slot = key_bucket(KEY, SLOTS).cast("string").alias("slot")
    return rows.select(slot, F.explode(_shown(rows)).alias("m")).groupBy(
        "slot", "m.measure", "m.value").agg((sign * F.count("*")).alias("n"))


def upsert_report(snapshots: Snapshots, rows: DataFrame, gone: DataFrame | None = None) -> int:
    """Replace the report rows of the processes in ``rows``, drop those in ``gone``; returns the version.

    ``rows`` hold one row a process, whose id is not null. A process in both is replaced. Only the
    snapshot buckets of the changed processes and of their slots are read and
    written anew. An empty change leaves every count as it is.
    """
    rows = store(rows, "changed_rows")
    keys = rows.select(KEY)
    if gone is not None:
        gone = gone.select(KEY).distinct().join(keys, KEY, "left_anti")
        keys = keys.unionByName(gone)
    change = counted(rows)
    seen = snapshots.manifest()
    if ROWS in seen:
        keys = store(keys, "changed_keys")
        old = snapshots.read(ROWS, buckets=_buckets(snapshots, keys, KEY)).join(keys, KEY, "left_semi")
        change = store(change.unionByName(counted(old, -1)), "count_changes")
        slots = change.select("slot").distinct()
        before = snapshots.read(COUNTS, buckets=_buckets(snapshots, slots, "slot")).join(slots, "slot", "left_semi")
        change = before.unionByName(change).groupBy("slot", "measure", "value").agg(F.sum("n").alias("n")).where("n <> 0")
    else:
        slots = None
    return snapshots.commit({ROWS: Change(rows, KEY, gone), COUNTS: Change(change, "slot", slots)})


def _buckets(snapshots: Snapshots, keys: DataFrame, key: str) -> list[str]:
    """The buckets of some keys; at most as many as the snapshots have."""
    return [str(r[0]) for r in keys.select(key_bucket(key, snapshots.buckets)).distinct().collect()]


def totals(counts: DataFrame) -> DataFrame:
    """The aggregate report, from counts."""
    n = F.col("n")

    def of(measure, value=None):
        fits = F.col("measure") == measure
        if value is not None:
            fits &= F.col("value") == value
        return F.coalesce(F.sum(F.when(fits, n)), F.lit(0))

    def sum_of(measure):
        return F.coalesce(F.sum(F.when(F.col("measure") == measure, F.expr("try_cast(value AS DOUBLE)") * n)), F.lit(0.0))

    return rates(counts.agg(
        *[of(name).alias(name) for name in PER_ROW],
        *[of(STATUS, s).alias(f"n_{i}") for i, s in enumerate(K.STATUSES)],
        sum_of(SCORE).alias("_scores"), *[sum_of(r).alias(f"_{r}") for r in K.RULES]))


def flag_totals(counts: DataFrame, top: int = 10) -> DataFrame:
    """Most frequent flags, from counts; ties by name."""
    return counts.where(F.col("measure") == FLAG).groupBy(F.col("value").alias("flag")).agg(
        F.sum("n").alias("n")).orderBy(F.desc("n"), "flag").limit(top)
