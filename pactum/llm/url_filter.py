"""URL rules by a sort-merge range join.

A key is the reversed host, a separator and the path, as bytes. A rule covers
the interval of keys it is a prefix of, and such intervals only nest. A url
probes one key for its host and one for each parent host that could own a rule.
Probes and interval ends are sorted together over range partitions. The sweep
keeps, for each depth of nesting, the rule opened last at that depth: this is
the stack of active rules, and its top is the longest rule that fits the probe.
What is open at the end of a partition is carried to the next ones as one row
per partition and depth.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pactum.session import cut_lineage

#: Rules of the query: (host, path, verdict).
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
DEFAULT = "allow"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_OPEN, _PROBE, _CLOSE = 0, 1, 2


def host_of(url: Column) -> Column:
    """What lies between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    rest = F.substring_index(F.substring_index(F.substring_index(_rest(url), "/", 1), "?", 1), "#", 1)
    return F.translate(rest, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    whole = F.substring_index(F.substring_index(_rest(url), "?", 1), "#", 1)
    return F.substr(whole, F.length(host_of(url)) + 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def _key(host: Column, path: Column) -> Column:
    """Reversed labels and the path. The separators are escaped inside a host, so keys are unique."""
    for raw, safe in (("\x02", "\x02c"), ("\x01", "\x02b"), ("\x00", "\x02a")):
        host = F.replace(host, F.lit(raw), F.lit(safe))
    labels = F.reverse(F.split(host, r"\."))
    return F.concat(F.array_join(labels, "\x01"), F.lit("\x00"), path).cast("binary")


def _probes(urls: DataFrame, labels: int) -> DataFrame:
    """One probe per parent host that has no more labels than the longest rule host, one at least."""
    parts = F.split("host", r"\.")
    n = F.size(parts)
    tails = F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(n, F.lit(labels)))),
        lambda k: F.array_join(F.slice(parts, n - k + 1, k), "."))
    return urls.select("page_id", "url", "n", "path", F.explode(tails).alias("owner")).select(
        "page_id", "url", "n", _key(F.col("owner"), F.col("path")).alias("key"))


def _sweep(events: DataFrame) -> DataFrame:
    """Probes with the rule on top of the stack where they stand, null where none is open."""
    order = ["key", "kind", "page_id", "url"]
    placed = cut_lineage(
        events.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    step = F.when(F.col("kind") == _OPEN, 1).when(F.col("kind") == _CLOSE, -1).otherwise(0)

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = placed.groupBy("part").agg(F.sum(step).alias("gain")).select(
        "part", F.coalesce(F.sum("gain").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy(*order)
    deep = placed.join(F.broadcast(bases), "part").withColumn(  # one row per partition
        "depth", F.sum(step).over(inside) + F.col("base"))

    opens = F.when(F.col("kind") == _OPEN, F.col("rule"))
    stack = Window.partitionBy("part", "depth").orderBy(*order)
    topped = deep.withColumn("own", F.last(opens, True).over(stack))
    left_open = deep.where(F.col("kind") == _OPEN).groupBy("part", "depth").agg(
        F.max_by("rule", F.struct(*order)).alias("left_open"))
    earlier = Window.partitionBy("depth").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    carried = deep.where("depth > 0").select("part", "depth").distinct().join(
        left_open, ["part", "depth"], "left").select(
        "part", "depth", F.last("left_open", True).over(earlier).alias("carried"))
    return topped.where(F.col("kind") == _PROBE).join(carried, ["part", "depth"], "left").select(
        "page_id", "url", "n",
        F.when(F.col("depth") > 0, F.coalesce("own", "carried")).alias("rule"))


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages`` (page_id, url).

    ``rules`` has host, path and verdict. A rule fits its host and all its
    subdomains if the path starts with the rule's path; the longest rule wins,
    then the longer host. Of equal rules with several verdicts the
    alphabetically last one holds (block before allow); a rule with a null or
    empty host or a null path fits nothing. A null url, or one without ``://``,
    has an empty host and path and gets ``default``. Repeated rows are judged
    once and come back as often as they stood.
    """
    usable = rules.where("host != '' and path is not null").groupBy("host", "path").agg(
        F.max("verdict").alias("verdict"))
    labels = usable.agg(F.max(F.size(F.split("host", r"\."))).alias("n")).first()["n"] or 0
    counted = pages.groupBy("page_id", "url").agg(F.count("*").alias("n"))
    urls = counted.withColumn("host", host_of(F.coalesce("url", F.lit("")))).withColumn(
        "path", path_of(F.coalesce("url", F.lit(""))))
    none = F.lit(None)
    start = usable.select(
        _key(F.col("host"), F.col("path")).alias("key"),
        F.struct(F.length(F.concat("host", "path")).alias("size"), F.length("host").alias("host_size"),
                 F.concat("host", "path").alias("text"), "verdict").alias("rule"))
    events = start.select(
        "key", F.lit(_OPEN).alias("kind"), none.cast("long").alias("page_id"),
        none.cast("string").alias("url"), none.cast("long").alias("n"), "rule",
    ).unionByName(start.select(
        F.concat("key", F.unhex(F.lit("FF"))).alias("key"), F.lit(_CLOSE).alias("kind"),
        none.cast("long").alias("page_id"), none.cast("string").alias("url"),
        none.cast("long").alias("n"), "rule",
    )).unionByName(_probes(urls, labels).select(
        "key", F.lit(_PROBE).alias("kind"), "page_id", "url", "n",
        none.cast(start.schema["rule"].dataType).alias("rule")))
    found = _sweep(events).groupBy("page_id", "url").agg(
        F.max("rule").alias("rule"), F.first("n").alias("n"))
    url = F.coalesce("url", F.lit(""))
    return found.select(
        "page_id", host_of(url).alias("host"), path_of(url).alias("path"),
        F.col("rule.text").alias("rule"),
        F.coalesce("rule.verdict", F.lit(default)).alias("verdict"),
        F.explode(F.sequence(F.lit(1), F.col("n"))).alias("_copy")).drop("_copy")


#: The same result as one DuckDB query over ``pages``, for the rules above.
SQL = """
WITH r AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM r),
u AS (SELECT page_id,
    translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
m AS (SELECT *, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1')
        THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/')
        THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/'
    END AS rule FROM u)
SELECT page_id, host, path, rule,
    CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END
    AS verdict FROM m
"""
