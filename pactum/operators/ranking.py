"""Positions over data too large for one task, and first/last picks without windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pactum.session import cut_lineage

_PART_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def global_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """1-based position in a total order, without a single-task window.

    Range-partition and sort, number rows inside each partition, then shift by
    the sizes of the partitions before. The sorted rows are written once, since
    range bounds are sampled and must be the same for counting and shifting.
    The offsets table has one row per partition, so broadcasting it is bounded
    by the partition count, whatever the data size.
    """
    placed = cut_lineage(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", _PART_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    row = F.col("_at") - F.shiftleft(F.col("_part"), _PART_BITS)
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + row + 1)
        .drop("_at", "_part", "_offset")
    )


def pick_first(df: DataFrame, keys: list[str], order: Column, *extra: Column) -> DataFrame:
    """The row with the smallest ``order`` per key, as a map-side-combined aggregate.

    Unlike row_number, a key that holds a large share of all rows is reduced
    inside each input task before any shuffle.
    """
    return _pick(df, keys, F.min_by, order, extra)


def pick_last(df: DataFrame, keys: list[str], order: Column, *extra: Column) -> DataFrame:
    return _pick(df, keys, F.max_by, order, extra)


def last_per_process(df: DataFrame, key: str = "processo_id", order: str = "written_at") -> DataFrame:
    """The row of each process that was written last, by ``order``, which the rows must carry.

    Rows written at the same time are ranked by their content, so the result
    does not depend on row order.
    """
    if order not in df.columns:
        raise ValueError(f"rows without {order} have no last one")
    content = [F.to_json(f.name) if "map<" in f.dataType.simpleString() else F.col(f.name)
               for f in df.schema if f.name not in (key, order)]
    return pick_last(df, [key], F.struct(F.col(order), F.xxhash64(*content))).select(*df.columns)


def written(rows: DataFrame, at: int) -> DataFrame:
    """Rows with the number of the write they come from."""
    return rows.withColumn("written_at", F.lit(at))


def _pick(df, keys, pick, order, extra) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in rest])
    extra_names = [f"_extra{i}" for i in range(len(extra))]
    found = df.groupBy(*keys).agg(
        pick(row, order).alias("_row"), *[e.alias(n) for e, n in zip(extra, extra_names)])
    return found.select(*keys, "_row.*", *extra_names)


def running_index(
    rows: DataFrame, key: str, page: str, slot: str, index: str, total: str,
    pages_per_chunk: int = 1000,
) -> DataFrame:
    """Number the rows of each key over pages, and add the key's row count.

    A result page holds a handful of rows, a key any number of pages. Rows are
    numbered inside (key, chunk of pages); only one count per chunk is summed
    over the key, so no task ever holds all rows of a key. The chunk sums come
    back by an equi-join on (key, chunk), which spreads a hot key.
    """
    chunk = F.floor(F.col(page) / pages_per_chunk)
    rows = rows.withColumn("_chunk", chunk)
    counts = rows.groupBy(key, "_chunk").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(key).orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    counts = counts.select(
        key, "_chunk",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(key)).alias(total),
    )
    inside = Window.partitionBy(key, "_chunk").orderBy(page, slot)
    numbered = rows.withColumn("_i", F.row_number().over(inside))
    return (
        numbered.join(counts, [key, "_chunk"])
        .withColumn(index, F.col("_before") + F.col("_i"))
        .drop("_chunk", "_i", "_before")
    )
