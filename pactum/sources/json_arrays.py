"""Reading the elements of large JSON arrays with many tasks.

A document such as ``{"total": 2, "processos": [{…}, {…}]}`` is read in pieces
that end at closing braces, so a file is split like any text file, whether it is
indented or stands on one line. What a piece means depends on all before it:
whether it starts inside a string, and how deep. Both come from a prefix scan:
each piece is measured for either start, pieces are composed inside chunks, and
one row per chunk is composed over the file. Everything is built-in columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pactum.sources.stage_store import store

CHUNK_BITS = 12  # pieces of one chunk: 4096
MAX_CHARS = 64_000_000  # a longer element is handed out in its pieces
CHUNK = ["path", "block", "chunk"]
_SOME_STRUCTURE = r"(?=[\[\]{])"  # a piece holds no closing brace outside strings


def _unquoted(parts: Column, inside: bool) -> Column:
    """The piece with the characters of its strings blanked; same length."""
    blank = 0 if inside else 1
    return F.array_join(F.transform(
        parts, lambda p, i: F.when(i % 2 == blank, F.repeat(F.lit("_"), F.length(p))).otherwise(p)), '"')


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _depth_change(masked: Column, open_end: Column) -> Column:
    """Change of depth over a piece and the brace that ends it, if that stands outside strings."""
    return (_count(masked, "{[") - _count(masked, "]") - F.when(open_end, 1).otherwise(0)).cast("long")


def _pieces(spark: SparkSession, pattern: str) -> DataFrame:
    """Pieces with their place, parity of quotes and change of depth for either start."""
    raw = spark.read.option("lineSep", "}").text(pattern).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("piece"))
    parts = F.split(F.regexp_replace("piece", r"(?s)\\.", "__"), '"', -1)
    odd = (F.size("_parts") - 1) % 2 == 1
    return raw.withColumn("_parts", parts).withColumns({
        "chunk": F.shiftright("at", CHUNK_BITS),
        "odd": odd,
        "from_out": _depth_change(_unquoted(F.col("_parts"), False), ~odd),
        "from_in": _depth_change(_unquoted(F.col("_parts"), True), odd),
    }).drop("_parts")


def _placed(pieces: DataFrame) -> DataFrame:
    """Add ``inside`` and ``depth`` at each piece's start, ``inside_end`` and ``depth_end``, ``closed``.

    ``closed`` is false for what follows a file's last closing brace.
    """
    order = Window.partitionBy(*CHUNK).orderBy("at")
    before, upto = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(
        Window.unboundedPreceding, 0)
    flips = F.coalesce(F.sum(F.col("odd").cast("int")).over(before), F.lit(0)) % 2 == 1
    rows = pieces.withColumn("_flip", flips)
    for start, same, other in (("out", "from_out", "from_in"), ("in", "from_in", "from_out")):
        own = F.when(F.col("_flip"), F.col(other)).otherwise(F.col(same))
        rows = rows.withColumn(f"_own_{start}", own).withColumn(
            f"_sum_{start}", F.sum(f"_own_{start}").over(upto))
    chunks = rows.groupBy(*CHUNK).agg(
        (F.sum(F.col("odd").cast("int")) % 2).alias("_odd"), F.sum("_own_out").alias("_out"),
        F.sum("_own_in").alias("_in"), F.max("file_size").alias("_size"),
        F.sum(F.octet_length("piece") + 1).alias("_bytes"), F.max("at").alias("_last_at"))
    line = Window.partitionBy("path").orderBy("block", "chunk")
    earlier = line.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("path")
    chunks = chunks.withColumn(
        "_inside", F.coalesce(F.sum("_odd").over(earlier), F.lit(0)) % 2 == 1)
    chunks = chunks.withColumn("_step", F.when(F.col("_inside"), F.col("_in")).otherwise(F.col("_out")))
    chunks = chunks.select(
        *CHUNK, "_inside", F.coalesce(F.sum("_step").over(earlier), F.lit(0)).alias("_depth"),
        # The reader drops the last separator, if there is one; sizes tell.
        F.when((F.sum("_bytes").over(whole) > F.col("_size")) & F.lead("chunk").over(line).isNull(),
               F.col("_last_at")).alias("_open_at"))
    rows = rows.join(chunks, CHUNK)
    pick = lambda name: F.when(F.col("_inside"), F.col(f"_{name}_in")).otherwise(
        F.col(f"_{name}_out"))
    inside = F.col("_inside") != F.col("_flip")
    return rows.select(
        *CHUNK, "at", "piece", inside.alias("inside"), (inside != F.col("odd")).alias("inside_end"),
        (F.col("_depth") + pick("sum") - pick("own")).alias("depth"),
        (F.col("_depth") + pick("sum")).alias("depth_end"),
        (~F.col("at").eqNullSafe(F.col("_open_at"))).alias("closed"))


def _opening(masked: Column, depth: Column, base: int) -> Column:
    """Offset of the brace that goes from the array's depth one deeper, else -1."""
    start = F.struct(depth.cast("long").alias("depth"), F.lit(0).alias("at"), F.lit(-1).alias("hit"))

    def step(acc: Column, part: Column) -> Column:
        head = F.substring(part, 1, 1)
        opens = (head == "{") & (acc["depth"] == base) & (acc["hit"] < 0)
        return F.struct(
            (acc["depth"] + F.when(head.isin("{", "["), 1).when(head == "]", -1).otherwise(0)).cast(
                "long").alias("depth"),
            (acc["at"] + F.length(part)).alias("at"),
            F.when(opens, acc["at"]).otherwise(acc["hit"]).alias("hit"))

    return F.aggregate(F.split(masked, _SOME_STRUCTURE, -1), start, step, lambda acc: acc["hit"])


def _in_arrays(placed: DataFrame, field: str | None) -> DataFrame:
    """Add ``element`` (number of elements that end before), ``name`` of the array, ``hit``, ``stray``."""
    base = 1 if field is None else 2
    parts = F.split(F.regexp_replace("piece", r"(?s)\\.", "__"), '"', -1)
    begins = ~F.col("inside") & (F.col("depth") <= base)
    rows = placed.withColumn("_masked", F.when(begins, _unquoted(parts, False))).withColumn(
        "hit", F.coalesce(_opening(F.col("_masked"), F.col("depth"), base), F.lit(-1)))
    before = F.when(F.col("hit") >= 0, F.substr(F.col("piece"), F.lit(1), F.col("hit")))
    shown = F.when(F.col("hit") >= 0, F.substr(F.col("_masked"), F.lit(1), F.col("hit")))
    flat = F.regexp_replace(shown, r"\[[^\[\]]*\]", "")
    opened = F.rtrim(F.translate(shown, "\t\r\n", "   ")).endswith("[")
    named = F.lit("") if field is None else F.regexp_extract(before, r'"((?:[^"\\]|\\.)*)"\s*:\s*\[\s*$', 1)
    same = (F.col("depth") == base) & ~flat.contains("]")
    rows = rows.withColumns({
        "_name": F.when(F.col("hit") < 0, None).when(same, None).when(opened, named).otherwise("\x00"),
        "stray": F.when(same, F.nullif(F.trim(F.regexp_replace(before, r"[\s,]+", " ")), F.lit(""))),
        "_end": ~F.col("inside_end") & (F.col("depth_end") == base) & F.col("closed") & (
            (F.col("hit") >= 0) | (F.col("depth") > base)),
    }).drop("_masked")
    order = Window.partitionBy(*CHUNK).orderBy("at")
    ends = F.col("_end").cast("long")
    rows = rows.withColumns({
        "_ends": F.coalesce(F.sum(ends).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_near": F.last("_name", True).over(order.rowsBetween(Window.unboundedPreceding, 0)),
    })
    chunks = rows.groupBy(*CHUNK).agg(
        F.sum(ends).alias("_n"), F.max_by("_name", F.when(F.col("_name").isNotNull(), F.col("at"))).alias("_own"))
    earlier = Window.partitionBy("path").orderBy("block", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select(*CHUNK, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
                           F.last("_own", True).over(earlier).alias("_far"))
    return rows.join(chunks, CHUNK).select(
        "path", "block", "at", "piece", "hit", "stray", "closed", F.col("_end").alias("ends"),
        (F.col("_before") + F.col("_ends")).alias("element"), F.coalesce("_near", "_far").alias("name"))


def read_array(spark: SparkSession, pattern: str, field: str | None = "processos",
               max_chars: int = MAX_CHARS) -> DataFrame:
    """Elements of the array ``field`` of each document (None: the document is the array).

    Rows (path, element, body, problem). ``element`` orders the objects of a
    file. ``problem`` is null for a readable object; else ``unreadable`` (the
    body is no JSON), ``stray`` (text between two objects), ``truncated`` (the file
    ends inside an object) or ``oversized`` (longer than ``max_chars``, handed
    out piece by piece in reading order). An empty file or array gives no rows.
    A quote or brace that is missing shifts all that follows in its file: it then comes out
    as unreadable, truncated or oversized, never as a readable object with wrong bounds.
    """
    found = store(_in_arrays(_placed(_pieces(spark, pattern)), field), "array_pieces")
    wanted = found.where(F.col("name") == F.lit(field or ""))
    key = ["path", "element"]
    sizes = wanted.groupBy(*key).agg(F.sum(F.length("piece") + 1).alias("_chars"), F.max("hit").alias("_hit"))
    large = sizes.where(F.col("_chars") > max_chars).select(*key)
    started = sizes.where((F.col("_hit") >= 0) & (F.col("_chars") <= max_chars)).select(*key)
    text = F.concat(F.when(F.col("hit") >= 0, F.expr("substr(piece, hit + 1)")).otherwise(F.col("piece")),
                    F.when(F.col("closed"), "}").otherwise(""))
    whole = wanted.join(started, key, "left_semi").groupBy(*key).agg(
        F.array_sort(F.collect_list(F.struct("block", "at", "hit", text.alias("text")))).alias("_p"),
        F.max("ends").alias("_ends"))
    # Text before the piece that opens the object belongs to no element.
    opened = F.array_position(F.transform("_p", lambda p: p["hit"] >= 0), F.lit(True))
    body = F.array_join(F.transform(F.slice("_p", opened.cast("int"), F.size("_p")), lambda p: p["text"]), "")
    whole = whole.select(*key, body.alias("body"), "_ends").select(
        *key, "body", F.when(~F.col("_ends"), "truncated").when(
            F.try_parse_json("body").isNull(), "unreadable").alias("problem"))
    stray = wanted.where("stray IS NOT NULL").select(*key, F.col("stray").alias("body"), F.lit("stray").alias("problem"))
    parts = wanted.join(large, key, "left_semi").select(*key, text.alias("body"), F.lit("oversized").alias("problem"))
    return whole.unionByName(stray).unionByName(parts)


def write_arrays(rows: DataFrame, document: str, order: str, path: str, field: str = "processos") -> None:
    """Each document's rows as one JSON array in a folder of its own, an object a line.

    ``order`` is unique inside a document; a document is one file, so one task writes it.
    """
    columns = [c for c in rows.columns if c != document]
    body = rows.select(document, F.col(order).alias("_order"), F.to_json(F.struct(*columns)).alias("_json"))
    ends = body.groupBy(F.col(document).alias("_document")).agg(
        F.min("_order").alias("_first"), F.max("_order").alias("_last"))
    lines = body.join(ends, F.col(document).eqNullSafe(F.col("_document"))).select(document, "_order", F.concat(
        F.when(F.col("_order") == F.col("_first"), F.lit(f'{{"meta": {{"of": {{}}}}, "{field}": [\n')).otherwise(""),
        "_json", F.when(F.col("_order") == F.col("_last"), F.lit("\n]}")).otherwise(","),
    ).alias("value"))
    lines.repartition(document).sortWithinPartitions(document, "_order").drop("_order").write.partitionBy(
        document).text(path)
