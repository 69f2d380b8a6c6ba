"""Line deduplication with a log-template tree of fixed depth.

A line is a row of tokens; tokens with a digit are a variable field from the
start. The tree has a level for the token count and one for each of the first
three tokens. In a leaf, a token that is frequent at its position is constant,
any other is a variable field. Frequent means a share of the leaf: the largest
of a few shares at which the line's constants reach the similarity bound, so
common values of a field do not split a template, whatever the input's size,
and a template that is rare in its leaf is still one. The line belongs to the
template of its constants. A template that
stands in enough different texts or surroundings, and in more than one
document, is boilerplate: its lines are dropped everywhere but in the first
document.

Texts are told apart by a hash, so exact copies of whole documents do not turn
every line of theirs into boilerplate; they are left to document deduplication.
Surroundings are the first words of the line before; they count a template that
recurs within few texts. Everything runs on built-in column functions, and no
group is ever collected: templates are told apart by order-free hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactum.llm.common import may_hold, membership, store

DEPTH = 3  # leading tokens on the way to a leaf
MIN_TOKENS = 1
MIN_PLACES = 5  # different texts or surroundings in which a template must stand
SIMILARITY = 0.8  # share of constant tokens
SHARES = [0.0, 1 / 128, 1 / 32, 1 / 8, 1 / 2]  # of a leaf, held by a constant; MIN_PLACES at least
VARIABLE = "<*>"
NO_LEAF = 0  # of lines that can be no template

LINE = ["h1", "h2"]
TEMPLATE = ["leaf", "level", "t1", "t2", "constants"]


def _body() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _masked(line: Column) -> Column:
    bare = F.btrim(line, F.lit(" \t\r"))
    return F.when(bare.rlike("[0-9]"), F.regexp_replace(
        bare, r"[^ 0-9]*+[0-9][^ ]*+", VARIABLE)).otherwise(bare)


def _lines(docs: DataFrame) -> DataFrame:
    """One row per line: (doc_id, tie, pos, line, place, leaf).

    Blank lines and one or two variable fields alone (numbers in a column) are no
    template.
    """
    lines = docs.select("doc_id", _body().alias("body")).select(
        "doc_id", F.xxhash64("body").alias("tie"), F.split("body", "\n").alias("lines"))
    with_before = lines.select("doc_id", "tie", F.posexplode(F.transform(
        "lines", lambda line, i: F.struct(
            line.alias("line"), F.substring_index(F.when(i > 0, F.get("lines", i - 1)), " ", DEPTH)
            .alias("before")))).alias("pos", "at"))
    return _placed(with_before.select(
        "doc_id", "tie", "pos", _masked(F.col("at.line")).alias("line"),
        F.xxhash64("at.before").alias("place")))


def _placed(lines: DataFrame) -> DataFrame:
    """Masked lines with their leaf, ``NO_LEAF`` where they can be no template.

    They are not filtered here: a filter would be pushed below the masking and mask each line again.
    """
    tokens = F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit(""))) + 1
    fields = F.col("line").isin("", VARIABLE, f"{VARIABLE} {VARIABLE}")
    leaf = F.when((F.col("tokens") >= MIN_TOKENS) & ~fields, F.xxhash64(
        "tokens", F.substring_index("line", " ", DEPTH))).otherwise(F.lit(NO_LEAF).cast("long"))
    return lines.withColumn("tokens", tokens).withColumn("leaf", leaf).drop("tokens")


def _crowded(docs: DataFrame) -> DataFrame:
    """Lines in leaves that hold enough lines to repeat a template often enough."""
    raw = docs.select(F.explode(F.split(_body(), "\n")).alias("line"))
    bare = _placed(raw.select(_masked(F.col("line")).alias("line")))
    leaves = store(bare.groupBy("leaf").agg(F.count_if(F.col("leaf") != NO_LEAF).alias("n")).where(
        F.col("n") >= MIN_PLACES).select("leaf"), "leaves")
    bits = F.broadcast(membership(leaves, F.col("leaf")))  # fixed size
    likely = _lines(docs).crossJoin(bits).where(may_hold(F.col("bits"), F.col("leaf"))).drop("bits")
    hashed = likely.withColumn("h1", F.xxhash64("line")).withColumn(
        "h2", F.xxhash64(F.lit(1), "line"))
    return store(hashed.join(leaves, "leaf", "left_semi"), "crowded")


def _recurrence() -> Column:
    """Different texts or different surroundings of a group, whichever are more."""
    return F.greatest(F.count_distinct("tie"), F.count_distinct("place"))


def _templates(crowded: DataFrame) -> DataFrame:
    """(h1, h2, template columns): the template of each different line that has one."""
    places = crowded.groupBy(*LINE).agg(_recurrence().alias("weight"))
    different = crowded.groupBy(*LINE).agg(F.first("leaf").alias("leaf"), F.first("line").alias("line"))
    tokens = store(
        different.join(places, LINE).select(
            *LINE, "leaf", "weight", F.posexplode(F.split("line", " ")).alias("pos", "token")),
        "tokens")
    counts = tokens.groupBy("leaf", "pos", "token").agg(F.sum("weight").alias("n"))
    whole = tokens.where("pos = 0").groupBy("leaf").agg(F.sum("weight").alias("whole"))
    constant = counts.where(F.col("n") >= MIN_PLACES).join(whole, "leaf").select(
        "leaf", "pos", "token", sum((F.col("n") >= share * F.col("whole")).cast("int")
                                    for share in SHARES).alias("levels"))
    marked = tokens.join(constant, ["leaf", "pos", "token"], "left")

    def at(level: int) -> Column:
        kept = lambda c: F.when(F.col("levels") > level, c)
        return F.struct(
            F.lit(level).alias("level"),
            F.coalesce(F.bit_xor(kept(F.xxhash64("pos", "token"))), F.lit(0)).alias("t1"),
            F.coalesce(F.bit_xor(kept(F.xxhash64("token", "pos"))), F.lit(0)).alias("t2"),
            F.count(kept(F.lit(1))).alias("constants"))

    # A template of a larger share holds those of smaller ones, so the first that suffices decides.
    by_level = marked.groupBy(*LINE, "leaf").agg(
        *[at(i).alias(f"at{i}") for i in range(len(SHARES))], F.count("*").alias("tokens"))
    suffices = lambda i: F.col(f"at{i}.constants") >= SIMILARITY * F.col("tokens")
    chosen = F.coalesce(*[F.when(suffices(i), F.col(f"at{i}")) for i in reversed(range(len(SHARES)))])
    return by_level.select(*LINE, "leaf", chosen.alias("own")).where("own is not null").select(
        *LINE, "leaf", "own.*")


def recurring_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, tie, pos) of every line to drop."""
    crowded = _crowded(docs)
    slim = crowded.select("doc_id", "tie", "pos", "place", *LINE)
    of_line = store(_templates(crowded), "templates")
    recurring = slim.select("doc_id", "tie", "place", *LINE).join(of_line, LINE).groupBy(
        *TEMPLATE).agg(_recurrence().alias("places"), F.min("doc_id").alias("first"),
                       F.max("doc_id").alias("last")).where(
        (F.col("places") >= MIN_PLACES) & (F.col("first") != F.col("last")))
    named = of_line.join(recurring.select(*TEMPLATE, "first"), TEMPLATE).select(*LINE, "first")
    return slim.join(named, LINE).where(~F.col("doc_id").eqNullSafe(F.col("first"))).select(
        "doc_id", "tie", "pos")


def drop_lines(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without their recurring lines; adds ``n_lines`` and ``n_dropped``.

    Rows that share an id count as one document, and the document with the
    lowest id keeps its lines of a template. Rows with a null id count towards
    a template's texts and places, but never as its first document. A null text stays
    null and has no line; a text whose lines are all dropped becomes empty, its
    row stays. Blank lines, and lines that are only one or two variable fields,
    are always kept. Repeated rows are treated alike. Other columns pass through, also ones named like helper
    columns; ``n_lines`` and ``n_dropped`` of the input are replaced.
    """
    drops = recurring_lines(docs).groupBy("doc_id", "tie").agg(F.collect_set("pos").alias("gone"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id"), F.xxhash64(
        _body()).alias("tie"))
    left, right = rows.alias("l"), drops.alias("r")
    both = left.join(right, (F.col("l.tie") == F.col("r.tie")) & F.col("l.doc_id").eqNullSafe(
        F.col("r.doc_id")), "left").select("l.row", "r.gone")
    text = F.col("row.text")
    lines = F.split(text, "\n")
    kept = F.filter(lines, lambda line, i: ~F.array_contains("gone", i))
    new = F.when(F.col("gone").isNull(), text).otherwise(F.array_join(kept, "\n"))
    return both.select(
        *[new.alias(c) if c == "text" else F.col("row")[c].alias(c)
          for c in docs.columns if c not in ("n_lines", "n_dropped")],
        F.when(text.isNotNull() & (text != ""), F.size(lines)).otherwise(0).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"))
