"""Which identifiers occur in which texts, however they are spelled.

Every text is looked up for every identifier, without comparing all pairs. A
spelling is cut into runs of letters and digits. A run inside the spelling must
be a whole run of the text; the first one only has to end a run, the last one
to begin one, a spelling that is one run may lie anywhere inside one. Only the
distinct runs of all texts are cut into ends, beginnings and inner parts, in the
lengths that spellings need. A spelling with a part that no run has is dropped;
any other is looked up by its rarest part, through the runs that hold it, and
the texts found are tested for the whole spelling.

Spellings without a letter or digit are never looked for; null texts hold
nothing. Upper and lower case count alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactum.functions.ids import id_variations
from pactum.sources.stage_store import store

RUN = r"[\p{L}\p{N}]+"
WHOLE, END, BEGIN, INSIDE = "whole", "end", "begin", "inside"
#: So many of the commonest runs that lead to no spelling are dropped before runs and spellings meet.
IDLE = 1 << 14


def _runs(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({RUN})"), F.lit(1))


def spellings(ids: DataFrame, key: str = "processo_id") -> DataFrame:
    """(id, rank, spelling): the spellings of each distinct identifier, in lower case, best first."""
    named = ids.select(F.col(key).alias("id")).where(F.col(key).isNotNull()).distinct()
    return named.select("id", F.posexplode(F.transform(id_variations(F.col("id")), F.lower)).alias("rank", "spelling"))


def _parts(spelled: DataFrame) -> DataFrame:
    """(id, rank, spelling, kind, part): what a text must hold to hold the spelling."""
    runs = spelled.withColumn("runs", _runs(F.col("spelling"))).where(F.size("runs") > 0)
    opens = ~F.rlike("spelling", F.lit(rf"^{RUN[:-1]}"))
    closes = ~F.rlike("spelling", F.lit(rf"{RUN[:-1]}\z"))
    each = runs.withColumns({"opens": opens, "closes": closes, "n": F.size("runs")}).select(
        "id", "rank", "spelling", "opens", "closes", "n", F.posexplode("runs").alias("i", "part"))
    left = F.col("opens") | (F.col("i") > 0)
    right = F.col("closes") | (F.col("i") < F.col("n") - 1)
    kind = F.when(left & right, WHOLE).when(right, END).when(left, BEGIN).otherwise(INSIDE)
    return each.select("id", "rank", "spelling", kind.alias("kind"), "part")


def _entries(runs: DataFrame, parts: DataFrame) -> DataFrame:
    """(run, pages, kind, part): what each distinct run of the texts holds, in the lengths that are asked for."""
    # One row; as many lengths as identifiers have characters.
    lengths = parts.groupBy().agg(*[
        F.sort_array(F.collect_set(F.when(F.col("kind") == k, F.length("part")))).alias(k)
        for k in (END, BEGIN, INSIDE)])
    n = F.length("run")
    fits = lambda kind: F.filter(kind, lambda size: size <= n)
    entry = lambda kind, part: F.struct(F.lit(kind).alias("kind"), part.alias("part"))
    run = F.col("run")
    held = F.concat(
        F.array(entry(WHOLE, run)),
        F.transform(fits(END), lambda size: entry(END, F.substring(run, n - size + 1, size))),
        F.transform(fits(BEGIN), lambda size: entry(BEGIN, F.substring(run, F.lit(1), size))),
        F.array_distinct(F.flatten(F.transform(fits(INSIDE), lambda size: F.transform(
            F.sequence(F.lit(1), n - size + 1), lambda at: entry(INSIDE, F.substring(run, at, size)))))))
    return runs.crossJoin(F.broadcast(lengths)).select("run", "pages", F.explode(held).alias("e")).select(
        "run", "pages", "e.*")


def _leads(parts: DataFrame, runs: DataFrame) -> DataFrame:
    """(run, id, rank, spelling): the runs that lead to each spelling, those that hold its rarest part."""
    entries = _entries(runs, parts)
    counts = entries.groupBy("kind", "part").agg(F.sum("pages").alias("pages"))
    held = parts.join(counts, ["kind", "part"], "left").groupBy("id", "rank", "spelling").agg(
        F.min(F.struct(F.coalesce("pages", F.lit(0)).alias("pages"), "kind", "part")).alias("rarest"))
    chosen = held.where("rarest.pages > 0").select("id", "rank", "spelling", "rarest.kind", "rarest.part")
    return chosen.join(entries, ["kind", "part"]).select("run", "id", "rank", "spelling")


def ids_in_texts(texts: DataFrame, ids: DataFrame, page: str, text: str, key: str = "processo_id") -> DataFrame:
    """(page, id, matched_variation) of every text (``page``, ``text``) and identifier it holds.

    The variation is the first in the order of spellings. ``page`` names a text.
    """
    parts = store(_parts(spellings(ids, key)), "spelling_parts")
    bodies = store(texts.select(F.col(page).alias("page"), F.lower(text).alias("body")), "bodies")
    tokens = bodies.select("page", F.explode(F.array_distinct(_runs(F.col("body")))).alias("run"))
    runs = store(tokens.groupBy("run").agg(F.count("*").alias("pages")), "runs")
    leads = store(_leads(parts, runs), "leads")
    idle = runs.join(leads.select("run").distinct(), "run", "left_anti").orderBy(F.desc("pages")).limit(IDLE)
    kept = tokens.join(F.broadcast(idle), "run", "left_anti")
    found = kept.join(leads, "run").select("page", "id", "rank", "spelling")
    hits = found.join(bodies, "page").where(F.contains("body", F.col("spelling")))
    return hits.groupBy("page", "id").agg(F.min_by("spelling", "rank").alias("matched_variation"))
