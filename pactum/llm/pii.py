"""Personal data: patterns for the base kinds, and terms that give protected entities away.

The base kinds are found by patterns in every text. Each distinct value is a
protected entity. Words near its mentions are terms; over the whole corpus, the
information a term gives about an entity is compared with the information the
entity itself holds: PMI(term; entity) / IC(entity). A term at or above the
disclosure threshold tells who is meant nearly as well as the value does, so
its mentions become spans as well. Everything runs on built-in column functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactum.llm.common import may_hold, membership, store

#: Kinds in the order of the result; the method's own kind comes last.
KINDS = ["email", "ip", "card", "phone", "term"]

#: Possessive forms of the patterns: the same leftmost matches, without retries inside a run.
_LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",  # shorter runs of digits are no cards
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"  # of a part that has a digit
TERM = r"[\p{L}\p{N}]+"
_BREAK = r"[^\p{L}\p{N}]+"

BLOCK = 1 << 14  # characters of a text's blocks
WINDOW = 3  # terms on either side of a mention
THRESHOLD = 0.9
MIN_DOCS = 3  # distinct texts that must show a term beside an entity
#: Of the bit array of terms, which is copied for each text: 128 KB, below the JVM's outsized objects.
TERM_WORDS = 1 << 14
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]"}
_SPAN = "array<struct<kind:int,start:int,end:int,value:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = F.filter(F.split(F.reverse(_digits(value)), ""), lambda d: d != "")
    doubled = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        (d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    size = F.length(_digits(value))
    if kind == "ip":
        return value.rlike(rf"\A{_BYTE}(?:\.{_BYTE}){{3}}\z")
    if kind == "card":
        return size.between(13, 19) & _luhn(value)
    if kind == "phone":
        return size.between(9, 15)
    return F.lit(True)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _before(values: Column, join) -> Column:
    """For each number, those before it joined by ``join`` (a sum, a maximum), starting from 0.

    Growing a list copies it, so the join runs inside chunks of about the square
    root of the list, and over the chunks.
    """
    def running(list_):
        return F.aggregate(list_, F.array(F.lit(0)), lambda acc, v: F.array_append(
            acc, join(F.element_at(acc, -1), v)))

    def inside(x):
        return F.transform(
            F.sequence(F.lit(0), F.ceil(F.size(x["n"]) / x["k"]).cast("int") - 1),
            lambda c: running(F.slice(x["n"], c * x["k"] + 1, x["k"])))

    def joined(chunks):
        ends = running(F.transform(chunks, lambda c: F.element_at(c, -1)))
        return _let(ends, lambda e: F.flatten(F.transform(chunks, lambda c, i: F.transform(
            F.slice(c, F.lit(1), F.size(c) - 1), lambda v: join(v, F.get(e, i))))))

    chunk = F.ceil(F.sqrt(F.size(values))).cast("int")
    found = _let(F.struct(values.alias("n"), chunk.alias("k")), lambda x: _let(inside(x), joined))
    return F.when(F.size(values) > 0, found).otherwise(F.array().cast("array<int>"))


def _places(text: Column, pattern: str | Column) -> Column:
    """Matches of a pattern with their code-point offsets, from the pieces between them."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    values = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    pairs = F.filter(F.arrays_zip(values.alias("v"), gaps.alias("g")), lambda m: m["v"].isNotNull())

    def placed(m):
        return _let(_before(F.transform(
            m, lambda x: x["g"] + F.length(x["v"])), lambda a, b: a + b), lambda before: F.transform(
            m, lambda x, i: F.struct(
                (F.get(before, i) + x["g"]).alias("start"),
                (F.get(before, i) + x["g"] + F.length(x["v"])).alias("end"), x["v"].alias("value"))))

    return _let(pairs, placed)


def _kind_spans(text: Column, kind: str) -> Column:
    """Valid spans of one kind; texts without its telling characters are not searched."""
    guard = {"email": text.contains("@"), "phone": text.contains("+")}.get(kind, text.rlike(
        r"[0-9]\.[0-9]" if kind == "ip" else r"[0-9][\x20-]?[0-9]"))
    found = F.filter(_places(text, PATTERNS[kind]), lambda s: _valid(kind, s["value"]))
    spans = F.transform(found, lambda s: F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
        s["value"].alias("value")))
    return F.when(guard, spans).otherwise(F.array().cast(_SPAN)).cast(_SPAN)


def base_spans(text: Column) -> Column:
    """Spans (kind number, start, end, value) by kind, then start."""
    return F.concat(*[_kind_spans(text, k) for k in KINDS[:4]])


def _body(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def _keys(text: Column) -> list[Column]:
    """Two independent hashes stand for a text, so that copies count as one observation."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


KEY = ["k1", "k2"]


def _terms_of(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, _BREAK), F.lower), lambda w: w.rlike(r"\p{L}"))


def _beside(text: Column, base: Column) -> Column:
    """(entity, term): terms within the window on either side of each mention."""
    around = 30 * WINDOW  # characters looked at; they hold the window of ordinary words

    # A place deep in a text is found by counting from the text's start, so it is cut into blocks first.
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor(F.length(text) / BLOCK).cast("int")),
        lambda i: F.substr(text, i * BLOCK + 1, F.lit(BLOCK + around)))

    def near(s, cut):
        left = F.greatest(F.lit(0), s["start"] - around)
        words = F.concat(F.slice(F.reverse(_terms_of(cut(left, s["start"] - left))), 1, WINDOW),
                         F.slice(_terms_of(cut(s["end"], F.lit(around))), 1, WINDOW))
        entity = F.concat_ws(":", s["kind"], s["value"])
        return F.transform(F.array_distinct(words), lambda w: F.struct(
            entity.alias("entity"), w.alias("term")))

    def cut_from(parts):
        return lambda at, size: F.substr(
            F.get(parts, F.floor(at / BLOCK).cast("int")), at % BLOCK + 1, size)

    return _let(blocks, lambda parts: F.flatten(F.transform(base, lambda s: near(s, cut_from(parts)))))


def find_base(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Carried columns, text keys, base spans and the terms beside them; no text."""
    carry = ["doc_id"] if carry is None else carry
    body = docs.select(*carry, _body(text).alias("_text"))
    spans = body.select("*", *_keys(F.col("_text")), base_spans(F.col("_text")).alias("base"))
    return spans.select(*carry, *KEY, "base", F.when(F.size("base") > 0, _beside(
        F.col("_text"), F.col("base"))).alias("beside"))


def _disclosure(n_term: str) -> Column:
    """PMI(term; entity) / IC(entity) from counts of texts."""
    pmi = F.log(F.col("total") * F.col("n_both") / (F.col(n_term) * F.col("n_entity")))
    return pmi / F.log(F.col("total") / F.col("n_entity"))


def _candidates(found: DataFrame, threshold: float) -> DataFrame:
    """(term, n_both, n_entity, total): pairs that may reach the threshold.

    A term stands in at least as many texts as it is seen beside entities; with
    that lower bound the disclosure is too high, never too low, so common words
    drop out before the corpus is searched for terms.
    """
    total = found.select(*KEY).distinct().agg(F.count("*").alias("total"))
    beside = found.where(F.size("beside") > 0).select(*KEY, F.explode("beside").alias("p")).select(
        *KEY, "p.*").distinct()
    entities = found.where(F.size("base") > 0).select(*KEY, F.explode("base").alias("s")).select(
        *KEY, F.concat_ws(":", "s.kind", "s.value").alias("entity")).distinct().groupBy(
        "entity").agg(F.count("*").alias("n_entity"))
    at_least = beside.select(*KEY, "term").distinct().groupBy("term").agg(
        F.count("*").alias("n_least"))
    both = beside.groupBy("entity", "term").agg(F.count("*").alias("n_both")).where(
        F.col("n_both") >= MIN_DOCS)
    return both.join(entities, "entity").join(at_least, "term").crossJoin(
        F.broadcast(total)).where(  # one row
        (F.col("n_entity") < F.col("total")) & (_disclosure("n_least") >= threshold)).select(
        "term", "n_both", "n_entity", "total")


def _hits(docs: DataFrame, text: str, terms: DataFrame) -> DataFrame:
    """(_text, term): words of each text that may be among the terms.

    Each task drops the words that a bit array of fixed size excludes, so the
    exact join that follows sees few others.
    """
    bits = F.broadcast(membership(terms, F.xxhash64("term"), TERM_WORDS))
    words = F.array_distinct(F.transform(F.split("_text", _BREAK), F.lower))
    likely = F.filter(words, lambda w: may_hold(F.col("bits"), F.xxhash64(w), TERM_WORDS))
    return docs.select(_body(text).alias("_text")).crossJoin(bits).select(
        "_text", F.explode(likely).alias("term"))


def term_spans(docs: DataFrame, found: DataFrame, text: str = "text",
               threshold: float = THRESHOLD) -> DataFrame:
    """(k1, k2, terms): places of disclosing terms in each text that has any.

    The candidates' texts are counted first; only terms that then reach the
    threshold are located.
    """
    candidates = store(_candidates(found, threshold), "candidates")
    seen = _hits(docs, text, candidates).select(*_keys(F.col("_text")), "term").distinct()
    counts = seen.groupBy("term").agg(F.count("*").alias("n_term"))
    telling = store(candidates.join(counts, "term").where(_disclosure("n_term") >= threshold).select(
        "term").distinct(), "telling")
    exact = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])\Q"), F.col("term"), F.lit(r"\E(?![\p{L}\p{N}])"))
    placed = _hits(docs, text, telling).select(*_keys(F.col("_text")), "term", F.transform(
        _places(F.col("_text"), exact), lambda s: F.struct(s["start"], s["end"])).alias("places"))
    single = placed.join(telling, "term").groupBy(*KEY, "term").agg(F.first("places").alias("places"))
    return single.groupBy(*KEY).agg(F.flatten(F.collect_list("places")).alias("terms"))


def _all_spans() -> Column:
    """Base spans, then the terms that no base span overlaps, in text order."""
    free = F.filter(F.coalesce("terms", F.array().cast("array<struct<start:int,end:int>>")),
                    lambda t: ~F.exists("base", lambda s: (s["start"] < t["end"]) & (
                        t["start"] < s["end"])))
    terms = F.transform(F.array_sort(free), lambda t: F.struct(
        F.lit(4).alias("kind"), t["start"].alias("start"), t["end"].alias("end"),
        F.lit("").alias("value")))
    return F.concat("base", terms.cast(_SPAN))


def _listed(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"], s["end"])), ",")


def personal_data(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Spans of every row: (doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term).

    Reads doc_id and text only. A null text is empty and has no span. Rows may
    share ids or texts: each row is searched, equal texts are one observation in
    the counts and get equal spans. An empty table gives an empty result.
    """
    found = store(find_base(docs), "base_spans")
    terms = term_spans(docs, found, threshold=threshold)
    joined = found.join(terms, KEY, "left").withColumn("all", _all_spans())
    count = lambda k: F.size(
        F.filter("base", lambda s: s["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return joined.select(
        "doc_id", *map(count, KINDS[:4]), F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.col("all")).alias("spans"),
        (F.size("all") - F.size("base")).cast("long").alias("n_term"))


def redact(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` with every span of ``text`` replaced by a label of its kind.

    Where spans overlap, the first one's label stands for their union. A null
    text stays null; other columns are unchanged.
    """
    columns = docs.columns
    found = store(find_base(docs, carry=[]), "base_spans")
    terms = term_spans(docs, found, threshold=threshold)
    body = docs.select(F.struct(*columns).alias("row"), _body("text").alias("_text")).select(
        "row", "_text", *_keys(F.col("_text")), base_spans(F.col("_text")).alias("base"))
    marked = body.join(terms, KEY, "left").withColumn("all", F.array_sort(F.transform(
        _all_spans(), lambda s: F.struct(s["start"], s["end"], s["kind"]))))
    text, labels = F.col("_text"), F.array(*[F.lit(LABELS[k]) for k in KINDS])
    # Where the spans before each one end; it is replaced if it begins there or later.
    done = F.col("done")
    marked = marked.withColumn("done", _before(F.transform("all", lambda s: s["end"]), F.greatest))
    parts = F.transform("all", lambda s, i: F.when(s["start"] >= F.get(done, i), F.concat(
        F.substr(text, F.get(done, i) + 1, s["start"] - F.get(done, i)),
        F.element_at(labels, s["kind"] + 1))).otherwise(""))
    last = F.array_max(F.transform("all", lambda s: s["end"]))
    new = F.concat(F.array_join(parts, ""), F.substr(text, last + 1))
    rewritten = F.when(F.size("all") == 0, F.col("row.text")).otherwise(new)
    return marked.select(*[
        (rewritten if c == "text" else F.col("row")[c]).alias(c) for c in columns])
