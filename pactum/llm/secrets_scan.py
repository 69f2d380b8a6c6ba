"""Secret scan: candidates by pattern, false positives removed by a random forest.

Candidates are values assigned to a credential name, and long runs that hold a
digit. A forest over the candidate's length, its character transitions, its
dictionary coverage, path signs and the words beside it is trained on labelled
findings and scores every candidate. Candidates, features and scores are
built-in column functions and JVM model code.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactum.llm.common import store
from pactum.llm.pii import _luhn, _places

TRAIN_ROWS = 20_000
TREES, DEPTH, SEED = 30, 8, 11
THRESHOLD = 0.5
BESIDE = 40  # characters of text looked at on either side

_RUN = "A-Za-z0-9+/_~-"
_NAME = r"(?:passw(?:or)?d|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|credential)"
LONG = rf"(?<![{_RUN}])(?=[A-Za-z+/_~-]*+[0-9])[{_RUN}]{{12,}}+={{0,2}}"
ASSIGNED = rf"(?i)(?<![a-z]){_NAME}[\"']?[\x20\t]?[:=][\x20\t]?[\"']?[^\s\"']{{6,}}+"
_VALUE = r"(?i)[\"']?[\x20\t]?[:=][\x20\t]?[\"']?([^\s\"']{6,}+)\z"
PLACEHOLDERS = r"(?i)example|sample|dummy|placeholder|changeme|your[_-]|xxxx|test|<|\$\{"

_SPAN = "array<struct<start:int,end:int,value:string>>"


def _found(text: Column) -> Column:
    """Spans (start, end, value, assigned): assigned values, then long runs outside of them."""
    none = F.array().cast(_SPAN)
    assigned = F.when(text.rlike(rf"(?i){_NAME}"), F.transform(
        _places(text, ASSIGNED), lambda s: F.struct(
            (s["end"] - F.length(F.regexp_extract(s["value"], _VALUE, 1))).alias("start"),
            s["end"].alias("end"), F.regexp_extract(s["value"], _VALUE, 1).alias("value")))).otherwise(
        none).cast(_SPAN)
    runs = F.when(text.rlike("[0-9]"), _places(text, LONG)).otherwise(none).cast(_SPAN)
    mark = lambda spans, flag: F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"),
        F.lit(flag).alias("assigned")))
    free = F.filter(runs, lambda r: ~F.exists(assigned, lambda a: (a["start"] < r["end"]) & (
        r["start"] < a["end"])))
    return F.concat(mark(assigned, True), mark(free, False))


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, start, end, value, assigned, before, after); code points, end exclusive.

    A null text has no candidate. Repeated rows give repeated candidates; ids
    are only carried. Other columns are not read.
    """
    body = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = body.select("doc_id", "text", F.explode(_found(F.col("text"))).alias("s"))
    size = F.least(F.col("s.start"), F.lit(BESIDE))
    return found.select(
        "doc_id", "s.*", F.substr("text", F.col("s.start") - size + 1, size).alias("before"),
        F.substr("text", F.col("s.end") + 1, F.lit(BESIDE)).alias("after"))


def dictionary(spark: SparkSession, path: str | None = None, shortest: int = 4) -> DataFrame:
    """(word): whole words of a public vocabulary; its size is that of the file, not of the data."""
    import public_tokenizers

    lines = spark.createDataFrame(
        [(w,) for w in _vocabulary_words(path or public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                         shortest)], "word string")
    return lines


def _vocabulary_words(path: str, shortest: int) -> list[str]:
    import base64

    words = set()
    with open(path, "rb") as file:
        for line in file:
            piece = base64.b64decode(line.split()[0]).decode("utf-8", "ignore")
            word = piece.strip().lower()
            if piece.startswith(" ") and len(word) >= shortest and word.isalpha():
                words.add(word)
    return sorted(words)


FEATURES = [
    "n_chars", "digits", "uppers", "lowers", "symbols", "different", "letter_digit", "digit_letter",
    "case_change", "vowel_change", "hex_only", "digits_only", "luhn", "coverage", "slashes",
    "path_before", "file_end", "named", "named_near", "quoted", "placeholder", "words_before",
]


def with_features(found: DataFrame, words: DataFrame) -> DataFrame:
    """Candidates with the forest's columns; ``words`` is a table of bounded size."""
    v, n = F.col("value"), F.length("value")
    share = lambda pattern: F.regexp_count(v, F.lit(pattern)) / n
    near = F.concat_ws(" ", "before", "after")
    rows = found.select(
        "*", n.alias("n_chars"), share("[0-9]").alias("digits"), share("[A-Z]").alias("uppers"),
        share("[a-z]").alias("lowers"), share("[^A-Za-z0-9]").alias("symbols"),
        (F.size(F.array_distinct(F.split(v, ""))) / n).alias("different"),
        share("[A-Za-z](?=[0-9])").alias("letter_digit"),
        share("[0-9](?=[A-Za-z])").alias("digit_letter"),
        share("[a-z](?=[A-Z])|[A-Z](?=[a-z])").alias("case_change"),
        share("(?i)[aeiou](?=[b-df-hj-np-tv-z])|[b-df-hj-np-tv-z](?=[aeiou])").alias("vowel_change"),
        v.rlike("^[0-9a-fA-F]+$").cast("double").alias("hex_only"),
        v.rlike("^[0-9]+$").cast("double").alias("digits_only"),
        F.coalesce((v.rlike("^[0-9]+$") & _luhn(v)).cast("double"), F.lit(0.0)).alias("luhn"),
        share("/").alias("slashes"),
        F.col("before").rlike(r"[/\\.]\z").cast("double").alias("path_before"),
        F.concat("value", "after").rlike(r"\A[^ \n]*\.[a-z]{1,4}\b").cast("double").alias("file_end"),
        F.col("assigned").cast("double").alias("named"),
        F.col("before").rlike(rf"(?i){_NAME}").cast("double").alias("named_near"),
        (F.col("before").rlike(r"[\"']\z") & F.col("after").rlike(r"\A[\"']")).cast("double").alias(
            "quoted"),
        F.concat("value", near).rlike(PLACEHOLDERS).cast("double").alias("placeholder"),
        F.regexp_count("before", F.lit(r"\p{L}{3,}")).cast("double").alias("words_before"),
    )
    # Letters of each different value that lie in dictionary words.
    runs = rows.select("value").distinct().withColumn("run", F.explode(F.array_distinct(
        F.regexp_extract_all(F.lower("value"), F.lit("[a-z]{4,}"), F.lit(0)))))
    covered = runs.join(F.broadcast(words.select(F.col("word").alias("run"))), "run").groupBy(
        "value").agg(F.sum(F.length("run")).alias("covered"))
    return rows.join(covered, "value", "left").withColumn(
        "coverage", F.coalesce("covered", F.lit(0)) / F.length("value")).drop("covered")


def rule_labels(found: DataFrame) -> DataFrame:
    """Findings with a label where a plain rule is sure: the stand-in for a labelled set.

    1: a value under a credential name that mixes letters and digits and is no
    placeholder. 0: digits alone, a path, or a run that is mostly dictionary words.
    """
    mixed = F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]")
    sure = F.col("assigned") & mixed & (F.col("placeholder") == 0)
    wrong = (F.col("digits_only") == 1) | (F.col("slashes") > 0.1) | (F.col("coverage") > 0.6)
    return found.withColumn("label", F.when(sure, 1.0).when(wrong, 0.0)).where("label is not null")


@dataclass
class Forest:
    """A trained forest, or the one label that all findings had (None: there were none)."""

    model: RandomForestClassificationModel | None
    only: float | None = None


_ASSEMBLER = {"inputCols": FEATURES, "outputCol": "features", "handleInvalid": "keep"}


def train(labelled: DataFrame, limit: int = TRAIN_ROWS) -> Forest:
    """Fit on at most ``limit`` labelled findings, chosen by a hash of value and place."""
    chosen = store(labelled.select(*FEATURES, "label", "doc_id", "start", "value").orderBy(
        F.xxhash64("value", "doc_id", "start"), "doc_id", "start").limit(limit), "labelled")
    classes = [r["label"] for r in chosen.select("label").distinct().collect()]
    if len(classes) < 2:
        return Forest(None, classes[0] if classes else None)
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, labelCol="label", featuresCol="features")
    return Forest(forest.fit(VectorAssembler(**_ASSEMBLER).transform(chosen)))


def judge(found: DataFrame, forest: Forest) -> DataFrame:
    """Add ``score``; without a forest it is the only label seen, or null."""
    if forest.model is None:
        return found.withColumn("score", F.lit(forest.only).cast("double"))
    rows = forest.model.transform(VectorAssembler(**_ASSEMBLER).transform(found))
    return rows.withColumn("score", vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability", "prediction")


def scan(docs: DataFrame, labelled: DataFrame | None = None, path: str | None = None) -> DataFrame:
    """(doc_id, start, end, named, score, secret) for every candidate of every text.

    ``labelled`` is a table of findings with the columns of ``with_features``
    and a label (0 or 1); without it labels come from ``rule_labels`` over all
    candidates. A candidate counts as a secret at a score of at least 1/2; a
    null score (no label anywhere) keeps the candidate.
    """
    spark = docs.sparkSession
    found = store(with_features(candidates(docs), dictionary(spark, path)), "candidates")
    forest = train(rule_labels(found) if labelled is None else labelled)
    return judge(found, forest).select(
        "doc_id", "start", "end", F.col("assigned").alias("named"), "score",
        F.coalesce(F.col("score") >= THRESHOLD, F.lit(True)).alias("secret"))
