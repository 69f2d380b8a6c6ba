"""Corpus pipeline: quality, line dedup, near-duplicates, personal data, packing.

Each stage gets the rows its predecessor kept and returns a DataFrame that is
written as Parquet and read again for the next one. All stages but the last
return the columns of ``documents``; where a stage changes texts, ``n_chars``
follows. The stages work on all rows: nulls, empty texts, ties and repeated
rows are handled as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactum.llm import common, line_dedup, minhash, packing, pii, quality


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the changed text, where the column is there."""
    if "n_chars" not in docs.columns:
        return docs
    size = F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)
    return docs.withColumn("n_chars", size)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that pass the base rules and their language's fertility band."""
    return quality.keep_good(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop recurring template lines from the texts; every row stays."""
    return _recounted(line_dedup.drop_lines(docs).select(*docs.columns))


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates (five words, similarity 0.8)."""
    return minhash.keep_one(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data and disclosing terms by labels."""
    return _recounted(pii.redact(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: (bin_id, bin_size, used, doc_ids, text)."""
    return packing.sequences(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", dedup_lines),
    ("MinHash near-dedup", dedup_documents),
    ("PII", redact_personal_data),
    ("best-fit packing", pack_sequences),
]

#: Several stages cannot be said in SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored in the shared folder and read again."""
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = common.store(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
