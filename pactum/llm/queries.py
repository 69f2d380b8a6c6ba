"""Registered queries of the text operators, over whole tables, and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactum.llm import (
    bpe, checks, common, conversation_repair, line_dedup, minhash, ngram_join,
    order_minhash, packing, phrases, pii, quality,
    secrets_scan, toxicity, url_filter,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


@query
def op3_bpe_round_trip(spark, sf_dir):
    return bpe.round_trip_digest(common.documents(spark, sf_dir), carry=["doc_id"])


@query
def op6_tokeniser_fertility(spark, sf_dir):
    found = quality.quality(common.documents(spark, sf_dir), carry=["doc_id"])
    first = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
             "base_failed", "kept"]
    return found.select(*first, *[c for c in found.columns if c not in first])


@query
def op7_minhash(spark, sf_dir):
    return minhash.near_duplicates(common.documents(spark, sf_dir), width=4, percent=80)


@query
def op10_order_minhash(spark, sf_dir):
    return order_minhash.neighbour_fingerprints(common.documents(spark, sf_dir))


@query
def op9_toxicity(spark, sf_dir):
    return toxicity.toxicity(
        common.documents(spark, sf_dir), common.documents(spark, sf_dir, "labels"))


@query
def op5_url_filter(spark, sf_dir):
    return url_filter.judge(common.documents(spark, sf_dir, "pages"), url_filter.rule_table(spark))


CHECKS["op5_url_filter"] = url_filter.SQL


@query
def op2_disclosure(spark, sf_dir):
    return pii.personal_data(common.documents(spark, sf_dir))


@query
def op1_line_templates(spark, sf_dir):
    docs = common.documents(spark, sf_dir).select("doc_id", "text")
    return line_dedup.drop_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256"))


@query
def op8_best_fit(spark, sf_dir):
    return packing.pack(common.documents(spark, sf_dir))


@query
def op4_secret_forest(spark, sf_dir):
    return secrets_scan.scan(common.documents(spark, sf_dir))


@query
def op12_structure_repair(spark, sf_dir):
    return conversation_repair.report(common.documents(spark, sf_dir, "conversations"))


CHECKS["op12_structure_repair"] = checks.STRUCTURE_REPAIR


@query
def op11_collocations(spark, sf_dir):
    return phrases.collocations(common.documents(spark, sf_dir))


CHECKS["op11_collocations"] = checks.COLLOCATIONS


@query
def op13_grouped_prefix(spark, sf_dir):
    return ngram_join.similar_groups(common.documents(spark, sf_dir), width=3, percent=90)


CHECKS["op13_grouped_prefix"] = checks.GROUPED_PREFIX
