"""Requests for the language model, written as a table.

Answers come back as the table ``(processo_id, kind, response)`` that the
compliance stage joins; the call itself belongs to another system.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactum import constants as K
from pactum.functions.text import text_or_blank, truthy

KEY = "processo_id"
CONTRACT_KEYS = [entry[2] for entry in K.CONTRACT_FIELD_MAP]
PUBLICATION_KEYS = [entry[2] for entry in K.PUBLICATION_FIELD_MAP]


def extraction_prompt(text: Column, document: str, keys: list[str]) -> Column:
    head = (
        f"Read the {document} below and answer with one JSON object with the keys "
        f"{', '.join(keys)}. Give dates as DD/MM/YYYY, names as written, and null for "
        "whatever the text does not state.\n\n"
    )
    return F.concat(F.lit(head), F.substring(text_or_blank(text), 1, K.REQUEST_TEXT_CHARS))


def party_prompt(hiring: list[Column], hired: list[Column]) -> Column:
    head = (
        "Decide whether both documents name the same parties. Answer with one JSON object: "
        "contratante_match and contratada_match (true or false), contratante_explanation and "
        "contratada_explanation (one sentence each), overall_verdict (PASS only if both match, "
        "else FAIL), confidence (high, medium or low; low if a name is missing or unclear).\n"
    )
    return F.concat(
        F.lit(head), F.lit("Contract contratante: "), hiring[0], F.lit("\nGazette contratante: "),
        hiring[1], F.lit("\nContract contratada: "), hired[0], F.lit("\nGazette contratada: "),
        hired[1])


def extraction_requests(raw_texts: DataFrame) -> DataFrame:
    """Both extraction requests of every process that has both texts."""
    both = raw_texts.where(truthy(F.col("contract_text")) & truthy(F.col("publication_text")))
    requests = F.array(
        F.struct(F.lit("contract").alias("kind"), extraction_prompt(
            F.col("contract_text"), "public contract", CONTRACT_KEYS).alias("prompt")),
        F.struct(F.lit("publication").alias("kind"), extraction_prompt(
            F.col("publication_text"), "gazette publication", PUBLICATION_KEYS).alias("prompt")),
    )
    return both.select(KEY, F.inline(requests))


def party_requests(compliance: DataFrame) -> DataFrame:
    """Party comparisons, only where all names are known and the diagnostic allows it.

    Reads the stored compliance rows, so the gate filters before any prompt is built.
    """
    match = F.col("r002_party_match")
    hiring = [match["contract_contratante"], match["publication_contratante"]]
    hired = [match["contract_contratada"], match["publication_contratada"]]
    known = F.lit(True)
    for name in hiring + hired:
        known = known & truthy(name)
    asked = compliance.where(
        known & (F.col("extraction_diagnostic.agreement_level") != "DIVERGENT"))
    return asked.select(KEY, F.lit("r002").alias("kind"), party_prompt(hiring, hired).alias("prompt"))
