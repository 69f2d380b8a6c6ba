"""Domain tables, shaped as the operators expect, over the driver's tables."""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactum import constants as K
from pactum.operators.alerts import classify_alerts
from pactum.operators.contract_text import (
    embedded_as_publication,
    embedded_extracts,
    preprocess_contracts,
)
from pactum.operators.discovery import discovery_metadata
from pactum.operators.evaluate import compliance_stage, conformity_stage
from pactum.operators.gazette_text import (
    consolidate,
    parsed_documents,
    prefer_embedded,
    primary_publications,
)
from pactum.operators.ranking import written
from pactum.operators.report import report_rows
from pactum.operators.state import state_index
from pactum.sources import adapter
from pactum.session import checkpoint_dir
from pactum.sources.snapshots import Change, Snapshots
from pactum.sources.stage_store import store

KEY = "processo_id"


class Tables:
    """Lazy access to the audit tables of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def view(self, name: str) -> DataFrame:
        return adapter.table(self.spark, self.sf_dir, name)

    def base(self, name: str) -> DataFrame:
        return adapter.table(self.spark, self.sf_dir, name)

    @cached_property
    def links(self) -> DataFrame:
        return self.view("links").withColumn("discovery_path", F.split("path_text", " > ")).drop(
            "path_text")

    @cached_property
    def contracts(self) -> DataFrame:
        return self.view("contracts").select(
            KEY,
            "document_type",
            F.struct(
                "contract_number", "signing_date", "contratante", "contratada",
                F.col("header_value").alias("value"),
            ).alias("header"),
            "value",
            F.struct(
                F.col("emb_found").alias("found"),
                F.col("emb_contratante").alias("contratante_pub"),
                F.col("emb_contratada").alias("contratada_pub"),
            ).alias("embedded_publication"),
        )

    @cached_property
    def publications(self) -> DataFrame:
        return self.view("publications")

    @cached_property
    def raw_texts(self) -> DataFrame:
        return self.view("raw_presence")

    @cached_property
    def answers(self) -> DataFrame:
        return self.view("answer_rows")

    @cached_property
    def compliance(self) -> DataFrame:
        """Stored compliance stage."""
        return store(
            compliance_stage(self.contracts, self.publications, self.raw_texts, self.answers),
            "compliance")

    @cached_property
    def conformity(self) -> DataFrame:
        """Stored conformity stage."""
        return store(conformity_stage(self.compliance), "conformity")

    @cached_property
    def conformity_writes(self) -> DataFrame:
        """All writes of the conformity stage: a twentieth of the processes was scored before, and failed."""
        early = self.conformity.where(F.pmod(F.xxhash64(KEY), F.lit(20)) == 0).withColumns({
            "overall_status": F.lit(K.STATUSES[-1]), "conformity_score": F.lit(-1.0)})
        return written(early, 1).unionByName(written(self.conformity, 2))

    @cached_property
    def alerts(self) -> DataFrame:
        return classify_alerts(self.conformity)

    @cached_property
    def parsed_documents(self) -> DataFrame:
        """Stored gazette documents with their parsed fields, without texts."""
        return store(parsed_documents(self.gazette_docs), "parsed_documents")

    @cached_property
    def preprocessed(self) -> DataFrame:
        """Stored contract texts as structured rows."""
        return store(preprocess_contracts(self.contract_docs), "contract_preprocessed")

    @cached_property
    def structured(self) -> DataFrame:
        """Stored publication of each process; what was parsed whole before is not read again."""
        made = vars(self)
        gazette = (consolidate(self.parsed_documents) if "parsed_documents" in made
                   else primary_publications(self.gazette_docs))
        extracts = (self.preprocessed if "preprocessed" in made
                    else store(embedded_extracts(self.contract_docs), "embedded_extracts"))
        return store(prefer_embedded(gazette, embedded_as_publication(extracts)), "structured")

    @cached_property
    def lookups(self) -> Snapshots:
        """Links and stage documents stored by process, for reads of one process."""
        snapshots = Snapshots(self.spark, f"{checkpoint_dir(self.spark)}/pactum/{uuid.uuid4().hex}/lookups")
        links = self.links.withColumn(KEY, F.trim(KEY))
        snapshots.commit({"links": Change(links), "artifacts": Change(self.view("artifact_docs"))})
        return snapshots

    @cached_property
    def state(self) -> DataFrame:
        return state_index(self.links, self.view("artifact_docs"))

    @cached_property
    def report_rows(self) -> DataFrame:
        """Stored report rows, one per discovered process."""
        sides = self.conformity_writes, *[written(side, 1) for side in (
            discovery_metadata(self.links), self.publications, self.contracts)]
        rows = report_rows(self.state, *sides)
        return store(rows, "report_rows")

    @cached_property
    def gazette_docs(self) -> DataFrame:
        return self.view("gazette_docs")

    @cached_property
    def contract_docs(self) -> DataFrame:
        return self.view("contract_docs").select(KEY, "raw_text")

    @cached_property
    def run_log(self) -> DataFrame:
        return self.view("run_log")


_OPEN: dict[tuple[str, str], Tables] = {}


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The tables of one folder; their lazy plans are built once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _OPEN:
        _OPEN[key] = Tables(spark, sf_dir)
    return _OPEN[key]
