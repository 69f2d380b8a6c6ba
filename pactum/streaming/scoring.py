"""Incremental evaluation of new publications.

The newest publication of every process is streaming state: an aggregate in
update mode, so a micro-batch restores and emits only the processes it names.
What they are scored against lies in snapshot tables dealt by process; a batch
opens the buckets of its processes. The alerts of the batch replace those of
its processes in one commit. So a batch costs what its rows and buckets cost,
however much arrived before, and the result does not depend on how arrivals are
cut into batches. A batch that is run again commits the same rows again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pactum.functions.dates import parse_dmy
from pactum.operators.alerts import classify_alerts
from pactum.operators.evaluate import compliance_stage, conformity_stage
from pactum.sources.snapshots import Change, Snapshots
from pactum.sources.stage_store import key_bucket, store

KEY = "processo_id"
INPUTS = ("contracts", "raw_texts", "answers")
ALERTS = "alerts"


def score_batch(
    publications: DataFrame, contracts: DataFrame, raw_texts: DataFrame, answers: DataFrame
) -> DataFrame:
    """Alerts of the contracts that a batch of publications names; other rows are not touched."""
    keys = publications.select(KEY).distinct()
    named, texts, replies = (d.join(keys, KEY, "left_semi") for d in (contracts, raw_texts, answers))
    return classify_alerts(conformity_stage(compliance_stage(named, publications, texts, replies)))


def newest_publications(publications: DataFrame) -> DataFrame:
    """The newest publication of each process, of a table or (in update mode) of a stream.

    Undated publications come first; ties go to the larger text, number and value.
    """
    rest = [c for c in publications.columns if c != KEY]
    # A struct is never null itself, so undated publications are ranked too.
    order = F.struct(
        parse_dmy(F.col("publication_date")), "publication_date", "contract_number", "value")
    newest = publications.groupBy(KEY).agg(F.max_by(F.struct(*rest), order).alias("_newest"))
    return newest.select(KEY, "_newest.*")


def publish_inputs(
    snapshots: Snapshots, contracts: DataFrame, raw_texts: DataFrame, answers: DataFrame
) -> int:
    """Store what publications are scored against; again for rows that changed."""
    return snapshots.commit(dict(zip(INPUTS, map(Change, (contracts, raw_texts, answers)))))


def start_scoring(publications: DataFrame, snapshots: Snapshots, checkpoint: str) -> StreamingQuery:
    """Score streamed publications as they arrive; alerts are the table ``alerts`` of ``snapshots``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        newest = store(batch, "newest_publications")  # the state is read and written once
        # At most as many rows as there are buckets.
        touched = [str(r[0]) for r in newest.select(
            key_bucket(KEY, snapshots.buckets)).distinct().collect()]
        if touched:
            version = snapshots.version()
            inputs = (snapshots.read(name, version, touched) for name in INPUTS)
            snapshots.commit({ALERTS: Change(score_batch(newest, *inputs))})

    return (
        newest_publications(publications).writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
