"""The evaluate path: compliance → conformity → alerts.

Contract and publication are joined once. The fields that scoring and alert
evidence need are stored with the compliance rows, so the later stages add no
join and no shuffle. Where those fields were not carried, `fallback_join` and
`alert_join` fetch them by key instead.

Each stage is meant to be stored before the next reads it (`stage_store`): a
filter on a stage's result is then answered from the stored column, not pushed
down through, and repeated inside, the whole rule computation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactum.functions.text import filled
from pactum.operators.alerts import alert_context
from pactum.operators.compliance import (
    KEY,
    answers_by_kind,
    compliance_rows,
    diagnostic_inputs,
    join_contract_publication,
)
from pactum.operators.conformity import score_conformity

CARRIED = [
    "contract_number_contract", "contract_value", "contract_number_publication",
    "publication_value", "fallback_used",
]


def compliance_stage(
    contracts: DataFrame, publications: DataFrame, raw_texts: DataFrame, answers: DataFrame
) -> DataFrame:
    """Compliance rows with the fields later stages need."""
    left = contracts.withColumn(
        "_value", F.coalesce(filled(F.col("header.value")), filled(F.col("value"))))
    joined = join_contract_publication(
        left, publications, contract_extra=["_value"], publication_extra=["value"])
    joined = diagnostic_inputs(joined, raw_texts)
    joined = joined.join(answers_by_kind(answers), KEY, "left")
    joined = joined.withColumns(
        {
            "contract_number_contract": F.col("c_contract_number"),
            "contract_value": F.col("c__value"),
            "contract_number_publication": F.col("p_contract_number"),
            "publication_value": F.col("p_value"),
            "fallback_used": F.lit(True),
        }
    )
    return compliance_rows(joined, carry=CARRIED)


def conformity_stage(compliance: DataFrame) -> DataFrame:
    """Scored rows, with the evidence context for alerts."""
    return score_conformity(compliance.withColumn("context", alert_context()), carry=["context"])
