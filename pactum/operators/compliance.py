"""Compliance stage: join, cross-check, R001 and R002."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactum import constants as K
from pactum.functions.dates import parse_dmy
from pactum.functions.text import truthy
from pactum.operators.diagnostic import (
    answer_warning,
    answered,
    compared,
    field_checks,
    merge_diagnostics,
)
from pactum.operators.rules import (
    match_answer,
    names_where,
    overall_status,
    parse_object,
    party_match,
    timeliness,
    undecided,
)

NO_PUBLICATION = "no_publication_found"
KEY = "processo_id"


def contract_fields(contracts: DataFrame) -> DataFrame:
    """The five comparator fields of a preprocessed contract."""
    header = F.col("header")
    names = ["contract_number", "signing_date", "contratante", "contratada"]
    return contracts.select(KEY, *[header[name].alias(name) for name in names])


def embedded_party(found: Column, embedded: Column, gazette: Column) -> Column:
    return F.when(found & truthy(embedded), embedded).otherwise(gazette)


def publication_fields(publications: DataFrame, contracts: DataFrame) -> DataFrame:
    """Comparator fields of a publication; embedded party names override."""
    emb = contracts.select(KEY, F.col("embedded_publication").alias("_emb"))
    found = F.coalesce(F.col("_emb.found"), F.lit(False))
    return publications.join(emb, KEY, "left").select(
        KEY,
        "contract_number",
        "publication_date",
        *[
            embedded_party(found, F.col(f"_emb.{side}_pub"), F.col(side)).alias(side)
            for side in ("contratante", "contratada")
        ],
    )


def answers_by_kind(answers: DataFrame) -> DataFrame:
    """One row per process with its three answers side by side."""
    return answers.groupBy(KEY).agg(
        *[
            F.max(F.when(F.col("kind") == kind, F.col("response"))).alias(f"answer_{kind}")
            for kind in ("contract", "publication", "r002")
        ]
    )


def skipped_contracts(pids: DataFrame, contracts: DataFrame) -> DataFrame:
    """Processes whose contract was never preprocessed: nothing to evaluate."""
    return pids.select(KEY).distinct().join(contracts.select(KEY), KEY, "left_anti")


def join_contract_publication(
    contracts: DataFrame, publications: DataFrame,
    contract_extra: list[str] = (), publication_extra: list[str] = (),
) -> DataFrame:
    """Every contract with its publication's fields, if one was found."""
    emb = F.col("embedded_publication")
    left = contracts.select(
        KEY,
        *[F.col("header")[n].alias(f"c_{n}")
          for n in ("contract_number", "signing_date", "contratante", "contratada")],
        *[F.col(n).alias(f"c_{n}") for n in contract_extra],
        F.coalesce(emb["found"], F.lit(False)).alias("_found"),
        *[emb[f"{side}_pub"].alias(f"_emb_{side}") for side in ("contratante", "contratada")],
    )
    right = publications.select(
        KEY,
        F.lit(True).alias("has_publication"),
        F.col("source").alias("publication_source"),
        *[F.col(n).alias(f"p_{n}")
          for n in ("contract_number", "publication_date", "contratante", "contratada",
                    *publication_extra)],
    )
    sides = ("contratante", "contratada")
    keep = [c for c in [*left.columns, *right.columns]
            if not c.startswith("_") and c not in (KEY, "has_publication", *[f"p_{s}" for s in sides])]
    found = F.col("_found") & F.col("has_publication")
    return left.join(right, KEY, "left").select(
        KEY,
        F.coalesce("has_publication", F.lit(False)).alias("has_publication"),
        *keep,
        *[embedded_party(found, F.col(f"_emb_{s}"), F.col(f"p_{s}")).alias(f"p_{s}")
          for s in sides],
    )


def diagnostic_inputs(joined: DataFrame, raw_texts: DataFrame) -> DataFrame:
    """Add the presence of both raw texts, and what is missing.

    Only presence flags cross the join, never the texts.
    """
    names = {"contract_text": "has_raw_contract", "publication_text": "has_raw_publication"}
    flags = raw_texts.select(KEY, *[truthy(F.col(c)).alias(n) for c, n in names.items()])
    joined = joined.join(flags, KEY, "left")
    present = {n: F.coalesce(n, F.lit(False)) for n in names.values()}
    missing = names_where(
        [("raw_contract", ~present["has_raw_contract"]),
         ("raw_publication", ~present["has_raw_publication"])]
    )
    return joined.withColumns(
        {
            **present,
            "diagnostic_skipped": F.size(missing) > 0,
            "diagnostic_warning": F.when(
                F.size(missing) > 0,
                F.concat(F.lit("diagnostic:skipped:missing_raw_files:"),
                         F.array_join(missing, ",")),
            ),
        }
    )


CONTRACT_SIDE = {
    "processo_id": KEY, "contract_number": "c_contract_number",
    "signing_date": "c_signing_date", "contratante": "c_contratante",
    "contratada": "c_contratada",
}
PUBLICATION_SIDE = {
    "processo_id": KEY, "contract_number": "p_contract_number",
    "publication_date": "p_publication_date", "contratante": "p_contratante",
    "contratada": "p_contratada",
}


def add_diagnostics(df: DataFrame) -> DataFrame:
    """Both comparisons and their merge; none without inputs or publication."""
    usable = F.col("has_publication") & ~F.col("diagnostic_skipped")
    df = df.withColumns(
        {
            "_usable": usable,
            "_signed": parse_dmy(F.col("c_signing_date")),
            "_published": parse_dmy(F.col("p_publication_date")),
            **{f"_{kind}": F.when(usable, parse_object(F.col(f"answer_{kind}")))
               for kind in ("contract", "publication")},
        }
    )
    df = df.withColumns(
        {
            "_c_given": answered(F.col("_contract"), K.CONTRACT_FIELD_MAP),
            "_p_given": answered(F.col("_publication"), K.PUBLICATION_FIELD_MAP),
        }
    )
    df = df.withColumns(
        {
            "_c_checks": field_checks(F.col("_c_given"), CONTRACT_SIDE, K.CONTRACT_FIELD_MAP),
            "_p_checks": field_checks(
                F.col("_p_given"), PUBLICATION_SIDE, K.PUBLICATION_FIELD_MAP),
        }
    )
    df = df.withColumns(
        {
            "contract_diag": compared(F.col("_contract"), F.col("_c_checks")),
            "publication_diag": compared(F.col("_publication"), F.col("_p_checks")),
        }
    )
    contract, publication = F.col("contract_diag"), F.col("publication_diag")
    usable = F.col("_usable")
    warnings = F.array_compact(
        F.array(
            F.when(usable, answer_warning(F.col("answer_contract"), contract, "contract")),
            F.when(usable, answer_warning(
                F.col("answer_publication"), publication, "publication")),
            F.when(F.col("has_publication"), F.col("diagnostic_warning")),
        )
    )
    return df.withColumns(
        {
            "diagnostic": merge_diagnostics(contract, publication, ~usable),
            "diagnostic_warnings": warnings,
        }
    )


def parties_present() -> Column:
    names = ["c_contratante", "p_contratante", "c_contratada", "p_contratada"]
    present = F.lit(True)
    for name in names:
        present = present & truthy(F.col(name))
    return present


def compliance_rows(joined: DataFrame, carry: list[str] = ()) -> DataFrame:
    """Diagnostics, R001, R002 and overall status of joined contracts.

    Columns named in ``carry`` pass through to later stages.
    """
    df = add_diagnostics(joined)
    published = F.col("has_publication")
    blocked = F.col("diagnostic.agreement_level") == "DIVERGENT"
    asked = parties_present() & ~blocked
    answer = F.when(asked, F.col("answer_r002"))
    df = df.withColumns(
        {"_parties": parties_present(), "_asked": asked, "_r002": parse_object(answer)})
    nothing = undecided(NO_PUBLICATION, "No publication file found for this processo.")
    divergent = F.col("diagnostic.fields_divergent")
    r001 = timeliness(
        F.col("c_signing_date"), F.col("p_publication_date"), F.col("_signed"),
        F.col("_published"), divergent)
    df = df.withColumns(
        {
            "_said": match_answer(F.col("_r002")),
            "r001": F.when(published, r001).otherwise(nothing),
        }
    )
    r002 = party_match(
        {"contract_contratante": F.col("c_contratante"), "pub_contratante": F.col("p_contratante"),
         "contract_contratada": F.col("c_contratada"), "pub_contratada": F.col("p_contratada")},
        F.when(F.col("_asked"), F.col("answer_r002")), F.col("_r002"), F.col("_said"), divergent)
    df = df.withColumn("r002", F.when(published, r002).otherwise(nothing))
    r001, r002 = F.col("r001"), F.col("r002")
    status = overall_status(
        r001["verdict"], r002["verdict"], F.col("diagnostic.agreement_level"))
    unpublished = F.struct(
        F.lit("INCONCLUSIVE").alias("status"),
        F.lit(True).alias("requires_review"),
        F.lit(NO_PUBLICATION).alias("review_reason"),
    )
    late_date = published & (F.col("publication_source") == K.SOURCE_EMBEDDED) & ~truthy(
        F.col("p_publication_date"))
    warnings = F.concat(
        F.col("diagnostic_warnings"),
        F.array_compact(
            F.array(
                F.when(late_date, "publication_date:from_signing_date_in_pub"),
                F.when(published & ~F.col("_parties"), "r002:skipped:missing_party_fields"),
                F.when(published & blocked, "r002:skipped:diagnostic_divergent"),
                F.when(~published, "no_publication_file"),
            )
        ),
    )
    calls = F.when(~published, 0).otherwise(
        F.when(F.col("diagnostic_skipped"), 0).otherwise(2) + F.col("_asked").cast("int"))
    return df.select(
        KEY,
        F.struct(
            F.lit("contract_preprocessed").alias("contract_file"),
            F.when(published, "publication_structured").alias("publication_file"),
            F.col("publication_source"),
        ).alias("inputs"),
        F.col("diagnostic").alias("extraction_diagnostic"),
        F.struct(
            r001["verdict"].alias("verdict"),
            F.col("c_signing_date").alias("signing_date"),
            F.col("p_publication_date").alias("publication_date"),
            r001["days_delta"].alias("days_delta"),
            F.lit(K.PUBLICATION_DEADLINE_DAYS).alias("limit_days"),
            *[r001[n].alias(n)
              for n in ("explanation", "confidence", "requires_review", "inconclusive_reason")],
        ).alias("r001_timeliness"),
        F.struct(
            r002["verdict"].alias("verdict"),
            F.col("c_contratante").alias("contract_contratante"),
            F.col("p_contratante").alias("publication_contratante"),
            F.col("c_contratada").alias("contract_contratada"),
            F.col("p_contratada").alias("publication_contratada"),
            *[r002[n].alias(n)
              for n in ("explanation", "confidence", "requires_review", "inconclusive_reason")],
        ).alias("r002_party_match"),
        F.when(published, status).otherwise(unpublished).alias("overall"),
        F.struct(
            (~published | F.col("diagnostic_skipped")).alias("diagnostic_skipped"),
            F.lit(False).alias("r001_skipped"),
            (~published | ~F.col("_asked")).alias("r002_skipped"),
            calls.alias("api_calls_made"),
            warnings.alias("warnings"),
        ).alias("metadata"),
        *carry,
    )
