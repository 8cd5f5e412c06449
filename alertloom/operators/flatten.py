"""Nested adverse-event reports to flat rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertloom.fixed.codes import EVENT_FIELDS
from alertloom.functions import codes, nested


def explode_reports(df: DataFrame, member: str = "results") -> DataFrame:
    """One row per element of a response's record array, with its position."""
    other = [c for c in df.columns if c != member]
    exploded = df.select(*other, F.posexplode(member).alias("source_pos", "_record"))
    return exploded.select(*other, "source_pos", "_record.*")


def flatten_adverse_events(reports: DataFrame) -> DataFrame:
    """The 18 flat fields of each report. The first drug is the primary one.

    A report without drugs has null in every drug field. A report without
    reactions has blank reaction texts. Codes become labels.
    """
    drug = nested.first(F.col("patient.drug"))
    reactions = F.col("patient.reaction")
    values = {
        "reporttype": codes.label(F.col("reporttype"), "reporttype"),
        "fulfillexpeditecriteria": codes.yes_no(F.col("fulfillexpeditecriteria")),
        "reporter_qualification": codes.label(
            F.col("primarysource.qualification"), "qualification"
        ),
        "patientonsetage": F.col("patient.patientonsetage"),
        "patientsex": codes.sex(F.col("patient.patientsex")),
        "medicinalproduct": drug["medicinalproduct"],
        "brand_name": nested.first(drug["openfda"]["brand_name"]),
        "manufacturer_name": nested.first(drug["openfda"]["manufacturer_name"]),
        "drugcharacterization": F.when(
            drug.isNotNull(),
            codes.label(drug["drugcharacterization"], "drugcharacterization"),
        ),
        "action_taken_with_drug": F.when(
            drug.isNotNull(), codes.label(drug["actiondrug"], "actiondrug")
        ),
        "drugindication": drug["drugindication"],
        "drugdosagetext": drug["drugdosagetext"],
        "reactions": nested.joined(reactions["reactionmeddrapt"]),
        "reaction_outcomes": nested.joined(
            F.transform(
                reactions["reactionoutcome"], lambda code: codes.label(code, "outcome")
            )
        ),
    }
    return reports.select(
        *[values.get(name, F.col(name)).alias(name) for name in EVENT_FIELDS]
    )
