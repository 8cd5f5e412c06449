"""Scenarios: what a record is about and which ones need action."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertloom.fixed import analysis as fixed
from alertloom.functions import text
from alertloom.operators import sample

SCENARIO_FIELDS = (
    "clinical_entity",
    "drug_name",
    "device_name",
    "condition",
    "risk_level",
    "old_warning",
    "new_warning",
    "clinical_significance",
    "patient_safety_impact",
    "manufacturer",
    "compliance_deadline",
)
CRITICAL = "Critical"


def entity() -> Column:
    """First of drug, device, condition that is not null."""
    return F.coalesce("drug_name", "device_name", "condition")


def entity_type() -> Column:
    """Kind of the first filled name; a blank name does not count here."""
    return (
        F.when(text.is_filled(F.col("drug_name")), "Drug")
        .when(text.is_filled(F.col("device_name")), "Device")
        .otherwise("Condition")
    )


def with_entity(records: DataFrame) -> DataFrame:
    return records.withColumns(
        {"clinical_entity": entity(), "entity_type": entity_type()}
    )


def critical(
    records: DataFrame, keep: Sequence[str] = (), named_only: bool = True
) -> DataFrame:
    """Critical records as scenarios, by default only those with an entity."""
    wanted = records.filter(F.col("risk_level") == CRITICAL)
    if named_only:
        wanted = wanted.filter(
            F.col("drug_name").isNotNull()
            | F.col("device_name").isNotNull()
            | F.col("condition").isNotNull()
        )
    return wanted.withColumn("clinical_entity", entity()).select(
        *keep, *SCENARIO_FIELDS
    )


def demo_scenario(like: DataFrame) -> DataFrame:
    """The fixed fallback scenario, in the columns and types of ``like``."""
    values = [
        F.lit(fixed.DEMO_SCENARIO.get(f.name)).cast(f.dataType).alias(f.name)
        for f in like.schema.fields
    ]
    return like.sparkSession.range(1).select(*values)


def select_scenario(
    scenarios: DataFrame, keys: Sequence[str], seed: int | str
) -> DataFrame:
    """One seeded scenario, or the fallback when there is none."""
    chosen = sample.pick_one(scenarios, keys, seed)
    found = scenarios.select(F.lit(1)).limit(1).agg(F.count(F.lit(1))).scalar()
    return chosen.unionByName(demo_scenario(scenarios).filter(found == 0))


def previews(scenarios: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The short lines a reader is shown first."""
    guidance = text.is_filled(F.col("old_warning")) & text.is_filled(
        F.col("new_warning")
    )

    def cut(name: str, length: int, shown: Column) -> Column:
        return F.when(shown, F.concat(text.head(F.col(name), length), F.lit("...")))

    return scenarios.select(
        *keep,
        cut("old_warning", 60, guidance).alias("old_preview"),
        cut("new_warning", 60, guidance).alias("new_preview"),
        cut(
            "clinical_significance", 80, text.is_filled(F.col("clinical_significance"))
        ).alias("significance_preview"),
    )
