"""Effort and cost metrics of an alert, against the manual process."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertloom.fixed import analysis as fixed
from alertloom.functions import text

HOURS = "total_hours"
COST = "financial_impact"


def hours_of_plan(plan: Column) -> Column:
    """Hours of a plan held as an array; no plan counts as a fixed effort."""
    total = F.aggregate(
        F.transform(plan, lambda step: step["estimated_hours"].cast("bigint")),
        F.lit(0).cast("bigint"),
        lambda a, b: a + F.coalesce(b, F.lit(0)),
    )
    return F.when(F.size(plan) > 0, total).otherwise(fixed.HOURS_WITHOUT_PLAN)


def plan_hours(
    scenarios: DataFrame, plan_rows: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Hours per scenario from plan rows; a scenario without rows gets the default."""
    totals = plan_rows.groupBy(*keys).agg(
        F.sum(F.col("estimated_hours").cast("bigint")).alias(HOURS)
    )
    joined = scenarios.join(totals, list(keys), "left")
    return joined.withColumn(
        HOURS, F.coalesce(HOURS, F.lit(fixed.HOURS_WITHOUT_PLAN).cast("bigint"))
    )


def impact_metrics(df: DataFrame) -> DataFrame:
    """Add time and cost saved, efficiency and speed-up. Zero hours give no speed-up."""
    saved = F.lit(fixed.MANUAL_HOURS) - F.col(HOURS)
    return df.withColumns(
        {
            "time_saved": saved,
            "efficiency_gain": saved / F.lit(float(fixed.MANUAL_HOURS)) * 100,
            "cost_saved": F.lit(fixed.MANUAL_COST) + F.col(COST),
            "speed_up": F.try_divide(
                F.lit(float(fixed.MANUAL_HOURS)), F.col(HOURS).cast("double")
            ),
        }
    )


def impact_comparison(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Four rows per scenario: bar values and printed labels, manual and automated."""
    thousands = F.col(COST).cast("double") / 1000
    hours = F.col(HOURS).cast("double")
    manual = [
        F.lit(float(fixed.MANUAL_MONTHS)),
        F.lit(float(fixed.MANUAL_HOURS)),
        F.lit(float(fixed.MANUAL_RISK_PERCENT)),
        thousands,
    ]
    automated = [
        F.lit(fixed.AUTOMATED_TIME_BAR),
        hours,
        F.lit(float(fixed.AUTOMATED_RISK_PERCENT)),
        F.lit(float(fixed.AUTOMATED_COST_THOUSANDS)),
    ]
    printed = [F.lit(float(fixed.AUTOMATED_TIME_LABEL)), *automated[1:]]
    manual_units = (" mo", " hrs", "%", "K")
    automated_units = (" min", " hrs", "%", "K")

    # Labels are columns of their own first: within the rows each would be worked out
    # once for every place it is used.
    labels = {
        f"_{kind}_{position}": F.concat(text.decimals(value, 1), F.lit(units[position]))
        for kind, values, units in (("manual", manual, manual_units), ("automated", printed, automated_units))
        for position, value in enumerate(values)
    }
    labelled = df.withColumns(labels)

    rows = [
        F.struct(
            F.lit(position + 1).alias("position"),
            F.lit(category).alias("category"),
            manual[position].alias("manual_value"),
            automated[position].alias("automated_value"),
            F.col(f"_manual_{position}").alias("manual_label"),
            F.col(f"_automated_{position}").alias("automated_label"),
        )
        for position, category in enumerate(fixed.COMPARISON)
    ]
    return labelled.select(*keep, F.inline(F.array(*rows)))


def stat_tiles(metrics: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Four labelled figures per scenario."""
    values = [
        F.concat(text.decimals(F.col("efficiency_gain"), 0), F.lit("%")),
        F.concat(
            F.lit("$"),
            text.decimals(F.col("cost_saved").cast("double") / 1000, 0),
            F.lit("K"),
        ),
        F.lit(fixed.RISK_MITIGATION),
        F.concat(text.decimals(F.col("speed_up"), 0), F.lit("x Faster")),
    ]
    figures = {f"_figure_{position}": value for position, value in enumerate(values)}
    rows = [
        F.struct(F.lit(name).alias("tile"), F.col(figure).alias("figure"))
        for name, figure in zip(fixed.TILES, figures)
    ]
    return metrics.withColumns(figures).select(*keep, F.inline(F.array(*rows)))


def annual_projection(metrics: DataFrame, keep: Sequence[str]) -> DataFrame:
    """A year of such alerts, in millions."""
    millions = F.col("cost_saved").cast("double") * fixed.ALERTS_PER_YEAR / 1_000_000
    return metrics.select(
        *keep,
        F.lit(fixed.ALERTS_PER_YEAR).alias("alerts_per_year"),
        millions.alias("annual_millions"),
        F.concat(F.lit("$"), text.decimals(millions, 1), F.lit("M+")).alias(
            "annual_label"
        ),
    )
