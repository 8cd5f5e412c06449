"""Row counts, readiness, and row audits that ride along with a write."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def table_counts(
    spark: SparkSession, tables: Mapping[str, DataFrame | None]
) -> DataFrame:
    """Rows per table in one plan and one shuffle; an absent table counts zero rows.

    Scans read no column. Every name gives one row of weight zero, so that empty
    and absent tables are listed too.
    """
    names = F.array(*[F.lit(name) for name in tables])
    weighted = [
        spark.range(1).select(F.explode(names).alias("table_name"), F.lit(0).alias("n"))
    ]
    weighted += [
        table.select(F.lit(name).alias("table_name"), F.lit(1).alias("n"))
        for name, table in tables.items()
        if table is not None
    ]
    rows = reduce(DataFrame.union, weighted)
    return rows.groupBy("table_name").agg(F.sum("n").alias("row_count"))


def readiness_summary(counts: DataFrame) -> DataFrame:
    filled = F.col("row_count") > 0
    return counts.agg(
        F.count_if(filled).alias("ready_tables"),
        F.count(F.lit(1)).alias("required_tables"),
        F.sum("row_count").alias("total_rows"),
        F.bool_and(filled).alias("all_ready"),
    )


def audited(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while another action runs, without a second pass."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation
