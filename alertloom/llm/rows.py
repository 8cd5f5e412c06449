"""Which row is meant, where doc_id may be null or repeated, and lines taken out of texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A document is named by its doc_id (null counts as a value) and a hash of its text. Rows
# alike in both are one document: they share its decisions.
NAME = ["__id", "__null", "__hash"]


def named(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns, and the name of the row's document in columns that join without nulls."""
    of = F.col(f"`{key}`").cast("long")
    return docs.withColumns(
        {
            "__id": F.coalesce(of, F.lit(0)),
            "__null": of.isNull(),
            "__hash": F.xxhash64(F.col(f"`{text}`").cast("string")),
        }
    )


def name_key(key: str = "doc_id") -> Column:
    return F.when(~F.col("__null"), F.col("__id")).alias(key)


def without_lines(text: Column, gone: Column) -> Column:
    """The text without the lines numbered in `gone` (from 0, null: none); linear in both."""
    rest = lambda lines: F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    bound = F.transform(
        F.array(F.split(text, "\n", -1)),
        lambda lines: F.array_join(F.transform(rest(lines), lambda i: F.get(lines, i)), "\n"),
    )
    return F.when(gone.isNull(), text).otherwise(F.get(bound, F.lit(0)))
