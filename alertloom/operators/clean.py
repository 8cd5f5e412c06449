"""Cleaning steps shared by all loads."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertloom.fixed import codes
from alertloom.functions import dates, seeded, text


def quoted(name: str) -> Column:
    """A column by its literal name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def trim_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def drop_blank_columns(df: DataFrame) -> DataFrame:
    """Drop the columns a reader made up for blank headers."""
    kept = [c for c in df.columns if c.strip() and not c.strip().startswith("_")]
    return df.select(*[quoted(c) for c in kept])


def plain_column_names(df: DataFrame) -> DataFrame:
    """Lower case with underscores, for names that hold spaces."""
    return df.toDF(*["_".join(c.lower().split()) for c in df.columns])


def coerce_dates(
    df: DataFrame, columns: Sequence[str], pattern: str = dates.ISO_FORMAT
) -> DataFrame:
    """Parse the listed columns that exist; what does not parse becomes null."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: dates.coerce_date(quoted(c), pattern) for c in present})


def add_date(
    df: DataFrame, source: str, target: str, pattern: str = dates.US_FORMAT
) -> DataFrame:
    """Add a parsed date next to its text, if the text column exists."""
    if source not in df.columns:
        return df
    return df.withColumn(target, dates.coerce_date(quoted(source), pattern))


def stamp(
    df: DataFrame,
    loaded_at: dt.datetime,
    source_file: str | None = None,
    column: str = "processed_at",
) -> DataFrame:
    """Add load time and source name."""
    added = {column: F.lit(loaded_at).cast("timestamp")}
    if source_file is not None:
        added["source_file"] = F.lit(source_file)
    return df.withColumns(added)


def add_row_id(df: DataFrame, keys: Sequence[str], column: str = "id") -> DataFrame:
    """Add an id made of the key columns, unless the table has one already."""
    if column in df.columns:
        return df
    return df.withColumn(column, seeded.digest(*[quoted(k) for k in keys]))


def text_columns(df: DataFrame, null_text: str | None = None) -> DataFrame:
    """Make non-numeric columns text. Null stays null unless a text is given."""
    chosen = []
    for field in df.schema.fields:
        column = quoted(field.name)
        if not isinstance(field.dataType, (T.NumericType, T.BooleanType)):
            column = column.cast("string")
            if null_text is not None:
                column = F.coalesce(column, F.lit(null_text))
        chosen.append(column.alias(field.name))
    return df.select(*chosen)


def lookup_table(
    df: DataFrame,
    code: str,
    mapping: DataFrame,
    key: str,
    value: str,
    output: str,
    default: str = codes.UNKNOWN,
) -> DataFrame:
    """Label codes from a mapping table; what it lacks gets the default.

    A key listed twice has its greatest value, so no row is repeated.
    """
    pairs = mapping.groupBy(quoted(key).alias("_code")).agg(
        F.max(quoted(value)).alias("_label")
    )
    joined = df.join(pairs, quoted(code) == F.col("_code"), "left")
    labelled = joined.withColumn(output, F.coalesce("_label", F.lit(default)))
    return labelled.drop("_code", "_label")


def document_manifest(
    files: DataFrame,
    base_uri: str,
    loaded_at: dt.datetime,
    path: str = "relative_path",
    size: str = "length",
    name: str | None = None,
) -> DataFrame:
    """One manifest row per listed file; hidden and ``.tmp`` files are left out.

    ``path`` is relative to the listed folder and is kept in the URI. The format
    is the extension in capitals; a leading dot alone is not an extension.
    """
    relative = F.col(path)
    file_name = F.col(name) if name else F.regexp_extract(relative, r"([^/]*)$", 1)
    with_extension = r"^.+\.([^.]*)$"
    source_format = F.when(
        F.rlike(file_name, F.lit(with_extension)),
        F.upper(F.regexp_extract(file_name, with_extension, 1)),
    ).otherwise(codes.MANIFEST_NO_FORMAT)
    uri = F.concat(
        F.lit(f"{base_uri.rstrip('/')}/{codes.MANIFEST_PREFIX}/"), relative
    )
    return (
        files.filter(~file_name.startswith(".") & ~file_name.endswith(".tmp"))
        .select(
            seeded.digest(uri).alias("document_id"),
            file_name.alias("document_name"),
            uri.alias("document_uri"),
            text.keyword_class(
                file_name, codes.DOCUMENT_RULES, codes.DOCUMENT_DEFAULT
            ).alias("document_type"),
            source_format.alias("source_format"),
            F.lit(loaded_at).cast("timestamp").alias("upload_timestamp"),
            F.lit(codes.MANIFEST_STATUS).alias("processing_status"),
            F.col(size).cast("bigint").alias("file_size_bytes"),
        )
    )
