"""Writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertloom.fixed.codes import EVENT_FIELDS, RECORD_FIELDS
from alertloom.sources import readers


# A file whose values hold line breaks is read by one task, so none is long.
RECORDS_PER_FILE = 100_000


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def append_new(df: DataFrame, path: str, key: str) -> None:
    """Append only rows whose key the table does not hold, so a rerun adds nothing."""
    existing = readers.read_table(df.sparkSession, path)
    if existing is not None:
        df = df.join(existing.select(key), key, "left_anti").select(*df.columns)
    append_table(df, path)


def write_csv(df: DataFrame, path: str, fields: Sequence[str]) -> None:
    """Headered CSV with a fixed field order, in files of bounded length. Null and blank are both written blank."""
    (
        df.select(*fields)
        .write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("emptyValue", "")
        .option("nullValue", "")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .csv(path)
    )


def write_records(df: DataFrame, path: str) -> None:
    write_csv(df, path, RECORD_FIELDS)


def write_events(df: DataFrame, path: str) -> None:
    """Event files as ``readers.read_event_csv`` reads them; line breaks stay in the values."""
    write_csv(df, path, EVENT_FIELDS)


def write_lines(df: DataFrame, path: str) -> None:
    """JSON lines as ``readers.read_landed_lines`` reads them, packed: a tenth of their length.

    A packed file is not split between tasks, so none is long.
    """
    packed = df.write.option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE)
    packed.json(path)


def append_seen(df: DataFrame, path: str, key: str = "source_url") -> None:
    """Add keys to the state. Call it after the data is written.

    A run that fails in between repeats its data rather than losing it; the
    reader of the state drops repeated keys.
    """
    df.select(F.col(key).alias("value")).write.mode("append").text(path)


def write_corpus(docs: DataFrame, path: str) -> None:
    """The corpus as a table of file name, template and text.

    One row per document instead of one file per document: millions of small
    files are slow to list and to read.
    """
    docs.select("file_name", "template", "text").write.mode("overwrite").parquet(path)


def write_corpus_texts(docs: DataFrame, path: str) -> None:
    """One text per document, in folders by template, for readers that want text."""
    (
        docs.filter(F.col("text").isNotNull())
        .select("template", "text")
        .write.mode("overwrite")
        .partitionBy("template")
        .option("lineSep", "\n\f\n")
        .text(path)
    )
