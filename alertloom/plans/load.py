"""Load every feed of a folder into tables. A failing feed fails the run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from alertloom import schemas
from alertloom.fixed.codes import RECORD_DATE_FIELDS, REQUIRED_TABLES
from alertloom.operators import clean, quality, sample
from alertloom.sources import readers, sinks

# Feed file, source label, name of the parsed date column.
NOTICES = {
    "fda_safety_communications": ("fda_safety.csv", "fda_safety", "alert_date"),
    "fda_drug_alerts": ("DrugAlerts_FDA.csv", "DrugAlerts_FDA", "alert_date"),
    "fda_public_statements": ("FDA_Stmts.csv", "FDA_Stmts", "statement_date"),
}
RECALL_FILE = "Recalls.csv"
EVENT_SOURCE = "fda_adverse_events"
DOCUMENT_FOLDER = "clinical_document_corpus"


def ground_truth(
    spark: SparkSession, folder: str, loaded_at: dt.datetime
) -> DataFrame:
    """The newest record file, with parsed dates and an id made of all fields."""
    records = readers.read_records(spark, folder)
    identified = clean.add_row_id(records, records.columns)
    dated = clean.coerce_dates(identified, RECORD_DATE_FIELDS)
    return clean.stamp(dated, loaded_at, column="created_at")


def adverse_events(
    spark: SparkSession,
    folder: str,
    loaded_at: dt.datetime,
    rows: int | None = None,
    null_text: str | None = None,
    seed: int | str = 42,
    multiline: bool = True,
    skip_unknown: bool = False,
) -> DataFrame:
    """All event files; with ``rows``, an exact seeded sample of that many."""
    events = readers.read_event_csv(spark, folder, multiline, skip_unknown)
    if rows is not None:
        events = sample.sample_exact(events, rows, events.columns, seed)
    return clean.stamp(clean.text_columns(events, null_text), loaded_at, EVENT_SOURCE)


def recalls(spark: SparkSession, folder: str, loaded_at: dt.datetime) -> DataFrame:
    df = readers.read_recall_csv(spark, f"{folder}/{RECALL_FILE}")
    return clean.stamp(df, loaded_at)


def notices(
    spark: SparkSession, folder: str, table: str, loaded_at: dt.datetime
) -> DataFrame:
    file, source, date_column = NOTICES[table]
    schema = (
        schemas.SAFETY_NOTICE
        if table == "fda_safety_communications"
        else schemas.NOTICE
    )
    df = readers.read_notices(spark, f"{folder}/{file}", schema)
    return clean.add_date(clean.stamp(df, loaded_at, source), "Date", date_column)


def manifest(
    spark: SparkSession, folder: str, base_uri: str, loaded_at: dt.datetime
) -> DataFrame:
    files = readers.list_documents(spark, f"{folder}/{DOCUMENT_FOLDER}")
    return clean.document_manifest(files, base_uri, loaded_at)


def readiness(spark: SparkSession, target: str) -> DataFrame:
    """Rows of each table the analysis needs; a table not loaded counts zero."""
    tables = {
        name: readers.read_table(spark, f"{target}/{name}") for name in REQUIRED_TABLES
    }
    return quality.table_counts(spark, tables)


def run(
    spark: SparkSession,
    folder: str,
    target: str,
    base_uri: str,
    loaded_at: dt.datetime,
    event_rows: int | None = None,
    event_multiline: bool = True,
) -> dict[str, int | None]:
    """Rows written per table; None marks a feed whose files are absent.

    ``event_multiline=False`` splits event files between tasks, if none has a line break in a value.
    """
    feeds: dict[str, tuple[str, Callable[[], DataFrame]]] = {
        "ground_truth_master": (
            readers.RECORD_FILES,
            lambda: ground_truth(spark, folder, loaded_at),
        ),
        "fda_adverse_events": (
            readers.EVENT_FILES,
            lambda: adverse_events(spark, folder, loaded_at, event_rows, multiline=event_multiline),
        ),
        "fda_recalls": (RECALL_FILE, lambda: recalls(spark, folder, loaded_at)),
    }
    for table, (file, _, _) in NOTICES.items():
        feeds[table] = (
            file,
            lambda table=table: notices(spark, folder, table, loaded_at),
        )
    written: dict[str, int | None] = {}
    for table, (files, read) in feeds.items():
        if not readers.path_exists(spark, f"{folder}/{files}"):
            written[table] = None
            continue
        audited, observation = quality.audited(read(), table)
        sinks.replace_table(audited, f"{target}/{table}")
        written[table] = observation.get["rows"]
    if readers.path_exists(spark, f"{folder}/{DOCUMENT_FOLDER}"):
        audited, observation = quality.audited(
            manifest(spark, folder, base_uri, loaded_at), "manifest"
        )
        sinks.append_new(audited, f"{target}/knowledge_base_master", "document_id")
        written["knowledge_base_master"] = observation.get["rows"]
    else:
        written["knowledge_base_master"] = None
    return written
