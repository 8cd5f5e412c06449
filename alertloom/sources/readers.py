"""Readers. Every schema is declared; an absent path is an empty table."""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertloom import schemas
from alertloom.functions import nested
from alertloom.operators import clean, flatten, harvest

# Names of the files each load looks for.
RECORD_FILES = "clinical_ground_truth*.csv"
EVENT_FILES = "drug-event*.csv"
NAME_STAMP = r"(\d{4}-\d{2}-\d{2}_\d{6})"


def _listed(spark: SparkSession, path: str) -> list:
    """File statuses a path or pattern matches, on whatever file system it names."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return list(system.globStatus(target) or [])


def path_exists(spark: SparkSession, path: str) -> bool:
    return bool(_listed(spark, path))


def newest_path(spark: SparkSession, pattern: str) -> str:
    """The newest match: by the time in its name, then by its change time.

    The choice is made from the listing; older files are not opened.
    """
    def age(status) -> tuple[str, int]:
        stamp = re.search(NAME_STAMP, status.getPath().getName())
        return (stamp.group(1) if stamp else "", status.getModificationTime())

    return max(_listed(spark, pattern), key=age).getPath().toString()


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _files(spark: SparkSession, path: str) -> list[str]:
    """Visible files at a path or pattern; of a folder, those directly in it."""
    found = []
    for status in _listed(spark, path):
        if status.isDirectory():
            found += _files(spark, f"{status.getPath()}/*")
        elif not status.getPath().getName().startswith(("_", ".")):
            found.append(status.getPath().toString())
    return sorted(found)


def _header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Trimmed column names of a CSV file, from its first line; the rest is not read."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(conf).open(target)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(target)
    if codec is not None:
        stream = codec.createInputStream(stream)
    lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        line = lines.readLine()
    finally:
        lines.close()
    names = next(csv.reader([(line or "").removeprefix("\ufeff")]), [])
    return tuple(name.strip() for name in names)


class UnknownLayout(ValueError):
    """CSV files whose header has none of the wanted columns."""


def csv_layouts(
    spark: SparkSession, path: str, schema: T.StructType
) -> tuple[dict[tuple[str, ...], list[str]], list[str]]:
    """Files by header, and the files whose header has no column of the schema.

    One line of each file is read. A file without any line is in neither.
    """
    known, unknown = defaultdict(list), []
    for file in _files(spark, path):
        header = _header(spark, file)
        if set(header) & set(schema.names):
            known[header].append(file)
        elif header:
            unknown.append(file)
    return dict(known), unknown


def _as_read(header: tuple[str, ...], schema: T.StructType) -> T.StructType:
    """The header's columns in its order, typed by the schema; of a repeated name the first."""
    kinds = {f.name: f.dataType for f in schema.fields}
    fields = []
    for position, name in enumerate(header):
        kind = kinds.pop(name, None)
        fields.append(T.StructField(name if kind else f"_c{position}", kind or T.StringType()))
    return T.StructType(fields)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    multiline: bool = False,
    skip_unknown: bool = False,
) -> DataFrame:
    """Headered CSV files at a path or pattern, stacked; a quote inside is doubled.

    Columns are taken by the names in each file's header, whatever their order: a
    column that a file lacks is null, one that the schema lacks is left out. Files with
    no known column raise ``UnknownLayout``; with ``skip_unknown`` they are left out, and
    ``csv_layouts`` lists them. There is one scan per layout, not per file.

    With ``multiline`` a quoted value may hold line breaks, and each file is then
    one task; leave it off for large files without such values.
    """
    layouts, unknown = csv_layouts(spark, path, schema)
    if unknown and not skip_unknown:
        raise UnknownLayout(f"no known column in {unknown}")
    frames = []
    for header, files in layouts.items():
        frame = (
            spark.read.schema(_as_read(header, schema))
            .option("header", True)
            .option("quote", '"')
            .option("escape", '"')
            .option("encoding", "UTF-8")
            .option("multiLine", multiline)
            .csv(files)
        )
        columns = [
            clean.quoted(f.name) if f.name in header else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
        frames.append(frame.select(*columns))
    return reduce(DataFrame.unionByName, frames) if frames else empty(spark, schema)


def read_csv_by_name(
    spark: SparkSession,
    paths: Sequence[str],
    schemas_by_path: Sequence[T.StructType],
) -> DataFrame:
    """Stack CSV files whose schemas differ: by name, null where one lacks a column."""
    frames = [
        read_csv(spark, path, schema)
        for path, schema in zip(paths, schemas_by_path, strict=True)
    ]
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """Canonical records of the newest file. Blank reads as null."""
    newest = newest_path(spark, f"{folder}/{RECORD_FILES}")
    return read_csv(spark, newest, schemas.RECORD, multiline=True)


def read_records_text(spark: SparkSession, folder: str) -> DataFrame:
    """All canonical records as text, blanks kept as blanks."""
    files = f"{folder}/*.csv"
    if not path_exists(spark, files):
        return empty(spark, schemas.RECORD_TEXT)
    return read_csv(spark, files, schemas.RECORD_TEXT, multiline=True).na.fill("")


def read_event_csv(
    spark: SparkSession, folder: str, multiline: bool = True, skip_unknown: bool = False
) -> DataFrame:
    """Flat adverse-event files, all stacked; quoted values may hold line breaks.

    Each file is then one task. ``multiline=False`` splits files between tasks; it is only
    for files known to have one line a record, as it takes a broken one for two.
    """
    path = f"{folder}/{EVENT_FILES}"
    return read_csv(spark, path, schemas.EVENT_FLAT, multiline, skip_unknown)


def read_recall_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.RECALL_FLAT, multiline=True)


def read_notices(
    spark: SparkSession, path: str, schema: T.StructType = schemas.NOTICE
) -> DataFrame:
    """Notice files: trimmed headers, blank-header columns dropped.

    The header is not checked against the schema, as blank headers have no name.
    """
    df = spark.read.schema(schema).option("header", True).option("escape", '"')
    df = df.option("enforceSchema", True).option("multiLine", True).csv(path)
    return clean.drop_blank_columns(clean.trim_column_names(df))


def read_landed(
    spark: SparkSession,
    path: str,
    record: T.StructType,
    member: str = "results",
) -> DataFrame:
    """Records of landed responses, one row each, with ``source_file`` and ``source_pos``.

    A response is one JSON document and so one task; land large exports as JSON
    lines and read them with ``read_landed_lines``.
    """
    landed = (
        spark.read.schema(schemas.envelope(member, record))
        .option("multiLine", True)
        .json(path)
        .select(F.col("_metadata.file_path").alias("source_file"), member)
    )
    return flatten.explode_reports(landed, member)


def read_landed_lines(spark: SparkSession, path: str, record: T.StructType) -> DataFrame:
    """Records landed one per line, with the same two columns; files are split between tasks.

    ``source_pos`` rises with the lines of a file: the start of the file's split, plus the
    row's number in its task. A later split starts further on than an earlier one has rows.
    The order is the same however the files are split; the numbers are not.
    """
    in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    lines = spark.read.schema(record).json(path)
    return lines.select(
        F.col("_metadata.file_path").alias("source_file"),
        (F.col("_metadata.file_block_start") + in_task).alias("source_pos"),
        *[clean.quoted(name) for name in record.names],
    )


def trial_lists(trials: DataFrame) -> DataFrame:
    """Trials read as ``schemas.LANDED_TRIAL``: lists that may have landed as plain text."""
    section = F.col("protocolSection")
    for module, field in (("conditionsModule", "conditions"), ("designModule", "phases")):
        section = section.withField(
            f"{module}.{field}", nested.list_or_scalar(F.col(f"protocolSection.{module}.{field}"))
        )
    return trials.withColumn("protocolSection", section)


def read_label_listings(spark: SparkSession, path: str) -> DataFrame:
    """Landed label listings, in folders ``drug=<search term>``, as ``schemas.DRUG_LABEL``.

    A listing names no drug: what was searched for is in its folder's name.
    """
    landed = read_landed(spark, path, schemas.record(setid=schemas.TEXT), "data")
    term = F.regexp_extract("source_file", r"/drug=([^/]+)/", 1)
    plain = F.url_decode(F.replace(term, F.lit("+"), F.lit("%2B")))
    return landed.withColumn("drug_name", F.nullif(plain, F.lit("")))


def list_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Files below a folder as rows. Contents are not read.

    Hidden and temporary files are left out later, where the manifest is made.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    )
    relative = F.regexp_extract(
        F.col("path"), r"^.*?" + _folder_pattern(folder) + r"/(.*)$", 1
    )
    return files.select(
        "path", relative.alias("relative_path"), "modificationTime", "length"
    )


def _folder_pattern(folder: str) -> str:
    """The folder's own path, without a scheme, as a literal pattern."""
    bare = folder.split("://", 1)[-1].rstrip("/")
    return r"\Q" + bare + r"\E"


def read_texts(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    """Whole text files with their names."""
    return (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .text(folder, wholetext=True)
        .select(
            F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("text")
        )
    )


def read_seen(spark: SparkSession, path: str, key: str = "source_url") -> DataFrame:
    """The key set of a state of one key per line; no state yet is an empty set."""
    if not path_exists(spark, path):
        return empty(spark, T.StructType([T.StructField(key, T.StringType())]))
    return harvest.clean_keys(spark.read.text(path), key=key)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """A parquet table, or None if it does not exist."""
    return spark.read.parquet(path) if path_exists(spark, path) else None
