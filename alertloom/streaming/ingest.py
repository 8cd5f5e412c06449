"""Keep only records whose key no earlier run has seen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from alertloom.operators import harvest
from alertloom.session import scratch_path
from alertloom.sources import keys as key_store
from alertloom.sources import snapshots

KEY = "source_url"
SALTS = 8


def read_landed_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    pattern: str,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Parquet files as they land."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def read_lines_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    pattern: str = "*.json",
    files_per_batch: int | None = None,
) -> DataFrame:
    """JSON lines as they land, with the name of their file."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder).withColumn("source_file", F.col("_metadata.file_path"))


def new_records(
    stream: DataFrame,
    key: str = KEY,
    within: tuple[str, str] | None = None,
    salts: int = SALTS,
    salt_on: Column | None = None,
) -> DataFrame:
    """One record of each key, whichever arrives first.

    A streaming dedup has no combine before its shuffle, so copies of one key
    would all reach one task. Copies are first spread over ``salts`` tasks per
    key and cut to one each, and only those meet.

    Without ``within`` the key state grows with the number of keys. With
    ``(time column, delay)`` it is bounded: a copy that comes later than the
    delay after the first counts as new. That is the form for large feeds. Either
    state belongs in RocksDB, which ``build_session`` sets, not in the JVM's heap.
    """
    salt = F.pmod(salt_on if salt_on is not None else F.xxhash64("*"), F.lit(salts))
    salted = stream.withColumn("_salt", salt)
    if within is None:
        cut = salted.dropDuplicates([key, "_salt"]).dropDuplicates([key])
    else:
        column, delay = within
        cut = (
            salted.withWatermark(column, delay)
            .dropDuplicatesWithinWatermark([key, "_salt"])
            .dropDuplicatesWithinWatermark([key])
        )
    return cut.drop("_salt")


def run_to_table(stream: DataFrame, path: str, state: str) -> StreamingQuery:
    """Write everything that has landed as parquet, then stop."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def write_new(
    batch: DataFrame, batch_id: int, root: str, key: str, order: Sequence[Column]
) -> None:
    """One micro-batch: first per key, not seen in earlier batches; rows and keys in one version.

    A batch that was committed before adds nothing; of one that failed nothing can be seen.
    """
    firsts = harvest.first_wins(batch, order, key).select(*batch.columns)
    key_store.commit_new(firsts, root, key, batch=batch_id)


def stream_to_table(
    stream: DataFrame,
    root: str,
    state: str,
    key: str = KEY,
    order: Sequence[Column] = (),
) -> StreamingQuery:
    """New records of everything that has landed, in the part `data` below `root`, beside their keys."""
    chosen = list(order) or [F.col(key)]

    def write(batch: DataFrame, batch_id: int) -> None:
        write_new(batch, batch_id, root, key, chosen)

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def read_streamed(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The rows of the newest version."""
    return snapshots.snapshot(spark, root).read(spark, "data", schema)


def scratch(spark: SparkSession, name: str) -> dict[str, str]:
    """Fresh paths for a run that keeps nothing."""
    return {part: scratch_path(spark, f"{name}-{part}") for part in ("data", "state")}
