"""Keys that earlier runs have seen, in bucketed tables that an anti-join reads without a shuffle.

Each run adds one generation, a folder with a file for each bucket, bucketed and sorted by the
key's hash. New rows are dealt once by key into as many partitions as there are buckets, and
then meet every generation where it lies: the keys, which may be many times the new rows, are
neither moved nor sorted. Generations are merged as they come to be like in size, so their
number, and that of the files, stays bounded by the logarithm of the runs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertloom.sources import snapshots
from alertloom.sources.snapshots import Snapshot

KEYS = "keys"
FANOUT = 4  # generations of one tier before they are merged into one of the next


def _table(spark: SparkSession, folder: str, key: T.StructField, buckets: int) -> DataFrame:
    """A generation as a bucketed table; it is named in this session only and owns no files."""
    name = f"keys_{uuid.uuid5(uuid.NAMESPACE_URL, folder).hex}"
    kind = key.dataType.simpleString()
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (`{key.name}` {kind}) USING parquet "
        f"CLUSTERED BY (`{key.name}`) SORTED BY (`{key.name}`) INTO {buckets} BUCKETS LOCATION '{folder}'"
    )
    return spark.table(name)


def _write(keys: DataFrame, folder: str, buckets: int) -> None:
    """One file a bucket: the rows are dealt as the table's buckets are."""
    column = keys.columns[0]
    name = f"keys_{uuid.uuid4().hex}"
    (
        keys.repartition(buckets, column)
        .write.option("path", folder)
        .bucketBy(buckets, column)
        .sortBy(column)
        .saveAsTable(name)
    )
    keys.sparkSession.sql(f"DROP TABLE {name}")  # the files stay, as the path is given


def _buckets(spark: SparkSession, snapshot: Snapshot) -> int:
    """As the store was begun with: as many as the session's shuffles have partitions."""
    return int(snapshot.notes.get("buckets") or spark.conf.get("spark.sql.shuffle.partitions"))


def unseen(rows: DataFrame, snapshot: Snapshot, key: str) -> DataFrame:
    """The rows whose key is in no generation of the snapshot; rows without a key are new each time."""
    spark, buckets = rows.sparkSession, _buckets(rows.sparkSession, snapshot)
    folders = snapshot.folders(KEYS)
    if not folders:
        return rows
    left = rows.repartition(buckets, key)
    for folder in folders:
        held = _table(spark, folder, rows.schema[key], buckets)
        left = left.join(held.hint("merge"), key, "left_anti")
    return left.select(*rows.columns)


def seen(spark: SparkSession, snapshot: Snapshot, key: T.StructField) -> DataFrame:
    """All keys of the snapshot."""
    return snapshot.read(spark, KEYS, T.StructType([key]))


def tiers(sizes: list[int], fanout: int = FANOUT) -> list[int]:
    """Places of the generations to merge: the newest ones, if `fanout` of them make up one tier.

    A generation's tier is the power of `fanout` of its batches, so each key is written again as
    often as tiers are passed, not with each run.
    """
    merged: list[int] = []
    counts = list(sizes)
    while True:
        last = counts[-1] if counts else 0
        same = [i for i in range(len(counts)) if counts[i] == last]
        run = same[-fanout:]
        if not last or len(run) < fanout or run[-1] - run[0] != fanout - 1:
            break
        first = run[0]
        merged = list(range(first, len(sizes)))
        counts = [*counts[:first], last * fanout]
    return merged


def add(rows: DataFrame, snapshot: Snapshot, key: str) -> tuple[dict[str, list[str]], dict[str, object]]:
    """Stage the rows' keys as a generation, merged with those due; for `snapshots.commit`.

    Gives what replaces the part, and the notes. Null keys are not kept. `rows` should be
    written data, as it is read once here.
    """
    spark, buckets = rows.sparkSession, _buckets(rows.sparkSession, snapshot)
    field = rows.schema[key]
    sizes = [int(n) for n in snapshot.notes.get("batches", [])] + [1]
    names = snapshot.parts.get(KEYS, [])
    due = tiers(sizes)
    new = rows.select(key).where(F.col(key).isNotNull()).distinct()
    if not due:
        due = [len(sizes) - 1]
    older = [snapshot.folders(KEYS)[i] for i in due if i < len(names)]
    if older:
        new = new.unionAll(spark.read.schema(T.StructType([field])).parquet(*older))
    name = snapshots.stage(snapshot, KEYS, lambda path: _write(new, path, buckets))
    kept = [i for i in range(len(names)) if i not in due]
    batches = [*[sizes[i] for i in kept], sum(sizes[i] for i in due)]
    return {KEYS: [*[names[i] for i in kept], name]}, {"batches": batches, "buckets": buckets}


def commit_new(
    rows: DataFrame, root: str, key: str, data: str = "data", batch: int | None = None
) -> Snapshot:
    """Append the rows with unseen keys and add these keys, both or neither.

    Rows must have one row a key. With `batch`, a number that grows, a batch that is already in
    the newest version is left out, so that a repeated call adds nothing.
    """
    spark = rows.sparkSession
    base = snapshots.snapshot(spark, root)
    if batch is not None and int(base.notes.get("batch", -1)) >= batch:
        return base
    fresh = unseen(rows, base, key)
    name = snapshots.stage(base, data, fresh.write.parquet)
    written = spark.read.schema(rows.schema).parquet(f"{root}/{snapshots.PARTS}/{data}/{name}")
    replaced, notes = add(written, base, key)
    if batch is not None:
        notes["batch"] = batch
    return snapshots.commit(spark, base, {data: [name]}, replaced, notes)
