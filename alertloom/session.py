"""Session settings and the shared folder for cut lineage and scratch tables."""

from __future__ import annotations

import gc
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
# Whether Spark deletes the shuffle files of an execution as soon as it ends.
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Paths of settled tables by application, for their removal.
SETTLED: dict[str, list[str]] = {}
_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
# Tables that are settled within a call of settle_alone.
_WITHIN: ContextVar[list[DataFrame] | None] = ContextVar("within", default=None)

# Query settings that hold at any size. Partition counts, memory and executors
# belong to the cluster and are left to it. The JVM never compiles methods above
# 8,000 bytes; wide projections over that limit run several times faster when
# Spark generates them operator by operator.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(
    name: str = "alertloom", master: str | None = None, **settings: str
) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder named by the session.

    A local session without one gets a temporary folder. On a cluster a folder
    on one machine is of no use to the others, so a missing setting is an error.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    context = spark.sparkContext
    if folder is None:
        folder = context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="alertloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, never used before."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch table, once nothing reads it any more; nothing outside the shared folder."""
    if not path.startswith(f"{shared_folder(spark)}/"):
        raise ValueError(f"{path} is not a scratch table")
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def discard_settled(spark: SparkSession) -> int:
    """Delete all tables this application has settled, at the end of a job; how many there were."""
    paths = SETTLED.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        discard(spark, path)
    return len(paths)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What begins inside deletes its shuffle files when it ends.

    For executions whose result is written out: nothing reads those files again, while Spark by
    itself keeps them until the driver's memory is collected. A frame that is computed once more
    is computed from its beginning.
    """
    before = spark.conf.get(CLEANUP_KEY, None)
    spark.conf.set(CLEANUP_KEY, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_KEY)
        else:
            spark.conf.set(CLEANUP_KEY, before)


def settle(df: DataFrame, name: str = "settled") -> DataFrame:
    """Compute once, as a table in the shared folder, and read it back.

    The lineage ends there, the storage outlives executors, and the size of the
    table is known, so later joins can be planned by it. The table stays until ``unsettle`` or
    ``discard_settled``, as frames that read it may live on; the shuffle files behind it go.
    """
    path = scratch_path(df.sparkSession, name)
    SETTLED.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _PATHS[table] = path
    if (within := _WITHIN.get()) is not None:
        within.append(table)
    return table


def unsettle(*tables: DataFrame) -> None:
    """Delete tables that `settle` gave, and that neither a caller nor a frame will read again."""
    for table in tables:
        path = _PATHS.pop(table)
        discard(table.sparkSession, path)
        SETTLED[table.sparkSession.sparkContext.applicationId].remove(path)


def settle_alone(make: Callable[[], DataFrame], name: str = "settled") -> DataFrame:
    """What `make` returns, settled; the tables that were settled on the way are deleted."""
    outer = _WITHIN.set(within := [])
    try:
        table = settle(make(), name)
    finally:
        _WITHIN.reset(outer)
    unsettle(*[t for t in within if t is not table and t in _PATHS])
    if (around := _WITHIN.get()) is not None:
        around.append(table)
    return table


def release(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files that nothing refers to any more.

    It does so by itself when the driver's memory is collected, which may be long after a
    table was settled and the files behind it became useless.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
