import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from alertloom import session
from alertloom.operators import harvest
from alertloom.sources import readers
from alertloom.streaming import ingest

SCHEMA = "source_url STRING, pos INT, at TIMESTAMP"


def land(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def row(key, pos, minute=0):
    return (key, pos, dt.datetime(2025, 1, 1, 0, minute))


def stream(spark, folder):
    schema = spark.createDataFrame([], SCHEMA).schema
    return ingest.read_landed_stream(spark, folder, schema, "*.parquet")


def test_keys_stay_known_across_runs(spark, tmp_path):
    landed, out, state = (str(tmp_path / n) for n in ("landed", "out", "state"))
    hot = [row("hot", i) for i in range(200)]
    land(spark, landed, hot + [row("a", 1)])
    ingest.run_to_table(ingest.new_records(stream(spark, landed)), out, state)
    land(spark, landed, [row("hot", 999), row("b", 2)])
    ingest.run_to_table(ingest.new_records(stream(spark, landed)), out, state)
    keys = sorted(r.source_url for r in spark.read.parquet(out).collect())
    assert keys == ["a", "b", "hot"]
    batch = harvest.first_wins(spark.read.parquet(landed), [F.col("pos")])
    assert sorted(r.source_url for r in batch.collect()) == keys


def test_bounded_state(spark, tmp_path):
    landed, out, state = (str(tmp_path / n) for n in ("landed", "out", "state"))
    land(spark, landed, [row("a", 1), row("a", 2, 1), row("b", 3, 2)])
    fresh = ingest.new_records(stream(spark, landed), within=("at", "1 hour"))
    ingest.run_to_table(fresh, out, state)
    assert sorted(r.source_url for r in spark.read.parquet(out).collect()) == ["a", "b"]


def streamed(spark, root):
    schema = spark.createDataFrame([], SCHEMA).schema
    return sorted((r.source_url, r.pos) for r in ingest.read_streamed(spark, root, schema).collect())


def test_table_keeps_the_first_record_of_each_key(spark, tmp_path):
    landed, root, state = (str(tmp_path / n) for n in ("landed", "root", "state"))
    for rows in ([row("a", 2), row("a", 1), row("b", 5)], [row("a", 0), row("c", 7)]):
        land(spark, landed, rows)
        ingest.stream_to_table(stream(spark, landed), root, state, order=[F.col("pos")])
    assert streamed(spark, root) == [("a", 1), ("b", 5), ("c", 7)]


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "root")
    first = spark.createDataFrame([row("a", 1), row("b", 2)], SCHEMA)
    second = spark.createDataFrame([row("b", 3), row("c", 4)], SCHEMA)
    for number, batch in ((0, first), (1, second), (1, second)):
        ingest.write_new(batch, number, root, "source_url", [F.col("pos")])
    assert streamed(spark, root) == [("a", 1), ("b", 2), ("c", 4)]


def test_json_lines_as_a_stream(spark, tmp_path):
    landed, out, state = (str(tmp_path / n) for n in ("landed", "out", "state"))
    for key in "ab":
        rows = spark.createDataFrame([(key, 1), (key, 2)], "source_url STRING, pos INT")
        rows.write.mode("append").json(landed)
    schema = rows.schema
    lines = ingest.read_lines_stream(spark, landed, schema, files_per_batch=1)
    ingest.run_to_table(ingest.new_records(lines, salt_on=F.xxhash64("pos")), out, state)
    got = spark.read.parquet(out).collect()
    assert sorted(r.source_url for r in got) == ["a", "b"]
    assert all(r.source_file.endswith(".json") for r in got)


def test_settling_leaves_no_shuffle_files_behind(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = lambda: {f"{disk.getAllFiles().apply(i).getName()}" for i in range(disk.getAllFiles().size())}
    shuffles = lambda: {n for n in names() if n.startswith("shuffle_")}
    before, setting = shuffles(), spark.conf.get(session.CLEANUP_KEY, None)
    rows = spark.range(1000).withColumn("key", F.col("id") % 7)
    grouped = rows.groupBy("key").agg(F.count("*").alias("n"))
    settled = [session.settle(rows.repartition(5, "id").join(grouped, "key"), "cleaned") for _ in range(2)]
    until = time.monotonic() + 20
    while shuffles() - before and time.monotonic() < until:
        time.sleep(0.1)
    assert not shuffles() - before
    assert spark.conf.get(session.CLEANUP_KEY, None) == setting
    assert [(df.count(), df.agg(F.sum("n")).first()[0]) for df in settled] == [(1000, 142858)] * 2
    assert grouped.count() == 7  # what was settled can be computed once more


def test_settled_tables_can_be_discarded(spark):
    first = session.settle(spark.range(5), "kept")
    path = first.inputFiles()[0].rsplit("/", 1)[0]
    assert readers.path_exists(spark, path)
    assert session.discard_settled(spark) >= 1
    assert not readers.path_exists(spark, path)
    with pytest.raises(ValueError):
        session.discard(spark, "/elsewhere/table")
