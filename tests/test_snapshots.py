"""Versions of a folder, and the key store that they hold."""

import pytest
from pyspark.sql import functions as F

from alertloom.sources import keys, snapshots


def rows(spark, first, last, name="x"):
    return spark.range(first, last).select(
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("source_url"), F.lit(name).alias("run")
    )


def test_versions_are_whole_and_pinned(spark, tmp_path):
    root = str(tmp_path / "t")
    empty = snapshots.snapshot(spark, root)
    schema = "source_url string, run string"
    assert empty.number == 0 and empty.read(spark, "data", schema).count() == 0
    one = snapshots.stage(empty, "data", rows(spark, 0, 5).write.parquet)
    assert snapshots.snapshot(spark, root).number == 0  # staged, not seen
    first = snapshots.commit(spark, empty, {"data": [one]}, notes={"by": "a"})
    two = snapshots.stage(first, "data", rows(spark, 5, 9).write.parquet)
    second = snapshots.commit(spark, first, {"data": [two]})
    three = snapshots.stage(second, "data", rows(spark, 0, 2).write.parquet)
    snapshots.commit(spark, second, {}, {"data": [three]})
    assert [snapshots.snapshot(spark, root, n).read(spark, "data", schema).count() for n in (1, 2, 3)] == [5, 9, 2]
    assert snapshots.snapshot(spark, root).notes == {"by": "a"}
    with pytest.raises(snapshots.Conflict):
        snapshots.commit(spark, first, {"data": [two]})
    with pytest.raises(ValueError):
        snapshots.snapshot(spark, root, 9)
    assert snapshots.expire(spark, root) == 2
    assert snapshots.versions(spark, root) == [3]
    assert snapshots.snapshot(spark, root).read(spark, "data", schema).count() == 2


def test_a_failure_between_the_writes_leaves_neither_repeats_nor_losses(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    keys.commit_new(rows(spark, 0, 10), root, "source_url", batch=0)
    for broken in ("add", "commit"):
        target = keys if broken == "add" else snapshots
        with monkeypatch.context() as m:
            m.setattr(target, broken, lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                keys.commit_new(rows(spark, 5, 15), root, "source_url", batch=1)
        now = snapshots.snapshot(spark, root)
        assert now.number == 1 and now.read(spark, "data", "source_url string, run string").count() == 10
    keys.commit_new(rows(spark, 5, 15), root, "source_url", batch=1)
    keys.commit_new(rows(spark, 5, 15), root, "source_url", batch=1)  # a repeated batch
    now = snapshots.snapshot(spark, root)
    held = [r.source_url for r in now.read(spark, "data", "source_url string, run string").collect()]
    assert sorted(held) == sorted(f"k{i}" for i in range(15))
    assert now.number == 2


def exchanges(df):
    """Exchanges of the plan, and the scans below each join's right side."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange")


def test_seen_keys_are_not_moved(spark, tmp_path):
    root = str(tmp_path / "t")
    for i in range(3):
        keys.commit_new(rows(spark, 10 * i, 10 * i + 10), root, "source_url")
    now = snapshots.snapshot(spark, root)
    assert len(now.folders(keys.KEYS)) == 3
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = keys.unseen(rows(spark, 5, 40), now, "source_url")
        assert exchanges(left) == 1  # the new rows alone
        assert "SortMergeJoin" in left._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert left.count() == 10


def test_tiers_keep_generations_few():
    sizes, written = [], 0
    for _ in range(1000):
        sizes.append(1)
        due = keys.tiers(sizes)
        if due:
            written += sum(sizes[i] for i in due)
            sizes = [*sizes[: due[0]], sum(sizes[due[0] :])]
        assert len(sizes) <= 3 * 6
    assert sum(sizes) == 1000 and written <= 1000 * 6


def test_files_stay_bounded_over_many_batches(spark, tmp_path):
    root = str(tmp_path / "t")
    most = 0
    for i in range(20):
        now = keys.commit_new(rows(spark, 3 * i, 3 * i + 5), root, "source_url", batch=i)
        most = max(most, len(now.folders(keys.KEYS)))
    assert most <= 6
    files = [f for g in now.folders(keys.KEYS) for f in spark.read.parquet(g).inputFiles()]
    assert len(files) <= 4 * most  # one a bucket
    held = [r[0] for r in keys.seen(spark, now, rows(spark, 0, 1).schema["source_url"]).collect()]
    assert sorted(held) == sorted(f"k{i}" for i in range(62))
    assert now.read(spark, "data", "source_url string, run string").count() == 62


def test_null_and_empty(spark, tmp_path):
    root = str(tmp_path / "t")
    none = spark.createDataFrame([(None, "a"), ("", "b")], "source_url string, run string")
    keys.commit_new(none, root, "source_url")
    keys.commit_new(none.limit(0), root, "source_url")
    left = keys.unseen(none, snapshots.snapshot(spark, root), "source_url").collect()
    assert [r.run for r in left] == ["a"]
