import datetime as dt
import hashlib

from pyspark.sql import functions as F

from alertloom.operators import sample


def ranked(ids, seed):
    return sorted(ids, key=lambda i: hashlib.md5(f"{seed}|{i}".encode()).hexdigest())


def test_exact_size_and_order(spark):
    df = spark.range(2500)
    got = [r.id for r in sample.sample_exact(df, 1000, ["id"], 42).collect()]
    assert sorted(got) == sorted(ranked(range(2500), 42)[:1000])
    assert sample.sample_exact(spark.range(900), 1000, ["id"]).count() == 900


def test_all_ways_give_the_same_rows(spark):
    df = spark.range(5000).repartition(9)
    for n in (5, 700, 1500):
        got = [r.id for r in sample.sample_exact(df, n, ["id"], 3).collect()]
        assert sorted(got) == sorted(ranked(range(5000), 3)[:n])


def test_the_bucket_of_the_cut_is_counted_again(spark, monkeypatch):
    monkeypatch.setattr(sample, "HEX_DIGITS", 1)
    monkeypatch.setattr(sample, "CUT_ROWS", 2)
    df = spark.range(3000)
    for n in (0, 1, 777, 2999):
        got = [r.id for r in sample.sample_exact(df, n, ["id"], 7).collect()]
        assert sorted(got) == sorted(ranked(range(3000), 7)[:n])
    assert sample.sample_exact(df, 5000, ["id"], 7).count() == 3000
    assert sample.sample_exact(df.filter("id < 0"), 5, ["id"], 7).count() == 0


def test_copies_and_nulls_are_counted_one_by_one(spark, monkeypatch):
    monkeypatch.setattr(sample, "CUT_ROWS", 2)
    rows = [(None, "a")] * 40 + [(1, None)] * 40 + [(i, "b") for i in range(20)]
    df = spark.createDataFrame(rows, "k INT, v STRING")
    for n in (10, 45, 90):
        assert sample.sample_exact(df, n, ["k"]).count() == n


def test_latest_puts_missing_dates_last(spark):
    day = dt.date(2024, 5, 1)
    df = spark.createDataFrame([(1, None), (3, day), (2, day)], "id INT, d DATE")
    assert sample.latest(df, F.col("d"), [F.col("id")]).first().id == 2
