import datetime as dt

from pyspark.sql import functions as F

from alertloom.operators import clean

NOW = dt.datetime(2025, 9, 14, 8, 30)


def test_names_are_trimmed_and_blank_headers_dropped(spark):
    df = spark.createDataFrame([("a", "b", "c")], [" Date ", "Safety Alert", "_c2"])
    cleaned = clean.drop_blank_columns(clean.trim_column_names(df))
    assert cleaned.columns == ["Date", "Safety Alert"]
    assert clean.plain_column_names(cleaned).columns == ["date", "safety_alert"]


def test_only_present_dates_are_coerced(spark):
    df = spark.createDataFrame([("2024-01-02", "x"), ("bad", "y")], ["update_date", "v"])
    rows = clean.coerce_dates(df, ["update_date", "absent"]).orderBy("v").collect()
    assert [r.update_date for r in rows] == [dt.date(2024, 1, 2), None]


def test_text_columns_keep_null_unless_a_text_is_given(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "n INT, t STRING")
    assert clean.text_columns(df).orderBy("n").first().t is None
    assert clean.text_columns(df, "nan").orderBy("n").first().t == "nan"
    assert dict(clean.text_columns(df).dtypes)["n"] == "int"


def test_row_id_is_kept_or_made_from_the_key(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x STRING, y STRING")
    ids = [r.id for r in clean.add_row_id(df, ["x", "y"]).collect()]
    assert len(set(ids)) == 2
    assert clean.add_row_id(df.withColumn("id", F.lit("k")), ["x"]).first().id == "k"


def test_manifest(spark):
    paths = ["a/bisoprolol_memo.txt", "b/.hidden", "c/x.tmp", "d/plain", "e/end.", "f/x.tar.gz"]
    files = spark.createDataFrame([(p, 5) for p in paths], ["relative_path", "length"])
    rows = {r.document_name: r for r in clean.document_manifest(files, "s3://b/", NOW).collect()}
    assert set(rows) == {"bisoprolol_memo.txt", "plain", "end.", "x.tar.gz"}
    assert rows["plain"].source_format == "UNKNOWN"
    assert rows["end."].source_format == ""
    assert rows["x.tar.gz"].source_format == "GZ"
    memo = rows["bisoprolol_memo.txt"]
    assert memo.document_uri == "s3://b/hospital_documents/a/bisoprolol_memo.txt"
    assert (memo.document_type, memo.processing_status) == ("CLINICAL_PROTOCOL", "UPLOADED")
