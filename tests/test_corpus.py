from pyspark.sql import functions as F

from alertloom import schemas
from alertloom.operators import corpus, match
from alertloom.plans import corpus as plan
from alertloom.sources import sinks

DAY = "2025-09-14"


def records(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.RECORD_TEXT).withColumn(
        "key", F.coalesce("drug_name", "device_name", "condition", F.lit("x"))
    )


def value(df, column):
    return df.select(column).first()[0]


def test_recalled_device_comes_before_the_drug(spark):
    df = records(spark, {"drug_name": "d", "device_name": "p", "recall_reason": "r"})
    assert value(df, corpus.route([F.col("key")])) == "device_manual"
    blank = records(spark, {"drug_name": "", "device_name": "p", "condition": ""})
    assert value(blank, corpus.route([F.col("key")])) in ("safety_alert", "training_memo")


def test_memo_lines_appear_only_when_filled(spark):
    df = records(spark, {"drug_name": "Testol", "old_dosage": "", "old_warning": "watch"})
    memo = value(df, corpus.training_memo([F.col("key")], DAY))
    lines = memo.split("\n")
    assert lines[0] == "Clinical Training Update: Testol"
    assert lines[1] == "=" * len(lines[0])
    assert "DATE: September 14, 2025" in lines
    assert "• Monitoring requirements: watch" in lines
    assert "Current dosing guidelines" not in memo
    assert "Risk level: Standard" in lines


def test_blank_stays_blank_and_absent_gets_the_default(spark):
    absent = records(spark, {"condition": "c"})
    blank = records(spark, {"condition": "c", "fda_approval_date": ""})
    keys = [F.col("key")]
    assert "Approval Date: Historical approval\n" in value(absent, corpus.research_summary(keys, DAY))
    assert "Approval Date: \n" in value(blank, corpus.research_summary(keys, DAY))


def test_alert_issue_has_three_forms(spark):
    keys = [F.col("key")]

    def alert(**fields):
        return value(records(spark, {"drug_name": "d", **fields}), corpus.safety_alert(keys, DAY))

    assert "DEVICE RECALL: broke\n" in alert(recall_reason="broke", new_warning="w")
    assert "SAFETY WARNING: " in alert(recall_reason="", new_warning="w")
    assert "Clinical safety concern identified" in alert()


def test_corpus_has_the_wanted_number_and_statistics(spark):
    df = records(spark, *[{"drug_name": f"drug {i}"} for i in range(7)]).drop("key")
    docs = plan.build(df, 24, DAY)
    assert docs.count() == 24
    stats = {r.kind: r.documents for r in corpus.corpus_stats(docs).collect()}
    assert len(stats) == 10 and stats["device_manual"] == 0
    assert stats["total"] == 24 + stats["images"]
    row = docs.first()
    assert row.file_name.endswith("." + row.format) and row.template in row.file_name


def test_many_copies_are_split_and_complete(spark, monkeypatch):
    monkeypatch.setattr(corpus, "COPIES_PER_ROW", 4)
    rows = corpus.spread(spark.range(3), 3 * 11 + 1, 3, ["id"])
    got = sorted(tuple(r) for r in rows.filter("copy < 11").collect())
    assert got == [(i, c) for i in range(3) for c in range(11)]
    assert rows.count() == 34


def test_corpus_without_records_uses_the_samples(spark):
    empty = spark.createDataFrame([], schemas.RECORD_TEXT)
    assert plan.build(empty, 6, DAY).select("file_name").distinct().count() == 6


def test_corpus_is_written_as_a_table_and_as_texts(spark, tmp_path):
    docs = plan.build(spark.createDataFrame([], schemas.RECORD_TEXT), 30, DAY)
    sinks.write_corpus(docs, str(tmp_path / "table"))
    back = spark.read.parquet(str(tmp_path / "table"))
    assert back.count() == 30
    sinks.write_corpus_texts(docs, str(tmp_path / "texts"))
    texts = spark.read.option("lineSep", "\n\f\n").text(str(tmp_path / "texts"))
    assert texts.count() == docs.filter("text IS NOT NULL").count()


def test_fields_come_back_out_of_a_text(spark):
    df = records(spark, {"drug_name": "Testol", "risk_level": "High"})
    docs = df.select("key", corpus.training_memo([F.col("key")], DAY).alias("text"))
    fields = match.corpus_fields(docs, "key").first()
    assert (fields.risk_level, fields.document_number[:4]) == ("High", "MED-")
    assert fields.sections.startswith("BACKGROUND|CURRENT PROTOCOLS|")
    assert fields.extracted_entities[0].entity_value == "Testol"


def test_affected_documents_against_brute_force(spark):
    bodies = [
        "Red pump, used daily.",
        "the RED  pump failed; red pump again",
        "redpump only",
        "one two three four five",
        "one two three four. six",
        "",
    ]
    names = ["red pump", "pump", "one two three four five", "one two three four", "---", "absent"]
    docs = spark.createDataFrame(list(enumerate(bodies)), "doc_id INT, text STRING")
    entities = spark.createDataFrame([(n,) for n in names * 2], "clinical_entity STRING")
    got = sorted(tuple(r) for r in match.affected_documents(entities, docs).collect())

    def plain(value):
        return " ".join("".join(c if c.isalnum() else " " for c in value.lower()).split())

    wanted = sorted(
        (n, i)
        for n in names
        for i, b in enumerate(bodies)
        if plain(n) and f" {plain(n)} " in f" {plain(b)} "
    )
    assert got == wanted


def test_vector_topk(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 2.0]), (2, [3.0, 0.1]), (3, [0.0, 0.0]), (4, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id INT, embedding ARRAY<FLOAT>")
    assert [r.vec_id for r in match.vector_topk(df, 0, 2).collect()] == [2, 4]
