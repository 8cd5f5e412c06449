import datetime as dt

from pyspark.sql import functions as F

from alertloom import schemas
from alertloom.fixed.codes import RECORD_FIELDS
from alertloom.operators import harvest
from alertloom.plans import harvest as plan
from alertloom.sources import readers

DAY = "2025-09-14"


def test_terms_ignore_case_and_repeat_a_record_per_term(spark):
    df = spark.createDataFrame([(1, ["RASH", "Nausea", "rash"]), (2, None)], "id INT, v ARRAY<STRING>")
    rows = harvest.match_terms(df, F.col("v"), ["nausea", "rash"]).collect()
    assert {(r.id, r.term, r.term_rank) for r in rows} == {(1, "nausea", 1), (1, "rash", 2)}
    first = harvest.match_terms(df, F.col("v"), ["nausea", "rash"], every=False).collect()
    assert [(r.id, r.term) for r in first] == [(1, "nausea")]


def test_cap_holds_with_one_huge_group(spark):
    df = spark.range(3000).withColumn("g", F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")))
    rows = harvest.cap_per_group(df, ["g"], ["id"], 5).filter("g = 0").collect()
    assert sorted(r.id for r in rows) == [0, 1, 2, 4, 5]
    assert harvest.cap_per_group(df, ["g"], ["id"], None).count() == 3000


def test_first_wins_and_new_only(spark):
    df = spark.createDataFrame(
        [("a", 2, 1), ("a", 1, 9), ("a", 1, 3), ("b", 3, 1)], "source_url STRING, rank INT, pos INT"
    )
    firsts = harvest.first_wins(df, [F.col("rank"), F.col("pos")])
    assert {tuple(r) for r in firsts.collect()} == {("a", 1, 3), ("b", 3, 1)}
    seen = spark.createDataFrame([("b",), ("b",)], "source_url STRING")
    assert [r.source_url for r in harvest.new_only(firsts, seen).collect()] == ["a"]


def test_keys_are_trimmed_and_merged(spark):
    lines = spark.createDataFrame([(" a ",), ("a",), ("b",)], "value STRING")
    seen = spark.createDataFrame([("c",)], "source_url STRING")
    merged = harvest.merge_keys(seen, harvest.clean_keys(lines)).collect()
    assert sorted(r.source_url for r in merged) == ["a", "b", "c"]


def test_top_up_threshold(spark):
    extra = spark.range(100, 102)
    assert harvest.top_up(spark.range(14), extra).count() == 16
    assert harvest.top_up(spark.range(15), extra).count() == 15
    assert harvest.top_up(spark.range(15), extra, force=True).count() == 17


def landed(spark, reports):
    events = spark.createDataFrame(reports, schemas.EVENT_REPORT).withColumn(
        "source_pos", F.monotonically_increasing_id()
    )

    def none(schema):
        return readers.empty(spark, schema).withColumn("source_pos", F.lit(0))

    return plan.Landed(
        labels=none(schemas.DRUG_LABEL),
        events=events,
        recalls=none(schemas.DEVICE_RECALL),
        trials=none(schemas.CLINICAL_TRIAL),
    )


def report(number):
    return {
        "safetyreportid": f"r{number}",
        "patient": {"reaction": [{"reactionmeddrapt": "rash"}, {"reactionmeddrapt": "Nausea"}]},
    }


def test_capped_runs_take_everything_in_the_end(spark, tmp_path):
    folder, state = str(tmp_path / "out"), str(tmp_path / "seen")
    feed = landed(spark, [report(i) for i in range(20)])
    taken = []
    for hour in (1, 2, 3, 4):
        seen = readers.read_seen(spark, state)
        new = plan.run(feed, seen, DAY, caps=plan.PAGE_CAPS)
        plan.commit(new, folder, dt.datetime(2025, 9, 14, hour), state)
        urls = [r.source_url for r in new.select("source_url").collect()]
        taken.append([u for u in urls if "adverse-event" in u])
    assert [len(t) for t in taken] == [8, 8, 4, 0]
    assert len({u for t in taken for u in t}) == 20
    newest = readers.read_records(spark, folder)
    assert newest.columns == list(RECORD_FIELDS)
    assert newest.count() == 2  # the two added when a run finds too little
    everything = readers.read_records_text(spark, folder)
    assert everything.count() == 20 + 4 * 2
    assert everything.filter("device_name IS NULL").count() == 0


def test_a_run_takes_all_by_default(spark):
    feed = landed(spark, [report(i) for i in range(20)])
    assert plan.new_records(feed, None, DAY).count() == 20


def test_ties_do_not_depend_on_the_order_of_rows(spark):
    """Two files may number their records alike."""
    pair = [report(1), {**report(1), "serious": "1"}]
    found = set()
    for rows in (pair, pair[::-1]):
        feed = landed(spark, rows)
        feed.events = feed.events.withColumn("source_pos", F.lit(0))
        found.add(plan.new_records(feed, None, DAY).select("risk_level").first()[0])
    assert len(found) == 1


def test_keys_seen_are_not_broadcast(spark, tmp_path):
    """Any number of them may have been seen; the rows lie by key anyway."""
    feed, path = landed(spark, [report(i) for i in range(6)]), str(tmp_path / "taken")
    first = plan.new_records(feed, None, DAY, caps=plan.Caps(events=4))
    first.coalesce(1).write.parquet(path)
    new = plan.new_records(feed, spark.read.parquet(path).select("source_url"), DAY)
    assert len(new.collect()) == 2
    assert "Broadcast" not in new._jdf.queryExecution().executedPlan().toString()


def test_records_that_tie_settle_before_the_cap_and_meet_once(spark):
    """Copies, ties and a later copy of one key; other keys once each."""
    rows = [report(1), {**report(1), "serious": "1"}, {**report(1), "serious": "1"}, report(2), report(3), report(1)]
    feed = landed(spark, rows)
    at = F.when(F.col("source_pos") > 2, 7).otherwise(0)
    feed.events = spark.createDataFrame(rows, schemas.EVENT_REPORT).coalesce(1).withColumn(
        "source_pos", F.monotonically_increasing_id()
    ).withColumn("source_pos", at.cast("bigint"))
    all_of_it = plan.new_records(feed, None, DAY)
    assert sorted(r.source_url[-2:] for r in all_of_it.collect()) == ["r1", "r2", "r3"]
    capped = plan.new_records(feed, None, DAY, caps=plan.Caps(events=2))
    assert sorted(r.source_url[-2:] for r in capped.collect()) == ["r1", "r2"]
    shuffles = all_of_it._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert shuffles <= 4  # one for each source


def test_large_caps_are_cut_in_parts(spark):
    df = spark.range(6000).select((F.col("id") % 2).alias("g"), "id")
    kept = harvest.cap_per_group(df, ["g"], ["id"], 1500)
    assert kept.groupBy("g").agg(F.max("id")).sort("g").collect() == [(0, 2998), (1, 2999)]


def test_without_caps_every_record_comes_once(spark):
    feed = landed(spark, [report(i % 15) for i in range(40)])
    new = plan.new_records(feed, None, DAY, caps=plan.Caps(None, None, None, None))
    assert new.count() == 15
    assert {r.term_rank for r in new.select("term_rank").collect()} == {2}


def test_reports_and_recalls_found_by_flag_and_class(spark):
    rows = [("a", "1", None, None), ("b", "2", "1", [("Rash",)]), ("c", None, "0", None), ("d", "1", None, [("rash",), (None,)])]
    reports = spark.createDataFrame(
        [(i, s, h, None, (r,)) for i, s, h, r in rows],
        "id string, serious string, seriousnesshospitalization string, seriousnesslifethreatening string, "
        "patient struct<reaction: array<struct<reactionmeddrapt: string>>>",
    )
    found = sorted((r.id, r.term, r.term_rank) for r in harvest.match_events(reports).collect())
    assert found == [
        ("a", "serious:1", 7),
        ("b", "rash", 6),
        ("b", "seriousnesshospitalization:1", 8),
        ("d", "rash", 6),
        ("d", "serious:1", 7),
    ]
    first = sorted((r.id, r.term) for r in harvest.match_events(reports, every=False).collect())
    assert first == [("a", "serious:1"), ("b", "rash"), ("d", "rash")]
    assert harvest.match_events(reports, 6).count() == 2
    recalls = spark.createDataFrame(
        [("x", "Software", "II"), ("y", None, "III"), ("z", "other", "I"), ("v", None, None)],
        "id string, root_cause_description string, classification string",
    )
    found = sorted((r.id, r.term_rank) for r in harvest.match_recalls(recalls).collect())
    assert found == [("x", 2), ("x", 4), ("y", 5)]
