"""Scenarios, generation, impact and the whole analysis."""

import json

import pytest
from pyspark.sql import functions as F

from alertloom.fixed import analysis as fixed
from alertloom.operators import generate, impact, quality, scenario
from alertloom.plans import alerts
from alertloom.queries.backends import backend_factory

SCHEMA = (
    "id INT, drug_name STRING, device_name STRING, condition STRING, risk_level STRING, "
    "old_warning STRING, new_warning STRING, clinical_significance STRING, "
    "patient_safety_impact STRING, manufacturer STRING, compliance_deadline STRING"
)


def frame(spark, *rows):
    return spark.createDataFrame([r + (None,) * (11 - len(r)) for r in rows], SCHEMA)


@pytest.fixture
def records(spark):
    return frame(
        spark,
        (1, None, "pump", "flu", "Critical"),
        (2, "", "pump", None, "Critical"),
        (3, None, None, None, "Critical"),
        (4, "pill", None, None, "High"),
        (5, None, None, None, None),
    )


def test_entity_and_type(records):
    rows = {r.id: (r.clinical_entity, r.entity_type) for r in scenario.with_entity(records).collect()}
    assert rows[1] == ("pump", "Device")
    assert rows[2] == ("", "Device")
    assert rows[3] == (None, "Condition")


def test_critical_filter(records):
    assert {r.id for r in scenario.critical(records, ["id"]).collect()} == {1, 2}
    everything = scenario.critical(records, ["id"], named_only=False)
    assert {r.id for r in everything.collect()} == {1, 2, 3}


def test_fallback_scenario_only_when_none(records):
    some = scenario.critical(records, ["id"])
    assert scenario.select_scenario(some, ["id"], 1).collect()[0].id in (1, 2)
    none = scenario.select_scenario(some.filter("id > 9"), ["id"], 1).collect()
    assert [r.clinical_entity for r in none] == ["warfarin"]


def test_default_cost(records):
    costs = {r[0]: r[1] for r in records.select("id", generate.default_cost()).collect()}
    assert costs == {1: 750000, 2: 750000, 3: 750000, 4: 350000, 5: 125000}


def test_breakdown(records):
    priced = records.filter("id = 1").withColumn("financial_impact", generate.default_cost())
    rows = generate.cost_breakdown(priced, ["id"]).collect()
    assert [r.amount for r in rows] == [450000, 150000, 112500, 37500]


def test_plan_rows_and_hours(records):
    planned = records.withColumn("plan", generate.default_plan())
    rows = generate.plan_rows(planned, ["id"])
    assert rows.count() == 25 and rows.filter("id = 1").agg(F.sum("estimated_hours")).first()[0] == 100
    hours = impact.plan_hours(records, rows.filter("id < 3"), ["id"])
    assert {r.id: r.total_hours for r in hours.collect()} == {1: 100, 2: 100, 3: 48, 4: 48, 5: 48}


def test_hours_without_a_plan(one):
    kind = "ARRAY<STRUCT<estimated_hours: BIGINT>>"
    hours = impact.hours_of_plan(F.col("p"))
    assert one([hours], p=([], kind)) == 48
    assert one([hours], p=(None, kind)) == 48
    assert one([hours], p=([(3,), (None,)], kind)) == 3


@pytest.mark.parametrize(
    ("hours", "saved", "efficiency", "speed"),
    [(100, 860, 89.5833, 9.6), (48, 912, 95.0, 20.0), (0, 960, 100.0, None)],
)
def test_impact(spark, hours, saved, efficiency, speed):
    df = spark.createDataFrame([(hours, 750000)], "total_hours BIGINT, financial_impact BIGINT")
    row = impact.impact_metrics(df).first()
    assert (row.time_saved, row.cost_saved, row.speed_up) == (saved, 900000, speed)
    assert round(row.efficiency_gain, 4) == efficiency


def test_tiles_comparison_projection(spark):
    df = spark.createDataFrame([(1, 100, 750000)], "id INT, total_hours BIGINT, financial_impact BIGINT")
    metrics = impact.impact_metrics(df)
    tiles = {r.tile: r.figure for r in impact.stat_tiles(metrics, ["id"]).collect()}
    assert list(tiles.values()) == ["90%", "$900K", "95%", "10x Faster"]
    first = impact.impact_comparison(metrics, ["id"]).first()
    assert (first.automated_value, first.automated_label) == (0.1, "6.0 min")
    assert impact.annual_projection(metrics, ["id"]).first().annual_label == "$180.0M+"


@pytest.mark.parametrize(
    ("value", "expected"), [(None, 7.0), ("0", 7.0), ("abc", 7.0), ("12.5", 12.5), ("NaN", 7.0)]
)
def test_number_or_fallback(one, value, expected):
    assert one([generate.number_or(F.col("v"), F.lit(7))], v=(value, "STRING")) == expected


def answer(text, **extra):
    return json.dumps({"candidates": [{"content": {"parts": [{"text": text}]}, **extra}]})


@pytest.mark.parametrize(
    ("response", "expected"),
    [
        (answer("hi"), ("hi", "STOP", False)),
        (answer("hi", finish_reason="MAX_TOKENS"), ("hi", "MAX_TOKENS", True)),
        ("oops", (None, None, False)),
        ('{"candidates": []}', (None, None, False)),
        (None, (None, None, False)),
    ],
)
def test_unpack(one, response, expected):
    parts = generate.unpack_response(F.col("r"))
    assert one(list(parts.values()), r=(response, "STRING")) == expected


def test_prompts_show_none_and_money(records):
    row = scenario.critical(records, ["id"]).filter("id = 1").select(
        generate.briefing_prompt(), generate.plan_prompt(F.lit("B"), F.lit(750000))
    ).first()
    assert "Entity: pump" in row[0] and "Previous Guidance: None" in row[0]
    assert "Liability: $750,000\n" in row[1]


def test_schema_names():
    assert generate.spark_schema(fixed.PLAN_SCHEMA).endswith("estimated_hours BIGINT")


def counting(path):
    """A backend that writes one line per prompt; local, so that tasks need no import."""

    class Counting:
        def complete(self, prompts, **options):
            assert options["temperature"] == 0.1 and options["max_output_tokens"] == 2048
            with open(path, "a") as out:
                out.writelines("x\n" for _ in prompts)
            parts = [{"parts": [{"text": str(len(p))}]} for p in prompts]
            return [json.dumps({"candidates": [{"content": c}]}) for c in parts]

    return Counting


def test_each_distinct_prompt_is_asked_once(spark, tmp_path):
    path = str(tmp_path / "calls")
    df = spark.range(300).withColumn("p", F.concat(F.lit("p"), (F.col("id") % 3).cast("string")))
    done = generate.generate_text(df, F.col("p"), counting(path), F.lit("none"))
    assert done.count() == 300
    assert done.filter("briefing = '2'").count() == 300
    with open(path) as calls:
        assert len(calls.readlines()) == 3


def failing():
    class Failing:
        def complete(self, prompts, **options):
            if "p1" in prompts:
                raise ConnectionError("busy")
            if "p2" in prompts and len(prompts) > 1:
                return []
            parts = [{"parts": [{"text": p}]} for p in prompts]
            return [json.dumps({"candidates": [{"content": c}]}) for c in parts]

    return Failing


def test_a_failing_backend_costs_only_the_rows_concerned(spark):
    df = spark.range(20).withColumn("p", F.concat(F.lit("p"), (F.col("id") % 5).cast("string")))
    done = generate.generate_text(
        df, F.col("p"), failing(), F.lit("none"), tasks=1, error="error"
    ).select("p", "briefing", "is_truncated", "error")
    assert {tuple(r) for r in done.collect()} == {
        ("p1", "none", False, "ConnectionError: busy"),
        *((f"p{i}", f"p{i}", False, None) for i in (0, 2, 3, 4)),
    }
    assert done.count() == 20


def test_analysis_with_defaults(records):
    rows = {r.id: r for r in alerts.analyze(records, ["id"]).collect()}
    assert set(rows) == {1, 2}
    assert (rows[1].total_hours, rows[1].cost_saved) == (100, 900000)
    assert rows[1].briefing.count("pump") == 3


def test_analysis_with_backend_falls_back_row_by_row(spark):
    records = frame(spark, *[(i, f"drug{i}", None, None, "Critical") for i in range(40)])
    rows = alerts.analyze_with_backend(records, ["id"], backend_factory("text")).collect()
    assert len(rows) == 40
    # Texts are no numbers and no tables, so cost and plan are the defaults.
    assert {(r.financial_impact, r.total_hours) for r in rows} == {(750000.0, 100)}
    assert any(r.briefing.startswith("Answer ") for r in rows)


def test_counts_and_readiness(spark):
    counts = quality.table_counts(spark, {"a": spark.range(3), "b": spark.range(0), "c": None})
    assert {r.table_name: r.row_count for r in counts.collect()} == {"a": 3, "b": 0, "c": 0}
    assert tuple(quality.readiness_summary(counts).first()) == (1, 3, 3, False)


def test_audit_counts_while_another_action_runs(spark):
    df, observation = quality.audited(spark.range(7), "audit")
    df.collect()
    assert observation.get["rows"] == 7
