import datetime as dt

import pytest
from pyspark.sql import functions as F

from alertloom.fixed import codes as fixed
from alertloom.functions import codes, dates, nested, seeded, text


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ("10/02/2024", dt.date(2024, 10, 2)),
        ("1/5/2023", dt.date(2023, 1, 5)),
        ("5/19/21", None),
        ("\xa0", None),
        ("soon", None),
        (None, None),
    ],
)
def test_date_is_coerced(one, value, expected):
    assert one([dates.coerce_date(F.col("d"))], d=(value, "STRING")) == expected


def test_deadline_is_text(one):
    assert one([dates.deadline(dates.day("2025-09-14"), 90)]) == "2025-12-13"


@pytest.mark.parametrize(
    ("serious", "other", "risk"),
    [("1", None, "Critical"), ("2", "1", "High"), ("2", "2", "Medium"), (None, None, "Medium")],
)
def test_risk_by_seriousness(one, serious, other, risk):
    column = codes.risk_by_seriousness(F.col("s"), F.col("o"))
    assert one([column], s=(serious, "STRING"), o=(other, "STRING")) == risk


@pytest.mark.parametrize(
    ("grade", "risk"),
    [("I", "Critical"), ("II", "High"), ("III", "Medium"), ("Class I", "Medium"), (None, "High")],
)
def test_risk_by_recall_class(one, grade, risk):
    assert one([codes.risk_by_recall_class(F.col("g"))], g=(grade, "STRING")) == risk


def test_labels_and_flags(one):
    columns = [
        codes.label(F.col("c"), "outcome"),
        codes.label(F.col("n"), "outcome"),
        codes.label(F.col("c"), "nothing"),
        codes.yes_no(F.col("n")),
        codes.sex(F.col("n")),
    ]
    got = one(columns, c=("5", "STRING"), n=(None, "STRING"))
    assert got == ("Fatal", "Unknown", "Unknown", "No", "Unknown")


@pytest.mark.parametrize(
    ("document", "path", "expected"),
    [
        ('{"a":null}', "a", "d"),
        ('{"a":""}', "a", ""),
        ('{"a":[{"b":"x"}]}', "a.0.b", "x"),
        ('{"a":[{"b":"x"}]}', "a.7.b", "d"),
        ('{"a":"x"}', "a.b.c", "d"),
        ("not json", "a", "d"),
    ],
)
def test_json_path(one, document, path, expected):
    assert one([nested.json_value(F.col("j"), path, "d")], j=(document, "STRING")) == expected


def test_first_filled_default_only_for_null(one):
    def chain():
        return text.first_filled([F.col("a"), F.col("b")], F.col("c"), "none")

    kinds = {"a": (None, "STRING"), "b": ("", "STRING")}
    assert one([chain()], **kinds, c=(None, "STRING")) == "none"
    assert one([chain()], **kinds, c=("", "STRING")) == ""
    assert one([chain()], **{**kinds, "b": (" ", "STRING")}, c=("x", "STRING")) == " "


@pytest.mark.parametrize(
    ("name", "label"),
    [
        ("bisoprolol_memo.txt", "CLINICAL_PROTOCOL"),
        ("Training_notes.txt", "TRAINING_MATERIAL"),
        ("DEVICE.pdf", "DEVICE_MANUAL"),
        ("research_summary.txt", "GENERAL_CLINICAL"),
    ],
)
def test_keyword_class(one, name, label):
    column = text.keyword_class(F.col("n"), fixed.DOCUMENT_RULES, fixed.DOCUMENT_DEFAULT)
    assert one([column], n=(name, "STRING")) == label


def test_safe_name_is_cut_before_it_is_filtered(one):
    column = text.alphanumeric_head(F.col("n"), 15)
    assert one([column], n=("Insulin glargine (U-100)", "STRING")) == "Insulinglargin"


def test_template_without_value_fails():
    with pytest.raises(KeyError):
        text.fill("{missing}", {})


def test_halves_go_to_even(one):
    columns = [text.decimals(F.lit(2.5), 0), text.decimals(F.lit(3.5), 0), text.dollars(F.lit(1234567.5))]
    assert one(columns) == ("2", "4", "1,234,568")


def test_seeded_values_are_repeatable_and_in_range(spark):
    keys = spark.range(500)
    values = keys.select(
        seeded.integer_between(14, 60, F.col("id"), seed=1).alias("n"),
        seeded.choice(("a", "b"), F.col("id"), seed=1).alias("c"),
        seeded.happens(0.2, F.col("id"), seed=1).alias("h"),
    )
    first, again = values.collect(), values.repartition(7).collect()
    assert sorted(first) == sorted(again)
    assert {r.c for r in first} == {"a", "b"}
    assert min(r.n for r in first) >= 14 and max(r.n for r in first) <= 60
    assert 60 < sum(r.h for r in first) < 140


def test_null_keeps_its_place_in_a_key(one):
    columns = [seeded.digest(F.col("a"), F.col("b")), seeded.digest(F.col("b"), F.col("a"))]
    left, right = one(columns, a=("x", "STRING"), b=(None, "STRING"))
    assert left != right


def test_decimals_round_the_binary_value(spark):
    values = [900.15, 900.45, 0.15, 0.25, 0.35, 2.5, 3.5, 0.5, 1e-9, 123456.05, -0.04, -1.25, 99.95, 750.0, 2.675]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for places in (0, 1, 2):
        got = [r[0] for r in df.select(text.decimals(F.col("v"), places)).collect()]
        wanted = [f"{v:.{places}f}" for v in values]
        assert [g.removeprefix("-") if float(g) == 0 else g for g in got] == [
            w.removeprefix("-") if float(w) == 0 else w for w in wanted
        ]
