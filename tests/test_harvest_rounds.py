"""Capped runs choose by narrow places, and move no record that they do not take."""

import os
import random

import pytest
from pyspark.sql import functions as F

from alertloom import schemas, session
from alertloom.fixed import records as fixed
from alertloom.plans import harvest as plan
from alertloom.sources import readers

DAY = "2025-09-14"
COLUMNS = "safetyreportid string, source_pos long, serious string, patient struct<reaction: array<struct<reactionmeddrapt: string>>>"


def landed(spark, rows):
    events = spark.createDataFrame([(i, p, s, ([(r,) for r in rs],)) for i, p, s, rs in rows], COLUMNS)
    like = readers.empty(spark, schemas.EVENT_REPORT)
    missing = {f.name: F.lit(None).cast(f.dataType) for f in like.schema if f.name not in events.columns and f.name != "patient"}
    parts = {f.name: f.dataType for f in like.schema["patient"].dataType}
    reaction = F.transform("patient.reaction", lambda r: F.struct(
        *[(r["reactionmeddrapt"] if f.name == "reactionmeddrapt" else F.lit(None).cast(f.dataType)).alias(f.name)
          for f in parts["reaction"].elementType]
    ))
    patient = F.struct(*[(reaction if n == "reaction" else F.lit(None).cast(t)).alias(n) for n, t in parts.items()])
    events = events.withColumns({**missing, "patient": patient})

    def none(schema):
        return readers.empty(spark, schema).withColumn("source_pos", F.lit(0))

    return plan.Landed(none(schemas.DRUG_LABEL), events, none(schemas.DEVICE_RECALL), none(schemas.CLINICAL_TRIAL))


def plain_round(rows, seen, cap):
    """Keys a run takes: of each key its first place, not seen before, then the first of each term."""
    terms = [t.lower() for t in [*fixed.EVENT_REACTIONS, *fixed.EVENT_FLAGS]]
    firsts = {}
    for key, pos, serious, reactions in rows:
        values = [r.lower() for r in reactions if r] + ([f"serious:{serious}"] if serious else [])
        ranks = [i for i, t in enumerate(terms) if t in values]
        if ranks and key is not None:
            place = (ranks[0], pos is None, pos or 0)
            firsts[key] = min(firsts.get(key, place), place)
    taken = set()
    for term in {p[0] for p in firsts.values()}:
        fresh = sorted((p, k) for k, p in firsts.items() if p[0] == term and k not in seen)
        taken |= {k for _, k in fresh[:cap]}
    return taken


@pytest.mark.parametrize("rows_a_share", [3, 1 << 20])
def test_rounds_take_what_plain_code_takes_however_places_repeat(spark, monkeypatch, rows_a_share):
    monkeypatch.setattr(plan, "SHARE_ROWS", rows_a_share)
    chance = random.Random(8)
    words = ["Rash", "nausea", "Headache", "none", None]
    rows = [
        (
            f"k{chance.randrange(70):02d}",
            chance.choice([None, *range(40)]),
            chance.choice([None, "1", "2"]),
            [chance.choice(words) for _ in range(chance.randrange(3))],
        )
        for _ in range(240)
    ]
    # Its first place is past the cap, while a later one lies within what is taken of another term.
    rows += [("late", 99, "2", ["headache"]), ("late", 3, "1", [])]
    feed, seen, held = landed(spark, rows), set(), None
    for number in range(30):
        wanted = plain_round(rows, seen, 4)
        new = session.settle(plan.new_records(feed, held, DAY, caps=plan.Caps(events=4)), "round")
        got = [r.source_url.removeprefix(fixed.EVENT_URL) for r in new.select("source_url").collect()]
        assert sorted(got) == sorted(wanted)
        if not wanted:
            break
        seen |= wanted
        held = new.select("source_url") if held is None else held.unionByName(new.select("source_url"))
    everything = plan.new_records(feed, None, DAY)
    assert number > 2 and everything.count() == len(seen)


def test_a_round_moves_whole_records_once(spark):
    rows = [(f"k{i}", i, "1", ["rash"]) for i in range(300)]
    feed = landed(spark, rows)
    first = session.settle(plan.new_records(feed, None, DAY, caps=plan.Caps(events=40)), "round")
    second = plan.new_records(feed, first.select("source_url"), DAY, caps=plan.Caps(events=40))
    assert sorted(r.source_pos for r in second.collect()) == list(range(40, 80))
    text = second._jdf.queryExecution().executedPlan().toString()
    assert "dense_rank" not in text  # the cap was put on places before
    taken = spark.createDataFrame([(6, 40, "a"), (6, 79, "b"), (7, None, "c")], "term_rank int, source_pos int, _key string")
    places = spark.createDataFrame(
        [(6, 39), (6, 40), (6, 60), (6, 79), (6, 80), (6, None), (7, 50), (7, None), (8, 40)], "term_rank int, source_pos int"
    )
    kept = plan._within(places, taken, ["term_rank", "source_pos"]).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(6, 40), (6, 60), (6, 79), (7, None)], key=str)


def test_tables_settled_on_the_way_are_deleted(spark):
    folder = session.shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    made = []

    def make():
        made.append(session.settle(spark.range(9), "on-the-way"))
        inner = session.settle_alone(lambda: session.settle(made[0].where("id > 2"), "deep"), "inner")
        session.unsettle(session.settle(made[0], "done-with"))
        return inner.where("id > 4")

    kept = session.settle_alone(make, "kept-one")
    names = [n.rsplit("-", 1)[0] for n in set(os.listdir(folder)) - before]
    assert names == ["kept-one"] and kept.count() == 4
