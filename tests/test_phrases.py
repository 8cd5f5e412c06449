"""The positional index against plain search, through additions, replacements, removals and merges."""

import random
import re

import pytest
from pyspark.sql import functions as F

from alertloom.sources import phrases, snapshots

WORDS = ["alpha", "beta", "gamma", "delta", "of", "the"]
PROBES = ["alpha", "Beta GAMMA", "of the of", "the the", "alpha beta gamma delta", "absent", "of absent", "", " - ", "É x"]


def words(text):
    return re.sub(r"[\W_]+", " ", (text or "").lower()).split()


def plain(docs, probes):
    out = {}
    for probe in probes:
        wanted = words(probe)
        for doc, text in docs.items():
            held = words(text)
            starts = [i for i in range(len(held) - len(wanted) + 1) if held[i : i + len(wanted)] == wanted]
            if wanted and starts:
                out[probe, doc] = starts
    return out


def frame(spark, docs):
    return spark.createDataFrame(list(docs.items()), "doc_id long, text string")


def search(spark, held, probes=PROBES):
    entities = spark.createDataFrame([(p,) for p in [*probes, *probes]], "clinical_entity string")
    found = phrases.find(entities, held, frame(spark, {1: ""}).schema["doc_id"])
    assert found.columns == ["clinical_entity", "doc_id", "starts"]
    rows = found.collect()
    out = {(r.clinical_entity, r.doc_id): r.starts for r in rows}
    assert len(out) == len(rows)
    return out


def some(seed, ids):
    chance = random.Random(seed)
    return {i: " ".join(chance.choice(WORDS) + chance.choice(["", ",", "\n"]) for _ in range(chance.randint(0, 30))) for i in ids}


def test_additions_replacements_and_removals(spark, tmp_path):
    root = str(tmp_path / "index")
    docs = some(1, range(20)) | {20: None, 21: "", 22: "É x, é X"}
    held = phrases.add(frame(spark, docs), root)
    assert search(spark, held) == plain(docs, PROBES)
    more = some(2, range(15, 30))
    later = phrases.add(frame(spark, more), root)
    assert search(spark, later) == plain(docs | more, PROBES)
    assert search(spark, held) == plain(docs, PROBES)  # a reader keeps its version
    last = phrases.remove(frame(spark, {3: "", 16: "", 99: ""}), root)
    now = {i: t for i, t in (docs | more).items() if i not in (3, 16)}
    assert search(spark, last) == plain(now, PROBES)
    again = phrases.add(frame(spark, {3: "beta gamma"}), root)
    now[3] = "beta gamma"
    merged = phrases.compact(spark, again, frame(spark, {}).schema["doc_id"])
    assert len(merged.folders(phrases.POSTINGS)) == 1
    assert search(spark, merged) == plain(now, PROBES)
    rows = phrases._read_postings(spark, merged, frame(spark, {}).schema["doc_id"])
    assert rows.select("document").distinct().count() == len([t for t in now.values() if words(t)])


def test_an_addition_writes_only_its_own_tokens(spark, tmp_path):
    root = str(tmp_path / "index")
    phrases.add(frame(spark, some(1, range(20))), root)
    before = snapshots.snapshot(spark, root)
    after = phrases.add(frame(spark, {50: "alpha beta"}), root)
    new = [f for f in after.folders(phrases.POSTINGS) if f not in before.folders(phrases.POSTINGS)]
    kept = [f for f in after.folders(phrases.POSTINGS) if f in before.folders(phrases.POSTINGS)]
    assert kept == before.folders(phrases.POSTINGS)
    files = spark.read.parquet(*new).inputFiles()
    tokens = spark.createDataFrame([("alpha",), ("beta",)], "token string")
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in files} == set(phrases._buckets_of(tokens))


def test_only_the_folders_of_wanted_tokens_are_read(spark, tmp_path):
    held = phrases.add(frame(spark, some(4, range(30))), str(tmp_path / "index"))
    kind = frame(spark, {}).schema["doc_id"]
    tokens = spark.createDataFrame([("alpha",)], "token string")
    wanted = phrases._buckets_of(tokens)
    rows = phrases._read_postings(spark, held, kind, wanted)
    files = rows.select(F.col("bucket")).distinct().collect()
    assert {r[0] for r in files} == set(wanted)
    assert "PartitionFilters: [" in rows._jdf.queryExecution().executedPlan().toString()


def test_generations_are_merged_when_there_are_many(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(phrases, "FEW", 2)
    root, docs = str(tmp_path / "index"), {}
    for i in range(4):
        new = some(i, range(5 * i, 5 * i + 7))
        docs |= new
        held = phrases.add(frame(spark, new), root)
        assert len(held.folders(phrases.POSTINGS)) <= 2
    assert search(spark, held) == plain(docs, PROBES)


def test_empty(spark, tmp_path):
    held = phrases.add(frame(spark, {}), str(tmp_path / "a"))
    assert search(spark, held) == {}
    assert search(spark, snapshots.snapshot(spark, str(tmp_path / "none"))) == {}
    full = phrases.add(frame(spark, {1: "alpha"}), str(tmp_path / "b"))
    assert search(spark, full, []) == {}


def test_words_meet_within_their_row(spark, tmp_path):
    """No shuffle before the one that deals postings; an id that comes twice has the places of both texts."""
    df = spark.createDataFrame([(1, "a b, A"), (1, "b a"), (2, None), (None, "a")], "doc_id long, text string")
    found = phrases.tokens(df, "doc_id", "text")
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.token, r.positions) for r in found.where("document = 1").collect()) == [
        ("a", [0, 2]),
        ("a", [1]),
        ("b", [0]),
        ("b", [1]),
    ]
    held = phrases.add(df, str(tmp_path / "index"))
    assert search(spark, held, ["a", "a b", "b a", "c"]) == {("a", 1): [0, 1, 2], ("a b", 1): [0], ("b a", 1): [0, 1]}
