"""Mixing against plain code, and on awkward tables."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from alertloom.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None) for i, t, s in rows], SCHEMA)


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets by resharing until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target = {}
    left = share * sum(sizes.values())
    free = list(order)
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > most * sizes[s]]
        if not over:
            target |= {s: left * weight[s] / total for s in free}
            break
        for s in over:
            target[s] = float(most * sizes[s])
            left -= target[s]
            free.remove(s)
    return target


def plain_mix(rows):
    sizes, held = defaultdict(int), defaultdict(list)
    for i, text, source in rows:
        sizes[source] += words(text)
        key = hashlib.md5(f"{'null' if i is None else i}:{hashlib.md5((text or '').encode()).hexdigest()}".encode()).hexdigest()
        held[source].append((key, i, words(text)))
    target = plain_targets(sizes)
    out = Counter()
    for source, docs in held.items():
        passes = int(target[source] // sizes[source]) if sizes[source] else 0
        rest, run = target[source] - passes * sizes[source], 0
        for _, i, size in sorted(docs, key=lambda d: d[0]):
            more = rest > 0 and (run + size <= rest or (run <= rest and run + size - rest <= rest - run))
            run += size
            out[i, size, sizes[source], round(target[source], 6), size * (passes + more)] += 1
    return out


def got(df):
    return Counter((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in df.collect())


def corpus(seed, sources, docs):
    chance = random.Random(seed)
    names = [None, "", *[f"s{i}" for i in range(sources)], "é", "𠀀"]
    rows = []
    for i in range(docs):
        source = names[0] if chance.random() < 0.3 else chance.choice(names)
        rows.append((i, " ".join("w" * chance.randint(1, 4) for _ in range(int(chance.paretovariate(1)))), source))
    return rows


@pytest.mark.parametrize("seed, sources, docs", [(1, 1, 60), (2, 7, 500), (3, 25, 900)])
def test_mix_is_the_plain_one(spark, seed, sources, docs):
    rows = corpus(seed, sources, docs)
    assert got(mixing.mix(table(spark, rows))) == plain_mix(rows)


def test_refined_buckets_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(mixing, "DIGITS", 1)
    rows = corpus(4, 5, 700)
    assert got(mixing.mix(table(spark, rows))) == plain_mix(rows)


def test_rows_alike_are_taken_as_the_budget_asks(spark):
    rows = [(1, "a b c", "x")] * 300 + [(i, "a b c d", "y") for i in range(2, 100)]
    out = mixing.mix(table(spark, rows)).collect()
    taken, target = defaultdict(int), {}
    for r in out:
        taken[r.source_size] += r.taken
        target[r.source_size] = r.target
        assert r.taken <= 2 * r.size
    assert len(out) == len(rows)
    assert all(abs(taken[s] - target[s]) <= 2 for s in target)
    assert got(mixing.mix(table(spark, rows).repartition(7))) == Counter(
        (r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in out
    )


def test_awkward_rows_and_tables(spark):
    rows = [(None, None, None), (1, "", "a"), (1, " \t\n", "a"), (2, "x", "b"), (2, "x", "b"), (3, "é y " * 20_000, None)]
    df = table(spark, rows)
    assert got(mixing.mix(df)) == plain_mix(rows)
    clashing = df.selectExpr("*", "1 AS size", "2 AS key", "3 AS target", "4 AS copies", "'r' AS doc", "5 AS passes")
    assert got(mixing.mix(clashing)) == plain_mix(rows)
    assert mixing.mixture(clashing).columns == clashing.columns
    assert mixing.mix(df.limit(0)).collect() == []
    assert mixing.mixture(df.limit(0)).collect() == []
    empty = mixing.mix(df.where("doc_id = 1")).collect()  # a source without words
    assert [(r.size, r.source_size, r.target, r.taken) for r in empty] == [(0, 0, 0.0, 0)] * 2


def test_mixture_repeats_documents(spark):
    df = table(spark, corpus(5, 4, 300))
    taken = {r.doc_id: r.taken for r in mixing.mix(df).collect()}
    times = {r.doc_id: r.n * words(r.text) for r in mixing.mixture(df).groupBy("doc_id", "text").agg(F.count("*").alias("n")).collect()}
    assert times == {i: n for i, n in taken.items() if n or i in times}


def test_other_weights_and_shares(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 300), ("c", 600)], "source string, source_size long")
    out = {r.source: r.target for r in mixing.targets(sizes, weights=(1, 1), share=0.9, most=1.0).collect()}
    assert out == pytest.approx({"a": 100.0, "b": 300.0, "c": 500.0})
    full = {r.source: r.target for r in mixing.targets(sizes, share=2.0, most=2.0).collect()}
    assert full == pytest.approx({"a": 200.0, "b": 600.0, "c": 1200.0})
