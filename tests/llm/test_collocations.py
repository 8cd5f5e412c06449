"""Phrase collocations against plain counts, in several batches, and on awkward tables."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from alertloom.llm import collocations as C

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, "web", None) for i, (lang, t) in enumerate(rows)], SCHEMA)


def plain(rows, top, least):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, 6):
                for i in range(len(words) - m + 1):
                    counts[lang, tuple(words[i : i + m])] += 1
    held = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= least}
    dropped = set()
    for (lang, words), a in held.items():
        for m in range(2, len(words)):
            for i in range(len(words) - m + 1):
                if a >= counts[lang, words[i : i + m]]:
                    dropped.add((lang, words[i : i + m]))
    found = defaultdict(list)
    for (lang, words), a in held.items():
        if (lang, words) in dropped:
            continue
        best = min(
            (1000 * a * totals[lang] // (counts[lang, words[:k]] * counts[lang, words[k:]]), k) for k in range(1, len(words))
        )
        l, r = counts[lang, words[: best[1]]], counts[lang, words[best[1] :]]  # noqa: E741
        found[lang].append((-best[0], -a, " ".join(words).encode(), l, r))
    out = []
    for lang, phrases in found.items():
        for rank, (s, a, p, l, r) in enumerate(sorted(phrases)[:top], 1):  # noqa: E741
            out.append((lang, rank, p.decode(), -a, l, r, totals[lang], -s))
    return sorted(out)


def got(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


def corpus(seed, docs, langs=("en", "de", None)):
    chance = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["É", "é", "Ab", "aB", "x y"]
    idioms = [[f"i{k}{j}" for j in range(chance.randint(2, 7))] for k in range(8)]
    rows = []
    for _ in range(docs):
        parts = []
        for _ in range(chance.randint(0, 60)):
            at = min(len(words) - 1, int(chance.paretovariate(0.6)) - 1)
            parts += chance.choice(idioms) if chance.random() < 0.12 else [words[at]]
            if chance.random() < 0.1:
                parts[-1] += chance.choice([".", "!", "\n", "\x0b", " \t", ",,"])
        rows.append((chance.choice(langs), " ".join(parts)))
    return rows


@pytest.mark.parametrize("batch, step, top", [(8, 1, 2000), (1, 0.5, 6)])
def test_phrases_are_the_plain_ones(spark, monkeypatch, batch, step, top):
    monkeypatch.setattr(C, "BATCH", batch)
    monkeypatch.setattr(C, "STEP", step)
    rows = corpus(batch + top, 300)
    wanted = plain(rows, top, 12)
    assert wanted and got(C.collocations(table(spark, rows), top, 12)) == wanted


def test_words_that_cannot_enter_are_not_expanded(spark, monkeypatch):
    expanded = []
    expand = C._expand
    monkeypatch.setattr(C, "_expand", lambda docs, words, fresh, *rest: expanded.append(fresh) or expand(docs, words, fresh, *rest))
    monkeypatch.setattr(C, "BATCH", 5)
    chance = random.Random(9)
    common, rare = [f"c{i}" for i in range(40)], [f"r{i} s{i}" for i in range(9)]
    rows = [("en", " ".join(chance.choices(common, k=20))) for _ in range(400)] + [("en", ", ".join(rare))] * 13
    assert got(C.collocations(table(spark, rows), 3, 12)) == plain(rows, 3, 12)
    assert sum(int(np.bitwise_count(b.bits).sum()) for b in expanded) <= 18


def test_a_full_bitmap_changes_nothing(spark, monkeypatch):
    class Full(C.Bitmap):
        def has(self, hashes):
            return np.ones(len(hashes), bool)

        @classmethod
        def of(cls, hashes):
            return cls(np.zeros(1, np.uint64))

    rows = corpus(4, 120)
    monkeypatch.setattr(C, "Bitmap", Full)
    assert got(C.collocations(table(spark, rows), 50, 10)) == plain(rows, 50, 10)


def test_long_texts_are_cut_where_no_phrase_passes():
    text = "one two. three, four five\nsix" * 50 + " é" * 400
    parts = list(C._parts(text, 64))
    assert len(parts) > 5 and b"".join(parts) == text.encode()
    assert all(part[-1:] in (b".", b",", b"\n") for part in parts[:-1])


def test_scores_past_64_bits(spark):
    a, n, l, r = 10**14, 10**17, 3 * 10**14, 7 * 10**14  # noqa: E741
    row = spark.createDataFrame([(a, n, l, r), (100, 10**16, 100, 100)], "a long, n long, l long, r long")
    found = [x[0] for x in row.select(C._score(*[F.col(c) for c in "anlr"])).collect()]
    assert found == [1000 * a * n // (l * r), 1000 * 100 * 10**16 // 10**4]


def test_awkward_rows_and_tables(spark):
    rows = [(None, None), ("en", ""), ("en", " \t\n.!"), ("und", "a b " * 30), (None, "a b " * 30), ("fr", "é" * 50_000), ("en", "x")]
    rows += [("en", "same words here. " * 40)] * 3 + [("", "no lang, no lang\r" * 20)]
    df = table(spark, rows)
    assert got(C.collocations(df, 100, 15)) == plain(rows, 100, 15)
    clashing = df.selectExpr("*", "1 AS name", "2 AS word", "3 AS n", "'x' AS w1", "4 AS score")
    assert got(C.collocations(clashing, 100, 15)) == plain(rows, 100, 15)
    assert got(C.collocations(df.limit(0))) == []
    assert got(C.collocations(df, 100, 10**6)) == []
