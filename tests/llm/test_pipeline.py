"""The stages over a small table, each held against its own operator's rules."""

import os
import random

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from test_llm import prose, table


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    chance = random.Random(44)
    clean = [prose(chance, chance.randint(80, 200)) for _ in range(40)]
    item = prose(chance, 30).replace("\n", " ")
    shared = "a line that many documents have in common today"
    texts = [t + "\n" + shared for t in clean]
    texts += [clean[0], clean[1] + "\n" + shared]  # copies
    texts += [prose(chance, 60) + " " + item + " " + prose(chance, 60)]  # leaked
    texts += ["too short", None, "la " * 200]  # junk
    path = tmp_path_factory.mktemp("small")
    table(spark, texts).write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(path / "benchmark.parquet"))
    return str(path), texts, shared


def test_stages_take_out_what_they_should(spark, folder):
    path, texts, shared = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, path)
        if name != "encoded":
            assert out.columns == docs.columns
        docs = out
        seen.append({r.doc_id for r in docs.collect()})
    assert seen[0] == set(range(43))  # the junk is gone
    assert seen[1] == seen[0]
    assert {40, 41} & seen[2] and len({40, 41} & seen[2]) == 1  # what is left of the copies is alike
    assert seen[2] >= set(range(40)) | {42}
    assert seen[3] == seen[2] - {42} and seen[4] == seen[3]
    after = corpus_pipeline.lines(spark, spark.read.parquet(f"{path}/documents.parquet"), path)
    assert sum(shared in (r.text or "") for r in after.collect()) == 1


def test_run_is_the_stages_in_turn(spark, folder):
    path = folder[0]
    assert entry.queries()["pipeline"](spark, path).count() == 41
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "benchmark_free", "encoded"]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test data")
def test_queries_are_registered_and_run(spark):
    named = [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()]
    assert len(named) == 10
    for name in named:
        df = entry.queries()[name](spark, "/root/testdata/sf0.001")
        assert "doc_id" in df.columns and df.count() >= 0
