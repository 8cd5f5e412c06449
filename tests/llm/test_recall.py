"""How many copies with random edits decontamination finds, by length of item, and all pairs of a small table."""

import random

import pytest

from alertloom.llm import decontamination as D
from alertloom.llm.text import buffers

SYLLABLES = ["the", "ra", "tion", "on", "er", "in", "st", "of", "ha", "wh", "ly", "é", "ou", "ing", "ble", "an"]


def word(chance):
    return "".join(chance.choice(SYLLABLES) for _ in range(chance.randint(1, 3)))


def prose(chance, words):
    return " ".join(word(chance) + chance.choice(["", "", "", ",", "."]) for _ in range(words))


def item(chance, low, high):
    while True:
        text = prose(chance, 60)[: chance.randint(low, high)].strip(" ")
        if low <= len(text.encode()) <= high:
            return text


def edited(chance, text, edits):
    letters = list(text)
    for at in sorted(chance.sample(range(len(letters)), edits), reverse=True):
        kind = chance.randrange(3)
        if kind == 0:
            letters[at] = chance.choice("abcdefgh ")
        elif kind == 1:
            del letters[at]
        else:
            letters.insert(at, chance.choice("abcdefgh "))
    return "".join(letters)


def found(items, docs):
    index, out = D.ItemIndex(list(enumerate(items)), D.SEED, D.SIMILARITY), set()
    for buffer in buffers(docs, D.TABLE):
        for doc, i, start in index.candidates(buffer).tolist():
            span = slice(int(buffer.doc_start[doc]), int(buffer.doc_end[doc]) - 1)
            if index.verify(buffer.bytes[span].tobytes(), i, start):
                out.add((buffer.rows[doc], i))
    return out


@pytest.mark.parametrize("low, high", [(12, 15), (16, 23), (24, 29), (30, 47), (48, 55), (56, 71), (72, 100), (100, 300)])
def test_recall_by_length(low, high):
    chance = random.Random(low)
    items = [item(chance, low, high) for _ in range(150)]
    for share, least in ((0.1, 0.9), (0.2, 0.65 if low < 16 else 0.82)):
        docs = [f"{prose(chance, 20)} {edited(chance, t, int(share * len(t)))} {prose(chance, 20)}" for t in items]
        hits = found(items, docs)
        assert sum((i, i) in hits for i in range(len(items))) >= least * len(items)
    for mark in ('"', "(", "Q:", "**"):
        docs = [f"{prose(chance, 20)} {mark}{t}{mark} {prose(chance, 20)}" for t in items]
        hits = found(items, docs)
        assert sum((i, i) in hits for i in range(len(items))) >= 0.99 * len(items)


def test_all_pairs_of_a_small_table(spark):
    chance = random.Random(8)
    items = [item(chance, 16, 160) for _ in range(25)]
    docs = []
    for i in range(60):
        parts = [prose(chance, 30)]
        if i % 3:
            t = items[i % 25]
            parts = [parts[0], edited(chance, t, chance.randint(0, len(t) // 6)), prose(chance, 25)]
        docs.append(" ".join(parts))
    truth = set()
    for d, doc in enumerate(docs):
        for i, t in enumerate(items):
            pattern = D.normal(t).strip(" ")
            edits, _ = D.best_end(pattern, D.normal(doc))
            if edits <= int((1 - D.SIMILARITY) * len(pattern) + 1e-9):
                truth.add((d, i))
    frame = spark.createDataFrame([(i, t, None, None, 0) for i, t in enumerate(docs)], "doc_id long, text string, lang string, source string, n_chars long")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in D.contaminated(frame, bench).collect()}
    assert got <= truth
    assert len(got) >= 0.9 * len(truth) and len(truth) >= 40
