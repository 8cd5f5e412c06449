"""Conversation repair against a shortest path over single edits and a full chart, and on awkward tables."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from alertloom.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string"
SOLID = r"[^\x20\x09-\x0D]"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (1 + (kind == 3))
    digest = lambda r: hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).hexdigest()
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, digest(r)))


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        solid = re.findall(SOLID, text)
        if not solid:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if solid[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


STEPS = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(initials, marks):
    """Least (cost, audit) by a search over single edits."""
    queue, done = [(0, "", 0, "")], set()
    while queue:
        cost, audit, at, state = heapq.heappop(queue)
        if (at, state) in done:
            continue
        done.add((at, state))
        if at == len(initials) and state in ("", "a"):
            return cost, audit
        for c in "ua":
            if (state, c) in STEPS:
                heapq.heappush(queue, (cost + 2, audit + "I", at, STEPS[state, c]))
        if at < len(initials):
            heapq.heappush(queue, (cost + 3, audit + "D", at + 1, state))
            if marks[at] not in ("blank", "duplicate"):
                more = marks[at] == "truncated"
                for c in "ua":
                    if (state, c) in STEPS:
                        heapq.heappush(queue, (cost + 2 + more, audit + "R", at + 1, STEPS[state, c]))
                if (state, initials[at]) in STEPS:
                    heapq.heappush(queue, (cost + more, audit + "K", at + 1, STEPS[state, initials[at]]))


def full_chart(initials, marks):
    """Every span from every cut."""
    n = len(initials)
    cells = {}
    for size in range(1, n + 1):
        for i in range(n - size + 1):
            if size == 1:
                cells[i, 1] = C.row_cell(initials[i], marks[i] in ("blank", "duplicate"), marks[i] == "truncated")
                continue
            parts = [C.combined(cells[i, k], cells[i + k, size - k]) for k in range(1, size)]
            cells[i, size] = {key: min(p[key] for p in parts) for key in parts[0]}
            assert all(p == parts[0] for p in parts)
    return C.best(cells[0, n]) if n else (0, "")


def plain(table):
    out = {}
    rows = plain_damage(table)
    for conv in {r[0] for r in table}:
        own = [r for r in rows if r[0] == conv]
        marks, initials = faults(own), [r[2][:1] for r in own]
        turns = [r[1] for r in own if r[1] is not None]
        cost, audit = cheapest(initials, marks)
        lines, at = [], 0
        for edit in audit:
            if edit in "KR":
                lines.append(((own[at][2] if edit == "K" else None), own[at][3]))
            if edit == "I":
                lines.append((None, ""))
            at += edit != "I"
        start = bool(lines) and (lines[0][0] or "")[:1] == "s"
        named = [f"{role or ('user', 'assistant')[(i - start) % 2]}:{text}" for i, (role, text) in enumerate(lines)]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(marks.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(named).encode()).hexdigest(),
        )
    return out


def got(df):
    rows = df.collect()
    out = {r.conv_id: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


def table(seed, convs, longest):
    chance = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "User"]
    texts = ["Fine.", "And you?", "no end", "", " \t", None, "Ok!", "x. ", "日本."]
    rows = []
    for conv in [None, *range(convs)]:
        for turn in range(chance.randint(1, longest)):
            if chance.random() < 0.15:
                continue
            good = chance.random() < 0.6
            role = "system" if turn == 0 and chance.random() < 0.3 else ("user", "assistant")[turn % 2] if good else chance.choice(roles)
            text = f"Line {turn} of {conv}." if good else chance.choice(texts)
            rows.append((conv, None if chance.random() < 0.05 else turn, role, text))
    return rows


def test_all_short_sequences_are_repaired_at_least_cost():
    kinds = [("s", ""), ("u", ""), ("a", ""), ("x", ""), ("u", "truncated"), ("a", "blank")]
    for n in range(5):
        for rows in itertools.product(kinds, repeat=n):
            initials, marks = [r[0] for r in rows], [r[1] for r in rows]
            chart = C.Chart()
            for i, m in rows:
                chart.add(C.row_cell(i, m == "blank", m == "truncated"))
            assert C.best(chart.whole()) == cheapest(initials, marks)


@pytest.mark.parametrize("n", [9, 40])
def test_one_cut_a_span_gives_what_all_cuts_give(n):
    chance = random.Random(n)
    initials = [chance.choice("suaax") for _ in range(n)]
    marks = [chance.choice(["", "", "truncated", "blank", "duplicate"]) for _ in range(n)]
    chart, cells = C.Chart(), []
    for i, m in zip(initials, marks):
        cells.append(C.row_cell(i, m in ("blank", "duplicate"), m == "truncated"))
        chart.add(cells[-1])
    assert C.best(chart.whole()) == full_chart(initials, marks) == cheapest(initials, marks)
    assert "".join(piece for _, piece in C.split(cells)) == C.best(chart.whole())[1]


def test_repair_is_the_plain_one(spark):
    rows = table(1, 60, 12)
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(C.repair_damaged(df)) == plain(rows)
    assert got(C.repair_damaged(df.repartition(5))) == plain(rows)


def test_conversations_in_many_parts(spark, monkeypatch):
    rows = table(2, 3, 200)
    df = spark.createDataFrame(rows, SCHEMA)
    whole = got(C.repair_damaged(df))
    assert whole == plain(rows)
    monkeypatch.setattr(C, "_PART_BITS", 3)  # eight rows a part
    assert got(C.repair_damaged(df)) == whole
    repaired, totals = C.repair(C.damaged(df))
    lines = {}
    for r in repaired.orderBy("conv_id", "part", "at").collect():
        lines.setdefault(r.conv_id, []).append(r)
    for r in totals.collect():
        kept = lines.get(r.conv_id, [])
        assert "".join(x.edit for x in kept) == r.audit.replace("D", "")
        assert re.fullmatch("(s?(ua)+)?", "".join(x.role[:1] for x in kept))


def test_awkward_rows_and_tables(spark):
    rows = [(1, 0, "user", "Hi.")] * 4 + [(2, None, None, None), (2, None, None, None), (3, 5, "", ""), (None, None, "user", "x")]
    rows += [(4, 2**40, "assistant", "é" * 50_000 + " " * 50_000), (4, -3, "user", "a?"), (5, 1, "s", " "), (6, 1, "agent", "ok. ")]
    rows += [(conv, 0, "user", "Gone?") for conv in range(100, 140)]  # some lose all rows
    df = spark.createDataFrame(rows, SCHEMA)
    wanted = plain(rows)
    assert any(w[6] == "" for w in wanted.values())
    assert got(C.repair_damaged(df)) == wanted
    clashing = df.selectExpr("*", "1 AS kind", "2 AS rid", "3 AS part", "'x' AS digest", "4 AS copy", "5 AS state")
    assert got(C.repair_damaged(clashing)) == wanted
    assert C.repair_damaged(df.limit(0)).collect() == []
    rows, totals = C.repair(df.limit(0))
    assert rows.collect() == totals.collect() == []


def test_one_conversation_with_most_rows(spark):
    n = 20_000
    df = spark.range(n).select(
        (F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(-1))).alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        F.concat(F.lit("Line "), F.col("id").cast("string"), F.lit(".")).alias("text"),
    )
    out = got(C.repair_damaged(df.repartition(8)))
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in df.where("conv_id = -1").collect()]
    assert out[-1] == plain(rows)[-1]
