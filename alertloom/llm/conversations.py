"""Repair of turn order in conversations by weighted interval parsing.

A repaired conversation's role initials read (s?(ua)+)?. Edits turn a conversation into such a
one: K keeps a row, R gives it the role user or assistant, D deletes it, I inserts an empty row.
The grammar's nonterminals name the state of the role sequence before and after a span:
0 at the start, 1 after system, 2 after user, 3 after assistant. In Chomsky normal form,
[p,q] -> [p,r] [r,q], and [p,q] yields a single row by an edit, closed under insertion on either
side. A cell holds the minimum (cost, audit) of each nonterminal over a span.

Cells are combined bottom-up by span length. As nonterminals name both ends' states, every cut
of a span yields the same cell, so a span of length 2m is combined from its two halves: the
chart has 2n cells rather than n * n / 2. Parts of a conversation are parsed by themselves, as
they stand in a global order, and their cells combined in turn, so that a conversation may have
more rows than any task holds. Of two audits of equal cost over one span none begins with the
other, as a letter more costs more; so least audits combine to the least one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from alertloom.session import settle

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
ROLES = {"u": "user", "a": "assistant"}

# Where an initial leads from a state, and what may be inserted from one state to another.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
STATES = range(4)
EMPTY = {(p, p): (0, "") for p in STATES} | {
    (0, 2): (INSERT, "I"),
    (1, 2): (INSERT, "I"),
    (2, 3): (INSERT, "I"),
    (3, 2): (INSERT, "I"),
    (0, 3): (2 * INSERT, "II"),
    (1, 3): (2 * INSERT, "II"),
}
Cell = dict[tuple[int, int], tuple]

_SPACES = " \t\n\x0b\x0c\r"
_LEGAL = {"su", "ua", "au"}
_PART_BITS = 33  # of a row number, below which rows of one part are counted
_FRAGMENT = (
    "conv_id long, part long, low long, high long, first_turn long, last_turn long, turns long, "
    "first string, last string, blank long, duplicate long, truncated long, illegal long, "
    "cells array<struct<p: int, q: int, cost: long, audit: string>>"
)
_PARSED = (
    "conv_id long, part long, state int, piece string, head boolean, gaps long, blank long, duplicate long, "
    "truncated long, illegal long, cost long, audit string"
)
_REPAIRED = "conv_id long, part long, at long, edit string, role string, text string"


# --- cells -------------------------------------------------------------------


def combined(left: Cell, right: Cell) -> Cell:
    """The cell of two spans in a row."""
    out: Cell = {}
    for (p, r), a in left.items():
        for q in STATES:
            b = right.get((r, q))
            if b is None:
                continue
            known = out.get((p, q))
            cost = a[0] + b[0]
            if known is None or cost < known[0] or (cost == known[0] and a[1] + b[1] < known[1]):
                out[p, q] = (cost, a[1] + b[1])
    return out


def _one_row(initial: str, faulty: bool, truncated: bool) -> Cell:
    edits: Cell = {(p, p): (DELETE, "D") for p in STATES}
    if not faulty:
        for (p, c), q in STEP.items():
            if c != "s" and (p, c) in STEP:
                edits[p, q] = (REROLE + TRUNCATED * truncated, "R")
        for (p, c), q in STEP.items():
            if c == initial:
                edits[p, q] = (KEEP + TRUNCATED * truncated, "K")
    return combined(combined(EMPTY, edits), EMPTY)


_rows: dict[tuple, Cell] = {}


def row_cell(initial: str, faulty: bool, truncated: bool) -> Cell:
    """The cell of one row, with what may be inserted before and after it."""
    key = (initial if initial in ("s", "u", "a") else "", faulty, truncated)
    if key not in _rows:
        _rows[key] = _one_row(*key)
    return _rows[key]


class Chart:
    """The cell of a growing span, by cells of lengths that are powers of two."""

    def __init__(self):
        self.cells: list[tuple[int, Cell]] = []

    def add(self, cell: Cell) -> None:
        self.cells.append((1, cell))
        while len(self.cells) > 1 and self.cells[-1][0] == self.cells[-2][0]:
            size, right = self.cells.pop()
            left = self.cells.pop()[1]
            self.cells.append((2 * size, combined(left, right)))

    def whole(self) -> Cell:
        out = None
        for _, cell in reversed(self.cells):
            out = cell if out is None else combined(cell, out)
        return EMPTY if out is None else out


def best(cell: Cell) -> tuple[int, str]:
    return min(cell[0, q] for q in (0, 3) if (0, q) in cell)


def split(cells: list[Cell]) -> list[tuple[int, str]]:
    """For each of some spans in a row: the state it begins in and its part of the best audit."""
    levels = [cells]
    while len(levels[-1]) > 1:
        below = levels[-1]
        pairs = [combined(below[i], below[i + 1]) for i in range(0, len(below) - 1, 2)]
        levels.append(pairs + below[len(below) - len(below) % 2 :])
    out: list[tuple[int, str]] = []

    def part(level: int, at: int, p: int, q: int) -> None:
        whole = levels[level][at][p, q]
        if level == 0:
            out.append((p, whole[1]))
        elif 2 * at + 1 == len(levels[level - 1]):
            part(level - 1, 2 * at, p, q)
        else:
            left, right = levels[level - 1][2 * at : 2 * at + 2]
            for r in STATES:
                a, b = left.get((p, r)), right.get((r, q))
                if a and b and a[0] + b[0] == whole[0] and a[1] + b[1] == whole[1]:
                    part(level - 1, 2 * at, p, r)
                    part(level - 1, 2 * at + 1, r, q)
                    return

    top = levels[-1][0]
    part(len(levels) - 1, 0, 0, min((q for q in (0, 3) if (0, q) in top), key=lambda q: top[0, q]))
    return out


# --- rows --------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with the rows' faults put in by crc32(conv_id:turn) % 20; nulls are a space."""
    spaced = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.encode(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")), "UTF-8")) % 20
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(spaced("role")).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(spaced("text"), "[.!?]", "")).otherwise(spaced("text")).alias("text"),
        kind.alias("kind"),
    )
    times = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.where("kind != 0").withColumn("copy", F.explode(times)).drop("kind", "copy")


def ordered(rows: DataFrame) -> DataFrame:
    """The rows in a global order by conversation and turn, nulls first, numbered as `rid`, with their faults.

    Rows of one turn go by a digest of role and text. Written once, so that the numbers hold. A
    conversation that is too long for one task of the sort has several parts, `part` in order.
    """
    solid = F.rtrim(F.col("text"), F.lit(_SPACES))
    digest = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))
    marked = rows.withColumns(
        {
            "initial": F.substring("role", 1, 1),
            "is_blank": solid == "",
            "is_truncated": (solid != "") & ~F.right(solid, F.lit(1)).isin(".", "!", "?"),
            "digest": digest,
        }
    )
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("digest").asc()]
    spread = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = spread.withColumn("rid", F.monotonically_increasing_id())
    held = settle(numbered, "conversation-rows")
    return held.withColumn("part", F.shiftright("rid", _PART_BITS))


def _groups(batches: Iterable[pa.RecordBatch], key: int) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Consecutive rows alike in the first `key` columns, read as they come."""

    def rows() -> Iterator[dict]:
        for batch in batches:
            yield from batch.to_pylist()

    source = rows()
    held = next(source, None)

    def of(name: tuple) -> Iterator[dict]:
        nonlocal held
        while held is not None and tuple(held.values())[:key] == name:
            row, held = held, None
            yield row
            held = next(source, None)

    while held is not None:
        name = tuple(held.values())[:key]
        group = of(name)
        yield name, group
        for _ in group:  # what the reader left
            pass


def _written(rows: Iterable[dict], kinds: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, kinds)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, kinds)


def _arrow(schema: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema))


def fragments(rows: DataFrame) -> DataFrame:
    """One row for each part of a conversation: its cells, counts and ends."""
    copies = rows.groupBy("conv_id", "digest").agg(F.min("rid").alias("earliest"), F.count("*").alias("n")).where("n > 1")
    narrow = rows.select("conv_id", "part", "rid", "turn", "initial", "is_blank", "is_truncated", "digest").alias("r")
    same = F.col("r.conv_id").eqNullSafe(F.col("c.conv_id")) & (F.col("r.digest") == F.col("c.digest"))
    repeated = ~F.col("is_blank") & F.coalesce(F.col("rid") > F.col("earliest"), F.lit(False))
    marked = narrow.join(copies.alias("c"), same, "left").select(
        "r.conv_id", "part", "rid", "turn", "initial", "is_blank", repeated.alias("is_copy"), "is_truncated"
    )

    kinds = _arrow(_FRAGMENT)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[dict]:
            for (conv, part), group in _groups(batches, 2):
                chart = Chart()
                out = dict(conv_id=conv, part=part, low=None, high=None, first_turn=None, last_turn=None, turns=0)
                out |= dict(first=None, last=None, blank=0, duplicate=0, truncated=0, illegal=0)
                for row in group:
                    turn, initial = row["turn"], row["initial"]
                    if out["first"] is None:
                        out["first"], out["first_turn"] = initial, turn
                    elif out["last"] + initial not in _LEGAL:
                        out["illegal"] += 1
                    if turn is not None:
                        out["turns"] += out["high"] != turn
                        out["low"] = turn if out["low"] is None else out["low"]
                        out["high"] = turn
                    out["last"], out["last_turn"] = initial, turn
                    cut = row["is_truncated"] and not row["is_copy"]
                    out["blank"] += row["is_blank"]
                    out["duplicate"] += row["is_copy"]
                    out["truncated"] += cut
                    chart.add(row_cell(initial, row["is_blank"] or row["is_copy"], cut))
                cells = chart.whole().items()
                out["cells"] = [dict(p=p, q=q, cost=c, audit=a) for (p, q), (c, a) in cells]
                yield out

        return _written(found(), kinds, 200)

    dealt = marked.repartition("conv_id", "part").sortWithinPartitions("conv_id", "part", "rid")
    return dealt.mapInArrow(parse, _FRAGMENT)


def parsed(rows: DataFrame) -> DataFrame:
    """For each part its state and piece of the audit; on a conversation's first part also its totals."""

    kinds = _arrow(_PARSED)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[dict]:
            for (conv,), group in _groups(batches, 1):
                parts = list(group)
                cells = [{(c["p"], c["q"]): (c["cost"], c["audit"]) for c in f["cells"]} for f in parts]
                pieces = split(cells)
                chart = Chart()
                for cell in cells:
                    chart.add(cell)
                cost, audit = best(chart.whole())
                sums = {k: sum(f[k] for f in parts) for k in ("blank", "duplicate", "truncated", "illegal", "turns")}
                for a, b in zip(parts, parts[1:]):
                    sums["illegal"] += a["last"] + b["first"] not in _LEGAL
                    sums["turns"] -= b["first_turn"] is not None and a["last_turn"] == b["first_turn"]
                lows = [f["low"] for f in parts if f["low"] is not None]
                highs = [f["high"] for f in parts if f["high"] is not None]
                turns = sums.pop("turns")
                totals = sums | dict(gaps=highs[-1] - lows[0] + 1 - turns if lows else 0, cost=cost, audit=audit)
                none = dict.fromkeys(totals)
                for i, (f, (state, piece)) in enumerate(zip(parts, pieces)):
                    yield dict(conv_id=conv, part=f["part"], state=state, piece=piece, head=i == 0) | (none if i else totals)

        return _written(found(), kinds, 200)

    dealt = fragments(rows).repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return dealt.mapInArrow(parse, _PARSED)


def repaired_rows(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """(conv_id, part, at, edit, role, text): the rows of the repaired conversations in order of part and at."""
    kept = rows.select("conv_id", "part", "rid", "role", "text", F.lit(None).cast("int").alias("state"), F.lit(None).cast("string").alias("piece"))
    heads = pieces.select("conv_id", "part", F.lit(-1).cast("long").alias("rid"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), "state", "piece")

    kinds = _arrow(_REPAIRED)

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[dict]:
            for (conv, part), group in _groups(batches, 2):
                head = next(group)  # the part's piece of the audit stands before its rows
                state, edits, at = head["state"], iter(head["piece"]), 0
                row = next(group, None)
                for edit in edits:
                    if edit == "D":
                        row = next(group, None)
                        continue
                    initial = "a" if state == 2 else "u"
                    role, text = ROLES[initial], ""
                    if edit != "I":
                        text = row["text"]
                        if edit == "K":
                            role, initial = row["role"], row["role"][:1]
                        row = next(group, None)
                    state = STEP[state, initial]
                    yield dict(conv_id=conv, part=part, at=at, edit=edit, role=role, text=text)
                    at += 1

        return _written(found(), kinds)

    both = kept.unionByName(heads)
    return both.repartition("conv_id", "part").sortWithinPartitions("conv_id", "part", "rid").mapInArrow(repair, _REPAIRED)


def _digests(rows: DataFrame) -> DataFrame:
    """(conv_id, sha) of each conversation's lines `role:text`, one row after the other."""
    schema = "conv_id long, sha string"
    kinds = _arrow(schema)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[dict]:
            for (conv,), group in _groups(batches, 1):
                sha, first = hashlib.sha256(), True
                for row in group:
                    line = f"{row['role']}:{row['text']}".encode("utf-8", "surrogatepass")
                    sha.update(line if first else b"\n" + line)
                    first = False
                yield dict(conv_id=conv, sha=sha.hexdigest())

        return _written(found(), kinds)

    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "part", "at")
    return dealt.select("conv_id", "role", "text").mapInArrow(digest, schema)


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The repaired rows of conversations (conv_id, turn, role, text), and what was found and done in each.

    The first as `repaired_rows` gives them; the second has conv_id, gaps, blank, duplicate,
    truncated, illegal, cost and audit for every conversation with a row. A null conv_id is a
    conversation like others, null turns come first, a null role or text must be made a value
    before. Of rows alike in turn, role and text the second is a duplicate. No rows give none.
    """
    rows = ordered(conversations)
    pieces = settle(parsed(rows), "conversation-pieces")
    totals = pieces.where("head").drop("part", "state", "piece", "head")
    return repaired_rows(rows, pieces), totals


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """Every conv_id with the counts, cost, audit and digest of its repair after `damaged`.

    A conversation whose rows are all gone has zeros, an empty audit and the digest of nothing.
    """
    rows, totals = repair(damaged(conversations))
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().alias("e")
    same = lambda name: F.col("e.conv_id").eqNullSafe(F.col(f"{name}.conv_id"))
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return (
        every.join(totals.alias("t"), same("t"), "left")
        .join(_digests(rows).alias("d"), same("d"), "left")
        .select(
            "e.conv_id",
            *[F.coalesce(F.col(f"t.{c}"), F.lit(0)).cast("long").alias(c) for c in counts],
            F.coalesce("t.audit", F.lit("")).alias("audit"),
            F.coalesce("d.sha", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
        )
    )
