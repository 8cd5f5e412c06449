"""Links between records that share a bucket, and the connected groups they form."""

from __future__ import annotations

from collections.abc import Callable, Generator, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertloom.session import settle, unsettle

BLOCK = 2000
# Members and characters of small groups that are compared at once.
SIDE_BY_SIDE, CHARACTERS = 48000, 1 << 23
NO_EDGES = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the least node it reaches.

    Alternates the large-star and small-star steps: every node hangs its larger, then all,
    neighbours below the least one it knows, until nothing changes. Each round is a grouped
    minimum and a join, written to the shared folder. Null ends and loops are dropped; an
    empty table gives an empty table.
    """
    now = settle(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a > b")
        .distinct(),
        "links",
    )
    mark = _mark(now)
    while mark[0]:
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.join(least, "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
            .distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        last, now = now, settle(small.unionAll(least.toDF("a", "b")).where("a > b").distinct(), "links")
        unsettle(last)
        before, mark = mark, _mark(now)
        if before == mark:
            break
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        roots.select("node", F.col("node").alias("root"))
    )


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def spread(rows: DataFrame) -> DataFrame:
    """The rows dealt to as many tasks as a shuffle has, before each of them turns into many."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def shared_buckets(members: DataFrame) -> DataFrame:
    """Members of the buckets that hold two or more, with the bucket's size as `members`.

    Only such buckets are on the join's hashed side, and most hold one member: nothing is sorted.
    """
    sizes = members.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    return members.join(sizes.hint("shuffle_hash"), "bucket")


def forest(
    members: DataFrame,
    near: Callable[[dict[str, list]], Callable[[int, np.ndarray], np.ndarray]],
    block: int = BLOCK,
) -> DataFrame:
    """Links (a, b) that connect the members of each bucket exactly as all near pairs would.

    `members` holds a long `bucket`, a long `id`, and the columns that `near` reads. From a
    group's columns `near` makes a function that, for one member and the positions still
    unreached, gives those positions that are near it.
    A bucket is walked breadth first, so it yields fewer links than it has members, however
    many pairs are near. One of more than `block` members is dealt into blocks, and each
    pair of blocks is a group of its own: no task holds more than two blocks of a bucket.
    Groups are found in sorted rows, so that small ones cost little.
    """
    return walked(dealt(members, block), near)


GROUP = ["bucket", "low", "high"]


def dealt(members: DataFrame, block: int = BLOCK) -> DataFrame:
    """Members of shared buckets with the group, or groups, that they are walked in: `bucket`, `low`, `high`."""
    payload = [c for c in members.columns if c != "bucket"]
    return (
        shared_buckets(members)
        .withColumn("blocks", F.ceil(F.col("members") / block).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .where("blocks = 1 OR own != other")
        .select("bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), *payload)
    )


def walked(rows: DataFrame, near, many: bool = False) -> DataFrame:
    """Links of the groups of `dealt`, whose rows may have got more columns for `near` since.

    With `many`, `near` makes the links of a list of groups at once.
    """
    rows = rows.repartition(*GROUP).sortWithinPartitions(*GROUP)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = _groups(batches, GROUP)
        for links in _walk_many(groups, near) if many else (_walk(table, near) for table in groups):
            if links:
                a, b = zip(*links)
                yield pa.record_batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.mapInArrow(walk, "a long, b long")


def _groups(batches, group: list[str]) -> Iterator[dict[str, list]]:
    """The payload of each run of rows with equal keys, across batches; lone rows are left out."""
    held, key = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = [batch.column(g).to_numpy(zero_copy_only=False) for g in group]
        change = np.zeros(batch.num_rows, dtype=bool)
        for v in values:
            change[1:] |= v[1:] != v[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        rest = [c for c in batch.schema.names if c not in group]
        for start, stop in zip(cuts, cuts[1:]):
            this = tuple(v[start] for v in values)
            if held is not None and this == key:
                for c in rest:
                    held[c].extend(batch.column(c).slice(start, stop - start).to_pylist())
                continue
            if held is not None and len(held["id"]) > 1:
                yield held
            # A group of one row can only go on if it is the last of its batch.
            if stop - start == 1 and stop < batch.num_rows:
                held = None
                continue
            held = {c: batch.column(c).slice(start, stop - start).to_pylist() for c in rest}
            key = this
    if held is not None and len(held["id"]) > 1:
        yield held


Links = list[tuple[int, int]]


def _steps(ids: list[int]) -> Generator[tuple[int, np.ndarray], np.ndarray, Links]:
    """A breadth-first walk that asks which of some positions are near a member, and is told."""
    links: Links = []
    left = np.arange(len(ids))
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            at = queue.pop()
            found = yield at, left
            if len(found):
                links.extend((ids[at], ids[i]) for i in found.tolist() if ids[i] != ids[at])
                queue.extend(found.tolist())
                left = np.setdiff1d(left, found, assume_unique=True)
    return links


def _walk(table: dict[str, list], near) -> Links:
    steps, find = _steps(table["id"]), near(table)
    try:
        asked = next(steps)
        while True:
            asked = steps.send(find(*asked))
    except StopIteration as end:
        return end.value


def _walk_many(groups: Iterator[dict[str, list]], near) -> Iterator[Links]:
    """The links of the groups, of many small ones at a time."""
    held: list[dict[str, list]] = []
    members = size = 0
    for table in groups:
        held.append(table)
        members += len(table["id"])
        size += sum(len(x) for c in table.values() for x in c if isinstance(x, str))
        if members >= SIDE_BY_SIDE or size >= CHARACTERS:
            yield near(held)
            held, members, size = [], 0, 0
    if held:
        yield near(held)
