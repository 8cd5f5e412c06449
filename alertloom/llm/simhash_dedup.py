"""SimHash near-duplicates of whole documents, found by multi-index hashing.

A document's fingerprint has a bit set where more than half of its shingles' hashes do.
Fingerprints link when few bits differ. To find the links, a fingerprint is cut into
segments; of two that link, some segment differs in at most distance // segments bits.
Every fingerprint is entered under the values of a small Hamming ball around each segment, so
that linked ones meet in a bucket, where complete distances are compared. Fewer, longer
segments mean more entries but fewer chance meetings: two segments suit up to some 10 ** 9
fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertloom.llm.graph import components, forest, spread
from alertloom.llm.rows import NAME, name_key, named
from alertloom.session import settle

WORDS = 4
DISTANCE = 4
SEED = 42
SEGMENTS = 2
EMPTY = 0


def fingerprint(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    """The fingerprint as a signed long; of a text without words (or null), 0.

    Letters A-Z are lowered, words are runs free of ASCII white space, shingles are joined
    by single spaces. A text of fewer words than a shingle is one shingle.
    """
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return EMPTY
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = (np.concatenate([[0], ends[:-1] + 1])).tolist()
    width = min(words, len(parts))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[s:e], seed) for s, e in zip(starts, ends[width - 1 :].tolist())),
        dtype="<u8",
        count=len(parts) - width + 1,
    )
    # In slices, so that a very long text needs no 64 bytes for each of its shingles at once.
    set_bits = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(bits, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    over = np.packbits(2 * set_bits > len(hashes), bitorder="little")
    return int(over.view("<i8")[0])


def with_fingerprints(docs: DataFrame, words: int = WORDS, seed: int = SEED) -> DataFrame:
    """Each row's document name and fingerprint `fp`; texts pass once through Python."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_py(), words, seed) for t in batch.column(3)]
            columns = [*batch.columns[:3], pa.array(prints, pa.int64())]
            yield pa.record_batch(columns, names=[*NAME, "fp"])

    return named(docs).select(*NAME, F.col("text").cast("string")).mapInArrow(
        run, "__id long, __null boolean, __hash long, fp long"
    )


def _bounds(segments: int) -> list[tuple[int, int]]:
    cuts = [64 * i // segments for i in range(segments + 1)]
    return list(zip(cuts, cuts[1:]))


def _balls(segments: int, radius: int) -> Column:
    """For each segment, its place and the bits changed in each value of the ball: a constant."""
    entries = []
    for segment, (low, high) in enumerate(_bounds(segments)):
        whole = (1 << (high - low)) - 1
        for size in range(radius + 1):
            for bits in combinations(range(high - low), size):
                change = sum(1 << b for b in bits)
                entries.append(f"named_struct('s',{segment},'low',{low},'whole',{_sql(whole)},'change',{_sql(change)})")
    return F.expr(f"array({','.join(entries)})")


def _sql(bits: int) -> str:
    value = bits - (1 << 64) if bits >> 63 else bits
    return f"{value}L" if value > -(1 << 63) else "(-9223372036854775807L - 1L)"


def _within(distance: int):
    def near(table):
        prints = np.array(table["id"], dtype=np.int64).view(np.uint64)

        def find(at, left):
            return left[np.bitwise_count(prints[left] ^ prints[at]) <= distance]

        return find

    return near


def links(prints: DataFrame, distance: int = DISTANCE, segments: int = SEGMENTS) -> DataFrame:
    """Links (a, b) between distinct fingerprints `fp`: all that their components need."""
    distinct = spread(prints.select("fp").where("fp IS NOT NULL").distinct())
    # Two values that differ in r bits have a value between them, r / 2 bits from either.
    radius = -(-(distance // segments) // 2)
    bucket = F.expr("xxhash64(ball.s, (shiftrightunsigned(fp, ball.low) & ball.whole) ^ ball.change)")
    members = distinct.select("fp", F.explode(_balls(segments, radius)).alias("ball")).select(
        bucket.alias("bucket"), F.col("fp").alias("id")
    )
    return forest(members, _within(distance))


def _grouped(docs: DataFrame, words: int, distance: int, segments: int) -> DataFrame:
    """Each row's name, fp, the root of its fingerprint's component, and component_id."""
    prints = settle(with_fingerprints(docs, words), "fingerprints")
    least = prints.groupBy("fp").agg(F.min(name_key()).alias("least"))
    nodes = components(links(prints, distance, segments))
    linked = least.join(nodes.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    heads = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(linked.join(heads, "root").drop("least"), "fp")


def near_groups(
    docs: DataFrame, words: int = WORDS, distance: int = DISTANCE, segments: int = SEGMENTS
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    component_id is the smallest doc_id reachable over links, the row's own included. Exact
    and other copies with equal fingerprints are one node of the graph. Texts without words,
    null ones too, share fingerprint zero. A row with a null doc_id joins its group, but a
    null names a group only if all its doc_ids are null. Repeated rows give repeated results.
    """
    return _grouped(docs, words, distance, segments).select(
        name_key(), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(
    docs: DataFrame, words: int = WORDS, distance: int = DISTANCE, segments: int = SEGMENTS
) -> DataFrame:
    """One row of `docs` for each group of near-duplicates, with all its columns.

    It is the row of the group's smallest doc_id (null comes last). Where rows with different
    texts repeat that doc_id, the one whose text hashes lowest stays.
    """
    groups = _grouped(docs, words, distance, segments)
    kept = groups.groupBy("root").agg(F.min(F.struct("__null", "__id", "__hash")).alias("row"))
    rows = named(docs).join(kept.select("row.*"), NAME, "left_semi")
    return rows.dropDuplicates(NAME).drop(*NAME)
