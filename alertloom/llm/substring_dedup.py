"""Substring dedup: paragraphs by MinHash banding, exact checks, connected groups.

Two kinds of paragraph are taken from each text: its lines, to which count the stretches between
blank lines as a whole, as lines may be wrapped; and passages of a fixed number of words that start wherever a word's hash is the least of its neighbourhood, so that a passage
copied into the middle of another text yields paragraphs equal to its own. Equal paragraphs
are one class. Lines that are nearly equal share a band of MinHashes with high probability;
the members of a bucket are compared by exact Jaccard similarity of their five-word shingles.
A passage needs one band only, its whole content: one changed word inside it already leaves
a similarity under the threshold. Of each connected group the first occurrence stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from alertloom.llm.bitmap import Bitmap
from alertloom.llm.graph import components, forest, shared_buckets
from alertloom.llm.rows import NAME, named
from alertloom.llm.text import Buffer, buffers, combine, mix, signed
from alertloom.session import release, settle

SHINGLE = 5
SIMILARITY = 0.8
BANDS, BAND_ROWS = 9, 3  # a pair at the threshold shares a band in 998 of 1000 cases
MIN_WORDS = SHINGLE
# A run of 51 words that two texts share holds a passage of both: 20 words that start at the
# least hash of 32 neighbouring starts.
PASSAGE_WORDS, PASSAGE_SPREAD = 20, 32
LINE, PASSAGE = 0, 1
SEED = 11
TEXT_BLOCK = 500


def _factors(count: int) -> tuple[np.ndarray, np.ndarray]:
    chance = np.random.default_rng(SEED)
    top = np.iinfo(np.uint64).max
    return (
        chance.integers(1, top, count, dtype=np.uint64) | np.uint64(1),
        chance.integers(0, top, count, dtype=np.uint64),
    )


def _passage_starts(buffer: Buffer) -> np.ndarray:
    """First words of passages: each is the least, by hash, of a window of starts of one document."""
    hashes, doc, words = buffer.hash, buffer.doc, PASSAGE_WORDS
    starts = np.flatnonzero(doc[: len(doc) - words + 1] == doc[words - 1 :]) if len(doc) >= words else np.zeros(0, int)
    if not len(starts):
        return starts
    # The hash of a start is of its next words, so that common words do not win everywhere.
    value = combine(hashes, 3)[starts]
    of = doc[starts]
    picked = np.zeros(len(starts), dtype=bool)
    width = PASSAGE_SPREAD
    if len(starts) >= width:
        windows = np.lib.stride_tricks.sliding_window_view(value, width)
        whole = of[: len(of) - width + 1] == of[width - 1 :]
        least = np.arange(len(windows)) + windows.argmin(axis=1)
        picked[least[whole]] = True
    # A document with fewer starts than a window gives its least one.
    first = np.flatnonzero(np.diff(of, prepend=-1))
    count = np.diff(np.append(first, len(of)))
    for a, n in zip(first[count < width].tolist(), count[count < width].tolist()):
        picked[a + int(np.argmin(value[a : a + n]))] = True
    return starts[picked]


def _joined_lines(buffer: Buffer, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word, and word after the last, of stretches of several lines, in documents with blank lines between."""
    line, doc = buffer.line[first], buffer.doc[first]
    new = np.ones(len(first), dtype=bool)
    new[1:] = (line[1:] > line[:-1] + 1) | (doc[1:] != doc[:-1])
    starts = np.flatnonzero(new)
    stops = np.append(starts[1:], len(first))[: len(starts)]
    parted = np.bincount(doc[starts], minlength=len(buffer.rows)) > 1
    chosen = (stops - starts > 1) & parted[doc[starts]]
    return first[starts[chosen]], last[stops[chosen] - 1]


def _line_bands(shingles: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """[line, band]: a hash of each band's least values over the shingles of the line."""
    a, b = _factors(BANDS * BAND_ROWS)
    # Shingles that lie inside a line, line after line.
    inside = np.concatenate([np.arange(f, e - SHINGLE + 1) for f, e in zip(first.tolist(), last.tolist())])
    offsets = np.concatenate([[0], np.cumsum(last - first - SHINGLE + 1)[:-1]])
    values = shingles[inside]
    bands = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(first), 1))  # tells the bands apart
    for k in range(BANDS * BAND_ROWS):
        least = np.minimum.reduceat(values * a[k] + b[k], offsets)
        bands[:, k // BAND_ROWS] = bands[:, k // BAND_ROWS] * np.uint64(0x100000001B3) + least
    return mix(bands)


SCHEMA = (
    "__id long, __null boolean, __hash long, kind tinyint, start int, end int, "
    "k1 long, k2 long, bands array<long>"
)


def paragraphs(docs: DataFrame, min_words: int = MIN_WORDS, only: Bitmap | None = None) -> DataFrame:
    """Every paragraph: its document's name, code points, identity `k1`, `k2`, and a line's bands.

    Paragraphs of fewer words than `min_words`, or than a shingle, are left out. With `only`, a
    set of `k1`, others are left out too, but for a few, and there are no bands.
    """
    least_words = max(min_words, SHINGLE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for buffer in buffers(t.as_py() for t in batch.column(3)):
                first, last = buffer.line_runs()
                more_first, more_last = _joined_lines(buffer, first, last)
                first, last = np.concatenate([first, more_first]), np.concatenate([last, more_last])
                long = last - first >= least_words
                first, last = first[long], last[long]
                starts = _passage_starts(buffer)
                if not len(first) and not len(starts):
                    continue
                kinds = np.repeat([LINE, PASSAGE], [len(first), len(starts)])
                bands = np.zeros((0, BANDS), np.uint64)
                if len(first) and only is None:
                    bands = _line_bands(combine(buffer.hash, SHINGLE), first, last)
                begin = np.concatenate([first, starts])
                stop = np.concatenate([last, starts + PASSAGE_WORDS])
                data, digest = buffer.hash.tobytes(), xxhash.xxh3_128_digest
                whole = np.frombuffer(
                    b"".join(digest(data[8 * a : 8 * b]) for a, b in zip(begin.tolist(), stop.tolist())),
                    dtype=np.int64,
                ).reshape(-1, 2)
                if only is not None:
                    wanted = only.has(np.ascontiguousarray(whole[:, 0]).view(np.uint64))
                    begin, stop, whole, kinds = begin[wanted], stop[wanted], whole[wanted], kinds[wanted]
                doc = buffer.doc[begin]
                points = buffer.points()
                base = points[buffer.doc_start[doc]]
                rows = pa.array(np.array(buffer.rows)[doc])
                sizes = np.concatenate([[0], np.where(kinds == LINE, BANDS, 0) * (only is None)])
                yield pa.record_batch(
                    {
                        **{n: batch.column(i).take(rows) for i, n in enumerate(NAME)},
                        "kind": pa.array(kinds, pa.int8()),
                        "start": pa.array(points[buffer.start[begin]] - base, pa.int32()),
                        "end": pa.array(points[buffer.end[stop - 1]] - base, pa.int32()),
                        "k1": pa.array(whole[:, 0]),
                        "k2": pa.array(whole[:, 1]),
                        "bands": pa.ListArray.from_arrays(
                            pa.array(np.cumsum(sizes), pa.int32()), pa.array(signed(bands.ravel()))
                        ),
                    }
                )

    return named(docs).select(*NAME, F.col("text").cast("string")).mapInArrow(run, SCHEMA)


def _similar(similarity: float):
    """Compare the shingle sets of a group's lines; each set is made once."""

    def near(table):
        sets = [shingle_set(t) for t in table["text"]]
        sizes = np.array([len(s) for s in sets])

        def find(at, left):
            one = sets[at]
            # Sets of too different sizes cannot be similar enough.
            low, high = similarity * len(one), len(one) / similarity
            likely = left[(sizes[left] >= low - 1e-9) & (sizes[left] <= high + 1e-9)]
            found = []
            for i in likely.tolist():
                both = len(one & sets[i])
                if both >= similarity * (len(one) + len(sets[i]) - both) - 1e-9:
                    found.append(i)
            return np.array(found, dtype=np.int64)

        return find

    return near


def shingle_set(text: str) -> set[tuple[str, ...]]:
    words = [w.decode("utf-8", "replace") for w in text.encode("utf-8").split()]
    return {tuple(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)}


def near_links(docs: DataFrame, lines: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) between `k1` of distinct lines; texts are fetched only for shared buckets."""
    entries = lines.select("k1", F.explode("bands").alias("bucket"))
    members = settle(shared_buckets(entries).drop("members"), "band-members")
    release(docs.sparkSession)
    wanted = lines.select("k1", "row").join(members.select("k1").distinct().hint("shuffle_hash"), "k1")
    wanted = wanted.groupBy(*[F.col(f"row.{c}").alias(c) for c in NAME]).agg(
        F.collect_list(F.struct("k1", "row.start", "row.end")).alias("wanted")
    )
    texts = (
        named(docs)
        .select(*NAME, F.col("text").cast("string").alias("all"))
        .join(wanted.hint("shuffle_hash"), NAME)
        .select("all", F.explode("wanted").alias("w"))
        .select(
            "w.k1",
            F.col("all").substr(F.col("w.start") + 1, F.col("w.end") - F.col("w.start")).alias("text"),
        )
        .dropDuplicates(["k1"])  # of rows alike in doc_id and text
    )
    rows = members.select("bucket", F.col("k1").alias("id")).join(
        settle(texts, "band-texts").withColumnRenamed("k1", "id"), "id"
    )
    return forest(rows, _similar(similarity), TEXT_BLOCK)


def repeats(docs: DataFrame, similarity: float = SIMILARITY, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, kept_doc_id, n_spans, n_chars, spans) for documents with repeated paragraphs.

    A row for each document and each document that holds the occurrence which stays; spans
    are the code points to remove, `start:end`, overlapping ones joined. A later occurrence in the
    same document counts too, unless it overlaps the one which stays. Occurrences are ordered by doc_id, null last, then
    place; rows alike in doc_id and text are one document. Null and empty texts have none.
    """
    # Read twice rather than kept: most paragraphs occur once, and only names are needed of the others.
    found = paragraphs(docs, min_words)
    row = F.struct("__null", "__id", "__hash", "start", "end")
    place = F.xxhash64(*NAME, "start")
    classes = found.groupBy("k1", "k2", "kind").agg(
        F.min(row).alias("row"), F.min(place).alias("low"), F.max(place).alias("high"), F.first("bands").alias("bands")
    )
    # Most passages occur once; their classes end here.
    classes = settle(classes.where((F.col("kind") == LINE) | (F.col("low") != F.col("high"))), "paragraph-classes")
    release(docs.sparkSession)  # every paragraph went through that shuffle
    lines = classes.where(F.col("kind") == LINE).drop("low", "high")
    roots = components(near_links(docs, lines, similarity)).select(F.col("node").alias("k1"), "root")
    near = lines.drop("bands").join(roots, "k1")
    heads = near.groupBy("root").agg(F.min("row").alias("head"))
    near = near.join(heads, "root").select("k1", "k2", "kind", "head")
    # A class is of interest if it has a near one, or occurs twice.
    exact = classes.where("low != high").select("k1", "k2", "kind", "row")
    heads = exact.join(near, ["k1", "k2", "kind"], "full").select(
        "k1", "k2", "kind", F.coalesce("head", "row").alias("head")
    )
    heads = settle(heads, "paragraph-heads")
    release(docs.sparkSession)
    spans = (
        paragraphs(docs, min_words, Bitmap.of(heads.select("k1")))
        .drop("bands")
        .join(heads.hint("shuffle_hash"), ["k1", "k2", "kind"])
        .where("__id != head.__id OR __null != head.__null OR __hash != head.__hash OR start >= head.end")
        .select(*NAME, F.col("head.__id").alias("kept_id"), F.col("head.__null").alias("kept_null"), "start", "end")
    )
    # Spans that overlap or touch are one; linear in their number.
    pair = [*NAME, "kept_id", "kept_null"]
    ordered = Window.partitionBy(*pair).orderBy("start", "end")
    reached = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    parts = (
        spans.withColumn("new", F.when(reached >= F.col("start"), 0).otherwise(1))
        .withColumn("part", F.sum("new").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*pair, "part")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy(*pair)
        .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    )
    return parts.select(
        F.when(~F.col("__null"), F.col("__id")).alias("doc_id"),
        F.when(~F.col("kept_null"), F.col("kept_id")).alias("kept_doc_id"),
        "spans",
    ).select(
        "doc_id",
        "kept_doc_id",
        F.size("spans").cast("long").alias("n_spans"),
        F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"]).alias("n_chars"),
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias("spans"),
    )
