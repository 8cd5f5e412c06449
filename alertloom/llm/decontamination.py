"""Benchmark decontamination: CGK walks, bit-sampling LSH over windows, exact edit checks.

A CGK walk reads a text from some place and, at every step, notes the character under it and
then stays or moves on as a fixed random table says for that step and character. Texts at a
small edit distance fall in step again after each edit, so their walks agree at most steps:
edit distance becomes Hamming distance. A few steps are sampled and hashed to a key; equal
keys of a document's window and an item's make a candidate, and several independent walks
raise the recall. A window starts at any word, also behind punctuation, and is as long as the
item; the walk is followed for its first steps only, and items are entered from each of their
words on, so an edit spoils only the walks that cross it. Of a candidate a longer walk compares
what lies before and behind the place; then it is aligned with the whole item: the edits of
the best place in the item-sized window and its margin decide.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertloom.llm.rows import NAME, name_key, named
from alertloom.llm.text import SPACE, Buffer, buffers

SIMILARITY = 0.8
SEED = 7


@dataclass(frozen=True)
class Form:
    """Steps of a walk, how many of the early and the late ones are sampled, and for which items.

    A short walk meets fewer edits but more strangers. Walks and steps are those at which nine of
    ten items or more were found with a fifth of their letters edited at random, but for items of
    under 16 bytes and a few lengths (`tests/llm/test_recall.py`, README). Lengths are in bytes,
    `below` is not included; between two forms items have both.
    """

    early_steps: int
    early: int
    steps: int
    late: int
    walks: int
    least: int
    below: int


FORMS = (
    Form(14, 7, 34, 6, 8, 72, 1 << 60),
    Form(10, 6, 24, 6, 14, 24, 72),
    Form(6, 4, 12, 4, 20, 12, 48),
)
MIN_ITEM_BYTES = 12
# Steps of the walk, each way, that a candidate is tried by first, and the share that must agree.
CHECK_STEPS, CHECK_SHARE = 96, 0.33
# A walk moves at half of its steps or so: one that may run past the item's end is entered too.
REACH = 0.6
BLOCK_ITEMS, BLOCK_BYTES = 2000, 1 << 20
FILTER_BITS = 17
PLACES = 1 << 14  # walked at once: their arrays stay in a core's cache
_FACTOR = np.uint64(0x9E3779B97F4A7C15)

TABLE = np.arange(256, dtype=np.uint8)
TABLE[65:91] += 32
TABLE[[0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0x20
WINDOW = np.full(256, 2, dtype=np.int8)
WINDOW[[ord(c) for c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"]] = 1
WINDOW[SPACE] = 0
_LOWER = {c: c + 32 for c in range(65, 91)} | {c: 32 for c in (9, 10, 11, 12, 13)}


def normal(text: str) -> str:
    """Letters A-Z lowered, each ASCII white space a space: places stay as they are."""
    return text.translate(_LOWER)


@dataclass(frozen=True)
class Walk:
    """One random table, and the steps sampled early and late."""

    moves: np.ndarray  # [step, byte] -> 0 or 1
    early: tuple[int, ...]
    early_steps: int
    late: tuple[int, ...]
    steps: int

    @staticmethod
    def draw(form: Form, number: int, seed: int) -> Walk:
        early_steps, early, steps, late = form.early_steps, form.early, form.steps, form.late
        chance = np.random.default_rng([seed, steps, number])
        return Walk(
            chance.integers(0, 2, size=(steps, 256), dtype=np.int8).astype(np.int64),
            tuple(sorted(chance.choice(early_steps, early, replace=False).tolist())),
            early_steps,
            tuple(sorted((early_steps + chance.choice(steps - early_steps, late, replace=False)).tolist())),
            steps,
        )

    def _follow(self, data, at, key, first, last, sampled):
        for step in range(first, last):
            byte = data.take(at)
            if step in sampled:
                key = key * _FACTOR + byte
            if step + 1 < self.steps:
                at = at + self.moves[step].take(byte)
        return at, key

    def keys(
        self, data: np.ndarray, starts: np.ndarray, sets: list[np.ndarray], fill: bool = False
    ) -> tuple[np.ndarray, np.ndarray]:
        """(place among `starts`, key) of the walks that no set of leading bits stops, on the way or at the end.

        With `fill` the sets are filled instead: by the keys so far, after each part of the walk.
        """
        sampled = {*self.early, *self.late}
        left, at, key, first = np.arange(len(starts)), starts, np.ones(len(starts), np.uint64), 0
        for held, last in zip(sets, (self.early_steps * 4 // 7, self.early_steps, self.steps)):
            at, key = self._follow(data, at, key, first, last, sampled)
            lead, first = key >> np.uint64(64 - FILTER_BITS), last
            if fill:
                held[lead] = True
                continue
            kept = np.flatnonzero(held.take(lead))
            left, at, key = left.take(kept), at.take(kept), key.take(kept)
        return left, key


def _padded(buffer: Buffer) -> tuple[np.ndarray, np.ndarray]:
    """The bytes with room for a walk at the end, and where windows start.

    That is at words, and after punctuation, as a copy may stand in quotes or brackets.
    """
    begins = WINDOW[buffer.bytes]  # 0 white space, 1 punctuation, 2 others
    after = (begins[:-1] == 1) & (begins[1:] == 2)
    if len(after):
        after[buffer.start[buffer.start > 0] - 1] = True
    starts = np.flatnonzero(after) + 1
    if len(buffer.start) and buffer.start[0] == 0:
        starts = np.concatenate([[0], starts])
    longest = max(form.steps for form in FORMS)
    return np.concatenate([buffer.bytes, np.full(longest + 1, 0x20, np.uint8)]), starts


class Check:
    """Whether the surroundings of two aligned places agree, by one walk forwards and one backwards.

    Texts at the least similarity agree at about half of the steps that fall into the item,
    strangers at an eighth or so. It spares the alignment of most strangers.
    """

    def __init__(self, seed: int):
        chance = np.random.default_rng([seed, CHECK_STEPS])
        self.moves = chance.integers(0, 2, size=(CHECK_STEPS, 256), dtype=np.int8).astype(np.int64)

    def agreeing(
        self, text: np.ndarray, at: np.ndarray, items: np.ndarray, place: np.ndarray, first: np.ndarray, last: np.ndarray
    ) -> np.ndarray:
        """For each pair of places, whether enough steps agree; the item lies from `first` to before `last`."""
        same, seen = np.zeros(len(at), np.int32), np.zeros(len(at), np.int32)
        for way, start in ((1, 0), (-1, -1)):
            a, b = at + start, place + start
            for step in range(CHECK_STEPS):
                inside = (b >= first) & (b < last) & (a >= 0) & (a < len(text))
                x, y = text.take(a, mode="clip"), items.take(b, mode="clip")
                seen += inside
                same += inside & (x == y)
                moves = way * self.moves[step]
                a, b = a + moves.take(x), b + moves.take(y)
        return same >= CHECK_SHARE * seen


class ItemIndex:
    """Keys of a block of items for each walk; the block is bounded, so it goes to every task."""

    def __init__(self, items: list[tuple[int | None, str]], seed: int, similarity: float):
        self.ids = [i for i, _ in items]
        self.texts = [normal(t).strip(" ") for _, t in items]
        self.similarity = similarity
        data = [t.encode("utf-8", "surrogatepass") for t in self.texts]
        self.lengths = np.array([len(d) for d in data], dtype=np.int64)
        whole = Buffer(list(range(len(data))), data, TABLE)
        padded, starts = _padded(whole)
        doc = np.searchsorted(whole.doc_end, starts, side="right")
        offset, length = starts - whole.doc_start[doc], self.lengths[doc]
        self.tables, self.check = [], Check(seed)
        self.data, self.begin = whole.bytes, whole.doc_start
        for form in FORMS:
            of_form = (length >= form.least) & (length < form.below)
            chosen = np.flatnonzero(of_form & (offset + REACH * form.steps <= length))
            if not len(chosen):
                continue
            for number in range(form.walks):
                walk = Walk.draw(form, number, seed)
                sets = [np.zeros(1 << FILTER_BITS, dtype=bool) for _ in range(3)]
                _, key = walk.keys(padded, starts[chosen], sets, fill=True)
                order = np.argsort(key, kind="stable")
                self.tables.append(
                    (walk, sets, key[order], doc[chosen][order], offset[chosen][order])
                )

    def candidates(self, buffer: Buffer) -> np.ndarray:
        """Distinct (document, item, start of the item in bytes), the start rounded."""
        found = []
        data, starts = _padded(buffer)
        parts = [starts[i : i + PLACES] for i in range(0, len(starts), PLACES)]
        for (walk, sets, keys, item, offset), starts in itertools.product(self.tables, parts):
            # A window of which some part so far no item has cannot have an item's key.
            left, key = walk.keys(data, starts, sets)
            low, high = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            count = high - low
            hit = np.repeat(np.arange(len(left)), count)
            if not len(hit):
                continue
            entry = np.repeat(low, count) + np.arange(len(hit)) - np.repeat(np.cumsum(count) - count, count)
            found.append((starts[left[hit]].astype(np.int64), item[entry], offset[entry]))
        if not found:
            return np.zeros((0, 3), np.int64)
        at, item, offset = (np.concatenate(x) for x in zip(*found))
        first = self.begin[item]
        alike = self.check.agreeing(buffer.bytes, at, self.data, first + offset, first, first + self.lengths[item])
        at, item, offset = at[alike], item[alike], offset[alike]
        doc = np.searchsorted(buffer.doc_end, at, side="right")
        start = at - buffer.doc_start[doc] - offset
        margin = np.maximum(self.lengths[item] // 8, 4)
        return np.unique(np.stack([doc, item, np.floor_divide(start, margin) * margin], 1), axis=0)

    def verify(self, text: bytes, item: int, start: int) -> tuple[int, int, int] | None:
        """(edits, start, end in bytes) of the item at its best place near `start`, if near enough."""
        pattern = self.texts[item]
        allowed = int((1 - self.similarity) * len(pattern) + 1e-9)
        size = int(self.lengths[item])
        margin = size // 4 + 8
        low = max(0, start - margin)
        near = text[low : start + size + 2 * margin]
        while near and near[0] & 0xC0 == 0x80:
            low, near = low + 1, near[1:]
        window = near.decode("utf-8", "ignore")
        edits, end = best_end(pattern, window)
        if edits > allowed:
            return None
        back, length = best_end(pattern[::-1], window[:end][::-1])
        first = end - length
        return edits, low + len(window[:first].encode()), low + len(window[:end].encode())


def best_end(pattern: str, window: str) -> tuple[int, int]:
    """Fewest edits between the pattern and any part of the window, and where such a part ends.

    A column of the table at a time, as the bits of whole numbers; the first end of equals.
    """
    where: dict[str, int] = {}
    for i, c in enumerate(pattern):
        where[c] = where.get(c, 0) | 1 << i
    full, top = (1 << len(pattern)) - 1, 1 << (len(pattern) - 1)
    up, down, score = full, 0, len(pattern)
    best = (score, 0)
    for end, c in enumerate(window, 1):
        match = where.get(c, 0)
        level = ((match & up) + up ^ up) | match | down
        right, left = down | (full & ~(level | up)), up & level
        if right & top:
            score += 1
        elif left & top:
            score -= 1
        right, left = right << 1 & full, left << 1 & full
        diagonal = match | down
        up, down = left | (full & ~(diagonal | right)), right & diagonal
        if score < best[0]:
            best = (score, end)
    return best


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    """Items with enough text, a bounded block at a time."""
    block, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where(
        F.octet_length("text") >= MIN_ITEM_BYTES
    )
    for item, text in rows.toLocalIterator():
        if len(normal(text).strip(" ").encode("utf-8", "surrogatepass")) < MIN_ITEM_BYTES:
            continue
        if block and (len(block) >= BLOCK_ITEMS or size + len(text) > BLOCK_BYTES):
            yield block
            block, size = [], 0
        block.append((item, text))
        size += len(text)
    if block:
        yield block


SCHEMA = "__id long, __null boolean, __hash long, item_id long, start long, end long, edits int, similarity double"


def _search(rows: DataFrame, index: ItemIndex) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for buffer in buffers((t.as_py() for t in batch.column(3)), TABLE):
                best: dict[tuple[int, int], tuple] = {}
                for doc, item, start in index.candidates(buffer).tolist():
                    known = best.get((doc, item))
                    if known and known[0] == 0:
                        continue
                    span = slice(int(buffer.doc_start[doc]), int(buffer.doc_end[doc]) - 1)
                    found = index.verify(buffer.bytes[span].tobytes(), item, start)
                    if found and (known is None or found < known):
                        best[doc, item] = found
                if not best:
                    continue
                points = buffer.points()
                docs = [d for d, _ in best]
                base = points[buffer.doc_start[docs]]
                place = lambda i: points[buffer.doc_start[docs] + np.array([f[i] for f in best.values()])] - base
                edits = [f[0] for f in best.values()]
                rows = pa.array([buffer.rows[d] for d in docs])
                yield pa.record_batch(
                    {
                        **{n: batch.column(i).take(rows) for i, n in enumerate(NAME)},
                        "item_id": pa.array([index.ids[i] for _, i in best], pa.int64()),
                        "start": pa.array(place(1), pa.int64()),
                        "end": pa.array(place(2), pa.int64()),
                        "edits": pa.array(edits, pa.int32()),
                        "similarity": pa.array(
                            [1 - e / len(index.texts[i]) for e, (_, i) in zip(edits, best)], pa.float64()
                        ),
                    }
                )

    return rows.mapInArrow(run, SCHEMA)


def found_items(
    docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, seed: int = SEED
) -> DataFrame:
    """Each document's name and the benchmark items found in it: where, and at how many edits.

    similarity is 1 - edits / length of the item, in code points of the normal forms. Items
    are taken in bounded blocks, each block going once over all documents. Null and empty
    texts hold nothing; null, empty and very short items (under 12 bytes) are skipped; equal
    items with several ids are found under each; repeated rows are found each.
    """
    rows = named(docs).select(*NAME, F.col("text").cast("string"))
    found = None
    for block in _blocks(benchmark):
        part = _search(rows, ItemIndex(block, seed, similarity))
        found = part if found is None else found.unionAll(part)
    return found if found is not None else docs.sparkSession.createDataFrame([], SCHEMA)


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """(doc_id, item_id, start, end, edits, similarity): a row for each item found in a document."""
    return found_items(docs, benchmark, **options).select(
        name_key(), "item_id", "start", "end", "edits", "similarity"
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of `docs` in which no item is found, with all their columns."""
    bad = found_items(docs, benchmark, **options).select(*NAME).distinct()
    return named(docs).join(bad, NAME, "left_anti").drop(*NAME)
