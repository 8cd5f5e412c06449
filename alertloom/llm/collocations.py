"""Phrase collocations by best-first branch and bound, over counts of contiguous words.

A phrase of count a that is cut into a first part of count l and a rest of count r scores
floor(1000 * a * n / (l * r)) by its lowest cut. As a is at most r, everything that grows from a
prefix of count l scores at most 1000 * n / l; the first word, the most frequent prefix, gives
the least bound. So first words are expanded best bound first, in batches: a batch's phrases are
grown through frequent prefixes and counted, scored and tested for survival, until the bound of
every word left is below the score of the language's last place, ties included. Most texts'
commonest words are never expanded.

Words are named by 64-bit hashes of language and word and phrases by their words' names; names
of frequent words are checked to be distinct. Tasks choose places to count by bitmaps of bounded
size: a bit set by chance costs rows, counts stay exact.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from alertloom.llm.bitmap import Bitmap
from alertloom.llm.text import BUFFER_BYTES, Buffer, combine, mix, signed
from alertloom.session import settle

LEAST = 100
LONGEST = 5
TOP = 2000
BATCH = 8  # first words of the first batch, as a multiple of the places asked for
STEP = 1.0  # occurrences of a later batch's words, as a multiple of those expanded before

_SEPARATORS = ".,;:!?\n\x0b\x0c\r"
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_LOWER[[ord(c) for c in _SEPARATORS]] = 0x0A
_CUT = re.compile(f"[{_SEPARATORS}]".encode())
_PLACES = [f"w{i}" for i in range(1, LONGEST + 1)]
_COUNTED = ", ".join(f"{p} long" for p in _PLACES) + ", n long"


class Words:
    """The words of some texts: their names, and how many more words their piece has."""

    def __init__(self, langs: list[str], texts: list[bytes]):
        self.buffer = buffer = Buffer(list(range(len(texts))), texts, _LOWER)
        self.langs = langs
        seeds = {lang: xxhash.xxh64_intdigest(lang.encode()) for lang in set(langs)}
        seed = np.array([seeds[lang] for lang in langs], dtype=np.uint64)
        names = mix(buffer.hash + seed[buffer.doc])
        names[names == 0] = 1  # zero stands for no word
        self.names = names
        piece = np.cumsum(buffer.bytes == 0x0A)[buffer.start] if len(names) else np.zeros(0, np.int64)
        self.left = np.searchsorted(piece, piece, side="right") - np.arange(len(names)) - 1

    def runs(self, width: int) -> np.ndarray:
        """Where runs of so many words in one piece begin."""
        return np.flatnonzero(self.left >= width - 1)

    def prints(self, width: int) -> np.ndarray:
        """One hash for the run of words that begins at each place, zero at the end."""
        hashes = combine(self.names, width)
        return np.concatenate([hashes, np.zeros(len(self.names) - len(hashes), np.uint64)])


def _parts(text: str, limit: int) -> Iterator[bytes]:
    """A long text's bytes, cut after separators, where no phrase passes."""
    data, start = text.encode("utf-8", "surrogatepass"), 0
    while len(data) - start > limit:
        cut = _CUT.search(data, start + limit)
        if not cut:
            break
        yield data[start : cut.end()]
        start = cut.end()
    yield data[start:]


def _words(batch: pa.RecordBatch, limit: int = BUFFER_BYTES) -> Iterator[Words]:
    langs, texts, size = [], [], 0
    for lang, text in zip(batch.column(0), batch.column(1)):
        name = lang.as_py()
        for part in _parts(text.as_py(), limit):
            if texts and size + len(part) > limit:
                yield Words(langs, texts)
                langs, texts, size = [], [], 0
            langs.append(name)
            texts.append(part)
            size += len(part) + 1
    if texts:
        yield Words(langs, texts)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


# --- counts ------------------------------------------------------------------


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, name, n) of every word; a language's sum of words has the empty word and name 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in _words(batch):
                if not len(words.names):
                    continue
                names, first, n = np.unique(words.names, return_index=True, return_counts=True)
                buffer = words.buffer
                start, end = buffer.start[first], buffer.end[first]
                offsets = np.concatenate([[0], np.cumsum(end - start)])
                at = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], end - start)
                spelled = pa.StringArray.from_buffers(
                    len(names), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(buffer.bytes[at])
                )
                langs = pa.array(words.langs)
                yield pa.record_batch(
                    {
                        "lang": langs.take(pa.array(buffer.doc[first])),
                        "word": spelled,
                        "name": pa.array(signed(names)),
                        "n": pa.array(n.astype(np.int64)),
                    }
                )
                spoken, sums = np.unique(np.array(words.langs, dtype=object)[buffer.doc], return_counts=True)
                yield pa.record_batch(
                    {
                        "lang": pa.array(list(spoken), pa.string()),
                        "word": pa.array([""] * len(spoken)),
                        "name": pa.array([0] * len(spoken), pa.int64()),
                        "n": pa.array(sums.astype(np.int64)),
                    }
                )

    counted = _texts(docs).mapInArrow(run, "lang string, word string, name long, n long")
    return counted.groupBy("lang", "word", "name").agg(F.sum("n").alias("n"))


def _tallied(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of word names, with how often each occurs among them."""
    if not len(rows):
        return
    rows = rows[np.lexsort(rows.T[::-1])]
    new = np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)])
    first = np.flatnonzero(new)
    columns = {p: pa.array(signed(np.ascontiguousarray(rows[first, i]))) for i, p in enumerate(_PLACES)}
    yield pa.record_batch({**columns, "n": pa.array(np.diff(np.append(first, len(rows))))})


def _phrases_at(words: Words, starts: np.ndarray, width: int) -> np.ndarray:
    rows = np.zeros((len(starts), LONGEST), np.uint64)
    for i in range(width):
        rows[:, i] = words.names[starts + i]
    return rows


def _count(docs: DataFrame, choose: Callable[[Words], Iterator[tuple[np.ndarray, int]]], least: int) -> DataFrame:
    """(p, n) of the phrases, as arrays of names, at the places that `choose` gives with their number of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in _words(batch):
                if len(words.names):
                    found = [_phrases_at(words, starts, width) for starts, width in choose(words)]
                    yield from _tallied(np.concatenate(found)) if found else ()

    rows = _texts(docs).mapInArrow(run, _COUNTED)
    counted = rows.groupBy(*_PLACES).agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return counted.select(F.filter(F.array(*_PLACES), lambda name: name != 0).alias("p"), "n")


def _prints(phrases: DataFrame) -> DataFrame:
    """The hash of each phrase `p`, as `Words.prints` makes it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            phrases = batch.column(0)
            sizes = np.diff(phrases.offsets.to_numpy())
            names = phrases.flatten().to_numpy().view(np.uint64)
            for width in set(sizes.tolist()):
                own = names[np.repeat(sizes == width, sizes)]
                yield pa.record_batch({"print": pa.array(signed(combine(own, width)[::width]))})

    return phrases.select("p").mapInArrow(run, "print long")


# --- growth ------------------------------------------------------------------


def _expand(docs: DataFrame, words: Bitmap, fresh: Bitmap, known: list[Bitmap], least: int) -> DataFrame:
    """All frequent phrases that begin with a fresh word.

    One pass counts pairs by a hash alone, most being rare; a second one counts what grows from
    the pairs that may be frequent, by the words' names.
    """

    def begins(texts: Words) -> np.ndarray:
        new = fresh.has(texts.names)
        for old in known:
            new &= ~old.has(texts.names)
        return new

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in _words(batch):
                starts = texts.runs(2)
                starts = starts[begins(texts)[starts]]
                starts = starts[words.has(texts.names[starts + 1])]
                prints, n = np.unique(texts.prints(2)[starts], return_counts=True)
                yield pa.record_batch({"print": pa.array(signed(prints)), "n": pa.array(n.astype(np.int64))})

    counted = _texts(docs).mapInArrow(pairs, "print long, n long").groupBy("print").agg(F.sum("n").alias("n"))
    frequent = Bitmap.of(settle(counted.where(F.col("n") >= least).select("print"), "phrases-pairs"))

    def grown(texts: Words) -> Iterator[tuple[np.ndarray, int]]:
        new = begins(texts)
        pair = frequent.has(texts.prints(2))
        # A pair whose first word is not fresh is not known here; its words at least are frequent.
        may = np.where(new, pair, words.has(texts.names))
        starts = texts.runs(2)
        starts = starts[new[starts]]
        for width in range(2, LONGEST + 1):
            starts = starts[texts.left[starts] >= width - 1]
            starts = starts[may[starts + width - 2] & words.has(texts.names[starts + width - 1])]
            yield starts, width

    return settle(_count(docs, grown, least), "phrases-grown")


def _lead_in(docs: DataFrame, found: DataFrame, words: Bitmap, known: list[Bitmap], least: int) -> DataFrame:
    """Counts that growth does not give, as they begin with words not expanded.

    The last parts of the phrases found, and the phrases with one word before.
    """
    size = F.size("p")
    tails = F.transform(F.sequence(F.lit(2), size - 1), lambda i: F.slice("p", i, size))
    ends = Bitmap.of(_prints(found.where(size > 2).select(F.explode(tails).alias("p")).distinct()))
    wholes = Bitmap.of(_prints(found.where(size < LONGEST)))

    def choose(texts: Words) -> Iterator[tuple[np.ndarray, int]]:
        outside = words.has(texts.names)
        for old in known:
            outside &= ~old.has(texts.names)
        for width in range(2, LONGEST + 1):
            starts = texts.runs(width)
            starts = starts[outside[starts]]
            wanted = np.zeros(len(starts), bool)
            if width < LONGEST:
                wanted |= ends.has(texts.prints(width)[starts])
            if width > 2:
                wanted |= wholes.has(texts.prints(width - 1)[starts + 1])
            yield starts[wanted], width

    return settle(_count(docs, choose, least), "phrases-lead-in")


# --- scores ------------------------------------------------------------------


def _score(a: Column, n: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """floor(1000 * a * n / (l * r)) in whole numbers of up to 38 digits."""
    over = (F.lit(1000).cast("decimal(4,0)") * a.cast("decimal(15,0)")) * n.cast("decimal(18,0)")
    return F.call_function("div", over, l.cast("decimal(19,0)") * r.cast("decimal(19,0)"))


def scored(words: DataFrame, counts: DataFrame, begun: DataFrame) -> DataFrame:
    """The surviving phrases that begin with a word of `begun`: p, lang, a, n, score, l, r.

    `counts` holds these phrases, their last parts and the phrases with a word more at either end,
    where those are frequent.
    """
    totals = words.where("name = 0").select("lang", F.col("n").alias("all"))
    singles = words.where("name != 0").select(F.array("name").alias("p"), "n")
    size = F.size("p")
    # A phrase goes if one with a word more, at either end, is as frequent.
    inner = F.explode(F.array(F.slice("p", F.lit(1), size - 1), F.slice("p", F.lit(2), size - 1))).alias("p")
    around = counts.where(size > 2).select("n", inner).groupBy("p").agg(F.max("n").alias("around"))
    mine = counts.withColumn("name", F.get("p", F.lit(0))).join(begun.select("name", "lang"), "name")
    left = mine.select("p", "lang", F.col("n").alias("a")).join(around, "p", "left")
    cuts = F.transform(
        F.sequence(F.lit(1), size - 1),
        lambda k: F.struct(k.alias("k"), F.slice("p", F.lit(1), k).alias("first"), F.slice("p", k + 1, size).alias("rest")),
    )
    cut = left.where("around IS NULL OR around < a").select("p", "lang", "a", F.inline(cuts))
    every = counts.unionByName(singles)
    firsts = every.select(F.col("p").alias("first"), F.col("n").alias("l"))
    rests = every.select(F.col("p").alias("rest"), F.col("n").alias("r"))
    valued = cut.join(firsts, "first").join(rests, "rest").join(totals, "lang").withColumnRenamed("all", "n")
    valued = valued.withColumn("score", _score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
    least = valued.groupBy("p", "lang", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    return least.select("p", "lang", "a", "n", "best.score", "best.l", "best.r")


def _last_place(found: DataFrame, top: int) -> DataFrame:
    """(lang, bar): the score of the last place, where a language has so many."""
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("score").desc()))
    return found.select("lang", "score", rank.alias("place")).where(F.col("place") <= top).where(
        F.col("place") == top
    ).select("lang", F.col("score").alias("bar"))


def _batch(left: DataFrame, totals: DataFrame, bars: DataFrame | None, first: int) -> DataFrame:
    """(lang, name) of the words to expand next: the rarest, unless nothing of theirs can enter.

    At first so many words; later as many occurrences as were expanded before, so that the number
    of batches goes with the logarithm of the text. Words are counted by frequency before they
    are put in order.
    """
    open_ = left.where("NOT done").join(totals, "lang")
    if bars is not None:
        bound = F.floor(F.lit(1000) * F.col("all") / F.col("n"))
        open_ = open_.join(bars, "lang", "left").where(F.col("bar").isNull() | (bound >= F.col("bar")))
    spent = left.where("done").groupBy("lang").agg(F.sum("n").alias("spent"))
    levels = open_.groupBy("lang", "n").agg(F.count("*").alias("held"))
    order = Window.partitionBy("lang").orderBy("n")
    levels = levels.join(spent, "lang", "left").select(
        "lang",
        "n",
        (F.sum("held").over(order) - F.col("held")).alias("words_before"),
        F.sum(F.col("held") * F.col("n")).over(order).alias("occurrences"),
        (F.col("spent") * STEP).alias("budget"),
        F.row_number().over(order).alias("level"),
    )
    starting = F.col("budget").isNull() & (F.col("words_before") < first)
    chosen = levels.where(starting | (F.col("occurrences") <= F.col("budget")) | (F.col("level") == 1))
    upto = chosen.groupBy("lang").agg(F.max("n").alias("upto"))
    return open_.join(upto, "lang").where("n <= upto").select("lang", "name")


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first `top` phrases.

    Ordered by score and count, highest first, then by the phrase's bytes. Phrases are 2 to 5
    words of a piece of text that occur `least` times or more; those inside a longer one that is
    as frequent are left out. A null lang counts as `und`, a null text as empty; ids and further
    columns are not read, repeated rows count each. No rows, or no such phrases, give none.
    """
    spark = docs.sparkSession
    words = settle(word_counts(docs).where((F.col("n") >= least) | (F.col("name") == 0)), "phrases-words")
    frequent = words.where("name != 0").select("lang", "name", "n")
    if frequent.groupBy("name").count().where("count > 1").limit(1).count():
        raise RuntimeError("two frequent words share a name")
    filter_ = Bitmap.of(frequent.select("name"))
    totals = words.where("name = 0").select("lang", F.col("n").alias("all"))
    left = frequent.withColumn("done", F.lit(False))
    counts, known, bars = None, [], None
    while True:
        fresh = settle(_batch(left, totals, bars, BATCH * top), "phrases-batch")
        if fresh.isEmpty():
            break
        bits = Bitmap.of(fresh.select("name"))
        grown = _expand(docs, filter_, bits, known, least)
        known.append(bits)
        done = left.join(fresh.select("name", F.lit(True).alias("now")), "name", "left")
        left = settle(done.select("lang", "name", "n", (F.col("done") | F.col("now").isNotNull()).alias("done")), "phrases-left")
        if not left.where("NOT done").isEmpty():
            grown = grown.unionByName(_lead_in(docs, grown, filter_, known, least))
        # A phrase may be counted in several rounds, each time in full.
        every = grown if counts is None else counts.unionByName(grown)
        counts = settle(every.groupBy("p").agg(F.max("n").alias("n")), "phrases-counts")
        survivors = settle(scored(words, counts, left.where("done")), "phrases-scored")
        bars = _last_place(survivors, top)
    if counts is None:
        return _nothing(spark)
    return _spelled(survivors, words, top)


def _nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [], "lang string, rank long, phrase string, a long, l long, r long, n long, score long"
    )


def _spelled(found: DataFrame, words: DataFrame, top: int) -> DataFrame:
    """The phrases up to each language's last place in words, ranked."""
    bars = _last_place(found, top)
    held = found.join(bars, "lang", "left").where("bar IS NULL OR score >= bar").drop("bar")
    names = held.select("p", F.posexplode("p").alias("at", "name"))
    spelled = names.join(words.select("name", "word"), "name").groupBy("p").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase")
    )
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    rank = F.row_number().over(order).cast("long")
    ranked = held.join(spelled, "p").withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
