"""Toxicity by compression distance: two zstandard dictionaries and calibrated thresholds.

One dictionary is trained on ordinary text, the other on the stretches of toxic text that
ordinary text lacks. A text's windows are compressed with the ordinary dictionary alone and
with both, and each window's saving in bytes is compared with a row of thresholds. What a
document's windows save becomes a probability by a logistic fit on labelled documents that
the dictionaries have not seen. Nothing but the text goes into a score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW_WORDS = 16
LEVEL = 3
ORDINARY_BYTES, TOXIC_BYTES = 31 * 1024, 1024
THRESHOLDS = (1, 2, 3, 4, 5, 6)
GRAM = 5
MARK_SHARE, MARK_RATIO = 0.015, 6.0
# The labelled rows to learn from are bounded: so many of each kind for the dictionaries, and
# again for the calibration, none of them longer than this.
DICTIONARY_TOXIC, DICTIONARY_ORDINARY = 1000, 2000
CALIBRATION_TOXIC, CALIBRATION_ORDINARY = 1000, 3000
MAX_SAMPLE_CHARS = 32_768
FOLDS = 5


def windows(text: str | None) -> list[bytes]:
    """The lowered text in consecutive windows of some words; without words, one empty window."""
    words = (text or "").lower().encode("utf-8", "surrogatepass").split()
    return [b" ".join(words[i : i + WINDOW_WORDS]) for i in range(0, len(words), WINDOW_WORDS)] or [b""]


def _spaced(text: str) -> bytes:
    return b" " + b" ".join(text.lower().encode("utf-8", "surrogatepass").split()) + b" "


def _grams(data: bytes) -> set[bytes]:
    """Byte runs of a fixed length that lie in one word, its bounds included."""
    found = {data[i : i + GRAM] for i in range(len(data) - GRAM + 1)}
    return {g for g in found if b" " not in g[1:-1]}


def toxic_stretches(toxic: list[str], ordinary: list[str]) -> list[bytes]:
    """Stretches of the toxic texts made of runs that far more toxic than ordinary texts have."""
    often = Counter(g for t in toxic for g in _grams(_spaced(t)))
    usual = Counter(g for t in ordinary for g in _grams(_spaced(t)))
    marked = {
        g
        for g, n in often.items()
        if n >= max(2, MARK_SHARE * len(toxic))
        and n / len(toxic) > MARK_RATIO * (usual[g] + 2) / (len(ordinary) + 1)
    }
    found = []
    for text in toxic:
        data = _spaced(text)
        start, end = 0, -1
        for i in range(len(data) - GRAM + 1):
            if data[i : i + GRAM] in marked:
                if i > end:
                    if end > 0:
                        found.append(data[start:end])
                    start = i
                end = i + GRAM
        if end > 0:
            found.append(data[start:end])
    return found


def _trained(samples: list[bytes], size: int, segment: int) -> bytes:
    """The content of a trained dictionary; of too few samples to train on, themselves."""
    samples = [s for s in samples if s]
    try:
        content = zstandard.train_dictionary(size + 400, samples, k=segment, d=6, steps=1).as_bytes()
    except zstandard.ZstdError:
        content = b"".join(samples)
    return content[-size:]


@dataclass(frozen=True)
class Model:
    """Two dictionaries, and the weights that turn a text's savings into a probability."""

    ordinary: bytes = b""
    toxic: bytes = b""
    centre: tuple[float, ...] = ()
    scale: tuple[float, ...] = ()
    weights: tuple[float, ...] = field(default=(0.0,))  # the first stands alone

    def score(self, text: str | None) -> float:
        value = self.weights[0]
        if len(self.weights) > 1:
            x = (features(text, self) - np.array(self.centre)) / np.array(self.scale)
            value += float(np.dot(x, self.weights[1:]))
        return float(1 / (1 + np.exp(-np.clip(value, -30, 30))))


@lru_cache(maxsize=4)
def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL,
        dict_data=dictionary,
        write_content_size=False,
        write_dict_id=False,
        write_checksum=False,
    )


def features(text: str | None, model: Model) -> np.ndarray:
    alone = _compressor(model.ordinary).compress
    both = _compressor(model.ordinary + model.toxic).compress
    saved = np.array([len(alone(w)) - len(both(w)) for w in windows(text)], dtype=np.float64)
    over = (saved[:, None] >= np.array(THRESHOLDS)).sum(axis=0)
    return np.concatenate(
        [
            [saved.mean(), saved.max(), np.sort(saved)[-2:].mean(), np.maximum(saved, 0).mean()],
            np.log1p(over),
            over / len(saved),
            [np.log(len(saved))],
        ]
    )


def _log_odds(share: float) -> float:
    return float(np.log(np.clip(share, 1e-6, 1 - 1e-6) / (1 - np.clip(share, 1e-6, 1 - 1e-6))))


def logistic(design: np.ndarray, y: np.ndarray, weight: np.ndarray, start: float) -> np.ndarray:
    """Weights of a logistic fit, all but the first drawn to zero, by Newton's steps from ``start``.

    A step that would make the fit worse is halved until it does not: a whole step from a point
    where most rows are already told apart can go far past the best one, and never come back.
    """
    drawn = np.r_[0.0, np.ones(design.shape[1] - 1)]

    def worth(at: np.ndarray) -> float:
        z = design @ at
        return float(weight @ (y * z - np.logaddexp(0, z)) - (drawn * at) @ at / 2)

    fit = np.zeros(design.shape[1])
    fit[0] = start
    reached = worth(fit)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ fit, -500, 500)))
        slope = design.T @ (weight * (y - p)) - drawn * fit
        bend = design.T @ (design * (weight * p * (1 - p))[:, None])
        step = np.linalg.solve(bend + np.diag(np.where(drawn > 0, 1.0, 1e-6)), slope)
        while (now := worth(fit + step)) < reached and np.abs(step).max() >= 1e-9:
            step = step / 2
        if now < reached:
            break
        fit, reached = fit + step, now
        if np.abs(step).max() < 1e-6:
            break
    return fit


def train(
    toxic: list[str], ordinary: list[str], toxic_check: list[str], ordinary_check: list[str], share: float
) -> Model:
    """A model from texts for the dictionaries, others to calibrate on, and the share of toxic ones.

    Without texts of both kinds for either, every score is that share.
    """
    if not (toxic and ordinary and toxic_check and ordinary_check):
        return Model(weights=(_log_odds(share),))
    usual = _trained([w for t in ordinary for w in windows(t)], ORDINARY_BYTES, 32)
    rude = _trained(toxic_stretches(toxic, ordinary), TOXIC_BYTES, 8)
    model = Model(usual or b" ", rude or b" ")
    x = np.array([features(t, model) for t in [*toxic_check, *ordinary_check]])
    y = np.repeat([1.0, 0.0], [len(toxic_check), len(ordinary_check)])
    # Each kind weighs as much as it does among all labelled rows, so that scores are frequencies.
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    design = np.column_stack([np.ones(len(x)), (x - centre) / scale])
    fit = logistic(design, y, weight, _log_odds(share))
    return Model(usual or b" ", rude or b" ", tuple(centre), tuple(scale), tuple(fit))


def fold(key: Column) -> Column:
    """crc32 of the id as text, modulo the number of folds; rows of fold 0 are held out."""
    return F.pmod(F.crc32(F.coalesce(key.cast("long").cast("string"), F.lit(""))), F.lit(FOLDS))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from labelled rows outside fold 0.

    Which rows is settled by a hash of the id, on ids alone; only their texts are fetched,
    and their number is bounded by the four limits above. Of labels that repeat an id the
    highest counts; null labels and ids do not.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .where(fold(F.col("doc_id")) != 0)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    usable = known.join(
        texts.where((F.length("text") > 0) & (F.length("text") <= MAX_SAMPLE_CHARS)).select("doc_id").distinct(),
        "doc_id",
    )
    share = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    limits = {
        1: (DICTIONARY_TOXIC, CALIBRATION_TOXIC),
        0: (DICTIONARY_ORDINARY, CALIBRATION_ORDINARY),
    }
    parts: dict[int, list[str]] = {}
    for kind, (first, second) in limits.items():
        ids = [
            r.doc_id
            for r in usable.where(F.col("toxic") == kind)
            .orderBy(F.xxhash64("doc_id"), "doc_id")
            .limit(first + second)
            .select("doc_id")
            .collect()
        ]
        # Of few rows the dictionaries get as large a part as of many.
        cut = min(first, len(ids) * first // (first + second))
        chosen = texts.where(F.col("doc_id").isin(ids)).groupBy("doc_id").agg(F.min("text").alias("text"))
        by_id = {r.doc_id: r.text for r in chosen.collect()} if ids else {}
        parts[kind] = [[by_id[i] for i in ids[:cut]], [by_id[i] for i in ids[cut:]]]
    return train(parts[1][0], parts[0][0], parts[1][1], parts[0][1], share or 0.0)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; null and empty texts are scored too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(t.as_py()) for t in batch.column(2)]
            yield pa.record_batch(
                {
                    "doc_id": batch.column(0),
                    "held_out": batch.column(1),
                    "score": pa.array(scores, pa.float64()),
                    "predicted": pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                }
            )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    ).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the labelled rows and score every row."""
    return score(docs, fit(docs, labels))
