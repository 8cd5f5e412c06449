"""Token counts of sections, from one encoding of each whole document.

A document is encoded once, as a whole, so that no section's start or end changes the
tokens. Each token covers a span of characters; an interval join of these spans with the
sections' spans gives every section its tokens. A token over a boundary goes by one rule:

    first     to the section that holds its first character (the default)
    majority  to the section with most of its bytes, the earlier one of equals
    split     to each section in proportion to its bytes

so that the counts of a document's sections add up to the document's count by any of them.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANKS = "byte_bpe_50k.tiktoken"
RULES = ("first", "majority", "split")
OUT_ROWS = 20_000
LONG_SPACE = re.compile(r"\s{10000}")


class OffsetEncoder:
    """Encodes texts to token ids and the bytes at which the tokens end."""

    def __init__(self, ranks_path: str, pattern: str):
        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding(
            "sections", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.pattern = regex.compile(pattern)
        self.lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for piece, rank in ranks.items():
            self.lengths[rank] = len(piece)

    def ends(self, text: str) -> np.ndarray:
        if LONG_SPACE.search(text):
            # The library's matcher runs out of stack on such runs; the same pattern elsewhere does not.
            parts = (m[0].encode("utf-8") for m in self.pattern.finditer(text))
            ids = [i for part in parts for i in self.encoding._encode_single_piece(part)]
        else:
            ids = self.encoding.encode_ordinary(text)
        return np.cumsum(self.lengths[np.array(ids, dtype=np.int64)])


@lru_cache(maxsize=2)
def encoder(ranks_path: str | None, pattern: str | None) -> OffsetEncoder:
    if ranks_path is None or pattern is None:
        import public_tokenizers

        ranks_path = ranks_path or public_tokenizers.path(RANKS)
        pattern = pattern or public_tokenizers.PATTERN
    return OffsetEncoder(ranks_path, pattern)


def line_sections(data: bytes) -> np.ndarray:
    """Section ends in bytes: every line with its break, white-space-only lines with the one before."""
    raw = np.frombuffer(data, dtype=np.uint8)
    ends = np.append(np.flatnonzero(raw == 0x0A) + 1, len(raw))
    if len(ends) > 1 and ends[-1] == ends[-2]:
        ends = ends[:-1]
    solid = np.concatenate([[0], np.cumsum(raw > 0x20)])[ends]
    filled = np.diff(solid, prepend=0) > 0
    # A section ends where the next filled one begins; leading blank lines join the first.
    order = np.cumsum(filled)
    last = np.append(order[1:] != order[:-1], True)
    last &= order > 0
    last[-1] = True
    return ends[last]


def attribute(token_ends: np.ndarray, section_ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section by the rule, and how many of them or their parts cross its bounds."""
    count = len(section_ends)
    starts = np.concatenate([[0], token_ends[:-1]])
    first = np.searchsorted(section_ends, starts, side="right")
    last = np.searchsorted(section_ends, token_ends - 1, side="right")
    crossing = first != last
    crossed = np.zeros(count, dtype=np.int64)
    whole = np.bincount(first[~crossing], minlength=count).astype(np.float64)
    bounds = np.concatenate([[0], section_ends])
    # Few tokens cross, and these one by one; each takes steps for the sections it touches.
    for i in np.flatnonzero(crossing).tolist():
        touched = np.arange(first[i], last[i] + 1)
        low = np.maximum(bounds[touched], starts[i])
        share = np.minimum(bounds[touched + 1], token_ends[i]) - low
        crossed[touched] += 1
        if rule == "first":
            whole[first[i]] += 1
        elif rule == "majority":
            whole[touched[np.argmax(share)]] += 1
        else:
            whole[touched] += share / share.sum()
    return whole, crossed


def section_tokens(
    docs: DataFrame,
    rule: str = "first",
    sections: Callable[[bytes], np.ndarray] = line_sections,
    ranks_path: str | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """(doc_id, section, start, end, n_tokens, n_crossing, doc_tokens), a row for each section.

    start and end are code points. `sections` gives the ends, in bytes, of the parts of a
    text; the last is the text's end. An empty or null text is one empty section of no
    tokens. Repeated rows and null doc_ids give rows of their own.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    def of(text: str) -> tuple[np.ndarray, ...]:
        data = text.encode("utf-8")
        ends = sections(data) if data else np.zeros(1, dtype=np.int64)
        token_ends = encoder(ranks_path, pattern).ends(text)
        if len(data) != (token_ends[-1] if len(token_ends) else 0):
            raise ValueError("tokens do not cover the text")
        counts, crossed = attribute(token_ends, ends, rule)
        points = np.concatenate(
            [[0], np.cumsum((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80)]
        )[np.concatenate([[0], ends])]
        return points[:-1], points[1:], counts, crossed, np.full(len(ends), len(token_ends))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, rows, size = [], [], 0
            for row, text in enumerate(batch.column(1)):
                held.append(of(text.as_py() or ""))
                rows.append(row)
                size += len(held[-1][0])
                if size >= OUT_ROWS:
                    yield _rows(batch, rows, held)
                    held, rows, size = [], [], 0
            if rows:
                yield _rows(batch, rows, held)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run,
        "doc_id long, section int, start long, end long, n_tokens double, n_crossing long, doc_tokens long",
    )


def _rows(batch: pa.RecordBatch, rows: list[int], held: list[tuple]) -> pa.RecordBatch:
    sizes = [len(h[0]) for h in held]
    columns = [np.concatenate(c) for c in zip(*held)]
    return pa.record_batch(
        {
            "doc_id": batch.column(0).take(pa.array(np.repeat(rows, sizes))),
            "section": pa.array(np.concatenate([np.arange(n) for n in sizes]), pa.int32()),
            "start": pa.array(columns[0], pa.int64()),
            "end": pa.array(columns[1], pa.int64()),
            "n_tokens": pa.array(columns[2], pa.float64()),
            "n_crossing": pa.array(columns[3], pa.int64()),
            "doc_tokens": pa.array(columns[4], pa.int64()),
        }
    )
