"""Words, lines and hashes of many texts at once, in numpy.

Texts are laid end to end in one byte buffer of bounded size, so that one numpy call
serves hundreds of short documents. A single longer document is a buffer of its own:
texts are never cut. A buffer needs about 100 bytes of memory per byte of text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np

BUFFER_BYTES = 1 << 20
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
NEWLINE = 0x0A
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = {}


def _power(base: np.uint64, count: int) -> np.ndarray:
    """base ** 0 .. base ** (count - 1), wrapping."""
    known = _powers.get(base)
    if known is None or len(known) < count:
        known = np.full(max(count, BUFFER_BYTES + 1), base, dtype=np.uint64)
        known[0] = 1
        known = np.cumprod(known, dtype=np.uint64)
        if count <= 4 * BUFFER_BYTES:
            _powers[base] = known
    return known[:count]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole 64-bit word (the splitmix64 finaliser)."""
    z = values.astype(np.uint64, copy=True)
    z ^= z >> np.uint64(30)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return z


def combine(hashes: np.ndarray, width: int) -> np.ndarray:
    """One hash for each run of `width` consecutive hashes."""
    count = max(0, len(hashes) - width + 1)
    total = np.zeros(count, dtype=np.uint64)
    for shift in range(width):
        total = total * _BASE + hashes[shift : shift + count]
    return mix(total)


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Weighted sums of the bytes before each place, from which `run_hash` takes the hash of any run."""
    terms = (data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(data))
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])


def run_hash(sums: np.ndarray, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    """A hash of each run of bytes, the same wherever it stands."""
    span = (sums[start + length] - sums[start]) * _power(_INVERSE, len(sums) - 1)[start]
    return mix(span + np.asarray(length).astype(np.uint64))


class Buffer:
    """Some whole texts: bytes, and their words with document, line and hash."""

    def __init__(self, rows: list[int], texts: list[bytes], table: np.ndarray | None = None):
        self.rows = rows
        lengths = np.array([len(t) + 1 for t in texts], dtype=np.int64)
        self.doc_end = np.cumsum(lengths)  # after the separating line break
        self.doc_start = self.doc_end - lengths
        self.raw = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        self.bytes = self.raw if table is None else table[self.raw]
        solid = ~SPACE[self.bytes]
        # The last byte is a line break, so starts and ends pair up.
        self.start = np.flatnonzero(solid & ~np.concatenate([[False], solid[:-1]]))
        self.end = np.flatnonzero(~solid & np.concatenate([[False], solid[:-1]]))
        self.doc = np.searchsorted(self.doc_end, self.start, side="right")

    @cached_property
    def _breaks(self) -> np.ndarray:
        return np.flatnonzero(self.raw == NEWLINE)

    @cached_property
    def line(self) -> np.ndarray:
        """The line of each word, numbered through the buffer."""
        return np.searchsorted(self._breaks, self.start)

    @cached_property
    def first_line(self) -> np.ndarray:
        """The first line of each document."""
        return np.searchsorted(self._breaks, self.doc_start)

    @cached_property
    def hash(self) -> np.ndarray:
        """A hash of each word."""
        return run_hash(prefix_sums(self.bytes), self.start, self.end - self.start)

    def points(self) -> np.ndarray:
        """Code points before each byte."""
        return np.concatenate([[0], np.cumsum((self.raw & 0xC0) != 0x80)])

    def line_runs(self) -> tuple[np.ndarray, np.ndarray]:
        """First word, and word after the last, of each line that has words."""
        if not len(self.line):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        first = np.flatnonzero(np.diff(self.line, prepend=self.line[0] - 1))
        return first, np.append(first[1:], len(self.line))


def buffers(
    texts: Iterable[str | None], table: np.ndarray | None = None, limit: int = BUFFER_BYTES
) -> Iterator[Buffer]:
    """Group consecutive texts (null: empty) into buffers of about `limit` bytes."""
    rows, parts, size = [], [], 0
    for row, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass")
        if parts and size + len(data) > limit:
            yield Buffer(rows, parts, table)
            rows, parts, size = [], [], 0
        rows.append(row)
        parts.append(data)
        size += len(data) + 1
    if parts:
        yield Buffer(rows, parts, table)


def signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)
