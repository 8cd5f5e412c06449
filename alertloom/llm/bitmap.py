"""Sets of hashes as bits of bounded size, for tasks to choose rows by.

A bit set by chance lets a row pass that is not wanted; none that is wanted is stopped.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_BITS = 1 << 27  # 16 MB
BITS_EACH = 16


def _bit(hashes: np.ndarray, size: int) -> np.ndarray:
    return hashes & np.uint64(size - 1)


class Bitmap:
    """A set of hashes as bits; its size goes with the set up to a fixed bound."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.size = bits, len(bits) * 64

    @classmethod
    def of(cls, hashes: DataFrame) -> Bitmap:
        """Of one column of longs. What comes to the driver is at most MOST_BITS."""
        column = F.col(hashes.columns[0])
        wanted = min(MOST_BITS, BITS_EACH * hashes.count())
        size = max(1 << 12, 1 << (wanted - 1).bit_length())
        place = column.bitwiseAND(F.lit(size - 1))
        blocks = hashes.groupBy(F.shiftright(place, 6).alias("block")).agg(
            F.bit_or(F.expr(f"shiftleft(1L, cast(`{hashes.columns[0]}` & 63 as int))")).alias("bits")
        )
        found = blocks.toArrow()
        bits = np.zeros(size // 64, np.uint64)
        bits[found["block"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
        return cls(bits)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = _bit(hashes, self.size)
        return (self.bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) != 0
