"""Latest row, seeded picks and exact seeded samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertloom.functions import seeded
from alertloom.operators.clean import quoted

HEX_DIGITS = 3  # of the hash, per round of counting: 4,096 counts at most
CUT_ROWS = 1000


def latest(df: DataFrame, when: Column, ties: Sequence[Column], n: int = 1) -> DataFrame:
    """The n newest rows; rows without a date come last."""
    return df.orderBy(F.desc_nulls_last(when), *ties).limit(n)


def _by_key(keys: Sequence[str], seed: int | str) -> Column:
    return seeded.digest(*[quoted(k) for k in keys], seed=seed)


def _by_row(df: DataFrame, seed: int | str) -> Column:
    """Settles ties of the key."""
    return seeded.digest(*[quoted(c) for c in df.columns], seed=seed)


def pick_one(df: DataFrame, keys: Sequence[str], seed: int | str) -> DataFrame:
    """One row, chosen by seeded hash of its key: one candidate per task."""
    return df.orderBy(_by_key(keys, seed), _by_row(df, seed)).limit(1)


def sample_exact(
    df: DataFrame, n: int, keys: Sequence[str], seed: int | str = 42
) -> DataFrame:
    """Exactly n rows, or all of them if there are no more than n.

    The n rows with the least hashes are taken. Rows are counted by the leading
    digits of the key's hash, then again inside the bucket that holds the cut, by
    further digits, until that bucket is small; where one key fills it, by the hash
    of all columns. Each round of counts is bounded. The small bucket's hashes give
    the last hash taken, so the sample is a filter; only rows alike in all columns
    that the cut would part are counted out.
    """
    hash_, cut, left = _by_key(keys, seed), "", n
    inside = df
    while True:
        digits = len(cut) + HEX_DIGITS
        counts = inside.groupBy(F.substring(hash_, 1, digits).alias("bucket")).count().collect()
        rows_at_cut = None
        for bucket, rows in sorted((r["bucket"], r["count"]) for r in counts):
            if rows > left:
                cut, rows_at_cut = bucket, rows
                break
            left -= rows
        if rows_at_cut is None:
            return df
        inside = df.filter(F.startswith(hash_, F.lit(cut)))
        if rows_at_cut <= CUT_ROWS or len(cut) == 2 * seeded.DIGEST_DIGITS:
            break
        if len(cut) == seeded.DIGEST_DIGITS:
            hash_ = F.concat(_by_key(keys, seed), _by_row(df, seed))
    if len(cut) == 2 * seeded.DIGEST_DIGITS:  # rows alike in all columns
        return df.filter(hash_ < F.lit(cut)).unionByName(inside.limit(left))
    if left == 0:
        return df.filter(hash_ < F.lit(cut))
    both = F.concat(_by_key(keys, seed), _by_row(df, seed))
    held = sorted(r[0] for r in inside.select(both).collect())
    last = held[left - 1]
    if held[left:left + 1] != [last]:
        # Rows of other keys need no hash of all columns.
        key, at = _by_key(keys, seed), last[: seeded.DIGEST_DIGITS]
        return df.filter((key < F.lit(at)) | ((key == F.lit(at)) & (both <= F.lit(last))))
    below = left - held.index(last)
    return df.filter(both < F.lit(last)).unionByName(df.filter(both == F.lit(last)).limit(below))
