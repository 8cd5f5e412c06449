"""Repeatable stand-ins for random numbers and generated ids.

A value depends only on the seed and the row's own key, so a retried task, a
different partitioning and a different engine all give the same result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "|"
NULL_KEY = "~"
DIGEST_DIGITS = 32


def key_text(*keys: Column) -> Column:
    """Join key columns into one text; a null keeps its place."""
    return F.concat_ws(
        SEPARATOR, *[F.coalesce(k.cast("string"), F.lit(NULL_KEY)) for k in keys]
    )


def digest(*keys: Column, seed: int | str | None = None) -> Column:
    """md5 of the keys, prefixed by the seed if there is one."""
    text = key_text(*keys)
    if seed is not None:
        text = F.concat(F.lit(f"{seed}{SEPARATOR}"), text)
    return F.md5(text)


def hash_int(
    *keys: Column, seed: int | str | None = None, digits: int = 8
) -> Column:
    """Leading hex digits of the digest as a non-negative BIGINT; 15 at most."""
    head = F.substring(digest(*keys, seed=seed), 1, digits)
    return F.conv(head, 16, 10).cast("bigint")


def integer_between(low: int, high: int, *keys: Column, seed: int | str) -> Column:
    """A BIGINT in ``low..high``, both ends included."""
    return F.lit(low) + hash_int(*keys, seed=seed) % F.lit(high - low + 1)


def choice(options: Sequence[str], *keys: Column, seed: int | str) -> Column:
    """One of the options."""
    index = integer_between(1, len(options), *keys, seed=seed).cast("int")
    return F.element_at(F.array(*[F.lit(o) for o in options]), index)


def happens(share: float, *keys: Column, seed: int | str) -> Column:
    """True for about ``share`` of all keys."""
    return hash_int(*keys, seed=seed) % F.lit(1_000_000) < F.lit(
        round(share * 1_000_000)
    )
