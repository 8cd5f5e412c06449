"""Shards of near equal size by sampled splitters, in DataFrame operations only.

Records are ordered by a key. A sample drawn in proportion to size gives splitters, which cut
the order into many ranges; ranges that turn out overfull are sampled again and cut further,
by the tie-breaking columns too, so that a key with very many records spreads over ranges.
Each range is ordered within one task, and running sums over the ranges place every record.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alertloom.session import settle

SHARDS = 24
RANGES_PER_SHARD = 32  # at least
RANGE_BYTES = 256 << 20  # a range is meant to hold no more
MAX_RANGES = 1 << 16
SAMPLES_PER_RANGE = 16
OVERFULL = 3.0
ROUNDS = 4
OVERHEAD = 8


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, key, tie) of every row; a null text has no bytes.

    The key is a hash of the text, so equal texts stand together in the order and only a
    shard's bound can part them; the tie is a hash of the id.
    """
    data = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8")
    doc = F.col("doc_id").cast("long")
    return docs.select(
        doc.alias("doc_id"),
        (F.octet_length(data) + OVERHEAD).cast("long").alias("size"),
        F.crc32(data).cast("long").alias("text_crc32"),
        F.xxhash64(data).alias("key"),
        F.xxhash64(doc).alias("tie"),
    )


def _place() -> Column:
    return F.struct("key", "tie")


def _splitters(rows: DataFrame, total: int, ranges: int) -> list:
    """Quantiles, by size, of the order, from a sample drawn in proportion to size.

    A row is drawn if a hash of it falls below its share, so a repeated task draws the same.
    The sample's rows are weighted where a share is over one. Its size is bounded by the
    number of ranges, as is the list returned.
    """
    wanted = ranges * SAMPLES_PER_RANGE
    share = F.col("size") * F.lit(wanted / total)
    chance = F.pmod(F.xxhash64(F.lit("sample"), "key", "tie", "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = rows.where(chance < share).select("key", "tie", F.greatest(share, F.lit(1.0)).alias("weight"))
    upto = F.sum("weight").over(Window.orderBy("key", "tie").rowsBetween(Window.unboundedPreceding, 0))
    whole = F.sum("weight").over(Window.partitionBy())
    numbered = drawn.select(_place().alias("place"), F.floor(upto * ranges / whole).alias("q"))
    picks = numbered.groupBy("q").agg(F.min("place").alias("place")).where((F.col("q") > 0) & (F.col("q") < ranges))
    return [(r.place.key, r.place.tie) for r in picks.orderBy("q").collect()]


def _literal(places: list) -> Column:
    pairs = ",".join(f"named_struct('key',{_long(k)},'tie',{_long(t)})" for k, t in places)
    return F.expr(f"array({pairs})")


def _long(value: int) -> str:
    return f"{value}L" if value > -(1 << 63) else "(-9223372036854775807L - 1L)"


def _range_of(splitters: list) -> Column:
    """How many splitters are at or before the row's place, by two searches of about the root."""
    if not splitters:
        return F.lit(0)
    step = max(1, math.isqrt(len(splitters)))
    blocks = [splitters[i : i + step] for i in range(0, len(splitters), step)]
    before = lambda list_: F.size(F.filter(list_, lambda s: s <= _place()))
    coarse = before(_literal([b[0] for b in blocks]))
    fine = F.expr("array(" + ",".join(_sql(b) for b in blocks) + ")")
    inner = F.size(F.filter(F.get(fine, coarse - 1), lambda s: s <= _place()))
    return F.when(coarse == 0, F.lit(0)).otherwise((coarse - 1) * step + inner)


def _sql(places: list) -> str:
    return "array(" + ",".join(f"named_struct('key',{_long(k)},'tie',{_long(t)})" for k, t in places) + ")"


def ranged(rows: DataFrame, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """The rows with their `range`, and (range, bytes, records) of each range."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    if not total:
        return rows.withColumn("range", F.lit(0)), rows.groupBy(F.lit(0).alias("range")).agg(
            F.sum("size").alias("bytes"), F.count("*").alias("records")
        )
    ranges = min(MAX_RANGES, max(RANGES_PER_SHARD * shards, math.ceil(total / RANGE_BYTES)))
    limit = OVERFULL * total / ranges
    splitters = _splitters(rows, total, ranges)
    for round_ in range(ROUNDS + 1):
        placed = rows.withColumn("range", _range_of(splitters))
        measured = placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("records"))
        over = measured.where((F.col("bytes") > limit) & (F.col("records") > 1))
        again = [(r.range, r.bytes) for r in over.collect()] if round_ < ROUNDS else []
        if not again:
            break
        inside = placed.where(F.col("range").isin([r for r, _ in again]))
        held = sum(b for _, b in again)
        more = _splitters(inside, held, max(2 * len(again), math.ceil(2 * held * ranges / total)))
        if not set(more) - set(splitters):
            break
        splitters = sorted({*splitters, *more})
    return placed, measured


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row.

    Law `bytes`: a record belongs to the shard in which its first byte falls when all records,
    in order, are cut into equal lengths, so sizes differ by less than a record at each end.
    slot numbers a shard's records from 0. Rows alike in text and id take their turns in any
    order; null ids and texts are values like others; no rows give none.
    """
    rows = settle(sizes(docs), "sizes")
    placed, measured = ranged(rows, shards)
    # One row for each range: their number is bounded, so one task may sum them up.
    order = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = measured.select(
        "range",
        F.coalesce(F.sum("bytes").over(order), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("records").over(order), F.lit(0)).alias("records_before"),
        F.sum("bytes").over(Window.partitionBy()).alias("total"),
    )
    inside = Window.partitionBy("range").orderBy("key", "tie", "doc_id", "size")
    before = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = placed.select(
        "doc_id",
        "size",
        "text_crc32",
        "range",
        before.alias("inner_bytes"),
        (F.row_number().over(inside) - 1).alias("inner_row"),
    )
    located = numbered.join(F.broadcast(starts), "range").select(
        "doc_id",
        "size",
        "text_crc32",
        F.least(
            F.floor((F.col("bytes_before") + F.col("inner_bytes")).cast("decimal(38,0)") * shards / F.col("total")),
            F.lit(shards - 1),
        ).cast("int").alias("shard"),
        (F.col("records_before") + F.col("inner_row")).alias("position"),
    )
    located = settle(located, "located")
    firsts = located.groupBy("shard").agg(F.min("position").alias("first"))
    return located.join(F.broadcast(firsts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("position") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """The documents as files below `path`, a folder for each shard."""
    by_id = shard(docs, shards).groupBy("doc_id", "text_crc32").agg(F.min("shard").alias("shard"))
    named = docs.withColumn("__crc", F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")))
    named.alias("d").join(
        by_id.alias("s"),
        F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.__crc") == F.col("s.text_crc32")),
    ).select("d.*", "s.shard").drop("__crc").write.partitionBy("shard").parquet(path)
