"""Sources mixed to target weights by hash thresholds, in DataFrame operations only.

Every document has a key, a hash of its id and text. A source's target is met by whole passes
over the source and one pass over the documents whose key lies below a threshold. Thresholds
are found by histograms: words are summed by source and leading digits of the key, the bucket
in which the budget runs out is refined by further digits, and so on until it holds a single
document, which is taken if that comes nearer to the target. Nothing is sorted; after the
first histogram only documents of boundary buckets are read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alertloom.session import settle

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
DIGITS = 3  # hexadecimal digits of the key a histogram goes by: 4,096 buckets a source
KEY_DIGITS = 32 + 16

_WORD = r"[^\x20\x09-\x0D]+"

def _key() -> Column:
    """32 digits by id and text, then 16 that part rows alike in both.

    The latter number the rows as they are written; which of several equal rows is taken
    makes no difference. Low digits come first, as the high ones are mostly zero.
    """
    hashed = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(_text())))
    return F.concat(hashed, F.reverse(F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0")))


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _measured(docs: DataFrame, *kept: Column) -> DataFrame:
    return settle(
        docs.select(
            *kept,
            F.col("source").cast("string").alias("source"),
            F.regexp_count(_text(), F.lit(_WORD)).cast("long").alias("size"),
            _key().alias("key"),
        ),
        "mix-sizes",
    )


def targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """(source, source_size, target, passes, rest) from (source, source_size), one row a source.

    Sources by code point, null last, take the weights in turn. Targets are weight * level, cut
    at `most` times the source's size; the level is such that they add up to `share` of all
    sizes. In order of the level at which a source is cut, it is cut if the level that holds
    once all before it are cut goes past that. One row a source goes through one task.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int"))
    weighted = sizes.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy((F.col("most") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    budget = F.sum("source_size").over(everything) * F.lit(float(share))
    left = budget - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    levelled = weighted.withColumn("level", left / weight_left)
    cut = levelled.withColumn("cut", F.col("level") * F.col("weight") > F.col("most"))
    # The level of the first source that is not cut holds for all after it.
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = F.first(F.when(~F.col("cut"), F.col("level")), ignorenulls=True).over(whole)
    target = F.when(F.col("cut"), F.col("most")).otherwise(level * F.col("weight"))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    return (
        cut.select("source", "source_size", target.alias("target"))
        .withColumn("passes", passes.cast("int"))
        .withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
    )


def _common(low: Column, high: Column) -> Column:
    """The digits that two keys begin with alike."""
    upto = F.sequence(F.lit(1), F.lit(KEY_DIGITS))
    alike = F.filter(upto, lambda i: F.substring(low, F.lit(1), i) == F.substring(high, F.lit(1), i))
    return F.substring(low, F.lit(1), F.size(alike))


def cuts(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, last): of the rows (source, size, key), those up to key `last` meet the budget best.

    `budgets` is (source, rest); rest is above 0 and below the sum of the source's sizes. `last`
    is null if no row at all comes nearest. The number of rounds goes with the logarithm of the
    rows; a bucket of rows alike is left at once, by the digits that number them.
    """
    inside = rows.where(F.col("size") > 0)
    cells = settle(budgets.select("source", F.lit("").alias("prefix"), F.lit("").alias("below"), "rest"), "mix-cells")
    found = []
    for first in (True, *[False] * KEY_DIGITS):
        joined = inside.alias("r").join(
            cells.alias("c"),
            F.col("r.source").eqNullSafe(F.col("c.source")) & F.col("r.key").startswith(F.col("c.prefix")),
        )
        start = F.length("c.prefix") + 1
        held = joined.select("r.*", "c.prefix", "c.rest", "c.below", F.substring("key", start, F.lit(DIGITS)).alias("digits"))
        if not first:  # the boundary buckets alone: a small share of the rows
            held = settle(held, "mix-boundary")
        bars = held.groupBy("source", "digits").agg(
            F.sum("size").alias("words"),
            F.count("*").alias("n"),
            F.min("key").alias("low"),
            F.max("key").alias("high"),
            F.first("rest").alias("rest"),
            F.first("below").alias("below"),
        )
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("digits"))
        # The last key of the bars before, where there are some.
        lower = F.max("high").over(Window.partitionBy("source").orderBy("digits").rowsBetween(Window.unboundedPreceding, -1))
        bars = bars.select("*", upto.alias("upto"), F.coalesce(lower, F.col("below")).alias("lower"))
        met = bars.where((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("words") <= F.col("rest")))
        left = F.col("rest") - (F.col("upto") - F.col("words"))
        met = settle(met.select("source", "low", "high", "n", "words", "lower", left.alias("rest")), "mix-met")
        # One document: with it or without, by which is nearer.
        last = F.when(F.col("words") - F.col("rest") <= F.col("rest"), F.col("low")).otherwise(F.nullif("lower", F.lit("")))
        found.append(met.where("n = 1").select("source", last.alias("last")))
        cells = met.where("n > 1").select("source", _common(F.col("low"), F.col("high")).alias("prefix"), F.col("lower").alias("below"), "rest")
        if cells.isEmpty():
            break
        inside = rows.where(F.col("size") > 0) if first else held.select("source", "size", "key")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def planned(rows: DataFrame, **how) -> DataFrame:
    """The rows (source, size, key, ...) with `source_size`, `target` and `copies`: how often each is taken."""
    sums = settle(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    wanted = settle(targets(sums, **how), "mix-targets")
    ends = cuts(rows, wanted.where("rest > 0").select("source", "rest"))
    plan = wanted.alias("w").join(ends.alias("e"), F.col("w.source").eqNullSafe(F.col("e.source")), "left")
    plan = settle(plan.select("w.*", "e.last"), "mix-plan")
    once_more = F.coalesce(F.col("key") <= F.col("last"), F.lit(False)).cast("int")
    return (
        rows.alias("r")
        .join(plan.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source")))
        .select("r.*", "p.source_size", "p.target", (F.col("p.passes") + once_more).alias("copies"))
    )


def mix(docs: DataFrame, **how) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row; size is in words, a null text has none.

    taken is the size times the passes of the source, and once more for the documents that its
    last, partial pass takes; a source's words are off its target by half a document at most.
    Null ids and sources are values like others. Of rows alike in id and text as many are taken
    as the budget asks for. Sources without words have target 0, no rows give none.
    """
    rows = _measured(docs, F.col("doc_id").cast("long").alias("doc_id"))
    return planned(rows, **how).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken")
    )


def mixture(docs: DataFrame, **how) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with all their columns.

    Documents without words take part in whole passes alone.
    """
    rows = _measured(docs, F.struct("*").alias("doc"))
    times = F.sequence(F.lit(1), F.col("copies"))
    chosen = planned(rows, **how).where("copies > 0")
    return chosen.select("doc", F.explode(times)).select("doc.*")
