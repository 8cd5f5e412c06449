"""Choosing what a run takes in: terms, caps, keys seen before, first-wins."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alertloom.fixed import records as fixed
from alertloom.functions import text
from alertloom.operators.normalize import URL

TERM = "term"
TERM_RANK = "term_rank"
CAP_PARTS = 64


def _literals(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def first_terms(terms: Sequence[str], limit: int | None) -> list[str]:
    """The leading terms of a list; all of them if there is no limit."""
    return list(terms if limit is None else terms[:limit])


def match_terms(
    df: DataFrame, values: Column, terms: Sequence[str], every: bool = True
) -> DataFrame:
    """One row per record and search term among the record's values.

    With ``every`` off, one row per matching record, for its first term. Case
    does not matter. The terms are a short list fixed by configuration, so they
    are matched inside the row; a table of terms would be joined instead.
    """
    wanted = _literals([t.lower() for t in terms])
    hits = F.array_intersect(wanted, F.transform(values, lambda v: F.lower(v)))
    if every:
        out = df.withColumn(TERM, F.explode(hits))
    else:
        out = df.withColumn(TERM, F.get(hits, F.lit(0)))
        out = out.filter(F.col(TERM).isNotNull())
    return out.withColumn(TERM_RANK, F.array_position(wanted, F.col(TERM)))


def match_term_table(df: DataFrame, values: Column, terms: DataFrame) -> DataFrame:
    """The same for a table of ``term`` and ``term_rank``, of any size.

    A term listed twice counts once, with its lowest rank. Spark broadcasts the
    terms when their size allows it.
    """
    ranked = terms.groupBy(F.lower(TERM).alias(TERM)).agg(
        F.min(TERM_RANK).alias(TERM_RANK)
    )
    lowered = F.array_distinct(F.transform(values, lambda v: F.lower(v)))
    return df.withColumn(TERM, F.explode(lowered)).join(ranked, TERM)


def _named_values(terms: Sequence[str], column: Callable[[str], str]) -> Column:
    """A row's values of the fields that terms of the form ``field:value`` name, in that form."""
    fields = list(dict.fromkeys(t.split(":", 1)[0] for t in terms))
    return F.array(*[F.concat(F.lit(f"{field}:"), F.col(column(field))) for field in fields])


def match_trials(
    trials: DataFrame, limit: int | None = None, every: bool = True
) -> DataFrame:
    """Trials in a wanted status whose conditions include a search condition."""
    section = F.col("protocolSection")
    wanted = trials.filter(
        section["statusModule"]["overallStatus"].isin(*fixed.TRIAL_STATUSES)
    )
    conditions = section["conditionsModule"]["conditions"]
    terms = first_terms(fixed.TRIAL_CONDITIONS, limit)
    return match_terms(wanted, conditions, terms, every)


def match_events(
    reports: DataFrame, limit: int | None = None, every: bool = True
) -> DataFrame:
    """Reports with a wanted reaction, then those with a flag of seriousness set."""
    reactions = F.coalesce(F.col("patient.reaction.reactionmeddrapt"), F.array().cast("array<string>"))
    flags = _named_values(fixed.EVENT_FLAGS, lambda field: field)
    terms = first_terms([*fixed.EVENT_REACTIONS, *fixed.EVENT_FLAGS], limit)
    return match_terms(reports, F.concat(reactions, flags), terms, every)


def match_recalls(
    recalls: DataFrame, limit: int | None = None, every: bool = True
) -> DataFrame:
    """Recalls with a wanted root cause, then those of a wanted class."""
    classes = _named_values(fixed.RECALL_CLASSES, lambda field: "classification")
    terms = first_terms([*fixed.RECALL_CAUSES, *fixed.RECALL_CLASSES], limit)
    values = F.concat(F.array("root_cause_description"), classes)
    return match_terms(recalls, values, terms, every)


def match_labels(
    labels: DataFrame, limit: int | None = None, every: bool = True
) -> DataFrame:
    """Labels of a wanted drug, named as the term. The category is that of its list."""
    listed: dict[str, str] = {}
    for category, drugs in fixed.LABEL_DRUGS.items():
        for drug in first_terms(drugs, limit):
            listed.setdefault(drug, category)  # a drug of two lists is of the first
    matched = match_terms(
        labels.drop("category"), F.array("drug_name"), list(listed), every
    )
    categories = _literals(list(listed.values()))
    return matched.withColumns(
        {
            "category": F.get(categories, F.col(TERM_RANK).cast("int") - 1),
            "drug_name": F.col(TERM),
        }
    )


def cap_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[str], cap: int | None
) -> DataFrame:
    """The first ``cap`` rows of each group; all rows if there is no cap.

    Each group is cut twice: first in parts, dealt by a hash of the order, then
    as a whole, so that of a large group only ``cap`` rows of each part meet in
    one task, whatever the cap. Rows alike in the order count as one place, and
    are taken or left together.
    """
    if cap is None:
        return df
    held = df.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(CAP_PARTS)))
    for keys in ([*group, "_part"], list(group)):
        places = Window.partitionBy(*keys).orderBy(*[F.asc_nulls_last(c) for c in order])
        held = held.withColumn("_rank", F.dense_rank().over(places)).filter(F.col("_rank") <= cap)
    return held.drop("_rank", "_part")


def firsts_and_ties(df: DataFrame, order: Sequence[str], key: str = URL) -> DataFrame:
    """The first rows per key: more than one where they tie in the order."""
    places = Window.partitionBy(key).orderBy(*[F.asc_nulls_last(c) for c in order])
    return df.withColumn("_rank", F.rank().over(places)).filter("_rank = 1").drop("_rank")


def keyed_only(df: DataFrame, key: Column) -> DataFrame:
    """Rows whose business key is neither null nor blank."""
    return df.filter(text.is_filled(key))


def new_only(df: DataFrame, seen: DataFrame, key: str = URL) -> DataFrame:
    """Rows whose key is not among the keys seen before.

    Spark broadcasts the seen keys when their size allows it and shuffles both
    sides otherwise; adaptive execution splits a key that fills a partition.
    """
    return df.join(seen.select(key), key, "left_anti")


def first_wins(df: DataFrame, order: Sequence[Column], key: str = URL) -> DataFrame:
    """One row per key, the first in the given order.

    Copies are cut to one per key in every task before the shuffle.
    """
    window = Window.partitionBy(key).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.filter(F.col("_rank") <= 1).drop("_rank")


def union_sources(
    sources: Sequence[tuple[str, DataFrame]],
    rank: str = "source_rank",
    name: str = "source",
) -> DataFrame:
    """Stack sources by column name, with each one's name and precedence."""
    ranked = [
        df.withColumns({name: F.lit(label), rank: F.lit(position)})
        for position, (label, df) in enumerate(sources, start=1)
    ]
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked
    )


def source_counts(df: DataFrame, source: str = "source") -> DataFrame:
    return df.groupBy(source).agg(F.count(F.lit(1)).alias("new_items"))


def merge_keys(seen: DataFrame, new: DataFrame, key: str = URL) -> DataFrame:
    """Set union of old and new keys."""
    return seen.select(key).union(new.select(key)).distinct()


def clean_keys(lines: DataFrame, line: str = "value", key: str = URL) -> DataFrame:
    """Key lines to a key set: trimmed and distinct."""
    return lines.select(F.trim(F.col(line)).alias(key)).distinct()


def top_up(
    df: DataFrame, extra: DataFrame, below: int = fixed.TOP_UP_BELOW, force: bool = False
) -> DataFrame:
    """Add the extra rows when there are too few rows, or when forced.

    The count looks at no more rows than the decision needs.
    """
    if not force:
        count = df.select(F.lit(1)).limit(below).agg(F.count(F.lit(1))).scalar()
        extra = extra.filter(count < below)
    return df.unionByName(extra, allowMissingColumns=True)
