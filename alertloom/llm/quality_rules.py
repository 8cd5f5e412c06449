"""Quality rules: fixed limits, and robust outliers of text statistics by language and source.

All in DataFrame functions. Each text becomes a vector of transformed statistics, in whole
steps of 1/1024. For every group of language and source a minimum covariance determinant
estimate is approached by concentration steps: from the centre of the group, mean and
covariance are taken over the three quarters of the rows that are nearest by the last
estimate, and again. Rows far from the final estimate by Mahalanobis distance are rejected.
Steps are grouped counts and sums, merged from partial ones, so a group may hold any share of
the rows; only estimates, a row for each group, are joined back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alertloom.session import settle

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
CORE = 0.75
STEPS = 4
MIN_GROUP = 200  # smaller groups of a language are estimated together, then those of all languages
CUTOFF = 90.0  # squared distance; of normal vectors of five not one in 10 ** 15 lies beyond
UNIT = 1024
FEATURES = ("f0", "f1", "f2", "f3", "f4")
# The least spread that is taken for real, so that a statistic all rows share does not reject
# the first row that differs a little: in logs of words, code points of word length, and
# shares of symbols, repeated lines and repeated words.
FLOORS = (0.25, 0.25, 0.03, 0.05, 0.05)
CHI2_MEDIAN = 4.351  # of five degrees of freedom
BIN_STEPS = 32
CENTRE_STEP = 16


def _words(text: Column) -> Column:
    return F.filter(F.split(text, f"[{SPACES}]+", -1), lambda w: w != "")


def _repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more.

    Windows are compared by a 64-bit hash. Where all differ, that ends it; else they are
    sorted, those with an equal neighbour give their places, and the places' union is
    measured. Values used twice are bound as lambda variables, so nothing is quadratic.
    """
    bound = lambda value, f: F.get(F.transform(F.array(value), f), F.lit(0))
    windows = lambda w: F.transform(
        F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    )
    placed = lambda h: F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    equal = lambda s, x, at: F.coalesce(F.get(s, at)["h"] == x["h"], F.lit(False))
    places = lambda s: F.sort_array(
        F.transform(F.filter(s, lambda x, j: equal(s, x, j - 1) | equal(s, x, j + 1)), lambda x: x["i"])
    )
    covered = lambda p: F.aggregate(
        p,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, i: F.struct(
            (a["n"] + i + 3 - F.greatest(a["end"], i)).alias("n"), (i + 3).alias("end")
        ),
        lambda a: a["n"],
    )
    of_hashes = lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
        bound(placed(h), lambda s: covered(places(s)))
    )
    return bound(
        words, lambda w: F.when(F.size(w) < 4, F.lit(0)).otherwise(bound(windows(w), of_hashes))
    ).cast("long")


def with_base(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the counts, and base_failed of every row; texts end here."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
        text.alias("text"),
        _words(text).alias("words"),
        F.filter(F.split(text, "\n", -1), lambda line: F.translate(line, SPACES, "") != "").alias("lines"),
    )
    counted = rows.select(
        "doc_id",
        "lang",
        "source",
        "text_hash",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("words")).alias("n_repeat_words"),
    )
    return counted.withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
    )


def _share(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double")), F.lit(0.0))


def with_features(base: DataFrame) -> DataFrame:
    """The transformed statistics, in whole units: logs for sizes, square roots for rare shares."""
    values = (
        F.log1p(F.col("n_words").cast("double")),
        _share("word_chars", "n_words"),
        F.sqrt(_share("n_symbols", "word_chars")),
        _share("n_dup_lines", "n_lines"),
        _share("n_repeat_words", "n_words"),
    )
    return base.withColumns({f: F.round(v * UNIT).cast("long") for f, v in zip(FEATURES, values)})


def _with_group(rows: DataFrame) -> DataFrame:
    """Rows with their `group`: language and source, or where those are few, wider pools.

    Only rows that pass the limits are counted. Null: too few even together.
    """
    sound = rows.where("NOT base_failed").groupBy("lang", "source").agg(F.count("*").alias("n"))
    small = F.when(F.col("n") < MIN_GROUP, F.col("n")).otherwise(0)
    pool = F.sum(small).over(Window.partitionBy("lang"))
    pooled = sound.select("lang", "source", "n", pool.alias("pool"))
    lone = (F.col("n") < MIN_GROUP) & (F.col("pool") < MIN_GROUP)
    rest = F.sum(F.when(lone, F.col("n")).otherwise(0)).over(Window.partitionBy())
    named = pooled.select(
        F.col("lang").alias("l"),
        F.col("source").alias("s"),
        F.when(F.col("n") >= MIN_GROUP, F.to_json(F.struct("lang", "source")))
        .when(~lone, F.to_json(F.struct("lang")))
        .when(rest >= MIN_GROUP, F.lit("rest"))
        .alias("group"),
    )
    same = F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s"))
    return rows.join(named, same, "left").drop("l", "s")


def _pairs() -> list[tuple[int, int]]:
    return [(i, j) for i in range(len(FEATURES)) for j in range(i + 1)]


def _estimate(rows: DataFrame) -> DataFrame:
    """For each group of the rows, the mean and the lower root of the covariance, floors added."""
    x = [F.col(f).cast("double") for f in FEATURES]
    sums = [F.avg(v).alias(f"m{i}") for i, v in enumerate(x)]
    sums += [F.avg(x[i] * x[j]).alias(f"p{i}{j}") for i, j in _pairs()]
    got = rows.groupBy("group").agg(*sums)
    got = got.select(
        "group",
        *[f"m{i}" for i in range(len(x))],
        *[
            (
                F.col(f"p{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}") + F.lit((FLOORS[i] * UNIT) ** 2 if i == j else 0.0)
            ).alias(f"c{i}{j}")
            for i, j in _pairs()
        ],
    )
    for i in range(len(x)):  # the root, a row at a time
        for j in range(i + 1):
            left = reduce(lambda a, k: a - F.col(f"r{i}{k}") * F.col(f"r{j}{k}"), range(j), F.col(f"c{i}{j}"))
            got = got.withColumn(
                f"r{i}{j}", F.sqrt(F.greatest(left, F.lit(1.0))) if i == j else left / F.col(f"r{j}{j}")
            )
    return got.select("group", *[f"m{i}" for i in range(len(x))], *[f"r{i}{j}" for i, j in _pairs()])


def _distance(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance `d2` of each row from its group's estimate, null without one."""
    near = rows.join(estimate, "group", "left")
    for i in range(len(FEATURES)):  # forward substitution
        left = reduce(
            lambda a, k: a - F.col(f"r{i}{k}") * F.col(f"z{k}"),
            range(i),
            F.col(FEATURES[i]).cast("double") - F.col(f"m{i}"),
        )
        near = near.withColumn(f"z{i}", left / F.col(f"r{i}{i}"))
    total = reduce(lambda a, b: a + b, [F.col(f"z{i}") * F.col(f"z{i}") for i in range(len(FEATURES))])
    return near.withColumn("d2", total).drop(
        *[f"z{i}" for i in range(len(FEATURES))], *[c for c in estimate.columns if c not in ("group", "scale")]
    )


def _quantile(rows: DataFrame, bin_: Column, share: float, name: str) -> DataFrame:
    """(group, name): the least bin up to which a group holds the share of its rows.

    A group's counts are one array: there are few bins, at any number of rows.
    """
    counts = rows.groupBy("group", bin_.alias("bin")).agg(F.count("*").alias("n"))
    held = counts.groupBy("group").agg(
        F.sum("n").alias("whole"), F.sort_array(F.collect_list(F.struct("bin", "n"))).alias("bins")
    )
    first = F.aggregate(
        "bins",
        F.struct(F.lit(0).cast("long").alias("upto"), F.lit(None).cast("long").alias("bin")),
        lambda a, b: F.struct(
            (a["upto"] + b["n"]).alias("upto"),
            F.coalesce(a["bin"], F.when(a["upto"] + b["n"] >= share * F.col("whole"), b["bin"].cast("long"))).alias(
                "bin"
            ),
        ),
        lambda a: a["bin"],
    )
    return held.select("group", first.alias(name))


def _bin() -> Column:
    """Distances by size, so many steps to a doubling: the bins are few, at any number of rows."""
    return F.floor(F.log2(1 + F.col("d2")) * BIN_STEPS).cast("int")


def robust_estimates(rows: DataFrame) -> DataFrame:
    """(group, mean, root of the covariance, `scale`) of the core of each group."""
    centre = reduce(
        lambda a, b: a.join(b, "group"),
        [_quantile(rows, F.floor(F.col(f) / CENTRE_STEP), 0.5, f"m{i}") for i, f in enumerate(FEATURES)],
    )
    start = centre.select(
        "group",
        *[(F.col(f"m{i}") * float(CENTRE_STEP)).alias(f"m{i}") for i in range(len(FEATURES))],
        *[F.lit(FLOORS[i] * UNIT if i == j else 0.0).alias(f"r{i}{j}") for i, j in _pairs()],
    )
    estimate = settle(start, "estimate")
    for _ in range(STEPS):
        near = _distance(rows, estimate)
        core = near.join(_quantile(near, _bin(), CORE, "limit"), "group").where(_bin() <= F.col("limit"))
        estimate = settle(_estimate(core), "estimate")
    half = _quantile(_distance(rows, estimate), _bin(), 0.5, "half")
    upper = F.pow(F.lit(2.0), (F.col("half") + 1) / BIN_STEPS) - 1
    # The core's spread is less than the group's: distances are scaled by their median, and never up.
    return estimate.join(half, "group").withColumn("scale", F.greatest(upper / CHI2_MEDIAN, F.lit(1.0))).drop("half")


def judge(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """Every row's counts, base_failed, squared distance `d2`, and `kept`.

    Groups are estimated from rows that pass the limits. A row that fails them is not kept;
    another is kept unless its distance is over the cutoff. Null texts are empty ones; null
    languages and sources are groups like others; where even the pooled rest is too small
    for an estimate, rows are kept. Repeated rows count, and are judged, each.
    """
    rows = settle(_with_group(settle(with_features(with_base(docs)), "statistics")), "grouped")
    estimates = robust_estimates(rows.where("NOT base_failed AND group IS NOT NULL"))
    far = _distance(rows, estimates).withColumn("d2", F.col("d2") / F.col("scale")).drop("scale", "group")
    return far.withColumn("kept", ~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= cutoff)).drop(*FEATURES)


def keep(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """The rows of `docs` that are kept, with all their columns."""
    verdict = judge(docs, cutoff).where("kept").select("doc_id", "text_hash", "lang", "source")
    own = {
        "_doc_id": F.col("d.doc_id").cast("long"),
        "_text_hash": F.xxhash64(F.col("d.text").cast("string")),
        "_lang": F.col("d.lang").cast("string"),
        "_source": F.col("d.source").cast("string"),
    }
    same = reduce(lambda a, b: a & b, [v.eqNullSafe(F.col(f"k.{n}")) for n, v in own.items()])
    return docs.alias("d").join(verdict.toDF(*own).alias("k"), same, "left_semi")
