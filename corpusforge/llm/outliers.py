"""Robust multivariate outliers among documents: minimum covariance determinant per language and source.

Five counters of each text are turned into a vector.  For each estimation unit the subset of about
``SUPPORT`` of its rows whose covariance has the smallest determinant is searched by concentration steps
from two starts (all rows; medians and quartiles), and a document is rejected when its Mahalanobis distance
from that subset's centre exceeds a chi-square bound.

Everything is one scan of the texts and narrow aggregations: a concentration step sums moments per (unit,
start, distance bin) with map-side partial sums, and the bins' running counts tell where the subset ends.
Vectors are whole numbers (``GRID`` steps a unit), so sums are exact and reruns agree.  ``FLOOR`` is added to
every variance, so that columns that are constant in most rows keep the determinant above zero.

A (language, source) with fewer than ``MIN_ROWS`` usable rows is judged by its language, a language with fewer
by all rows; with fewer in all, every document that passes the base rule is kept.

Defined cases: a null text has no words and fails the base rule; null languages and sources are groups of
their own; repeated rows are separate rows; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import join_small, split_words, stage

# The transformed statistics, in this order.
NAMES = ("size", "length", "symbols", "lines", "repeats")
P = len(NAMES)
GRID = 256
FLOOR = (0.25, 0.05, 0.10, 0.15, 0.15)
SUPPORT = 0.75
MIN_ROWS = 200
STEPS = 5
# Fixed values for five dimensions: 0.75 and 0.999999 quantiles of chi-square with 5 degrees of freedom, and
# the factor 0.75 / P(chi-square with 7 degrees of freedom <= the first) that makes the covariance of the inner
# 75 % consistent under the normal law.
CHI2_SUPPORT, CHI2_CUT, CONSISTENCY = 6.62568, 35.888, 1.41207
#: Distance bins: equal steps of the logarithm.
BINS_PER_UNIT = 64


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counters of each whole text, one scan without a shuffle."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = docs.select(
        "doc_id", "lang", "source", split_words(text).alias("w"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    starts = F.when(F.size("w") >= 3, F.sequence(F.lit(0), F.size("w") - 3)).otherwise(F.array().cast("array<int>"))
    triples = F.transform(
        starts, lambda i: F.struct(F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)).alias("h"), i.alias("i"))
    )
    ordered = words.select(
        "doc_id", "lang", "source", "n_symbols",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.sort_array(triples).alias("t"),
    )
    twice = F.filter("t", lambda x, k: (x.h == F.get("t", k - 1).h) | (x.h == F.get("t", k + 1).h))
    marked = ordered.withColumn("at", F.sort_array(F.transform(twice, lambda x: x.i)))
    count = F.aggregate(
        "at", F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda s, i: F.struct((i + 3).alias("end"), (s.n + 3 - F.greatest(F.lit(0), s.end - i)).alias("n")),
        lambda s: s.n,
    )
    return marked.select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", count.alias("n_repeat_words"), "n_lines"
    )


def base_failed(min_words: int = 50, max_repeated_percent: int = 50) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeated_percent * F.col("n_words"))


def vector(df: DataFrame) -> DataFrame:
    """Adds x0..x4: log size, log mean word length, roots of the symbol, repeated-line and repeated-word rates."""
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    values = (
        F.log(words), F.log(F.greatest(F.col("word_chars") / words, F.lit(0.01))), F.sqrt(F.col("n_symbols") / words),
        F.sqrt(F.col("n_dup_lines") / lines), F.sqrt(F.col("n_repeat_words") / words),
    )
    return df.withColumns({f"x{i}": F.round(v * GRID).cast("long") for i, v in enumerate(values)})


def moments() -> list[Column]:
    """Count, sums and sums of products as exact whole numbers."""
    products = [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}{j}") for i in range(P) for j in range(i + 1)]
    return [F.count(F.lit(1)).alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in range(P)], *products]


SUMS = ["n", *[f"s{i}" for i in range(P)], *[f"s{i}{j}" for i in range(P) for j in range(i + 1)]]


def shape(sums: DataFrame, factor: float = 1.0) -> DataFrame:
    """Centre (m0..m4), inverse Cholesky factor (r00..r44) and log determinant from the sums of each row."""
    at = sums.withColumns({f"m{i}": F.col(f"s{i}") / F.col("n") / GRID for i in range(P)})
    at = at.withColumns(
        {
            f"c{i}{j}": factor * (F.col(f"s{i}{j}") / F.col("n") / GRID**2 - F.col(f"m{i}") * F.col(f"m{j}")) + F.lit(FLOOR[i] ** 2 if i == j else 0.0)
            for i in range(P)
            for j in range(i + 1)
        }
    )
    return inverted(at)


def inverted(at: DataFrame) -> DataFrame:
    """From c00..c44 the inverse Cholesky factor and the log determinant, column by column."""
    keep = [c for c in at.columns if c not in SUMS and not c.startswith("c")]
    for j in range(P):
        rest = lambda i: sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))  # noqa: B023,E731
        at = at.withColumn(f"l{j}{j}", F.sqrt(F.greatest(F.col(f"c{j}{j}") - rest(j), F.lit(1e-9))))
        if j < P - 1:
            at = at.withColumns({f"l{i}{j}": (F.col(f"c{i}{j}") - rest(i)) / F.col(f"l{j}{j}") for i in range(j + 1, P)})
    for i in range(P):
        at = at.withColumn(f"r{i}{i}", 1 / F.col(f"l{i}{i}"))
        if i:
            at = at.withColumns(
                {f"r{i}{j}": -sum((F.col(f"l{i}{k}") * F.col(f"r{k}{j}") for k in range(j, i)), F.lit(0.0)) / F.col(f"l{i}{i}") for j in range(i)}
            )
    log_det = 2 * sum((F.log(f"l{i}{i}") for i in range(P)), F.lit(0.0))
    return at.select(*keep, log_det.alias("log_det"), *[f"r{i}{j}" for i in range(P) for j in range(i + 1)])


def distance() -> Column:
    """Squared Mahalanobis distance of x from the centre m under the factor r."""
    z = [
        sum((F.col(f"r{i}{j}") * (F.col(f"x{j}") / GRID - F.col(f"m{j}")) for j in range(i + 1)), F.lit(0.0)) for i in range(P)
    ]
    return sum((v * v for v in z), F.lit(0.0))


def unit_of(rows: DataFrame) -> DataFrame:
    """lang, source and the unit that judges them: [lang, source], [lang] or []; null if there are too few rows."""
    usable = F.count_if(~F.col("base_failed"))
    sizes = stage(rows.groupBy("lang", "source").agg(usable.alias("n")), "unit-sizes")
    by_lang = sizes.groupBy("lang").agg(F.sum("n").alias("n_lang"))
    in_all = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    joined = join_small(sizes, stage(by_lang, "language-sizes"), ["lang"], salt=["source"])
    named = F.transform(F.array("lang", "source"), lambda v: F.coalesce(F.concat(F.lit("="), v), F.lit("")))
    unit = (
        F.when(F.col("n") >= MIN_ROWS, named)
        .when(F.col("n_lang") >= MIN_ROWS, F.slice(named, 1, 1))
        .when(F.lit(in_all >= MIN_ROWS), F.array().cast("array<string>"))
    )
    return joined.select("lang", "source", unit.alias("unit"))


def members(rows: DataFrame, units: DataFrame) -> DataFrame:
    """Vectors of usable rows under every unit they belong to and that judges some row."""
    wanted = units.where("unit is not null").select("unit").distinct()
    named = F.transform(F.array("lang", "source"), lambda v: F.coalesce(F.concat(F.lit("="), v), F.lit("")))
    levels = F.array(named, F.slice(named, 1, 1), F.array().cast("array<string>"))
    each = rows.where("not base_failed").select(F.explode(levels).alias("unit"), *[f"x{i}" for i in range(P)])
    return join_small(each, stage(wanted, "units"), ["unit"], salt=["x0", "x1"])


def estimate(vectors: DataFrame) -> DataFrame:
    """Minimum covariance determinant of each unit: unit, m0..m4, r00..r44."""
    vectors = stage(vectors, "vectors")
    everything = shape(vectors.groupBy("unit").agg(*moments())).withColumn("start", F.lit(0))
    # Exact, and bounded in memory: a whole-number column has few distinct values.
    quartiles = vectors.groupBy("unit").agg(
        *[F.percentile(f"x{i}", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"q{i}") for i in range(P)]
    )
    spread = {f"c{i}{i}": F.pow((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / GRID / 1.349, 2) + F.lit(FLOOR[i] ** 2) for i in range(P)}
    flat = {f"c{i}{j}": F.lit(0.0) for i in range(P) for j in range(i)}
    middle = quartiles.select(
        "unit", *[(F.col(f"q{i}")[1] / GRID).alias(f"m{i}") for i in range(P)], *[v.alias(k) for k, v in (spread | flat).items()]
    )
    state = everything.unionByName(inverted(middle).withColumn("start", F.lit(1)))
    sizes = stage(vectors.groupBy("unit").agg(F.ceil(F.count(F.lit(1)) * SUPPORT).alias("h")), "supports")
    n_units = sizes.count()
    running = Window.partitionBy("unit", "start").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    for _ in range(STEPS):
        # Both starts of a unit stand in one row of arrays, so that each vector meets one row.
        starts = state.groupBy("unit").agg(F.sort_array(F.collect_list(F.struct("start", *[c for c in state.columns if c not in ("unit", "start")]))).alias("starts"))
        met = join_small(vectors, stage(starts, "mcd-starts"), ["unit"], salt=["x0", "x1"], rows=n_units)
        both = met.select("unit", *[f"x{i}" for i in range(P)], F.explode("starts").alias("s")).select("unit", *[f"x{i}" for i in range(P)], "s.*")
        binned = both.withColumn("bin", F.floor(F.log(distance() + 1e-3) * BINS_PER_UNIT).cast("int"))
        sums = binned.groupBy("unit", "start", "bin").agg(*moments())
        added = join_small(sums, sizes, ["unit"], salt=["bin"], rows=n_units).withColumn("n_before", F.coalesce(F.sum("n").over(running) - F.col("n"), F.lit(0)))
        subset = added.where("n_before < h").groupBy("unit", "start").agg(*[F.sum(c).alias(c) for c in SUMS])
        state = shape(subset, CONSISTENCY)
    best = F.min_by(F.struct(*[c for c in state.columns if c not in ("unit", "start", "log_det")]), F.struct("log_det", "start"))
    return state.groupBy("unit").agg(best.alias("b")).select("unit", "b.*")


def judge(docs: DataFrame, cut: float = CHI2_CUT) -> DataFrame:
    """One row per document: the counters, base_failed, distance and kept.

    ``cut`` bounds the squared distance; the distance is null where the base rule fails or no unit is large enough.
    """
    rows = stage(vector(statistics(docs).withColumn("base_failed", base_failed())), "text-statistics")
    units = stage(unit_of(rows), "row-units")
    shapes = stage(estimate(members(rows, units)), "mcd-shapes")
    judged = join_small(rows, units, ["lang", "source"], salt=["doc_id"])
    judged = join_small(judged, shapes, ["unit"], "left", salt=["doc_id"])
    far = F.when(~F.col("base_failed"), distance())
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(far <= cut, F.lit(True))).alias("kept"), far.alias("distance"), "lang", "source",
    )
