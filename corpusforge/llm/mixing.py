"""Mixing sources to target weights by entropy balancing.

Every document gets an expected number of copies r between 0 and ``most``: the rates closest (in binary
relative entropy, base rate ``most`` / 2) to equal ones whose words, source by source, sum to the source's
target.  The convex dual has one multiplier per source, and its solution tilts the rates exponentially,
r = most / (1 + exp(-(tilt * size / mean size))).  Newton steps, kept inside a bracket, find the multipliers.

A rate depends on a document's source and size alone, so each step is an aggregation over (source, size) cells
with their counts, never over documents.  Rounding is systematic in order of size: the copies of a cell are
the whole numbers that its running rate passes, so a source misses its target by about one document's words,
and a few single copies, each chosen to bring its source nearest to the target, make up for that;
inside a cell the remainder goes to the documents of smallest hash.  Sums are exact decimals: reruns agree.

Defined cases: a null or wordless text has size 0 and takes nothing; a null source is a source, ordered last;
repeated rows are separate documents; a source without words has target 0; an empty table gives no rows.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from .common import join_small, shielded, split_words, stage, unshielded

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
STEPS = 40
#: Single copies changed at most per source after rounding.
CORRECTIONS = 3
#: Documents of a cell that are ranked together at most; larger cells are split by hash.
RANKED = 500
_EXACT = "decimal(38,12)"


def source_targets(cells: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size, target from (source, size, n) cells.

    Sources in order of code points, null last, take the weights in turn.  A target above ``most`` times its
    source's size is cut to it and the rest is shared again by weight.  The shares are found without rounds: a
    source is full exactly if its size per weight is below the common level, which a running sum finds.
    """
    sizes = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    choice = F.array(*[F.lit(float(w)) for w in weights])
    weighed = sizes.withColumn("weight", F.get(choice, F.pmod(turn, F.lit(len(weights))).cast("int")))
    weighed = weighed.withColumns({"room": most * F.col("source_size"), "level": most * F.col("source_size") / F.col("weight")})
    order = Window.orderBy("level", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    run = weighed.withColumns(
        {
            "filled": F.coalesce(F.sum("room").over(before), F.lit(0)),
            "left_weight": F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
            "pool": F.least(share * F.sum("source_size").over(whole), F.lit(float(most)) * F.sum("source_size").over(whole)),
        }
    )
    # Per weight, what remains after all lower levels are full; the first source that it does not fill ends them.
    run = run.withColumn("per_weight", (F.col("pool") - F.col("filled")) / F.col("left_weight"))
    run = run.withColumn("is_full", F.col("level") <= F.col("per_weight"))
    common = F.min(F.when(~F.col("is_full"), F.struct("level", "per_weight"))).over(whole)["per_weight"]
    target = F.when(F.col("is_full"), F.col("room").cast("double")).otherwise(F.least(F.col("room").cast("double"), common * F.col("weight")))
    return run.select("source", F.col("source_size").cast("long").alias("source_size"), target.alias("target"))


def _rate(tilt, most: int):
    return most / (1 + F.exp(-F.greatest(F.lit(-700.0), F.least(F.lit(700.0), tilt))))


def tilts(cells: DataFrame, targets: DataFrame, most: int = MOST, steps: int = STEPS, tolerance: float = 1e-9) -> DataFrame:
    """source, mean_size, tilt: Newton steps on the dual of every source at once.

    A source whose target is all it can give keeps a null tilt: its rates are ``most`` exactly.
    """
    means = cells.where("size > 0").groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean_size"))
    state = join_small(targets, stage(means, "mean-sizes"), ["source"]).where(F.col("target") < most * F.col("source_size"))
    state = state.select(
        "source", "mean_size", "target", "source_size", F.lit(0.0).alias("tilt"), F.lit(-60.0).alias("low"), F.lit(60.0).alias("high"), F.lit(False).alias("done")
    )
    state = stage(state, "tilts")
    n_sources = state.count()
    held = ["source", "mean_size", "target", "source_size", "tilt", "low", "high", "done"]
    x = F.col("size") / F.col("mean_size")
    r = _rate(F.col("tilt") * x, most)
    for _ in range(steps):
        met = join_small(cells.where("size > 0"), state, ["source"], salt=["size"], rows=n_sources)
        at = met.groupBy(*held).agg(
            F.sum((r * F.col("size") * F.col("n")).cast(_EXACT)).cast("double").alias("words"),
            F.sum((r * (1 - r / most) * x * F.col("size") * F.col("n")).cast(_EXACT)).cast("double").alias("slope"),
        )
        miss = F.col("words") - F.col("target")
        bracket = at.withColumns({"low": F.when(miss < 0, F.col("tilt")).otherwise(F.col("low")), "high": F.when(miss >= 0, F.col("tilt")).otherwise(F.col("high"))})
        newton = F.col("tilt") - miss / F.greatest("slope", F.lit(1e-300))
        inside = (newton > F.col("low")) & (newton < F.col("high"))
        done = F.col("done") | (F.abs(miss) <= tolerance * F.greatest(F.col("target"), F.lit(1.0)))
        next_tilt = F.when(done, F.col("tilt")).when(inside, newton).otherwise((F.col("low") + F.col("high")) / 2)
        state = stage(bracket.select(*held[:4], next_tilt.alias("tilt"), "low", "high", done.alias("done")), "tilts")
        if state.where("not done").isEmpty():
            break
    return state.select("source", "mean_size", "tilt")


def cell_copies(cells: DataFrame, targets: DataFrame, solved: DataFrame, most: int = MOST) -> DataFrame:
    """source, size, n, copies: whole copies of each cell, by systematic rounding in order of size."""
    solved = solved.select("source", "mean_size", "tilt")
    rated = join_small(join_small(cells, stage(targets, "targets"), ["source"], salt=["size"]), solved, ["source"], "left", salt=["size"])
    x = F.col("size") / F.col("mean_size")
    rate = (
        F.when(F.col("size") == 0, F.lit(0.0))
        .when(F.col("target") >= most * F.col("source_size"), F.lit(float(most)))
        .otherwise(_rate(F.col("tilt") * x, most))
    )
    running = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum((rate * F.col("n")).cast(_EXACT)).over(running)
    passed = F.floor(total + F.lit(0.5))
    counted = rated.withColumn("passed", passed.cast("long"))
    before = F.coalesce(F.lag("passed").over(Window.partitionBy("source").orderBy("size")), F.lit(0))
    return counted.withColumn("copies", F.least(F.col("passed") - before, most * F.col("n"))).select("source", "size", "n", "copies", "source_size", "target")


def settle(cells: DataFrame, steps: int = CORRECTIONS, most: int = MOST) -> DataFrame:
    """``cells`` with single copies added or taken away, each the one that brings its source nearest to its target."""
    cells = stage(cells, "rounded-cells")
    for _ in range(steps):
        taken = stage(
            cells.groupBy("source").agg((F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("short")), "shortfalls"
        )
        n_sources = taken.count()
        met = join_small(cells, taken, ["source"], salt=["size"], rows=n_sources).where("size > 0")
        able = F.when(F.col("short") > 0, F.col("copies") < most * F.col("n")).otherwise(F.col("copies") > 0)
        left = F.abs(F.abs("short") - F.col("size"))
        best = (
            met.where(able & (left < F.abs("short")))
            .groupBy("source")
            .agg(F.min(F.struct(left.alias("left"), F.col("size").alias("at"), F.sign("short").alias("change"))).alias("best"))
        )
        changed = join_small(cells, stage(best, "corrections"), ["source"], "left", salt=["size"], rows=n_sources)
        copies = F.col("copies") + F.when(F.col("size") == F.col("best.at"), F.col("best.change").cast("long")).otherwise(F.lit(0))
        cells = stage(changed.withColumn("copies", F.coalesce(copies, F.col("copies"))).drop("best"), "rounded-cells")
    return cells


def with_size(docs: DataFrame) -> DataFrame:
    """``docs`` with ``size``, the number of words of the whole text."""
    return docs.withColumn("size", F.size(split_words(F.col("text"))).cast("long"))


def mix(sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Every row of ``sized`` (doc_id, source, size, ...) with source_size, target, copies and taken = copies * size.

    The rows are read four times and ranked once: give a staged table of narrow rows, not texts.  Columns of ``sized``
    named like a result come back as ``doc_<name>``.
    """
    sized, hidden = shielded(sized, ("doc_id", "source", "size"))
    cells = stage(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "size-cells")
    targets = stage(source_targets(cells, weights, share, most), "source-targets")
    shared = settle(cell_copies(cells, targets, tilts(cells, targets, most), most), most=most)
    shared = stage(shared.withColumn("parts", F.ceil(F.col("n") / RANKED).cast("int")), "cell-copies")
    placed = join_small(sized.withColumn("_h", F.xxhash64("doc_id")), shared, ["source", "size"], salt=["doc_id"])
    # The remainder of a cell goes to its documents of smallest (part, hash): counts of whole parts first.
    placed = placed.withColumn("_part", F.pmod(F.shiftright("_h", 20), F.col("parts")).cast("int"))
    remainder = F.col("copies") % F.col("n")
    per_part = placed.where(remainder > 0).groupBy("source", "size", "_part").agg(F.count(F.lit(1)).alias("_in_part"))
    earlier_parts = Window.partitionBy("source", "size").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = per_part.select("source", "size", "_part", F.coalesce(F.sum("_in_part").over(earlier_parts), F.lit(0)).alias("_earlier"))
    within = Window.partitionBy("source", "size", "_part").orderBy("_h", "doc_id")
    ranked = placed.withColumn("_rank", F.row_number().over(within))
    full = join_small(ranked, stage(earlier, "part-counts"), ["source", "size", "_part"], "left", salt=["doc_id"])
    extra = (F.coalesce(F.col("_earlier"), F.lit(0)) + F.col("_rank") <= remainder).cast("long")
    copies = F.floor(F.col("copies") / F.col("n")).cast("long") + F.when(remainder > 0, extra).otherwise(F.lit(0))
    mixed = full.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size"))
    return unshielded(mixed.select(*sized.columns, "source_size", "target", "copies", "taken"), hidden)
