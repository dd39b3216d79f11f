"""Mixing sources to token targets by entropy balancing."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import text_of, words_of, written

#: Documents of one source and size are dealt to salts of about this many rows.
ROWS_PER_SALT = 256


def word_count(column: str = "text") -> Column:
    return F.size(words_of(text_of(column))).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """source, source_size and target for a table of source and source_size.

    Sources in code point order, null last, take the weights in turn and share the sum
    of all sizes. A target stops at ``most`` times its source's size; what is over goes
    to the others by weight until none is above. That is the level t at which
    sum(min(most * size, weight * t)) equals the sum of sizes, found in one pass over
    the sources in order of the level at which each is full. Both windows see one row
    per source. Sources without words have target 0.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    full = Window.orderBy("full_at", F.col("source").isNull(), "source")
    before, every = full.rowsBetween(Window.unboundedPreceding, -1), full.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)
    rows = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(most))
    rows = rows.withColumn("full_at", F.col("cap") / F.col("weight"))
    rows = rows.withColumn(
        "level",
        (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))),
    )
    # the first source, in filling order, that its level does not fill
    level = F.first(F.when(F.col("level") <= F.col("full_at"), F.col("level")), ignorenulls=True).over(every)
    return rows.select("source", "source_size", F.least("cap", F.col("weight") * level).alias("target"))


def tilts(cells: DataFrame, goals: DataFrame, most: float, tolerance: float = 1e-7, rounds: int = 80) -> DataFrame:
    """The dual variable ``tilt`` of each source.

    Of all document rates r in [0, most] that meet sum(r * size) = target, the ones of
    least relative entropy to rate 1 are r = min(most, exp(tilt * size / mean size)).
    The tilt solves one increasing equation per source: a Newton step on its logarithm,
    or the middle of the bracket where the step leaves it. Each round is one distributed
    aggregation over cells (source, size, n) for all sources at once; the driver sees
    the largest relative error and nothing else. A solve that does not reach
    ``tolerance`` within ``rounds`` raises.
    """
    worded = cells.where("size > 0")
    shape = worded.groupBy("source").agg(F.min("size").alias("least"), (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    top = F.lit(math.log(most)) * F.col("mean") / F.col("least")  # here every rate is at its most
    low = F.least(F.lit(0.0), F.log(F.col("target") / F.col("source_size")) * F.col("mean") / F.col("least"))
    state = goals.where("source_size > 0").alias("a").join(shape.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")))
    state = state.select("a.source", "target", "mean", low.alias("low"), top.alias("high"), F.lit(0.0).alias("tilt"), F.lit(1.0).alias("error"))
    full = F.col("target") >= most * F.col("source_size") * (1 - 1e-12)
    state = state.join(goals.select(F.col("source").alias("s"), "source_size"), F.col("source").eqNullSafe(F.col("s"))).select(
        "source", "target", "mean", "low", "high", F.when(full, F.col("high")).otherwise(F.col("tilt")).alias("tilt"), "error"
    )
    state = written(state, "tilt")
    for _ in range(rounds):
        power = F.col("tilt") * F.col("size") / F.col("mean")
        words = F.col("n") * F.col("size") * F.least(F.lit(float(most)), F.exp(F.least(power, F.lit(math.log(most)))))
        slope = F.when(power < math.log(most), words * F.col("size") / F.col("mean")).otherwise(0.0)
        joined = worded.alias("c").join(state.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source")))
        sums = joined.groupBy("s.source", "target", "mean", "low", "high", "tilt").agg(F.sum(words).alias("words"), F.sum(slope).alias("slope"))
        over = F.col("words") > F.col("target")
        step = F.col("tilt") - F.log(F.col("words") / F.col("target")) * F.col("words") / F.col("slope")
        sums = sums.withColumn("error", F.abs(F.col("words") / F.col("target") - 1))
        sums = sums.withColumn("low", F.when(over, F.col("low")).otherwise(F.col("tilt"))).withColumn("high", F.when(over, F.col("tilt")).otherwise(F.col("high")))
        sums = sums.withColumn("step", F.when(F.col("slope") > 0, step))
        inside = (F.col("step") > F.col("low")) & (F.col("step") < F.col("high"))
        moved = F.when(F.col("error") <= tolerance, F.col("tilt")).when(inside, F.col("step")).otherwise((F.col("low") + F.col("high")) / 2)
        state = written(sums.select("source", "target", "mean", "low", "high", moved.alias("tilt"), "error"), "tilt")
        worst = state.agg(F.max("error")).first()[0]
        if worst is None or worst <= tolerance:
            return state
    raise RuntimeError(f"no mix within {tolerance} of its targets after {rounds} rounds: {worst}")


def _factor(goal: float, most: float, first: int, rate: np.ndarray, mass: np.ndarray, words: np.ndarray) -> float:
    """The f at which sum(min(most, rate * f) * words) over the sizes from ``first`` on is ``goal``.

    Rates rise or fall with size, so the sizes at their most are the first ones or the
    last ones; bisection finds how many. ``mass`` (of rates) and ``words`` are sums from
    each size to the last.
    """
    if goal >= most * words[first]:
        return math.inf
    low, high = first, len(rate)
    if rate[first] >= rate[-1]:
        while low < high:
            mid = (low + high) // 2
            if rate[mid] * (goal - most * (words[first] - words[mid])) <= most * mass[mid]:
                high = mid
            else:
                low = mid + 1
        rest, over = goal - most * (words[first] - words[low]), mass[low]
    else:
        while low < high:
            mid = (low + high + 1) // 2
            if rate[mid - 1] * (goal - most * words[mid]) <= most * (mass[first] - mass[mid]):
                low = mid
            else:
                high = mid - 1
        rest, over = goal - most * words[low], mass[first] - mass[low]
    return max(rest, 0.0) / over if over > 0 else math.inf


def _rounded(cells: pd.DataFrame, most: float) -> pd.DataFrame:
    """Whole copies for the sizes of one source, the largest first.

    What rounding a size leaves over or takes too much goes to all smaller sizes: their
    rates change by one factor, up to ``most``. A size is rounded to the side on which the
    smaller ones can still meet the target; where none can, to the nearer end.
    """
    cells = cells.sort_values("size", ascending=False, kind="stable")
    size, n, rate = (cells[c].to_numpy(dtype=float) for c in ("size", "n", "rate"))
    mass, words = (np.r_[np.cumsum(x[::-1])[::-1], 0.0] for x in (n * rate * size, n * size))
    copies, goal, top = np.zeros(len(cells), dtype=np.int64), mass[0], math.ceil(most)
    for i in range(len(cells)):
        factor = _factor(goal, most, i, rate, mass, words)
        wanted = n[i] * (most if math.isinf(factor) else min(most, rate[i] * factor))
        spare = top * words[i + 1]
        fewest, greatest = math.ceil((goal - spare) / size[i] - 1e-6), math.floor(goal / size[i] + 1e-6)
        if fewest > greatest:  # one more is too much, one less too little for all smaller sizes
            fewest = greatest = greatest if goal - greatest * size[i] - spare <= (greatest + 1) * size[i] - goal else greatest + 1
        copies[i] = int(min(max(round(wanted), fewest, 0), max(greatest, 0), top * n[i]))
        goal -= copies[i] * size[i]
    return cells.assign(copies=copies)[["source", "size", "n", "copies"]]


def mixed(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), most: float = 3.0, carry: Sequence[str] = ("*",)) -> DataFrame:
    """Every row of ``docs``, its columns ``carry`` as struct ``row``, with size, source_size, target and ``copies``.

    Sizes are words, null text has none. The rates of ``tilts`` are rounded into copies,
    0 to ``most``: documents of one source and size share a rate, their copies are a
    whole number, and what rounding leaves over passes to all smaller sizes, so a source
    ends within about one of its short documents of its target, also beside documents
    that hold much of it. Only where all copies of the shorter ones cannot fill the place
    of a longer one does a source end further off, by half of that one at most. Within a source
    and size, the documents that get one copy more are spaced evenly in the order of a
    hash of doc_id: runs agree. Documents without words get no copy. Rows that repeat a
    doc_id are rows of their own. A source may be null; other columns travel in ``row``.

    A source's sizes, one row per distinct size, meet in one task for the rounding: a
    corpus of w words has at most sqrt(2w) distinct sizes. Documents of a hot source and
    size are split by salts before their window.
    """
    rows = docs.select(F.struct(*carry).alias("row"), F.col("source").cast("string").alias("source"), F.col("doc_id").alias("id"), word_count().alias("size"))
    cells = written(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "cells")
    goals = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goals = written(targets(goals, weights, most), "targets")
    state = tilts(cells, goals, most)

    same = F.col("c.source").eqNullSafe(F.col("s.source"))
    power = F.least(F.col("tilt") * F.col("size") / F.col("mean"), F.lit(math.log(most)))
    rates = cells.where("size > 0").alias("c").join(state.alias("s"), same)
    rates = rates.select("c.source", "size", "n", F.least(F.exp(power), F.lit(float(most))).alias("rate"))
    plan = rates.groupBy("source").applyInPandas(lambda cells: _rounded(cells, most), "source string, size long, n long, copies long")
    plan = plan.unionByName(cells.where("size = 0").withColumn("copies", F.lit(0).cast("long")))
    plan = plan.alias("p").join(goals.alias("g"), F.col("p.source").eqNullSafe(F.col("g.source")))
    plan = plan.select(
        F.col("p.source").alias("plan_source"), F.col("size").alias("plan_size"), "source_size", "target",
        F.expr("copies div n").alias("base"), (F.expr("copies % n") / F.col("n")).alias("extra"),
        F.ceil(F.col("n") / ROWS_PER_SALT).alias("salts"),
    )
    plan = written(plan, "copies")

    every = rows.join(plan, F.col("source").eqNullSafe(F.col("plan_source")) & (F.col("size") == F.col("plan_size")))
    every = every.withColumn("hash", F.xxhash64("id")).withColumn("salt", F.pmod(F.shiftright("hash", 20), F.col("salts")))
    every = every.repartition("plan_source", "plan_size", "salt")
    nth = F.row_number().over(Window.partitionBy("plan_source", "plan_size", "salt").orderBy("hash", "id"))
    every = every.withColumn("nth", nth).withColumn("phase", (F.col("salt") + 0.5) / F.col("salts"))
    chosen = F.floor(F.col("nth") * F.col("extra") + F.col("phase")) - F.floor((F.col("nth") - 1) * F.col("extra") + F.col("phase"))
    return every.select("row", "size", "source_size", "target", (F.col("base") + chosen).alias("copies"))


def copied(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), most: float = 3.0) -> DataFrame:
    """The mix itself: each row as often as it has copies, with the columns of ``docs``."""
    rows = mixed(docs, weights, most).where("copies > 0")
    return rows.withColumn("nth", F.explode(F.expr("sequence(1L, copies)"))).select("row.*")
