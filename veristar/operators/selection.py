"""Exact quantiles of any column by distributed selection.

Values are counted first. Then the values around each wanted rank are narrowed down: cut points taken from the values that are
still possible divide them into ranges, one aggregate counts the rows of every range, and the range that holds the rank is
what the next round looks at. A round leaves about one value in ``RANGES``, whatever the distribution. When at most ``LAST`` values are possible for
a rank, they are sorted. No buffer holds a column's values, no sort runs over all of them, and the state is a row for each group
and rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .lookup import small

RANGES = 64
LAST = 4096


def exact_quantiles(freq: DataFrame, keys: list[str], probs: list[float], value: str = "value", count: str = "n") -> DataFrame:
    """``keys, q``: an array of the quantiles of every group, interpolated between neighbours.

    ``freq`` has a row for each group and different value, with its count; missing values are left out. It is read once in every
    round: pass a written table. A group without values has no row.
    """
    rows = freq.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("v"), F.col(count).alias("n"))
    sizes = rows.groupBy(*keys).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("m"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(*_neighbours(p)) for p in probs])))
    open_ = materialize(sizes.select(*keys, F.explode(ranks).alias("rank"), "lo", "hi", F.lit(0).cast("long").alias("below"), "m"), "ranks")
    done = open_.where(f"m <= {LAST}")
    open_ = open_.where(f"m > {LAST}")
    while not open_.isEmpty():
        state = materialize(narrowed(rows, open_, keys), "ranks")
        done, open_ = done.unionByName(state.where(f"m <= {LAST}")), state.where(f"m > {LAST}")
    # At most LAST values for each rank.
    near = _possible(rows, done, keys)
    upto = F.sum("n").over(Window.partitionBy(*keys, "rank").orderBy("v")) + F.col("below")
    found = near.withColumn("upto", upto).where("upto > rank").groupBy(*keys, "rank").agg(F.min("v").alias("v"))
    by_rank = found.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("at"))  # two for each quantile
    joined = sizes.select(*keys, "total").join(by_rank, keys)
    return joined.select(*keys, F.array(*[_between(p) for p in probs]).alias("q"))


def _place(p: float) -> Column:
    return F.lit(p) * (F.col("total") - 1)


def _neighbours(p: float) -> list[Column]:
    return [F.floor(_place(p)).cast("long"), F.ceil(_place(p)).cast("long")]


def _between(p: float) -> Column:
    low, high = (F.element_at("at", r) for r in _neighbours(p))
    share = _place(p) - F.floor(_place(p))
    return F.when(low == high, low).otherwise(low * (1 - share) + high * share)


def _possible(rows: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """The values that each rank may still have; the state is broadcast where its checked size allows."""
    names = [f"_k{i}" for i in range(len(keys))]
    ranks = small(state.drop("m").withColumnsRenamed(dict(zip(keys, names))))
    same = [F.col(k) == F.col(n) for k, n in zip(keys, names)]
    return rows.join(ranks, [*same, F.col("v") >= F.col("lo"), F.col("v") <= F.col("hi")]).drop(*names)


def narrowed(rows: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """One round: for each rank the range of values that holds it. ``state``: keys, rank, lo, hi, below, m."""
    group = [*keys, "rank"]
    near = _possible(rows, state, keys)
    shares = [i / RANGES for i in range(1, RANGES)]
    cuts = near.groupBy(*group).agg(F.percentile_approx("v", shares, 20 * RANGES).alias("cuts"))
    names = [f"_k{i}" for i in range(len(group))]
    cuts = small(cuts.withColumnsRenamed(dict(zip(group, names))))
    placed = near.join(cuts, [F.col(k) == F.col(n) for k, n in zip(group, names)]).withColumn(
        "part", F.expr("size(filter(cuts, c -> c <= v))"))
    counted = placed.groupBy(*group, "part").agg(
        F.sum("n").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.first("below").alias("below"), F.count(F.lit(1)).alias("m"))
    # At most RANGES rows for each rank.
    upto = F.sum("n").over(Window.partitionBy(*group).orderBy("part"))
    placed = counted.withColumn("below", F.col("below") + upto - F.col("n"))
    return placed.where((F.col("below") <= F.col("rank")) & (F.col("rank") < F.col("below") + F.col("n"))).select(
        *group, "lo", "hi", "below", "m")
