"""Histograms, density curves and box statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .profiling import QUARTILES, quantiles, value_frequencies

# Bin counts, density grid and whisker length of the reports.
LENGTH_BINS = 50
GAP_BINS = 40
DENSITY_POINTS = 200
WHISKER = 1.5


def _frequencies(df: DataFrame, value: str, keys: list[str]) -> DataFrame:
    return value_frequencies(df, [value], keys).drop("feature")


def histogram(df: DataFrame, value: str, bins: int, keys: list[str] | None = None) -> DataFrame:
    """Equal bins over the whole range, the last one closed; empty bins are left out.

    Rows are first reduced to value frequencies; the common range is a scalar
    subquery over those, which reuses their shuffle.
    """
    keys = keys or []
    freq = _frequencies(df, value, keys)
    span = freq.agg(F.struct(F.min("value").alias("lo"), F.max("value").alias("hi")).alias("span")).scalar()
    placed = freq.withColumn("span", span).select(*keys, "value", "n", "span.*")
    width = F.col("hi") - F.col("lo")
    slot = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("value") - F.col("lo")) * bins / F.nullif(width, F.lit(0.0))), F.lit(bins - 1)).cast("int"))
    return (
        placed.groupBy(*keys, slot.alias("bin"), F.round(F.col("lo") + width / bins * slot, 4).alias("bin_start"))
        .agg(F.sum("n").alias("n_rows"))
    )


def density(df: DataFrame, value: str, key: str, points: int = DENSITY_POINTS) -> DataFrame:
    """Gaussian kernel density per key on an even grid, Scott bandwidth.

    Equal values share one kernel, so the sum runs over value frequencies.
    The grid spans each group's own range. The statistics of the groups are left
    to AQE, which broadcasts them where they turn out small.
    """
    freq = _frequencies(df, value, [key])
    stats = freq.groupBy(key).agg(
        F.sum("n").alias("n_all"), F.min("value").alias("lo"), F.max("value").alias("hi"),
        F.sum(F.col("value") * F.col("n")).alias("s1"),
    )
    spread = (
        freq.join(stats, key)
        .groupBy(key, "n_all", "lo", "hi")
        .agg(F.sum(F.col("n") * F.pow(F.col("value") - F.col("s1") / F.col("n_all"), 2)).alias("ss"))
        .where((F.col("n_all") > 1) & (F.col("ss") > 0))
        .withColumn("bandwidth", F.sqrt(F.col("ss") / (F.col("n_all") - 1)) * F.pow(F.col("n_all"), F.lit(-0.2)))
    )
    step = (F.col("hi") - F.col("lo")) / (points - 1)
    kernel = F.exp(-F.pow((F.col("x") - F.col("value")) / F.col("bandwidth"), 2) / 2)
    return (
        freq.join(spread, key)
        .withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .withColumn("x", F.col("lo") + step * F.col("point"))
        .groupBy(key, "point", "x", "n_all", "bandwidth").agg(F.sum(F.col("n") * kernel).alias("k"))
        .select(key, "point", F.round("x", 6).alias("x"),
                F.round(F.col("k") / (F.col("n_all") * F.col("bandwidth") * F.sqrt(F.lit(2.0) * F.pi())), 6)
                .alias("density"))
    )


def box_stats(df: DataFrame, cols: list[str], key: str, accuracy: int | None = None) -> DataFrame:
    """Quartiles, whisker ends (furthest value within 1.5 IQR) and outlier count."""
    # Read by every round of the selection and for the whiskers: written once.
    freq = materialize(value_frequencies(df, cols, [key]), "frequencies")
    cuts = quantiles(freq, [key, "feature"], QUARTILES, accuracy)
    q = [F.get("q", F.lit(i)) for i in range(3)]
    reach = F.lit(WHISKER) * (q[2] - q[0])
    fences = cuts.select(key, "feature", *[c.alias(n) for c, n in zip(q, ("q25", "q50", "q75"))],
                         (q[0] - reach).alias("low_fence"), (q[2] + reach).alias("high_fence"))
    inside = F.col("value").between(F.col("low_fence"), F.col("high_fence"))
    return (
        freq.join(fences, [key, "feature"])
        .groupBy(key, "feature", "q25", "q50", "q75")
        .agg(F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
             F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
             F.sum(F.when(inside, F.lit(0)).otherwise(F.col("n"))).alias("n_outliers"))
        .withColumns({c: F.round(c, 6) for c in ("q25", "q50", "q75")})
    )
