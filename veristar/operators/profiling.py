"""Counts, shares and summary statistics of a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .cleaning import text_digest
from .selection import exact_quantiles

QUARTILES = [0.25, 0.5, 0.75]


def _rows(df: DataFrame, structs: list[Column]) -> DataFrame:
    """One output row per struct of a one-row (or grouped) frame."""
    return df.select(F.inline(F.array(*structs)))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def value_counts(df: DataFrame, col: str, by_key: bool = False) -> DataFrame:
    """Rows per value without missing values, most frequent first or in key order."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.orderBy(col) if by_key else counts.orderBy(F.desc("n_rows"), col)


def value_share(df: DataFrame, col: str) -> DataFrame:
    """Percent of the rows per value, one decimal."""
    counts = value_counts(df, col)
    total = counts.agg(F.sum("n_rows")).scalar()
    return counts.withColumn("pct", F.round(F.col("n_rows") * 100.0 / total, 1))


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    cols = cols or df.columns
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return _rows(counts, [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null")) for c in cols])


def column_info(df: DataFrame) -> DataFrame:
    """Name, type and number of present values, in column order."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    return _rows(counts, [
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"),
                 F.lit(kind).alias("data_type"), F.col(c).alias("n_present"))
        for i, (c, kind) in enumerate(df.dtypes)
    ])


def duplicate_count(df: DataFrame, text_col: str = "text_") -> DataFrame:
    """Rows beyond the first of each text; missing texts count as equal."""
    copies = df.groupBy(text_digest(text_col).alias("digest")).agg(F.count(F.lit(1)).alias("n"))
    return copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"))


def unpivot(df: DataFrame, cols: list[str], keys: list[str] | None = None) -> DataFrame:
    """Long form ``keys, feature, value``."""
    keys = keys or []
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols])
    return df.select(*keys, F.inline(pairs))


def value_frequencies(df: DataFrame, cols: list[str], keys: list[str] | None = None) -> DataFrame:
    """Rows per (keys, feature, value). Map-side counts shrink the table to its
    distinct values before anything is ranked."""
    keys = keys or []
    return (
        unpivot(df, cols, keys).where(F.col("value").isNotNull())
        .groupBy(*keys, "feature", "value").agg(F.count(F.lit(1)).alias("n"))
    )


def quantiles(freq: DataFrame, keys: list[str], probs: list[float], accuracy: int | None) -> DataFrame:
    """``keys, q``: exact by selection, or approximate from a sketch of the *different* values' rows."""
    if accuracy:
        return freq.groupBy(*keys).agg(F.percentile_approx("value", probs, accuracy).alias("q"))
    return exact_quantiles(freq, keys, probs)


def describe_numeric(df: DataFrame, cols: list[str], accuracy: int | None = None) -> DataFrame:
    """count, mean, sample deviation, extremes and quartiles per column.

    Quartiles are exact, by selection over value frequencies; with ``accuracy`` they come from
    a mergeable sketch over the rows instead.
    """
    stats = unpivot(df, cols).groupBy("feature").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
        *([F.percentile_approx("value", QUARTILES, accuracy).alias("q")] if accuracy else []),
    )
    if not accuracy:
        exact = exact_quantiles(materialize(value_frequencies(df, cols), "frequencies"), ["feature"], QUARTILES)
        stats = stats.join(exact, "feature", "left")
    return stats.select(
        "feature", "n", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), "min",
        *[F.round(F.get("q", F.lit(i)), 6).alias(name) for i, name in enumerate(("q25", "q50", "q75"))], "max",
    )


def grouped_means(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    return df.groupBy(key).agg(*[F.round(F.avg(c), 4).alias(c) for c in cols])


def correlation_matrix(df: DataFrame, cols: list[str], digits: int = 2) -> DataFrame:
    """Pearson correlation of every pair, from one aggregate over the table."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    wide = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    both = [(a, b, f"{a}|{b}") for a, b in pairs] + [(b, a, f"{a}|{b}") for a, b in pairs if a != b]
    return _rows(wide, [
        F.struct(F.lit(a).alias("feature_x"), F.lit(b).alias("feature_y"),
                 F.round(F.col(f"`{name}`"), digits).alias("r"))
        for a, b, name in both
    ])
