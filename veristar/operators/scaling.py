"""Standard scaling with the population deviation."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import local_table
from .profiling import unpivot


def fit_scaler(train: DataFrame, cols: list[str]) -> DataFrame:
    """``idx, feature, mean, std``; a constant column gets a divisor of 1."""
    stats = train.agg(*[F.avg(c).alias(f"{c}|m") for c in cols], *[F.stddev_pop(c).alias(f"{c}|s") for c in cols])
    row = stats.first()
    return local_table(train.sparkSession, {
        "idx": (pa.int64(), list(range(len(cols)))),
        "feature": (pa.string(), cols),
        "mean": (pa.float64(), [row[f"{c}|m"] for c in cols]),
        "std": (pa.float64(), [row[f"{c}|s"] or 1.0 for c in cols]),
    })


def scaled_values(df: DataFrame, scaler: DataFrame, cols: list[str], id_col: str = "review_id") -> DataFrame:
    """Long form ``id, idx, feature, value`` of the scaled columns."""
    # One row per feature column.
    return unpivot(df, cols, [id_col]).join(F.broadcast(scaler), "feature").select(
        id_col, "idx", "feature", ((F.col("value") - F.col("mean")) / F.col("std")).alias("value"))
