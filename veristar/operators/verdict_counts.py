"""Summary of a scan, from counts that an aggregate or a writing job gives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import verdict as V


def scan_counts() -> dict[str, Column]:
    return {"total": F.count(F.lit(1)), "deceptive": F.count_if(F.col("classification") == V.SHORT_NAMES[0])}


def summary_of(counts: DataFrame) -> DataFrame:
    """One row of ``total`` and ``deceptive`` -> the four numbers of the summary."""
    total, found = F.col("total"), F.col("deceptive")
    return counts.select("total", "deceptive", (total - found).alias("genuine"),
                         F.when(total == 0, F.lit(0.0)).otherwise(
                             F.round(found * 100.0 / F.nullif(total, F.lit(0)), 1)).alias("deceptive_pct"))
