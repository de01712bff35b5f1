"""Declared schemas of the stored tables and files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as t

from ..operators.features import FEATURE_COLS

RAW_FILE = t.StructType([
    t.StructField("category", t.StringType()),
    t.StructField("rating", t.DoubleType()),
    t.StructField("label", t.StringType()),
    t.StructField("text_", t.StringType()),
])
RAW_REVIEWS = t.StructType([
    t.StructField("review_id", t.LongType(), False),
    t.StructField("category", t.StringType()),
    t.StructField("rating", t.DecimalType(2, 1)),
    t.StructField("label", t.StringType()),
    t.StructField("review_text", t.StringType()),
    t.StructField("ingested_at", t.TimestampType()),
])
ENGINEERED_FEATURES = t.StructType([
    t.StructField("feature_id", t.LongType(), False),
    t.StructField("review_id", t.LongType()),
    *[t.StructField(c, t.DoubleType()) for c in FEATURE_COLS],
    t.StructField("created_at", t.TimestampType()),
])
SYSTEM_LOGS = t.StructType([
    t.StructField("log_id", t.LongType(), False),
    t.StructField("stage", t.StringType()),
    t.StructField("message", t.StringType()),
    t.StructField("logged_at", t.TimestampType()),
])
TABLES = {"raw_reviews": RAW_REVIEWS, "engineered_features": ENGINEERED_FEATURES, "system_logs": SYSTEM_LOGS}

# Column names other installations use for the model columns.
FEATURE_ALIASES = {
    "roberta_sentiment": "model_sentiment",
    "roberta_rating_sentiment_gap": "model_rating_gap",
    "vader_roberta_dissonance": "sentiment_dissonance",
}
MAX_CATEGORY, MAX_LABEL, MAX_STAGE = 100, 10, 100


def rename_features(features: DataFrame) -> DataFrame:
    """A feature table of another installation under the names used here."""
    return features.withColumnsRenamed({k: v for k, v in FEATURE_ALIASES.items() if k in features.columns})


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[name])


def with_default_time(df: DataFrame, col: str) -> DataFrame:
    """Missing times become the time of the query."""
    given = F.col(col) if col in df.columns else F.lit(None).cast("timestamp")
    return df.withColumn(col, F.coalesce(given, F.current_timestamp()))


def too_long(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Rows whose strings exceed the declared lengths."""
    broken = F.lit(False)
    for col, limit in limits.items():
        broken = broken | F.coalesce(F.length(col) > limit, F.lit(False))
    return df.where(broken)
