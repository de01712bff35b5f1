"""The keyed feature table: partial upsert, deltas, cascade, schema growth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import FEATURE_COLS, MODEL_COLS, STABLE_COLS


def upsert_features(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """New snapshot: new keys are added; known keys get only the model columns replaced.

    Both sides are unique on ``review_id``, so the join keys cannot be skewed.
    """
    old, new = stored.alias("old"), fresh.alias("new")
    known, arrived = F.col("old.review_id").isNotNull(), F.col("new.review_id").isNotNull()
    return old.join(new, F.col("old.review_id") == F.col("new.review_id"), "full_outer").select(
        F.coalesce("old.review_id", "new.review_id").alias("review_id"),
        *[F.when(known, F.col(f"old.{c}")).otherwise(F.col(f"new.{c}")).alias(c) for c in STABLE_COLS],
        *[F.when(arrived, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in MODEL_COLS],
    )


def resolve_deltas(deltas: DataFrame, order_col: str = "batch_id") -> DataFrame:
    """The same rule over appended batches: first delivery keeps the stable columns,
    the latest delivery sets the model columns.

    A batch only appends its own rows; the table is not rewritten per batch.
    All buffers are fixed-width, so this stays one hash aggregate with map-side combine.
    """
    return deltas.groupBy("review_id").agg(
        *[F.min_by(c, order_col).alias(c) for c in STABLE_COLS],
        *[F.max_by(c, order_col).alias(c) for c in MODEL_COLS],
    )


def deliveries(batch: DataFrame, order_cols: list[str]) -> DataFrame:
    """Repeated deliveries of reviews, each distinct one once and under a key of its own.

    ``review_id`` becomes a struct of the id and its place in the order of arrival, where rating and a
    digest of the text settle ties. Equal deliveries would add up under one key, so copies go.
    """
    digest = F.md5(F.coalesce("review_text", F.lit("")))
    place = F.struct(*order_cols, F.col("rating").alias("__rating"), digest.alias("__digest"))
    return (
        batch.select(F.struct("review_id", place.alias("place")).alias("review_id"), "review_text", "rating")
        .dropDuplicates(["review_id"])
    )


def resolve_deliveries(features: DataFrame) -> DataFrame:
    """Features of ``deliveries`` -> one row per review, by the rule of ``resolve_deltas``."""
    rest = [c for c in features.columns if c != "review_id"]
    return resolve_deltas(features.select("review_id.review_id", "review_id.place", *rest), "place")


def cascade_features(features: DataFrame, reviews: DataFrame) -> DataFrame:
    """Features whose review still exists."""
    return features.join(reviews.select("review_id"), "review_id", "left_semi")


def evolve_schema(features: DataFrame, columns: list[str] = FEATURE_COLS) -> DataFrame:
    """Add the columns that are not there yet, empty for old rows."""
    missing = {c: F.lit(None).cast("double") for c in columns if c not in features.columns}
    return features.withColumns(missing) if missing else features
