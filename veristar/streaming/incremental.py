"""Feature extraction of newly arriving reviews.

Each micro-batch appends its own features below ``batch_id=N`` and nothing else;
a replayed batch overwrites just that folder. Readers resolve the deltas with
the upsert rule, and ``compact`` folds them into one when there are many.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as t
from pyspark.sql.streaming import StreamingQuery

from ..operators.feature_table import deliveries, resolve_deliveries, resolve_deltas
from ..operators.features import extract_features
from ..operators.lexicon import SentimentTables


def read_review_stream(spark: SparkSession, directory: str, schema: t.StructType, pattern: str = "*.parquet",
                       files_per_batch: int = 1000) -> DataFrame:
    """Parquet files of a folder as a stream."""
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch).parquet(directory)
    )


def without_late_copies(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """Drop repeated deliveries of a review within the watermark (needs ``ingested_at``)."""
    return stream.withWatermark("ingested_at", delay).dropDuplicatesWithinWatermark(["review_id"])


def start_extraction(reviews: DataFrame, tables: SentimentTables, deltas: str, checkpoint: str,
                     order_cols: list[str], trigger: dict | None = None) -> StreamingQuery:
    """Start ``review_id, review_text, rating`` and arrival -> features; by default until the input is used up.

    ``order_cols`` give the order of arrival. Within a micro-batch as across them, the first delivery
    of a review keeps the stable columns and the latest one sets the model columns.
    """
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        found = extract_features(deliveries(batch, order_cols), tables)
        resolve_deliveries(found).write.mode("overwrite").parquet(f"{deltas}/batch_id={batch_id}")

    return (
        reviews.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def current_features(spark: SparkSession, deltas: str) -> DataFrame:
    return resolve_deltas(spark.read.parquet(deltas).withColumn("batch_id", F.col("batch_id").cast("long")))


def compact(spark: SparkSession, deltas: str, target: str) -> None:
    """Write the resolved features as a single first delta of a new folder."""
    current_features(spark, deltas).write.parquet(f"{target}/batch_id=-1")
