"""Reviews and features in co-bucketed tables: rows of one review lie in the same bucket of both, sorted by its id.

Joins of two such tables on ``review_id`` need neither a shuffle nor a hash table of a whole side, however large both
are: a task reads a bucket of each. Retry, training set and upsert (``unprocessed_reviews``, ``training_set``, ``upsert_features``)
are used as they are; the upsert's result goes into a new table of the same buckets.

The number of buckets belongs to the tables: take it so that a bucket fits a task, about the table's size by 200 MB. Ids
are unique in both tables, so no bucket is hot. Rows without an id lie in one bucket and meet nothing in a join; an empty table has
no bucket files and joins as any other. A table that exists is an error, never overwritten.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..operators.feature_table import upsert_features
from ..session import shared_dir

KEY = "review_id"


def write_bucketed(df: DataFrame, name: str, buckets: int, key: str = KEY) -> DataFrame:
    """Save as table ``name`` with one sorted file a bucket, in the shared folder, and read it back."""
    spark = df.sparkSession
    # One task a bucket: else every task would write a file of every bucket, and none would be sorted as a whole.
    path = shared_dir(spark, f"bucketed-{name}")
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)


def fresh_table(purpose: str) -> str:
    return f"{purpose}_{uuid.uuid4().hex}"


def upsert_bucketed(stored: DataFrame, fresh: DataFrame, name: str, buckets: int) -> DataFrame:
    """The upsert of two co-bucketed tables as a third one: the rows already lie as they are to be written."""
    path = shared_dir(stored.sparkSession, f"bucketed-{name}")
    merged = upsert_features(stored, fresh)
    # The result's key is a coalesce of both sides' keys, which Spark does not know to be their partitioning, so
    # nothing is asked of it here: a task holds one bucket and writes the file of that bucket.
    merged.write.bucketBy(buckets, KEY).sortBy(KEY).option("path", path).format("parquet").saveAsTable(name)
    return stored.sparkSession.table(name)
