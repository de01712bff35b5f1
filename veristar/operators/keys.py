"""Hash-ordered ranks, surrogate keys, key checks and the stratified split."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Leading hex digits that form a rank bucket: 65,536 even buckets per class.
BUCKET_DIGITS = 4
# Finer buckets for the split: only one of them is ever sorted.
CUT_DIGITS = 5


def order_hash(key: Column, seed: str = "") -> Column:
    """Pseudo-random but repeatable order of a unique key."""
    return F.md5(F.concat(F.lit(seed), key.cast("string")))


def hash_rank(df: DataFrame, key: str, seed: str = "") -> DataFrame:
    """Dense 1-based ``rank`` in hash order, without a global sort.

    Buckets of the hash are even because the key is unique; each is ranked on
    its own and shifted by the number of rows in the buckets before it.
    """
    hashed = df.withColumn("h", order_hash(F.col(key), seed))
    hashed = hashed.withColumn("bucket", F.substring("h", 1, BUCKET_DIGITS))
    sizes = hashed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # At most 16**BUCKET_DIGITS rows, whatever the table holds.
    starts = sizes.select("bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("bucket").orderBy("h", key))
    return (
        hashed.join(F.broadcast(starts), "bucket")
        .withColumn("rank", inside + F.col("start")).drop("bucket", "start", "h")
    )


def assign_ids(df: DataFrame, key: str, id_col: str, start: int = 0) -> DataFrame:
    """Dense ids after ``start``; a re-run or a lost executor gives the same ids."""
    return hash_rank(df, key).withColumn(id_col, F.col("rank") + F.lit(start).cast("long")).drop("rank")


def append_ids(df: DataFrame, id_col: str, start: int = 0) -> DataFrame:
    """Unique ids with gaps after ``start`` for rows that have no key of their own."""
    return df.withColumn(id_col, F.monotonically_increasing_id() + F.lit(start + 1).cast("long"))


def key_violations(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def train_quotas(class_sizes: dict, test_share: float) -> dict:
    """Train rows per class: proportional, rounded by largest remainder."""
    total = sum(class_sizes.values())
    n_train = total - math.ceil(test_share * total)
    exact = {c: n_train * n / total for c, n in class_sizes.items()} if total else {}
    quota = {c: math.floor(x) for c, x in exact.items()}
    by_remainder = sorted(exact, key=lambda c: (quota[c] - exact[c], c))
    for c in by_remainder[: n_train - sum(quota.values())]:
        quota[c] += 1
    return quota


def stratified_split(df: DataFrame, key: str, target: str = "target", test_share: float = 0.20,
                     seed: int = 42) -> DataFrame:
    """Add ``is_test`` with exact shares per class.

    The cut is one hash value per class. It is found from bucket counts and a
    sort of the one bucket it falls into; marking the rows is then a filter.
    """
    prefix = F.substring("h", 1, CUT_DIGITS)
    keyed = df.select(target, F.col(key), order_hash(F.col(key), f"{seed}-").alias("h"))
    buckets = keyed.groupBy(target, prefix.alias("bucket")).agg(F.count(F.lit(1)).alias("n")).persist()
    running = buckets.withColumn("upto", F.sum("n").over(Window.partitionBy(target).orderBy("bucket")))
    # Only a row per class reaches the driver here and below.
    sizes = {r[target]: r["n"] for r in buckets.groupBy(target).agg(F.sum("n").alias("n")).collect()}
    train = train_quotas(sizes, test_share)
    is_test = F.lit(False)
    for c in sorted(sizes):
        n_test = sizes[c] - train[c]
        if n_test == 0:
            continue
        edge = running.where((F.col(target) == c) & (F.col("upto") >= n_test)).orderBy("bucket").first()
        rest = n_test - (edge["upto"] - edge["n"])
        last = (
            keyed.where((F.col(target) == c) & (prefix == edge["bucket"]))
            .withColumn("place", F.row_number().over(Window.partitionBy(target).orderBy("h", key)))
            .where(F.col("place") == rest).first()
        )
        here = (F.col("h") < last["h"]) | ((F.col("h") == last["h"]) & (F.col(key) <= last[key]))
        is_test = is_test | ((F.col(target) == c) & here)
    buckets.unpersist()
    return df.withColumn("h", order_hash(F.col(key), f"{seed}-")).withColumn("is_test", is_test).drop("h")
