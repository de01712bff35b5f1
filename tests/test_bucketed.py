"""Joins of co-bucketed tables: no exchange in the plan, the same rows as without buckets."""

import pytest
from pyspark.sql import functions as F

from veristar.operators.feature_table import upsert_features
from veristar.operators.features import FEATURE_COLS, unprocessed_reviews
from veristar.operators.training import training_set
from veristar.sources import bucketed as B

N = 4


def _features(spark, lo, hi, shift):
    ids = spark.range(lo, hi).withColumnRenamed("id", "review_id")
    return ids.select("review_id", *[
        F.when(F.col("review_id") % (i + 5) != 0, F.col("review_id").cast("double") * (i + 1) + shift).alias(c)
        for i, c in enumerate(FEATURE_COLS)])


@pytest.fixture
def tables(spark):
    """Broadcast joins are off, as for tables too large for them."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    names = []

    def table(df, purpose):
        names.append(B.fresh_table(purpose))
        return df, B.write_bucketed(df, names[-1], N)

    reviews = spark.range(100).select(F.col("id").alias("review_id"), F.format_string("text %d", "id").alias("review_text"),
                                      F.lit(3.0).alias("rating"), F.when(F.col("id") % 3 == 0, "CG").otherwise("OR").alias("label"))
    yield table(reviews, "reviews"), table(_features(spark, 20, 80, 0), "stored"), table(_features(spark, 60, 130, 0.5), "fresh"), names
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    for name in names:
        spark.sql(f"drop table if exists {name}")


def _rows(df):
    return sorted(map(repr, df.collect()))


def _exchanges(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_joins_need_no_exchange(tables):
    (reviews, b_reviews), (stored, b_stored), (fresh, b_fresh), _ = tables
    for plain, bucketed in [
        (unprocessed_reviews(reviews, stored), unprocessed_reviews(b_reviews, b_stored)),
        (training_set(stored, reviews), training_set(b_stored, b_reviews)),
        (upsert_features(stored, fresh), upsert_features(b_stored, b_fresh)),
    ]:
        assert _exchanges(bucketed) == 0
        assert _exchanges(plain) > 0
        assert _rows(plain) == _rows(bucketed)


def test_upsert_stays_in_its_buckets(spark, tables):
    (reviews, b_reviews), (stored, b_stored), (fresh, b_fresh), names = tables
    names.append(B.fresh_table("merged"))
    merged = B.upsert_bucketed(b_stored, b_fresh, names[-1], N)
    assert _rows(merged) == _rows(upsert_features(stored, fresh))
    # One file a bucket, although nothing was shuffled to write it.
    assert len(merged.inputFiles()) == N
    assert _exchanges(unprocessed_reviews(b_reviews, merged)) == 0
    assert _rows(unprocessed_reviews(b_reviews, merged)) == _rows(unprocessed_reviews(reviews, upsert_features(stored, fresh)))


def test_empty_and_existing_tables(spark, tables):
    (reviews, b_reviews), (stored, _), _, names = tables
    names.append(B.fresh_table("none"))
    empty = B.write_bucketed(stored.limit(0), names[-1], N)
    assert unprocessed_reviews(b_reviews, empty).count() == 100
    assert training_set(empty, b_reviews).count() == 0
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        B.write_bucketed(stored, names[-1], N)
