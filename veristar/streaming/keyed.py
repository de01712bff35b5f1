"""The feature table of a stream, kept as state for each review.

Two streams in a row. The first scores every delivery of a review and appends its features. The second keeps, for each review, the
features that the upsert rule leaves (the first delivery's stable columns, the latest one's model columns, by delivery time), and
emits a row only when a delivery changes it: copies and late deliveries that change nothing write nothing. State is 12 numbers for a review
and is dropped once the watermark is ``ttl`` past its last delivery. The reviews of one hash bucket share a state value, so that a
micro-batch calls Python once for each bucket that it touches, not for each review; more reviews want more ``buckets``. The number of
buckets belongs to the checkpoint, like that of shuffle partitions.

Each emitted row says which deliveries it stands for, so a reader needs no state: over all emitted rows the earliest first delivery
gives the stable columns and the latest one the model columns. A review that comes back after its state is gone, a replayed
micro-batch or a restart from the checkpoint therefore change nothing in the table.

Deliveries that tie in time are settled by their values, so the outcome does not depend on how they are dealt to micro-batches. Rows
without a review_id or a time take no part. On a cluster, use Spark's RocksDB state store for more keys than memory holds
(``spark.sql.streaming.stateStore.providerClass``).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as t
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.features import FEATURE_COLS, MODEL_COLS, STABLE_COLS, extract_features
from ..operators.lexicon import SentimentTables

_NUMBERS = [t.StructField(c, t.DoubleType()) for c in FEATURE_COLS]
#: A scored delivery, as the first stream writes it.
DELIVERY = t.StructType([t.StructField("review_id", t.LongType()), t.StructField("delivered_at", t.TimestampType()), *_NUMBERS])
#: An emitted row: times in microseconds of the deliveries that its columns come from.
KEYED = t.StructType([t.StructField("review_id", t.LongType()), t.StructField("first_at", t.LongType()),
                      t.StructField("last_at", t.LongType()), *_NUMBERS])
#: Rows of ``KEYED`` of a bucket's reviews, as ``_HELD`` lays them out.
STATE = t.StructType([t.StructField("held", t.BinaryType())])
_HELD = np.dtype([*[(f.name, "<i8") for f in KEYED.fields[:3]], *[(c, "<f8") for c in FEATURE_COLS]])
#: Buckets of reviews: fixed value.
BUCKETS = 4096


def start_scoring(deliveries: DataFrame, tables: SentimentTables, scored: str, checkpoint: str,
                  trigger: dict | None = None) -> StreamingQuery:
    """``review_id, review_text, rating, delivered_at`` -> features of every delivery, below ``batch_id=N``."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        known = batch.where("review_id is not null and delivered_at is not null")
        found = extract_features(known, tables, ("delivered_at",)).select(*DELIVERY.names)
        found.write.mode("overwrite").parquet(f"{scored}/batch_id={batch_id}")

    return (deliveries.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def _order(row: tuple) -> tuple:
    """Missing numbers first, so that ties in time have one order."""
    return tuple((v is not None, v or 0.0) for v in row)


def merge(held: tuple | None, rows: Iterable[tuple]) -> tuple:
    """The state after deliveries ``(time, features...)``: ``(first_at, last_at, features...)``."""
    stable = range(len(STABLE_COLS))
    model = range(len(STABLE_COLS), len(FEATURE_COLS))
    first = last = None
    if held is not None:
        first = (held[0], tuple(held[2 + i] for i in stable))
        last = (held[1], tuple(held[2 + i] for i in model))
    for at, *values in rows:
        early, late = (at, tuple(values[i] for i in stable)), (at, tuple(values[i] for i in model))
        if first is None or (early[0], _order(early[1])) < (first[0], _order(first[1])):
            first = early
        if last is None or (late[0], _order(late[1])) > (last[0], _order(last[1])):
            last = late
    return first[0], last[0], *first[1], *last[1]


def _unpacked(held: bytes) -> dict[int, tuple]:
    """State of each review of a bucket; a missing number is held as NaN."""
    return {row[0]: tuple(None if v != v else v for v in row[1:]) for row in np.frombuffer(held, _HELD).tolist()}


def _packed(held: dict[int, tuple]) -> bytes:
    return np.array([(i, *[np.nan if v is None else v for v in row]) for i, row in held.items()], _HELD).tobytes()


def keyed_features(deliveries: DataFrame, delay: str = "1 day", ttl: timedelta = timedelta(days=7),
                   buckets: int = BUCKETS) -> DataFrame:
    """The stream of changed rows (``KEYED``) from a stream of scored deliveries; rows without a review_id take no part."""
    keep_ms = int(ttl.total_seconds() * 1000)

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = _unpacked(state.get[0]) if state.exists else {}
        now, arrived = state.getCurrentWatermarkMs(), {}
        for frame in () if state.hasTimedOut else frames:
            at = frame["delivered_at"].astype("datetime64[us]").astype("int64").tolist()
            values = (frame[c].astype("float64").tolist() for c in FEATURE_COLS)
            for i, *row in zip(frame["review_id"].tolist(), at, *values):
                arrived.setdefault(i, []).append([None if v != v else v for v in row])
        # A review that arrives again is held until then, whatever the watermark.
        kept = {i: row for i, row in held.items() if i in arrived or row[1] // 1000 + keep_ms >= now}
        changed = []
        for i, rows in arrived.items():
            found = merge(kept.get(i), rows)
            if found != kept.get(i):
                kept[i] = found
                changed.append((i, *found))
        if kept:
            if changed or len(kept) < len(held):
                state.update((_packed(kept),))
            # When the first review goes.
            state.setTimeoutTimestamp(max(min(row[1] for row in kept.values()) // 1000 + keep_ms, now + 1))
        elif state.exists:
            state.remove()
        if changed:
            yield pd.DataFrame(changed, columns=KEYED.names)

    bucket = F.pmod(F.xxhash64("review_id"), F.lit(buckets)).alias("bucket")
    known = deliveries.where("review_id is not null").select(bucket, *DELIVERY.names).withWatermark("delivered_at", delay)
    return known.groupBy("bucket").applyInPandasWithState(update, KEYED, STATE, "update", GroupStateTimeout.EventTimeTimeout)


def start_keyed(spark: SparkSession, scored: str, updates: str, checkpoint: str, delay: str = "1 day",
                ttl: timedelta = timedelta(days=7), files_per_batch: int = 1000, trigger: dict | None = None,
                buckets: int = BUCKETS) -> StreamingQuery:
    """Keep the state of all scored deliveries below ``scored``; changed rows go below ``updates``, a folder for each micro-batch."""
    stream = (spark.readStream.schema(DELIVERY).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
              .option("maxFilesPerTrigger", files_per_batch).parquet(scored))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{updates}/batch_id={batch_id}")

    return (keyed_features(stream, delay, ttl, buckets).writeStream.outputMode("update").foreachBatch(write_batch)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def keyed_table(spark: SparkSession, updates: str) -> DataFrame:
    """``review_id`` and the features that all emitted rows leave; one hash aggregate with map-side combine."""
    rows = spark.read.schema(KEYED).parquet(updates)
    first, last = F.struct("first_at", *STABLE_COLS), F.struct("last_at", *MODEL_COLS)
    best = rows.groupBy("review_id").agg(F.min(first).alias("first"), F.max(last).alias("last"))
    return best.select("review_id", *[F.col(f"first.{c}").alias(c) for c in STABLE_COLS], *[F.col(f"last.{c}").alias(c) for c in MODEL_COLS])
