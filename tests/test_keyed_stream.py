"""Keyed state of the feature stream: rule, batches, restarts, late rows, expiry."""

import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import types as t

from veristar.operators.features import FEATURE_COLS, MODEL_COLS, STABLE_COLS
from veristar.streaming import keyed as K

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def _rows(deliveries):
    """(id, minute, value): every stable feature is the value, every model feature its negative (None stays)."""
    return [(i, START + timedelta(minutes=m) if m is not None else None, *[v] * len(STABLE_COLS),
             *[None if v is None else -v] * len(MODEL_COLS)) for i, m, v in deliveries]


def _write(spark, folder, deliveries):
    spark.createDataFrame(_rows(deliveries), K.DELIVERY).coalesce(1).write.mode("append").parquet(folder)


def _run(spark, base, **options):
    K.start_keyed(spark, f"{base}/scored", f"{base}/updates", f"{base}/state", **options).awaitTermination()


def _table(spark, base):
    rows = K.keyed_table(spark, f"{base}/updates").collect()
    assert len({r["review_id"] for r in rows}) == len(rows)
    for r in rows:
        assert len({r[c] for c in STABLE_COLS}) == 1 and len({r[c] for c in MODEL_COLS}) == 1
    return {r["review_id"]: (r[STABLE_COLS[0]], r[MODEL_COLS[0]]) for r in rows}


def _want(deliveries):
    out = {}
    for i, m, v in deliveries:
        out.setdefault(i, []).append((m, v))
    return {i: (min(x)[1], max((m, -v) for m, v in x)[1]) for i, x in out.items()}


def test_merge_does_not_depend_on_the_order_of_arrival():
    rng = random.Random(6)
    for _ in range(200):
        rows = [(rng.randint(0, 4), *[rng.choice([None, 0.5, 1.5])] * 6, *[rng.choice([None, 2.0, 3.0])] * 3) for _ in range(6)]
        results = set()
        for _ in range(5):
            rng.shuffle(rows)
            held = None
            for part in (rows[:2], rows[2:3], rows[3:]):
                held = K.merge(held, part)
            results.add(held)
        assert len(results) == 1
        held = results.pop()
        assert held[0] == min(r[0] for r in rows) and held[1] == max(r[0] for r in rows)


def test_batches_restarts_copies_and_late_deliveries(spark, tmp_path):
    base = str(tmp_path)
    parts = [
        [(1, 10, 1.0), (2, 10, 2.0), (3, 10, 3.0), (1, 12, 1.5)],
        [(1, 10, 1.0), (2, 20, 2.5), (4, 20, 4.0)],       # a copy, a later delivery, a new review
        [(2, 5, 2.1), (3, 10, 3.0), (4, 30, 4.5)],        # late but earlier than the first one; a copy
        [(3, 10, 3.0)],                                    # nothing changes
    ]
    for part in parts:  # each run stops, the next one goes on from the checkpoint
        _write(spark, f"{base}/scored", part)
        _run(spark, base)
    every = [d for part in parts for d in part]
    assert _table(spark, base) == _want(every) == {1: (1.0, -1.5), 2: (2.1, -2.5), 3: (3.0, -3.0), 4: (4.0, -4.5)}
    # Copies wrote nothing.
    rows = spark.read.schema(t.StructType([*K.KEYED, t.StructField("batch_id", t.LongType())])).parquet(f"{base}/updates").collect()
    changed = {}
    for r in rows:
        changed.setdefault(r["batch_id"], set()).add(r["review_id"])
    assert [changed[b] for b in sorted(changed)] == [{1, 2, 3}, {2, 4}, {2, 4}]


def test_one_batch_equals_many(spark, tmp_path):
    rng = random.Random(1)
    every = [(rng.randint(1, 20), rng.randint(0, 300), float(rng.randint(1, 9))) for _ in range(150)]
    every = list({(i, m): (i, m, v) for i, m, v in every}.values())
    for name, size in (("one", len(every)), ("many", 40)):
        base = str(tmp_path / name)
        for start in range(0, len(every), size):
            _write(spark, f"{base}/scored", every[start:start + size])
        _run(spark, base, files_per_batch=1)
        assert _table(spark, base) == _want(every)


def test_state_expires_and_a_late_row_behind_the_watermark_is_left_out(spark, tmp_path):
    base = str(tmp_path)
    options = {"delay": "10 minutes", "ttl": timedelta(minutes=30)}

    def keys():
        return spark.read.format("statestore").load(f"{base}/state").count()

    _write(spark, f"{base}/scored", [(1, 0, 1.0), (2, 0, 2.0)])
    _run(spark, base, **options)
    assert keys() == 2
    _write(spark, f"{base}/scored", [(2, 100, 2.5)])
    _run(spark, base, **options)
    _write(spark, f"{base}/scored", [(9, 101, 9.0), (1, 1, 7.0)])  # review 1 again, an hour and a half behind the watermark
    _run(spark, base, **options)
    assert keys() == 2  # 2 and 9; review 1 is gone
    _write(spark, f"{base}/scored", [(1, 200, 1.5)])  # it comes back: its stable columns stay
    _run(spark, base, **options)
    assert _table(spark, base) == {1: (1.0, -1.5), 2: (2.0, -2.5), 9: (9.0, -9.0)}


def test_scoring_keeps_every_delivery(spark, tmp_path):
    from veristar.operators import lexicon as L

    rows = [(1, "good thing", 5.0, START), (1, "bad thing", 1.0, START + timedelta(hours=1)), (None, "x", 1.0, START),
            (2, None, None, START), (3, "x", 1.0, None)]
    df = spark.createDataFrame(rows, "review_id long, review_text string, rating double, delivered_at timestamp")
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    K.start_scoring(stream, L.default_tables(spark), str(tmp_path / "scored"), str(tmp_path / "cp")).awaitTermination()
    found = spark.read.schema(K.DELIVERY).parquet(str(tmp_path / "scored"))
    assert sorted((r["review_id"], r["sentiment_score"] > 0) for r in found.collect()) == [(1, False), (1, True), (2, False)]
    K.start_keyed(spark, str(tmp_path / "scored"), str(tmp_path / "updates"), str(tmp_path / "state")).awaitTermination()
    table = {r["review_id"]: r for r in K.keyed_table(spark, str(tmp_path / "updates")).collect()}
    assert set(table) == {1, 2} and table[1]["sentiment_score"] > 0 and table[2]["rating_sentiment_gap"] is None
    assert set(table[1].asDict()) == {"review_id", *FEATURE_COLS}


def test_reviews_of_a_bucket_share_a_state_and_expire_each(spark, tmp_path):
    base = str(tmp_path)
    options = {"delay": "10 minutes", "ttl": timedelta(minutes=30), "buckets": 1}
    first = [(i, i % 7, float(i)) for i in range(1, 60)]
    later = [(2, 100, 2.5), (60, 101, None)]
    _write(spark, f"{base}/scored", first)
    _run(spark, base, **options)
    state = spark.read.format("statestore").load(f"{base}/state").collect()
    assert len(state) == 1  # one value for all reviews, so one call of Python
    assert _table(spark, base) == _want(first)
    for part in (later, [(61, 102, 1.0)]):
        _write(spark, f"{base}/scored", part)
        _run(spark, base, **options)
    (row,) = spark.read.format("statestore").load(f"{base}/state").collect()
    held = next(v for v in _binaries(row.asDict(recursive=True)))
    assert set(K._unpacked(held)) == {2, 60, 61}  # the others are gone
    assert _table(spark, base) == {i: (v, -v) for i, _, v in first} | {2: (2.0, -2.5), 60: (None, None), 61: (1.0, -1.0)}


def _binaries(value):
    if isinstance(value, (bytes, bytearray)):
        yield bytes(value)
    elif isinstance(value, dict):
        for v in value.values():
            yield from _binaries(v)
