"""Quantiles by selection against sorting."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from veristar.operators import profiling as PF
from veristar.operators import selection as S
from veristar.operators.distributions import box_stats

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


def _check(spark, groups, probs=PROBS):
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "g string, value double").groupBy("g", "value").agg(F.count(F.lit(1)).alias("n"))
    got = {r["g"]: r["q"] for r in S.exact_quantiles(df, ["g"], probs).collect()}
    assert got == {g: pytest.approx([float(np.quantile(v, p)) for p in probs], rel=1e-12) for g, v in groups.items() if len(v)}


@pytest.mark.parametrize("last", [4096, 3])
def test_equals_sorting_on_odd_distributions(spark, monkeypatch, last):
    monkeypatch.setattr(S, "LAST", last)
    rng = random.Random(last)
    _check(spark, {
        "one": [5.0], "two": [1.0, 2.0], "same": [3.25] * 400, "hot": [0.0] * 900 + [rng.random() for _ in range(100)],
        "tails": [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300) for _ in range(700)],
        "edges": [1.0] * 300 + [2.0] * 300 + [1e308, -1e308], "uniform": [rng.random() for _ in range(1500)]})


def test_rounds_shrink_many_different_values(spark, monkeypatch):
    monkeypatch.setattr(S, "LAST", 50)
    states = []
    plain = S.narrowed
    monkeypatch.setattr(S, "narrowed", lambda rows, state, keys: states.append(state.agg(F.max("m")).first()[0]) or plain(rows, state, keys))
    freq = spark.range(200_000).select(F.lit("a").alias("g"), (F.xxhash64("id") / 3.0).alias("value"), F.lit(1).cast("long").alias("n"))
    from veristar.session import materialize

    freq = materialize(freq, "selection-test")
    values = np.array([r["value"] for r in freq.select("value").collect()])
    got = S.exact_quantiles(freq, ["g"], [0.25, 0.5, 0.9]).first()["q"]
    assert got == pytest.approx(np.quantile(values, [0.25, 0.5, 0.9]).tolist(), rel=1e-12)
    assert states[0] == 200_000 and len(states) <= 3 and all(b < a / 20 for a, b in zip(states, states[1:]))


def test_no_percentile_and_no_rows(spark):
    df = spark.createDataFrame([(1, 1.5, "x"), (2, None, "x"), (3, 2.5, "y")], "id int, v double, k string")
    found = PF.describe_numeric(df, ["v"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "percentile(" not in plan
    row = found.first()
    assert (row["n"], row["q25"], row["q50"], row["q75"]) == (2, 1.75, 2.0, 2.25)
    assert PF.describe_numeric(df.where("id > 5"), ["v"]).collect() == []
    nulls = PF.describe_numeric(df.where("id = 2"), ["v"]).first()
    assert nulls["n"] == 0 and nulls["q50"] is None
    assert box_stats(df.where("id > 5"), ["v"], "k").collect() == []
    boxes = {r["k"]: (r["q25"], r["q50"], r["q75"], r["n_outliers"]) for r in box_stats(df, ["v"], "k").collect()}
    assert boxes == {"x": (1.5, 1.5, 1.5, 0), "y": (2.5, 2.5, 2.5, 0)}
