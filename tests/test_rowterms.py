"""Terms counted in the row, the feature union, and scores of repeated ids."""

import math
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from veristar.operators import lexicon as L
from veristar.operators import scoring as SC
from veristar.operators import training as TR
from veristar.operators.features import FEATURE_COLS
from veristar.operators.rowterms import binary_order, number_array, with_counts
from veristar.operators.scaling import fit_scaler
from veristar.operators.terms import fit_vocabulary, tfidf
from veristar.sources import params as P


def test_counts_in_the_row(spark):
    rows = [(1, ["b", "a", "b", "x"]), (2, []), (3, None), (4, ["ä", "z z", "ä"])]
    words = binary_order(["b", "a", "ä", "z z", "Z"])
    df = spark.createDataFrame(rows, "id int, _terms array<string>")
    got = {r["id"]: dict(zip([words[i] for i in r["k"]["indices"]], r["k"]["values"]))
           for r in with_counts(df, F.col("_terms"), words, "k").collect()}
    assert got == {1: {"a": 1, "b": 2}, 2: {}, 3: {}, 4: {"ä": 2, "z z": 1}}
    assert with_counts(df, F.col("_terms"), words, "k").columns == ["id", "_terms", "k"]
    assert all(r["k"]["indices"] == [] for r in with_counts(df, F.col("_terms"), [], "k").collect())
    with pytest.raises(ValueError, match="not finite"):
        number_array([1.0, math.nan])


def _data(spark, n=60, seed=4):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    rows = [(i // 2, " ".join(rng.choices(words, k=rng.choice([0, 3, 30]))) or None, float(rng.randint(1, 5)), i % 2,
             *[rng.random() for _ in FEATURE_COLS]) for i in range(n)]
    schema = "review_id long, review_text string, rating double, target int, " + ", ".join(f"{c} double" for c in FEATURE_COLS)
    return spark.createDataFrame(rows, schema)


def test_feature_union_equals_the_long_form_and_has_no_shuffle(spark):
    data = _data(spark).withColumn("review_id", F.monotonically_increasing_id())
    vocabulary, scaler = fit_vocabulary(data, ["w1"], 50), fit_scaler(data, FEATURE_COLS)
    vectors = TR.vectorize(data, scaler, vocabulary, 50, ("target",))
    plan = vectors._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Pandas" not in plan
    got = {(r["review_id"], i): v for r in vectors.collect() for i, v in zip(r["features"]["indices"], r["features"]["values"])}
    want = {(r["review_id"], r["idx"] + len(FEATURE_COLS)): r["weight"] for r in tfidf(data, vocabulary).collect()}
    stats = {r["feature"]: r for r in scaler.collect()}
    for r in data.collect():
        want |= {(r["review_id"], i): (r[c] - stats[c]["mean"]) / stats[c]["std"] for i, c in enumerate(FEATURE_COLS)}
    assert got == pytest.approx(want)
    for r in vectors.collect():
        assert r["features"]["indices"] == sorted(r["features"]["indices"]) and r["features"]["size"] == 50 + len(FEATURE_COLS)


def _coefficients(spark, terms):
    rows = [(-1, "intercept", "intercept", 0.1, None, None, None)]
    rows += [(i, "num", c, 0.2, 0.5, 2.0, None) for i, c in enumerate(FEATURE_COLS)]
    rows += [(9 + i, "text", t, 0.01 * (i + 1), None, None, 1.5) for i, t in enumerate(terms)]
    return P.coefficient_table(spark, rows)


def test_each_row_of_a_repeated_id_is_scored_and_analysed_alone(spark):
    rows = [(7, "good good thing", 5.0), (7, "bad thing", 1.0), (7, "bad thing", 1.0), (None, "good", None), (8, None, 2.0)]
    df = spark.createDataFrame(rows, "review_id long, review_text string, rating double")
    table, sentiment = _coefficients(spark, ["good", "thing", "bad thing"]), L.default_tables(spark)
    found = SC.analyze(df, sentiment, table, []).collect()
    assert len(found) == len(rows)
    assert Counter((r["review_id"], r["review_text"], r["rating"]) for r in found) == Counter(rows)
    for row in rows:  # as if it were alone
        alone = SC.analyze(spark.createDataFrame([row], df.schema), sentiment, table, []).first()
        same = [r for r in found if (r["review_id"], r["review_text"], r["rating"]) == row]
        assert all(r == alone for r in same) and same


def test_a_forest_scores_rows_that_repeat_an_id(spark, tmp_path):
    from veristar.sources import writers

    data = _data(spark)
    prepared = TR.prepare(data.withColumn("review_id", F.monotonically_increasing_id()), [], max_terms=20)
    models = TR.estimators(prepared.n_train, forest_trees=5, forest_depth=3, max_iter=20)
    result = TR.compare(prepared, {"RandomForest": models["RandomForest"]})
    writers.save_bundle(str(tmp_path / "b"), result, prepared)
    bundle = writers.load_bundle(spark, str(tmp_path / "b"))
    reviews = data.select("review_id", "review_text", "rating")
    scanned = SC.scan_bundle(reviews, L.default_tables(spark), bundle).collect()
    assert len(scanned) == reviews.count()
    assert Counter((r["review_id"], r["rating"]) for r in scanned) == Counter((r[0], r[2]) for r in reviews.collect())


def test_models_are_compared_in_a_session_that_has_observed_a_write(spark, tmp_path):
    from pyspark.sql import Observation

    # Once rows are observed, Spark's session holds an object that cannot be sent to tasks.
    seen = Observation("seen")
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(str(tmp_path / "seen"))
    assert seen.get["n"] == 3
    prepared = TR.prepare(_data(spark).withColumn("review_id", F.monotonically_increasing_id()), [], max_terms=20)
    models = TR.estimators(prepared.n_train, forest_trees=5, forest_depth=3, max_iter=20)
    assert TR.compare(prepared, models).report.count() == len(models)


def test_the_text_score_is_linear_in_the_text(spark):
    rng = random.Random(9)
    words = [f"t{i}" for i in range(3000)]
    table = _coefficients(spark, words[:2000])
    seconds = {}
    for n in (2_000, 20_000):
        texts = [(i, " ".join(rng.choices(words, k=n))) for i in range(24)]
        df = spark.createDataFrame(texts, "review_id long, review_text string").coalesce(1).cache()
        df.count()
        best = []
        for _ in range(3):
            start = time.time()
            SC.with_text_score(df, table, []).agg(F.sum("text_z")).collect()
            best.append(time.time() - start)
        seconds[n] = min(best)
        df.unpersist()
    assert seconds[20_000] < 15 * seconds[2_000], seconds


def test_terms_of_a_vocabulary_are_those_of_all_terms(spark):
    from veristar.operators import terms as TM

    rng = random.Random(11)
    words = ["toks", "a'b", "x", "y", "zz", "q"]
    rows = [(i, [rng.choice(words) for _ in range(rng.randint(0, 9))]) for i in range(80)]
    df = spark.createDataFrame(rows, "id int, `the toks` array<string>")
    for vocabulary in (["toks", "x y", "y y", "a'b toks", "x"], ["zz"], ["toks x"], ["a b c"], []):
        got = df.select(F.expr(TM.known_terms(vocabulary, "`the toks`")).alias("t")).collect()
        every = df.select(F.expr(TM.ALL_TERMS.replace("toks", "`the toks`")).alias("t")).collect()
        assert [sorted(r["t"]) for r in got] == [sorted(x for x in r["t"] if x in vocabulary) for r in every]
    assert TM.known_terms([str(i) for i in range(TM.IN_ROW_TOKENS + 1)]) == TM.ALL_TERMS
