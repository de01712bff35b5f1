"""Operators on small hand-written rows."""

import html
import math
import re

import pytest
from pyspark.sql import functions as F

from veristar.operators import attribution as A
from veristar.operators import cleaning as C
from veristar.operators import distributions as D
from veristar.operators import evaluation as E
from veristar.operators import feature_table as FT
from veristar.operators import keys as K
from veristar.operators import lexicon as L
from veristar.operators import model_sentiment as M
from veristar.operators import profiling as G
from veristar.operators import scoring as SC
from veristar.operators import terms as TM
from veristar.operators.features import FEATURE_COLS, MODEL_COLS, STABLE_COLS, extract_features, unprocessed_reviews
from veristar.sources import params as P
from veristar.sources import schemas


# --- cleaning ---------------------------------------------------------------

RAW = "review_id long, category string, rating double, label string, text_ string"


def test_cleaning_order(spark):
    raw = spark.createDataFrame([
        (1, "a", None, "CG", "first copy lacks a rating"),
        (2, "a", 5.0, "CG", "first copy lacks a rating"),
        (3, "a", 5.0, " or ", "a  b"),
        (4, "a", 5.0, "OR", "a b"),
        (5, "a", 5.0, "OR", "   "),
        (6, "a", 5.0, "XX", "odd label"),
        (7, "a", 5.0, "OR", None),
        (8, "a", 5.0, "OR", None),
        (9, "a", 5.0, "cg", "a  b"),
    ], RAW)
    kept = {r["review_id"]: (r["label"], r["text_"]) for r in C.clean_reviews(raw).collect()}
    assert kept == {3: ("OR", "a b"), 4: ("OR", "a b"), 5: ("OR", "")}
    funnel = {r["step"]: r["n_rows"] for r in C.clean_funnel(raw).collect()}
    assert funnel == {"raw": 9, "distinct_text": 6, "complete": 4, "clean": 3}
    assert G.duplicate_count(raw).first()[0] == 3


# --- lexicon sentiment ------------------------------------------------------

def compound(s):
    return round(s / math.sqrt(s * s + 15), 4)


def test_lexicon_rules(spark):
    cases = {
        "good": 1.9,
        "very good": 1.9 + 0.293,
        "very so so good": 1.9 + 0.293 + 0.293 * 0.95 + 0.293 * 0.9,
        "slightly bad": -2.5 + 0.293,
        "very bad": -2.5 - 0.293,
        "not good": 1.9 * -0.74,
        "not a good": 1.9 * -0.74,
        "not at all good": 1.9 * -0.74,
        "not at all a good": 1.9,
        "GOOD thing": 1.9 + 0.733,
        "GOOD": 1.9,
        "VERY good": 1.9 + 0.293 + 0.733,
        "good but bad": 1.9 * 0.5 - 2.5 * 1.5,
        "good!": 1.9 + 0.292,
        "good!!!!!!": 1.9 + 4 * 0.292,
        "bad!": -2.5 - 0.292,
        "good??": 1.9 + 0.36,
        "good????": 1.9 + 0.96,
        "neutral words!": 0.0,
        "": 0.0,
        "(good), nice.": 1.9 + 1.8,
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "review_id long, review_text string")
    got = {r["review_id"]: r["sentiment_score"] for r in L.lexicon_sentiment(df, L.default_tables(spark)).collect()}
    for i, (text, s) in enumerate(cases.items()):
        assert got[i] == pytest.approx(compound(s), abs=1.01e-4), text


def test_two_reviews_under_one_id_are_scored_each(spark):
    rows = [(1, "good good", 5.0, "a"), (1, "bad", 1.0, "a"), (1, "bad", 1.0, "b"), (2, "", 3.0, "a")]
    df = spark.createDataFrame(rows, "review_id long, review_text string, rating double, category string")
    alone = {r["review_id"]: r for r in extract_features(
        df.withColumn("review_id", F.monotonically_increasing_id()), L.default_tables(spark), ("rating", "category")).collect()}
    got = extract_features(df, L.default_tables(spark), ("rating", "category")).collect()
    assert len(got) == 4 and sorted(r["review_id"] for r in got) == [1, 1, 1, 2]
    assert sorted(map(str, (r[1:] for r in got))) == sorted(map(str, (r[1:] for r in alone.values())))
    assert {(r["rating"], r["sentiment_score"] > 0) for r in got if r["review_id"] == 1} == {(5.0, True), (1.0, False)}


def test_large_lexicon_takes_the_join(spark, monkeypatch):
    """Beyond the in-row and broadcast bounds the result is the same."""
    import veristar.operators.lookup as lookups

    df = spark.createDataFrame([(1, "very good but not BAD thing!"), (2, "plain"), (3, "")], "review_id long, review_text string")
    want = L.lexicon_sentiment(df, L.default_tables(spark)).orderBy("review_id").collect()
    tables = L.default_tables(spark)
    monkeypatch.setattr(L, "small", lambda lookup: lookups.small(lookup, 1))
    monkeypatch.setattr(L, "token_test", lambda lookup, col: lookups.token_test(lookup, col, 1))
    assert tables.known is None
    assert L.lexicon_sentiment(df, tables).orderBy("review_id").collect() == want


def test_text_score_of_repeated_ids_and_repeated_terms(spark):
    df = spark.createDataFrame([(1, "red car red car bus"), (1, "bus stop"), (2, ""), (None, "bus bus")], "review_id long, review_text string")
    rows = [("red", 0.5), ("red car", -0.4), ("bus", 0.3)]
    table = P.coefficient_table(spark, [(i, "text", k, w, None, None, 1.0 + i) for i, (k, w) in enumerate(rows)])
    parts = [((1 + math.log(2)) * 1, 0.5), ((1 + math.log(2)) * 2, -0.4), (3, 0.3)]
    first = sum(w * c for w, c in parts) / math.sqrt(sum(w * w for w, _ in parts))
    scored = SC.with_text_score(df, table, ["stop"])
    assert "Exchange" not in scored._jdf.queryExecution().executedPlan().toString()
    assert [r["text_z"] for r in scored.collect()] == [pytest.approx(first), pytest.approx(0.3), None, pytest.approx(0.3)]
    # A term that a model holds twice is two terms of the sum.
    twice = table.unionByName(P.coefficient_table(spark, [(3, "text", "bus", -0.1, None, None, 2.0)]))
    got = SC.with_text_score(df, twice, ["stop"]).where("review_text = 'bus stop'").first()["text_z"]
    assert got == pytest.approx((3 * 0.3 - 2 * 0.1) / math.sqrt(9 + 4))


def test_odd_tokens_in_lookup(spark):
    tables = L.SentimentTables(
        P.lexicon_table(spark, {":')": 2.0, "\\o/": 1.0, "good": 1.5}), P.default_boosters(spark), P.default_negations(spark))
    df = spark.createDataFrame([(1, "x :') y"), (2, "\\o/ z"), (3, "good")], "review_id long, review_text string")
    got = {r[0]: r[1] for r in L.lexicon_sentiment(df, tables).collect()}
    assert got == {1: compound(2.0), 2: compound(1.0), 3: compound(1.5)}


def test_extraction_needs_no_python_and_shuffles_narrow_rows(spark):
    df = spark.range(100).select(F.col("id").alias("review_id"), F.lit("good text").alias("review_text"), F.lit(3.0).alias("rating"))
    plan = extract_features(df, L.default_tables(spark))._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "InPandas" not in plan
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert plan.count("Exchange hashpartitioning") <= 1


# --- feature table ----------------------------------------------------------

def feature_rows(spark, rows):
    schema = "review_id long, " + ", ".join(f"{c} double" for c in FEATURE_COLS)
    return spark.createDataFrame(
        [(i, *[stable] * len(STABLE_COLS), *[model] * len(MODEL_COLS)) for i, stable, model in rows], schema)


def as_dict(df):
    return {r["review_id"]: (r[STABLE_COLS[0]], r[MODEL_COLS[0]]) for r in df.collect()}


def test_partial_upsert(spark):
    old = feature_rows(spark, [(1, 1.0, 10.0), (3, 3.0, None)])
    new = feature_rows(spark, [(1, 2.0, 20.0), (2, 4.0, 40.0), (3, 5.0, None)])
    once = FT.upsert_features(old, new)
    assert as_dict(once) == {1: (1.0, 20.0), 2: (4.0, 40.0), 3: (3.0, None)}
    assert as_dict(FT.upsert_features(once, new)) == as_dict(once)
    deltas = old.withColumn("batch_id", F.lit(0)).unionByName(new.withColumn("batch_id", F.lit(1)))
    assert as_dict(FT.resolve_deltas(deltas)) == as_dict(once)


def test_unprocessed_after_extraction_is_empty(spark):
    reviews = spark.createDataFrame([(1, "good", 5.0), (2, "bad", 1.0)], "review_id long, review_text string, rating double")
    done = extract_features(reviews, L.default_tables(spark))
    assert unprocessed_reviews(reviews, done).count() == 0
    assert unprocessed_reviews(reviews, done.where("review_id = 1")).count() == 1
    gaps = done.withColumn("model_sentiment", F.lit(None).cast("double"))
    assert unprocessed_reviews(reviews, gaps).count() == 2


def test_schema_growth(spark):
    old = feature_rows(spark, [(1, 1.0, 2.0)]).drop(*MODEL_COLS)
    grown = FT.evolve_schema(old)
    assert grown.columns == ["review_id", *FEATURE_COLS] and grown.first()["model_sentiment"] is None
    foreign = grown.withColumnsRenamed({v: k for k, v in schemas.FEATURE_ALIASES.items()})
    assert schemas.rename_features(foreign).columns == grown.columns


# --- keys and split ---------------------------------------------------------

def test_split_is_exact_and_repeatable(spark):
    rows = spark.range(1003).select(F.col("id").alias("review_id"), (F.col("id") % 3 == 0).cast("int").alias("target"))
    first = K.stratified_split(rows, "review_id")
    counts = {(r["target"], r["is_test"]): r["count"] for r in first.groupBy("target", "is_test").count().collect()}
    assert counts[(0, True)] + counts[(1, True)] == math.ceil(0.2 * 1003)
    assert abs(counts[(1, True)] - 0.2 * 335) <= 1
    again = K.stratified_split(rows.repartition(5), "review_id")
    assert sorted(again.collect()) == sorted(first.collect())
    other = K.stratified_split(rows, "review_id", seed=7)
    assert sorted(other.collect()) != sorted(first.collect())


def test_quotas():
    assert K.train_quotas({0: 20213, 1: 20200}, 0.2) == {0: 16170, 1: 16160}
    assert K.train_quotas({0: 5}, 0.2) == {0: 4}
    assert K.train_quotas({}, 0.2) == {}


def test_ids(spark):
    rows = spark.range(500).select((F.col("id") * 7).alias("k"))
    ids = K.assign_ids(rows, "k", "i", start=10)
    assert sorted(r["i"] for r in ids.collect()) == list(range(11, 511))
    loose = K.append_ids(rows, "i", start=10)
    assert loose.select("i").distinct().count() == 500 and loose.agg(F.min("i")).first()[0] > 10


# --- terms ------------------------------------------------------------------

@pytest.mark.parametrize("max_terms", [3, 7, 12, 500])
def test_vocabulary_is_exact(spark, max_terms):
    """The pruned count of bigrams against a full count in Python."""
    import random
    from collections import Counter

    rng = random.Random(max_terms)
    texts = [" ".join(rng.choice(["aa", "bb", "cc", "dd", "ee", "ff", "gg", "x"]) for _ in range(rng.randint(0, 12)))
             for _ in range(80)]
    stop = ["gg"]
    total, present = Counter(), Counter()
    for text in texts:
        toks = [w for w in text.split() if len(w) >= 2 and w not in stop]
        terms = toks + [f"{a} {b}" for a, b in zip(toks, toks[1:])]
        total.update(terms)
        present.update(set(terms))
    want = sorted(sorted(total.items(), key=lambda kv: (-kv[1], kv[0]))[:max_terms])
    df = spark.createDataFrame(list(enumerate(texts)), "review_id long, review_text string")
    fitted = TM.fit_vocabulary(df, stop, max_terms)
    rows = fitted.table.orderBy("idx").collect()
    assert [(r["term"], r["total"]) for r in rows] == want
    assert [r["df"] for r in rows] == [present[t] for t, _ in want]
    assert fitted.n_reviews == 80
    norms = TM.tfidf(df, fitted).groupBy("review_id").agg(F.sum(F.col("weight") ** 2).alias("n")).collect()
    assert all(r["n"] == pytest.approx(1.0) for r in norms)


# --- explanations -----------------------------------------------------------

def coefficient_rows(spark, weights):
    return P.coefficient_table(spark, [(i, "text", k, w, None, None, 1.0) for i, (k, w) in enumerate(weights.items())])


def python_html(text, weights):
    out = []
    for token in re.findall(r"\S+|\s+", text):
        weight = weights.get(re.sub(r"[^\w]", "", token).lower())
        shown = html.escape(token)
        name = None
        if weight is not None:
            name = ("strong_deceptive" if weight > 0.30 else "mild_deceptive" if weight > 0.05
                    else "strong_authentic" if weight < -0.30 else "mild_authentic" if weight < -0.05 else None)
        out.append(A.SPANS[name].replace("{w}", f"{weight:.2f}").replace("{t}", shown) if name else shown)
    return "".join(out)


def test_explanations(spark):
    weights = {"good": 0.31, "ok": 0.30, "meh": 0.05, "fine": -0.05, "bad": -0.30, "awful": -0.31, "dont": 0.2, "two words": 0.9}
    texts = ["Good, ok meh\n fine <bad> & awful!", "  leading good  ", "", "don't  two words", "\tgood", "none of them", "good\u2003ok "]
    df = spark.createDataFrame(list(enumerate(texts)), "review_id long, review_text string")
    table = coefficient_rows(spark, weights)
    want = {i: python_html(t, weights) for i, t in enumerate(texts)}
    in_row = {r[0]: r[1] for r in A.explain_words(df, table).collect()}
    assert in_row == want
    plain = {i: html.unescape(re.sub(r"</?span[^>]*>", "", h)) for i, h in in_row.items()}
    assert plain == dict(enumerate(texts))
    no_model = {r[0]: r[1] for r in A.explain_words(df, coefficient_rows(spark, {})).collect()}
    assert no_model == {i: html.escape(t) for i, t in enumerate(texts)}
    assert "Exchange" not in A.explain_words(df, table)._jdf.queryExecution().executedPlan().toString()


# --- evaluation -------------------------------------------------------------

# Three published confusion matrices and their metrics.
GOLDEN = [
    ((3666, 377, 458, 3582), (0.896696771000866, 0.904773932811316, 0.8866336633663366, 0.8956119514939368)),
    ((3576, 467, 467, 3573), (0.884448843251268, 0.8844059405940594, 0.8844059405940594, 0.8844059405940594)),
    ((3575, 468, 915, 3125), (0.8289001608313745, 0.8697467297522962, 0.7735148514851485, 0.8188130486047426)),
]


def test_golden_metrics(spark):
    counts = spark.createDataFrame([c for c, _ in GOLDEN], "tn long, fp long, fn long, tp long")
    got = E.classification_metrics(counts).orderBy(F.desc("accuracy")).select(*E.METRICS[:4]).collect()
    for row, (_, want) in zip(got, GOLDEN):
        assert tuple(row) == pytest.approx(want, abs=1e-12)


def test_metrics_without_positives(spark):
    counts = spark.createDataFrame([(5, 0, 0, 0), (0, 0, 0, 0)], "tn long, fp long, fn long, tp long")
    rows = [tuple(r) for r in E.classification_metrics(counts).orderBy("tn").select(*E.METRICS[:4]).collect()]
    assert rows == [(0.0, 0.0, 0.0, 0.0), (1.0, 0.0, 0.0, 0.0)]


def test_auc_against_pairs(spark):
    import random

    rng = random.Random(3)
    data = [(rng.randint(0, 1), round(rng.random() ** 3, rng.choice([1, 5]))) for _ in range(700)]
    pos = [s for t, s in data if t == 1]
    neg = [s for t, s in data if t == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame(data, "target int, probability double")
    for buckets in (2, 10, 1000):
        assert E.roc_auc(df, buckets=buckets).first()[0] == pytest.approx(want, abs=1e-12)
    assert E.roc_auc(df.withColumn("probability", F.lit(0.5))).first()[0] == pytest.approx(0.5)
    assert E.roc_auc(df.where("target = 1")).first()[0] is None


def test_best_model_keeps_the_earlier_tie(spark):
    report = spark.createDataFrame([(0, "a", 0.9), (1, "b", 0.9), (2, "c", 0.1)], "position long, model string, roc_auc double")
    assert E.best_model(report).first()["model"] == "a"


# --- profiles ---------------------------------------------------------------

def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 4, 10, 10]], "v double")
    bins = {r["bin"]: r["n_rows"] for r in D.histogram(df, "v", 5).collect()}
    assert bins == {0: 2, 1: 2, 2: 1, 4: 2}
    same = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert [tuple(r) for r in D.histogram(same, "v", 5).collect()] == [(0, 2.0, 2)]


def test_box_outliers(spark):
    df = spark.createDataFrame([("x", float(v)) for v in [1, 2, 3, 4, 5, 100]], "label string, f double")
    row = D.box_stats(df, ["f"], "label").first()
    assert (row["q25"], row["q50"], row["q75"]) == (2.25, 3.5, 4.75)
    assert (row["whisker_low"], row["whisker_high"], row["n_outliers"]) == (1.0, 5.0, 1)


def test_density_integrates_to_one(spark):
    df = spark.createDataFrame([("x", v / 50) for v in range(100)] + [("y", 1.0)], "label string, v double")
    rows = D.density(df, "v", "label", 200).orderBy("point").collect()
    assert len(rows) == 200 and {r["label"] for r in rows} == {"x"}
    step = rows[1]["x"] - rows[0]["x"]
    assert 0.85 < sum(r["density"] for r in rows) * step < 1.0


# --- user model -------------------------------------------------------------

def test_user_model_is_loaded_per_worker(spark):
    def load():
        import pandas as pd

        def model(texts):
            n = [float(len(t)) for t in texts]
            return pd.DataFrame({"neg": [0.0] * len(n), "neu": [0.0] * len(n), "pos": n})

        return model

    df = spark.createDataFrame([(1, "abc"), (2, "  "), (3, None)], "review_id long, review_text string")
    rows = {r["review_id"]: r for r in M.score_with(df, load).collect()}
    e = math.exp(3)
    assert rows[1]["model_sentiment"] == pytest.approx((e - 1) / (e + 2), abs=1e-4)
    assert (rows[2]["model_sentiment"], rows[2]["model_neu"]) == (0.0, 1.0)
    assert (rows[3]["model_sentiment"], rows[3]["model_neu"]) == (0.0, 1.0)


def test_pos_density(spark):
    lexicon = spark.createDataFrame([("runs", "VERB"), ("red", "ADJ"), ("car", "NOUN")], "token string, pos string")
    df = spark.createDataFrame([(1, "Red car runs"), (2, "nothing"), (3, "")], "review_id long, review_text string")
    got = {r["review_id"]: r["pos_density"] for r in M.pos_density(df, lexicon).collect()}
    assert got == {1: 2.0, 2: 0.0, 3: 0.0}


def test_head_takes_every_token_and_every_rated_review(spark):
    texts = [("awful rareword", 1.0), ("fine", 3.0), ("great", 5.0), ("", 5.0), (None, 1.0), ("unrated", None)] * 4
    df = spark.createDataFrame([(i, t, r) for i, (t, r) in enumerate(texts)],
                               "review_id long, review_text string, rating double")
    head, bias = M.fit_head(df)
    rows = {r["token"]: r for r in head.collect()}
    assert set(rows) == {"awful", "rareword", "fine", "great"}
    # A token that is one review's only one in a class pulls towards that class.
    assert rows["great"]["w_pos"] > rows["great"]["w_neg"] and rows["rareword"]["w_neg"] > rows["rareword"]["w_pos"]
    # Two ratings of three are at the ends, through reviews without any token as well: they show in the biases.
    assert len(bias) == 3 and bias[0] > bias[1] and bias[2] > bias[1]
    none = df.where("rating is null")
    assert M.fit_head(df.where("rating = 5"))[1][0] <= 0.0 and none.count() == 4


def test_terms_are_counted_behind_the_exchange_of_texts(spark):
    rows = [(1, "alpha beta alpha"), (1, "alpha"), (2, None), (None, "beta"), (None, "beta beta")]
    df = spark.createDataFrame(rows, "review_id int, review_text string")
    counted = TM.term_counts(df, [])
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "hashpartitioning" in line and "term" in line]
    assert sorted(((r[0] or 0, r[1], r[2]) for r in counted.collect())) == [
        (0, "beta", 3), (0, "beta beta", 1), (1, "alpha", 3), (1, "alpha beta", 1), (1, "beta", 1), (1, "beta alpha", 1)]
