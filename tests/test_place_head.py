"""The head by place: scores without a shuffle of tokens, a fit of few partitions, and the texts it reads."""

import pytest
from pyspark.sql import functions as F

from veristar.operators import lexicon as L
from veristar.operators import lookup
from veristar.operators import model_sentiment as M
from veristar.plans import inputs as I
from veristar.sources import params as P

SCHEMA = "review_id long, review_text string, rating double"


def _reviews(spark):
    texts = [("awful rareword, (Awful)", 1.0), ("fine thing!", 3.0), ("GREAT great good", 5.0), ("", 5.0), (None, 1.0), ("Σας ΣΑΣ :)", 2.0)] * 3
    # Unrated texts with known, unknown and repeated unknown words; ids that repeat or are missing.
    texts += [("great unseen unseen awful", None), ("unseen", None), ("fine", None), ("", None), (None, None)]
    rows = [(None if i % 7 == 6 else i // 2, t, r) for i, (t, r) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def _tables(spark, fitted, **places):
    return L.SentimentTables(P.sample_lexicon(spark), P.default_boosters(spark), P.default_negations(spark), *fitted, **places)


@pytest.mark.parametrize("covered", [None, "rating is not null"])
def test_scores_by_place_are_those_of_the_token_table(spark, monkeypatch, covered):
    df = _reviews(spark)
    fitted = M.fit_head(df)
    names = {"carry": {"rating": F.col("rating"), "again": F.col("review_text")}}
    want = L.sentiment_scores(df, _tables(spark, fitted), **names).collect()
    # Beyond the bound of a broadcast.
    monkeypatch.setattr(L, "small", lambda table: lookup.small(table, 1))
    tables = _tables(spark, fitted, places=fitted.places, covered=covered and F.expr(covered))
    got = L.sentiment_scores(df, tables, **names)
    assert sorted(map(str, got.collect())) == sorted(map(str, want)) and len(want) == 23
    assert got.columns == ["review_id", "rating", "again", "sentiment_score", "model_sentiment", "model_neg", "model_neu", "model_pos"]


def test_covered_reviews_shuffle_no_tokens(spark):
    df = _reviews(spark)
    fitted = M.fit_head(df)
    tables = _tables(spark, fitted, places=fitted.places, covered=F.col("rating").isNotNull())
    assert fitted[0].where("token = 'rareword'").count() == 1 and tables.facts.where("hit = 'rareword'").count() == 0
    plan = L.sentiment_scores(df, tables)._jdf.queryExecution().optimizedPlan().toString()
    # The one join with the head's table is that of the other reviews, read from what was written of them.
    assert plan.count("LeftAnti") == 1


def test_fit_sums_few_partitions(spark, monkeypatch):
    seen = []
    fit = M.LogisticRegression.fit

    def watched(self, data, *args):
        seen.append(data.rdd.getNumPartitions())
        return fit(self, data, *args)

    monkeypatch.setattr(M.LogisticRegression, "fit", watched)
    df = _reviews(spark).unionByName(spark.createDataFrame([(i, f"word{i} great", float(i % 5 + 1)) for i in range(200)], SCHEMA))
    M.fit_head(df.repartition(40), max_iter=2)
    assert seen[0] <= M.FEW_PARTS


def test_texts_come_as_often_as_their_labels(spark, tmp_path):
    docs = [(i, f"text {i}", "web") for i in range(1, 40)] + [(3, "again", "web"), (None, "no id", "web")]
    spark.createDataFrame(docs, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(1, 0), (2, 1), (2, 0), (3, 1), (3, 1), (3, None), (None, 1), (None, 0), (99, 1), (99, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    want = I.reviews(spark, str(tmp_path)).select("review_id", "rating", "review_text")
    got = I.rated_texts(spark, str(tmp_path))
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() == 46


def test_edges_of_tokens(spark):
    texts = ["(hello) :) a! -- 'tis... ok?! don't \"x\" ¿qué? «so» ab. abc. ..abc", "!!!", "", "a.b.c. (ab) (abc) 'é' 'éée'"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(L.sentiment_tokens(F.col("t"))).collect()
    marks = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
    assert [r[0] for r in got] == [[c if len(c := t.strip(marks)) > 2 else t for t in x.split()] for x in texts]
