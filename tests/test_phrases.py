"""Phrases as tokens: matching against a plain walk, and scores by hand."""

import random

import pytest
from pyspark.sql import functions as F

from veristar.operators import lexicon as L
from veristar.operators import phrases as PH
from veristar.sources import params as P


def _walk(tokens, phrases):
    """Leftmost, then longest, word by word."""
    known = {tuple(p.split(" ")) for p in phrases}
    sizes = sorted({len(p) for p in known}, reverse=True)
    out, i = [], 0
    while i < len(tokens):
        n = next((n for n in sizes if tuple(t.lower() for t in tokens[i:i + n]) in known), 1)
        out.append(" ".join(tokens[i:i + n]))
        i += n
    return out


def test_matches_a_plain_walk(spark):
    rng = random.Random(7)
    alphabet = ["a", "B", "b", "c.d", "C.D", "x\\E", "$1", "(", "É"]
    phrases = ["a b", "b a", "a b c.d", "b b b b", "x\\e $1", "( (", "é a", "c.d a b", "a a"]
    rows = [(i, rng.choices(alphabet, k=rng.choice([0, 1, 2, 5, 40, 300]))) for i in range(300)] + [(300, None)]
    df = spark.createDataFrame(rows, "id int, ws array<string>")
    got = {r["id"]: r["toks"] for r in PH.with_phrases(df, F.coalesce("ws", F.expr("cast(array() as array<string>)")), phrases).collect()}
    assert got == {i: _walk(ws or [], phrases) for i, ws in rows}
    clash = PH.with_phrases(df.withColumn("_toks", F.lit(1)).withColumn("_present", F.lit(2)), F.col("ws"), phrases)
    assert clash.columns == ["id", "ws", "_toks", "_present", "toks"]


def test_dot_is_no_wildcard(spark):
    df = spark.createDataFrame([(["cxd", "a"], )], "ws array<string>")
    assert PH.with_phrases(df, F.col("ws"), ["c.d a"]).first()["toks"] == ["cxd", "a"]


@pytest.fixture(scope="module")
def tables(spark):
    return L.SentimentTables(
        P.lexicon_table(spark, {"bad": -2.5, "good": 1.9, "not bad": 1.5, "the bomb": 3.0, "bad news": -3.0}),
        P.booster_table(spark, {"very": 0.293, "kind of": -0.293}), P.token_table(spark, ["not"]))


def _compound(total):
    return round(total / (total * total + 15) ** 0.5, 4)


def test_scores_by_hand(spark, tables):
    texts = {
        1: ("it is not bad", 1.5, 1),                      # the phrase in place of a negated word
        2: ("it is not bad news", 1.5, 1),                 # begins first, though the other is as long
        3: ("very not bad", 1.5 + 0.293, 1),
        4: ("kind of good", 1.9 - 0.293, 1),               # a booster of two words stands right in front
        5: ("it is THE BOMB", 3.0 + 0.733, 1),
        6: ("bad", -2.5, 0), 7: ("", 0.0, 0), 8: (None, 0.0, 0),
        9: ("the bomb!", 3.0 + 0.292, 1),
    }
    rows = [(i, t) for i, (t, _, _) in texts.items()] + [(6, "the bomb, the bomb")]
    got = PH.phrase_sentiment(spark.createDataFrame(rows, "review_id int, review_text string"), tables).collect()
    want = sorted([(i, _compound(s), n) for i, (_, s, n) in texts.items()] + [(6, _compound(6.0), 2)])
    assert sorted((r["review_id"], r["sentiment_score"], r["n_phrases"]) for r in got) == want


def test_without_phrases_nothing_changes(spark):
    tables = L.default_tables(spark)
    df = spark.createDataFrame([(1, "very good, not bad"), (2, None)], "review_id int, review_text string")
    plain = {tuple(r) for r in L.lexicon_sentiment(df, tables).collect()}
    assert {tuple(r)[:2] for r in PH.phrase_sentiment(df, tables).collect()} == plain
    assert PH.phrase_sentiment(df.limit(0), tables).count() == 0
