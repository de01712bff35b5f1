"""Hand-computed rows and Python restatements of the rules."""

import math
import random
import re
import string

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from veristar.functions import sentiment as N
from veristar.functions import text as T
from veristar.functions import verdict as V

STYLE_ROWS = [
    ("", 0.0, 0.0, 0.0),
    ("!!!", 100.0, 0.0, 0.0),
    ("Good. Good! Bad?", 18.75, 0.6667, 1.0),
    ("Costs 3.5 euros", 6.6667, 1.0, 2.0),
    ("don't", 20.0, 1.0, 2.0),
    ("Très élégant été", 0.0, 1.0, 3.0),
    ("a_b a_b", 28.5714, 0.5, 2.0),
    ("   ", 0.0, 0.0, 0.0),
]


def one_column(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")


def test_style_rows(spark):
    t = F.col("t")
    rows = one_column(spark, [r[0] for r in STYLE_ROWS]).select(
        "i", T.punctuation_frequency(t), T.vocab_diversity(t), T.avg_sentence_length(t)).orderBy("i").collect()
    assert [tuple(r)[1:] for r in rows] == [r[1:] for r in STYLE_ROWS]


def python_syllables(text):
    total = 0
    for word in re.findall(r"\w+", text.lower()):
        groups = len(re.findall("[aeiouy]+", word))
        silent = 1 if re.search("[^aeiouyl]e$", word) else 0
        total += max(1, groups - silent)
    return total


def test_text_rules_against_python(spark):
    rng = random.Random(7)
    alphabet = "aeiouylbcdt eE  .!?,'-_3é\n\t\u00a0\u2003"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["the", "table", "see", "be", "rhythm", "e", "ale", "home", "queue", "le", "x", "ee e", "fire!", "bee-the"]
    t = F.col("t")
    rows = one_column(spark, texts).select(
        "t", T.word_count(t).alias("w"), T.sentence_count(t).alias("s"), T.syllable_count(t).alias("y"),
        F.regexp_count(t, F.lit(T.PUNCTUATION_MARK)).alias("p"), T.spaced_tokens(t).alias("k"),
        T.squeeze_space(t).alias("q")).collect()
    for r in rows:
        text = r["t"]
        assert r["w"] == len(re.findall(r"\b\w+\b", text.lower())), text
        assert r["s"] == len([s for s in re.split(r"[.!?]+", text) if s.strip()]), text
        assert r["y"] == python_syllables(text), text
        assert r["p"] == sum(ch in string.punctuation for ch in text), text
        assert r["k"] == text.split(), text
        assert r["q"] == re.sub(r"\s+", " ", text.strip()), text


def test_readability(spark):
    # 3 words, 1 sentence, 4 syllables (the, ta-ble, is).
    row = one_column(spark, ["The table is."]).select(
        T.flesch_reading_ease(F.col("t")), T.flesch_kincaid_grade(F.col("t"))).first()
    assert row[0] == pytest.approx(206.835 - 1.015 * 3 - 84.6 * 4 / 3, abs=1e-4)
    assert row[1] == pytest.approx(0.39 * 3 + 11.8 * 4 / 3 - 15.59, abs=1e-4)


def test_rating_scale(spark):
    want = {1.0: -1.0, 2.0: -0.5, 2.5: -0.25, 3.0: 0.0, 4.0: 0.5, 4.5: 0.75, 5.0: 1.0}
    rows = spark.createDataFrame([(k,) for k in want], "r double").select("r", N.rating_to_scale(F.col("r")).alias("s"))
    assert {r["r"]: r["s"] for r in rows.collect()} == want


def test_softmax(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, False), (5.0, 1.0, 2.0, True), (800.0, -800.0, 0.0, False)],
                               "a double, b double, c double, blank boolean")
    cols = N.model_sentiment_columns(F.col("a"), F.col("b"), F.col("c"), F.col("blank"))
    rows = [tuple(r) for r in df.select(*cols.values()).collect()]
    assert rows == [(0.0, 0.3333, 0.3333, 0.3333), (0.0, 0.0, 1.0, 0.0), (-1.0, 1.0, 0.0, 0.0)]


def test_flags_at_thresholds(spark):
    df = spark.createDataFrame([
        (0.65, 1.0, 1.0, 6.0, 0.40), (0.6501, 1.0001, 1.5, 6.25, 0.3999), (None, None, None, 0.0, 0.0)],
        "d double, m double, l double, p double, v double")
    flags = V.risk_factors(*[F.col(c) for c in "dmlpv"])
    rows = df.select(flags.alias("f"), V.flags_text(flags).alias("t")).collect()
    assert rows[0]["f"] == [] and rows[0]["t"] == "None"
    assert rows[1]["f"] == [
        "High VADER-RoBERTa Dissonance (0.65)", "High RoBERTa Sentiment Mismatch (Gap: 1.00)",
        "High VADER Sentiment Mismatch (Gap: 1.50)", "Elevated Punctuation Density (6.25/100 chars)",
        "Low Vocabulary Diversity (0.40 TTR)"]
    assert rows[2]["f"] == ["Low Vocabulary Diversity (0.00 TTR)"]


def test_classes_and_targets(spark):
    df = spark.createDataFrame([(0.5, " cg "), (0.49999, "OR"), (0.9, "fake"), (0.1, "1"), (0.2, None)], "p double, l string")
    rows = df.select(V.class_name(F.col("p")), V.class_name(F.col("p"), V.LONG_NAMES), V.target_of(F.col("l"))).collect()
    assert [r[0] for r in rows] == ["DECEPTIVE", "GENUINE", "DECEPTIVE", "GENUINE", "GENUINE"]
    assert rows[0][1] == "Computer-Generated / Deceptive" and rows[1][1] == "Original / Authentic"
    assert [r[2] for r in rows] == [1, 0, 1, 1, 0]


def test_html_escape(spark):
    import html

    text = "a & b < c > \"d\" 'e' &amp;"
    assert one_column(spark, [text]).select(T.html_escape(F.col("t"))).first()[0] == html.escape(text)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="abcde .!?'\n", max_size=40), min_size=1, max_size=20))
def test_style_properties(spark, texts):
    t = F.col("t")
    rows = one_column(spark, texts).select(T.vocab_diversity(t), T.punctuation_frequency(t)).collect()
    assert all(0.0 <= r[0] <= 1.0 and 0.0 <= r[1] <= 100.0 and not math.isnan(r[0]) for r in rows)
