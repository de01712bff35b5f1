"""The nine features per review, and the rows that still need them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.sentiment import gap, rating_to_scale
from .lexicon import SentimentTables, sentiment_scores

STYLE_COLS = ["punctuation_freq", "vocab_diversity", "readability_score", "avg_sentence_length"]
LEXICON_COLS = ["sentiment_score", "rating_sentiment_gap"]
MODEL_COLS = ["model_sentiment", "model_rating_gap", "sentiment_dissonance"]
STABLE_COLS = STYLE_COLS + LEXICON_COLS
FEATURE_COLS = STABLE_COLS + MODEL_COLS


def with_style(reviews: DataFrame, text_col: str = "review_text") -> DataFrame:
    """Add the four style features; every text pass is done once per row."""
    text = T.text_or_empty(F.col(text_col))
    counted = (
        reviews.withColumn("_words", T.words(text))
        .withColumns({"_n_words": F.size("_words"), "_n_sentences": T.sentence_count(text),
                      "_n_syllables": T.syllable_count(text)})
    )
    n_words, n_sentences = F.col("_n_words"), F.col("_n_sentences")
    return counted.withColumns({
        "punctuation_freq": T.punctuation_frequency(text),
        "vocab_diversity": T.diversity_of(F.col("_words")),
        "readability_score": T.reading_ease_of(n_words, n_sentences, F.col("_n_syllables")),
        "avg_sentence_length": T.ratio(n_words, n_sentences),
    }).drop("_words", "_n_words", "_n_sentences", "_n_syllables")


def gap_columns(rating: Column, lexicon: Column, model: Column) -> dict[str, Column]:
    scaled = rating_to_scale(rating.cast("double"))
    return {
        "rating_sentiment_gap": gap(lexicon, scaled),
        "model_rating_gap": gap(model, scaled),
        "sentiment_dissonance": gap(lexicon, model),
    }


def extract_features(reviews: DataFrame, tables: SentimentTables, keep: tuple[str, ...] = ()) -> DataFrame:
    """``review_id, review_text, rating`` -> ``review_id`` and the nine features.

    Used for training, scoring and the stream alike. A missing text counts as
    empty; a missing rating gives missing gaps.
    """
    carried = ["rating", *keep, *STYLE_COLS]
    scored = sentiment_scores(with_style(reviews), tables, {c: F.col(c) for c in carried})
    gaps = gap_columns(F.col("rating"), F.col("sentiment_score"), F.col("model_sentiment"))
    return scored.withColumns(gaps).select("review_id", *keep, *FEATURE_COLS)


def unprocessed_reviews(reviews: DataFrame, features: DataFrame) -> DataFrame:
    """Reviews without features, or whose model sentiment is still missing (retry)."""
    done = features.where(F.col("model_sentiment").isNotNull()).select("review_id")
    return reviews.join(done, "review_id", "left_anti")
