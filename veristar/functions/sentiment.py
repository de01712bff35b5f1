"""Arithmetic on ratings, sentiment scores and logits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rating_to_scale(rating: Column) -> Column:
    """A 1-5 star rating on the -1..1 scale of the sentiment scores."""
    return F.round((rating - 1) / 4 * 2 - 1, 4)


def gap(left: Column, right: Column) -> Column:
    return F.round(F.abs(left - right), 4)


def softmax3(neg: Column, neu: Column, pos: Column) -> Column:
    """Softmax of three logits, shifted by their maximum, as an array."""
    logits = F.array(neg, neu, pos)
    weights = F.transform(logits, lambda z: F.exp(z - F.greatest(neg, neu, pos)))
    total = F.aggregate(weights, F.lit(0.0), lambda sum_, w: sum_ + w)
    return F.transform(weights, lambda w: w / total)


def model_sentiment_columns(neg: Column, neu: Column, pos: Column, blank: Column) -> dict[str, Column]:
    """Rounded class shares and ``pos - neg``; blank text is neutral."""
    shares = F.when(blank, F.array(F.lit(0.0), F.lit(1.0), F.lit(0.0))).otherwise(softmax3(neg, neu, pos))
    p_neg, p_neu, p_pos = (F.get(shares, F.lit(i)) for i in range(3))
    return {
        "model_sentiment": F.round(p_pos - p_neg, 4), "model_neg": F.round(p_neg, 4),
        "model_neu": F.round(p_neu, 4), "model_pos": F.round(p_pos, 4),
    }
