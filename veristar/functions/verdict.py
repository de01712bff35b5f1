"""Probability -> class, flags and their messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds, class names and message formats.
DECEPTIVE_FROM = 0.50
DISSONANCE_ABOVE = 0.65
MODEL_GAP_ABOVE = 1.0
LEXICON_GAP_ABOVE = 1.0
PUNCTUATION_ABOVE = 6.0
DIVERSITY_BELOW = 0.40
LONG_NAMES = ("Computer-Generated / Deceptive", "Original / Authentic")
SHORT_NAMES = ("DECEPTIVE", "GENUINE")
NO_FLAGS = "None"
DECEPTIVE_LABELS = ("CG", "1", "FAKE")
DISSONANCE_MESSAGE = "High VADER-RoBERTa Dissonance ({})"
MODEL_GAP_MESSAGE = "High RoBERTa Sentiment Mismatch (Gap: {})"
LEXICON_GAP_MESSAGE = "High VADER Sentiment Mismatch (Gap: {})"
PUNCTUATION_MESSAGE = "Elevated Punctuation Density ({}/100 chars)"
DIVERSITY_MESSAGE = "Low Vocabulary Diversity ({} TTR)"


def two_decimals(value: Column) -> Column:
    """Text of a four-decimal number with two decimals, half rounded up."""
    return value.cast("decimal(18,4)").cast("decimal(18,2)").cast("string")


def fill(template: str, value: Column) -> Column:
    before, after = template.split("{}")
    return F.concat(F.lit(before), two_decimals(value), F.lit(after))


def target_of(label: Column) -> Column:
    """1 for a deceptive label, 0 for any other or a missing one."""
    from .text import strip_space

    hit = F.upper(strip_space(label)).isin(*DECEPTIVE_LABELS)
    return F.when(hit, F.lit(1)).otherwise(F.lit(0))


def is_deceptive(probability: Column) -> Column:
    return probability >= F.lit(DECEPTIVE_FROM)


def class_name(probability: Column, names: tuple[str, str] = SHORT_NAMES) -> Column:
    return F.when(is_deceptive(probability), F.lit(names[0])).otherwise(F.lit(names[1]))


def risk_factors(dissonance: Column, model_gap: Column, lexicon_gap: Column,
                 punctuation: Column, diversity: Column) -> Column:
    """Array of messages, in a fixed order; all tests are strict."""
    tests = [
        (dissonance > DISSONANCE_ABOVE, DISSONANCE_MESSAGE, dissonance),
        (model_gap > MODEL_GAP_ABOVE, MODEL_GAP_MESSAGE, model_gap),
        (lexicon_gap > LEXICON_GAP_ABOVE, LEXICON_GAP_MESSAGE, lexicon_gap),
        (punctuation > PUNCTUATION_ABOVE, PUNCTUATION_MESSAGE, punctuation),
        (diversity < DIVERSITY_BELOW, DIVERSITY_MESSAGE, diversity),
    ]
    return F.array_compact(F.array(*[F.when(test, fill(text, value)) for test, text, value in tests]))


def flags_text(flags: Column) -> Column:
    return F.when(F.size(flags) == 0, F.lit(NO_FLAGS)).otherwise(F.array_join(flags, ", "))
