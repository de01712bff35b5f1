"""Parameter tables: lexicon, modifiers, stop words, sentiment head, coefficients.

The published libraries' full word lists are not shipped. The defaults below are
short samples; pass the path of a full list to the ``read_*`` functions.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import local_table

# Rule constants of the published lexicon method (ICWSM 2014).
BOOST = 0.293
DAMPING = (1.0, 0.95, 0.9)
NEGATION_FACTOR = -0.74
CAPS_EMPHASIS = 0.733
BEFORE_CONTRAST, AFTER_CONTRAST = 0.5, 1.5
EXCLAMATION_STEP, EXCLAMATION_MAX = 0.292, 4
QUESTION_STEP, QUESTION_STEPS_MAX, QUESTION_CEILING = 0.18, 3, 0.96
NORMALIZER = 15.0
CONTRAST_WORD = "but"

# Sample lists (valence on -4..4, as in the published method).
SAMPLE_LEXICON = {
    "amazing": 2.8, "awesome": 3.1, "bad": -2.5, "beautiful": 2.9, "best": 3.2,
    "boring": -1.3, "broken": -2.1, "cheap": -0.8, "comfortable": 2.3, "defective": -1.9,
    "disappointed": -2.1, "disappointing": -2.2, "easy": 1.9, "enjoy": 2.2, "excellent": 2.7,
    "fail": -2.5, "fantastic": 2.6, "fine": 0.8, "good": 1.9, "great": 3.1,
    "happy": 2.7, "hate": -2.7, "horrible": -2.5, "like": 1.5, "love": 3.2,
    "nice": 1.8, "no": -1.2, "perfect": 2.7, "poor": -2.1, "problem": -1.7,
    "recommend": 1.5, "sad": -2.1, "terrible": -2.1, "useless": -1.8, "waste": -1.8,
    "wonderful": 2.7, "worst": -3.1, "wrong": -2.1,
}
INTENSIFIERS = (
    "absolutely", "completely", "especially", "extremely", "highly", "incredibly",
    "more", "most", "particularly", "really", "so", "totally", "truly", "very",
)
DAMPENERS = ("almost", "barely", "hardly", "kinda", "less", "little", "partly", "slightly", "somewhat")
NEGATIONS = (
    "aint", "arent", "can't", "cannot", "cant", "didn't", "didnt", "doesn't", "doesnt",
    "don't", "dont", "isn't", "isnt", "neither", "never", "none", "nor", "not", "nothing",
    "nowhere", "wasn't", "wasnt", "without", "won't", "wont", "wouldn't", "wouldnt",
)


def lexicon_table(spark: SparkSession, valences: dict[str, float]) -> DataFrame:
    return local_table(spark, {
        "token": (pa.string(), list(valences)),
        "valence": (pa.float64(), [float(v) for v in valences.values()]),
    })


def booster_table(spark: SparkSession, scalars: dict[str, float]) -> DataFrame:
    return local_table(spark, {
        "token": (pa.string(), list(scalars)),
        "scalar": (pa.float64(), [float(v) for v in scalars.values()]),
    })


def column_table(spark: SparkSession, name: str, entries) -> DataFrame:
    return local_table(spark, {name: (pa.string(), list(entries))})


def token_table(spark: SparkSession, tokens) -> DataFrame:
    return column_table(spark, "token", tokens)


def weight_table(spark: SparkSession, first: str, rows: list[tuple]) -> DataFrame:
    """Whole-number weights of a tag model: ``(first, tag, weight)``."""
    columns = list(zip(*rows)) if rows else [[], [], []]
    kinds = (pa.string(), pa.string(), pa.int64())
    return local_table(spark, {n: (k, list(c)) for n, k, c in zip((first, "tag", "weight"), kinds, columns)})


def sample_lexicon(spark: SparkSession) -> DataFrame:
    return lexicon_table(spark, SAMPLE_LEXICON)


def default_boosters(spark: SparkSession) -> DataFrame:
    scalars = {word: BOOST for word in INTENSIFIERS} | {word: -BOOST for word in DAMPENERS}
    return booster_table(spark, scalars)


def default_negations(spark: SparkSession) -> DataFrame:
    return token_table(spark, NEGATIONS)


def default_stop_words() -> list[str]:
    """Spark's own English list."""
    return StopWordsRemover.loadDefaultStopWords("english")


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated ``token  valence  ...`` without a header; further columns are ignored."""
    parts = F.split("value", "\t")
    return (
        spark.read.text(path)
        .select(F.lower(F.get(parts, F.lit(0))).alias("token"),
                F.get(parts, F.lit(1)).try_cast("double").alias("valence"))
        .where("token is not null and valence is not null")
        .groupBy("token").agg(F.max("valence").alias("valence"))
    )


def read_token_list(spark: SparkSession, path: str) -> DataFrame:
    """One token per line."""
    return (
        spark.read.text(path).select(F.lower(F.trim("value")).alias("token"))
        .where("token <> ''").distinct()
    )


def head_table(spark: SparkSession, weights: dict[str, tuple[float, float, float]]) -> DataFrame:
    """Weights of a linear three-class sentiment head, one row per token."""
    neg, neu, pos = zip(*weights.values())
    return local_table(spark, {
        "token": (pa.string(), list(weights)),
        "w_neg": (pa.float64(), list(neg)),
        "w_neu": (pa.float64(), list(neu)),
        "w_pos": (pa.float64(), list(pos)),
    })


def coefficient_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Frozen linear model: ``(idx, kind, feature, weight, mean, std, idf)``.

    ``kind`` is ``intercept``, ``num`` (mean and std set) or ``text`` (idf set).
    """
    names = ("idx", "kind", "feature", "weight", "mean", "std", "idf")
    kinds = (pa.int64(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.float64(), pa.float64())
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return local_table(spark, {n: (k, list(c)) for n, k, c in zip(names, kinds, columns)})
