"""Linear scoring of large tables, verdicts, and the batch scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import verdict as V
from .attribution import explain_words
from .features import FEATURE_COLS, extract_features
from .lexicon import SentimentTables
from .rowterms import binary_order, free_name, number_array, with_counts
from .terms import known_terms, tokens
from .verdict_counts import scan_counts, summary_of

RESULT_COLS = [
    "deceptive_probability_pct", "classification", "risk_factors", "lexicon_sentiment", "model_sentiment",
    "sentiment_dissonance", "vocab_diversity", "readability_score",
]


def with_text_score(reviews: DataFrame, coefficients: DataFrame, stop_words: list[str]) -> DataFrame:
    """Add ``text_z``, the text part of the linear score; missing without a known term.

    One program for models of every size: the terms of a row are counted in the row, so every row, also one that
    repeats an id, has its own score. Entries of a model that repeat a term add up, each as a term of its own.
    """
    fitted = coefficients.where("kind = 'text'").groupBy("feature").agg(
        F.sum(F.col("idf") * F.col("weight")).alias("push"), F.sum(F.col("idf") * F.col("idf")).alias("square"))
    # As many rows as the model has terms.
    model = {r["feature"]: r for r in fitted.collect() if r["feature"] is not None}
    terms = binary_order(model)
    push, square = (number_array([model[t][c] for t in terms]) for c in ("push", "square"))
    toks, known = free_name(reviews, "toks"), free_name(reviews, "known")
    # Terms are named after the token column they are made of.
    arrays = reviews.withColumn(toks, tokens(T.text_or_empty(F.col("review_text")), stop_words))
    counted = with_counts(arrays, F.expr(known_terms(terms, f"`{toks}`")), terms, known)
    tf = f"transform(`{known}`.values, c -> ln(c) + 1)"
    z = f"aggregate(zip_with(`{known}`.indices, {tf}, (i, f) -> f * get({push}, i)), 0D, (x, y) -> x + y)"
    norm = f"aggregate(zip_with(`{known}`.indices, {tf}, (i, f) -> f * f * get({square}, i)), 0D, (x, y) -> x + y)"
    return counted.withColumn("text_z", F.expr(f"{z} / nullif(sqrt({norm}), 0D)")).drop(toks, known)


def number_part(coefficients: DataFrame):
    """Scaled numbers times weights plus the intercept, as one column expression.

    A model has nine such rows, so they are read into the expression.
    """
    z, rows = F.lit(0.0), coefficients.where("kind <> 'text'").orderBy("idx").collect()
    if not rows:
        raise ValueError("no coefficients: the model is not linear, score with the model itself (scan_bundle)")
    for r in rows:
        if r["kind"] == "intercept":
            z = z + F.lit(r["weight"])
        else:
            z = z + (F.coalesce(F.col(r["feature"]), F.lit(0.0)) - r["mean"]) / r["std"] * r["weight"]
    return z


def with_probability(scored: DataFrame, coefficients: DataFrame) -> DataFrame:
    """Features and ``text_z`` -> the unrounded ``probability``."""
    z = number_part(coefficients) + F.coalesce("text_z", F.lit(0.0))
    return scored.withColumn("probability", 1 / (1 + F.exp(-z))).drop("text_z")


def score_linear(features: DataFrame, reviews: DataFrame, coefficients: DataFrame,
                 stop_words: list[str]) -> DataFrame:
    """Score a stored feature table, which has a row for each id; reviews without a known term keep their number part.

    Reviews that repeat an id are scored each, with the features stored for it.
    """
    texts = with_text_score(reviews.select("review_id", "review_text"), coefficients, stop_words)
    return with_probability(features.join(texts.drop("review_text"), "review_id", "left"), coefficients)


def extract_and_score(reviews: DataFrame, tables: SentimentTables, coefficients: DataFrame, stop_words: list[str],
                      keep: tuple[str, ...] = ()) -> DataFrame:
    """Features and probability in one pass over the texts: the text score
    travels with the style features, so nothing is joined."""
    scored = with_text_score(reviews, coefficients, stop_words)
    return with_probability(extract_features(scored, tables, (*keep, "text_z")), coefficients)


def classify(scored: DataFrame, probability: str = "probability") -> DataFrame:
    p = F.col(probability)
    return scored.withColumns({
        "deceptive_probability": F.round(p, 4),
        "deceptive_percentage": F.round(p * 100, 2),
        "is_deceptive": V.is_deceptive(p),
        "classification": V.class_name(p, V.LONG_NAMES),
        "class_code": V.class_name(p, V.SHORT_NAMES),
    })


def risk_flags(features: DataFrame) -> DataFrame:
    flags = V.risk_factors(*[F.col(c) for c in (
        "sentiment_dissonance", "model_rating_gap", "rating_sentiment_gap", "punctuation_freq", "vocab_diversity")])
    return features.withColumn("risk_factors", flags)


def scan(reviews: DataFrame, tables: SentimentTables, coefficients: DataFrame, stop_words: list[str],
         keep: tuple[str, ...] = ("rating",)) -> DataFrame:
    """Score every review: kept input columns plus the eight result columns.

    One pass over the texts and one shuffle of narrow rows. ``keep`` is for
    narrow columns; join the result on ``review_id`` where texts must be repeated.
    """
    return scan_columns(extract_and_score(reviews, tables, coefficients, stop_words, keep), keep)


def scan_bundle(reviews: DataFrame, tables: SentimentTables, bundle, keep: tuple[str, ...] = ("rating",)) -> DataFrame:
    """``scan`` with whatever model was saved: coefficients for a linear one, else the model on vectors."""
    if not bundle.coefficients.isEmpty():
        return scan(reviews, tables, bundle.coefficients, bundle.stop_words, keep)
    from .terms import Vocabulary
    from .training import materialize_vectors, model_probability, vectorize

    if not bundle.model.hasParam("probabilityCol"):
        raise ValueError(f"{bundle.model_name} gives no probability")
    vocabulary = Vocabulary(bundle.vocabulary, bundle.n_reviews, bundle.stop_words)
    keyed = reviews.withColumns(row_key())
    found = extract_features(keyed, tables, (*keep, *ROW_KEY)).dropDuplicates(list(ROW_KEY))
    data = keyed.select(*ROW_KEY, "review_text").join(found, list(ROW_KEY))
    filled = data.withColumns({"_review_text": F.coalesce("review_text", F.lit("")), **{
        f"_{c}": F.coalesce(c, F.lit(0.0)) for c in FEATURE_COLS}})
    numbers = filled.select("review_id", *keep, F.struct(*FEATURE_COLS).alias("found"), F.col("_review_text").alias("review_text"),
                            *[F.col(f"_{c}").alias(c) for c in FEATURE_COLS])
    vectors = materialize_vectors(vectorize(
        numbers, bundle.scaler, vocabulary, bundle.model.numFeatures - len(FEATURE_COLS), (*keep, "found")))
    scored = model_probability(bundle.model, vectors, (*keep, "found"))
    return scan_columns(scored.select("review_id", *keep, "probability", "found.*"), keep)


#: Names of the key below; they travel with the extraction.
ROW_KEY = ("_key1", "_key2")


def row_key() -> dict[str, Column]:
    """A 128-bit key of what a review's results depend on: rows that share it have the same results."""
    parts = [F.col(c) for c in ("review_id", "rating", "review_text")]
    present = [p.isNull().cast("int") for p in parts]
    return {name: F.xxhash64(F.lit(i), *present, *parts) for i, name in enumerate(ROW_KEY)}


def scan_columns(scored: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """Features and probability -> kept input columns and the eight results."""
    scored = risk_flags(scored)
    p = F.col("probability")
    return scored.select(
        "review_id", *keep,
        F.round(p * 100, 2).alias("deceptive_probability_pct"),
        V.class_name(p).alias("classification"),
        V.flags_text(F.col("risk_factors")).alias("risk_factors"),
        F.col("sentiment_score").alias("lexicon_sentiment"),
        "model_sentiment", "sentiment_dissonance", "vocab_diversity", "readability_score",
    )


def filter_class(scanned: DataFrame, view: str = "all") -> DataFrame:
    """``all``, ``deceptive`` or ``genuine`` rows of a scan."""
    codes = dict(zip(("deceptive", "genuine"), V.SHORT_NAMES))
    if view == "all":
        return scanned
    return scanned.where(F.col("classification") == codes[view])


def scan_summary(scanned: DataFrame) -> DataFrame:
    return summary_of(scanned.agg(*[c.alias(n) for n, c in scan_counts().items()]))


def analyze(reviews: DataFrame, tables: SentimentTables, coefficients: DataFrame,
            stop_words: list[str]) -> DataFrame:
    """The detailed result per review: text, probability, class, nested features, list of flags, explained text.

    A row for each row of ``reviews``, also where ids repeat.
    """
    keyed = reviews.withColumns(row_key())
    scored = classify(risk_flags(extract_and_score(keyed, tables, coefficients, stop_words, ("rating", *ROW_KEY))))
    results = scored.select(
        "review_id", "rating", "deceptive_probability", "deceptive_percentage", "is_deceptive", "classification",
        F.struct(*FEATURE_COLS).alias("features"), "risk_factors", *ROW_KEY).dropDuplicates(list(ROW_KEY))
    explained = explain_words(keyed, coefficients, keep=("review_text", *ROW_KEY)).drop("review_id")
    return explained.join(results, list(ROW_KEY)).select(
        "review_id", "review_text", "explained_html", *[c for c in results.columns if c not in ("review_id", *ROW_KEY)])
