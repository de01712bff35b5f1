"""Word-level explanation of a linear score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.verdict import two_decimals
from .lookup import one_of, small
from .rowterms import binary_order, number_array, with_counts

# Weight bands and the markup of each.
STRONG, MILD = 0.30, 0.05
SPANS = {
    "strong_deceptive": "<span style='background-color:#7F1D1D; color:#FCA5A5; padding:2px 6px; border-radius:4px; font-weight:600;' title='Deceptive Weight: +{w}'>{t}</span>",
    "mild_deceptive": "<span style='background-color:#991B1B; color:#FECACA; padding:2px 4px; border-radius:4px;' title='Deceptive Weight: +{w}'>{t}</span>",
    "strong_authentic": "<span style='background-color:#064E3B; color:#6EE7B7; padding:2px 6px; border-radius:4px; font-weight:600;' title='Authentic Weight: {w}'>{t}</span>",
    "mild_authentic": "<span style='background-color:#065F46; color:#A7F3D0; padding:2px 4px; border-radius:4px;' title='Authentic Weight: {w}'>{t}</span>",
}
# Between a blank and a token: cuts a text into tokens with the whitespace that follows them.
CHUNK_START = f"(?<=[{T.SPACE_CHARS}])(?![{T.SPACE_CHARS}])"


def word_weights(coefficients: DataFrame) -> DataFrame:
    """``key, weight`` for every named coefficient; a word shared with a number
    column keeps the later entry."""
    named = coefficients.where(F.col("kind") != "intercept")
    return named.groupBy(F.lower("feature").alias("key")).agg(F.max_by("weight", "idx").alias("weight"))


def band(weight: Column) -> Column:
    return (
        F.when(weight > STRONG, F.lit("strong_deceptive")).when(weight > MILD, F.lit("mild_deceptive"))
        .when(weight < -STRONG, F.lit("strong_authentic")).when(weight < -MILD, F.lit("mild_authentic"))
        .otherwise(F.lit("neutral"))
    )


def _weighted_tokens(reviews: DataFrame, coefficients: DataFrame, text_col: str) -> DataFrame:
    chunks = F.split(T.text_or_empty(F.col(text_col)), CHUNK_START)
    rows = reviews.select("review_id", F.posexplode(chunks).alias("pos", "chunk"))
    rows = rows.withColumn("token", F.regexp_replace("chunk", f"[{T.SPACE_CHARS}]+$", ""))
    weights = small(word_weights(coefficients))
    return rows.join(weights, T.token_key(F.col("token")) == weights["key"], "left").withColumn(
        "band", band(F.coalesce("weight", F.lit(0.0))))


def word_attribution(reviews: DataFrame, coefficients: DataFrame, text_col: str = "review_text") -> DataFrame:
    """Tidy form: ``review_id, pos, token, weight, band`` of the tokens with a weight."""
    rows = _weighted_tokens(reviews, coefficients, text_col)
    return rows.where(F.col("weight").isNotNull()).select("review_id", "pos", "token", "weight", "band")


def explain_words(reviews: DataFrame, coefficients: DataFrame, text_col: str = "review_text",
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """``review_id``, kept columns, ``explained_html``: the escaped text with coloured spans.

    A row for each row of ``reviews``, in one way for models of every size: a row's known words are counted in the row,
    in the order of the model's words. Its own words, sorted, meet these counts one by one, and go back to their places.
    """
    # As many rows as the model has words.
    weights = {r["key"]: r["weight"] for r in word_weights(coefficients).collect() if r["key"] is not None}
    text = T.text_or_empty(F.col(text_col))
    if not weights:
        return reviews.select("review_id", *keep, T.html_escape(text).alias("explained_html"))
    words = binary_order(weights)
    known, number = one_of(words), number_array([weights[w] for w in words])
    # Escaping adds no whitespace, so raw and escaped chunks line up.
    rows = reviews.select("review_id", *keep, F.split(text, CHUNK_START).alias("_raw"),
                          F.split(T.html_escape(text), CHUNK_START).alias("_shown"))
    rows = with_counts(rows.withColumn("_keys", F.transform("_raw", T.token_key)), F.col("_keys"), words, "_known")
    places = "transform(_keys, (k, i) -> struct(k, i))"
    sorted_known = f"array_sort(filter({places}, p -> {known('p.k')}))"
    in_order = (f"flatten(zip_with(_known.indices, _known.values, (i, n) -> array_repeat(get({number}, i), cast(n as int))))")
    found = f"zip_with({sorted_known}, {in_order}, (p, w) -> struct(p.i as i, w as w))"
    others = f"transform(filter({places}, p -> not {known('p.k')}), p -> struct(p.i as i, cast(null as double) as w))"
    return rows.withColumn("_weights", F.expr(f"array_sort(concat({found}, {others})).w")).select(
        "review_id", *keep, F.array_join(F.zip_with("_shown", "_weights", _decorate), "").alias("explained_html"))


def _decorate(chunk: Column, weight: Column) -> Column:
    """A chunk with its span; the whitespace behind the token stays outside."""
    token = F.rtrim(chunk, F.lit(T.SPACES))
    space = F.substring(chunk, F.length(token) + 1, F.length(chunk))
    return F.when(F.coalesce(F.abs(weight) > MILD, F.lit(False)), F.concat(_span(band(weight), token, weight), space)) \
        .otherwise(chunk)


def _span(name: Column, shown: Column, weight: Column) -> Column:
    span = shown
    for key, markup in SPANS.items():
        start, rest = markup.split("{w}")
        middle, end = rest.split("{t}")
        span = F.when(name == key, F.concat(
            F.lit(start), weight.cast("decimal(18,2)").cast("string"), F.lit(middle), shown, F.lit(end))).otherwise(span)
    return span
