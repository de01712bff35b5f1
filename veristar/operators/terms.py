"""TF-IDF: terms, vocabulary, weights."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import local_table
from .lookup import IN_ROW_TOKENS, one_of, tokens_of

# Vocabulary size and shortest token of the text features.
MAX_TERMS = 2000
MIN_TOKEN = 2


def tokens(text: Column, stop_words: list[str]) -> Column:
    """Lower-case words of at least two characters without the stop words."""
    def keep(word: Column) -> Column:
        long_enough = F.length(word) >= MIN_TOKEN
        return long_enough & ~word.isin(stop_words) if stop_words else long_enough

    return F.filter(T.words(text), keep)


# Neighbouring tokens joined by a blank.
_NEIGHBOURS = "case when size(toks) > 1 then sequence(0, size(toks) - 2) else cast(array() as array<int>) end"
_PAIR = "concat(get(toks, i), ' ', get(toks, i + 1))"
BIGRAMS = f"transform({_NEIGHBOURS}, i -> {_PAIR})"
ALL_TERMS = f"concat(toks, {BIGRAMS})"


def token_arrays(reviews: DataFrame, stop_words: list[str], text_col: str = "review_text",
                 id_col: str = "review_id", keep: tuple[str, ...] = ()) -> DataFrame:
    text = T.text_or_empty(F.col(text_col))
    return reviews.select(id_col, *keep, tokens(text, stop_words).alias("toks"))


def known_only(lookup: DataFrame | None, col: str) -> str:
    """The term array of a row, thinned out to the terms of a small lookup inside the row."""
    found = tokens_of(lookup, col) if lookup is not None else None
    return ALL_TERMS if found is None else known_terms(found)


def known_terms(vocabulary: list[str], toks: str = "toks") -> str:
    """SQL array of the terms of a row that are in ``vocabulary``, each as often as it occurs, single words first.

    Two neighbours are joined only where a bigram of the vocabulary begins with the one and ends with the other.
    Beyond the bound of a test in the row these are all terms, and what counts them leaves out the others.
    """
    if len(vocabulary) > IN_ROW_TOKENS:
        return ALL_TERMS.replace("toks", toks)
    pairs = sorted(t for t in vocabulary if t.count(" ") == 1)
    first, second = (one_of(sorted({p.split(" ")[k] for p in pairs})) for k in (0, 1))
    single = one_of(sorted(t for t in vocabulary if " " not in t))
    words = f"filter({toks}, x -> {single('x')})"
    if not pairs:
        return words
    neighbours, pair = _NEIGHBOURS.replace("toks", toks), _PAIR.replace("toks", toks)
    both = f"{first(f'get({toks}, i)')} and {second(f'get({toks}, i + 1)')}"
    joined = f"transform(filter({neighbours}, i -> {both}), i -> {pair})"
    return f"concat({words}, filter({joined}, x -> {one_of(pairs)('x')}))"


def term_rows(reviews: DataFrame, stop_words: list[str], lookup: DataFrame | None = None, col: str = "term",
              **names) -> DataFrame:
    """One row per unigram and bigram occurrence; with ``lookup``, of its terms."""
    id_col = names.get("id_col", "review_id")
    arrays = token_arrays(reviews, stop_words, **names)
    return arrays.select(id_col, F.explode(F.expr(known_only(lookup, col))).alias("term"))


def term_counts(reviews: DataFrame, stop_words: list[str], **names) -> DataFrame:
    """``id, term, tf``.

    Texts are dealt out by id and cut into terms behind that, so the terms, many times the text, are counted where they arise.
    """
    id_col, text_col = names.get("id_col", "review_id"), names.get("text_col", "review_text")
    dealt = reviews.select(id_col, *names.get("keep", ()), text_col).repartition(id_col)
    rows = term_rows(dealt, stop_words, **names)
    return rows.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))


@dataclass(frozen=True)
class Vocabulary:
    """Fitted terms: ``term, idx, total, df, idf``, at most ``max_terms`` rows."""

    table: DataFrame
    n_reviews: int
    stop_words: list[str]


def _top_counts(terms: DataFrame, k: int) -> list[tuple[str, int]]:
    """The ``k`` most frequent values of ``term``, ties by term."""
    counts = terms.groupBy("term").agg(F.count(F.lit(1)).alias("total"))
    return [(r["term"], r["total"]) for r in counts.orderBy(F.desc("total"), "term").limit(k).collect()]


def top_terms(reviews: DataFrame, stop_words: list[str], max_terms: int = MAX_TERMS,
              **names) -> list[tuple[str, int]]:
    """The most frequent terms over the corpus with their counts, ties by term.

    Every occurrence of a bigram uses up one occurrence of each of its words.
    So once ``max_terms`` words reach a count, no bigram with a rarer word can
    enter the list, and only bigrams of frequent words need to be counted: the
    long tail of bigrams is never shuffled, and the result is still exact.
    """
    arrays = token_arrays(reviews, stop_words, **names)
    words = _top_counts(arrays.select(F.explode("toks").alias("term")), 2 * max_terms)
    floor = words[max_terms - 1][1] if len(words) >= max_terms else 1
    # All words at or above the bar are known unless very many tie at it; then
    # every bigram is counted.
    complete = len(words) < 2 * max_terms or words[-1][1] < floor
    pairs = BIGRAMS
    if floor > 1 and complete:
        frequent = one_of([word for word, n in words if n >= floor])
        both = f"{frequent('get(toks, i)')} and {frequent('get(toks, i + 1)')}"
        pairs = f"transform(filter({_NEIGHBOURS}, i -> {both}), i -> {_PAIR})"
    doubles = _top_counts(arrays.select(F.explode(F.expr(pairs)).alias("term")), max_terms)
    return sorted(words + doubles, key=lambda r: (-r[1], r[0]))[:max_terms]


def fit_vocabulary(reviews: DataFrame, stop_words: list[str], max_terms: int = MAX_TERMS, **names) -> Vocabulary:
    """Choose the terms and count the reviews each occurs in.

    The fitted table has at most ``max_terms`` rows and is held by the driver,
    like any other fitted model.
    """
    spark = reviews.sparkSession
    chosen = sorted(top_terms(reviews, stop_words, max_terms, **names))
    columns = {
        "term": (pa.string(), [t for t, _ in chosen]),
        "idx": (pa.int64(), list(range(len(chosen)))),
        "total": (pa.int64(), [n for _, n in chosen]),
    }
    base = local_table(spark, columns)
    arrays = token_arrays(reviews, stop_words, **names)
    present = F.expr(f"array_distinct({known_terms(list(columns['term'][1]))})")
    # The count of all reviews rides along as the count of a null term.
    found = arrays.select(F.explode(F.concat(present, F.array(F.lit(None).cast("string")))).alias("term")) \
        .groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    if len(chosen) > IN_ROW_TOKENS:
        wanted = base.select("term").unionByName(spark.range(1).select(F.lit(None).cast("string").alias("term")))
        found = found.join(wanted, found["term"].eqNullSafe(wanted["term"]), "left_semi")
    counts = {r["term"]: r["df"] for r in found.collect()}
    n = counts.pop(None, 0)
    columns["df"] = (pa.int64(), [counts[t] for t, _ in chosen])
    table = local_table(spark, columns).withColumn("idf", smooth_idf(F.lit(n), F.col("df")))
    return Vocabulary(table, n, stop_words)


def smooth_idf(n_reviews: Column, df: Column) -> Column:
    return F.log((n_reviews + 1) / (df + 1)) + 1


def sublinear_tf(tf: Column) -> Column:
    return F.log(tf) + 1


def raw_weights(reviews: DataFrame, vocabulary: Vocabulary, **names) -> DataFrame:
    """``id, idx, term, w`` before normalising; only known terms leave the map side."""
    id_col = names.get("id_col", "review_id")
    known = F.broadcast(vocabulary.table.select("term", "idx", "idf"))
    counted = (
        term_rows(reviews, vocabulary.stop_words, vocabulary.table, **names).join(known, "term")
        .groupBy(id_col, "idx", "term", "idf").agg(F.count(F.lit(1)).alias("tf"))
    )
    return counted.select(id_col, "idx", "term", (sublinear_tf(F.col("tf")) * F.col("idf")).alias("w"))


def tfidf(reviews: DataFrame, vocabulary: Vocabulary, **names) -> DataFrame:
    """``id, idx, term, weight`` with unit length per review."""
    from pyspark.sql import Window

    id_col = names.get("id_col", "review_id")
    # A review holds at most ``max_terms`` known terms, so its window is small.
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(id_col)))
    return raw_weights(reviews, vocabulary, **names).select(
        id_col, "idx", "term", (F.col("w") / norm).alias("weight"))
