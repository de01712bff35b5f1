"""Multi-word entries of the sentiment tables: a phrase counts as one token with its own valence.

A phrase is an entry of two words or more in the lexicon, the boosters or the negations ("kind of", "not bad").
Where phrases overlap, the one that begins first is taken, and of those that begin at one word the longest; the
words that it takes belong to no other phrase. Everything happens inside the row: the phrases that a text can hold are
looked up once (``rowterms``, linear in the text), and one regular expression of these few, longest first,
cuts the text into phrases and single words. No text is exploded or shuffled for it.

Rows that repeat an id are scored each; a missing or empty text has no phrase; a table without phrases leaves the
scores of ``lexicon_sentiment``; phrases that repeat are one entry (as in ``SentimentTables``); columns that are
not asked for may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .lexicon import SentimentTables, sentiment_scores, sentiment_tokens
from .rowterms import binary_order, free_name, with_counts

# A blank parts tokens, this mark the two spellings of one; both are whitespace, so no token holds them.
_MARK = "\x1e"


def phrase_list(tables: SentimentTables) -> list[str]:
    """The entries of two words or more, in binary order; a parameter list of the user's, held by the driver."""
    entries = tables.lexicon.select("token").union(tables.boosters.select("token")).union(tables.negations.select("token"))
    found = entries.where(F.size(F.split("token", " ")) > 1).distinct().toArrow()
    return binary_order(found.column(0).to_pylist())


def _grams(keys: str, sizes: list[int]) -> Column:
    """All runs of ``sizes`` words, joined by blanks."""
    return F.expr("concat(cast(array() as array<string>), " + ", ".join(
        f"case when size({keys}) >= {n} then transform(sequence(1, size({keys}) - {n - 1}), "
        f"i -> array_join(slice({keys}, i, {n}), ' ')) else array() end" for n in sizes) + ")")


def _pattern(phrase: str) -> str:
    """Java pattern of a phrase among tokens that are spelled ``lower-case MARK as-written``."""
    quoted = [f"\\Q{w.replace(chr(92) + 'E', chr(92) + 'E' + chr(92) * 2 + 'E' + chr(92) + 'Q')}\\E" for w in phrase.split(" ")]
    return " ".join(f"{w}{_MARK}[^ ]*+" for w in quoted)


def with_phrases(df: DataFrame, tokens: Column, phrases: list[str], out: str = "toks") -> DataFrame:
    """Add ``out``: the tokens, where each phrase is one token (its words as written, one blank between)."""
    if not phrases:
        return df.withColumn(out, tokens)
    toks, keys, present = (free_name(df, n) for n in ("_toks", "_keys", "_present"))
    sizes = sorted({p.count(" ") + 1 for p in phrases})
    # Longest first, so that the alternation takes the longest phrase of a place; places are walked from the left.
    ordered = sorted(binary_order(phrases), key=lambda p: -p.count(" "))
    held = df.withColumn(toks, tokens).withColumn(keys, F.transform(toks, F.lower))
    counted = with_counts(held, _grams(f"`{keys}`", sizes), ordered, present)
    patterns = F.array(*[F.lit(_pattern(p)) for p in ordered])
    spelled = F.array_join(F.zip_with(F.col(keys), F.col(toks), lambda k, t: F.concat(k, F.lit(_MARK), t)), " ")
    known = F.transform(F.col(f"`{present}`.indices"), lambda i: F.get(patterns, i))
    cut = F.regexp_extract_all(spelled, F.concat(F.array_join(known, "|"), F.lit("|[^ ]++")), F.lit(0))
    merged = F.transform(cut, lambda piece: F.regexp_replace(piece, f"[^ ]*?{_MARK}", ""))
    return counted.withColumn(out, F.when(F.size(known) == 0, F.col(toks)).otherwise(merged)).drop(toks, keys, present)


def phrase_sentiment(reviews: DataFrame, tables: SentimentTables, text_col: str = "review_text",
                     id_col: str = "review_id") -> DataFrame:
    """Lexicon score with phrases as tokens, and how many phrases the text holds: id, ``sentiment_score``, ``n_phrases``.

    Boosters, negations, capitals and the contrast word act on phrases as on words: a phrase is in capitals if all
    its words are, and stands at the distance of one token.
    """
    narrow = reviews.select(F.col(id_col).alias("id"), F.col(text_col).alias("txt"))
    merged = with_phrases(narrow, sentiment_tokens(T.text_or_empty(F.col("txt"))), phrase_list(tables))
    n_phrases = F.size(F.filter("toks", lambda t: F.contains(t, F.lit(" "))))
    scored = sentiment_scores(merged, tables, {"n_phrases": n_phrases}, "txt", "id", F.col("toks"))
    return scored.select(F.col("id").alias(id_col), "sentiment_score", "n_phrases")
