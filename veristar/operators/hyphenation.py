"""Syllables by hyphenation patterns (Liang 1983): the user's table of patterns meets the *distinct* words of all texts.

A pattern such as ``hy3ph`` names letters and a level for each gap between them. At each gap of a word, with a dot
on both sides as its border, the highest level of all patterns that fit there counts, and an odd one is a
break. A word has one syllable more than it has breaks. The patterns are found by a join of the words' substrings on
the patterns' letters, so the work on them grows with the distinct words, not with the texts.

The texts are read for the distinct words and their counts, and again for the sum of each text. Frequent words, as many as may be broadcast, are
looked up where the text is read; only the tokens of the others are counted by text and word and shuffled to their
join. The text itself is never shuffled, only numbers by the row's key.

Results: a missing or empty text has no words and no syllables; rows that repeat an id, or id and text, have a
result row each; an empty pattern table gives one syllable a word; a pattern that repeats or an upper-case one does no harm; exceptions go before patterns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import materialize
from .lookup import BROADCAST_ROWS, small

# Letters that stay together at a word's start and end: no break nearer to its border.
LEFT_MARGIN, RIGHT_MARGIN = 2, 2


def parsed_patterns(patterns: DataFrame) -> DataFrame:
    """``pattern`` -> ``letters`` and ``levels``: level ``i`` belongs to the gap in front of letter ``i``."""
    p = F.lower(F.trim("pattern"))
    letters = F.regexp_replace(p, "[0-9]", "")
    marks = F.regexp_extract_all(p, F.lit("([0-9]?)(?:[^0-9]|$)"), F.lit(1))
    levels = F.transform(F.slice(marks, 1, F.length(letters) + 1),
                         lambda m: F.when(m == "", F.lit(0)).otherwise(m.cast("int")))
    return patterns.select(letters.alias("letters"), levels.alias("levels")).where(F.length("letters") > 0).distinct()


def word_syllables(words: DataFrame, patterns: DataFrame, exceptions: DataFrame | None = None,
                   left: int = LEFT_MARGIN, right: int = RIGHT_MARGIN) -> DataFrame:
    """Distinct ``word``s -> ``word``, ``n_syllables``.

    ``exceptions``: words as they are to be broken, ``ta-ble``, in a column ``word``.
    """
    known = parsed_patterns(patterns)
    lengths = [r[0] for r in known.select(F.length("letters")).distinct().orderBy(F.length("letters")).collect()]
    dotted = words.select("word", F.concat(F.lit("."), F.lower("word"), F.lit(".")).alias("w"))
    pieces = F.expr("concat(cast(array() as array<struct<p: int, letters: string>>), " + ", ".join(
        ["array()"] + [f"case when length(w) >= {n} then transform(sequence(1, length(w) - {n - 1}), "
                       f"i -> struct(i as p, substr(w, i, {n}) as letters)) else array() end" for n in lengths]) + ")")
    found = dotted.select("word", F.inline(pieces)).join(small(known), "letters")
    # Place i of a pattern that stands at p is the gap in front of character p + i of the dotted word.
    gaps = found.select("word", "p", F.posexplode("levels").alias("i", "level")).where("level > 0")
    level = gaps.groupBy("word", (F.col("p") + F.col("i") - 2).alias("before")).agg(F.max("level").alias("level"))
    odd = level.where((F.col("level") % 2 == 1) & (F.col("before") >= left) & (F.col("before") <= F.length("word") - right))
    counted = odd.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    out = words.select("word").join(counted, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    if exceptions is not None:
        given = exceptions.select(F.lower(F.trim("word")).alias("w")).groupBy(F.replace("w", F.lit("-"), F.lit("")).alias("word")).agg(
            F.max(T.char_count(F.col("w"), "-")).alias("given"))
        out = out.join(small(given), "word", "left").withColumn("n", F.coalesce("given", "n"))
    return out.select("word", (F.col("n") + 1).cast("long").alias("n_syllables"))


def _bits(count: str) -> Column:
    return F.length(F.bin(count))


def counted_syllables(tokens: DataFrame, patterns: DataFrame, exceptions: DataFrame | None = None) -> DataFrame:
    """``word``, ``times`` and ``n_syllables`` of each distinct word."""
    counted = materialize(tokens.groupBy("word").agg(F.count(F.lit(1)).alias("times")), "words")
    return word_syllables(counted.select("word"), patterns, exceptions).join(counted, "word")


def frequent_from(words: DataFrame, max_rows: int | None = None) -> int:
    """How many binary digits a word's ``times`` has at least, so that no more than ``max_rows`` words do; 1 where all fit."""
    sizes = words.groupBy(_bits("times").alias("bits")).agg(F.count(F.lit(1)).alias("n")).collect()  # at most 63 rows
    left, bits = BROADCAST_ROWS if max_rows is None else max_rows, 64
    for size in sorted(sizes, key=lambda r: -r["bits"]):
        left -= size["n"]
        if left < 0:
            return bits
        bits = size["bits"]
    return 1


def _key(id_col: str, text_col: str) -> dict[str, Column]:
    """Two hashes of id and text; rows that share both have the same result."""
    parts = [F.col(id_col), F.col(text_col)]
    present = [p.isNull().cast("int") for p in parts]
    return {f"_row{i}": F.xxhash64(F.lit(i), *present, *parts) for i in (1, 2)}


def pattern_readability(reviews: DataFrame, patterns: DataFrame, exceptions: DataFrame | None = None,
                        text_col: str = "review_text", id_col: str = "review_id") -> DataFrame:
    """Reading ease with syllables by patterns: id, ``n_words``, ``n_syllables``, ``readability_score``."""
    text = T.text_or_empty(F.col(text_col))
    narrow = reviews.select(F.col(id_col).alias(id_col), *[c.alias(n) for n, c in _key(id_col, text_col).items()],
                            T.words(text).alias("ws"), T.sentence_count(text).alias("n_sentences"))
    rows = narrow.select(id_col, "_row1", "_row2", F.size("ws").alias("n_words"), "n_sentences")
    tokens = narrow.select("_row1", "_row2", F.explode("ws").alias("word"))
    # Written once, so that the joins below know its size.
    words = materialize(counted_syllables(tokens, patterns, exceptions), "syllables")
    bits = frequent_from(words)
    frequent, rare = words.where(_bits("times") >= bits), words.where(_bits("times") < bits)
    # Frequent words meet the tokens where they are, and only sums by row are shuffled; the others come by a join.
    sums = tokens.join(F.broadcast(frequent), "word").groupBy("_row1", "_row2").agg(F.sum("n_syllables").alias("s"))
    if bits > 1:
        far = tokens.join(F.broadcast(frequent.select("word")), "word", "left_anti")
        per_row = far.groupBy("_row1", "_row2", "word").agg(F.count(F.lit(1)).alias("n"))
        sums = sums.unionByName(per_row.join(rare, "word").groupBy("_row1", "_row2").agg(
            F.sum(F.col("n") * F.col("n_syllables")).alias("s"))).groupBy("_row1", "_row2").agg(F.sum("s").alias("s"))
    counts = rows.groupBy("_row1", "_row2").agg(F.count(F.lit(1)).alias("copies"))
    # Rows that are copies of each other were counted together.
    each = sums.join(counts, ["_row1", "_row2"]).select("_row1", "_row2", F.expr("s div copies").alias("n_syllables"))
    out = rows.join(each, ["_row1", "_row2"], "left").withColumn("n_syllables", F.coalesce("n_syllables", F.lit(0).cast("long")))
    score = T.reading_ease_of(F.col("n_words"), F.col("n_sentences"), F.col("n_syllables"))
    return out.select(id_col, "n_words", "n_syllables", score.alias("readability_score"))
