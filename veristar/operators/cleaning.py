"""Cleaning: keep the first copy of a text, drop gaps, normalise, keep known labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

# The two label codes.
KNOWN_LABELS = ("CG", "OR")


def text_digest(text_col: str = "text_"):
    """256-bit digest that stands for the exact text in a shuffle."""
    return F.sha2(F.col(text_col), 256)


def first_copies(raw: DataFrame, text_col: str = "text_", id_col: str = "review_id") -> DataFrame:
    """Smallest id per exact text.

    Texts are compared by digest and reduced on the map side first, so a text
    copied a billion times sends one short row per task. Missing texts are one
    group of copies, too.
    """
    return (
        raw.select(F.col(id_col), text_digest(text_col).alias("digest"))
        .groupBy("digest").agg(F.min(id_col).alias(id_col))
        .select(id_col)
    )


def dedupe_first(raw: DataFrame, text_col: str = "text_", id_col: str = "review_id") -> DataFrame:
    """First row, by id, of each exact text."""
    return raw.join(first_copies(raw, text_col, id_col), id_col, "left_semi")


def normalize(df: DataFrame, text_col: str = "text_") -> DataFrame:
    return df.withColumns({
        text_col: T.squeeze_space(F.col(text_col)),
        "label": F.upper(T.strip_space(F.col("label"))),
    })


def clean_reviews(raw: DataFrame, text_col: str = "text_", id_col: str = "review_id") -> DataFrame:
    """All five steps. Which copy is first is decided before any row is dropped.

    The drops commute with the semi join, so they run first: only rows that
    survive them carry their text through a shuffle.
    """
    kept = raw.na.drop(subset=[text_col, "rating", "label"])
    kept = normalize(kept, text_col).where(F.col("label").isin(*KNOWN_LABELS))
    return kept.join(first_copies(raw, text_col, id_col), id_col, "left_semi")


def clean_funnel(raw: DataFrame, text_col: str = "text_", id_col: str = "review_id") -> DataFrame:
    """Rows left after each step, in one pass over narrow columns."""
    label = F.upper(T.strip_space(F.col("label")))
    narrow = raw.select(
        id_col, text_digest(text_col).alias("digest"),
        F.col(text_col).isNotNull().alias("has_text"),
        (F.col("rating").isNotNull() & F.col("label").isNotNull()).alias("has_values"),
        F.coalesce(label.isin(*KNOWN_LABELS), F.lit(False)).alias("known"),
    )
    full = F.col("has_text") & F.col("has_values")
    # Bits of the first copy, packed behind its id: min() then finds both in
    # one hash aggregate on a fixed-width value.
    packed = F.col(id_col) * 4 + full.cast("long") * 2 + (full & F.col("known")).cast("long")
    per_text = narrow.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), F.min(packed).alias("first"))
    bits = F.pmod(F.col("first"), F.lit(4))
    counts = per_text.agg(
        F.sum("copies").alias("raw"), F.count(F.lit(1)).alias("distinct_text"),
        F.sum((bits >= 2).cast("long")).alias("complete"), F.sum((bits == 3).cast("long")).alias("clean"),
    )
    return funnel_rows(counts)


FUNNEL = ("raw", "distinct_text", "complete", "clean")
FUNNEL_SCHEMA = ", ".join(f"{step} long" for step in FUNNEL)


def funnel_rows(counts: DataFrame) -> DataFrame:
    """One row of counts -> a row for each step."""
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("step_no"), F.lit(s).alias("step"), F.coalesce(F.col(s), F.lit(0)).alias("n_rows"))
        for i, s in enumerate(FUNNEL, 1)
    ])).alias("r")).select("r.*")


def marked_firsts(raw: DataFrame, text_col: str = "text_", id_col: str = "review_id") -> DataFrame:
    """The first copy of each text in one scan: ``row``, ``copies``, and whether it is ``complete`` and ``clean``.

    Rows are reduced by the text's digest on the map side. Values go through the shuffle only with rows that
    cleaning would keep; of others, two marks. Rows that share id and text: the smallest by all values, so
    no column may be a map.
    """
    tidy = {text_col: T.squeeze_space(F.col(text_col)), "label": F.upper(T.strip_space(F.col("label")))}
    rating = F.col("rating")
    complete = (F.col(text_col).isNotNull() & rating.isNotNull() & ~F.coalesce(F.isnan(rating.try_cast("double")), F.lit(False))
                & F.col("label").isNotNull())
    marked = raw.select(text_digest(text_col).alias("digest"), F.col(id_col).alias("id"), complete.alias("complete"),
                        (complete & F.coalesce(tidy["label"].isin(*KNOWN_LABELS), F.lit(False))).alias("clean"),
                        F.struct(*[tidy.get(c, F.col(f"`{c}`")).alias(c) for c in raw.columns]).alias("row"))
    carried = F.struct("id", "complete", "clean", F.when(F.col("clean"), F.col("row")).alias("row"))
    firsts = marked.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), F.min(carried).alias("first"))
    return firsts.select("copies", "first.complete", "first.clean", "first.row")
