"""Column renaming, selection and detection."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Accepted names.
ALIASES = {"category": "category", "rating": "rating", "label": "label",
           "text_": "review_text", "review_text": "review_text"}
EXPECTED = ["category", "rating", "label", "review_text"]
TEXT_NAMES = {"review_text", "text", "text_", "review", "content"}
RATING_NAMES = {"rating", "stars", "score", "star_rating"}


def rename_aliases(df: DataFrame, aliases: dict[str, str] = ALIASES) -> DataFrame:
    """Rename the aliases that exist; two columns for one name are an error."""
    renamed = {c: aliases[c] for c in df.columns if c in aliases}
    if len(set(renamed.values())) < len(renamed):
        raise ValueError(f"several columns would be named alike: {sorted(renamed)}")
    return df.withColumnsRenamed(renamed)


def keep_expected(df: DataFrame, expected: list[str] = EXPECTED) -> DataFrame:
    """The expected columns that exist, in the expected order."""
    return df.select([c for c in expected if c in df.columns])


def normalize_columns(df: DataFrame) -> DataFrame:
    return keep_expected(rename_aliases(df))


def detect(columns: list[str], names: set[str]) -> str:
    """First column with one of the names, ignoring case, else the first column."""
    return next((c for c in columns if c.lower() in names), columns[0])


def as_reviews(df: DataFrame, text_col: str | None = None, rating_col: str | None = None) -> DataFrame:
    """Present any table as ``review_text`` and ``rating``, next to its other columns."""
    text_col = text_col or detect(df.columns, TEXT_NAMES)
    rating_col = rating_col or detect(df.columns, RATING_NAMES)
    others = [c for c in df.columns if c not in (text_col, rating_col, "review_text", "rating")]
    return df.select(*others, df[text_col].cast("string").alias("review_text"),
                     df[rating_col].try_cast("double").alias("rating"))


def head_rows(df: DataFrame, order_col: str, n: int) -> DataFrame:
    """First ``n`` rows in key order (files have no row order in Spark)."""
    return df.orderBy(order_col).limit(n)
