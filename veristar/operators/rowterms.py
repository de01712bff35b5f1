"""Known terms of a row, counted inside the row.

A fitted vocabulary is a list that the driver holds, like the coefficients of the model it belongs to. Spark ML's
``CountVectorizerModel`` sends it to the workers once and counts a term array against it in one pass, in the order of
the list; the counts are then plain array columns. Nothing is exploded, joined or shuffled, and the work is linear in
the terms of the row, whatever the size of the vocabulary.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EMPTY = "cast(named_struct('indices', array(), 'values', array()) as struct<indices: array<int>, values: array<double>>)"


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one where a column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def with_counts(df: DataFrame, terms: Column, vocabulary: list[str], out: str) -> DataFrame:
    """Add ``out``: a struct of ``indices`` (places in ``vocabulary``, ascending) and ``values`` (how often each term occurs)."""
    if not vocabulary:
        return df.withColumn(out, F.expr(EMPTY))
    source, counts = free_name(df, "_terms"), free_name(df, "_counts")
    known = F.coalesce(terms, F.expr("cast(array() as array<string>)"))
    model = CountVectorizerModel.from_vocabulary(vocabulary, inputCol=source, outputCol=counts, minTF=1.0)
    counted = model.transform(df.withColumn(source, known)).withColumn(out, F.unwrap_udt(counts))
    pair = F.struct(F.col(f"`{out}`.indices").alias("indices"), F.col(f"`{out}`.values").alias("values"))
    return counted.withColumn(out, pair).drop(source, counts)


def number_array(values: list[float]) -> str:
    """A constant array of doubles as SQL text; Spark folds it to one literal."""
    if not all(map(math.isfinite, values)):
        raise ValueError("a fitted number is missing or not finite")
    return "array(" + ", ".join(f"{float(v)!r}D" for v in values) + ")" if values else "cast(array() as array<double>)"


def binary_order(terms) -> list[str]:
    """Terms in the order in which Spark compares strings."""
    return sorted(terms, key=lambda t: t.encode("utf-8"))
