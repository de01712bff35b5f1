"""Readers: CSV, tables, SQL results, databases, model reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as t

from ..operators.evaluation import METRICS
from ..session import spread
from .schemas import RAW_FILE

# Spellings that count as missing in text files.
NULL_SPELLINGS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
                  "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def present(value: Column) -> Column:
    return F.when(~value.isin(NULL_SPELLINGS), value)


def read_csv(spark: SparkSession, path, schema: t.StructType | None = None,
             extra: Callable[[DataFrame], Column] | None = None) -> DataFrame:
    """CSV with a header; quoted fields may hold line breaks and doubled quotes.

    Columns are matched by name. All are read as text first, so the null
    spellings apply to every type; a value that does not parse becomes missing.
    Without a schema all columns stay text. ``extra`` gives one more column of the scan, such as the place of a row.
    """
    raw = spark.read.options(header=True, multiLine=True, escape='"', quote='"', enforceSchema=False).csv(path)
    more = [extra(raw)] if extra else []
    if schema is None:
        return raw.select([present(F.col(f"`{c}`")).alias(c) for c in raw.columns] + more)
    kinds = {f.name: f.dataType for f in schema.fields}
    return raw.select([
        present(F.col(f"`{c}`")).try_cast(kinds[c]).alias(c) if c in kinds else present(F.col(f"`{c}`")).alias(c)
        for c in raw.columns
    ] + more)


def read_raw_file(spark: SparkSession, path) -> DataFrame:
    return read_csv(spark, path, RAW_FILE)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Asked of the file system that owns the path."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(str(path))
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def first_existing(spark: SparkSession, paths: list[str]) -> str | None:
    """First path of the list that exists (cleaned file before raw file)."""
    return next((p for p in paths if path_exists(spark, p)), None)


def read_table(spark: SparkSession, sf_dir: str, name: str, key: str | None = None,
               columns: list[str] | None = None) -> DataFrame:
    """Parquet table; ``key`` asks for enough tasks if the file is a single split."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if columns:
        df = df.select(*columns)
    return spread(df, key) if key else df


def read_sql(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """Result of a SQL text over the given tables."""
    return spark.sql(query, **tables)


def read_jdbc(spark: SparkSession, url: str, query: str, partition: dict | None = None,
              properties: dict | None = None) -> DataFrame:
    """The same against an external database. Credentials come from ``properties``.

    ``partition``: partitionColumn, lowerBound, upperBound, numPartitions.
    """
    reader = spark.read.format("jdbc").option("url", url)
    if partition:
        reader = reader.option("dbtable", f"({query}) q").options(**partition)
    else:
        reader = reader.option("query", query)
    return reader.options(**(properties or {})).load()


_METRIC = t.StructType([
    *[t.StructField(m, t.DoubleType()) for m in METRICS],
    t.StructField("confusion_matrix", t.ArrayType(t.ArrayType(t.LongType()))),
])


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """``{model: {metric: value}}`` as one row per model, in file order."""
    text = spark.read.text(path, wholetext=True)
    names = F.json_object_keys("value")
    return (
        text.select(F.posexplode(names).alias("position", "model"),
                    F.from_json("value", t.MapType(t.StringType(), _METRIC)).alias("m"))
        .select(F.col("position").cast("long").alias("position"), "model",
                F.element_at("m", F.col("model")).alias("r"))
        .select("position", "model", "r.*")
    )
