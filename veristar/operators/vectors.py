"""Written tables of ML vectors, without Python per row."""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import types as t

from ..session import shared_dir


def materialize_vectors(rows: DataFrame, features: str = "features", path: str | None = None) -> DataFrame:
    """Write rows once and read ``features`` back as ML vectors.

    Model fitting passes over the vectors many times; the written table cuts the
    lineage and survives the loss of executors.
    """
    spark = rows.sparkSession
    path = path or shared_dir(spark, "vectors")
    rows.write.parquet(path)
    fields = [
        t.StructField(f.name, VectorUDT() if f.name == features else f.dataType, True) for f in rows.schema.fields
    ]
    return spark.read.schema(t.StructType(fields)).parquet(path)
