"""Session helpers: tuning, shared folder, written intermediate tables."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "veristar",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Session with the settings the library is tested with."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.memory", "8g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


#: Used only with a local master and no ``spark.checkpoint.dir``, as in tests.
LOCAL_SHARED = "/tmp/checkpoints"


def shared_root(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = LOCAL_SHARED
    return root.rstrip("/")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a written intermediate table from the shared folder."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def path_bytes(spark: SparkSession, path: str) -> int:
    """Size of a written intermediate table."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(hadoop).getLength()


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give a *scan* enough tasks for the text work that follows.

    A table of many files or row groups is left as it is (no shuffle); only a
    scan with fewer splits than cores is hashed on its unique key.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key)


def materialize(df: DataFrame, purpose: str, key: str | None = None) -> DataFrame:
    """Write once to the shared folder and read back: cuts the lineage of a
    result that is used several times, and survives the loss of executors.

    ``key`` as in ``spread``, for text work on the result.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    written = df.sparkSession.read.parquet(path)
    return spread(written, key) if key else written


def local_table(spark: SparkSession, columns: dict[str, tuple[pa.DataType, list]]) -> DataFrame:
    """Driver-side rows as a DataFrame whose size the optimizer knows."""
    return spark.createDataFrame(
        pa.table({name: pa.array(values, type=kind) for name, (kind, values) in columns.items()})
    )
