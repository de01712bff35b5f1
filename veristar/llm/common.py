"""Shared small parts: tables, words, written intermediate results."""

from __future__ import annotations

import gc
import sys
import types
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veristar.session import remove_path, shared_dir

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and outlives executors."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Spark's setting by which the shuffle files of a query go when it ends; else they stay until the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that run in here leave no shuffle files; nothing later may be cached by them."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


class Scratch:
    """Written intermediate tables of one operator, removed when what was made of them is written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def written(self, df: DataFrame, purpose: str) -> DataFrame:
        path = shared_dir(self.spark, purpose)
        with shuffles_dropped(self.spark):
            df.write.parquet(path)
        found = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(found)] = (path, found)
        return found

    def drop(self, *tables: DataFrame) -> None:
        """Remove tables of this operator; nothing that is still to run may read them."""
        for table in tables:
            path, _ = self.paths.pop(id(table), (None, None))
            if path:
                remove_path(self.spark, path)


def fold(doc_id: Column | str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts`` (null ids: as the empty text)."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that no column of ``df`` has (names compare without case)."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that only a few texts at a time are Python objects."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def lower_ascii(column: Column) -> Column:
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def kept_in_worker(key: str, make: Callable[[], object]) -> object:
    """A value that a Python worker makes once and keeps for its later tasks, until one asks for another key.

    A worker outlives stages and jobs: with one value at a time, what earlier operators kept takes no memory.
    """
    store = sys.modules.setdefault("_veristar_worker", types.ModuleType("_veristar_worker"))
    if getattr(store, "key", None) != key:
        store.key = store.value = None
        gc.collect()
        pa.default_memory_pool().release_unused()
        store.value, store.key = make(), key
    return store.value
