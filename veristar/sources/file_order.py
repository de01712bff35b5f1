"""The order of rows in files: file, start of the block in it, and place among the rows of the block's reader.

Spark reads a table's blocks in any order, but within a block from front to back. The three together put rows as a single reader
would, that takes the files by path and each from front to back. The place alone depends on how blocks are packed into tasks and is only comparable
within a block; ``read_in_order`` therefore writes rows and order once, so that later jobs, or a task that is run
again, all see the same values.

Rows that are equal keep different places; an empty table has no order to give; a column that has the order's name is an error;
files whose paths differ in a part number sort by its digits as text, as Spark's own part files do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as t

from ..session import materialize
from .readers import read_csv

FILE_ORDER = "file_order"


def file_place(scan: DataFrame) -> Column:
    """Sortable place of each row of ``scan``, which must be a file source itself."""
    about = scan.metadataColumn("_metadata")
    return F.struct(about["file_path"].alias("file"), about["file_block_start"].alias("block"),
                    F.monotonically_increasing_id().alias("place"))


def with_file_order(scan: DataFrame, order: str = FILE_ORDER) -> DataFrame:
    if order.lower() in {c.lower() for c in scan.columns}:
        raise ValueError(f"the file has a column {order}")
    return scan.select("*", file_place(scan).alias(order))


def read_in_order(spark: SparkSession, path, schema: t.StructType | None = None, order: str = FILE_ORDER) -> DataFrame:
    """CSV files with their order of rows, written once to the shared folder."""
    rows = read_csv(spark, path, schema, lambda scan: file_place(scan).alias(order))
    if len({c.lower() for c in rows.columns}) < len(rows.columns):
        raise ValueError(f"the file has a column {order}")
    return materialize(rows, "ordered")
