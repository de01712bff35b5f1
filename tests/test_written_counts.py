"""Counts of the job that writes, and the order of rows in files."""

import csv

import pandas as pd
import pytest
from pyspark.sql import functions as F

from veristar.operators import cleaning as C
from veristar.operators import scoring as SC
from veristar.sources import file_order as FO
from veristar.sources import writers

RAW = "review_id int, category string, rating double, label string, text_ string"


@pytest.fixture
def raw(spark):
    rows = [
        (1, "a", 5.0, " cg ", "same  text"), (2, "b", 4.0, "OR", "same  text"), (3, "c", None, "OR", "no stars"), (4, "d", 1.0, "OR", "no stars"),
        (5, "e", 1.0, None, "no label"), (6, "f", 2.0, "XX", "odd label"), (7, "g", 2.0, "or", None), (8, "h", 2.0, "or", None),
        (9, "i", 2.0, "or", ""), (10, "j", float("nan"), "or", "not a number"), (11, "k", 3.0, "cg", "x" * 100000), (12, "l", 3.0, "cg", " same text "),
        (13, "m", 3.0, "cg", "twice"), (13, "n", 3.0, "or", "twice"),
    ]
    return spark.createDataFrame(rows, RAW).repartition(5).withColumn("digest", F.lit(1))


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_clean_and_funnel_of_one_job(spark, raw, tmp_path):
    funnel = writers.write_clean(raw, f"{tmp_path}/clean")
    unique = raw.where("not (review_id = 13 and category = 'n')")
    written = spark.read.parquet(f"{tmp_path}/clean")
    assert written.columns == raw.columns
    assert _rows(written) == _rows(C.clean_reviews(unique))
    counts = {r["step"]: r["n_rows"] for r in funnel.collect()}
    # The row whose stars are no number is not complete.
    assert counts == {"raw": 14, "distinct_text": 10, "complete": 6, "clean": 5}
    empty = writers.write_clean(raw.limit(0), f"{tmp_path}/none")
    assert [r["n_rows"] for r in empty.orderBy("step_no").collect()] == [0, 0, 0, 0]


def test_one_scan(spark, raw, tmp_path):
    raw.write.parquet(f"{tmp_path}/raw")
    plan = C.marked_firsts(spark.read.parquet(f"{tmp_path}/raw"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.split("Initial Plan")[0].count("Exchange") == 1


def test_summary_of_the_writing_job(spark, tmp_path):
    scanned = spark.createDataFrame([(i, "DECEPTIVE" if i % 3 == 0 else "GENUINE") for i in range(100)], "id int, classification string")
    assert _rows(writers.write_scan(scanned, f"{tmp_path}/a")) == _rows(SC.scan_summary(scanned))
    assert spark.read.parquet(f"{tmp_path}/a").count() == 100
    assert _rows(writers.write_scan(scanned.limit(0), f"{tmp_path}/b")) == [(0, 0, 0, 0.0)]


def test_order_of_files_as_a_single_reader(spark, tmp_path):
    for f, name in enumerate(["a.csv", "b 2.csv", "c.csv"]):
        with open(tmp_path / name, "w", newline="") as out:
            w = csv.writer(out)
            w.writerow(["text_", "n"])
            w.writerows([f"{'line' if i % 5 else 'broken' + chr(10) + 'line'} {(i * 7 + f) % 40}", f * 1000 + i] for i in range(200))
    want = pd.concat([pd.read_csv(tmp_path / n) for n in ["a.csv", "b 2.csv", "c.csv"]], ignore_index=True)
    got = FO.read_in_order(spark, str(tmp_path / "*.csv")).repartition(7)
    assert [int(r["n"]) for r in got.orderBy("file_order").collect()] == want["n"].tolist()
    assert [int(r["n"]) for r in got.orderBy("file_order").limit(10).collect()] == want["n"].head(10).tolist()
    first = C.dedupe_first(got, id_col="file_order")
    assert sorted(int(r["n"]) for r in first.collect()) == sorted(want.drop_duplicates("text_")["n"])
    with pytest.raises(ValueError, match="column N"):
        FO.read_in_order(spark, str(tmp_path / "a.csv"), order="N")


def test_order_over_blocks_of_a_file(spark, tmp_path):
    """A file that is read in several blocks keeps its order."""
    lines = [f"{i:06d},{'y' * (i % 50)}" for i in range(20000)]
    (tmp_path / "big.csv").write_text("\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        scan = FO.with_file_order(spark.read.csv(str(tmp_path / "big.csv")))
        assert scan.rdd.getNumPartitions() > 3
        assert [int(r["_c0"]) for r in scan.orderBy("file_order").collect()] == list(range(20000))
        assert len({r[0] for r in scan.select("file_order.block").distinct().collect()}) > 3
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    with pytest.raises(ValueError):
        FO.with_file_order(scan.drop("file_order"), "_c0")
