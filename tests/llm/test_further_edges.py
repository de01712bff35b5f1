"""Labels after further edges; shuffle files of written tables."""

import random
from pathlib import Path

import pytest

from veristar.llm import neardup
from veristar.llm.common import CLEANUP, Scratch

rng = random.Random(33)


def _least(edges):
    label = {n: n for e in edges for n in e}
    moved = True
    while moved:
        moved = False
        for a, b in edges:
            low = min(label[a], label[b])
            moved = moved or label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def test_labels_after_further_edges(spark):
    scratch = Scratch(spark)
    for n, first, further in ((40, 30, 12), (12, 10, 0), (12, 0, 8), (300, 200, 60)):
        one, two = ([(rng.randrange(n), rng.randrange(n)) for _ in range(k)] for k in (first, further))
        one, two = ([(a, b) for a, b in e if a != b] for e in (one, two))
        old, new = (spark.createDataFrame(e, "a long, b long") for e in (one, two))
        labels = neardup.extended(neardup.components(old, "t", scratch), new, "t", scratch).collect()
        assert len(labels) == len({r["node"] for r in labels})
        assert {r["node"]: r["label"] for r in labels} == _least(one + two)


def test_written_tables_leave_no_shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def files():
        return {f for d in dirs for f in Path(d).rglob("shuffle_*.data")}

    scratch, before, setting = Scratch(spark), files(), spark.conf.get(CLEANUP)
    found = scratch.written(spark.range(1000).selectExpr("id % 7 as k").groupBy("k").count(), "t")
    assert found.count() == 7
    with pytest.raises(Exception):
        scratch.written(spark.range(3).selectExpr("raise_error('no') as k"), "t")
    assert spark.conf.get(CLEANUP) == setting
    # Those of the count above come and go with the driver's garbage.
    assert len(files() - before) <= 1
