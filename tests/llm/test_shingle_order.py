"""Counts that order the shingles, and sketches that refuse pairs inside the join."""

import numpy as np

from veristar.llm import neardup


def test_counts_over_all_documents(spark):
    texts = ["a b c d", "a b c", "a b", "", None, "q " * 400, "a b c d"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    want = np.zeros(neardup.PLACES, np.uint16)
    h = neardup.Hasher(2)
    for t in texts:
        want[neardup.places(h.shingles(t))] += 1
    assert (neardup.document_counts(docs, "text", 2) == want).all()
    assert want.max() == 4 and neardup.places(h.shingles("a b c d")).max() < neardup.PLACES
    assert not neardup.document_counts(docs.filter("false"), "text", 2).any()


def test_more_documents_than_a_task_counts(spark):
    docs = spark.range(0, 1200, numPartitions=2).selectExpr("id as doc_id", "'same two' as text")
    counts = neardup.document_counts(docs, "text", 2)  # at most 255 from each of two tasks
    assert counts.max() == 510 and (counts > 0).sum() == 1


def test_folded_sketches_never_differ_more_than_their_sets():
    r = np.random.default_rng(9)
    for n in (1, 5, 40, 300, 2000):
        for shared in (0, n // 2, n - n // 10, n):
            x = r.integers(0, 1 << 62, n).astype(np.uint64)
            y = np.concatenate([x[:shared], r.integers(0, 1 << 62, n - shared).astype(np.uint64)])
            a, b = (neardup.folded(neardup.sketch(np.unique(s))) for s in (x, y))
            assert len(a) == neardup.SHORT
            assert np.bitwise_count(a ^ b).sum() <= len(np.setxor1d(x, y))
