"""Postings that go into the pair join of near copies: none that a pair needs is dropped, and few others stay."""

import random

from pyspark.sql import functions as F

from veristar.llm import neardup

WORDS = [f"s{i}" for i in range(neardup.SHORT)]


def _pairs(rows: list[tuple]) -> set[tuple]:
    out = set()
    for a in rows:
        for b in rows:
            n = a[3] + b[3]
            differ = sum(bin((x ^ y) & (1 << 64) - 1).count("1") for x, y in zip(a[5:], b[5:]))
            if (a[0] == b[0] and a[1] < b[1] and a[2] != b[2] and 180 * min(a[4], b[4]) >= 80 * n
                    and differ <= n - 2 * -(-80 * n // 180)):
                out.add((a[0], a[1], b[1]))
    return out


def test_postings_of_all_pairs_stay(spark):
    rng = random.Random(3)
    rows = []
    for shingle in range(900):
        base = rng.choice([3, 10, 40, 300, 5000])
        for k in range(rng.choice([1, 2, 2, 2, 3, 3, 4, 9])):
            n = max(1, round(base * rng.uniform(0.4, 2.5)))
            node = shingle * 10 + k
            label = rng.choice([node, shingle * 10])
            rest = n - rng.randint(0, n // 5)
            rows.append((shingle, node, label, n, rest, *[rng.choice([0, 0, 1, 7 << 40, -1]) for _ in WORDS]))
    table = spark.createDataFrame(rows, ["shingle", "node", "label", "n", "rest", *WORDS]).repartition(3)
    kept = {(r.shingle, r.node) for r in neardup.with_partner(table, WORDS).collect()}
    pairs = _pairs(rows)
    needed = {(s, x) for s, a, b in pairs for x in (a, b)}
    assert needed and needed <= kept
    two = {s for s in range(900) if sum(r[0] == s for r in rows) == 2}
    assert {k for k in kept if k[0] in two} == {k for k in needed if k[0] in two}
    # Before, every posting of a shingle with two components went into the join.
    labels = {}
    for r in rows:
        labels.setdefault(r[0], set()).add(r[2])
    assert 4 * len(kept) < 3 * sum(len(labels[r[0]]) > 1 for r in rows)


def test_counts_come_with_the_signatures(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "a b d"), (None, None)], "doc_id long, text string")
    found = neardup.sets(docs).cache()
    assert sorted((r.doc_id or 0, r.n_shingles) for r in found.filter("block is null").collect()) == [(0, 0), (1, 2), (2, 2)]
    counts = neardup.summed_counts(found)
    assert sorted(counts[counts > 0]) == [1, 1, 2]
    assert (counts == neardup.document_counts(docs.select(F.col("text").alias("t")), "t", 2)).all()
