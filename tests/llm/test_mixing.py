"""Quotas of the mix against a brute force over all quotients."""

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from veristar.llm import mixing

PARTIES = "place long, party long, votes long, house long, most long"


def highest_quotients(parties, house):
    """{party: seats}: one seat after the other to the highest quotient, ties to the smaller party."""
    seats = {party: 0 for party, _, _ in parties}
    for _ in range(house):
        open_ = [(-Fraction(votes, 2 * seats[party] + 1), party) for party, votes, most in parties if seats[party] < most]
        if not open_:
            break
        seats[min(open_)[1]] += 1
    return seats


def test_apportion_equals_brute_force(spark):
    draw = random.Random(3)
    rows, want = [], {}
    for place in range(60):
        n = draw.choice([1, 2, 3, 7, 20])
        tied = place % 3 == 0
        parties = []
        for party in range(n):
            votes = draw.choice([1, 3, 6, 30]) if tied else draw.choice([1, 2, 50, 1000, 99991])
            parties.append((party, votes, draw.choice([0, 1, 2, 5, 1000]) if place % 2 else 10_000))
        house = draw.choice([0, 1, 2, 3, 17, 100])
        rows += [(place, *p[:2], house, p[2]) for p in parties]
        want.update({(place, party): s for party, s in highest_quotients(parties, house).items()})
    got = mixing.apportion(spark.createDataFrame(rows, PARTIES).repartition(7)).collect()
    assert len(got) == len(want) and {(r.place, r.party): r.seats for r in got} == want
    assert mixing.apportion(spark.createDataFrame([], PARTIES)).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_blocks_add_up_to_the_house(spark, seed):
    draw = random.Random(seed)
    rows = [(i, " ".join("w" * draw.randint(1, 3) for _ in range(draw.choice([1, 16, 40, 700]))), f"s{i % 4}")
            for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    block, cap = 16, 2
    sums = docs.groupBy("source").agg(F.sum(mixing.words_of(F.col("text"))).alias("source_size"))
    targets = mixing.source_targets(sums)
    rows = {r.place: r for r in targets.collect()}
    house = int(sum(r.target for r in rows.values()) / block + 0.5)
    seats = {r.place: r.house for r in mixing.source_seats(targets, block, cap).collect()}
    assert sum(seats.values()) == house
    assert all(abs(seats[p] * block - rows[p].target) <= 2 * block for p in seats)
    found = mixing.mix(docs, shard_words=1000)
    taken = {r.source: r.taken for r in found.rows.groupBy("source").agg(F.sum(found.taken).alias("taken")).collect()}
    # The last block of a shard may be short.
    assert all(seats[r.place] * block - taken[r.source] in range(0, 2 * block * 40) for r in rows.values())


def test_rows_of_one_id_are_spread_by_their_texts(spark):
    docs = spark.createDataFrame([(None, f"word {i} more words", "s") for i in range(400)],
                                 "doc_id long, text string, source string")
    found = mixing.mix(docs, shard_words=200)
    sizes = found.rows.agg(F.sum(found.size), F.sum(found.taken)).first()
    # Eight shards, whose last blocks may be short.
    assert sizes[0] == 1600 and abs(sizes[1] - 2400) <= 8 * 16
    again = sorted((r.text, r[found.taken]) for r in mixing.mix(docs.repartition(3), shard_words=200).rows.collect())
    assert again == sorted((r.text, r[found.taken]) for r in found.rows.collect())
