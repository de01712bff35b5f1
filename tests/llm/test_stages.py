"""The pipeline's stages on odd tables, and the near-copy stage against brute force."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from veristar.llm import neardup, toxicity
from veristar.llm.common import table, written

from .test_operators import _brute_components
from .test_queries import SF_DIR

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows and ids, and columns that stages use inside."""
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    rows = [(None, None, None, None, None), (None, "only text here of no id at all", None, None, 1), (1, None, "en", "a", 0), (2, "", "en", "a", 0),
            (3, " \t\n", None, None, 3), (4, long, "en", "a", len(long)), (5, long, "en", None, len(long)), (6, "password = hunter2hunter2", "en", "b", 25),
            (6, "another text under the same id that is not alike", "en", "b", 1), (7, "one", None, "b", 3), (7, "one", None, "b", 3)]
    rows += [(10 + i, " ".join(words[(i + j) % 10] + str(i % 3) for j in range(40)), "en", "c", 10) for i in range(12)]
    df = spark.createDataFrame(rows, SCHEMA)
    extra = ["__id", "__toxic", "__kept", "node", "score", "predicted", "label", "digest", "h1", "node_number"]
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(extra)])


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_stage_on_odd_and_empty_tables(spark, name):
    stage = dict(P.STAGES)[name]
    odd = written(_odd(spark), "odd")
    for docs in (odd, odd.limit(0)):
        found = written(stage(spark, docs, SF_DIR), "odd-stage")
        rows = found.collect()
        if name != "bpe":
            assert found.columns == docs.columns
        if docs is not odd:
            assert rows == []
        elif name in ("secrets", "bpe"):
            assert len(rows) == odd.count()
        elif name == "near_dedup":
            _check_near(odd.collect(), rows)


def _check_near(before, after):
    """One row of each component of different rows, of the smallest id; rows without words stay."""
    different = sorted(set(before), key=lambda r: (r.doc_id is None, r.doc_id or 0, str(r)))
    want = _brute_components({i: r.text for i, r in enumerate(different)}, width=5)
    groups = {}
    for i, c in want.items():
        groups.setdefault(c, []).append(different[i])
    assert len(after) == len(groups)
    kept = set(after)
    for rows in groups.values():
        stay = [r for r in rows if r in kept]
        assert len(stay) == 1
        ids = [r.doc_id for r in rows if r.doc_id is not None]
        assert not ids or stay[0].doc_id == min(ids)


def test_near_copies_of_five_words_with_repeated_and_missing_ids(spark):
    rng = random.Random(12)
    words = [f"w{i}" for i in range(2000)]
    rows = []
    for c in range(8):
        origin = [rng.choice(words) for _ in range(200)]
        for k in range(25):
            edit = list(origin)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 6, 8])):
                edit[rng.randrange(200)] = rng.choice(words)
            rows.append((rng.choice([None, rng.randrange(60), 1000 + len(rows)]), " ".join(edit), rng.choice(["en", None]), None, len(rows)))
    rows += rows[:20]
    df = written(spark.createDataFrame(rows, SCHEMA), "near-test")
    first = neardup.without_near_copies(df, width=5).collect()
    _check_near(df.collect(), first)
    again = neardup.without_near_copies(df.repartition(5), width=5).collect()
    assert sorted(map(str, first)) == sorted(map(str, again))


def test_two_words_and_five_words_differ(spark):
    words = [f"w{i}" for i in range(100)]
    edited = [w if i % 17 else f"x{i}" for i, w in enumerate(words)]
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(edited))], "doc_id long, text string")
    assert [r.component_id for r in neardup.linked_components(df, width=2).orderBy("doc_id").collect()] == [1, 1]
    assert [r.component_id for r in neardup.linked_components(df, width=5).orderBy("doc_id").collect()] == [1, 2]


def test_clean_rows_are_those_not_predicted_toxic(spark):
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    model = toxicity.fit(docs, labels, F.lit(True))
    scored = toxicity.score(docs, model, keep=(F.col("doc_id"), F.lit(1).alias("text"), F.lit(2).alias("__text")))
    clean = {r.doc_id for r in scored.filter("predicted = 0").collect()}
    assert {r.doc_id for r in toxicity.without_toxic(docs, model).collect()} == clean
    assert toxicity.without_toxic(docs, None).count() == docs.count()
