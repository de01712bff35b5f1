"""Tags by Viterbi against the enumeration of all paths."""

import itertools
import random

import pytest

from veristar.operators import tagging as TG
from veristar.sources import params as P


def _model(spark, emissions, transitions):
    return TG.tag_model(P.weight_table(spark, "token", emissions), P.weight_table(spark, "prev_tag", transitions))


def _best(words, tags, emit, move):
    """Highest sum; of equal paths the one that comes first, read from its end."""
    def score(path):
        pairs = zip((None, *path), path)
        return sum(move.get(p, TG.FLOOR) for p in pairs) + sum(emit(w, t) for w, t in zip(words, path))

    return min(itertools.product(tags, repeat=len(words)), key=lambda path: (-score(path), path[::-1]))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_enumeration(spark, seed):
    rng = random.Random(seed)
    tags, tokens = ["ADJ", "NOUN", "VERB"], ["a", "b", "c", "d"]
    # Few different weights, so that equal paths are common.
    emissions = [(w, t, -rng.randint(0, 2)) for w in [*tokens[:3], None] for t in tags if rng.random() < 0.8]
    transitions = [(p, t, -rng.randint(0, 2)) for p in [None, *tags] for t in tags if rng.random() < 0.8]
    listed = {(w, t): x for w, t, x in emissions}
    move = {(p, t): x for p, t, x in transitions}
    known = {w for w, _, _ in emissions} - {None}

    def emit(w, t):
        return listed.get((w if w in known else None, t), TG.FLOOR)

    rows = [(i, [rng.choices(tokens, k=rng.randint(0, 6)) for _ in range(rng.randint(0, 3))]) for i in range(60)]
    texts = [(i, ". ".join(" ".join(s) for s in ss).upper()) for i, ss in rows]
    model = _model(spark, emissions, transitions)
    assert model.tags == tags
    got = {r["review_id"]: (r["n_adjectives"], r["n_nouns"], r["n_verbs"]) for r in TG.pos_density_tagged(
        spark.createDataFrame(texts, "review_id int, review_text string"), model).collect()}
    for i, ss in rows:
        path = [t for s in ss if s for t in _best(s, tags, emit, move)]
        assert got[i] == tuple(path.count(t) for t in tags), (ss, path)


def test_context_decides(spark):
    emissions = [("the", "DET", 0), ("book", "NOUN", -500), ("book", "VERB", -400), ("it", "PRON", 0), ("i", "PRON", 0)]
    transitions = [(None, "DET", 0), (None, "PRON", 0), ("DET", "NOUN", 0), ("DET", "VERB", -5000), ("PRON", "VERB", 0),
                   ("VERB", "DET", 0), ("VERB", "PRON", 0), ("PRON", "NOUN", -5000)]
    texts = [(1, "The book. I book the book!"), (1, "I book it"), (2, None), (3, ""), (4, "?!."), (1, "I book it"), (None, "the book")]
    df = spark.createDataFrame(texts, "review_id int, review_text string")
    got = sorted(((r[0] or 0, r["n_verbs"], r["n_nouns"], r["pos_density"]) for r in TG.pos_density_tagged(df, _model(spark, emissions, transitions)).collect()))
    assert got == [(0, 0, 1, 0.0), (1, 1, 0, 0.0), (1, 1, 0, 0.0), (1, 1, 2, 0.5), (2, 0, 0, 0.0), (3, 0, 0, 0.0), (4, 0, 0, 0.0)]


def test_long_sentence_empty_table_and_models(spark):
    model = _model(spark, [("a", "NOUN", 0), ("a", "VERB", 0)], [(None, "NOUN", 0), ("NOUN", "VERB", 0), ("VERB", "NOUN", 0)])
    df = spark.createDataFrame([(1, "a " * 20001)], "review_id int, review_text string")
    assert TG.pos_density_tagged(df, model).first()["n_nouns"] == 10001
    assert TG.pos_density_tagged(df.limit(0), model).count() == 0
    with pytest.raises(ValueError, match="tags"):
        _model(spark, [], [])
    assert _model(spark, [], [(None, "NOUN", 0)]).tags == ["NOUN"]


def test_words_are_not_shuffled(spark):
    model = _model(spark, [("a", "NOUN", 0)], [(None, "NOUN", 0)])
    df = spark.createDataFrame([(1, "a. a b! c"), (1, "a. a b! c"), (2, "a"), (None, None)], "review_id int, review_text string")
    counted = TG.tag_counts(df, model, ["NOUN"])
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "hashpartitioning" in line and "_s#" in line]
    assert sorted((r[0] or 0, r[1][0]) for r in counted.collect()) == [(0, 0), (1, 4), (1, 4), (2, 1)]
