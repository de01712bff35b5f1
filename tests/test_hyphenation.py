"""Syllables by patterns: published hand-worked words, a plain walk, and readability of odd texts."""

import random
import re

import pytest

from veristar.operators import hyphenation as HY
from veristar.sources import params as P

# The worked examples of the published method.
EXAMPLE = ["hy3ph", "he2n", "hena4", "hen5at", "1na", "n2at", "1tio", "2io", "o2n"]


def _breaks(word, patterns, left=2, right=2):
    dotted = f".{word}."
    levels = [0] * (len(dotted) + 1)
    for p in set(patterns):
        letters = re.sub("[0-9]", "", p)
        marks, i = [0] * (len(letters) + 1), 0
        for c in p:
            if c.isdigit():
                marks[i] = int(c)
            else:
                i += 1
        for at in range(len(dotted) - len(letters) + 1):
            if dotted.startswith(letters, at):
                for k, m in enumerate(marks):
                    levels[at + k] = max(levels[at + k], m)
    return [g for g in range(left, len(word) - right + 1) if levels[g + 1] % 2]


def _syllables(spark, words, patterns, exceptions=None):
    given = None if exceptions is None else P.column_table(spark, "word", exceptions)
    rows = HY.word_syllables(P.column_table(spark, "word", words), P.column_table(spark, "pattern", patterns), given).collect()
    return {r["word"]: r["n_syllables"] for r in rows}


def test_hand_worked_words(spark):
    # hy-phen-ation: the levels 3 and 5 are odd and highest at their gaps.
    assert _breaks("hyphenation", EXAMPLE) == [2, 6]
    assert _syllables(spark, ["hyphenation", "the"], EXAMPLE) == {"hyphenation": 3, "the": 1}
    assert _syllables(spark, ["table", "tables"], ["1b"], ["ta-b-le"]) == {"table": 3, "tables": 2}
    assert _syllables(spark, ["ab", "é"], []) == {"ab": 1, "é": 1}


def test_matches_a_plain_walk(spark):
    rng = random.Random(3)
    letters = "abcé"
    patterns = []
    for _ in range(60):
        p = "".join(rng.choice(["", "", str(rng.randint(1, 5))]) + rng.choice(letters) for _ in range(rng.randint(1, 4))) + rng.choice(["", "1", "2"])
        patterns.append(rng.choice(["", ".", ""]) + p + rng.choice(["", ".", ""]))
    words = sorted({"".join(rng.choices(letters, k=rng.randint(1, 14))) for _ in range(300)})
    assert _syllables(spark, words, patterns * 2) == {w: 1 + len(_breaks(w, patterns)) for w in words}


@pytest.mark.parametrize("patterns", [EXAMPLE, []])
def test_readability_of_odd_texts(spark, patterns):
    text = "Hyphenation! The hyphenation."
    rows = [(1, text), (1, text), (1, "the"), (2, None), (3, ""), (None, text), (4, "..."), (5, "hyphenation " * 20000)]
    df = spark.createDataFrame(rows, "review_id int, review_text string")
    got = HY.pattern_readability(df, P.column_table(spark, "pattern", patterns)).collect()
    per = 3 if patterns else 1
    one = (3, 2 * per + 1)
    assert sorted(((r["review_id"] or 0, r["n_words"], r["n_syllables"]) for r in got)) == sorted(
        [(1, *one), (1, *one), (1, 1, 1), (2, 0, 0), (3, 0, 0), (0, *one), (4, 0, 0), (5, 20000, 20000 * per)])
    assert {r["readability_score"] for r in got if r["n_words"] == 0} == {0.0}
    assert HY.pattern_readability(df.limit(0), P.column_table(spark, "pattern", patterns)).count() == 0


def test_tokens_of_frequent_words_are_not_shuffled(spark, monkeypatch):
    rows = [(i, " ".join(["the", "hyphenation", f"table{i % 7}", "the"] * (i % 4))) for i in range(60)] + [(1, None), (3, "the table")]
    df = spark.createDataFrame(rows, "review_id int, review_text string")
    patterns = P.column_table(spark, "pattern", EXAMPLE)
    whole = HY.pattern_readability(df, patterns)
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_row1" in plan and not re.search(r"hashpartitioning\([^)]*word", plan)
    want = sorted(map(repr, whole.collect()))
    for bound in (0, 1, 3):  # the others, or all, by a join
        monkeypatch.setattr(HY, "BROADCAST_ROWS", bound)
        assert sorted(map(repr, HY.pattern_readability(df, patterns).collect())) == want
