"""The filter audit against plain loops."""

import random
import re
from itertools import permutations

from veristar.llm import filteraudit as A


def test_gallop_union_difference():
    rng = random.Random(3)
    for _ in range(2000):
        lists = [sorted(rng.sample(range(60), rng.choice([0, 1, 3, 30, 60]))) for _ in range(rng.randint(0, 5))]
        assert A.union(lists) == sorted({x for part in lists for x in part})
        if len(lists) > 1:
            assert A.difference(lists[0], lists[1]) == [x for x in lists[0] if x not in set(lists[1])]
        if lists and lists[0]:
            start, value = rng.randrange(len(lists[0])), rng.randrange(-1, 61)
            want = next((i for i in range(start, len(lists[0])) if lists[0][i] >= value), len(lists[0]))
            assert A.gallop(lists[0], value, start) == want


def test_runs_are_taken_at_once(monkeypatch):
    calls = []
    plain = A.gallop
    monkeypatch.setattr(A, "gallop", lambda *a: calls.append(1) or plain(*a))
    blocks = [list(range(i * 10_000, (i + 1) * 10_000)) for i in range(5)]
    assert A.union(blocks) == list(range(50_000)) and len(calls) < 10
    assert A.difference(list(range(50_000)), blocks[2]) == blocks[0] + blocks[1] + blocks[3] + blocks[4]
    assert len(calls) < 30_000  # one for each removed item at most


def _brute(rows, labels):
    """rows: (doc_id, text, lang); labels: (doc_id, quality, toxic)."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    bad = {i for i, _, t in labels if t == 1 and i is not None}
    smallest = {}
    for i, text, _ in rows:
        if i is not None:
            smallest[text or ""] = min(i, smallest.get(text or "", i))
    parts = {}
    for i, text, lang in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search("[#$%&*|]", text)),
                 "E": i is not None and i > smallest[text]}
        parts.setdefault(lang or "", []).append(({f for f, x in fails.items() if x}, i in good, i in bad))
    out = {}
    for part, docs in parts.items():
        steps, total = {}, dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            live = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in live if f in d[0]]
                earlier = set(order[:step - 1])
                live = [d for d in live if f not in d[0]]
                total[f] += len(gone)
                steps["".join(order), step] = [
                    len(live), len(gone), sum(f in d[0] and bool(d[0] & earlier) for d in docs),
                    sum(d[0] == {f} for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone)]
        for (order, step), values in steps.items():
            out[part, order, step] = (*values, total[order[step - 1]])
    return out


def _found(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr(
        "doc_id", "text", "lang", "1 as bits", "'x' as Part", "2 as n", "'y' as digest", "false as salt")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'z' as salt", "1 as is_good")
    got = A.audit(docs, marks).collect()
    found = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost,
                                                r.shapley) for r in got}
    assert len(found) == len(got)
    return found


def test_equals_loops_on_nulls_ties_and_repeats(spark, monkeypatch):
    rng = random.Random(8)
    words = ["alpha", "Beta", "GAMMA", "delta#", "x|y", "ÄÖ", "eps ilon", "z"]
    texts = [None, "", " \t\n", "A" * 40, "a b c", "$", " ".join(f"w{i}" for i in range(100)), " ".join(f"w{i}" for i in range(99)),
             " ".join(["w"] * 200_000)]
    texts += [" ".join(rng.choice(words) + str(rng.randrange(200)) for _ in range(rng.choice([3, 120, 130]))) for _ in range(12)]
    rows = [(rng.choice([None, *range(60)]), rng.choice(texts), rng.choice([None, "", "en", "de"])) for _ in range(400)]
    rows += [(7, "copy of all", "en")] * 300 + [(None, "copy of all", "fr")] * 50 + [(i, "copy of all", "fr") for i in range(100, 160)]
    labels = [(rng.choice([None, *range(80)]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1])) for _ in range(90)]
    assert _found(spark, rows, labels) == _brute(rows, labels)
    # Ranges of a few rows give the same sums.
    monkeypatch.setattr(A, "RANGE", 7)
    assert _found(spark, rows[:200], labels) == _brute(rows[:200], labels)


def test_empty_tables(spark):
    assert _found(spark, [], []) == {}
    clean = " ".join(f"w{i}" for i in range(150))
    found = _found(spark, [(1, clean, "en")], [])
    assert len(found) == 600 and set(found.values()) == {(1, 0, 0, 0, 0, 0, 0)}
