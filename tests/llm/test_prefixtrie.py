"""The prefix trie against a trie of dictionaries."""

import hashlib
import random
import zlib

import pytest

from veristar.llm import prefixtrie as P

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def _digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def _brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs.setdefault(c, []).append((turn is not None, turn or 0, _digest(role, text), role, text))
    convs = {c: [t[3:] for t in sorted(ts)] for c, ts in convs.items()}
    nodes, last = {}, {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        turns = convs.get(base, [])[:h] + own[h:]
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
        last.setdefault(tuple(turns), []).append(c)
    children, leaves, saved = {}, {}, {}
    for node in nodes:
        if node:
            children.setdefault(node[:-1], []).append(node)
    for node in sorted(nodes, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[x] for x in below) or 1
        own = (len(nodes[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[x] for x in below)
    return sorted(
        (min(m), len(n), min(nodes[n[:-1]]) if n else None, len(m), len(children.get(n, [])), leaves[n], saved[n],
         hashlib.sha256(",".join(map(str, sorted(last.get(n, [])))).encode()).hexdigest()) for n, m in nodes.items())


def _found(spark, rows):
    data = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as depth", "2 as k1", "'x' as range_id", "3 as tie", "4 as pos")
    got = P.prefix_trie(data)
    assert got.columns == COLUMNS
    return sorted((tuple(r) for r in got.collect()), key=lambda r: r[:2])


def _random_rows(seed, n):
    rng = random.Random(seed)
    turns = [("user", "hi"), ("assistant", "yes é"), (None, "hi"), ("user", None), (None, None), ("user", ""), ("", "user")]
    rows = []
    for c in rng.sample(range(-20, 120), n):
        for i in range(rng.choice([1, 2, 5, 9, 12])):
            rows.append((c, rng.choice([i, i, i, None, 3]), *rng.choice(turns[: rng.choice([2, 7])])))
    rows += [(200 + i, t, "user", f"t{t}") for i in range(60) for t in range(10)]  # the same conversation
    rows += [(300 + 5 * i, 0, "user", f"only {i}") for i in range(40)]  # a node of many children
    rows += [(None, 1, "user", "no id"), *rows[:5]]
    return rows


@pytest.mark.parametrize("block", [4096, 3])
def test_equals_dictionaries(spark, monkeypatch, block):
    monkeypatch.setattr(P, "BLOCK", block)
    rows = _random_rows(block, 60)
    assert _found(spark, rows) == _brute(rows)


def test_a_third_of_all_rows_in_one_conversation_and_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK", 5)
    rows = [(10, i, "user", f"turn {i % 3}") for i in range(60)]
    rows += [(c, i, "user", f"turn {i % 3}") for c in (11, 12, 13) for i in range(c)]
    rows += [(20, None, "user", "z" * 300_000), (21, None, "user", "z" * 300_000)]
    assert _found(spark, rows) == _brute(rows)


def test_empty_tables(spark):
    assert _found(spark, []) == []
    assert _found(spark, [(None, 1, "user", "x")]) == []
    assert _found(spark, [(5, None, None, None)]) == _brute([(5, None, None, None)])
    # No base and fewer turns than the opening takes: no turns are left, the root has the only member.
    absent = next(c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2)
    assert _found(spark, [(absent, 1, "user", "x")]) == [
        (absent, 0, None, 1, 0, 1, 0, hashlib.sha256(str(absent).encode()).hexdigest())]


def test_pointer_jumping_ranks_a_shuffled_list(spark):
    rng = random.Random(4)
    ids = list(range(300))
    rng.shuffle(ids)
    arcs = [rng.randint(0, 5) for _ in ids]
    rows = [((i, i, 0), (ids[k + 1], ids[k + 1], 0) if k + 1 < len(ids) else None, arcs[k]) for k, i in enumerate(ids)]
    rng.shuffle(rows)
    kind = "struct<c: long, d: long, k: int>"
    found = P.ranked(spark.createDataFrame(rows, f"id {kind}, next {kind}, arcs long")).collect()
    assert {r.id.c: r.pos for r in found} == {i: sum(arcs[:k]) for k, i in enumerate(ids)}
