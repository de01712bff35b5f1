"""The operators' own parts against brute force, without Spark."""

import gzip
import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from veristar.llm import bpe, chat, kdtree, neardup, secrets, toxicity, warc

tokenizers = pytest.importorskip("tokenizers")
rng = random.Random(3)


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.Merges(bpe.vocabulary()))


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    return tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


ALPHABETS = ["abcdefghijklmnopqrstuvwxyz", "ab", "'stve re ll d", "ÀÉßΣσςİıſK ÅÅ é", "日本語한국", "0٤५", "😀👍🏽‍",
             "\u0085   \x1c\x1f\t\n\r", "ﬁǅ", "!.-", "́̀"]


def test_bpe_equals_library(encoder, library):
    texts = ["", " ", "<|endoftext|>a<|startoftext|>", "It's THE end", "a" * 300, "ab" * 4000]
    for _ in range(1500):
        texts.append("".join(rng.choice(rng.choice(ALPHABETS)) for _ in range(rng.choice([1, 4, 30, 200]))))
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        assert encoder.ids(text) == want
        assert bpe.Decoder(encoder.merges).run(want) == library.decode(want, skip_special_tokens=False)


def _merged(merges, word):
    """Merges in the order of their ranks, the leftmost first."""
    symbols = [*word[:-1], word[-1] + merges.end]
    while len(symbols) > 1:
        rank, at = min((merges.ranks.get(pair, 1 << 60), i) for i, pair in enumerate(zip(symbols, symbols[1:])))
        if rank == 1 << 60:
            break
        symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
    return [merges.ids[s] for s in symbols]


def test_bpe_transducer_equals_merges_and_keeps_little(encoder):
    t = encoder.transducer
    for _ in range(600):
        word = "".join(rng.choice("aeinthrso") for _ in range(rng.randrange(1, 80)))
        assert [*t.feed(word), *t.finish()] == _merged(encoder.merges, word)
    most = 0
    for i, _ in enumerate(t.feed("".join(rng.choice("aeinth") for _ in range(5000)))):
        most = max(most, len(t.states))
    t.finish()
    assert most < 8 * encoder.merges.lookahead


def test_bpe_every_piece_goes_through_the_transducer(encoder, library, monkeypatch):
    fresh = bpe.Encoder(encoder.merges)
    calls = []
    advance = bpe.Transducer._advance
    monkeypatch.setattr(bpe.Transducer, "_advance", lambda self, *a: (calls.extend(a[0]), advance(self, *a))[1])
    fed = []
    feed = bpe.Decoder.feed
    monkeypatch.setattr(bpe.Decoder, "feed", lambda self, ids: (fed.extend(ids), feed(self, ids))[1])
    text = "Some words, some 12 WORDS and é"
    n, ids_sha, text_sha, ids = bpe._digest(fresh, text, True)
    want = library.encode(text, add_special_tokens=False).ids
    assert ids == fed == want and n == len(want)
    # Pieces met again come from the table.
    assert len(calls) == len("somewords,12andé".encode())
    assert ids_sha == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
    assert text_sha == hashlib.sha256(library.decode(want, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_long_runs_in_lots(encoder, library, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK", 50)
    monkeypatch.setattr(bpe.chunks, "__defaults__", (50,))
    for text in ("ab" * 400, "1a!" * 300, "é" * 200 + " x " + "word9" * 100, "x" * 101, ("y" * 120 + " ") * 3, "Σ" * 150):
        want = library.encode(text, add_special_tokens=False).ids
        found = list(encoder.encode(text))
        assert [i for entries in found for ids, _ in entries for i in ids] == want
        assert max(len(ids) for entries in found for ids, _ in entries) <= 50 or " " in text
        assert bpe._digest(encoder, text, True)[3] == want


def test_bpe_decoder_by_pieces(encoder):
    ids = encoder.ids("some words, and more")
    d = bpe.Decoder(encoder.merges)
    assert "".join(d.feed([i]) for i in ids) == bpe.Decoder(encoder.merges).run(ids)


def test_maximal_segments_by_definition():
    def brute(s):  # the best segment first, then the same on both sides
        def best(a, b):
            options = [(sum(s[i:j]), -(j - i), i, j) for i in range(a, b) for j in range(i + 1, b + 1)]
            top = max(options, default=(0,))
            if top[0] <= 0:
                return []
            return [*best(a, top[2]), (top[2], top[3], top[0]), *best(top[3], b)]
        return best(0, len(s))

    for _ in range(400):
        s = [rng.choice([-3.0, -2.0, -1.0, 1.0, 2.0, 5.0]) + rng.random() / 100 for _ in range(rng.randrange(0, 14))]
        got = toxicity.segments(np.array(s))
        want = brute(s)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert np.allclose([g[2] for g in got], [w[2] for w in want])


def test_base_spans_by_definition():
    pattern = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    pieces = ["password", "TOKEN", "secret", "api_key", "apikey", "=", ": ", '"', "'", "deadbeef" * 4, "AKIA", "ABCDEF123456",
              "abc", "K", "é", " ", "\n", "x" * 9, "0123456789abcdef" * 2]
    for _ in range(800):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(0, 14)))
        want = [(m.start(), m.end(), "assign") for m in pattern.finditer(text) if len(m[2]) >= 8]
        want += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
        want += [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
        got = secrets.base_spans(text)
        assert sorted(got) == sorted(want)
        assert [s[0] for s in got] == sorted(s[0] for s in got)


def test_viterbi_and_marginals_by_enumeration():
    r = np.random.default_rng(0)
    transition = r.normal(size=(3, 3))
    for n in (1, 2, 4):
        scores = r.normal(size=(n, 3))
        field = secrets.Field({}, np.zeros((0, 3)), transition)

        def total(path):
            full = [2, *path, 2]
            return sum(transition[a, b] for a, b in zip(full, full[1:])) + sum(scores[i, t] for i, t in enumerate(path))

        paths = list(itertools.product(range(3), repeat=n))
        assert total(field.decode(scores)) == pytest.approx(max(map(total, paths)))
        node, _ = secrets._marginals(scores[None], transition)
        z = sum(np.exp(total(p)) for p in paths)
        for i in range(n):
            for t in range(3):
                assert node[0, i, t] == pytest.approx(sum(np.exp(total(p)) for p in paths if p[i] == t) / z)


def test_viterbi_goes_on_over_the_ends_of_blocks(monkeypatch):
    r = np.random.default_rng(1)
    transition = r.normal(size=(3, 3))
    scores = r.normal(size=(9, 3))
    field = secrets.Field({}, np.zeros((0, 3)), transition)
    whole = field.decode(scores)

    def total(path):
        full = [2, *path, 2]
        return sum(transition[a, b] for a, b in zip(full, full[1:])) + sum(scores[i, t] for i, t in enumerate(path))

    assert total(whole) == pytest.approx(max(map(total, itertools.product(range(3), repeat=9))))
    for size in (1, 2, 4, 8):
        assert list(field.decode_blocks(scores[i:i + size] for i in range(0, 9, size))) == whole
    names = {"letters=hex": 0, "letters=digits": 1}
    field = secrets.Field(names, np.array([[5.0, 6, 0], [0, 0, 5]]), np.array([[0, 3.0, 0], [0, 3, 0], [0, -1e4, 0]]))
    text = "12 " * 3 + "0a1b " * 6 + "77 " * 3
    want = secrets.find_spans(text, field)
    monkeypatch.setattr(secrets, "BLOCK_TOKENS", 5)
    assert secrets.find_spans(text, field) == want and want[1] == [(9, 38, "crf")]


def test_words_that_the_field_tags():
    def tagged(text):
        return [text[s:e] for run in secrets.odd_runs(text) for s, e in run]

    assert tagged("in pw QzXkLmPqRsTuVwYzAbCdEfGhIjKlMnOp here") == ["QzXkLmPqRsTuVwYzAbCdEfGhIjKlMnOp"]
    assert tagged("pw: hunterhunter") == ["hunterhunter"] and tagged("pw='hunter'") == ["hunter"]
    assert tagged("x " + "a" * 20 + " " + "b" * 19) == ["a" * 20]
    assert tagged("Plain words, ALSO these. And é") == []
    assert tagged("a1" + "z" * 50_000) == ["a1" + "z" * 50_000]


def test_field_finds_a_secret_of_letters():
    r = np.random.default_rng(2)

    def key():
        return "".join(chr(c + (65 if u else 97)) for c, u in zip(r.integers(0, 26, 24), r.integers(0, 2, 24)))

    chains = []
    for i in range(80):
        text = f"some words then password: {key()} and note: this McDonald {i} went to room 12_{i}"
        spans = secrets.base_spans(text)
        chains += [(secrets.run_features(text, run), secrets.tags_of(run, spans)) for run in secrets.odd_runs(text)]
    field, secret = secrets.train(chains), key()
    text = f"the pw: {secret} and note: that McDonald 7 went"
    base, spans = secrets.find_spans(text, field)
    assert base == [] and [text[s:e] for s, e, _ in spans] == [secret]


def test_field_learns_base_tokens():
    texts = [f"some words then key {i:040x} and more words of text" for i in range(60)]
    texts += [f"call {1000000 + i} or room 12_{i} now" for i in range(60)]
    chains = []
    for t in texts:
        spans = secrets.base_spans(t)
        for run in secrets.odd_runs(t):
            chains.append((secrets.run_features(t, run), secrets.tags_of(run, spans)))
    field = secrets.train(chains)
    hits = [field.decode(field.scores(f, [])) for f, _ in chains]
    assert hits == [tags for _, tags in chains]
    assert secrets.train([(f, [2] * len(t)) for f, t in chains]) is None


def test_cheapest_repair_by_enumeration():
    def brute(roles):
        best = [10 ** 9]

        def go(i, state, cost):
            if cost >= best[0]:
                return
            if i == len(roles):
                best[0] = cost
                return
            for b in (1, 2, 3):
                go(i + 1, b, cost + chat._table(roles[i])[state][b][0])

        go(0, 0, 0)
        return best[0]

    for _ in range(200):
        roles = [rng.choice(["system", "user", "assistant", None, "tool"]) for _ in range(rng.randrange(1, 7))]
        steps, cost, state, out = chat.repair(roles, 0), 0, 0, []
        for role, (to, action, inserted) in zip(roles, steps):
            cost += chat._table(role)[state][to][0]
            out += [*inserted] + ([to] if action != "merge" else [])
            state = to
        assert cost == brute(roles) == min(chat.summary(roles)[:4])
        assert all(p in chat._LEGAL for p in zip([0, *out], out))


def _warc(payloads):
    out = []
    for i, p in enumerate(payloads):
        import hashlib
        head = (f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: urn:page:{i}\r\n"
                f"WARC-Block-Digest: sha256:{hashlib.sha256(p).hexdigest()}\r\nContent-Length: {len(p)}\r\n\r\n")
        out.append(head.encode() + p + b"\r\n\r\n")
    return out


@pytest.mark.parametrize("packed", [False, True])
def test_salvage_after_damage(packed):
    records = _warc([b"first", b"WARC/1.1\r\nfalse start", b"x" * 500, b"", b"last"])
    parts = [gzip.compress(r) for r in records] if packed else records
    data = b"".join(parts)
    sound = [h["warc-target-uri"] for _, _, h, _ in warc.salvage(data) if isinstance(h, dict)]
    assert sound == [f"urn:page:{i}" for i in range(5)]
    at = sum(map(len, parts[:2])) + len(parts[2]) // 2
    broken = data[:at] + bytes([data[at] ^ 0xFF]) + data[at + 1:]
    found = list(warc.salvage(broken))
    assert [h["warc-target-uri"][-1] for _, _, h, _ in found if isinstance(h, dict)] == ["0", "1", "3", "4"]
    gaps = [(m + o, n) for m, o, h, n in found if isinstance(h, str)]
    assert gaps == [(sum(map(len, parts[:2])), len(parts[2]))]
    cut = list(warc.salvage(data[:-3]))
    assert len([1 for _, _, h, _ in cut if isinstance(h, dict)]) >= 4
    assert list(warc.salvage(b"")) == []
    assert list(warc.salvage(b"noise"))[0][3] == 5


def test_salvage_decides_by_place():
    body = gzip.compress(b"a packed body of some length")
    plain = _warc([body, b"second", b"third"])
    assert [h["warc-target-uri"][-1] for _, _, h, _ in warc.salvage(b"".join(plain))] == ["0", "1", "2"]
    # A packed body of a broken record is no place to go on; plain records and members may follow each other.
    broken = plain[0][:-6] + b"#" + plain[0][-5:]
    found = list(warc.salvage(broken + plain[1] + gzip.compress(plain[2])))
    assert [(m, o, h if isinstance(h, str) else h["warc-target-uri"][-1]) for m, o, h, _ in found] == [
        (0, 0, "block digest differs"), (0, len(broken), "1"), (len(broken) + len(plain[1]), 0, "2")]
    assert found[0][3] == len(broken)


def test_packed_members_end_with_a_zero():
    for record in (b"", b"abc", b"x" * (1 << 24), b"y" * ((1 << 24) + 5)):
        member = warc.packed(record)
        assert member[-1] == 0 and gzip.decompress(member) == record


def test_tree_equals_brute_force():
    r = np.random.default_rng(1)
    points = r.integers(-9, 9, (700, 5))
    points[100:300] = points[100]  # many copies
    ids = r.permutation(700)
    tree = kdtree.Tree(points, ids, leaf=16)
    got = tree.search(points[:40], ids[:40], np.full(40, kdtree._FAR), 5)
    for i in range(40):
        scores = points @ points[i]
        want = sorted((-s, o) for s, o in zip(scores, ids) if o != ids[i])[:5]
        assert sorted((-s, o) for q, s, o in got if q == ids[i]) == want


def test_hashed_sets_equal_word_sets():
    h = neardup.Hasher()
    word = re.compile(r"[^\x20\x09-\x0D]+")
    for _ in range(200):
        text = "".join(rng.choice(["a", "B", "é", " ", " ", "\n", "\x1c", "the ", "of\t"]) for _ in range(rng.randrange(0, 60)))
        w = word.findall("".join(c.lower() if c.isascii() else c for c in text))
        want = {(a, b) for a, b in zip(w, w[1:])} or ({tuple(w)} if w else set())
        assert len(h.shingles(text)) == len(want)
    assert (h.shingles("A b c") == h.shingles("a  B\nc")).all()
    long = "word " * 100_000 + "x" * 600_000 + " end"
    assert len(h.shingles(long)) == 3


def _random_field(r):
    names = {f"letters={k}": i for i, k in enumerate(("alpha", "digits", "hex", "key", "other", "upper"))}
    names |= {f"before:word={w}": i + 6 for i, w in enumerate(("pass", "the", "und"))} | {"sign==": 9, "after=edge": 10}
    transition = r.normal(size=(3, 3)) * 2
    transition[2, 1] = -1e4
    return secrets.Field(names, r.normal(size=(11, 3)) * 2 + [0, 0, 1.5], transition)


def test_every_token_of_a_text_is_scored(monkeypatch):
    # A field that takes the word behind "pass" for a secret finds it where it is a plain word behind a blank.
    names = {"before:word=pass": 0}
    field = secrets.Field(names, np.array([[9.0, 0, 0]]), np.array([[0, 0, 0.0], [0, 0, 0], [-1, -1e4, 2]]))
    assert secrets.find_spans("the pass swordfish is new", field)[1] == [(9, 18, "crf")]
    r = np.random.default_rng(4)
    words = ["the", "pass", "und", "x=", "12", "0af3", "QX12", "k-y.z", "swordfish.", "(", "é", "=", " \n"]
    for size in (1 << 20, 7):  # whole, and in lots
        monkeypatch.setattr(secrets, "LOT_CHARS", size)
        for _ in range(150):
            field = _random_field(r)
            text = " ".join(r.choice(words, r.integers(0, 40)))
            run = [m.span() for m in secrets.TOKEN.finditer(text)]
            if not run:
                continue
            scores = field.scores(secrets.run_features(text, run), secrets.file_features(text, []))

            def total(tags):
                full = [2, *tags, 2]
                return sum(field.transition[a, b] for a, b in zip(full, full[1:])) + sum(scores[i, t] for i, t in enumerate(tags))

            found = secrets.find_spans(text, field)[1]
            tags = [next((int(s != a) for a, b, _ in found if a <= s < b), 2) for s, _ in run]
            # Paths may tie, so scores are compared.
            assert total(tags) == pytest.approx(total(field.decode(scores)))


def test_secrets_sample_as_numbers_trains_the_field_of_the_lists():
    rng = random.Random(3)
    chains = []
    for _ in range(60):
        size = rng.randint(1, 4)
        tags = [rng.choice([0, 2, 2]) for _ in range(size)]
        chains.append(([[f"f{rng.randint(0, 6)}" for _ in range(rng.randint(1, 3))] for _ in range(size)], tags))
    chains += chains[:3]
    features = pa.array([f for f, _ in chains], pa.list_(pa.list_(pa.string())))
    numbers = secrets.Chains.of(features, pa.array([t for _, t in chains], pa.list_(pa.int32())))
    want = secrets.Chains.listed(sorted(chains))
    assert numbers.features == want.features
    for name in ("places", "per_token", "tags", "lengths"):
        assert getattr(numbers, name).tolist() == getattr(want, name).tolist(), name
    a, b = secrets.train(numbers), secrets.train(sorted(chains))
    assert a.names == b.names and (a.emission == b.emission).all() and (a.transition == b.transition).all()
    empty = secrets.Chains.of(features[:0], pa.array([], pa.list_(pa.int32())))
    assert secrets.train(empty) is None


def test_secrets_forms_of_all_tokens_at_once():
    tokens = ["aZ9", "Σïx-7", "G_é\U0001f600Q", "0fFg"]
    assert secrets.forms(tokens) == ["aA0", "Σïg-0", "A_é\U0001f600A", "0aAg"]
    assert secrets.base_spans("password is hunter2hunter2") == []
