"""Secrets in texts: base patterns, and a linear-chain conditional random field.

Base spans come from three patterns (see ``base_spans``) and always stay. The field tags
tokens as begin, inside or outside of a secret and adds spans that no base span touches.
Its features are the token's shape, length and letters, the words and signs next to it,
and those of the whole text ("file"): its length, share of digits and whether a base
span is in it. It is trained in numpy on the driver, on token windows of a bounded,
documented sample: at most about ``SAMPLE_DOCS`` documents with base spans and as many others
with digits, ``WINDOWS_PER_DOC`` windows of ``WINDOW`` neighbouring tokens each. The base spans are its labels.

Every token of a text is scored, plain words too, and the best path is that of the whole text's chain, by Viterbi. A token whose
score for outside is ahead by more than its neighbours' transitions can make up for is outside on every best path (``sure``), so the chain falls
into the runs between such tokens and only these are walked. A run of any length is decoded as a whole: scores are made
in lots of a text, and the best scores and back pointers go on from one lot to the next.

Defined results: a null text is empty and has no spans; positions count code points, ends are
exclusive; spans are ordered by start, then kind; repeated rows are scanned each; without
base spans in the sample nothing is added; other columns stay out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices

SAMPLE_DOCS = 1000
WINDOWS_PER_DOC = 6
WINDOW = 12
EPOCHS = 50
KINDS = ("assign", "access", "hex", "crf")
TAGS = ("begin", "inside", "outside")
_OUT = 2
#: Words of letters alone from this length on are no plain words, whatever their case.
PLAIN_BELOW = 20
BLOCK_TOKENS = 4096
#: Characters of a text that are tokenised at once, at least.
LOT_CHARS = 1 << 20
#: Scores that a worker keeps for words that it has met.
KNOWN_WORDS, KNOWN_CHARS = 200_000, 8_000_000

#: The base patterns: fixed values.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")

#: Signs that part tokens; a dot does so at the end of a token only.
_PARTS = r"""\s"'=:;,()<>\[\]{}`!?"""
TOKEN = re.compile(rf"[^{_PARTS}.]+(?:\.+[^{_PARTS}.]+)*")
#: A match ends with a character of a token that is not a plain word: a sign in it, a capital behind a small letter, or
#: the first letter behind the sign of an assignment. All branches begin with a set of characters, which is quick.
_ODD_SIGNS = (rf"[^{_PARTS}.\w]|[\d_]|\.(?<=\w.)(?=\w)|[A-Z](?<=[a-z].)"
              r"|[:=]\x20?[\"']?[^\W\d_]")
_ODD = re.compile(_ODD_SIGNS)
#: The same, and long words of letters.
_ODD_LONG = re.compile(rf"{_ODD_SIGNS}|[^\W\d_](?<![^\W\d_].)[^\W\d_]{{{PLAIN_BELOW - 1}}}")
_CLOSE = re.compile(rf"[{_PARTS}]")
_CUT = re.compile(rf"({TOKEN.pattern})")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind), leftmost and not overlapping within a kind."""
    signed = ":" in text or "=" in text  # as every assignment is
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8] if signed else []
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    # A run of 32 or more is always matched as a whole, as it is from its first character on.
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _shape(token: str) -> str:
    runs, last = [], ""
    for c in token:
        k = "d" if c.isdigit() else "x" if c.islower() else "X" if c.isupper() else "l" if c.isalpha() else c
        if k != last:
            runs.append(k)
            last = k
    return "".join(runs[:8]) + "+" * (len(runs) > 8)


def _letters(token: str) -> str:
    if re.fullmatch(r"\d+", token):
        return "digits"
    if re.fullmatch(r"[0-9a-f]+", token):
        return "hex"
    if re.fullmatch(r"[0-9A-Z]+", token):
        return "upper"
    if token.isalpha():
        return "alpha"
    return "key" if re.fullmatch(r"[A-Za-z0-9+/_.=-]+", token) else "other"


def _size(n: int) -> str:
    return str(min(n, 8)) if n < 8 else "16" if n < 16 else "20" if n < 20 else "32" if n < 32 else "long"


def own_features(token: str, sign: str) -> list[str]:
    letters = _letters(token)
    return [f"letters={letters}", f"size={letters}/{_size(len(token))}", f"shape={_shape(token)[:6]}",
            f"mix={len(_shape(token)) > 4}/{_size(len(token))}", f"sign={sign}", f"sign={sign}/{letters}"]


def side_features(side: str, token: str | None) -> list[str]:
    if token is None:
        return [f"{side}=edge"]
    letters = _letters(token)
    return [f"{side}:letters={letters}", *([f"{side}:word={token.lower()}"] if len(token) <= 12 else [])]


def file_features(text: str, found: list) -> list[str]:
    digits = sum(map(text.count, "0123456789")) / max(1, len(text))
    return [f"file:size={len(text).bit_length()}", f"file:digits={min(9, int(digits * 100))}", f"file:base={bool(found)}"]


def odd_runs(text: str) -> list[list[tuple[int, int]]]:
    """Runs of neighbouring tokens that are not plain words (start, end); training takes windows that hold them first."""
    runs: list[list[tuple[int, int]]] = []
    done = -1
    long = any(len(word) >= PLAIN_BELOW for word in text.split())
    for m in (_ODD_LONG if long else _ODD).finditer(text):
        start = at = m.end() - 1
        if at < done:
            continue
        while start > 0 and not _CLOSE.match(text, start - 1):
            start -= 1
        token = None
        for token in TOKEN.finditer(text, start):
            if token.end() > at:
                break
        if token is None or token.start() > at:
            continue
        done = token.end()
        if runs and not _has_token(text, runs[-1][-1][1], token.start()):
            runs[-1].append(token.span())
        else:
            runs.append([token.span()])
    return runs


class _Signs(dict):
    """The sign of each gap between tokens; long gaps are not kept."""

    def __missing__(self, gap: str) -> str:
        sign = _sign(gap)
        if len(gap) < 4 and len(self) < KNOWN_WORDS:
            self[gap] = sign
        return sign


_SIGNS = _Signs()


def _has_token(text: str, start: int, end: int) -> bool:
    return TOKEN.search(text, start, end) is not None


def _before(text: str, at: int) -> tuple[str | None, str]:
    """The token before a place and the sign between, looked for as far as 64 characters back."""
    low = max(0, at - 64)
    last = None
    for last in TOKEN.finditer(text, low, at):
        pass
    return (last[0] if last else None), _sign(text[last.end() if last else low:at])


def _sign(gap: str) -> str:
    """What stands between two tokens: the sign of an assignment, else the last sign, else a blank."""
    return next((c for c in reversed(gap) if c in "=:"), next((c for c in reversed(gap) if not c.isspace()), " "))


def lots(text: str) -> Iterator[tuple[int, list[str]]]:
    """(offset, parts): gaps and tokens in turn, a gap first and last. A lot ends behind a character that no token holds."""
    start = 0
    while start < len(text):
        cut = _CLOSE.search(text, start + LOT_CHARS)
        end = cut.end() if cut else len(text)
        yield start, _CUT.split(text[start:end] if start or end < len(text) else text)
        start = end


def run_features(text: str, run: list[tuple[int, int]]) -> list[list[str]]:
    """Own and side features for each token of a run (or of a block of one) and the tokens around it."""
    tokens = [text[s:e] for s, e in run]
    after = TOKEN.search(text, run[-1][1], min(len(text), run[-1][1] + 64))
    out = []
    for i, (start, _) in enumerate(run):
        before, sign = _before(text, start)
        following = tokens[i + 1] if i + 1 < len(run) else after[0] if after else None
        out.append(own_features(tokens[i], sign) + side_features("before", before) + side_features("after", following))
    return out


class Scored(dict):
    """The place of each key's scores in a table that grows as keys are met."""

    def __init__(self, score, width: int):
        super().__init__()
        self.score, self.table, self.chars = score, np.zeros((1024, width)), 0

    def __missing__(self, key: str) -> int:
        at = len(self)
        if at == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[at] = self.score(key)
        self[key] = at
        self.chars += len(key)
        return at

    def rows(self, keys: list[str]) -> np.ndarray:
        at = list(map(self.__getitem__, keys))
        return self.table[at]


#: Characters that the features of a token's form do not tell apart: digits, a to f, g to z, A to Z.
_FORM = bytes.maketrans(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0" * 10 + b"a" * 6 + b"g" * 20 + b"A" * 26)


def forms(tokens: list[str]) -> list[str]:
    """The forms of tokens, which hold no white space; all go through the table at once."""
    return "\n".join(tokens).encode("utf-8", "surrogatepass").translate(_FORM).decode("utf-8", "surrogatepass").split("\n")


class Field:
    """Weights of features for each tag, and of neighbouring tags."""

    def __init__(self, names: dict[str, int], emission: np.ndarray, transition: np.ndarray):
        self.names, self.emission, self.transition = names, emission, transition
        t = transition
        tags = range(3)
        # The most that neighbours can gain from a token that is not outside, where its follower is not inside, and where it is.
        self.gain = max(t[a, x] + t[x, b] - t[a, _OUT] - t[_OUT, b] for a in tags for x in (0, 1) for b in (0, _OUT))
        self.gain_inside = max(t[a, x] + t[x, 1] + t[1, c] - t[a, _OUT] - t[_OUT, 0] - t[0, c]
                               for a in tags for x in (0, 1) for c in tags)
        # Words that side features name, and what each adds to the token behind it and to the one in front of it.
        named = sorted({f.partition(":word=")[2] for f in names if f.startswith(("before:word=", "after:word="))})
        self.word_at = {w: i for i, w in enumerate(named, 1)}
        self.word_scores = np.array([np.zeros(6)] + [self._sides(f":word={w}") for w in named])
        self._known: list[Scored] = []

    def _sides(self, ending: str) -> np.ndarray:
        return np.r_[self._sum([f"before{ending}"]), self._sum([f"after{ending}"])]

    def known(self) -> list[Scored]:
        """Scores by form: a token's own (key: a sign, then the form), and those that it adds to its neighbours."""
        if not self._known or any(len(k) > KNOWN_WORDS or k.chars > KNOWN_CHARS for k in self._known):
            self._known = [Scored(lambda k: self._sum(own_features(k[1:], k[0])), 3),
                           Scored(lambda k: self._sides(f":letters={_letters(k)}"), 6)]
        return self._known

    def token_scores(self, tokens: list[str], signs: list[str], before: str | None, after: str | None, file: np.ndarray) -> np.ndarray:
        """Scores of neighbouring tokens, those at the ends of which have ``before`` and ``after`` next to them."""
        own, side = self.known()
        form = forms(tokens)
        words = list(map(self.word_at.get, "\n".join(tokens).lower().split("\n"), repeat(0)))
        scores = own.rows(list(map(str.__add__, signs, form))) + file
        gives = side.rows(form) + self.word_scores[words]
        scores[1:] += gives[:-1, :3]
        scores[:-1] += gives[1:, 3:]
        scores[0] += self._sum(side_features("before", before))
        scores[-1] += self._sum(side_features("after", after))
        return scores

    def sure(self, scores: np.ndarray) -> np.ndarray:
        """Tokens that are outside on every best path; the last one is not settled, as its follower is not known."""
        lead = scores[:, _OUT] - scores[:, :_OUT].max(axis=1)
        settled = np.zeros(len(scores), dtype=bool)
        settled[:-1] = lead[:-1] > np.maximum(self.gain, self.gain_inside + scores[1:, 1] - scores[1:, 0]) + 1e-9
        return settled

    def scores(self, features: list[list[str]], file: list[str]) -> np.ndarray:
        common = self._sum(file)
        return np.array([self._sum(f) for f in features]) + common

    def _sum(self, features: list[str]) -> np.ndarray:
        rows = [self.names[f] for f in features if f in self.names]
        return self.emission[rows].sum(axis=0) if rows else np.zeros(3)

    def decode(self, scores: np.ndarray) -> list[int]:
        return list(self.decode_blocks([scores]))

    def decode_blocks(self, blocks: Iterable[np.ndarray]) -> bytearray:
        """The best tags of a chain whose scores come in blocks, outside before and after."""
        into = self.transition.T.tolist()  # for each tag, from which tag
        best, back = None, bytearray()
        for scores in blocks:
            for row in scores.tolist():
                if best is None:
                    best = [own + t[_OUT] for own, t in zip(row, into)]
                    continue
                found = []
                for own, (a, b, c) in zip(row, into):
                    a, b, c = best[0] + a, best[1] + b, best[2] + c
                    tag = 0 if a >= b and a >= c else 1 if b >= c else 2
                    back.append(tag)
                    found.append(own + (a, b, c)[tag])
                best = found
        last = [score + row[_OUT] for score, row in zip(best, self.transition.tolist())]
        tags = bytearray([last.index(max(last))])
        for i in range(len(back) - 3, -1, -3):
            tags.append(back[i + tags[-1]])
        tags.reverse()
        return tags


#: Inside never follows outside.
_FORBIDDEN = -1e4


@dataclass(frozen=True)
class Chains:
    """Chains of a sample as numbers: the driver holds a feature's name once, not for each token that has it."""

    features: list[str]  # all names, in order
    places: np.ndarray  # of the features of all tokens, token by token
    per_token: np.ndarray  # how many features a token has
    tags: np.ndarray  # of all tokens
    lengths: np.ndarray  # tokens of each chain

    @classmethod
    def of(cls, features: pa.Array, tags: pa.Array) -> Chains:
        """``features``: a list of tokens, each a list of names, for each chain; in the order of these lists, then of the tags."""
        coded = features.flatten().flatten().dictionary_encode()
        return cls.coded(features, coded.indices.to_numpy(), coded.dictionary.to_pylist(), tags)

    @classmethod
    def coded(cls, features: pa.Array, at: np.ndarray, names: list[str], tags: pa.Array) -> Chains:
        """The same, where ``features`` gives the lists' lengths and ``at`` the place in ``names`` of each feature."""
        rows = features.flatten()
        ordered = sorted(range(len(names)), key=names.__getitem__)
        rank = np.empty(len(names), dtype=np.int32)
        rank[ordered] = np.arange(len(names), dtype=np.int32)
        places = rank[at] if names else np.zeros(0, np.int32)
        per_token, lengths = (pc.list_value_length(a).to_numpy(zero_copy_only=False).astype(np.int64) for a in (rows, features))
        flat = tags.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
        # Big-endian ranks from 1 on, zero behind each token and each chain: byte order is the order of the lists of names.
        marked = np.insert(places + 1, np.cumsum(per_token), 0).astype(">i4")
        token_ends = np.cumsum(per_token + 1)
        chain_ends = np.cumsum(lengths)
        stops = [0, *(token_ends[chain_ends - 1] if len(lengths) else [])]
        keys = [marked[a:b].tobytes() + b"\0\0\0\0" + flat[e - n:e].astype(">i4").tobytes()
                for a, b, e, n in zip(stops, stops[1:], chain_ends, lengths)]
        return cls([names[i] for i in ordered], places, per_token, flat, lengths)._taken(
            sorted(range(len(keys)), key=keys.__getitem__))

    @classmethod
    def listed(cls, chains: list[tuple[list[list[str]], list[int]]]) -> Chains:
        """Chains given as lists, in their order."""
        names = sorted({f for features, _ in chains for row in features for f in row})
        place = {f: i for i, f in enumerate(names)}
        rows = [row for features, _ in chains for row in features]
        return cls(names, np.array([place[f] for row in rows for f in row], dtype=np.int32),
                   np.array([len(row) for row in rows], dtype=np.int64),
                   np.array([t for _, tags in chains for t in tags], dtype=np.int32),
                   np.array([len(tags) for _, tags in chains], dtype=np.int64))

    def _taken(self, order: list[int] | np.ndarray) -> Chains:
        """The chains in another order."""
        tokens = _runs(self.lengths, np.asarray(order, dtype=np.int64))
        return Chains(self.features, self.places[_runs(self.per_token, tokens)], self.per_token[tokens], self.tags[tokens],
                      self.lengths[order])

    def by_length(self) -> Chains:
        return self._taken(np.argsort(self.lengths, kind="stable"))


def _runs(sizes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Places of the elements of consecutive runs, the runs in the given order."""
    starts, taken = np.cumsum(sizes) - sizes, sizes[order]
    return np.repeat(starts[order] - (np.cumsum(taken) - taken), taken) + np.arange(taken.sum())


def train(chains: Chains | list[tuple[list[list[str]], list[int]]], epochs: int = EPOCHS, rate: float = 0.5,
          penalty: float = 0.1) -> Field | None:
    """chains: features (file features among them) and tags of each run."""
    if not isinstance(chains, Chains):
        chains = Chains.listed(chains)
    if not (chains.tags != _OUT).any():
        return None
    chains = chains.by_length()
    often = np.bincount(chains.places, minlength=len(chains.features)) >= 3
    names = {f: i for i, f in enumerate(f for f, kept in zip(chains.features, often) if kept)}
    kept = often[chains.places]
    n_tokens, tags, lengths = len(chains.tags), chains.tags, chains.lengths
    flat = (np.cumsum(often) - 1)[chains.places[kept]]
    of = np.repeat(np.arange(n_tokens), chains.per_token)[kept]
    gold = np.zeros((n_tokens, 3))
    gold[np.arange(n_tokens), tags] = 1
    pairs = np.zeros((3, 3))
    ends = np.cumsum(lengths)
    first = np.zeros(n_tokens, dtype=bool)
    first[ends[lengths > 0] - lengths[lengths > 0]] = True
    np.add.at(pairs, (np.where(first, _OUT, np.roll(tags, 1)), tags), 1)
    np.add.at(pairs, (tags[ends[lengths > 0] - 1], _OUT), 1)
    pairs[_OUT, _OUT] += (lengths == 0).sum()
    emission, transition = np.zeros((len(names), 3)), np.zeros((3, 3))
    fixed = np.zeros((3, 3))
    fixed[_OUT, 1] = _FORBIDDEN
    squares_e, squares_t = np.full_like(emission, 1e-6), np.full_like(transition, 1e-6)
    for _ in range(epochs):
        scores = np.stack([np.bincount(of, emission[flat, k], n_tokens) for k in range(3)], axis=1)
        node, edge, start = np.empty_like(scores), np.zeros((3, 3)), 0
        for n in np.unique(lengths):  # chains of one length go together
            size = int((lengths == n).sum()) * n
            p, e = _marginals(scores[start:start + size].reshape(-1, n, 3), transition + fixed)
            node[start:start + size] = p.reshape(-1, 3)
            edge += e
            start += size
        left = gold - node
        grad_e = np.stack([np.bincount(flat, left[of, k], len(names)) for k in range(3)], axis=1) - penalty * emission
        grad_t = pairs - edge - penalty * transition
        squares_e += grad_e ** 2
        squares_t += grad_t ** 2
        emission += rate * grad_e / np.sqrt(squares_e)
        transition += rate * grad_t / np.sqrt(squares_t)
    return Field(names, emission, transition + fixed)


def _lse(z: np.ndarray, axis: int) -> np.ndarray:
    top = z.max(axis=axis, keepdims=True)
    return np.log(np.exp(z - top).sum(axis=axis)) + np.squeeze(top, axis)


def _marginals(scores: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(chains, tokens, tags) -> probabilities of tags, expected pairs; outside at both ends."""
    n = scores.shape[1]
    forward, backward = np.zeros_like(scores), np.zeros_like(scores)
    forward[:, 0] = transition[_OUT] + scores[:, 0]
    for i in range(1, n):
        forward[:, i] = _lse(forward[:, i - 1, :, None] + transition, 1) + scores[:, i]
    backward[:, -1] = transition[:, _OUT]
    for i in range(n - 2, -1, -1):
        backward[:, i] = _lse(transition + (scores[:, i + 1] + backward[:, i + 1])[:, None], 2)
    total = _lse(forward[:, -1] + backward[:, -1], 1)
    node = np.exp(forward + backward - total[:, None, None])
    edge = np.zeros((3, 3))
    for i in range(1, n):
        edge += np.exp(forward[:, i - 1, :, None] + transition + (scores[:, i] + backward[:, i])[:, None]
                       - total[:, None, None]).sum(axis=0)
    edge[_OUT] += node[:, 0].sum(axis=0)
    edge[:, _OUT] += node[:, -1].sum(axis=0)
    return node, edge


def tags_of(run: list[tuple[int, int]], spans: list[tuple[int, int, str]]) -> list[int]:
    tags, last = [], None
    for start, end in run:
        touched = next((s for s in spans if s[0] < end and start < s[1]), None)
        tags.append(_OUT if touched is None else 1 if touched is last else 0)
        last = touched
    return tags


def windows(text: str, size: int = WINDOW) -> list[list[tuple[int, int]]]:
    """All tokens of a text (start, end), in windows of neighbours."""
    spans = [m.span() for m in TOKEN.finditer(text)]
    return [spans[i:i + size] for i in range(0, len(spans), size)]


def sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_class: int = SAMPLE_DOCS,
           per_doc: int = WINDOWS_PER_DOC, seed: int = 5) -> Chains:
    """Chains of a bounded sample of documents, on the driver."""
    text = F.col(text_col)
    has = text.rlike(r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]|AKIA[A-Z0-9]{12}|[0-9a-f]{32}")
    odd = text.rlike(r"[0-9_]")
    kinds = docs.filter(text.isNotNull() & odd).select(F.col(id_col).alias("__id"), has.alias("__has"))
    counts = {r["__has"]: r.n for r in kinds.groupBy("__has").agg(F.count("*").alias("n")).collect()}
    share = F.when(has, per_class / max(1, counts.get(True, 0))).otherwise(per_class / max(1, counts.get(False, 0)))
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(1 << 30)) / float(1 << 30)

    def chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            # Features go to the driver as numbers; their names come once, with the batch's first chain.
            names: dict[str, int] = {}
            features, tags = [], []
            for t in batch.column(0).to_pylist():
                spans = base_spans(t)
                file = file_features(t, spans)
                odd = np.array([s for run in odd_runs(t) for s, _ in run])
                runs = windows(t)
                # Windows with secrets first, then those with other words than plain ones; each kind from all over the text.
                runs.sort(key=lambda r: (all(x == _OUT for x in tags_of(r, spans)),
                                         bool(np.searchsorted(odd, r[0][0]) == np.searchsorted(odd, r[-1][1])), (r[0][0] * 7919) % 10007))
                for run in runs[:per_doc]:
                    features.append([[names.setdefault(f, len(names)) for f in row + file] for row in run_features(t, run)])
                    tags.append(tags_of(run, spans))
            yield pa.RecordBatch.from_arrays(
                [pa.array(features, pa.list_(pa.list_(pa.int32()))), pa.array(tags, pa.list_(pa.int32())),
                 pa.array([[*names], *[None] * (len(features) - 1)][:len(features)], pa.list_(pa.string()))],
                names=["features", "tags", "names"])

    # Few rows are drawn: the patterns look at these alone.
    most = max(per_class / max(1, counts.get(has_base, 0)) for has_base in (True, False))
    chosen = docs.filter(text.isNotNull() & (draw < most) & odd & (draw < share)).select(text)
    rows = chosen.mapInArrow(chains, "features array<array<int>>, tags array<int>, names array<string>").toArrow()
    features, tags, names = (_whole(rows.column(c)) for c in ("features", "tags", "names"))
    del rows
    found = _named(features, tags, names)
    del features, tags, names
    pa.default_memory_pool().release_unused()
    return found


def _named(features: pa.Array, tags: pa.Array, names: pa.Array) -> Chains:
    """Chains whose features are places in the last ``names`` that came, of their own row or one before it."""
    at = features.flatten().flatten().to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(features.flatten()).to_numpy(zero_copy_only=False))])
    tokens = np.concatenate([[0], np.cumsum(pc.list_value_length(features).to_numpy(zero_copy_only=False))])
    firsts = np.flatnonzero(pc.is_valid(names).to_numpy(zero_copy_only=False))
    places: dict[str, int] = {}
    found = np.zeros(len(at), np.int32)
    for first, after in zip(firsts, [*firsts[1:], len(features)]):
        part = slice(ends[tokens[first]], ends[tokens[after]])
        found[part] = np.array([places.setdefault(f, len(places)) for f in names[first].as_py()], np.int32)[at[part]]
    return Chains.coded(features, found, [*places], tags)


def _whole(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def find_spans(text: str, field: Field | None) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans, and all spans."""
    base = base_spans(text)
    if field is None:
        return base, base
    added: list[tuple[int, int, str]] = []
    for spans in secret_runs(text, field, field._sum(file_features(text, base))):
        added += [(s, e, "crf") for s, e in spans]
    if base and added:
        added = _apart(added, base)
    return base, sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2])))


def secret_runs(text: str, field: Field, file: np.ndarray) -> Iterator[list[list[int]]]:
    """Spans of the best path over all tokens, run by run of tokens that are not surely outside."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # scores, starts and ends of a run that goes on

    def ended() -> list[list[int]]:
        tags, spans, at = field.decode_blocks(scores for scores, _, _ in held), [], 0
        if any(t != _OUT for t in tags):
            for _, starts, ends in held:
                for s, e, tag in zip(starts.tolist(), ends.tolist(), tags[at:at + len(starts)]):
                    if tag == 0:
                        spans.append([s, e])
                    elif tag == 1 and spans:
                        spans[-1][1] = e
                at += len(starts)
        held.clear()
        return spans

    before, gap = None, ""
    for offset, parts in lots(text):
        tokens = parts[1::2]
        parts[0], into = gap + parts[0], len(gap)
        gap = parts[-1]
        if not tokens:
            continue
        offset -= into
        until = offset + sum(map(len, parts))
        after = TOKEN.search(text, until, min(len(text), until + 64))
        scores = field.token_scores(tokens, [_SIGNS[g] for g in parts[0:-1:2]], before, after[0] if after else None, file)
        before = tokens[-1]
        settled = field.sure(scores)
        places = np.flatnonzero(~settled)
        if held and settled[0]:
            yield ended()
        stops = offset + np.cumsum(list(map(len, parts)))
        starts, ends = stops[0:-1:2], stops[1::2]
        for run in np.split(places, np.flatnonzero(np.diff(places) > 1) + 1):
            if held and run[0]:
                yield ended()
            for i in range(run[0], run[-1] + 1, BLOCK_TOKENS):
                part = slice(i, min(i + BLOCK_TOKENS, run[-1] + 1))
                held.append((scores[part], starts[part], ends[part]))
    if held:
        yield ended()


def _apart(added: list[tuple[int, int, str]], base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Spans that touch none of the base spans (both in order of their start)."""
    reach, kept, i = -1, [], 0
    starts = [b[0] for b in base]
    for span in added:
        while i < len(base) and starts[i] < span[1]:
            reach = max(reach, base[i][1])
            i += 1
        if reach <= span[0]:
            kept.append(span)
    return kept


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, for each row of ``docs``."""
    parts = None if field is None else (field.names, field.emission, field.transition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None if parts is None else Field(*parts)
        for batch in slices(batches):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                base, spans = find_spans(text or "", own)
                n = [sum(s[2] == kind for s in base) for kind in KINDS[:3]]
                rows.append((doc_id, *n, hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 4 + [pa.string()] * 2)],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(docs: DataFrame, field: Field | None, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced (overlapping spans by one mark); null texts stay null."""
    names = docs.columns
    at = names.index(text_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    parts = None if field is None else (field.names, field.emission, field.transition)

    def clean(text: str | None, own: Field | None) -> str | None:
        if not text:
            return text
        out, done = [], 0
        for start, end, _ in find_spans(text, own)[1]:
            if end <= done:
                continue
            if start >= done:
                out += [text[done:start], mark]
            done = end
        return "".join(out) + text[done:] if out else text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None if parts is None else Field(*parts)
        for batch in slices(batches):
            columns = list(batch.columns)
            columns[at] = pa.array([clean(t, own) for t in columns[at].to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, schema)


def fitted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", trained_on: Column | None = None) -> Field | None:
    return train(sample(docs if trained_on is None else docs.filter(trained_on), id_col, text_col))
