"""Token counts by whole-token shortcut.

Offline, once for a vocabulary: every vocabulary string that ends a word is taken apart into its symbols and put
through the merge list. Those that come back as one token are *proved*: a pre-token with that spelling is one token
in every text, because merges never reach across pre-tokens. All other strings (a better merge takes one of their
symbols away, or none makes them) stay unproved.

In the texts, a pre-token that is proved counts one without any merging; only the rest run through the merge list,
with a heap over the pairs of a linked list, so a piece of n symbols takes n log n steps. Their counts are kept in a
table of bounded size.

A text is read in chunks that end where neither a word nor NFC reaches across, so no copy of a very long text is
made; a run without white space is one chunk, at most the text itself. Special strings in the raw text are one token
each, as the library takes them.

Defined results: a null text is empty: 0 bytes, 0 tokens. Every row of the input gives one row, also where ids repeat or
are null; an empty table gives none. Input columns are carried under the names asked for, others stay out.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import PIECES, byte_letters, chunks, normalise, vocabulary
from .common import fresh, kept_in_worker, slices

#: Tokens of a document beyond which it does not fit a context window.
LIMIT = 2048
#: Unproved pre-tokens whose counts a task keeps, and the longest of them; the table is emptied when it is full.
KEPT_PIECES, LONGEST_KEPT = 200_000, 64

#: Pre-tokens of lower-case ASCII: the tokenizer's pattern (fixed values), white space spelled out.
_ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9\t-\r ]+")

__all__ = ["LIMIT", "MergeList", "Counter", "count_tokens", "proved_strings", "vocabulary"]


class MergeList:
    """The ranks of a tokenizer file and the symbols that words begin as."""

    def __init__(self, ranks: dict[tuple[str, str], int], end: str):
        self.ranks, self.end, self.letters = ranks, end, byte_letters()

    @classmethod
    def read(cls, source: str) -> tuple["MergeList", dict[str, int], list[str]]:
        """The merge list, the vocabulary and the special strings of a file's content."""
        spec = json.loads(source)
        model = spec["model"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        merges = cls({pair: rank for rank, pair in enumerate(pairs)}, model["end_of_word_suffix"] or "")
        missing = [c for c in merges.letters if c not in model["vocab"] or c + merges.end not in model["vocab"]]
        if missing:
            raise ValueError(f"the vocabulary lacks {len(missing)} single bytes: it drops text, so it cannot be counted")
        return merges, model["vocab"], [t["content"] for t in spec["added_tokens"]]

    def symbols(self, piece: str) -> list[str]:
        """One symbol for each byte of a pre-token; the last carries the word end."""
        found = [self.letters[b] for b in piece.encode("utf-8", "surrogatepass")]
        if found:
            found[-1] += self.end
        return found

    def merge(self, symbols: list[str]) -> list[str]:
        """The symbols after all merges, lowest rank first, of equal ranks the one further left."""
        n, ranks = len(symbols), self.ranks
        if n < 2:
            return symbols
        left, right, part = list(range(-1, n - 1)), [*range(1, n), -1], list(symbols)
        heap = [(rank, i, pair) for i, pair in enumerate(zip(symbols, symbols[1:]))
                if (rank := ranks.get(pair)) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, (a, b) = heapq.heappop(heap)
            j = right[i] if part[i] else -1
            if j < 0 or part[i] != a or part[j] != b:  # one of the two has gone into another merge
                continue
            part[i], part[j] = a + b, ""
            right[i] = after = right[j]
            if after >= 0:
                left[after] = i
                if (rank := ranks.get((part[i], part[after]))) is not None:
                    heapq.heappush(heap, (rank, i, (part[i], part[after])))
            if (before := left[i]) >= 0 and (rank := ranks.get((part[before], part[i]))) is not None:
                heapq.heappush(heap, (rank, before, (part[before], part[i])))
        return [p for p in part if p]


def proved_strings(merges: MergeList, vocab: dict[str, int]) -> list[str]:
    """Pre-tokens that are vocabulary strings and provably encode alone as that one token, sorted.

    At most as many as the vocabulary has entries.
    """
    byte = {letter: b for b, letter in enumerate(merges.letters)}
    found = []
    for token in vocab:
        body = token[: len(token) - len(merges.end)] if merges.end else token
        if not token.endswith(merges.end) or not body or not all(c in byte for c in body):
            continue
        if merges.merge([*body[:-1], body[-1] + merges.end]) != [token]:
            continue
        try:
            found.append(bytes(byte[c] for c in body).decode("utf-8"))
        except UnicodeDecodeError:  # a part of a character: no pre-token is spelled like that
            continue
    return sorted(found)


class Shortcut:
    """Counts pre-tokens: the proved ones directly, the others by merging."""

    def __init__(self, merges: MergeList, proved: frozenset[str], special: list[str], kept: int = KEPT_PIECES):
        self.merges, self.proved, self.special, self.kept = merges, proved, special, kept
        self.known: dict[str, int] = {}
        marks = sorted(special, key=len, reverse=True)
        self.marks = regex.compile("|".join(map(regex.escape, marks))) if marks else None

    def merged(self, piece: str) -> int:
        n = self.known.get(piece)
        if n is None:
            n = len(self.merges.merge(self.merges.symbols(piece)))
            if len(piece) <= LONGEST_KEPT:
                if len(self.known) >= self.kept:
                    self.known.clear()
                self.known[piece] = n
        return n

    def pieces(self, part: str) -> Iterator[list[str]]:
        """Pre-tokens of a text without special strings, a list for each chunk."""
        for chunk in chunks(part):
            yield _ASCII_PIECES.findall(chunk.lower()) if chunk.isascii() else PIECES.findall(normalise(chunk))

    def count(self, text: str) -> tuple[int, int, int]:
        """Tokens, pre-tokens, and how many of these the shortcut counted."""
        tokens = found = whole = 0
        proved, known = self.proved, self.known
        parts = [text]
        if self.marks and any(mark in text for mark in self.special):
            parts, tokens = self.marks.split(text), len(self.marks.findall(text))
        for part in parts:
            for pieces in self.pieces(part):
                found += len(pieces)
                for piece, n in Counter(pieces).items():
                    if piece in proved:
                        whole += n
                    else:
                        tokens += n * (known.get(piece) or self.merged(piece))
        return tokens + whole, found, whole


def count_tokens(docs: DataFrame, source: str, keep: tuple[Column, ...], text: Column | str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """The ``keep`` columns, then n_bytes, n_tokens, over_limit, n_pretokens, n_whole, a row for each row of ``docs``.

    ``source``: the tokenizer file's content. The proof runs here, once; its strings (at most the vocabulary) and the
    merge list go to the workers in one broadcast, whose size is the file's, whatever ``docs`` holds.
    """
    merges, vocab, special = MergeList.read(source)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((merges.ranks, merges.end, proved_strings(merges, vocab), special))
    key = "tokencount-" + hashlib.sha256(source.encode()).hexdigest()
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    rows = docs.select(*keep, text.alias("text"))
    (body,) = fresh(docs.select(*keep), "text")
    rows = rows.toDF(*rows.columns[:-1], body)
    kept = rows.columns[:-1]
    counted = rows.select(*[F.col(f"`{c}`") for c in kept], F.octet_length(F.col(f"`{body}`")).cast("long").alias("n_bytes"),
                          F.col(f"`{body}`"))
    schema = counted.drop(body).schema.add("n_tokens", "long", False).add("n_pretokens", "long", False).add(
        "n_whole", "long", False)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def make() -> Shortcut:
            ranks, end, proved, marks = shared.value
            return Shortcut(MergeList(ranks, end), frozenset(proved), marks)

        shortcut = kept_in_worker(key, make)
        for batch in slices(batches, 64):
            last = batch.num_columns - 1
            found = [shortcut.count(t.as_py() or "") for t in batch.column(last)]
            columns = [*batch.columns[:last], *[pa.array(c, type=pa.int64()) for c in zip(*found)]]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    found = counted.mapInArrow(run, schema)
    n = F.col("n_tokens")
    return found.select(*[F.col(f"`{c}`") for c in kept], "n_bytes", "n_tokens", (n > limit).alias("over_limit"),
                        "n_pretokens", "n_whole")
