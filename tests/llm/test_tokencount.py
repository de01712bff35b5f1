"""Token counts against the tokenizers library."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from veristar.llm import tokencount as T
from veristar.llm.common import table
from veristar.llm.queries import QUERIES

from .test_queries import SF_DIR


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def parts():
    merges, vocab, special = T.MergeList.read(T.vocabulary())
    return merges, vocab, special, T.proved_strings(merges, vocab)


def _count(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


def test_proved_strings_are_one_token_and_others_are_merged(library, parts):
    merges, vocab, special, proved = parts
    assert 10_000 < len(proved) <= len(vocab)
    rng = random.Random(5)
    for word in rng.sample(proved, 500):
        # As pre-tokens: an upper-case or composed spelling never reaches the table.
        assert merges.merge(merges.symbols(word)) == ["".join(merges.symbols(word))]
        if word.isascii() and word.isalpha() and word.islower():
            assert _count(library, word) == 1


def test_merges_equal_quadratic_merging(parts):
    merges = parts[0]
    rng = random.Random(2)
    for _ in range(300):
        symbols = merges.symbols("".join(rng.choice("aabnetshioélin") for _ in range(rng.randint(1, 25))))
        slow = list(symbols)
        while len(slow) > 1:
            rank, at = min((merges.ranks.get(p, 1 << 60), i) for i, p in enumerate(zip(slow, slow[1:])))
            if rank == 1 << 60:
                break
            slow[at:at + 2] = [slow[at] + slow[at + 1]]
        assert merges.merge(symbols) == slow


def test_counts_equal_the_library_on_odd_texts(library, parts):
    merges, _, special, proved = parts
    shortcut = T.Shortcut(merges, frozenset(proved), special, kept=50)
    alphabet = ["a", "B", "é", "é", "Σ", "ς", "İ", "ß", " ", "\n", " ", " ", "\x1c", "\x1f", "\x85", "'s",
                "'LL", "don't", "中", "1", "٣", "½", "😀", "<|endoftext|>", "<|startoftext|>", "</w>", "the", "The", "_",
                "́", "ᄀ", "ᅡ", "ﬁ", "'", "t", "\x00", "힣", "‍", "Å"]
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14)))
        assert shortcut.count(text)[0] == _count(library, text), repr(text)
    assert shortcut.count("") == (0, 0, 0)
    tokens, found, whole = shortcut.count("the the zqxzqx")
    assert (found, whole) == (3, 2) and tokens == 2 + _count(library, "zqxzqx")


def test_very_long_texts(library, parts):
    merges, _, special, proved = parts
    shortcut = T.Shortcut(merges, frozenset(proved), special)
    for text in ("ab" * 60_000, "the cat " * 30_000, "é" * 50_000, "!" * 70_000 + " x"):
        assert shortcut.count(text)[0] == _count(library, text)


def test_query_equals_the_library(spark, library):
    want = {r.doc_id: (len((r.text or "").encode()), _count(library, r.text or ""))
            for r in table(spark, SF_DIR, "documents").collect()}
    got = QUERIES["op13_token_counts"](spark, SF_DIR).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in got} == want and len(got) == len(want)
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got)


def test_nulls_repeats_clashes_and_empty_tables(spark):
    rows = [(1, None, 7, "x"), (1, "the cat", 8, "y"), (1, "the cat", 8, "y"), (None, "", None, None), (2, "a" * 5000, 1, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, Text_ string")
    source = T.vocabulary()
    got = T.count_tokens(docs, source, keep=(F.col("doc_id"), F.col("n_tokens").alias("old"), F.col("text").alias("kept")))
    found = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens, r.kept or "") for r in got.collect())
    assert [f[:4] for f in found] == [(False, 1, 0, 0), (False, 1, 7, 2), (False, 1, 7, 2), (False, 2, 5000, found[3][3]),
                                      (True, 0, 0, 0)]
    empty = T.count_tokens(docs.limit(0), source, keep=(F.col("doc_id"),))
    assert empty.collect() == []
    assert empty.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit", "n_pretokens", "n_whole"]


def test_a_vocabulary_without_single_bytes_is_refused():
    source = '{"model": {"vocab": {"a": 0}, "merges": [], "end_of_word_suffix": "</w>"}, "added_tokens": []}'
    with pytest.raises(ValueError, match="single bytes"):
        T.MergeList.read(source)
