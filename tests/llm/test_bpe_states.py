"""States kept behind the first letters of words."""

import random

import pytest

from veristar.llm import bpe

rng = random.Random(33)


def _merged(merges, word):
    symbols = [*word[:-1], word[-1] + merges.end]
    while len(symbols) > 1:
        rank, at = min((merges.ranks.get(pair, 1 << 60), i) for i, pair in enumerate(zip(symbols, symbols[1:])))
        if rank == 1 << 60:
            break
        symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
    return [merges.ids[s] for s in symbols]


def test_words_that_begin_alike_share_states(monkeypatch):
    encoder = bpe.Encoder(bpe.Merges(bpe.vocabulary()))
    calls = []
    advance = bpe.Transducer._advance
    monkeypatch.setattr(bpe.Transducer, "_advance", lambda self, *a: (calls.extend(a[0]), advance(self, *a))[1])
    assert encoder.ids("internally") == _merged(encoder.merges, "internally")
    assert len(calls) == 10
    assert encoder.ids("internment") == _merged(encoder.merges, "internment")
    assert len(calls) == 20 - bpe.Transducer.BEGINNING


@pytest.mark.parametrize("kept", [1 << 16, 3])
def test_words_of_all_lengths_by_kept_states(monkeypatch, kept):
    monkeypatch.setattr(bpe.Transducer, "BEGINNINGS", kept)
    merges = bpe.Merges(bpe.vocabulary())
    t = bpe.Transducer(merges)
    for _ in range(1500):
        word = "".join(rng.choice(("the", "in", "g", "tion", "a", "e", "x", "un")) for _ in range(rng.randrange(1, 18)))
        assert t.word(word) == _merged(merges, word)
    assert len(t.begun) <= kept
