"""BPE with word ends as a streaming transducer, and its incremental decoder.

Encoding. A token sequence is the encoding of its text exactly if every token encodes
to itself and every two neighbours encode to themselves (later merges never reach
across a boundary that holds for its two sides). So the encoding of each prefix is that
of a shorter prefix plus one token that fits behind that prefix's last token, and the
encoding of the whole goes through one of the last ``lookahead`` boundaries, where
``lookahead`` is the longest token of the merge list. The transducer keeps a state for each
of these boundaries; tokens on which all of them agree are stable and are emitted. The
last symbol of a word carries the word end, so one symbol is held back. Memory is
bounded by the lookahead, not by the word. The states behind the first letters of a word are kept for the
next word that begins so. Every piece of a text goes through the transducer;
pieces and words seen before come from tables of bounded size.

A text is normalised (NFC, white space to one space, lower case letter by letter) and
split in chunks that end where neither can reach across, so no copy of a very long text
is made; only a run without white space longer than a chunk is normalised as one, and its pieces and
ids are then made and hashed in lots. Special tokens are found in the raw text, as the library does.

Decoding. The file names no decoder, so the library joins the tokens' strings with a
space. The state machine takes the ids of a document in order and does so token by token; its
state is whether text has begun.

Defined results: a null text is empty and has no ids; repeated rows are encoded each; an empty table gives
an empty result; other columns stay out.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept_in_worker, slices

CHUNK = 1 << 16
#: Words and pieces kept with their ids in a task: a full table becomes the older one, words met again move to the newer.
KEPT_WORDS = 500_000
_UNREACHED = -2
_START = -1


def byte_letters() -> list[str]:
    """The letter for each byte: printable bytes stand for themselves, others follow from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, extra = [], 256
    for byte in range(256):
        letters.append(chr(byte) if byte in own else chr(extra))
        extra += byte not in own
    return letters


class Merges:
    """The merge list: ids, ranks, and which tokens may stand beside each other."""

    def __init__(self, source: str | dict):
        spec = json.loads(source) if isinstance(source, str) else source
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.strings = {i: s for s, i in self.ids.items()}
        self.end = model["end_of_word_suffix"] or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings |= {i: s for s, i in self.special.items()}
        self.letters = byte_letters()
        # Sufficient lookahead: no token spans more symbols than this.
        self.symbols = {token: self._symbols(token) for token in self.ids}
        made = {a + b for a, b in pairs}
        self.lookahead = max([1, *(len(self.symbols[t]) for t in made if t in self.symbols)])
        self.tokens = {i: s for s, i in self.ids.items()}
        # How long the tokens are that end with three given symbols, the longest first.
        lengths: dict[str, set[int]] = {}
        for symbols in self.symbols.values():
            if len(symbols) >= 3:
                lengths.setdefault("".join(symbols[-3:]), {1, 2}).add(len(symbols))
        self.lengths = {last: tuple(sorted(found, reverse=True)) for last, found in lengths.items()}
        # How each token is made (its first rule is the one that works), and when.
        self.parts: dict[str, tuple[str, str]] = {}
        self.made: dict[str, int] = {}
        for rank, (a, b) in enumerate(pairs):
            if a + b not in self.parts:
                self.parts[a + b], self.made[a + b] = (a, b), rank
        self._alone: dict[str, bool] = {}
        self._whole: dict[int, bool] = {}
        self._beside: dict[tuple[int, int], bool] = {}

    def _symbols(self, token: str) -> list[str]:
        if self.end and token.endswith(self.end) and token != self.end:
            body = token[: -len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    def alone(self, token: str) -> bool:
        """Whether the token is the encoding of its own text."""
        if (known := self._alone.get(token)) is None:
            ranks, symbols = self.ranks, list(self.symbols[token])
            while len(symbols) > 1:
                rank, at = min((ranks.get(pair, 1 << 60), i) for i, pair in enumerate(zip(symbols, symbols[1:])))
                if rank == 1 << 60:
                    break
                symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
            known = self._alone[token] = symbols == [token]
        return known

    def beside(self, left: str, right: str) -> bool:
        """Whether no merge ever crosses the boundary between two tokens.

        Back in time: the pieces at the boundary as they were before each merge, the
        latest merge first; a rule for the two pieces must not come before the merge that
        took one of them away (of equal rules the one further left comes first).
        """
        made, never = self.made, 1 << 60
        x, y = left, right
        x_goes = y_goes = never
        while True:
            rank = self.ranks.get((x, y))
            if rank is not None and rank < x_goes and rank <= y_goes:
                return False
            x_made, y_made = made.get(x, -1), made.get(y, -1)
            if x_made < 0 and y_made < 0:
                return True
            if x_made > y_made:
                x, x_goes = self.parts[x][1], x_made
            else:
                y, y_goes = self.parts[y][0], y_made

    def whole(self, token: int) -> bool:
        """``alone`` of an id, kept."""
        known = self._whole[token] = self.alone(self.tokens[token])
        return known

    def fits(self, left: int, right: int) -> bool:
        """``beside`` of two ids, kept in a table of bounded size."""
        if len(self._beside) >= 1 << 18:
            self._beside.clear()
        known = self._beside[left, right] = self.beside(self.tokens[left], self.tokens[right])
        return known


class Transducer:
    """Symbols of one word in, stable token ids out."""

    #: The states behind so many first letters of a word are kept, for so many beginnings.
    BEGINNING, BEGINNINGS = 5, 1 << 16

    def __init__(self, merges: Merges):
        self.merges = merges
        self.begun: dict[str, tuple] = {}
        self.reset()

    def reset(self) -> None:
        self.held: str | None = None
        self.tail = ""  # the last letters, at most `lookahead`
        # For each of the last boundaries: the id of the last token and the boundary it starts at.
        self.states: list[tuple[int | None, int]] = [(None, _START)]
        self.first = 0  # boundary of states[0]
        self.sent = 0  # boundary up to which tokens are emitted

    def _advance(self, letters: str, end: str = "") -> None:
        """States behind the boundaries after these letters; ``end`` goes with a last single letter."""
        m, states, tail = self.merges, self.states, self.tail
        ids, lengths, fits, whole = m.ids, m.lengths, m._beside, m._whole
        n = self.first + len(states)
        for letter in letters:
            tail += letter
            for back in lengths.get(tail[-3:] + end, (2, 1)):
                if back > len(states) or (token := ids.get(tail[-back:] + end)) is None:
                    continue
                left, reached = states[-back]
                if reached != _UNREACHED:
                    if left is not None and not (m.fits(left, token) if (f := fits.get((left, token))) is None else f):
                        continue
                    if m.whole(token) if (w := whole.get(token)) is None else w:
                        states.append((token, n - back))
                        break
            else:
                states.append((None, _UNREACHED))
            n += 1
        self.tail = tail[-m.lookahead:]

    def word(self, letters: str) -> list[int]:
        """A word at once. One that the lookahead covers begins with the states that its first letters had before."""
        if not self.BEGINNING < len(letters) <= self.merges.lookahead:
            return [*self.feed(letters), *self.finish()]
        start = letters[:self.BEGINNING]
        known = self.begun.get(start)
        if known is None:
            self._advance(start)
            if len(self.begun) >= self.BEGINNINGS:
                self.begun.clear()
            self.begun[start] = tuple(self.states)
        else:
            self.states, self.tail = [*known], start
        self._advance(letters[self.BEGINNING:-1])
        self.held = letters[-1]
        return self.finish()

    def _emit(self) -> Iterator[int]:
        """Tokens on which every live boundary agrees."""
        newest = self.first + len(self.states) - 1
        ends = [b for b in range(max(self.sent, newest - self.merges.lookahead + 1), newest + 1)
                if self.states[b - self.first][1] != _UNREACHED]
        while len({*ends}) > 1:  # to the common ancestor: the latest goes a token back
            latest = max(ends)
            ends = [self.states[latest - self.first][1] if b == latest else b for b in ends]
        path, at = [], ends[0]
        while at > self.sent:
            token, start = self.states[at - self.first]
            path.append(token)
            at = start
        self.sent = max(self.sent, ends[0])
        yield from reversed(path)
        # Nothing before the last stable boundary is asked for again.
        if self.sent - self.first > 4 * self.merges.lookahead:
            del self.states[: self.sent - self.first]
            self.first = self.sent

    def feed(self, letters: str) -> Iterator[int]:
        """More letters of the word; the last one is held back."""
        letters, size = (self.held or "") + letters, self.merges.lookahead
        for start in range(0, len(letters) - 1, size):
            part = letters[start:min(start + size, len(letters) - 1)]
            self._advance(part)
            if len(part) == size:
                yield from self._emit()
        self.held = letters[-1:] or None

    def finish(self) -> list[int]:
        """The end of the word: the held symbol takes the word end."""
        if self.held is None:
            return []
        self._advance(self.held, self.merges.end)
        out, at = [], self.first + len(self.states) - 1
        while at > self.sent:
            token, at = self.states[at - self.first]
            out.append(token)
        out.reverse()
        self.reset()
        return out


#: Words of the tokenizer file, without its apostrophe cases in the middle: fixed values.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: The same for lower-case ASCII.
ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
_SPACE = regex.compile(r"\s+")
_SEPARATORS = re.compile("[\x1c-\x1f]")


def normalise(text: str) -> str:
    """NFC, white space to one space, lower case letter by letter (no final sigma)."""
    text = _SPACE.sub(" ", unicodedata.normalize("NFC", text))
    return text.replace("Σ", "σ").lower()


def chunks(text: str, size: int = CHUNK) -> Iterator[str]:
    """Parts that end behind white space, where neither words nor NFC reach across.

    A run without white space stays one part, at most the text itself.
    """
    start = 0
    while len(text) - start > size:
        cut = _SPACE.search(text, start + size)
        if not cut:
            break
        yield text[start:cut.end()]
        start = cut.end()
    yield text[start:]


#: Ids, and the same as text.
Entry = tuple[tuple[int, ...], str]


def _entry(ids: Iterable[int]) -> Entry:
    ids = tuple(ids)
    return ids, " ".join(map(str, ids))


class Encoder:
    """Texts to ids, with a bounded table of words seen before."""

    LONGEST_KEPT = 64

    def __init__(self, merges: Merges, kept: int = KEPT_WORDS):
        self.merges, self.kept, self.words, self.pieces = merges, kept, {}, {}
        self.older_words, self.older_pieces = {}, {}
        self.transducer, self.letters = Transducer(merges), merges.letters
        marks = sorted(merges.special, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None

    def symbols(self, piece: str) -> str:
        """The letters of a piece's bytes."""
        return "".join(map(self.letters.__getitem__, piece.encode("utf-8", "surrogatepass")))

    def piece(self, piece: str) -> Iterator[int]:
        """Ids of a piece that the split has made."""
        yield from self.transducer.feed(self.symbols(piece))
        yield from self.transducer.finish()

    def entry(self, piece: str) -> Entry:
        """Ids of a piece. An ASCII piece is also the word that it spells and stands in the words' table, once."""
        plain = piece.isascii()
        known = (self.words if plain else self.pieces).get(piece)
        if known is None:
            known = (self.older_words if plain else self.older_pieces).get(piece)
            if known is None:
                known = _entry(self.transducer.word(self.symbols(piece)))
            self._keep(piece, known, plain)
        return known

    def word(self, word: str) -> Entry:
        """Ids of a run without white space."""
        if (entry := self.older_words.get(word)) is not None:
            return self._keep(word, entry)
        if word.isascii():
            plain = word.lower()
            pieces = [plain] if plain.isalpha() else ASCII_PIECES.findall(plain)
            if len(pieces) == 1 and plain == word:
                return self.entry(word)
        else:
            plain = normalise(word)
            pieces = [plain] if plain.isalpha() else PIECES.findall(plain)
        if len(pieces) == 1:
            entry = self.entry(pieces[0])
        else:
            entry = _entry(i for piece in pieces for i in self.entry(piece)[0])
        return self._keep(word, entry)

    def long_word(self, word: str) -> Iterator[list[Entry]]:
        """The same for a very long run, a lot of ids after the other."""
        ids = (i for m in PIECES.finditer(normalise(word))
               for i in (self.entry(m[0])[0] if len(m[0]) <= CHUNK else self.piece(m[0])))
        while lot := tuple(islice(ids, CHUNK)):
            yield [_entry(lot)]

    def _keep(self, word: str, entry: Entry, as_word: bool = True) -> Entry:
        if len(word) <= self.LONGEST_KEPT:
            if as_word:
                if len(self.words) >= self.kept:
                    self.older_words, self.words = self.words, {}
                self.words[word] = entry
            else:
                if len(self.pieces) >= self.kept // 2:
                    self.older_pieces, self.pieces = self.pieces, {}
                self.pieces[word] = entry
        return entry

    def encode(self, text: str) -> Iterator[list[Entry]]:
        """Ids of the words of a text, a list for each chunk."""
        marked = self.marks and any(mark in text for mark in self.merges.special)
        word = self.word
        for part in self.marks.split(text) if marked else [text]:
            if part in self.merges.special:
                i = self.merges.special[part]
                yield [((i,), str(i))]
                continue
            for chunk in chunks(part):
                # split() also takes the separators 1C to 1F for white space, the tokenizer does not.
                words = _SPACE.split(chunk) if _SEPARATORS.search(chunk) else chunk.split()
                if len(words) <= 2 and len(chunk) > 2 * CHUNK:
                    for w in words:
                        yield from self.long_word(w)
                    continue
                known = self.words
                yield [entry for w in words if (entry := known.get(w) or word(w))[0]]

    def ids(self, text: str) -> list[int]:
        return [i for entries in self.encode(text) for ids, _ in entries for i in ids]


class Decoder:
    """Ids in, text out, piece by piece."""

    def __init__(self, merges: Merges):
        self.strings, self.begun = merges.strings, False

    def feed(self, ids: Iterable[int]) -> str:
        """The text that these ids add; ids the vocabulary lacks add none."""
        text = self.run(ids)
        lead = " " if self.begun and text else ""
        self.begun = self.begun or bool(text)
        return lead + text

    def run(self, ids: Iterable[int]) -> str:
        """The text of ids that stand alone."""
        ids = ids if isinstance(ids, list | tuple) else [*ids]
        try:
            return " ".join(map(self.strings.__getitem__, ids))
        except KeyError:
            return " ".join([s for s in map(self.strings.get, ids) if s is not None])


def _digest(encoder: Encoder, text: str, with_ids: bool) -> tuple:
    """Number of ids and the digests of ids and decoded text, a chunk of the text at a time."""
    n, ids_hash, text_hash, all_ids, lead = 0, hashlib.sha256(), hashlib.sha256(), [], ""
    decoder = Decoder(encoder.merges)
    for entries in encoder.encode(text):
        if not entries:
            continue
        ids = [*chain.from_iterable([entry[0] for entry in entries])]
        n += len(ids)
        ids_hash.update((lead + " ".join([entry[1] for entry in entries])).encode())
        text_hash.update(decoder.feed(ids).encode())
        lead = " "
        if with_ids:
            all_ids += ids
    return (n, ids_hash.hexdigest(), text_hash.hexdigest(), *([all_ids] if with_ids else []))


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = False, kept: int = KEPT_WORDS) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids), a row for each row of ``docs``.

    ``kept``: how many words a worker's table holds; fewer take less memory and more time.
    ``vocabulary``: the tokenizer file's content. It goes to the workers once, as a broadcast
    of a fixed size (1.7 MB). A worker keeps its tables for its next tasks.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32())]
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: 4 + with_ids]
    key = hashlib.sha256(vocabulary.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_in_worker(f"bpe-{key}-{kept}", lambda: Encoder(Merges(shared.value), kept))
        for batch in slices(batches, 64):
            rows = [(doc_id, *_digest(encoder, text or "", with_ids))
                    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), types)], names=names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).alias("text")).mapInArrow(run, schema)


def vocabulary(path: str | None = None) -> str:
    """The content of a tokenizer file; by default the public one this library is tested with."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as file:
        return file.read()
