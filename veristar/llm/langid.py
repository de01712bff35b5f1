"""Language of a text by a convolutional network over its bytes.

The network: an embedding of the 256 bytes, filters of several widths, the largest
response of each filter in a window, and a softmax over the languages. It is trained in
numpy on the driver with windows of a bounded, documented sample of labelled documents:
per language at most ``DOCS_PER_LANGUAGE`` documents, those of the smallest hash of the id,
``WINDOWS_PER_DOCUMENT`` windows each, and the ``MAX_LANGUAGES`` most frequent languages. It
is applied to the whole of every text, in fixed windows of ``WINDOW`` bytes; a text's score
for a language is the mean over its windows, by the bytes in them.

Defined results: null, empty and letterless texts are ``und`` with score 0; so is every text if
no labelled document can be learned from; ties go to the language first in code-point
order; repeated rows are scored each; other columns stay out of the prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices

WINDOW = 252
MAX_LANGUAGES = 256
DOCS_PER_LANGUAGE = 800
WINDOWS_PER_DOCUMENT = 2
WIDTHS = (2, 3, 4, 5)
FILTERS = 8
DEPTH = 6
EPOCHS = 8
UNKNOWN = "und"
_PAD = 256


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray  # (257, DEPTH); the last row stands for padding and is zero
    kernel: np.ndarray  # (max width * DEPTH, filters)
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray
    mask: np.ndarray  # 0 where a filter is narrower than the widest

    def columns(self, x: np.ndarray) -> np.ndarray:
        """The bytes seen from each place, embedded: (n, WINDOW + widest - 1) -> (n, WINDOW, ...)."""
        widest = max(WIDTHS)
        e = self.embedding[x]
        view = np.lib.stride_tricks.sliding_window_view(e, widest, axis=1)  # n, WINDOW, DEPTH, widest
        return view.transpose(0, 1, 3, 2).reshape(len(x), WINDOW, -1)

    def pooled(self, x: np.ndarray) -> np.ndarray:
        seen = self.columns(x)
        out = seen.reshape(-1, seen.shape[2]) @ self.kernel
        return np.maximum(out.reshape(len(x), WINDOW, -1).max(axis=1) + self.bias, 0)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return softmax(self.pooled(x) @ self.dense + self.dense_bias)


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def windows(data: bytes) -> np.ndarray:
    """All windows of a text, each with the first bytes of the next one."""
    over = max(WIDTHS) - 1
    n = max(1, -(-len(data) // WINDOW))
    flat = np.full(n * WINDOW + over, _PAD, dtype=np.int16)
    flat[:len(data)] = np.frombuffer(data, dtype=np.uint8)
    return np.lib.stride_tricks.as_strided(flat, (n, WINDOW + over), (WINDOW * 2, 2))


def train(rows: list[tuple[str, bytes]], seed: int = 7, epochs: int = EPOCHS) -> Network | None:
    """rows: (language, at most a window of bytes)."""
    rows = [(lang, data) for lang, data in rows if data]
    if not rows:
        return None
    rng = np.random.default_rng(seed)
    languages = sorted({lang for lang, _ in rows})
    at = {lang: i for i, lang in enumerate(languages)}
    y = np.array([at[lang] for lang, _ in rows])
    x = np.concatenate([windows(data[:WINDOW]) for _, data in rows])
    widest, filters = max(WIDTHS), FILTERS * len(WIDTHS)
    mask = np.zeros((widest, DEPTH, filters), dtype=np.float32)
    for i, width in enumerate(WIDTHS):
        mask[:width, :, i * FILTERS:(i + 1) * FILTERS] = 1
    mask = mask.reshape(widest * DEPTH, filters)
    draw = lambda *shape: rng.normal(0, 1, shape).astype(np.float32)
    net = Network(languages, draw(257, DEPTH) * 0.5, draw(widest * DEPTH, filters) * 0.3 * mask,
                  np.zeros(filters, np.float32), draw(filters, len(languages)) * 0.1,
                  np.zeros(len(languages), np.float32), mask)
    net.embedding[_PAD] = 0
    names = ["embedding", "kernel", "bias", "dense", "dense_bias"]
    first = {n: np.zeros_like(getattr(net, n)) for n in names}
    second = {n: np.zeros_like(getattr(net, n)) for n in names}
    # Every language weighs the same, however rare.
    weight = (len(y) / (len(languages) * np.bincount(y, minlength=len(languages)))).astype(np.float32)
    step, size = 0, 64
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for start in range(0, len(order), size):
            step += 1
            gradient = _gradient(net, x[order[start:start + size]], y[order[start:start + size]], weight)
            for n in names:
                g = gradient[n]
                first[n] = 0.9 * first[n] + 0.1 * g
                second[n] = 0.999 * second[n] + 0.001 * g * g
                value = getattr(net, n)
                value -= (0.01 * (first[n] / (1 - 0.9 ** step))
                          / (np.sqrt(second[n] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
            net.kernel *= mask
            net.embedding[_PAD] = 0
    return net


def _gradient(net: Network, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    n = len(x)
    seen = net.columns(x)
    out = (seen.reshape(-1, seen.shape[2]) @ net.kernel).reshape(n, WINDOW, -1)
    place = out.argmax(axis=1)
    top = np.take_along_axis(out, place[:, None], axis=1)[:, 0] + net.bias
    hidden = np.maximum(top, 0)
    delta = softmax(hidden @ net.dense + net.dense_bias)
    delta[np.arange(n), y] -= 1
    delta *= weight[y][:, None] / n
    back = (delta @ net.dense.T) * (top > 0)
    # Only the place of the largest response gets a gradient.
    chosen = seen[np.arange(n)[:, None], place]  # n, filters, widest * DEPTH
    kernel = np.einsum("nfk,nf->kf", chosen, back)
    embedding = np.zeros_like(net.embedding)
    to_bytes = (back[:, :, None] * net.kernel.T[None]).reshape(n, -1, max(WIDTHS), DEPTH)
    for j in range(max(WIDTHS)):
        np.add.at(embedding, x[np.arange(n)[:, None], place + j], to_bytes[:, :, j])
    return {"embedding": embedding, "kernel": kernel, "bias": back.sum(axis=0),
            "dense": hidden.T @ delta, "dense_bias": delta.sum(axis=0)}


def sample(docs: DataFrame, trained_on: Column, id_col: str, text_col: str, label_col: str,
           docs_per_language: int = DOCS_PER_LANGUAGE, windows_per_doc: int = WINDOWS_PER_DOCUMENT,
           seed: int = 11) -> list[tuple[str, bytes]]:
    """Windows of a bounded sample of labelled documents, on the driver."""
    text, label = F.col(text_col), F.col(label_col)
    labelled = docs.filter(trained_on & label.isNotNull() & text.rlike(r"\p{L}"))
    counts = (labelled.groupBy(label.alias("l")).agg(F.count("*").alias("n"))
              .orderBy(F.col("n").desc(), "l").limit(MAX_LANGUAGES).collect())
    if not counts:
        return []
    share = F.lit(0.0)
    for r in counts:
        share = F.when(label == r.l, F.lit(min(1.0, docs_per_language / r.n))).otherwise(share)
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(1 << 30)) / float(1 << 30)
    length = F.char_length(text)
    picks = []
    for i in range(windows_per_doc):
        at = F.pmod(F.xxhash64(F.lit(seed + 1 + i), F.col(id_col)), F.greatest(length - WINDOW + 1, F.lit(1)))
        picks.append(F.substring(text, (at + 1).cast("int"), F.lit(WINDOW)))
    rows = labelled.filter(draw < share).select(label.alias("l"), F.explode(F.array(*picks)).alias("w")).collect()
    return sorted((r.l, r.w.encode("utf-8")[:WINDOW]) for r in rows)


def predict(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text",
            keep: tuple[Column, ...] = ()) -> DataFrame:
    """Columns ``keep``, then lang_pred and score, for each row of ``docs``."""
    text = F.when(F.col(text_col).rlike(r"\p{L}"), F.col(text_col))
    rows = docs.select(*keep, text.alias("__text"))
    if net is None:
        return rows.drop("__text").withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    schema = ", ".join([*fields, "lang_pred string", "score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            texts = batch.column(batch.num_columns - 1)
            langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            data = [None if not t.is_valid else t.as_buffer().to_pybytes() for t in texts]
            kept = [i for i, d in enumerate(data) if d]
            sums = _scores(net, [data[i] for i in kept])
            for i, row in zip(kept, sums):
                best = int(row.argmax())
                langs[i], scores[i] = net.languages[best], min(1.0, max(0.0, float(row[best])))
            names = [*batch.schema.names[:-1], "lang_pred", "score"]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=names)

    return rows.mapInArrow(run, schema)


def _scores(net: Network, texts: list[bytes], chunk: int = 64) -> np.ndarray:
    """Mean probabilities of each text; windows of all texts go through the network in blocks."""
    sums = np.zeros((len(texts), len(net.languages)))
    sizes = np.array([len(t) for t in texts])
    queue: list[tuple[int, np.ndarray]] = []
    held = 0

    def flush() -> None:
        x = np.concatenate([w for _, w in queue])
        of = np.concatenate([np.full(len(w), i) for i, w in queue])
        used = (x[:, :WINDOW] != _PAD).sum(axis=1)
        p = np.concatenate([net.probabilities(x[s:s + chunk]) for s in range(0, len(x), chunk)])
        np.add.at(sums, of, p * used[:, None])

    for i, text in enumerate(texts):
        found = windows(text)
        for start in range(0, len(found), chunk):
            queue.append((i, found[start:start + chunk]))
            held += len(queue[-1][1])
            if held >= chunk:
                flush()
                queue, held = [], 0
    if queue:
        flush()
    return sums / np.maximum(sizes, 1)[:, None]
