"""Toxic passages as maximum-scoring segments of token log-odds.

Model. Words (lower-case letter runs) of a bounded, documented sample of labelled rows,
at most about ``SAMPLE_PER_CLASS`` documents of each class, are counted by document in
``BUCKETS`` hash buckets, and so are their first letters (``PREFIX``). A word's log-odds
come from its counts with a Dirichlet prior whose mean is the share of its first letters, are
drawn towards zero by their standard error and lowered by a constant drift, so that
ordinary text scores below zero. A word that was never counted has the log-odds of its
first letters; a word that repeats the one before has the drift alone.

Search. One linear scan finds every maximal scoring segment of a text. For the lengths and scores of
clean text, segment scores follow an extreme-value law: with lambda from the score distribution
and K from clean documents, a segment of score S in n words is expected K n exp(-lambda S) times
by chance. Segments expected fewer than ``SIGNIFICANT`` times are toxic passages. The
evidence of a document is the sum of lambda S - ln(K n) over them, or the best one's if there is none; a logistic
curve, fitted on sample documents kept out of the counts, turns it into a score.

The model is a table of fixed size (``BUCKETS``); nothing else reaches the driver than its counts and a
number for each calibration document.

Defined results: null and empty texts score as a text without any evidence; without labels of
both classes every score is 0; columns of any names are carried; an empty table gives an empty result; labels, source, lang and id are no inputs; of several label rows of an
id the highest counts; repeated documents are scored each.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, kept_in_worker, slices, written

BUCKETS = 1 << 18
SAMPLE_PER_CLASS = 20_000
PREFIX = 4
PRIOR = 2.0
DRIFT = 0.5
LIMIT = 8.0
SIGNIFICANT = 0.05
THRESHOLD = 0.7
KEPT_WORDS = 300_000
WORDS = re.compile(r"[^\W\d_]+")
_GAMMA = 0.5772156649


def word_bucket(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) & (BUCKETS - 1)


def prefix_bucket(word: str) -> int:
    return zlib.crc32(b"\0" + word[:PREFIX].encode("utf-8", "surrogatepass")) & (BUCKETS - 1)


@dataclass
class Model:
    clean: np.ndarray  # documents of each class by word bucket
    toxic: np.ndarray
    even: tuple[float, float]  # makes the two classes weigh the same
    prefix_weight: np.ndarray
    rate: float  # lambda
    log_k: float
    slope: float = 0.0
    offset: float = -30.0

    def key(self) -> str:
        return hashlib.sha256(self.toxic.tobytes() + self.clean.tobytes() + np.array([self.rate]).tobytes()).hexdigest()

    def token_score(self, word: str) -> float:
        prefix = float(self.prefix_weight[prefix_bucket(word)])
        i = word_bucket(word)
        n0, n1 = float(self.clean[i]), float(self.toxic[i])
        if n0 + n1 == 0:
            return prefix - DRIFT
        mean = 1 / (1 + math.exp(-prefix))
        a1, a0 = PRIOR * mean, PRIOR * (1 - mean)
        odds = math.log((n1 * self.even[1] + a1) / (n0 * self.even[0] + a0))
        odds = math.copysign(max(abs(odds) - math.sqrt(1 / max(n1 + a1, 0.5) + 1 / max(n0 + a0, 0.5)), 0.0), odds)
        return min(max(odds, -LIMIT), LIMIT) - DRIFT

    def probability(self, evidence: float) -> float:
        z = self.slope * min(max(evidence, _ENDS[0]), _ENDS[1]) + self.offset
        return float(1 / (1 + np.exp(-min(max(z, -30.0), 30.0))))


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """Every maximal scoring segment (start, end, score), in one pass over the positive scores."""
    if not len(scores):
        return []
    upto = np.cumsum(scores)
    kept: list[tuple[float, float, int, int, int]] = []  # left sum, right sum, start, end, link
    for i in np.flatnonzero(scores > 0):
        right = float(upto[i])
        left, start = right - float(scores[i]), int(i)
        link = len(kept) - 1
        while True:
            # The nearest earlier segment whose left sum is smaller; links skip those known to be larger.
            while link >= 0 and kept[link][0] >= left:
                link = kept[link][4]
            if link < 0 or kept[link][1] >= right:
                kept.append((left, right, start, int(i) + 1, link))
                break
            left, start = kept[link][0], kept[link][2]
            before = kept[link][4]
            del kept[link:]
            link = before
    return [(start, end, right - left) for left, right, start, end, _ in kept]


def evidence(scores: np.ndarray, rate: float, log_k: float) -> tuple[float, list[tuple[int, int, float]]]:
    """Evidence of a text and its significant segments."""
    n = max(1, len(scores))
    base = log_k + np.log(n)
    found = [(start, end, rate * s - base) for start, end, s in segments(scores)]
    good = [x for x in found if x[2] > -np.log(SIGNIFICANT)]
    if good:
        return float(sum(x[2] for x in good)), good
    return float(max((x[2] for x in found), default=-base)), []


def labelled_sample(docs: DataFrame, labels: DataFrame, trained_on: Column, id_col: str, text_col: str,
                    per_class: int, seed: int) -> tuple[DataFrame, dict[int, float]]:
    """text, toxic, half of a bounded sample of labelled rows, and the share that was taken of each class."""
    known = (labels.filter(F.col("toxic").isNotNull()).groupBy(F.col("doc_id").alias("label_id"))
             .agg(F.max("toxic").cast("int").alias("toxic")).filter("toxic in (0, 1)"))
    counts = {r["toxic"]: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = {c: min(1.0, per_class / n) for c, n in counts.items()}
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("label_id")), F.lit(1 << 30)) / float(1 << 30)
    part = F.when(F.col("toxic") == 1, share.get(1, 0.0)).otherwise(share.get(0, 0.0))
    chosen = written(known.filter(draw < part), "toxic-sample")
    # At most about 2 * per_class ids of 12 bytes: the bound of the broadcast. Of the documents only id and text are read.
    rows = (docs.filter(trained_on & F.col(text_col).isNotNull())
            .select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")))
    half = F.pmod(F.xxhash64(F.lit(seed + 1), F.col("label_id")), F.lit(3)) == 0
    return rows.select("text", "toxic", half.alias("held")), share


def bucket_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Documents of each class by bucket: (2, BUCKETS) for words and prefixes, and documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((4, BUCKETS), dtype=np.int64)
        docs = np.zeros(2, dtype=np.int64)
        for batch in slices(batches):
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = set(WORDS.findall(text.lower()))
                docs[toxic] += 1
                if words:
                    table[toxic, list({word_bucket(w) for w in words})] += 1
                    table[2 + toxic, list({prefix_bucket(w) for w in words})] += 1
        where = np.flatnonzero(table.any(axis=0))
        columns = [where, *table[:, where]]
        columns = [np.append(c, v) for c, v in zip(columns, [-1, docs[0], docs[1], 0, 0])]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                         names=["bucket", "w0", "w1", "p0", "p1"])

    names = ["w0", "w1", "p0", "p1"]
    sums = (rows.select("text", "toxic").mapInArrow(count, "bucket long, w0 long, w1 long, p0 long, p1 long")
            .groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names]).toPandas())
    table, docs = np.zeros((4, BUCKETS)), np.zeros(2)
    real = sums[sums["bucket"] >= 0]
    table[:, real["bucket"].to_numpy(dtype=np.int64)] = real[names].to_numpy(dtype=float).T
    rest = sums[sums["bucket"] < 0]
    if len(rest):
        docs = rest[["w0", "w1"]].to_numpy(dtype=float)[0]
    return table, docs


def log_odds(n0: np.ndarray, n1: np.ndarray, docs: np.ndarray, mean: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds with a Dirichlet prior of strength PRIOR around ``mean``, less their standard error."""
    even = docs.mean() / np.maximum(docs, 1)
    a1, a0 = PRIOR * mean, PRIOR * (1 - mean)
    odds = np.log((n1 * even[1] + a1) / (n0 * even[0] + a0))
    error = np.sqrt(1 / np.maximum(n1 + a1, 0.5) + 1 / np.maximum(n0 + a0, 0.5))
    return np.clip(np.sign(odds) * np.maximum(np.abs(odds) - error, 0), -LIMIT, LIMIT), (n1 + n0) > 0


def fit_words(table: np.ndarray, docs: np.ndarray) -> Model | None:
    if docs.min() < 1:
        return None
    half = np.full(BUCKETS, 0.5)
    prefix_weight, _ = log_odds(table[2], table[3], docs, half)
    even = docs.mean() / docs
    # The score distribution of clean text, for lambda, is taken with the plain prior.
    weight, counted = log_odds(table[0], table[1], docs, half)
    scores = weight[counted] - DRIFT
    chance = table[0][counted] + PRIOR * 0.5 * (table[1][counted] > 0) / max(1.0, even[1])
    chance = chance / chance.sum()

    def excess(rate: float) -> float:
        return float(chance @ np.exp(rate * scores)) - 1

    low, high = 1e-3, 5.0
    if excess(low) < 0 < excess(high):
        for _ in range(60):
            low, high = ((low + high) / 2, high) if excess((low + high) / 2) < 0 else (low, (low + high) / 2)
        rate = low
    else:
        rate = 1.0
    return Model(table[0].astype(np.float32), table[1].astype(np.float32), (float(even[0]), float(even[1])),
                 prefix_weight.astype(np.float32), rate, 0.0)


def _scorer(model: Model):
    """word -> score, remembered up to a bound; shared by the tasks of a worker."""
    known: dict[str, float] = kept_in_worker(f"toxic-{model.key()}", dict)

    def scores(text: str | None) -> np.ndarray:
        words = WORDS.findall((text or "").lower())
        out, last = [], None
        for w in words:
            if w == last:  # a word said again says nothing new
                out.append(-DRIFT)
                continue
            last = w
            s = known.get(w)
            if s is None:
                s = model.token_score(w)
                if len(known) >= KEPT_WORDS:
                    known.clear()
                known[w] = s
            out.append(s)
        return np.array(out, dtype=np.float64)

    return scores


def fit(docs: DataFrame, labels: DataFrame, trained_on: Column, id_col: str = "doc_id", text_col: str = "text",
        per_class: int = SAMPLE_PER_CLASS, seed: int = 41) -> Model | None:
    rows, share = labelled_sample(docs, labels, trained_on, id_col, text_col, per_class, seed)
    rows = written(rows, "toxic-texts")
    table, n = bucket_counts(rows.filter("not held"))
    model = fit_words(table, n)
    if model is None:
        return None

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _scorer(model)
        for batch in slices(batches):
            out = []
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                s = scores(text)
                top = max((x[2] for x in segments(s)), default=0.0)
                # Evidence at K = 1; K shifts each segment alike and is put in on the driver.
                sums = [x[2] * model.rate - np.log(max(1, len(s))) for x in segments(s)]
                out.append((toxic, len(s), top, sorted(sums, reverse=True)[:64]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), [pa.int32(), pa.int64(), pa.float64(),
                                                            pa.list_(pa.float64())])],
                names=["toxic", "n", "top", "sums"])

    # A few numbers for each calibration document, bounded as the sample is.
    held = rows.filter("held").select("text", "toxic").mapInArrow(
        measure, "toxic int, n long, top double, sums array<double>").toPandas()
    clean = held[(held["toxic"] == 0) & (held["n"] > 0)]
    if not len(clean) or not (held["toxic"] == 1).any():
        return None
    raw = model.rate * clean["top"].to_numpy() - np.log(np.maximum(clean["n"].to_numpy(), 1))
    # Clean documents without any positive word say nothing about the law of the maxima but its lower end.
    model.log_k = float(np.median(raw) + np.log(np.log(2)))
    x = np.array([_sum_evidence(s, n, model.log_k) for s, n in zip(held["sums"], held["n"])])
    y = held["toxic"].to_numpy(dtype=float)
    weight = np.where(y == 1, 1 / share[1], 1 / share[0])
    model.slope, model.offset = logistic(x, y, weight)
    return model


def _sum_evidence(sums, n: int, log_k: float) -> float:
    values = np.asarray(sums, dtype=float) - log_k
    good = values[values > -np.log(SIGNIFICANT)]
    if len(good):
        return float(good.sum())
    return float(values.max()) if len(values) else -(log_k + float(np.log(max(1, n))))


#: Evidence beyond these ends says no more; keeps the logistic curve away from overflow.
_ENDS = (-20.0, 60.0)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset by penalised Newton steps."""
    x = np.clip(x, *_ENDS)
    design = np.stack([x, np.ones_like(x)], axis=1)
    theta = np.array([0.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        gradient = design.T @ (weight * (p - y)) + 1e-2 * theta
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        theta = theta - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return max(0.0, float(theta[0])), float(theta[1])


def score(docs: DataFrame, model: Model | None, text_col: str = "text", threshold: float = THRESHOLD,
          keep: tuple[Column, ...] = (), with_passages: bool = False) -> DataFrame:
    """Columns ``keep``, then score, predicted (and the significant passages, as word numbers with evidence)."""
    (text,) = fresh(docs.select(*keep), "text")
    rows = docs.select(*keep, F.col(text_col).alias(text))
    added = {"score": F.lit(0.0), "predicted": F.lit(0)}
    passages = "array<struct<start:int,end:int,evidence:double>>"
    if model is None:
        return rows.drop(text).withColumns(
            added | ({"passages": F.array().cast(passages)} if with_passages else {}))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    schema = ", ".join([*fields, "score double", "predicted int", *([f"passages {passages}"] if with_passages else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, scores = model, _scorer(model)
        for batch in slices(batches):
            values, spans = [], []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                x, found = evidence(scores(text), m.rate, m.log_k)
                values.append(m.probability(x))
                spans.append([{"start": s, "end": e, "evidence": v} for s, e, v in found] if with_passages else None)
            columns = [*batch.columns[:-1], pa.array(values, pa.float64()),
                       pa.array([int(v >= threshold) for v in values], pa.int32())]
            names = [*batch.schema.names[:-1], "score", "predicted"]
            if with_passages:
                columns.append(pa.array(spans, pa.list_(pa.struct(
                    [("start", pa.int32()), ("end", pa.int32()), ("evidence", pa.float64())]))))
                names.append("passages")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, schema)


def without_toxic(docs: DataFrame, model: Model | None, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score stays below the threshold, with their columns; a text reaches the worker once."""
    if model is None:
        return docs
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _scorer(model)
        for batch in slices(batches):
            clean = [model.probability(evidence(scores(text.as_py()), model.rate, model.log_k)[0]) < threshold
                     for text in batch.column(place)]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
