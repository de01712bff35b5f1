"""Part-of-speech tags in context: a first-order tag model, decoded by Viterbi as a fold over a sentence's words.

The model is two tables of whole-number weights, for example thousandths of logarithms of probabilities, so that sums and ties are exact:

- ``emissions``: ``token``, ``tag``, ``weight``. Rows without a token hold for words that the table does not list.
- ``transitions``: ``prev_tag``, ``tag``, ``weight``. Rows without a ``prev_tag`` hold for a sentence's first word.

A pair that is not listed weighs ``floor``; of a pair that is listed twice the larger weight holds. Of paths with equal weight the one
whose last tag, then whose last but one, and so on, comes first in the order of tags is taken.

Word and sentence boundaries are those of the text statistics. A sentence's words meet the emission table by a join and are
put together again in order: no more than a sentence is ever in one group. Texts are dealt out by their row's key before
they are cut, so the words and their weights, many times the text, are never shuffled. The
fold keeps a score and the counts of the best path for each tag, so its memory does not grow with the sentence.

Missing and empty texts have no words and count zero of each tag; rows that repeat an id are counted each; an empty
emission table gives every word ``floor`` for each tag of the transitions; a model without tags is an error.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .lookup import small

# Weight of a pair that is not in the tables.
FLOOR = -20_000
# A fold step compares every pair of tags; the published tag sets have at most a few hundred.
MAX_TAGS = 512
# The tags whose counts the density uses.
VERB, ADJECTIVE, NOUN = "VERB", "ADJ", "NOUN"


@dataclass
class TagModel:
    """Tags in binary order, and their weights as SQL constants."""

    tags: list[str]
    emissions: DataFrame      # token, emit: a weight for each tag
    unknown: str
    start: str
    moves: str                # moves[tag][previous tag]


def _numbers(values) -> str:
    return "array(" + ", ".join(f"{int(v)}L" for v in values) + ")"


def tag_model(emissions: DataFrame, transitions: DataFrame, floor: int = FLOOR) -> TagModel:
    """The tags are those of both tables; they and their pairs are parameters that the driver holds."""
    named = emissions.select("tag").union(transitions.select("tag")).union(transitions.select("prev_tag"))
    tags = [r[0] for r in named.where("tag is not null").distinct().limit(MAX_TAGS + 1).collect()]
    if not 0 < len(tags) <= MAX_TAGS:
        raise ValueError(f"a tag model has 1 to {MAX_TAGS} tags")
    tags = sorted(tags, key=lambda t: t.encode("utf-8"))
    pairs = {(r[0], r[1]): r[2] for r in transitions.where("tag is not null").groupBy("prev_tag", "tag").agg(F.max("weight")).collect()}
    weights = [F.coalesce(F.max(F.when(F.col("tag") == t, F.col("weight"))), F.lit(floor)).cast("long") for t in tags]
    listed = emissions.groupBy(F.lower("token").alias("token")).agg(F.array(*weights).alias("emit"))
    unknown = listed.where("token is null").select("emit").collect()
    return TagModel(
        tags, small(listed.where("token is not null")),
        _numbers(unknown[0][0] if unknown else [floor] * len(tags)),
        _numbers(pairs.get((None, t), floor) for t in tags),
        "array(" + ", ".join(_numbers(pairs.get((p, t), floor) for p in tags) for t in tags) + ")")


def best_path_counts(emits: str, model: TagModel, counted: list[str]) -> str:
    """SQL: struct of ``score`` and ``n``, the number of words of each tag of ``counted`` on the best path.

    ``emits``: the weights of a sentence's words, an array that is not empty. ``rank`` orders paths of equal score: it
    is the place of the path among those of the step before, so the last differing tag decides.
    """
    n = len(model.tags)
    ones = "array(" + ", ".join(
        "array(" + ", ".join("1" if t == c else "0" for c in counted) + ")" for t in model.tags) + ")"
    first = (f"transform(get({emits}, 0), (e, t) -> struct(e + get({model.start}, t) as score, -t as place, get({ones}, t) as n))")
    # Best predecessor of each tag: highest score, then the smallest place.
    best = (f"array_max(transform(acc, (a, p) -> struct(a.score + get(get({model.moves}, t), p) as score, -p as place, a.n as n)))")
    step = (f"transform(transform(sequence(0, {n - 1}), t -> {best}), (b, t) -> struct("
            f"b.score + get(e, t) as score, -t as place, zip_with(b.n, get({ones}, t), (x, y) -> x + y) as n))")
    return f"aggregate(slice({emits}, 2, size({emits})), {first}, (acc, e) -> {step}, acc -> array_max(acc))"


def tag_counts(reviews: DataFrame, model: TagModel, counted: list[str], text_col: str = "review_text",
               id_col: str = "review_id") -> DataFrame:
    """How many words of each review carry each tag of ``counted``: id and an array ``n``."""
    text = T.text_or_empty(F.col(text_col))
    parts = [F.col(id_col), F.col(text_col)]
    present = [p.isNull().cast("int") for p in parts]
    keys = {f"_row{i}": F.xxhash64(F.lit(i), *present, *parts) for i in (1, 2)}
    keyed = reviews.select(F.col(id_col).alias(id_col), *[c.alias(k) for k, c in keys.items()], text.alias("_text")).repartition(*keys)
    sentences = keyed.select("_row1", "_row2", F.posexplode(F.split("_text", f"[{T.SENTENCE_MARKS}]+")).alias("_s", "_piece"))
    words = sentences.select("_row1", "_row2", "_s", F.posexplode(T.words(F.col("_piece"))).alias("_w", "token"))
    met = words.join(model.emissions, "token", "left").withColumn("emit", F.coalesce("emit", F.expr(model.unknown)))
    # A set: equal rows bring the same words at the same places and are counted as one text.
    grouped = met.groupBy("_row1", "_row2", "_s").agg(F.array_sort(F.collect_set(F.struct("_w", "emit"))).alias("ws"))
    paths = grouped.select("_row1", "_row2", F.expr(best_path_counts("ws.emit", model, counted)).alias("best"))
    each = paths.groupBy("_row1", "_row2").agg(
        F.array(*[F.sum(F.get("best.n", F.lit(i)).cast("long")) for i in range(len(counted))]).alias("n"))
    zero = F.array(*[F.lit(0).cast("long") for _ in counted])
    return keyed.select(id_col, "_row1", "_row2").join(each, ["_row1", "_row2"], "left").select(
        id_col, F.coalesce("n", zero).alias("n"))


def pos_density_tagged(reviews: DataFrame, model: TagModel, **names) -> DataFrame:
    """Verbs plus adjectives per noun, by the tags of each word in its sentence."""
    id_col = names.get("id_col", "review_id")
    counts = tag_counts(reviews, model, [VERB, ADJECTIVE, NOUN], **names).select(
        id_col, *[F.get("n", F.lit(i)).alias(c) for i, c in enumerate(("n_verbs", "n_adjectives", "n_nouns"))])
    return counts.withColumn("pos_density", T.ratio(F.col("n_verbs") + F.col("n_adjectives"), F.col("n_nouns")))
