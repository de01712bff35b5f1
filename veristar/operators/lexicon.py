"""Lexicon sentiment and the linear sentiment head in one pass over the tokens.

Each review is turned into token rows inside its own task, met with small
broadcast tables and summed again. Only one narrow row per review and map task
is shuffled: the partial sums already cover the whole review.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import text as T
from ..functions.sentiment import model_sentiment_columns
from ..session import materialize
from ..sources import params as P
from .lookup import small, token_test

if TYPE_CHECKING:
    from .model_sentiment import PlaceWeights

WEIGHTS = ("w_neg", "w_neu", "w_pos")
# Sums over a review's tokens by a head that knows its weights by place.
PLACE_SUMS = ("place_neg", "place_neu", "place_pos")


@dataclass
class SentimentTables:
    """Lookup tables of the two sentiment scores; the derived ones are built once."""

    lexicon: DataFrame            # token, valence
    boosters: DataFrame           # token, scalar
    negations: DataFrame          # token
    head: DataFrame | None = None  # token, w_neg, w_neu, w_pos
    bias: tuple[float, float, float] = (0.0, 0.0, 0.0)
    contrast: str = P.CONTRAST_WORD
    # A head by place (``model_sentiment.PlaceWeights``) whose table is ``head``, and the reviews, as a condition,
    # all of whose tokens are in that table, such as those of the fit. Tokens of other reviews are looked up there.
    places: PlaceWeights | None = None
    covered: Column | None = None

    @cached_property
    def facts(self) -> DataFrame:
        """One row per known token: valence (boosters carry none) and head weights."""
        nothing = F.lit(None).cast("double")
        parts = self.lexicon.join(self.boosters.select("token"), "token", "left_anti").select(
            "token", "valence", *[nothing.alias(w) for w in WEIGHTS])
        if self.head is not None and self.places is None:
            parts = parts.unionByName(self.head.select("token", nothing.alias("valence"), *WEIGHTS))
        merged = parts.groupBy(F.col("token").alias("hit")).agg(*[F.max(c).alias(c) for c in ("valence", *WEIGHTS)])
        return small(merged)

    @cached_property
    def modifiers(self) -> DataFrame:
        """Boosters and negations; a word with its own valence never modifies another."""
        parts = self.boosters.select("token", "scalar", F.lit(False).alias("negates")).unionByName(
            self.negations.select("token", F.lit(0.0).alias("scalar"), F.lit(True).alias("negates")))
        merged = parts.groupBy("token").agg(F.max_by("scalar", F.abs("scalar")).alias("scalar"),
                                            F.bool_or("negates").alias("negates"))
        return small(merged.join(self.lexicon.select("token"), "token", "left_anti"))

    @cached_property
    def known(self):
        """In-row test for known tokens, or ``None`` where there are too many."""
        return token_test(self.facts, "hit")


def default_tables(spark) -> SentimentTables:
    return SentimentTables(P.sample_lexicon(spark), P.default_boosters(spark), P.default_negations(spark))


def is_upper(token: Column) -> Column:
    return (token == F.upper(token)) & (token != F.lower(token))


def _core(token: Column) -> Column:
    return F.btrim(token, F.lit(T.PUNCTUATION))


def _core_or_whole(token: Column, core: Column) -> Column:
    return F.when(F.length(core) <= 2, token).otherwise(core)


def sentiment_tokens(text: Column) -> Column:
    """Tokens without edge punctuation; very short ones, such as emoticons, stay whole."""
    # Pairs, so that the text is split once.
    pairs = F.transform(T.spaced_tokens(text), lambda t: F.struct(t.alias("whole"), _core(t).alias("core")))
    return F.transform(pairs, lambda pair: _core_or_whole(pair["whole"], pair["core"]))


def sentiment_token(raw: Column) -> Column:
    """The same for one token of ``spaced_tokens``."""
    return _core_or_whole(raw, _core(raw))


def _emphasis(text: Column) -> Column:
    """What exclamation and question marks add to the size of the sum."""
    marks = F.least(T.char_count(text, "!"), F.lit(P.EXCLAMATION_MAX))
    questions = T.char_count(text, "?")
    asked = (
        F.when(questions <= 1, F.lit(0.0))
        .when(questions <= P.QUESTION_STEPS_MAX, questions * P.QUESTION_STEP)
        .otherwise(F.lit(P.QUESTION_CEILING))
    )
    return marks * P.EXCLAMATION_STEP + asked


def sentiment_scores(reviews: DataFrame, tables: SentimentTables, carry: dict[str, Column] | None = None,
                     text_col: str = "review_text", id_col: str = "review_id", tokens: Column | None = None) -> DataFrame:
    """Add up both scores per review; ``carry`` columns travel along unchanged.

    ``tokens`` takes the place of the text's own tokens, for example with phrases as one token.

    Carried columns are repeated per known token: carry narrow values, never texts.
    Sums go by a key of the row's own, so rows that repeat an id are scored each.

    Result: id, carried columns, ``sentiment_score``, ``model_sentiment`` and the
    three class shares ``model_neg``, ``model_neu``, ``model_pos``.
    """
    carry = carry or {}
    text = T.text_or_empty(F.col(text_col))
    row = "_row"
    while row.lower() in {c.lower() for c in (id_col, *carry)}:
        row = f"_{row}"
    toks = (sentiment_tokens(text) if tokens is None else tokens).alias("toks")
    kept = [F.monotonically_increasing_id().alias(row), F.col(id_col), *[c.alias(n) for n, c in carry.items()],
            _emphasis(text).alias("emphasis"), toks]
    if tables.places is None:
        return _shares(_sums(reviews.select(*kept), tables, row, id_col, list(carry)), tables, id_col, list(carry))
    covered = F.lit(False) if tables.covered is None else F.coalesce(tables.covered, F.lit(False))
    sums = _sums(reviews.where(covered).select(*kept), tables, row, id_col, list(carry))
    # Written once, as two branches meet by the row's key.
    others = materialize(reviews.where(~covered).select(*kept), "others")
    found = others.select(row, F.explode(F.transform("toks", F.lower)).alias("token"))
    strange = found.join(tables.head.select("token"), "token", "left_anti").groupBy(row).agg(
        F.collect_list("token").alias("token"))
    less = [F.col(c).alias(f"less_{c}") for c in PLACE_SUMS]
    looked_up = _sums(others, tables, row, id_col, list(carry)).join(
        tables.places.sums(strange, "token").select(row, *less), row, "left")
    # A token that the table lacks adds nothing.
    known = looked_up.withColumns({w: F.col(w) - F.coalesce(F.col(f"less_{c}"), F.lit(0.0)) for w, c in zip(WEIGHTS, PLACE_SUMS)})
    return _shares(sums.unionByName(known.select(*sums.columns)), tables, id_col, list(carry))


def _sums(split: DataFrame, tables: SentimentTables, row: str, id_col: str, carry: list[str]) -> DataFrame:
    """One row per review: what the lexicon and the head add up to over its tokens."""
    per_review = (
        split.withColumns({"n_toks": F.size("toks"), "n_caps": F.size(F.filter("toks", is_upper)),
                           "keys": F.transform("toks", F.lower)})
        .withColumns({"contrast_at": F.array_position("keys", tables.contrast) - 1,
                      "mixed_case": (F.col("n_caps") > 0) & (F.col("n_caps") < F.col("n_toks"))})
    )
    by_place = list(PLACE_SUMS) if tables.places else []
    if by_place:
        per_review = tables.places.sums(per_review, "keys")
    places = "case when n_toks > 0 then sequence(0, n_toks - 1) else cast(array() as array<int>) end"
    if tables.known:
        places = f"filter({places}, i -> {tables.known('get(keys, i)')})"
    # A review without any known word keeps one row, with an empty token.
    fixed = [row, id_col, *carry, *by_place, "emphasis", "n_toks", "contrast_at", "mixed_case"]
    rows = per_review.select(
        *fixed,
        F.explode_outer(F.expr(
            f"transform({places}, i -> struct(i as pos, get(toks, i) as t, "
            "get(toks, i - 1) as p1, get(toks, i - 2) as p2, get(toks, i - 3) as p3))")).alias("tok"),
    ).select(*fixed, "tok.*")
    hits = rows.join(tables.facts, F.lower(F.col("t")) == F.col("hit"), "left")
    hits = _with_valence(hits, tables)

    weights = [F.any_value(c).alias(w) for w, c in zip(WEIGHTS, by_place)] or [F.sum(w).alias(w) for w in WEIGHTS]
    # Strings go with the key: in an aggregation buffer they would force a sort.
    strings = [f.name for f in per_review.schema if f.name in carry and isinstance(f.dataType, StringType)]
    numbers = [c for c in carry if c not in strings]
    return hits.groupBy(row, id_col, *strings).agg(
        *[F.any_value(c).alias(c) for c in (*numbers, "emphasis", "n_toks")],
        F.sum("v").alias("s"), *weights,
    )


def _shares(sums: DataFrame, tables: SentimentTables, id_col: str, kept: list[str]) -> DataFrame:
    """Both scores from a review's sums."""
    logits = {
        z: f"{float(b)}D + coalesce({w}, 0.0D) / greatest(n_toks, 1) as {z}"
        for z, b, w in zip(("z_neg", "z_neu", "z_pos"), tables.bias, WEIGHTS)
    }
    totals = sums.selectExpr(
        id_col, *kept, "n_toks = 0 as blank",
        "coalesce(s, 0.0D) + signum(coalesce(s, 0.0D)) * emphasis as total", *logits.values())
    parts = model_sentiment_columns(F.col("z_neg"), F.col("z_neu"), F.col("z_pos"), F.col("blank"))
    score = F.expr(f"round(total / sqrt(total * total + {P.NORMALIZER}D), 4)")
    return totals.select(id_col, *kept, score.alias("sentiment_score"), *[c.alias(n) for n, c in parts.items()])


def _upper(token: str) -> str:
    return f"({token} = upper({token}) and {token} <> lower({token}))"


def _with_valence(hits: DataFrame, tables: SentimentTables) -> DataFrame:
    """Apply capitals, boosters, negations and the contrast word to each valence."""
    out = hits.selectExpr(
        "*", f"valence + if(mixed_case and {_upper('t')}, signum(valence) * {P.CAPS_EMPHASIS}D, 0.0D) as v0")
    for k, damping in enumerate(P.DAMPING, 1):
        near = tables.modifiers.selectExpr(f"token as m{k}", f"scalar as s{k}", f"negates as n{k}")
        # A null key finds nothing, so words without valence cost no lookup.
        key = F.expr(f"case when valence is not null then lower(p{k}) end")
        before = f"v{k - 1}"
        loud = f"if(mixed_case and {_upper(f'p{k}')}, {P.CAPS_EMPHASIS}D, 0.0D)"
        push = (f"if(coalesce(s{k}, 0.0D) <> 0, if({before} < 0, -1.0D, 1.0D) * (s{k} + {loud}) * {damping}D, 0.0D)")
        flip = f"if(coalesce(n{k}, false) or coalesce(contains(lower(p{k}), \"n't\"), false), {P.NEGATION_FACTOR}D, 1.0D)"
        out = out.join(near, key == F.col(f"m{k}"), "left").selectExpr("*", f"({before} + {push}) * {flip} as v{k}")
    return out.selectExpr(
        "*", f"""v{len(P.DAMPING)} * case when contrast_at < 0 or pos = contrast_at then 1.0D
                 when pos < contrast_at then {P.BEFORE_CONTRAST}D else {P.AFTER_CONTRAST}D end as v""")


def lexicon_sentiment(reviews: DataFrame, tables: SentimentTables, **names) -> DataFrame:
    """Compound score -1..1 per review."""
    id_col = names.get("id_col", "review_id")
    return sentiment_scores(reviews, tables, **names).select(id_col, "sentiment_score")
