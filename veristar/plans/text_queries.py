"""Text statistics, sentiment and the feature table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sentiment as N
from ..functions import text as T
from ..operators import feature_table as FT
from ..operators import hyphenation as HY
from ..operators import keys as K
from ..operators import lexicon as L
from ..operators import model_sentiment as M
from ..operators import phrases as PH
from ..operators import tagging as TG
from ..operators.features import FEATURE_COLS, MODEL_COLS, STABLE_COLS, extract_features, unprocessed_reviews
from ..session import shared_dir
from ..operators.training import training_set
from ..sources import bucketed
from ..sources import params as P
from ..sources.readers import read_table
from ..streaming import incremental, keyed
from . import inputs as I
from . import sql as S
from .registry import ORACLES, query

STYLE = f"with {S.RAW},\n{S.STORED},\n{S.style('stored')}\n"
COLS = ", ".join(FEATURE_COLS)


def _texts(spark, sf):
    return read_table(spark, sf, "documents", "doc_id", ["doc_id", "text"]).toDF("review_id", "review_text")


@query("punctuation_freq", STYLE + "select review_id, punctuation_freq from style")
def punctuation_freq(spark, sf):
    return _texts(spark, sf).select("review_id", T.punctuation_frequency(F.col("review_text")).alias("punctuation_freq"))


@query("vocab_diversity", STYLE + "select review_id, vocab_diversity from style")
def vocab_diversity(spark, sf):
    return _texts(spark, sf).select("review_id", T.vocab_diversity(F.col("review_text")).alias("vocab_diversity"))


@query("avg_sentence_length", STYLE + "select review_id, avg_sentence_length from style")
def avg_sentence_length(spark, sf):
    return _texts(spark, sf).select("review_id", T.avg_sentence_length(F.col("review_text")).alias("avg_sentence_length"))


@query("readability", STYLE + "select review_id, readability_score from style")
def readability(spark, sf):
    return _texts(spark, sf).select("review_id", T.flesch_reading_ease(F.col("review_text")).alias("readability_score"))


# Each pattern at each place of each distinct word, without the substrings of the DataFrame form.
@query("pattern_readability", STYLE.rstrip() + f""",
pat as (select p, regexp_replace(p, '[0-9]', '', 'g') as letters from {S.values([(p,) for p in I.PATTERNS], 'p')}),
lev as (
  select p, letters, i, coalesce(try_cast(regexp_extract(regexp_extract(p, '^(?:[0-9]?[^0-9]){{' || i || '}}([0-9]?)', 0), '([0-9])$', 1) as int), 0) as level
  from (select p, letters, unnest(range(0, length(letters) + 1)) as i from pat)),
vocabulary as (select distinct unnest(w) as word from style),
standing as (
  select word, pat.p, at_ from (select word, '.' || word || '.' as d, unnest(range(1, length(word) + 3)) as at_ from vocabulary) join pat
  on substr(d, at_, length(letters)) = letters),
gap as (select word, at_ + i - 2 as before, max(level) as level from standing join lev using (p) group by 1, 2),
breaks as (select word, count(*) as n from gap where level % 2 = 1 and before between 2 and length(word) - 2 group by word),
given as (select replace(b, '-', '') as word, length(b) - length(replace(b, '-', '')) as n from {S.values([(b,) for b in I.BROKEN_WORDS], 'b')}),
syll as (select word, 1 + coalesce(given.n, breaks.n, 0) as n from vocabulary left join breaks using (word) left join given using (word)),
counts as (select review_id, cast(sum(n) as bigint) as n_syllables from (select review_id, unnest(w) as word from style) join syll using (word) group by review_id)
select review_id, cast(n_words as int) as n_words, coalesce(n_syllables, 0) as n_syllables,
  case when n_words = 0 or n_sent = 0 then 0.0 else
    round(cast(206.835 as double) - cast(1.015 as double) * (cast(n_words as double) / n_sent)
          - cast(84.6 as double) * (cast(coalesce(n_syllables, 0) as double) / n_words), 4) end as readability_score
from style left join counts using (review_id)""")
def pattern_readability(spark, sf):
    return HY.pattern_readability(_texts(spark, sf), P.column_table(spark, "pattern", I.PATTERNS), P.column_table(spark, "word", I.BROKEN_WORDS))


@query("fk_grade", STYLE + "select review_id, fk_grade from style")
def fk_grade(spark, sf):
    return _texts(spark, sf).select("review_id", T.flesch_kincaid_grade(F.col("review_text")).alias("fk_grade"))


@query("text_counts", STYLE + """select review_id, cast(length(review_text) as int) as n_chars, cast(n_words as int) as n_words, cast(n_sent as int) as n_sentences,
  cast(n_syll as int) as n_syllables, cast(length(review_text) - length(replace(review_text, '!', '')) as int) as n_exclamations from style""")
def text_counts(spark, sf):
    return _texts(spark, sf).select(
        "review_id", F.length(F.col("review_text")).alias("n_chars"), T.word_count(F.col("review_text")).alias("n_words"),
        T.sentence_count(F.col("review_text")).alias("n_sentences"), T.syllable_count(F.col("review_text")).alias("n_syllables"),
        T.char_count(F.col("review_text"), "!").alias("n_exclamations"))


@query("pos_density", f"""with {S.RAW},
pos as (select * from {S.values(I.POS_WORDS.items(), 'token, pos')}),
hits as (select review_id, pos from (
  select review_id, unnest(regexp_extract_all(lower(text_), '{S.WORD}')) as token from raw) join pos using (token)),
n as (select review_id, count(*) filter (pos = 'VERB') as n_verbs, count(*) filter (pos = 'ADJ') as n_adjectives,
  count(*) filter (pos = 'NOUN') as n_nouns from raw left join hits using (review_id) group by review_id)
select *, case when n_nouns = 0 then 0.0 else round(cast(n_verbs + n_adjectives as double) / n_nouns, 4) end as pos_density from n""")
def pos_density(spark, sf):
    import pyarrow as pa

    from ..session import local_table

    words = local_table(spark, {"token": (pa.string(), list(I.POS_WORDS)), "pos": (pa.string(), list(I.POS_WORDS.values()))})
    return M.pos_density(_texts(spark, sf), words)


def _tag_sql() -> str:
    tags = sorted({t for _, t, _ in I.EMISSIONS})
    weights = {(a, t): w for a, t, w in I.TRANSITIONS}
    listed: dict = {}
    for token, tag, weight in I.EMISSIONS:
        listed.setdefault(token, dict.fromkeys(tags, TG.FLOOR))[tag] = weight

    def cells(emit: dict, first: bool) -> str:
        return "[" + ", ".join(
            f"{{'score': {emit[t] + (weights.get((None, t), TG.FLOOR) if first else 0)}::bigint, 'place': {-i}, "
            f"'v': {int(t == TG.VERB)}, 'a': {int(t == TG.ADJECTIVE)}, 'n': {int(t == TG.NOUN)}}}" for i, t in enumerate(tags)) + "]"

    rows = ", ".join(f"({S.text(k)}, {cells(e, True)}, {cells(e, False)})" for k, e in listed.items() if k is not None)
    moves = "[" + ", ".join("[" + ", ".join(str(weights.get((p, t), TG.FLOOR)) for p in tags) + "]" for t in tags) + "]"
    best = (f"list_max(list_transform(acc, lambda a, p: {{'score': a.score + ({moves})[t][p], 'place': 1 - p, 'v': a.v, 'a': a.a, 'n': a.n}}))")
    return f"""with {S.RAW},
emission as (select * from (values {rows}) as v(token, opening, inner_)),
piece as (select review_id, s, ws from (
  select review_id, unnest(ps) as p, generate_subscripts(ps, 1) as s from (select review_id, string_split_regex(text_, '[.!?]+') as ps from raw)),
  lateral (select regexp_extract_all(lower(p), '{S.WORD}') as ws)),
word as (select review_id, s, unnest(ws) as token, generate_subscripts(ws, 1) as k from piece),
met as (select review_id, s, list(case when k = 1 then coalesce(opening, {cells(listed[None], True)}) else coalesce(inner_, {cells(listed[None], False)}) end
  order by k) as es from word left join emission using (token) group by review_id, s),
path as (select review_id, list_max(list_reduce(es, lambda acc, x: list_transform(list_transform(x, lambda e, t: {{'e': e, 'b': {best}}}),
  lambda y: {{'score': y.e.score + y.b.score, 'place': y.e.place, 'v': y.e.v + y.b.v, 'a': y.e.a + y.b.a, 'n': y.e.n + y.b.n}}))) as b from met),
counts as (select review_id, cast(sum(b.v) as bigint) as n_verbs, cast(sum(b.a) as bigint) as n_adjectives, cast(sum(b.n) as bigint) as n_nouns from path group by review_id),
every as (select review_id, coalesce(n_verbs, 0) as n_verbs, coalesce(n_adjectives, 0) as n_adjectives, coalesce(n_nouns, 0) as n_nouns
  from raw left join counts using (review_id))
select *, case when n_nouns = 0 then 0.0 else round(cast(n_verbs + n_adjectives as double) / n_nouns, 4) end as pos_density from every"""


@query("pos_density_tagged", _tag_sql())
def pos_density_tagged(spark, sf):
    model = TG.tag_model(P.weight_table(spark, "token", I.EMISSIONS), P.weight_table(spark, "prev_tag", I.TRANSITIONS))
    return TG.pos_density_tagged(_texts(spark, sf), model)


@query("rating_scale", f"with {S.RAW}\nselect review_id, rating, {S.SCALED} as scaled_rating from raw")
def rating_scale(spark, sf):
    return I.reviews(spark, sf).select("review_id", "rating", N.rating_to_scale(F.col("rating")).alias("scaled_rating"))


SENTIMENT = f"with {S.RAW},\n{S.STORED},\n{S.sentiment('stored')}\n"


@query("lexicon_sentiment", SENTIMENT + "select review_id, sentiment_score from sentiment")
def lexicon_sentiment(spark, sf):
    return L.lexicon_sentiment(_texts(spark, sf), I.sentiment_tables(spark))


# Phrases by table: where each can stand, the longest of a place, and for each the first that begins behind its end; a walk
# from a text's first one along these takes those that count.
PHRASE_SPLIT = f"""{S.split_tokens('stored').replace('split as', 'plain as', 1)},
words as (select review_id, unnest(toks) as t, generate_subscripts(toks, 1) as pos from plain),
phrase as (select string_split(p, ' ') as ws from {S.values([(p,) for p in (*I.PHRASES, *I.PHRASE_BOOSTERS)], 'p')}),
begun as (
  select review_id, pos, max(len(ws)) as n from words join phrase on lower(t) = ws[1] join plain using (review_id)
  where list_transform(toks[pos:pos + len(ws) - 1], lambda x: lower(x)) = ws group by review_id, pos),
linked as (
  select b.review_id, b.pos, b.n, nx.pos as next_pos from begun b asof left join begun nx
  on nx.review_id = b.review_id and nx.pos >= b.pos + b.n),
walk as (
  select review_id, pos, n, next_pos from (select *, row_number() over (partition by review_id order by pos) as k from linked) where k = 1
  union all select l.review_id, l.pos, l.n, l.next_pos from walk w join linked l on l.review_id = w.review_id and l.pos = w.next_pos),
taken as (select review_id, pos, n, unnest(range(pos, pos + n)) as inside from walk),
units as (
  select w.review_id, coalesce(k.pos, w.pos) as place, string_agg(t, ' ' order by w.pos) as t
  from words w left join taken k on k.review_id = w.review_id and k.inside = w.pos group by 1, 2),
joined as (select review_id, list(t order by place) as toks from units group by review_id),
n_walk as (select review_id, cast(count(*) as int) as n_phrases from walk group by review_id),
split as (select review_id, txt, coalesce(joined.toks, []) as toks from plain left join joined using (review_id))"""


@query("phrase_sentiment", f"with recursive {S.RAW},\n{S.STORED},\n" + S.sentiment(
    "stored", split=PHRASE_SPLIT, lexicon=I.LEXICON | I.PHRASES, boosters=I.BOOSTERS | I.PHRASE_BOOSTERS)
    + "\nselect review_id, sentiment_score, coalesce(n_phrases, 0) as n_phrases from sentiment left join n_walk using (review_id)")
def phrase_sentiment(spark, sf):
    return PH.phrase_sentiment(_texts(spark, sf), I.phrase_tables(spark))


@query("head_sentiment", SENTIMENT + "select review_id, model_sentiment, model_neg, model_neu, model_pos from sentiment")
def head_sentiment(spark, sf):
    return L.sentiment_scores(_texts(spark, sf), I.sentiment_tables(spark)).drop("sentiment_score")


# Logits out of the first components of the given vectors; one class stands for blank texts.
@query("softmax_compound", """with z as (
  select vec_id, cast(embedding[1] as double) * 8 as z_neg, cast(embedding[2] as double) * 8 as z_neu,
    cast(embedding[3] as double) * 8 as z_pos, label = 0 as blank from embeddings),
e as (select *, exp(z_neg - greatest(z_neg, z_neu, z_pos)) as e1, exp(z_neu - greatest(z_neg, z_neu, z_pos)) as e2,
  exp(z_pos - greatest(z_neg, z_neu, z_pos)) as e3 from z)
select vec_id, case when blank then 0.0 else round(e3 / (e1 + e2 + e3) - e1 / (e1 + e2 + e3), 4) end as model_sentiment,
  case when blank then 0.0 else round(e1 / (e1 + e2 + e3), 4) end as model_neg,
  case when blank then 1.0 else round(e2 / (e1 + e2 + e3), 4) end as model_neu,
  case when blank then 0.0 else round(e3 / (e1 + e2 + e3), 4) end as model_pos from e""")
def softmax_compound(spark, sf):
    logits = [F.get("embedding", F.lit(i)).cast("double") * 8 for i in range(3)]
    return read_table(spark, sf, "embeddings").select(
        "vec_id", *[c.alias(n) for n, c in N.model_sentiment_columns(*logits, F.col("label") == 0).items()])


@query("sentiment_gaps", S.ALL_FEATURES + """select review_id, sentiment_score, model_sentiment, rating_sentiment_gap,
  model_rating_gap, sentiment_dissonance from features""")
def sentiment_gaps(spark, sf):
    return I.features(spark, sf).select(
        "review_id", "sentiment_score", "model_sentiment", "rating_sentiment_gap", "model_rating_gap",
        "sentiment_dissonance")


@query("extract_features", S.ALL_FEATURES + f"select review_id, {COLS} from features")
def extract(spark, sf):
    return I.features(spark, sf)


@query("model_sentiment")
def model_sentiment(spark, sf):
    """Fit the head on the rated reviews, then score all of them."""
    reviews = I.rated_texts(spark, sf)
    fitted = M.fit_head(reviews)
    tables = L.SentimentTables(P.sample_lexicon(spark), P.default_boosters(spark), P.default_negations(spark), *fitted,
                               places=fitted.places, covered=F.col("rating").isNotNull())
    return L.sentiment_scores(reviews, tables).select("review_id", "model_sentiment", "model_neg", "model_neu", "model_pos")


@query("stream_features", S.ALL_FEATURES + f"select review_id, {COLS} from features")
def stream_features(spark, sf):
    """The document file as a stream; ratings as in the batch queries."""
    schema = spark.read.parquet(f"{sf}/documents.parquet").schema
    base = shared_dir(spark, "stream")
    # A pattern, since a stream takes the table's path itself only where the table is a folder of files, not one file.
    docs = incremental.read_review_stream(spark, f"{sf}/documents.parque[t]", schema)
    rating = F.when(F.col("doc_id") % 17 != 0, (F.col("doc_id") % 5 + 1).cast("double"))
    arriving = docs.select(F.col("doc_id").alias("review_id"), F.col("text").alias("review_text"), rating.alias("rating"))
    # The table has a row per document and no arrival time: any order will do.
    run = incremental.start_extraction(arriving, I.sentiment_tables(spark), f"{base}/deltas", f"{base}/checkpoint",
                                       ["review_id"])
    run.awaitTermination()
    return incremental.current_features(spark, f"{base}/deltas")


# Deliveries of every document: all of them, later a changed text of some, and last a text of some that was delivered before all
# others but arrives behind them, with copies of first deliveries.
DELIVERIES = """deliveries as (
  select review_id * 4 as review_id, review_id as doc, 2 as hours, rating, text_ as review_text from raw
  union all select review_id * 4 + 1, review_id, 3, 6 - rating, text_ || ' was best!' from raw where review_id % 3 = 0
  union all select review_id * 4 + 2, review_id, 1, rating, 'No ' || text_ from raw where review_id % 5 = 0)"""


@query("stream_keyed_features", f"with {S.RAW},\n{DELIVERIES},\n{S.features('deliveries')}\nselect doc as review_id, " + ", ".join(
    [f"arg_min_null({c}, hours) as {c}" for c in STABLE_COLS] + [f"arg_max_null({c}, hours) as {c}" for c in MODEL_COLS]) + " from features group by doc")
def stream_keyed_features(spark, sf):
    """The feature table of a stream of repeated and late deliveries, in three rounds that restart from the checkpoints."""
    base = shared_dir(spark, "keyed")
    reviews = I.reviews(spark, sf).select("review_id", "rating", "review_text")
    rid, text, rating = F.col("review_id"), F.col("review_text"), F.col("rating")

    def at(hour: int):
        return F.timestamp_seconds(F.lit(1_700_000_000 + 3600 * hour))

    first = reviews.withColumn("delivered_at", at(2))
    changed = reviews.where(rid % 3 == 0).select(
        rid, (6 - rating).alias("rating"), F.concat(text, F.lit(" was best!")).alias("review_text"), at(3).alias("delivered_at"))
    late = reviews.where(rid % 5 == 0).select(
        rid, rating, F.concat(F.lit("No "), text).alias("review_text"), at(1).alias("delivered_at"))
    for arriving in (first, changed, late.unionByName(first.where(rid % 7 == 0))):
        arriving.write.mode("append").parquet(f"{base}/deliveries")
        stream = incremental.read_review_stream(spark, f"{base}/deliveries", first.schema)
        keyed.start_scoring(stream, I.sentiment_tables(spark), f"{base}/scored", f"{base}/scoring").awaitTermination()
        keyed.start_keyed(spark, f"{base}/scored", f"{base}/updates", f"{base}/state").awaitTermination()
    return keyed.keyed_table(spark, f"{base}/updates")


# A stored feature table with gaps: only labelled reviews are in it, one label
# lacks its model columns, and the rows of two sources belong to no review.
STORED_SQL = f"""partial as (
  select review_id + case when category in ('src1', 'src7') then 1000000000 else 0 end as review_id,
    {", ".join(f"cast(length(text_) as double) + {i} as {c}" for i, c in enumerate(STABLE_COLS))},
    {", ".join(f"case when label = 'or' then cast(review_id as double) + {i} end as {c}" for i, c in enumerate(MODEL_COLS))}
  from raw where label is not null)"""


def _partial(spark, sf):
    rid = F.col("review_id")
    orphan = F.when(F.col("category").isin("src1", "src7"), F.lit(1_000_000_000)).otherwise(F.lit(0))
    return I.raw_reviews(spark, sf).where(F.col("label").isNotNull()).select(
        (rid + orphan).alias("review_id"),
        *[(F.length("text_").cast("double") + i).alias(c) for i, c in enumerate(STABLE_COLS)],
        *[F.when(F.col("label") == "or", rid.cast("double") + i).alias(c) for i, c in enumerate(MODEL_COLS)])


@query("unprocessed_reviews", f"""with {S.RAW}, {STORED_SQL}
select r.review_id, r.rating, r.text_ as review_text from raw r left join partial p on p.review_id = r.review_id
where p.review_id is null or p.model_sentiment is null""")
def unprocessed(spark, sf):
    return unprocessed_reviews(I.reviews(spark, sf), _partial(spark, sf)).select("review_id", "rating", "review_text")


@query("upsert_features", S.ALL_FEATURES.rstrip() + f""", {STORED_SQL}
select coalesce(p.review_id, f.review_id) as review_id,
  {", ".join(f"case when p.review_id is not null then p.{c} else f.{c} end as {c}" for c in STABLE_COLS)},
  {", ".join(f"case when f.review_id is not null then f.{c} else p.{c} end as {c}" for c in MODEL_COLS)}
from partial p full join features f on p.review_id = f.review_id""")
def upsert(spark, sf):
    """Write the new snapshot next to the old one and read it back."""
    path = shared_dir(spark, "features")
    FT.upsert_features(_partial(spark, sf), I.features(spark, sf)).write.parquet(path)
    return spark.read.parquet(path)


BUCKETS = 8


def _bucketed(df, purpose):
    return bucketed.write_bucketed(df, bucketed.fresh_table(purpose), BUCKETS)


@query("unprocessed_bucketed", ORACLES["unprocessed_reviews"])
def unprocessed_bucketed(spark, sf):
    """The retry of stored reviews, both tables in the same buckets."""
    reviews, stored = _bucketed(I.reviews(spark, sf), "reviews"), _bucketed(_partial(spark, sf), "features")
    return unprocessed_reviews(reviews, stored).select("review_id", "rating", "review_text")


@query("training_bucketed", f"""with {S.RAW}, {STORED_SQL}
select p.review_id, {", ".join(f"p.{c}" for c in STABLE_COLS)}, {", ".join(f"coalesce(p.{c}, 0.0) as {c}" for c in MODEL_COLS)},
  coalesce(r.text_, '') as review_text, r.label, case when upper(trim(r.label)) = 'CG' then 1 else 0 end as target
from partial p join raw r on p.review_id = r.review_id""")
def training_bucketed(spark, sf):
    return training_set(_bucketed(_partial(spark, sf), "features"), _bucketed(I.reviews(spark, sf), "reviews"))


@query("upsert_bucketed", ORACLES["upsert_features"])
def upsert_bucketed(spark, sf):
    """The upsert as a third table of the same buckets."""
    stored, fresh = _bucketed(_partial(spark, sf), "features"), _bucketed(I.features(spark, sf), "features")
    return bucketed.upsert_bucketed(stored, fresh, bucketed.fresh_table("features"), BUCKETS)


@query("resolve_deltas", S.ALL_FEATURES.rstrip() + f""", {STORED_SQL}
select coalesce(p.review_id, f.review_id) as review_id,
  {", ".join(f"case when p.review_id is not null then p.{c} else f.{c} end as {c}" for c in STABLE_COLS)},
  {", ".join(f"case when f.review_id is not null then f.{c} else p.{c} end as {c}" for c in MODEL_COLS)}
from partial p full join features f on p.review_id = f.review_id""")
def deltas(spark, sf):
    old = _partial(spark, sf).withColumn("batch_id", F.lit(0))
    return FT.resolve_deltas(old.unionByName(I.features(spark, sf).withColumn("batch_id", F.lit(1))))


@query("cascade_features", f"""with {S.RAW}, {STORED_SQL}
select p.* from partial p where exists (select 1 from raw r where r.review_id = p.review_id)""")
def cascade(spark, sf):
    return FT.cascade_features(_partial(spark, sf), I.reviews(spark, sf))


@query("key_violations", """select conv_id, count(*) as n_rows from conversations group by conv_id having count(*) > 1""")
def key_violations(spark, sf):
    return K.key_violations(read_table(spark, sf, "conversations"), "conv_id")


@query("assign_ids", """select row_number() over (order by md5(cast(doc_id as varchar)), doc_id) as feature_id, doc_id from documents""")
def assign_ids(spark, sf):
    return K.assign_ids(read_table(spark, sf, "documents").select("doc_id"), "doc_id", "feature_id")


@query("extract_conversations", f"""with turns as (
  select struct_pack(conv_id := conv_id, turn := turn) as review_id, cast(1 + turn % 5 as double) as rating, text as review_text, role from conversations),
{S.features('turns')}
select review_id.conv_id as conv_id, review_id.turn as turn, {COLS} from features""")
def extract_conversations(spark, sf):
    """The same features over a second text source, whose key has two parts."""
    turns = read_table(spark, sf, "conversations").select(
        F.struct("conv_id", "turn").alias("review_id"), F.col("text").alias("review_text"),
        (F.col("turn") % 5 + 1).cast("double").alias("rating"))
    return extract_features(turns, I.sentiment_tables(spark)).select("review_id.*", *FEATURE_COLS)
