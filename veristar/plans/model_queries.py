"""Terms, training data, models, scores and explanations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import verdict as V
from ..operators import attribution as A
from ..operators import evaluation as E
from ..operators import scoring as SC
from ..operators import terms as TM
from ..operators import training as TR
from ..operators.features import FEATURE_COLS, extract_features
from ..operators.keys import stratified_split
from ..operators.scaling import fit_scaler, scaled_values
from ..session import materialize, shared_dir
from ..sources import columns, readers, writers
from . import inputs as I
from . import sql as S
from .registry import ORACLES, query

TARGET = f"case when upper(regexp_replace(label, '^[{S.SPACE}]+|[{S.SPACE}]+$', '', 'g')) in ('CG', '1', 'FAKE') then 1 else 0 end"
TERMS = f"with {S.RAW},\n{S.STORED},\n{S.term_ctes('stored', I.STOP_WORDS)}"
SCORED = (S.ALL_FEATURES.rstrip() + ",\n" + S.term_ctes("stored", I.STOP_WORDS) + ",\n"
          + S.coefficient_cte() + ",\n" + S.score_ctes() + "\n")
# Feature table as it is stored: model columns missing for the reviews of one source.
HOLES = ", ".join(f"case when category = 'src2' then 0.0 else coalesce({c}, 0.0) end as {c}" for c in
                  ("model_sentiment", "model_rating_gap", "sentiment_dissonance"))


@query("tfidf_terms", TERMS + "\nselect review_id, term, tf from terms")
def tfidf_terms(spark, sf):
    return TM.term_counts(I.reviews(spark, sf), I.STOP_WORDS)


@query("tfidf_vocab", TERMS + f",\n{S.vocabulary_ctes()}\nselect term, total, df from vocab")
def tfidf_vocab(spark, sf):
    return TM.fit_vocabulary(I.reviews(spark, sf), I.STOP_WORDS).table.select("term", "total", "df")


@query("tfidf", TERMS + f""",\n{S.vocabulary_ctes()}
select review_id, term, round(w / sqrt(sum(w * w) over (partition by review_id)), 6) as weight from weights""")
def tfidf(spark, sf):
    reviews = I.reviews(spark, sf)
    vocabulary = TM.fit_vocabulary(reviews, I.STOP_WORDS)
    return TM.tfidf(reviews, vocabulary).select("review_id", "term", F.round("weight", 6).alias("weight"))


def _stored_features(spark, sf):
    found = extract_features(I.reviews(spark, sf), I.sentiment_tables(spark), ("category",))
    holes = {c: F.when(F.col("category") != "src2", F.col(c)) for c in TR.MODEL_COLS}
    return found.withColumns(holes).drop("category")


@query("training_set", S.ALL_FEATURES + f"""select review_id, review_text, label,
  punctuation_freq, vocab_diversity, readability_score, avg_sentence_length, sentiment_score, rating_sentiment_gap,
  {HOLES},
  {TARGET} as target from features""")
def training_set(spark, sf):
    return TR.training_set(_stored_features(spark, sf), I.reviews(spark, sf))


@query("stratified_split", f"""with {S.RAW}, t as (select review_id, {TARGET} as target from raw),
c as (select target, count(*) as n_c, sum(count(*)) over () as n from t group by target),
x as (select *, n - cast(ceil(0.2::double * n) as bigint) as n_train from c),
q as (select *, floor(n_train * n_c / n::double) as base, n_train * n_c / n::double - floor(n_train * n_c / n::double) as frac from x),
k as (select *, base + case when row_number() over (order by frac desc, target) <= n_train - sum(base) over () then 1 else 0 end as quota from q),
r as (select review_id, target, row_number() over (partition by target order by md5('42-' || cast(review_id as varchar)), review_id) as place from t)
select r.review_id, r.target, place <= n_c - quota as is_test from r join k using (target)""")
def split(spark, sf):
    rows = I.raw_reviews(spark, sf).select("review_id", V.target_of(F.col("label")).alias("target"))
    return stratified_split(rows, "review_id")


@query("scale_features", S.ALL_FEATURES.rstrip() + ", long as (" + " union all ".join(
    f"select review_id, '{c}' as feature, coalesce({c}, 0.0) as v from features" for c in FEATURE_COLS) + """),
s as (select feature, avg(v) as m, stddev_pop(v) as d from long group by feature)
select review_id, feature, round((v - m) / case when d = 0 then 1.0 else d end, 6) as value from long join s using (feature)""")
def scale_features(spark, sf):
    # Read by the fit and by the transform: written once.
    rows = materialize(I.features(spark, sf).na.fill(0.0), "features")
    scaled = scaled_values(rows, fit_scaler(rows, FEATURE_COLS), FEATURE_COLS)
    return scaled.select("review_id", "feature", F.round("value", 6).alias("value"))


@query("score_linear", SCORED + "select review_id, round(p, 4) as probability from scored")
def score_linear(spark, sf):
    scored = SC.score_linear(I.features(spark, sf), I.reviews(spark, sf), I.coefficients(spark), I.STOP_WORDS)
    return scored.select("review_id", F.round("probability", 4).alias("probability"))


@query("classify", SCORED + """select review_id, round(p, 4) as deceptive_probability, round(p * 100, 2) as deceptive_percentage,
  p >= 0.5 as is_deceptive, case when p >= 0.5 then 'Computer-Generated / Deceptive' else 'Original / Authentic' end as classification,
  case when p >= 0.5 then 'DECEPTIVE' else 'GENUINE' end as class_code from scored""")
def classify(spark, sf):
    scored = SC.extract_and_score(I.reviews(spark, sf), I.sentiment_tables(spark), I.coefficients(spark), I.STOP_WORDS)
    return SC.classify(scored).select(
        "review_id", "deceptive_probability", "deceptive_percentage", "is_deceptive", "classification", "class_code")


@query("risk_flags", S.ALL_FEATURES + f"""select review_id, cast(len(f) as int) as n_flags,
  case when len(f) = 0 then 'None' else array_to_string(f, ', ') end as risk_factors
from (select review_id, {S.flag_list()} as f from features)""")
def risk_flags(spark, sf):
    flagged = SC.risk_flags(I.features(spark, sf))
    return flagged.select("review_id", F.size("risk_factors").alias("n_flags"),
                          V.flags_text(F.col("risk_factors")).alias("risk_factors"))


SCAN = SCORED.rstrip() + f""",
scan as (select review_id, category, rating, round(p * 100, 2) as deceptive_probability_pct,
  case when p >= 0.5 then 'DECEPTIVE' else 'GENUINE' end as classification,
  case when len({S.flag_list()}) = 0 then 'None' else array_to_string({S.flag_list()}, ', ') end as risk_factors,
  sentiment_score as lexicon_sentiment, model_sentiment, sentiment_dissonance, vocab_diversity, readability_score
  from scored)
"""


def _scan(spark, sf):
    rows = columns.as_reviews(I.raw_reviews(spark, sf))
    return SC.scan(rows, I.sentiment_tables(spark), I.coefficients(spark), I.STOP_WORDS, ("category", "rating"))


@query("batch_scan", SCAN + "select * from scan")
def batch_scan(spark, sf):
    return _scan(spark, sf)


@query("filter_class", SCAN + "select * from scan where classification = 'DECEPTIVE'")
def filter_class(spark, sf):
    return SC.filter_class(_scan(spark, sf), "deceptive")


@query("scan_summary", SCAN + """select count(*) as total, count(*) filter (classification = 'DECEPTIVE') as deceptive,
  count(*) filter (classification <> 'DECEPTIVE') as genuine,
  round(count(*) filter (classification = 'DECEPTIVE') * 100.0::double / count(*), 1) as deceptive_pct from scan""")
def scan_summary(spark, sf):
    return SC.scan_summary(_scan(spark, sf))


@query("scan_summary_written", ORACLES["scan_summary"])
def scan_summary_written(spark, sf):
    """The same numbers, counted by the job that writes the scan's rows."""
    return writers.write_scan(_scan(spark, sf), shared_dir(spark, "scan"))


def _key(token: str) -> str:
    return f"lower(regexp_replace({token}, '[^\\p{{L}}\\p{{N}}_]', '', 'g'))"


ESCAPED = ("replace(replace(replace(replace(replace(tok, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), "
           "'''', '&#x27;')")
NAMED = S.values([(f, w) for f, w, *_ in I.NUMBER_WEIGHTS] + [(f, w) for f, w, _ in I.TEXT_WEIGHTS], "key, weight")
CHUNK_CTES = f"""word_weights as (select * from {NAMED}),
chunk as (select review_id, unnest(c) as chunk, generate_subscripts(c, 1) - 1 as pos from (
  select review_id, regexp_extract_all(text_, '[^{S.SPACE}]+[{S.SPACE}]*|[{S.SPACE}]+') as c from raw)),
piece as (select *, regexp_replace(chunk, '[{S.SPACE}]+$', '') as tok from chunk),
hit as (select review_id, pos, chunk, tok, weight, case when weight > 0.3 then 'strong_deceptive' when weight > 0.05 then 'mild_deceptive'
  when weight < -0.3 then 'strong_authentic' when weight < -0.05 then 'mild_authentic' else 'neutral' end as band
  from piece left join word_weights on word_weights.key = {_key('tok')})
"""
CHUNKS = f"with {S.RAW}, {CHUNK_CTES}"


def _span(name: str) -> str:
    start, rest = A.SPANS[name].split("{w}")
    middle, end = rest.split("{t}")
    w = "cast(cast(weight as decimal(18,2)) as varchar)"
    return f"when '{name}' then {S.text(start)} || {w} || {S.text(middle)} || {ESCAPED} || {S.text(end)}"


@query("word_attribution", CHUNKS + "select review_id, cast(pos as int) as pos, tok as token, weight, band from hit where weight is not null")
def word_attribution(spark, sf):
    return A.word_attribution(I.reviews(spark, sf), I.coefficients(spark))


HTML_CTE = f"""html as (
  select review_id, string_agg(case band {" ".join(map(_span, A.SPANS))} else {ESCAPED} end || substr(chunk, length(tok) + 1), '' order by pos) as h
  from hit group by review_id)"""


@query("explain_words", CHUNKS + f", {HTML_CTE} select review_id, coalesce(h, '') as explained_html from raw left join html using (review_id)")
def explain_words(spark, sf):
    return A.explain_words(I.reviews(spark, sf), I.coefficients(spark))


@query("analyze", f"""{SCORED.rstrip()}, {CHUNK_CTES}, {HTML_CTE} select review_id, review_text, rating, round(p, 4) as deceptive_probability,
  round(p * 100, 2) as deceptive_percentage, p >= 0.5 as is_deceptive,
  case when p >= 0.5 then 'Computer-Generated / Deceptive' else 'Original / Authentic' end as classification,
  {", ".join(FEATURE_COLS)}, array_to_string({S.flag_list()}, '; ') as flags, coalesce(h, '') as explained_html
  from scored left join html using (review_id)""")
def analyze(spark, sf):
    found = SC.analyze(I.reviews(spark, sf), I.sentiment_tables(spark), I.coefficients(spark), I.STOP_WORDS)
    return found.select(
        "review_id", "review_text", "rating", "deceptive_probability", "deceptive_percentage", "is_deceptive",
        "classification", "features.*", F.array_join("risk_factors", "; ").alias("flags"), "explained_html")


PREDICTED = SCORED.rstrip() + f""", predicted as (
  select {TARGET} as target, p, case when p >= 0.5 then 1 else 0 end as prediction from scored),
counts as (select count(*) filter (target = 0 and prediction = 0) as tn, count(*) filter (target = 0 and prediction = 1) as fp,
  count(*) filter (target = 1 and prediction = 0) as fn, count(*) filter (target = 1 and prediction = 1) as tp from predicted)
"""


def _predicted(spark, sf):
    """Scores of all reviews with their target; the label travels along."""
    rows = I.reviews(spark, sf)
    scored = SC.extract_and_score(rows, I.sentiment_tables(spark), I.coefficients(spark), I.STOP_WORDS, ("label",))
    return scored.select(V.target_of(F.col("label")).alias("target"), "probability",
                         V.is_deceptive(F.col("probability")).cast("int").alias("prediction"))


@query("confusion_matrix", PREDICTED + "select tn, fp, fn, tp from counts")
def confusion_matrix(spark, sf):
    counts = E.confusion_counts(_predicted(spark, sf))
    matrix = E.confusion_matrix(counts).select(F.col("confusion_matrix").alias("m"))
    cell = lambda i, j: F.get(F.get("m", F.lit(i)), F.lit(j))
    return matrix.select(cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp"))


@query("classification_metrics", PREDICTED + """select round(cast(tp + tn as double) / (tp + tn + fp + fn), 6) as accuracy,
  case when tp + fp = 0 then 0.0 else round(cast(tp as double) / (tp + fp), 6) end as precision,
  case when tp + fn = 0 then 0.0 else round(cast(tp as double) / (tp + fn), 6) end as recall,
  case when 2 * tp + fp + fn = 0 then 0.0 else round(cast(2 * tp as double) / (2 * tp + fp + fn), 6) end as f1_score from counts""")
def classification_metrics(spark, sf):
    metrics = E.classification_metrics(E.confusion_counts(_predicted(spark, sf)))
    return metrics.select(*[F.round(m, 6).alias(m) for m in E.METRICS[:4]])


@query("roc_auc", PREDICTED.rstrip() + """, ranked as (
  select target, avg(place) over (partition by s) as r from (
    select target, round(p, 9) as s, row_number() over (order by round(p, 9)) as place from predicted))
select round((sum(r) filter (target = 1) - count(*) filter (target = 1) * (count(*) filter (target = 1) + 1) / 2.0)
  / (count(*) filter (target = 1) * count(*) filter (target = 0)), 6) as roc_auc from ranked""")
def roc_auc(spark, sf):
    # Rounded to nine digits so that both engines see the same ties.
    scores = _predicted(spark, sf).select("target", F.round("probability", 9).alias("probability"))
    return E.roc_auc(scores).select(F.round("roc_auc", 6).alias("roc_auc"))


def _rule_report(spark, sf):
    """Five one-feature classifiers as models: each flags reviews above a mean."""
    labelled = I.labelled_features(spark, sf).select(V.target_of(F.col("label")).alias("target"), *RULES)
    rows = materialize(labelled, "rules")
    means = rows.agg(*[F.avg(c).alias(f"m_{c}") for c in RULES]).first()
    flagged = rows.select("target", F.inline(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("model"),
                 (F.col(c) > means[f"m_{c}"]).cast("int").alias("prediction")) for i, c in enumerate(RULES)])))
    return E.rule_auc(E.classification_metrics(E.confusion_counts(flagged, ["position", "model"])))


RULES = ["punctuation_freq", "vocab_diversity", "readability_score", "avg_sentence_length", "sentiment_score"]
RULE_SQL = S.CLEAN_FEATURES.rstrip() + ", long as (" + " union all ".join(
    f"select {i} as position, '{c}' as model, {TARGET} as target, case when {c} > avg({c}) over () then 1 else 0 end as prediction from features"
    for i, c in enumerate(RULES)) + """),
cells as (select position, model, count(*) filter (target = 0 and prediction = 0) as tn, count(*) filter (target = 0 and prediction = 1) as fp,
  count(*) filter (target = 1 and prediction = 0) as fn, count(*) filter (target = 1 and prediction = 1) as tp from long group by position, model),
report as (select position, model, tn, fp, fn, tp, round(cast(tp + tn as double) / (tp + tn + fp + fn), 6) as accuracy,
  case when tp + fp = 0 then 0.0 else round(cast(tp as double) / (tp + fp), 6) end as precision,
  case when tp + fn = 0 then 0.0 else round(cast(tp as double) / (tp + fn), 6) end as recall,
  case when 2 * tp + fp + fn = 0 then 0.0 else round(cast(2 * tp as double) / (2 * tp + fp + fn), 6) end as f1_score,
  round((cast(tp as double) / nullif(tp + fn, 0) + cast(tn as double) / nullif(tn + fp, 0)) / 2, 6) as roc_auc from cells)
"""


@query("model_leaderboard", RULE_SQL.rstrip() + ", l as (" + " union all ".join(
    f"select model, '{m}' as metric, {m} as value from report" for m in E.METRICS) + """)
select model, metric, value, value = max(value) over (partition by metric) as is_best from l""")
def model_leaderboard(spark, sf):
    rounded = _rule_report(spark, sf).select("model", *[F.round(m, 6).alias(m) for m in E.METRICS])
    return E.leaderboard(rounded)


@query("best_model", RULE_SQL + "select model, roc_auc from report order by roc_auc desc, position limit 1")
def best_model(spark, sf):
    """The rule of the largest area under its curve."""
    report = _rule_report(spark, sf).select("position", "model", F.round("roc_auc", 6).alias("roc_auc"))
    return E.best_model(report).select("model", "roc_auc")


# Coefficients fitted on the reviews: log-odds of each vocabulary term.
ODDS = f"""odds as (select v.term as feature, round(ln((count(*) filter (t.target = 1) + 1.0::double) / (count(*) filter (t.target = 0) + 1.0::double)), 6) as weight
  from vocab v join terms x on x.term = v.term join (select review_id, {TARGET} as target from stored) t on t.review_id = x.review_id group by v.term)"""


@query("coef_ranking", TERMS + f""",\n{S.vocabulary_ctes()},
{ODDS},
low as (select *, 'negative' as side from odds order by weight, feature limit 15),
high as (select *, 'positive' as side from odds order by weight desc, feature desc limit 15)
select feature, weight, side, case when weight > 0 then '#EF4444' else '#10B981' end as color from (select * from low union all select * from high)""")
def coef_ranking(spark, sf):
    reviews = I.reviews(spark, sf)
    return TR.coef_ranking(term_odds(reviews, TM.fit_vocabulary(reviews, I.STOP_WORDS)))


def term_odds(reviews, vocabulary):
    """``idx, kind, feature, weight``: log-odds of each term of the vocabulary."""
    labelled = reviews.withColumn("target", V.target_of(F.col("label")))
    present = F.expr(f"array_distinct({TM.known_only(vocabulary.table, 'term')})")
    found = (
        TM.token_arrays(labelled, I.STOP_WORDS, keep=("target",)).select("target", F.explode(present).alias("term"))
        .join(F.broadcast(vocabulary.table.select("term", "idx")), "term").groupBy("term", "idx")
        .agg(F.count_if(F.col("target") == 1).alias("n1"), F.count_if(F.col("target") == 0).alias("n0"))
    )
    return found.select("idx", F.lit("text").alias("kind"), F.col("term").alias("feature"),
                        F.round(F.log((F.col("n1") + 1.0) / (F.col("n0") + 1.0)), 6).alias("weight"))


def _prepared(spark, sf):
    kept = materialize(I.cleaned(spark, sf), "cleaned", "review_id")
    found = extract_features(kept, I.sentiment_tables(spark))
    return TR.prepare(materialize(TR.training_set(found, kept), "training", "review_id"), I.STOP_WORDS)


SPLIT = """c as (select target, count(*) as n_c, sum(count(*)) over () as n from t group by target),
x as (select *, n - cast(ceil(0.2::double * n) as bigint) as n_train from c),
q as (select *, floor(n_train * n_c / n::double) as base, n_train * n_c / n::double - floor(n_train * n_c / n::double) as frac from x),
k as (select *, base + case when row_number() over (order by frac desc, target) <= n_train - sum(base) over () then 1 else 0 end as quota from q),
r as (select review_id, target, row_number() over (partition by target order by md5('42-' || cast(review_id as varchar)), review_id) as place from t),
train as (select r.review_id from r join k using (target) where place > n_c - quota)"""


@query("feature_union", S.CLEAN_FEATURES.rstrip() + f""",
t as (select *, {TARGET} as target from features),
{SPLIT},
long as (""" + " union all ".join(
    f"select review_id, {i} as idx, coalesce({c}, 0.0) as v from t" for i, c in enumerate(FEATURE_COLS)) + f"""),
s as (select idx, avg(v) as m, stddev_pop(v) as d from long where review_id in (select review_id from train) group by idx),
{S.term_ctes("t", I.STOP_WORDS)},
vocab as (select *, row_number() over (order by term) - 1 as idx from (
  select term, count(*) as df, sum(tf) as total from terms where review_id in (select review_id from train)
  group by term order by total desc, term limit 2000)),
w as (select review_id, idx, (1 + ln(tf)) * (ln(cast(1 + (select count(*) from train) as double) / (1 + df)) + 1) as w
  from terms join vocab using (term))
select review_id, cast(idx as int) as idx, round((v - m) / case when d = 0 then 1.0 else d end, 6) as value from long join s using (idx)
union all
select review_id, cast(idx + {len(FEATURE_COLS)} as int), round(w / sqrt(sum(w * w) over (partition by review_id)), 6) from w""")
def feature_union(spark, sf):
    """The hybrid features of every cleaned review, fitted on the train part: scaled numbers, then TF-IDF terms."""
    prepared = _prepared(spark, sf)
    vectors = prepared.train.unionByName(prepared.test).select("review_id", F.unwrap_udt("features").alias("f"))
    entries = vectors.select("review_id", F.inline(F.arrays_zip(F.col("f.indices").alias("idx"), F.col("f.values").alias("value"))))
    return entries.select("review_id", "idx", F.round("value", 6).alias("value"))


@query("score_fitted_terms", TERMS + f""",\n{S.vocabulary_ctes()},
{ODDS},
idf as (select term, ln(cast(1 + (select count(*) from tokens) as double) / (1 + df)) + 1 as idf from vocab),
z as (select review_id, sum((1 + ln(tf)) * idf * weight) / sqrt(sum(((1 + ln(tf)) * idf) * ((1 + ln(tf)) * idf))) as text_z
  from terms join idf on idf.term = terms.term join odds on odds.feature = terms.term group by review_id)
select stored.review_id, round(text_z, 6) as text_z from stored left join z using (review_id)""")
def score_fitted_terms(spark, sf):
    """The text part of the score by a fitted model of 2,000 terms (their log-odds)."""
    reviews = I.reviews(spark, sf)
    vocabulary = TM.fit_vocabulary(reviews, I.STOP_WORDS)
    model = term_odds(reviews, vocabulary).join(vocabulary.table.select("idx", "idf"), "idx")
    return SC.with_text_score(reviews, model, I.STOP_WORDS).select("review_id", F.round("text_z", 6).alias("text_z"))


@query("train_models")
def train_models(spark, sf):
    """All four estimators on the cleaned reviews, at the reference's settings."""
    prepared = _prepared(spark, sf)
    models = TR.estimators(prepared.n_train)
    return TR.compare(prepared, models).report


@query("score_batch")
def score_batch(spark, sf):
    """Train, save, load, and scan all reviews with the loaded bundle."""
    prepared = _prepared(spark, sf)
    models = TR.estimators(prepared.n_train)
    compared = {k: m for k, m in models.items() if k != "LinearSVC"}
    path = shared_dir(spark, "bundle")
    writers.save_bundle(path, TR.compare(prepared, compared), prepared)
    bundle = writers.load_bundle(spark, path)
    return SC.scan_bundle(I.reviews(spark, sf), I.sentiment_tables(spark), bundle)


@query("report_roundtrip", RULE_SQL + "select cast(position as bigint) as position, model, accuracy, precision, recall, f1_score, roc_auc, tn, fp, fn, tp from report")
def report_roundtrip(spark, sf):
    """Write the report as one JSON document and read it back."""
    path = shared_dir(spark, "report")
    report = _rule_report(spark, sf).withColumns({
        "confusion_matrix": F.array(F.array("tn", "fp"), F.array("fn", "tp")), **{
            m: F.round(m, 6) for m in E.METRICS}})
    writers.write_report(report, path)
    cells = {"tn": (0, 0), "fp": (0, 1), "fn": (1, 0), "tp": (1, 1)}
    return readers.read_report(spark, path).select(
        "position", "model", *E.METRICS, *[F.col("confusion_matrix")[i][j].alias(c) for c, (i, j) in cells.items()])
