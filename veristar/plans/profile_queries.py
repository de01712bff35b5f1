"""Profiling of raw reviews and features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import distributions as D
from ..operators import profiling as G
from ..operators.features import STABLE_COLS
from ..sources.readers import read_table
from . import inputs as I
from . import sql as S
from .registry import query

RAW = f"with {S.RAW}\n"
CLEAN = f"with {S.RAW},\n{S.CLEAN}\n"


@query("table_counts", RAW + """select 'raw_reviews' as table_name, count(*) as n_rows from raw
union all select 'labels', count(*) from labels union all select 'system_logs', count(*) from events""")
def table_counts(spark, sf):
    return G.table_counts({
        "raw_reviews": I.raw_reviews(spark, sf), "labels": read_table(spark, sf, "labels"),
        "system_logs": I.logs(spark, sf)})


@query("value_counts", RAW + "select label, count(*) as n_rows from raw where label is not null group by label")
def value_counts(spark, sf):
    return G.value_counts(I.raw_reviews(spark, sf), "label")


@query("target_counts", RAW + f"""select target, count(*) as n_rows from (
  select case when upper(regexp_replace(label, '^[{S.SPACE}]+|[{S.SPACE}]+$', '', 'g')) in ('CG', '1', 'FAKE') then 1 else 0 end as target
  from raw) group by target""")
def target_counts(spark, sf):
    from ..functions.verdict import target_of

    return G.value_counts(I.raw_reviews(spark, sf).select(target_of(F.col("label")).alias("target")), "target")


@query("rating_distribution", RAW + "select rating, count(*) as n_rows from raw where rating is not null group by rating order by rating")
def rating_distribution(spark, sf):
    return G.value_counts(I.raw_reviews(spark, sf), "rating", by_key=True)


@query("label_share", RAW + """select label, count(*) as n_rows, round(count(*) * 100.0::double / sum(count(*)) over (), 1) as pct
from raw where label is not null group by label""")
def label_share(spark, sf):
    return G.value_share(I.raw_reviews(spark, sf), "label")


RAW_COLS = ["review_id", "category", "rating", "label", "text_"]


@query("null_counts", RAW + " union all ".join(
    f"select '{c}' as column_name, count(*) filter ({c} is null) as n_null from raw" for c in RAW_COLS))
def null_counts(spark, sf):
    return G.null_counts(I.raw_reviews(spark, sf))


@query("column_info", RAW + " union all ".join(
    f"select {i} as position, '{c}' as column_name, '{kind}' as data_type, count({c}) as n_present from raw"
    for i, (c, kind) in enumerate(zip(RAW_COLS, ["bigint", "string", "double", "string", "string"]))))
def column_info(spark, sf):
    return G.column_info(I.raw_reviews(spark, sf))


@query("duplicate_count", RAW + """select count(*) - count(distinct text_) - count(distinct case when text_ is null then 1 end) as n_duplicates
from raw""")
def duplicate_count(spark, sf):
    return G.duplicate_count(I.raw_reviews(spark, sf))


def _describe(col: str, source: str) -> str:
    return f"""select '{col}' as feature, count({col}) as n, round(avg({col}), 4) as mean, round(stddev_samp({col}), 4) as std,
  cast(min({col}) as double) as min, round(quantile_cont({col}, 0.25), 6) as q25, round(quantile_cont({col}, 0.5), 6) as q50,
  round(quantile_cont({col}, 0.75), 6) as q75, cast(max({col}) as double) as max from {source}"""


@query("describe_numeric", RAW + _describe("rating", "raw") + " union all "
       + _describe("text_length", "(select cast(length(text_) as double) as text_length from raw)"))
def describe_numeric(spark, sf):
    raw = I.raw_reviews(spark, sf).select("rating", F.length("text_").alias("text_length"))
    return G.describe_numeric(raw, ["rating", "text_length"])


@query("text_length", CLEAN + "select review_id, cast(length(review_text) as int) as text_length from cleaned")
def text_length(spark, sf):
    return I.cleaned(spark, sf).select("review_id", F.length("review_text").alias("text_length"))


@query("length_hist", CLEAN + f""", l as (select cast(length(review_text) as double) as v from cleaned),
s as (select min(v) as lo, max(v) as hi from l),
b as (select case when hi = lo then 0 else cast(least(floor((v - lo) * {D.LENGTH_BINS} / (hi - lo)), {D.LENGTH_BINS - 1}) as int) end as bin, lo, hi from l, s)
select bin, round(lo + (hi - lo) / {D.LENGTH_BINS} * bin, 4) as bin_start, count(*) as n_rows from b group by bin, lo, hi""")
def length_hist(spark, sf):
    lengths = I.cleaned(spark, sf).select(F.length("review_text").alias("text_length"))
    return D.histogram(lengths, "text_length", D.LENGTH_BINS)


AGG = ", ".join(f"round(avg({c}), 4) as {c}" for c in STABLE_COLS)


@query("feature_means_by_label", S.CLEAN_FEATURES + f"select label, {AGG} from features group by label")
def feature_means_by_label(spark, sf):
    return G.grouped_means(I.labelled_features(spark, sf), "label", STABLE_COLS)


@query("gap_hist_by_label", S.CLEAN_FEATURES.rstrip() + f""",
s as (select min(rating_sentiment_gap) as lo, max(rating_sentiment_gap) as hi from features),
b as (select label, cast(least(floor((rating_sentiment_gap - lo) * {D.GAP_BINS} / (hi - lo)), {D.GAP_BINS - 1}) as int) as bin, lo, hi from features, s)
select label, bin, round(lo + (hi - lo) / {D.GAP_BINS} * bin, 4) as bin_start, count(*) as n_rows from b group by label, bin, lo, hi""")
def gap_hist_by_label(spark, sf):
    return D.histogram(I.labelled_features(spark, sf), "rating_sentiment_gap", D.GAP_BINS, ["label"])


@query("gap_kde", S.CLEAN_FEATURES.rstrip() + f""",
s as (select label, count(*) as n, min(rating_sentiment_gap) as lo, max(rating_sentiment_gap) as hi,
  stddev_samp(rating_sentiment_gap) * pow(count(*), -0.2::double) as h from features group by label),
g as (select label, point, lo + (hi - lo) / {D.DENSITY_POINTS - 1} * point as x, n, h from s, range({D.DENSITY_POINTS}) r(point))
select g.label, cast(point as int) as point, round(x, 6) as x,
  round(sum(exp(-pow((x - rating_sentiment_gap) / h, 2) / 2)) / (n * h * sqrt(2 * pi())), 6) as density
from g join features f on f.label = g.label group by g.label, point, x, n, h""")
def gap_kde(spark, sf):
    return D.density(I.labelled_features(spark, sf), "rating_sentiment_gap", "label")


@query("box_stats", S.CLEAN_FEATURES.rstrip() + ", long as (" + " union all ".join(
    f"select label, '{c}' as feature, {c} as v from features" for c in STABLE_COLS) + f"""),
q as (select label, feature, quantile_cont(v, 0.25) as q1, quantile_cont(v, 0.5) as q2, quantile_cont(v, 0.75) as q3 from long group by label, feature),
f as (select long.*, q1, q2, q3, v between q1 - {D.WHISKER}::double * (q3 - q1) and q3 + {D.WHISKER}::double * (q3 - q1) as inside from long join q using (label, feature))
select label, feature, round(q1, 6) as q25, round(q2, 6) as q50, round(q3, 6) as q75, min(v) filter (inside) as whisker_low,
  max(v) filter (inside) as whisker_high, count(*) filter (not inside) as n_outliers from f group by label, feature, q1, q2, q3""")
def box_stats(spark, sf):
    return D.box_stats(I.labelled_features(spark, sf), STABLE_COLS, "label")


@query("feature_corr", S.CLEAN_FEATURES + " union all ".join(
    f"select '{a}' as feature_x, '{b}' as feature_y, round(corr({a}, {b}), 2) as r from features"
    for a in STABLE_COLS for b in STABLE_COLS))
def feature_corr(spark, sf):
    return G.correlation_matrix(I.labelled_features(spark, sf), STABLE_COLS)
