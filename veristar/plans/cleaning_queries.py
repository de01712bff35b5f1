"""Cleaning, columns, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cleaning as C
from ..session import shared_dir
from ..sources import columns, readers, schemas, writers
from ..sources.file_order import FILE_ORDER, read_in_order
from . import inputs as I
from . import sql as S
from .registry import ORACLES, query

RAW = f"with {S.RAW}\n"
CLEAN = f"with {S.RAW},\n{S.CLEAN}\n"


@query("dedupe_first", RAW + """select review_id, category, rating, label, text_ from (
  select *, row_number() over (partition by text_ order by review_id) as n from raw) where n = 1""")
def dedupe_first(spark, sf):
    return C.dedupe_first(I.raw_reviews(spark, sf))


@query("clean_reviews", CLEAN + "select review_id, category, rating, label, review_text from cleaned")
def clean_reviews(spark, sf):
    return I.cleaned(spark, sf)


@query("clean_funnel", CLEAN + """select 1 as step_no, 'raw' as step, count(*) as n_rows from raw
union all select 2, 'distinct_text', count(*) from firsts where copy_no = 1
union all select 3, 'complete', count(*) from firsts where copy_no = 1 and text_ is not null and rating is not null and label is not null
union all select 4, 'clean', count(*) from cleaned""")
def clean_funnel(spark, sf):
    return C.clean_funnel(I.raw_reviews(spark, sf))


@query("clean_funnel_written", ORACLES["clean_funnel"])
def clean_funnel_written(spark, sf):
    """The same rows, counted by the job that writes the cleaned reviews."""
    return writers.write_clean(I.raw_reviews(spark, sf), shared_dir(spark, "cleaned"))


@query("clean_written", ORACLES["clean_reviews"])
def clean_written(spark, sf):
    """The cleaned reviews of that job."""
    path = shared_dir(spark, "cleaned")
    writers.write_clean(I.raw_reviews(spark, sf), path)
    return spark.read.parquet(path).withColumnRenamed("text_", "review_text")


# Files are written in the order of ids and hold no id: the first row of a text in file order is that of its smallest id.
@query("dedupe_file_order", RAW + """select category, rating, label, text_ from (
  select *, row_number() over (partition by text_ order by review_id) as n from raw) where n = 1""")
def dedupe_file_order(spark, sf):
    return C.dedupe_first(_in_file_order(spark, sf), id_col=FILE_ORDER).select("category", "rating", "label", "text_")


@query("head_file_order", RAW + "select category, rating, label, text_ from raw order by review_id limit 200")
def head_file_order(spark, sf):
    return columns.head_rows(_in_file_order(spark, sf), FILE_ORDER, 200).select("category", "rating", "label", "text_")


def _in_file_order(spark, sf):
    path = shared_dir(spark, "files")
    raw = I.raw_reviews(spark, sf).repartitionByRange(8, "review_id").sortWithinPartitions("review_id").drop("review_id")
    writers.write_csv(raw, path)
    return read_in_order(spark, path, raw.schema)


@query("normalize_columns", RAW + "select category, rating, label, text_ as review_text from raw")
def normalize_columns(spark, sf):
    return columns.normalize_columns(I.raw_reviews(spark, sf))


@query("csv_roundtrip", RAW + "select review_id, category, rating, label, text_ from raw")
def csv_roundtrip(spark, sf):
    path = shared_dir(spark, "csv")
    raw = I.raw_reviews(spark, sf)
    writers.write_csv(raw, path)
    return readers.read_csv(spark, path, raw.schema)


@query("append_table", RAW + """select category, count(*) as n_rows, sum(rating) as stars from (
  select category, rating from raw union all select category, rating from raw) group by category""")
def append_table(spark, sf):
    path = shared_dir(spark, "append")
    rows = I.raw_reviews(spark, sf).select("review_id", "category", "rating")
    writers.append_table(rows, path)
    writers.append_table(rows, path)
    return spark.read.parquet(path).groupBy("category").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("rating").alias("stars"))


@query("seed_if_empty", RAW + """select category, rating, label, count(*) as n_rows, cast(sum(length(text_)) as bigint) as n_chars
from raw group by category, rating, label""")
def seed_if_empty(spark, sf):
    """Seed from CSV, then again: the second call must leave the table alone."""
    base = shared_dir(spark, "seed")
    writers.write_csv(I.raw_reviews(spark, sf).drop("review_id"), f"{base}/raw")
    for _ in range(2):
        writers.seed_if_empty(spark, f"{base}/raw_reviews", [f"{base}/cleaned", f"{base}/raw"], f"{base}/logs")
    return spark.read.parquet(f"{base}/raw_reviews").groupBy("category", F.col("rating").cast("double").alias("rating"), "label").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.length("review_text")).alias("n_chars"))


@query("evolve_schema", """with r as (select doc_id as review_id, cast(n_chars as double) as sentiment_score from documents)
select review_id, sentiment_score, cast(null as double) as model_sentiment, cast(null as double) as model_rating_gap,
  cast(null as double) as sentiment_dissonance from r""")
def evolve_schema(spark, sf):
    from ..operators.feature_table import evolve_schema as evolve
    from ..operators.features import MODEL_COLS

    old = readers.read_table(spark, sf, "documents").select(
        F.col("doc_id").alias("review_id"), F.col("n_chars").cast("double").alias("sentiment_score"))
    return evolve(old, MODEL_COLS)


@query("head_rows", RAW + "select review_id, category, rating, label, text_ from raw order by review_id limit 200")
def head_rows(spark, sf):
    return columns.head_rows(I.raw_reviews(spark, sf), "review_id", 200)


@query("log_tail", """select event_id as log_id, event_type as stage, props as message, ts as logged_at
from events order by ts desc, event_id desc limit 10""")
def log_tail(spark, sf):
    return I.logs(spark, sf).orderBy(F.desc("logged_at"), F.desc("log_id")).limit(10)


@query("sql_scan", RAW + """select stage, count(*) as n_logs, max(logged_at) as last_at from (
  select event_type as stage, ts as logged_at from events) group by stage""")
def sql_scan(spark, sf):
    return readers.read_sql(
        spark, "select stage, count(*) as n_logs, max(logged_at) as last_at from {logs} group by stage",
        logs=I.logs(spark, sf))


@query("length_violations", """select event_id as log_id from events where length(event_type) > 4""")
def length_violations(spark, sf):
    return schemas.too_long(I.logs(spark, sf), {"stage": 4}).select("log_id")
