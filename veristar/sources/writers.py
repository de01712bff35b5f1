"""Writers: CSV, appends, seeding, logs, snapshots, reports and model bundles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import cleaning
from ..operators.evaluation import METRICS
from ..operators.keys import append_ids
from ..operators.verdict_counts import scan_counts, summary_of
from .columns import normalize_columns
from .readers import first_existing, path_exists, read_raw_file
from .schemas import RAW_REVIEWS, SYSTEM_LOGS, empty_table, with_default_time


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV part files with a header; arrays and structs are written as JSON text."""
    flat = [
        F.to_json(c).alias(c) if kind.startswith(("array", "struct", "map")) else F.col(f"`{c}`")
        for c, kind in df.dtypes
    ]
    # An empty text is quoted, a missing one is not: both survive the way back.
    # Blanks at the edges of a value belong to it.
    df.select(*flat).write.mode(mode).options(
        header=True, escape='"', quote='"', emptyValue='""',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_counted(df: DataFrame, path: str, counts: dict[str, Column]) -> dict:
    """Write ``df`` and return aggregates of it, observed by the one job that writes.

    The rows are counted in the tasks that write them, and only finished tasks report, so a task that is run again counts once.
    """
    seen = Observation()
    df.observe(seen, *[c.alias(n) for n, c in counts.items()]).write.parquet(path)
    return seen.get


def write_clean(raw: DataFrame, path: str, text_col: str = "text_", id_col: str = "review_id") -> DataFrame:
    """Write the cleaned reviews and return the funnel, from one scan of ``raw``."""
    firsts = cleaning.marked_firsts(raw, text_col, id_col)
    n = F.count(F.lit(1))
    seen = Observation()
    # The marks are counted in front of the last filter, in the task that writes behind it.
    firsts.observe(seen, F.coalesce(F.sum("copies"), F.lit(0)).alias("raw"), n.alias("distinct_text"),
                   F.count_if("complete").alias("complete"), F.count_if("clean").alias("clean")) \
        .where("clean").select("row.*").write.parquet(path)
    return cleaning.funnel_rows(raw.sparkSession.createDataFrame([seen.get], cleaning.FUNNEL_SCHEMA))


def write_scan(scanned: DataFrame, path: str) -> DataFrame:
    """Write a scan's rows and return its summary, counted by the job that writes."""
    seen = write_counted(scanned, path, scan_counts())
    return summary_of(scanned.sparkSession.createDataFrame([seen], "total long, deceptive long"))


def ensure_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Create an empty table of the declared schema unless the path holds one."""
    if not path_exists(spark, path):
        empty_table(spark, name).write.mode("append").parquet(path)
    return spark.read.schema(empty_table(spark, name).schema).parquet(path)


def log_append(spark: SparkSession, path: str, stage: str, message: str) -> None:
    """Append one line to the log table."""
    row = append_ids(spark.range(1).select(F.lit(stage).alias("stage"), F.lit(message).alias("message")),
                     "log_id", _last_id(spark, path, "log_id"))
    row = with_default_time(row, "logged_at")
    append_table(row.select([F.col(f.name).cast(f.dataType) for f in SYSTEM_LOGS]), path)


def _last_id(spark: SparkSession, path: str, col: str) -> int:
    if not path_exists(spark, path):
        return 0
    return spark.read.parquet(path).agg(F.coalesce(F.max(col), F.lit(0)).alias("m")).first()["m"]


def seed_if_empty(spark: SparkSession, target: str, sources: list[str], log: str | None = None) -> int | None:
    """Load the first existing source unless the target holds rows.

    Returns the row count after loading, or ``None`` where nothing was loaded.
    """
    table = ensure_table(spark, target, "raw_reviews")
    if not table.isEmpty():
        return None
    source = first_existing(spark, sources)
    if source is None:
        return None
    rows = with_default_time(append_ids(normalize_columns(read_raw_file(spark, source)), "review_id"), "ingested_at")
    for f in RAW_REVIEWS:
        if f.name not in rows.columns:
            rows = rows.withColumn(f.name, F.lit(None))
    append_table(rows.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_REVIEWS]), target)
    n = spark.read.parquet(target).count()
    if log:
        log_append(spark, log, "db_setup", f"Seeded {n} rows into raw_reviews.")
    return n


def write_report(report: DataFrame, path: str) -> None:
    """``{model: {metric: value}}`` as one JSON document; a row per model."""
    entry = F.struct(*METRICS, "confusion_matrix")
    ordered = F.array_sort(F.collect_list(F.struct("position", "model", entry.alias("m"))))
    pairs = F.transform(ordered, lambda r: F.struct(r["model"], r["m"]))
    (report.agg(F.to_json(F.map_from_entries(pairs)).alias("value"))
     .coalesce(1).write.mode("overwrite").text(path))


@dataclass
class Bundle:
    """A stored model with what is needed to score with it."""

    model_name: str
    numerical_cols: list[str]
    feature_names: list[str]
    stop_words: list[str]
    metrics: DataFrame
    coefficients: DataFrame
    vocabulary: DataFrame
    scaler: DataFrame
    model: object
    n_reviews: int = 0


def save_bundle(path: str, comparison, prepared) -> None:
    """Write the best model, its preprocessing tables and the metadata below ``path``."""
    from ..operators.features import FEATURE_COLS
    from ..operators.training import coefficients

    spark = prepared.train.sparkSession
    model = comparison.models[comparison.best]
    model.write().overwrite().save(f"{path}/model")
    coefficients(model, prepared).write.mode("overwrite").parquet(f"{path}/coefficients")
    prepared.vocabulary.table.write.mode("overwrite").parquet(f"{path}/vocabulary")
    prepared.scaler.write.mode("overwrite").parquet(f"{path}/scaler")
    comparison.report.where(F.col("model") == comparison.best).write.mode("overwrite").json(f"{path}/metrics")
    meta = spark.range(1).select(
        F.lit(comparison.best).alias("model_name"),
        F.array(*map(F.lit, FEATURE_COLS)).alias("numerical_cols"),
        F.array(*map(F.lit, ["review_text", *FEATURE_COLS])).alias("feature_names"),
        F.array(*map(F.lit, prepared.vocabulary.stop_words)).alias("stop_words"),
        F.lit(prepared.vocabulary.n_reviews).alias("n_reviews"),
    )
    # Written last: its presence marks a complete bundle.
    meta.write.mode("overwrite").json(f"{path}/metadata")


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    from ..operators.features import FEATURE_COLS
    from ..operators.training import MODEL_CLASSES

    if not path_exists(spark, f"{path}/metadata"):
        raise FileNotFoundError(f"no trained model at {path}: train one and save it there first")
    meta = spark.read.json(f"{path}/metadata").first().asDict()
    return Bundle(
        model_name=meta["model_name"],
        numerical_cols=meta.get("numerical_cols") or list(FEATURE_COLS),
        feature_names=meta.get("feature_names") or ["review_text"],
        stop_words=meta.get("stop_words") or [],
        metrics=spark.read.json(f"{path}/metrics"),
        coefficients=spark.read.parquet(f"{path}/coefficients"),
        vocabulary=spark.read.parquet(f"{path}/vocabulary"),
        scaler=spark.read.parquet(f"{path}/scaler"),
        model=MODEL_CLASSES[meta["model_name"]].load(f"{path}/model"),
        n_reviews=meta.get("n_reviews") or 0,
    )
