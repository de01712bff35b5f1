"""Training set, hybrid features, the model comparison and its artefacts."""

from __future__ import annotations

from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.ml.classification import (
    LinearSVC, LinearSVCModel, LogisticRegression, LogisticRegressionModel,
    RandomForestClassificationModel, RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.verdict import target_of
from ..session import local_table, shared_dir
from . import evaluation as E
from .features import FEATURE_COLS, MODEL_COLS
from .keys import stratified_split
from .rowterms import number_array, with_counts
from .scaling import fit_scaler
from .sgd import SGDLogLoss
from .terms import MAX_TERMS, Vocabulary, fit_vocabulary, known_terms, tokens
from .vectors import materialize_vectors

# Hyper-parameters of the compared models.
TEST_SHARE = 0.20
SEED = 42
LOGISTIC_C = 2.0
SGD_ALPHA = 1e-4
MAX_ITER = 1000
FOREST_TREES, FOREST_DEPTH = 100, 18
# Fewer rows per task than this cost more in scheduling than in arithmetic.
ROWS_PER_TASK = 2000

MODEL_CLASSES = {
    "LogisticRegression": LogisticRegressionModel,
    "SGDClassifier_LogLoss": LogisticRegressionModel,
    "RandomForest": RandomForestClassificationModel,
    "LinearSVC": LinearSVCModel,
}


def training_set(features: DataFrame, reviews: DataFrame) -> DataFrame:
    """Features joined with text and label; gaps filled, target encoded."""
    joined = features.join(reviews.select("review_id", "review_text", "label"), "review_id")
    return joined.withColumns({
        "review_text": F.coalesce("review_text", F.lit("")),
        **{c: F.coalesce(c, F.lit(0.0)) for c in MODEL_COLS},
        "target": target_of(F.col("label")),
    })


@dataclass
class Prepared:
    """Fitted preprocessing and the written vectors of both parts."""

    vocabulary: Vocabulary
    scaler: DataFrame
    n_train: int
    train: DataFrame
    test: DataFrame


def prepare(data: DataFrame, stop_words: list[str], max_terms: int = MAX_TERMS,
            test_share: float = TEST_SHARE, seed: int = SEED) -> Prepared:
    """Split, fit scaler and vocabulary on the train part only, write all vectors once."""
    marked = stratified_split(data, "review_id", "target", test_share, seed)
    train = marked.where(~F.col("is_test"))
    scaler = fit_scaler(train, FEATURE_COLS)
    vocabulary = fit_vocabulary(train, stop_words, max_terms)
    vectors = materialize_vectors(vectorize(marked, scaler, vocabulary, max_terms, ("target", "is_test")))
    n_train = vectors.where(~F.col("is_test")).count()
    # Only ever merges the few rows of a small table; large tables keep their splits.
    vectors = vectors.coalesce(max(1, min(vectors.rdd.getNumPartitions(), -(-n_train // ROWS_PER_TASK))))
    return Prepared(vocabulary, scaler, n_train, vectors.where(~F.col("is_test")), vectors.where("is_test"))


def vectorize(data: DataFrame, scaler: DataFrame, vocabulary: Vocabulary, max_terms: int = MAX_TERMS,
              keep: tuple[str, ...] = ()) -> DataFrame:
    """Scaled numbers first, then the text terms of unit length: ``review_id``, kept columns and one sparse vector.

    The vector is put together inside the row: terms are counted against the vocabulary in one pass, weighed and
    normalised as arrays, and follow the numbers. No term leaves its row, so there is no shuffle, and
    rows that repeat an id have each their own vector. ``features`` has the stored layout of a sparse vector.
    """
    # A row for each number, and for each term of the vocabulary.
    numbers = sorted(scaler.collect(), key=lambda r: r["idx"])
    terms = sorted(vocabulary.table.select("term", "idx", "idf").collect(), key=lambda r: r["idx"])
    width = len(numbers)
    toks = tokens(F.coalesce("review_text", F.lit("")), vocabulary.stop_words)
    rows = data.withColumn("toks", toks)
    names = [r["term"] for r in terms]
    rows = with_counts(rows, F.expr(known_terms(names)), names, "_known")
    idf = number_array([r["idf"] for r in terms])
    weights = f"zip_with(_known.indices, _known.values, (i, n) -> (ln(n) + 1) * get({idf}, i))"
    length = "sqrt(aggregate(_weights, 0D, (x, w) -> x + w * w))"
    scaled = [(F.col(r["feature"]).cast("double") - F.lit(r["mean"])) / F.lit(r["std"]) for r in numbers]
    return rows.withColumn("_weights", F.expr(weights)).withColumn("_length", F.expr(length)).select(
        "review_id", *keep, F.struct(
            F.lit(0).cast("byte").alias("type"), F.lit(width + max_terms).alias("size"),
            F.concat(F.array(*[F.lit(i) for i in range(width)]), F.expr(f"transform(_known.indices, i -> i + {width})")).alias("indices"),
            F.concat(F.array(*scaled), F.expr("transform(_weights, w -> w / _length)")).alias("values")).alias("features"))


def estimators(n_train: int, forest_trees: int = FOREST_TREES, forest_depth: int = FOREST_DEPTH,
               max_iter: int = MAX_ITER, seed: int = SEED) -> dict:
    """The compared models, in report order.

    ``C`` weighs the summed loss, ``regParam`` the mean loss: regParam = 1 / (C n).
    The second model has the log-loss objective with penalty 1e-4 and is fitted by single-row gradient steps.
    """
    common = dict(featuresCol="features", labelCol="target")
    logistic = dict(common, maxIter=max_iter, elasticNetParam=0.0, standardization=False)
    return {
        "LogisticRegression": LogisticRegression(regParam=1.0 / (LOGISTIC_C * max(n_train, 1)), **logistic),
        "SGDClassifier_LogLoss": SGDLogLoss(alpha=SGD_ALPHA, max_iter=max_iter, seed=seed, **common),
        "RandomForest": RandomForestClassifier(
            numTrees=forest_trees, maxDepth=forest_depth, featureSubsetStrategy="sqrt", seed=seed, **common),
        "LinearSVC": LinearSVC(regParam=1.0 / max(n_train, 1), maxIter=max_iter, standardization=False,
                               **common),
    }


def predict(model, vectors: DataFrame) -> DataFrame:
    """``review_id, target, probability, prediction``; the margin stands in for the SVM."""
    score = "probability" if model.hasParam("probabilityCol") else "rawPrediction"
    out = model.transform(vectors)
    return out.select("review_id", "target", vector_to_array(score)[1].alias("probability"),
                      F.col("prediction").cast("int").alias("prediction"))


def model_probability(model, vectors: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``review_id``, kept columns and ``probability`` of any model that gives one."""
    return model.transform(vectors).select("review_id", *keep, vector_to_array("probability")[1].alias("probability"))


@dataclass
class Comparison:
    models: dict
    report: DataFrame
    best: str
    metrics: dict = field(default_factory=dict)


REPORT_FIELDS = ["position", "model", *E.METRICS, "confusion_matrix"]


def without_summary(spark: SparkSession, model):
    """The fitted model as it is read back from a file, without the summary of its training.

    The summary holds the session. A session that has observed the rows of a write can no longer be serialised, and
    then no model with a summary can be sent to the tasks that score with it.
    """
    if not model.hasSummary:
        return model
    path = shared_dir(spark, "model")
    model.write().save(path)
    return type(model).load(path)


def compare(prepared: Prepared, models: dict) -> Comparison:
    """Fit each estimator on the same vectors, evaluate on the test part, choose the best AUC."""
    spark = prepared.train.sparkSession
    fitted, rows = {}, []
    prepared.train.persist()
    for position, (name, estimator) in enumerate(models.items()):
        fitted[name] = without_summary(spark, estimator.fit(prepared.train))
        scored = predict(fitted[name], prepared.test).persist()
        counts = E.classification_metrics(E.confusion_counts(scored)).first().asDict()
        auc = E.roc_auc(scored).first()["roc_auc"]
        scored.unpersist()
        matrix = [[counts["tn"], counts["fp"]], [counts["fn"], counts["tp"]]]
        rows.append({"position": position, "model": name, **{m: counts.get(m) for m in E.METRICS},
                     "roc_auc": auc, "confusion_matrix": matrix})
    prepared.train.unpersist()
    report = report_table(spark, rows)
    # The margin of a support vector machine is no probability, so that model is shown but never chosen.
    calibrated = [name for name, m in fitted.items() if m.hasParam("probabilityCol")]
    best = E.best_model(report.where(F.col("model").isin(calibrated))).first()["model"]
    return Comparison(fitted, report, best, next(r for r in rows if r["model"] == best))


def report_table(spark: SparkSession, rows: list[dict]) -> DataFrame:
    kinds = [pa.int64(), pa.string(), *[pa.float64()] * len(E.METRICS), pa.list_(pa.list_(pa.int64()))]
    return local_table(spark, {n: (k, [r[n] for r in rows]) for n, k in zip(REPORT_FIELDS, kinds)})


def coefficients(model, prepared: Prepared) -> DataFrame:
    """Coefficient table of a linear model in feature order; empty for a forest.

    Columns: ``idx, kind, feature, weight, mean, std, idf``; names are lower case.
    """
    spark = prepared.train.sparkSession
    if not hasattr(model, "coefficients"):
        return linear_table(spark, [], [], [])
    weights = model.coefficients.toArray().tolist()
    scaler = prepared.scaler.orderBy("idx").collect()
    terms = prepared.vocabulary.table.orderBy("idx").collect()
    return linear_table(spark, scaler, terms, weights, model.intercept)


def linear_table(spark: SparkSession, scaler: list, terms: list, weights: list, intercept: float = 0.0) -> DataFrame:
    from ..sources.params import coefficient_table

    if not weights:
        return coefficient_table(spark, [])
    width = len(scaler)
    rows = [(-1, "intercept", "intercept", float(intercept), None, None, None)]
    rows += [(r["idx"], "num", r["feature"].lower(), weights[r["idx"]], r["mean"], r["std"], None) for r in scaler]
    rows += [(r["idx"] + width, "text", r["term"].lower(), weights[r["idx"] + width], None, None, r["idf"])
             for r in terms]
    return coefficient_table(spark, rows)


def coef_ranking(table: DataFrame, k: int = 15) -> DataFrame:
    """The ``k`` most negative and ``k`` most positive coefficients with their colour."""
    # Bar colours of the chart.
    red, green = "#EF4444", "#10B981"
    named = table.where(F.col("kind") != "intercept").select("feature", "weight")
    low = named.orderBy("weight", "feature").limit(k).withColumn("side", F.lit("negative"))
    high = named.orderBy(F.desc("weight"), F.desc("feature")).limit(k).withColumn("side", F.lit("positive"))
    return low.unionByName(high).withColumn(
        "color", F.when(F.col("weight") > 0, F.lit(red)).otherwise(F.lit(green)))
