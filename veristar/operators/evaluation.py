"""Confusion matrix, metrics, exact ROC-AUC, leaderboard and model choice."""

from __future__ import annotations

from pyspark.ml.feature import QuantileDiscretizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

# Metric names, in report order.
METRICS = ["accuracy", "precision", "recall", "f1_score", "roc_auc"]


def confusion_counts(predictions: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """``tn, fp, fn, tp`` from ``target`` and ``prediction`` (0/1)."""
    def cell(target: int, prediction: int) -> Column:
        return F.count_if((F.col("target") == target) & (F.col("prediction") == prediction))

    return predictions.groupBy(*(keys or [])).agg(
        cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp"))


def confusion_matrix(counts: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """``[[tn, fp], [fn, tp]]``."""
    matrix = F.array(F.array("tn", "fp"), F.array("fn", "tp")).alias("confusion_matrix")
    return counts.select(*(keys or []), matrix)


def _share(top: Column, bottom: Column) -> Column:
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top / F.nullif(bottom, F.lit(0)))


def classification_metrics(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1; 0 where undefined."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return counts.withColumns({
        "accuracy": _share(tp + tn, tp + tn + fp + fn),
        "precision": _share(tp, tp + fp),
        "recall": _share(tp, tp + fn),
        "f1_score": _share(2 * tp, 2 * tp + fp + fn),
    })


def rule_auc(counts: DataFrame) -> DataFrame:
    """Add ``roc_auc`` of a yes/no rule: its curve has one corner, at (FPR, TPR). Missing without both classes."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return counts.withColumn("roc_auc", (tp / F.nullif(tp + fn, F.lit(0)) + tn / F.nullif(tn + fp, F.lit(0))) / 2)


def roc_auc(scores: DataFrame, score: str = "probability", target: str = "target", buckets: int = 1000) -> DataFrame:
    """Exact area under the ROC curve; ties count half.

    Rows are reduced to distinct scores. Those are cut into even value ranges,
    so the running count of negatives is a window per range plus the total of
    the ranges before it: no task sorts all scores.
    """
    grouped = scores.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(target) == 1).cast("double").alias("pos"),
        F.count_if(F.col(target) == 0).cast("double").alias("neg"),
    )
    # Used by the cut and by both passes below.
    grouped = materialize(grouped, "scores")
    cutter = QuantileDiscretizer(numBuckets=buckets, inputCol="score", outputCol="range", relativeError=0.0005)
    ranged = cutter.fit(grouped).transform(grouped)
    inside = Window.partitionBy("range").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("range").agg(F.sum("neg").alias("range_neg"))
    # At most ``buckets`` rows.
    totals = totals.select("range", F.coalesce(F.sum("range_neg").over(before), F.lit(0.0)).alias("neg_before"))
    return (
        ranged.withColumn("run", F.sum("neg").over(inside)).join(F.broadcast(totals), "range")
        .withColumn("below", F.col("neg_before") + F.coalesce("run", F.lit(0.0)))
        .agg(F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2)).alias("wins"),
             F.sum("pos").alias("p"), F.sum("neg").alias("n"))
        .select((F.col("wins") / F.nullif(F.col("p") * F.col("n"), F.lit(0.0))).alias("roc_auc"))
    )


def leaderboard(report: DataFrame, metrics: list[str] = METRICS) -> DataFrame:
    """Long form ``model, metric, value, is_best``; a handful of rows per metric."""
    long = report.select("model", F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics])))
    best = F.max("value").over(Window.partitionBy("metric"))
    return long.withColumn("is_best", F.col("value") == best)


def best_model(report: DataFrame) -> DataFrame:
    """Highest AUC; the earlier model wins a tie."""
    return report.orderBy(F.desc("roc_auc"), "position").limit(1)
