"""Model sentiment: a linear three-class head fitted on ratings, or a user's own model.

A pretrained network is not part of this library. Scores are therefore not
comparable with those of any particular network; the contract is the same:
three logits per text, softmax, ``compound = positive - negative``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.sentiment import model_sentiment_columns
from ..session import materialize, path_bytes, remove_path, shared_dir
from .lexicon import PLACE_SUMS, sentiment_token, sentiment_tokens
from .lookup import small
from .rowterms import free_name

CLASSES = ("w_neg", "w_neu", "w_pos")
# Places of the hashed tokens; the fitted head has three numbers for each.
HEAD_WIDTH = 1 << 16
# In each step of the fit every partition writes a gradient. Beyond the first few, a partition of hashed reviews
# holds so many times a gradient's bytes, so that what the steps write does not grow with the number of splits.
PART_OVER_GRADIENT = 48
FEW_PARTS = 5


@dataclass(frozen=True)
class PlaceWeights:
    """The fitted weights by place: sums over a row's tokens without a look into the table of tokens."""

    width: int
    model: LogisticRegressionModel
    bias: tuple[float, float, float]

    def sums(self, df: DataFrame, tokens: str) -> DataFrame:
        """Add ``PLACE_SUMS``: the weights of the array's tokens, each as often as it occurs."""
        counts, margin = free_name(df, "_counts"), free_name(df, "_margin")
        hashed = HashingTF(numFeatures=self.width, inputCol=tokens, outputCol=counts).transform(df)
        head = self.model.copy().setFeaturesCol(counts).setRawPredictionCol(margin).setProbabilityCol("").setPredictionCol("")
        margins = head.transform(hashed).withColumn(margin, vector_to_array(margin))
        return margins.withColumns({c: F.coalesce(F.get(margin, F.lit(k)) - b, F.lit(0.0))
                                    for k, (c, b) in enumerate(zip(PLACE_SUMS, self.bias))}).drop(counts, margin)


class FittedHead(tuple):
    """The pair of the head's table and its biases; ``places`` holds the same weights by place."""

    places: PlaceWeights


def weak_label(rating: Column) -> Column:
    """0 negative, 1 neutral, 2 positive, from the stars."""
    return F.when(rating <= 2, F.lit(0)).when(rating < 4, F.lit(1)).otherwise(F.lit(2))


def fit_head(reviews: DataFrame, width: int = HEAD_WIDTH, reg: float = 1e-3,
             max_iter: int = 50) -> FittedHead:
    """Fit token weights and biases on all rated reviews.

    The inputs are token shares per review, hashed into ``width`` places within the row, so the score of
    a review is a plain sum over its tokens. Every token of the rated reviews gets the weights of its place;
    a review without tokens is an empty vector. The hashed reviews are written once for the fit.
    """
    spark = reviews.sparkSession
    rated = reviews.where(F.col("rating").isNotNull()).select(
        weak_label(F.col("rating")).alias("target"), T.text_or_empty(F.col("review_text")).alias("text"))
    split = rated.withColumn("toks", F.transform(sentiment_tokens(F.col("text")), F.lower))
    hashed = HashingTF(numFeatures=width, inputCol="toks", outputCol="counts")
    shares = Normalizer(p=1.0, inputCol="counts", outputCol="features")
    head = LogisticRegression(featuresCol="features", labelCol="target", family="multinomial", regParam=reg,
                              maxIter=max_iter, standardization=False)
    path = shared_dir(spark, "features")
    try:
        hashed.transform(split).select("target", "counts").write.parquet(path)
        parts = path_bytes(spark, path) // (PART_OVER_GRADIENT * 8 * len(CLASSES) * width)
        counted = spark.read.parquet(path).coalesce(max(FEW_PARTS, parts))
        model = head.fit(shares.transform(counted))
    finally:
        remove_path(spark, path)
    bias = [float(b) for b in model.interceptVector.toArray()]
    bias += [0.0] * (len(CLASSES) - len(bias))
    # A token alone is a vector of its one place: its margins less the biases are its weights.
    # Repeats go before the tokens are trimmed, as that costs more than to split the text.
    raw = rated.select(F.explode(T.spaced_tokens(F.col("text"))).alias("token")).distinct()
    tokens = raw.select(F.lower(sentiment_token(F.col("token"))).alias("token")).distinct()
    margins = model.transform(hashed.transform(tokens.withColumn("toks", F.array("token")))
                              .withColumnRenamed("counts", "features")).select(
        "token", vector_to_array("rawPrediction").alias("margin"))
    weights = [F.coalesce(F.get("margin", F.lit(k)) - b, F.lit(0.0)).alias(c)
               for k, (c, b) in enumerate(zip(CLASSES, bias))]
    fitted = FittedHead((materialize(margins.select("token", *weights), "head"), tuple(bias)))
    fitted.places = PlaceWeights(width, model, tuple(bias))
    return fitted


def score_with(reviews: DataFrame, load_model: Callable[[], Callable[[list[str]], "pd.DataFrame"]],
               text_col: str = "review_text") -> DataFrame:
    """Score with a user's model, loaded once per Python worker.

    ``load_model()`` returns a function from texts to a frame with the logits
    ``neg, neu, pos``. Whole texts are passed; any cut is the model's own.
    """
    @F.pandas_udf("neg double, neu double, pos double")
    def logits(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = load_model()
        for texts in batches:
            yield model(texts.fillna("").tolist())[["neg", "neu", "pos"]].reset_index(drop=True)

    text = T.text_or_empty(F.col(text_col))
    scored = reviews.withColumn("logits", logits(text))
    blank = F.length(T.strip_space(text)) == 0
    return scored.withColumns(
        model_sentiment_columns(F.col("logits.neg"), F.col("logits.neu"), F.col("logits.pos"), blank)).drop("logits")


def pos_density(reviews: DataFrame, pos_lexicon: DataFrame, text_col: str = "review_text") -> DataFrame:
    """Verbs plus adjectives per noun, from a user's ``token, pos`` table.

    ``pos`` is ``VERB``, ``ADJ`` or ``NOUN``; words not in the table count nowhere.
    """
    rows = reviews.select("review_id", F.explode_outer(T.words(T.text_or_empty(F.col(text_col)))).alias("token"))
    tagged = rows.join(small(pos_lexicon.where(F.col("pos").isin("VERB", "ADJ", "NOUN"))), "token", "left")
    counts = tagged.groupBy("review_id").agg(
        F.count_if(F.col("pos") == "VERB").alias("n_verbs"), F.count_if(F.col("pos") == "ADJ").alias("n_adjectives"),
        F.count_if(F.col("pos") == "NOUN").alias("n_nouns"))
    return counts.withColumn(
        "pos_density", T.ratio(F.col("n_verbs") + F.col("n_adjectives"), F.col("n_nouns")))
