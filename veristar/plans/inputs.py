"""The given tables seen as reviews, features, logs and parameter tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import clean_reviews
from ..operators.features import extract_features
from ..operators.lexicon import SentimentTables
from ..operators.lookup import small
from ..sources import params as P
from ..sources.readers import read_table

# Small parameter tables of the registered queries. The texts of
# the given tables hold invented words, so frequent ones play the roles.
LEXICON = {
    "the": 0.4, "of": -0.3, "best": 3.2, "no": -1.2, "la": 0.9, "der": -0.8, "que": 1.3, "thatin": 2.1,
    "rewh": -2.4, "ononst": 1.7, "und": 0.5, "von": -1.1, "les": 0.7, "with": 1.1, "was": -0.6, "orre": -1.9,
    "hehely": 2.8, "from": -1.4, "den": 0.3, "für": 1.6, "été": 2.2, "in": -0.9, "an": 0.2, "thon": -2.9,
}
BOOSTERS = {"is": 0.293, "to": 0.293, "en": 0.293, "und": 0.293, "that": -0.293, "for": -0.293, "die": -0.293}
# Entries of two words and more: overlapping ones, one inside another, of repeated words, and one that is a booster.
PHRASES = {
    "the the": 1.2, "the the the": -2.2, "of the": 0.7, "the of the": -1.6, "de la": 2.3, "la de": -1.9, "the and attion": 2.9,
    "attion to": -2.7, "orre orre": 0.6, "hehely hehely hehely": -1.3, "der der": 1.9, "in the": -0.4,
}
PHRASE_BOOSTERS = {"is the": 0.293, "und und": -0.293}
NEGATIONS = ["it", "nicht", "pas", "un", "by", "not"]
CONTRAST = "be"
HEAD = {
    "the": (0.2, 1.1, 2.0), "de": (2.4, 0.3, 0.1), "and": (0.1, 0.9, 1.2), "la": (0.4, 0.2, 3.1),
    "a": (1.0, 0.1, 0.8), "der": (3.3, 0.5, 0.2), "this": (0.1, 0.2, 4.0), "no": (5.1, 0.3, 0.2),
    "best": (0.1, 0.4, 6.0), "thatin": (0.3, 2.0, 1.5), "le": (1.2, 1.4, 0.6),
}
BIAS = (0.1, 0.4, 0.2)
POS_WORDS = {
    "is": "VERB", "was": "VERB", "are": "VERB", "est": "VERB", "ist": "VERB", "ha": "VERB",
    "best": "ADJ", "thatin": "ADJ", "orre": "ADJ", "rewh": "ADJ",
    "tion": "NOUN", "la": "NOUN", "ing": "NOUN", "hehely": "NOUN", "ea": "NOUN",
}
# Tag model in thousandths: words of several tags, an entry for unlisted words, and equal weights on purpose.
EMISSIONS = [
    ("is", "VERB", -900), ("is", "OTHER", -2300), ("was", "VERB", -700), ("are", "VERB", -800), ("the", "OTHER", -100), ("of", "OTHER", -200),
    ("best", "ADJ", -900), ("best", "NOUN", -1400), ("best", "VERB", -2100), ("thatin", "ADJ", -1200), ("thatin", "NOUN", -1200),
    ("orre", "ADJ", -1500), ("orre", "VERB", -1000), ("rewh", "VERB", -1600), ("rewh", "NOUN", -1100), ("tion", "NOUN", -500), ("la", "NOUN", -1500),
    ("la", "OTHER", -600), ("de", "OTHER", -300), ("der", "OTHER", -400), ("ing", "NOUN", -1700), ("ing", "VERB", -1300), ("hehely", "ADJ", -600),
    ("to", "OTHER", -500), ("to", "VERB", -2600), ("in", "OTHER", -700), ("a", "OTHER", -200), ("ist", "VERB", -900), ("est", "VERB", -900),
    (None, "NOUN", -2000), (None, "ADJ", -2400), (None, "VERB", -2200), (None, "OTHER", -3000),
]
TRANSITIONS = [
    (None, "OTHER", -600), (None, "NOUN", -1300), (None, "ADJ", -2000), (None, "VERB", -2500), ("OTHER", "NOUN", -700), ("OTHER", "ADJ", -1400),
    ("OTHER", "VERB", -1900), ("OTHER", "OTHER", -1600), ("ADJ", "NOUN", -400), ("ADJ", "ADJ", -1900), ("ADJ", "OTHER", -2300), ("NOUN", "VERB", -900),
    ("NOUN", "OTHER", -1000), ("NOUN", "NOUN", -1800), ("VERB", "OTHER", -800), ("VERB", "ADJ", -1700), ("VERB", "NOUN", -1700), ("VERB", "VERB", -2700),
]
# Hyphenation patterns for the invented words, and words with breaks of their own.
PATTERNS = [
    "a1n", "1na", "1ti", "ti2o", "1o2n", "e1r", "er2i", "1th", "2nd.", ".in1", ".an3e", "n3on", "4st.", "at1t", "r1r", "he1h", "e2l",
    "hel3y", "a2t", "1de", "de2s", "t3a", "ha3n", "o4r4a", "i1n", "in2g.", "re1", "u1n2d", "a3b", "1c", "3be", "é1t", "w2h",
]
BROKEN_WORDS = ["o-rantion", "re-wh", "thatin"]
# (feature, weight, mean, std) and (term, weight, idf).
NUMBER_WEIGHTS = [
    ("punctuation_freq", 0.31, 2.6, 1.9), ("vocab_diversity", -0.44, 0.68, 0.14),
    ("readability_score", 0.12, 58.0, 21.0), ("avg_sentence_length", -0.27, 14.0, 6.5),
    ("sentiment_score", 0.22, 0.25, 0.7), ("rating_sentiment_gap", 0.63, 0.8, 0.55),
    ("model_sentiment", -0.18, 0.01, 0.02), ("model_rating_gap", 0.09, 0.6, 0.35),
    ("sentiment_dissonance", 0.35, 0.7, 0.3),
]
TEXT_WEIGHTS = [
    ("de", 0.42, 1.9), ("de la", -0.35, 3.1), ("der", 0.12, 2.0), ("en", 0.02, 2.1), ("hehely", -0.61, 4.4),
    ("inoran", 0.05, 4.5), ("la", -0.35, 2.0), ("le", 0.3, 2.3), ("ononst", 0.88, 4.3), ("orantion", -0.05, 4.4),
    ("orre", -0.3, 4.2), ("que", -0.08, 2.2), ("rewh", 0.07, 4.2), ("thatin", 1.25, 4.1), ("und", -0.5, 2.1),
    ("von", -0.02, 2.7),
]
INTERCEPT = -0.15
STOP_WORDS = [
    "the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "was", "on", "with", "be", "as", "by", "this",
    "are", "at", "from", "an", "et", "les", "des", "un", "une", "die", "den", "das", "zu", "mit", "el", "los", "se",
]


def _rating() -> Column:
    return F.when(F.col("doc_id") % 17 != 0, (F.col("doc_id") % 5 + 1).cast("double"))


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and labels as a raw review file with gaps and untidy labels."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", ["doc_id", "text", "source"])
    labels = read_table(spark, sf_dir, "labels", columns=["doc_id", "quality"])
    label = F.when(F.col("quality") == 0, F.lit(" cg ")).when(F.col("quality") == 1, F.lit("or"))
    return docs.join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("review_id"), F.col("source").alias("category"), _rating().alias("rating"),
        label.alias("label"), F.col("text").alias("text_"))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw reviews under the stored column name."""
    return raw_reviews(spark, sf_dir).withColumnRenamed("text_", "review_text")


def rated_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``reviews`` without category and label.

    A label only decides how often its review comes, so the texts meet the ids that are labelled
    more than once instead of being shuffled to all labels.
    """
    docs = read_table(spark, sf_dir, "documents", "doc_id", ["doc_id", "text"])
    labels = read_table(spark, sf_dir, "labels", columns=["doc_id"])
    repeated = labels.groupBy("doc_id").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    each = F.explode(F.expr("sequence(1L, coalesce(times, 1L))"))
    return docs.join(small(repeated), "doc_id", "left").select("doc_id", "text", each.alias("time")).select(
        F.col("doc_id").alias("review_id"), _rating().alias("rating"), F.col("text").alias("review_text"))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_reviews(raw_reviews(spark, sf_dir)).withColumnRenamed("text_", "review_text")


_TABLES: dict[str, SentimentTables] = {}


def sentiment_tables(spark: SparkSession) -> SentimentTables:
    """Loaded once per application, as a service would do."""
    application = spark.sparkContext.applicationId
    if application not in _TABLES:
        _TABLES.clear()
        _TABLES[application] = SentimentTables(
            P.lexicon_table(spark, LEXICON), P.booster_table(spark, BOOSTERS), P.token_table(spark, NEGATIONS),
            P.head_table(spark, HEAD), BIAS, CONTRAST)
    return _TABLES[application]


def phrase_tables(spark: SparkSession) -> SentimentTables:
    """The same tables with phrases."""
    return SentimentTables(P.lexicon_table(spark, LEXICON | PHRASES), P.booster_table(spark, BOOSTERS | PHRASE_BOOSTERS),
                           P.token_table(spark, NEGATIONS), contrast=CONTRAST)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature table of all reviews."""
    return extract_features(reviews(spark, sf_dir), sentiment_tables(spark))


def labelled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of the cleaned reviews with their label and rating.

    The label travels with the extraction; a stored feature table would be
    joined on ``review_id`` instead.
    """
    return extract_features(cleaned(spark, sf_dir), sentiment_tables(spark), ("label", "rating"))


def coefficients(spark: SparkSession) -> DataFrame:
    rows = [(-1, "intercept", "intercept", INTERCEPT, None, None, None)]
    rows += [(i, "num", f, w, m, s, None) for i, (f, w, m, s) in enumerate(NUMBER_WEIGHTS)]
    rows += [(len(NUMBER_WEIGHTS) + i, "text", f, w, None, None, idf) for i, (f, w, idf) in enumerate(TEXT_WEIGHTS)]
    return P.coefficient_table(spark, rows)


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the log table."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("event_id").alias("log_id"), F.col("event_type").alias("stage"),
        F.col("props").alias("message"), F.col("ts").alias("logged_at"))
