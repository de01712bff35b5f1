"""A corpus pipeline: toxicity, near copies, secrets, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet
to the shared folder and reads it back as the next stage's documents. All stages but the last return the
columns of documents.

No SQL twin: the first stages fit models. ``tests/llm`` holds the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veristar.llm import bpe, mixing, neardup, secrets, toxicity
from veristar.llm.common import fold, table, written

TOXIC_FOLDS, TOXIC_HELD = 3, 1
NEAR_WORDS = 5
#: Words that a worker of the last stage keeps: few, as the executors' memory has grown in the stages before.
KEPT_WORDS = 60_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose toxicity score reaches the threshold."""
    held = fold("doc_id", TOXIC_FOLDS) == TOXIC_HELD
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held)
    return toxicity.without_toxic(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, a similarity of 0.8 or more."""
    return neardup.without_near_copies(docs, width=NEAR_WORDS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets replaced by a mark; every document stays."""
    clean = secrets.redact(docs, secrets.fitted(docs))
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as much of them, as the target weights ask for."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row of the mix, decoded for a check: doc_id, n_tokens, ids_sha256, decoded_sha256, ids."""
    return bpe.encode_documents(docs, bpe.vocabulary(), with_ids=True, kept=KEPT_WORDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("bpe", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
