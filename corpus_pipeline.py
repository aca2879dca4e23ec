"""The corpus pipeline: documents in, clean documents with sampled piece ids out.

Each stage is ``(name, function)``; a function takes ``(spark, docs,
sf_dir)`` and returns the next stage's documents.  Stages keep all columns of
``documents``; the last adds the ids.

1. toxicity: documents the factorization machine scores as toxic go.
2. near_duplicates: one document of each SimHash component stays (4-word
   shingles, at most 4 differing bits).
3. decontaminate: documents that overlap a benchmark item go.
4. secrets: secret spans in the text become a mark, ``n_chars`` follows; all
   documents stay.
5. pieces: sampled piece ids and their number; decoding them gives the text.

Null and empty texts are ordinary documents (all but one empty document are
near-duplicates of each other); null ids stay as they are.  Extra columns
pass through, but for ``ids`` and ``n_pieces``, which the last stage sets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logwarden.llm import decontaminate, secrets, sentencepiece_sampling, simhash, toxicity
from logwarden.llm.common import read, stored


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train_toxicity(docs, read(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model, to="__score")
    return scored.where(F.col("__score") < toxicity.THRESHOLD).drop("__score")


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    if "n_chars" not in docs.columns:
        return secrets.redact_secrets(docs)
    out = secrets.redact_secrets(docs.withColumn("__old", F.col("text")))
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    same = F.col("text").eqNullSafe(F.col("__old"))
    return out.withColumn("n_chars", F.when(same, F.col("n_chars")).otherwise(length)).drop("__old")


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = sentencepiece_sampling.encode_sampled(docs, sentencepiece_sampling.model_path())
    return out.withColumn("n_pieces", F.when(F.col("ids").isNotNull(), F.size("ids")))


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicates_stage),
    ("decontaminate", decontaminate_stage),
    ("secrets", secrets_stage),
    ("pieces", pieces_stage),
]

#: a factorization machine and Markov models are not expressible in SQL; tests compare the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's output is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
