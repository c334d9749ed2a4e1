"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.llm import mixing, pieces, pii, similar, toxicity
from quarterdeck.llm.common import fresh_names, read_table, shared_folder


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model learned from the labels does not reject."""
    labels = read_table(spark, sf_dir, "labels", "doc_id", "toxic")
    return toxicity.drop_toxic(docs, toxicity.fitted(docs.select("doc_id", "text"), labels))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies: five-word shingles at a Jaccard similarity of 0.8 or more."""
    return similar.keep_one(docs)


def pii_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced; n_chars, where there is one, follows the text."""
    masked = pii.mask(docs, pii.secret_key(spark, pii.TRIAL_KEY), kinds=fresh_names(docs, "kinds")[0])
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked.select(*[F.col(f"`{c}`") for c in docs.columns])


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixing.take(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids, and whether these decode to the text."""
    return pieces.encode(docs, pieces.PieceModel.load())


STAGES = [("toxicity", toxicity_filter), ("near_dedup", near_dedup), ("pii", pii_masking), ("mixing", source_mixing), ("sentencepiece", sentencepiece)]

#: Stages draw at random and run trained models, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents`` in order."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{shared_folder(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
