"""The training-data pipeline: five stages over documents.

A stage's result has to be written before the next stage is called: a stage first
deletes what the stage before has staged.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.llm import bpe, line_dedup, mixing, near_dedup, quality_classifier
from quotelake.llm.common import free_prefix, release
from quotelake.session import scratch_path

QUALITY_CUT = 0.3
TARGETS = {"clean": 1.0, "toxic": 0.0, "low": 0.0}
RANKS = "byte_bpe_multi_50k.tiktoken"

# No SQL fits a discriminant, solves for rates or merges bytes; stages are tested
# against brute force.
ORACLE_SQL = None


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the cut. A document without doc_id stays."""
    release(spark)
    scores = quality_classifier.score_quality(docs, _labels(spark, sf_dir))
    low = scores.where(F.col("score") < QUALITY_CUT).select("doc_id").distinct()
    return docs.join(low, "doc_id", "left_anti").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document holds; n_chars follows the text."""
    release(spark)
    kept = line_dedup.dedup_lines(docs)
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest doc_id of each group of near copies (5 words, 0.8)."""
    release(spark)
    copies = near_dedup.near_duplicates(docs, percent=80, width=5).where(~F.col("kept"))
    return docs.join(copies.select("doc_id").distinct(), "doc_id", "left_anti").select(
        *docs.columns
    )


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rate, rounded, says: clean ones stay, toxic ones go."""
    release(spark)
    labelled = mixing.label_domains(_labels(spark, sf_dir))
    mixed = mixing.mix(docs, labelled, TARGETS, rounding="nearest")
    p = free_prefix(docs.columns)
    rates = mixed.where(F.col("copies") != 1).select("doc_id", F.col("copies").alias(f"{p}copies"))
    copies = F.coalesce(F.col(f"{p}copies"), F.lit(1)).cast("int")
    joined = docs.join(rates.dropDuplicates(["doc_id"]), "doc_id", "left").where(copies > 0)
    repeated = joined.withColumn(f"{p}copy", F.explode(F.sequence(F.lit(1), copies)))
    return repeated.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of each text; the ids decode to the text's bytes."""
    release(spark)
    pieces = bpe.read_ranks(public_tokenizers.path(RANKS))
    codec = bpe.Codec(pieces, public_tokenizers.PATTERN)
    coded = bpe.encode_texts(docs.select("doc_id", "text"), codec)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality_classifier", reject_low_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", keep_one_of_near_copies),
    ("mixing", mix_domains),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    release(spark)
    return docs
