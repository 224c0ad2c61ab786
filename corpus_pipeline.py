"""Corpus pipeline: each stage reads the documents that the stage before it kept."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.llm import byte_bpe, decontamination, line_dedup, near_dedup, quality_rules
from tallywell.llm.rows import quoted, unused
from tallywell.session import shared_dir


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that score under 0.3 go."""
    model = quality_rules.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = unused("quality_score", docs.columns)
    scored = quality_rules.score_quality(docs, model, score_col=score)
    return scored.where(F.col(score) >= 0.3).select(*map(quoted, docs.columns))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: later copies of three-line windows go; a document that loses all its lines goes."""
    lines, removed = unused("dedup_lines", docs.columns), unused("dedup_removed", docs.columns)
    done = line_dedup.dedup_lines(docs, counts=(lines, removed))
    return done.where((F.col(removed) == 0) | (F.col(removed) < F.col(lines))).select(*map(quoted, docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: of each class of near-duplicates the document of the smallest id stays."""
    return near_dedup.keep_one(docs)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold a test item go."""
    return decontamination.drop_leaked(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: ids of every document, packed, with their number and digests of ids and decoded bytes."""
    return byte_bpe.encode_and_check(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality classifier", keep_good), ("line dedup", drop_repeated_lines), ("near-dedup", drop_near_copies),
          ("decontamination", drop_leaked), ("byte BPE", encode)]
#: The classifier is fitted and near-duplicates are found by random hashes; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
