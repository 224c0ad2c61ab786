"""Documents, chunks, questions and stored vectors of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.functions.text import default_title
from tallywell.operators.chunking import chunk_documents
from tallywell.session import spread
from tallywell.sources.tables import table


def documents(spark: SparkSession, base: str) -> DataFrame:
    """``(doc_id, text, source, title, lang)``; the title is the source's name."""
    return table(spark, base, "documents").select(
        "doc_id", "text", "source",
        default_title(F.lit(None).cast("string"), F.col("source")).alias("title"), "lang")


def spread_documents(spark: SparkSession, base: str) -> DataFrame:
    """Documents for costly text work, see :func:`tallywell.session.spread`."""
    return spread(documents(spark, base), "doc_id")


def chunk_table(spark: SparkSession, base: str) -> DataFrame:
    return chunk_documents(spread_documents(spark, base))


def questions(spark: SparkSession, base: str) -> DataFrame:
    """Every user turn, whole, as ``(query_id, question)``."""
    return (table(spark, base, "conversations").filter("role = 'user'")
            .select(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("query_id"),
                    F.col("text").alias("question")))


def stored_vectors(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "embeddings").select("vec_id", "label", F.col("embedding").alias("vector"))
