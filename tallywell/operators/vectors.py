"""Text vectors, vector joins and exact vector search."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.ml.feature import CountVectorizerModel, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.functions.numeric import similarity_from_distance
from tallywell.functions.text import is_blank, tokens
from tallywell.operators.blocksearch import (DECIMALS, QUERY_LIMIT, DenseQueries, block_summary,
                                             block_topk)

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A token's slot is the first two hex digits of its MD5.
HASH_DIGITS = 2
VECTOR_SIZE = 16 ** HASH_DIGITS


def embed_text(df: DataFrame, text: str = "text", output: str = "vector") -> DataFrame:
    """Append a hashed bag-of-words vector of length 1, or all zero for text
    without tokens. The same text always has the same vector."""
    slots = F.transform(tokens(F.col(text)), lambda t: F.substring(F.md5(t), 1, HASH_DIGITS))
    counter = CountVectorizerModel.from_vocabulary(
        [format(i, f"0{HASH_DIGITS}x") for i in range(VECTOR_SIZE)],
        inputCol="_slots", outputCol="_counts", minTF=1.0)
    empty = F.array().cast("array<string>")
    counted = counter.transform(df.withColumn("_slots", F.coalesce(slots, empty)))
    scaled = Normalizer(p=2.0, inputCol="_counts", outputCol="_scaled").transform(counted)
    return scaled.withColumn(output, vector_to_array("_scaled")).drop("_slots", "_counts", "_scaled")


def embed_chunks(chunks: DataFrame, id_col: str = "chunk_id", text: str = "text") -> DataFrame:
    """Vectors of all chunks; rows with blank text or no id are left out."""
    kept = chunks.filter(~is_blank(F.col(text)) & ~is_blank(F.col(id_col).cast("string")))
    return embed_text(kept, text)


def join_vectors(documents: DataFrame, vectors: DataFrame, on: str = "doc_id") -> DataFrame:
    """Documents with their stored vector; documents without one are left out."""
    return documents.join(vectors, on)


def zip_by_ordinal(left: DataFrame, right: DataFrame, ordinal: str) -> DataFrame:
    """Rows with the same explicit position, cut to the shorter side."""
    return left.join(right, ordinal)


def knn_l2(corpus: DataFrame, queries: DataFrame, keys: list[str], k: int = 5,
           query_limit: int = QUERY_LIMIT) -> DataFrame:
    """The ``k`` nearest corpus vectors per query by squared distance:
    ``(query_id, *keys, distance, score, rank)`` with ``score = 1 / (1 + distance)``.

    ``corpus`` has ``keys`` and ``vector``; ``queries`` has ``query_id`` and ``vector``.
    """
    found = _search(corpus, queries, keys, "l2", k, None, query_limit)
    distance = F.abs("rank_score")
    return found.select("query_id", *keys, distance.alias("distance"),
                        similarity_from_distance(distance).alias("score"), "rank")


def search_cosine(corpus: DataFrame, queries: DataFrame, keys: list[str], k: int = 5,
                  threshold: float = 0.0, query_limit: int = QUERY_LIMIT) -> DataFrame:
    """The ``k`` most similar corpus vectors at or above ``threshold``:
    ``(query_id, *keys, score, rank)``; ties keep corpus order."""
    found = _search(corpus, queries, keys, "cosine", k, threshold, query_limit)
    return found.select("query_id", *keys, F.round("rank_score", DECIMALS).alias("score"), "rank")


def _search(corpus, queries, keys, measure, k, floor, query_limit):
    return block_topk(corpus.filter(F.col("vector").isNotNull()).select(*keys, "vector"), keys,
                      queries.filter(F.col("vector").isNotNull()).select("query_id", "vector"),
                      lambda t: DenseQueries(t, measure, k), F.size("vector"), k, floor, query_limit)


def similarity_summary(corpus: DataFrame, queries: DataFrame, keys: list[str], threshold: float = 0.0,
                       query_limit: int = QUERY_LIMIT) -> DataFrame:
    """Every query against every corpus vector by cosine, reduced as it is
    computed: ``(query_id, n_scored, n_similar, best)``."""
    return block_summary(corpus.select(*keys, "vector"), queries.select("query_id", "vector"),
                         lambda t: DenseQueries(t, "cosine"), F.size("vector"), threshold, query_limit)
