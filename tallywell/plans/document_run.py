"""From files to stored chunks and vectors, and from questions to answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.operators.answers import answer_with_sources, retrieve_auto
from tallywell.operators.lexical import lexical_index
from tallywell.operators.vectors import embed_chunks
from tallywell.session import spread, staged
from tallywell.sources.corpus import (DEFAULT_EXTENSIONS, add_documents, add_embeddings, load_corpus,
                                      load_embeddings, read_corpus, save_corpus, save_embeddings)

MODEL_NAME = "hashed-words-256"


def index_documents(documents: DataFrame, out: str, with_vectors: bool = True) -> str:
    """Store ``(doc_id, text, source)`` documents, their chunks and chunk vectors below ``out``."""
    spark = documents.sparkSession
    save_corpus(spread(documents, "doc_id"), out)
    if with_vectors:
        save_embeddings(_vectors(load_corpus(spark, out)[1]), out, MODEL_NAME, "doc_id")
    # Written last: it says whether the vectors belong to this index.
    spark.createDataFrame([(MODEL_NAME if with_vectors else None,)], "vectors string").coalesce(1) \
        .write.mode("overwrite").json(f"{out}/manifest", ignoreNullFields=False)
    return out


def update_documents(documents: DataFrame, store: str) -> str:
    """Add documents to an index, or replace those of the same ids, with their chunks and vectors."""
    spark = documents.sparkSession
    added = staged(documents, "added")
    add_documents(spread(added, "doc_id"), store)
    if spark.read.schema("vectors string").json(f"{store}/manifest").first()["vectors"]:
        ids = added.select("doc_id").distinct()
        chunks = load_corpus(spark, store)[1].join(ids, "doc_id", "left_semi")
        add_embeddings(_vectors(chunks), store, MODEL_NAME, "doc_id", ids)
    return store


def _vectors(chunks: DataFrame) -> DataFrame:
    return embed_chunks(chunks).select("chunk_id", "doc_id", "pos", "vector",
                                       F.create_map().cast("map<string,string>").alias("metadata"))


def index_directory(spark: SparkSession, path: str, out: str, extensions=DEFAULT_EXTENSIONS,
                    with_vectors: bool = True) -> str:
    """Index every text file below ``path``."""
    return index_documents(read_corpus(spark, path, extensions), out, with_vectors)


def answer_batch(spark: SparkSession, store: str, questions: DataFrame, k: int = 5,
                 use_vectors: bool = True, threshold: float = 0.1) -> DataFrame:
    """``(query_id, answer, confidence, sources)`` for a table of
    ``(query_id, question)``: by vectors where the store has them, else by BM25."""
    documents, chunks = load_corpus(spark, store)
    model = spark.read.schema("vectors string").json(f"{store}/manifest").first()["vectors"]
    vectors = load_embeddings(spark, store, model)[0] if use_vectors and model else None
    index = None if vectors is not None else lexical_index(chunks, ["doc_id", "pos"])
    hits = staged(retrieve_auto(questions, k, vectors, index).drop("reply"), "hits")
    return answer_with_sources(questions, hits, chunks, documents, threshold)
