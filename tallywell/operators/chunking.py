"""Sentence-packed, overlapping chunks of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywell.functions.text import let, sentences

# Target size in characters, sentences carried into the next
# chunk, and the overlap number that enters ``start_idx``.
MAX_CHUNK_SIZE = 1000
CARRIED_SENTENCES = 3
OVERLAP = 200


def chunk_spans(lengths: Column, max_size: int = MAX_CHUNK_SIZE) -> Column:
    """Array of ``(first, n)`` sentence spans for an array of sentence lengths.

    The fold keeps a constant-size state: sentences in the chunk, its counted
    size, its total length and the last three lengths. A sentence that does
    not fit closes the chunk and the next one starts with up to three carried
    sentences; only then do the blanks between sentences count.
    """
    empty_span = "cast(array() as array<struct<first:int,n:int>>)"
    start = F.expr(f"named_struct('at', 0, 'n', 0, 'size', 0, 'total', 0, "
                   f"'l1', 0, 'l2', 0, 'l3', 0, 'spans', {empty_span})")

    def state(at, n, size, total, l1, l2, l3, spans):
        return F.struct(at.alias("at"), n.alias("n"), size.alias("size"), total.alias("total"),
                        l1.alias("l1"), l2.alias("l2"), l3.alias("l3"), spans.alias("spans"))

    def closed(a):
        return F.when(a["n"] > 0, F.array_append(
            a["spans"], F.struct((a["at"] - a["n"]).alias("first"), a["n"].alias("n")))).otherwise(a["spans"])

    def step(a, length):
        fits = a["size"] + length <= max_size
        long = a["n"] > CARRIED_SENTENCES
        kept_n = F.when(long, CARRIED_SENTENCES).otherwise(a["n"])
        kept_total = F.when(long, a["l1"] + a["l2"] + a["l3"]).otherwise(a["total"])
        return F.when(fits, state(a["at"] + 1, a["n"] + 1, a["size"] + length, a["total"] + length,
                                  a["l2"], a["l3"], length, a["spans"])) \
            .otherwise(state(a["at"] + 1, kept_n + 1, kept_total + length + kept_n, kept_total + length,
                             a["l2"], a["l3"], length, closed(a)))

    return F.aggregate(lengths, start, step, closed)


def chunk_array(text: Column, max_size: int = MAX_CHUNK_SIZE) -> Column:
    """Array of ``(text, start_idx, end_idx)`` chunks of one text, in order."""
    def build(sents, span):
        body = F.slice(sents, span["first"] + 1, span["n"])
        head = F.greatest(F.lit(0), span["n"] - OVERLAP)
        start = F.when(head > 0, F.length(F.array_join(
            F.slice(sents, span["first"] + 1, head), ""))).otherwise(0)
        return let(F.array_join(body, " "), lambda t: F.struct(
            t.alias("text"), start.alias("start_idx"), F.length(t).alias("end_idx")))

    return let(sentences(text), lambda sents: F.transform(
        chunk_spans(F.transform(sents, lambda s: F.length(s)), max_size), lambda span: build(sents, span)))


def chunk_count(text: Column, max_size: int = MAX_CHUNK_SIZE) -> Column:
    return F.size(chunk_spans(F.transform(sentences(text), lambda s: F.length(s)), max_size))


def chunk_documents(documents: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    max_size: int = MAX_CHUNK_SIZE) -> DataFrame:
    """One row per chunk: ``(chunk_id, doc_id, pos, text, start_idx, end_idx)``.
    Narrow: every document is cut where it lies."""
    # The outer form is not given an extra filter that builds all chunks twice.
    return (documents.select(F.col(doc_id).alias("doc_id"),
                             F.posexplode_outer(chunk_array(F.col(text), max_size)).alias("pos", "c"))
            .filter(F.col("pos").isNotNull())
            .select(F.concat_ws(":", F.col("doc_id").cast("string"), F.col("pos").cast("string")).alias("chunk_id"),
                    "doc_id", "pos", "c.text", "c.start_idx", "c.end_idx"))


def document_stats(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Text length and chunk count per document, without exploding chunks."""
    return documents.select(doc_id, F.length(text).cast("bigint").alias("text_length"),
                            chunk_count(F.col(text)).cast("bigint").alias("num_chunks"))


def union_chunks(batches: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Chunks and documents of several ``(doc_id, text)`` batches added in turn.

    Chunks of every batch are kept. Of the documents with one id the last
    batch wins; that choice is a combining aggregate, so an id added very
    often is reduced before the shuffle.
    """
    chunks = docs = None
    for i, batch in enumerate(batches):
        c = chunk_documents(batch).withColumn("batch", F.lit(i))
        d = batch.select("doc_id", "text").withColumn("batch", F.lit(i))
        chunks = c if chunks is None else chunks.unionByName(c)
        docs = d if docs is None else docs.unionByName(d)
    latest = docs.groupBy("doc_id").agg(F.max_by("text", "batch").alias("text"))
    return chunks, latest
