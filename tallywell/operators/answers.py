"""Answers to a table of questions from retrieved text, with sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywell.functions.text import answer_sentences, basename, important_words, let, words
from tallywell.operators.lexical import LexicalIndex, normalized_scores, search_bm25
from tallywell.operators.sentencematch import best_sentences
from tallywell.operators.vectors import embed_text, knn_l2
from tallywell.session import staged

# Replies and limits.
NO_DOCUMENT = "I couldn't find any relevant information to answer your question."
NO_INDEX = "I could not find an answer because no document index is available."
NO_CHUNK = "I could not find relevant information to answer your question."
NOT_CONFIDENT = "I could not find a confident answer to your question in the provided documents."
FALLBACK_CONFIDENCE = 0.1
CONFIDENCE_THRESHOLD = 0.1
CONTEXT_CUT = 512

# Questions one task answers from one copy of a document, and hits that share one copy of a text.
QUESTIONS_PER_COPY = 64
HITS_PER_COPY = 1024


def _copies(hits: DataFrame, keys: list[str], per_copy: int) -> DataFrame:
    """``(*keys, copies)`` of what is hit; the count is combined before its shuffle."""
    return hits.groupBy(*keys).agg(F.ceil(F.count("*") / per_copy).cast("int").alias("copies"))


def _copied(side: DataFrame, copies: DataFrame, keys: list[str]) -> DataFrame:
    """The hit rows of ``side`` once for each ``copy``."""
    return (side.join(copies, keys).withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
            .drop("copies"))


def _dealt(hits: DataFrame, copies: DataFrame, keys: list[str]) -> DataFrame:
    """``hits`` with the ``copy`` each of them goes to."""
    return (hits.join(copies, keys).withColumn("copy", F.pmod(F.xxhash64("query_id"), F.col("copies")).cast("int"))
            .drop("copies"))


def join_hits(hits: DataFrame, side: DataFrame, keys: list[str], per_copy: int = HITS_PER_COPY) -> DataFrame:
    """Hits with the row of ``side`` that they hit. A row that very many
    questions hit goes out in copies, each to its own task."""
    copies = _copies(hits, keys, per_copy)
    return _dealt(hits, copies, keys).join(_copied(side, copies, keys), [*keys, "copy"]).drop("copy")


def word_sets(df: DataFrame, left: str, right: str) -> DataFrame:
    """Append counts of distinct words: of each side, in common, only left."""
    a, b = F.array_distinct(words(F.col(left))), F.array_distinct(words(F.col(right)))
    return df.withColumns({"n_left": F.size(a), "n_right": F.size(b),
                           "n_common": F.size(F.array_intersect(a, b)),
                           "n_only_left": F.size(F.array_except(a, b))})


def _best(important: Column, split_sentences: Column) -> Column:
    """Hits and negated position of the first sentence with most important words."""
    return F.array_max(F.transform(split_sentences, lambda w, i: F.struct(
        F.size(F.array_intersect(important, w)).alias("hits"), (-i).alias("neg_position"))))


def _reply(important: Column, sents: Column, top: Column) -> tuple[Column, Column]:
    """Answer text and confidence. With no match the first sentence, or '',
    has a low fixed confidence."""
    hit = F.coalesce(top["hits"], F.lit(0)) > 0
    return (F.when(hit, F.try_element_at(sents, 1 - top["neg_position"]))
            .otherwise(F.coalesce(F.try_element_at(sents, F.lit(1)), F.lit(""))),
            F.when(hit, F.round(top["hits"] / F.size(important), 6)).otherwise(F.lit(FALLBACK_CONFIDENCE)))


def _split_words(sents: Column) -> Column:
    return F.transform(sents, lambda s: F.split(s, " "))


def with_answer(df: DataFrame, question: str = "question", context: str = "context") -> DataFrame:
    """Append ``answer``, the first sentence of ``context`` covering most of the
    question's important words, and ``confidence``, the share it covers. The
    context is read whole, inside its row."""
    def made(wanted, sents, top):
        answer, confidence = _reply(wanted, sents, top)
        return F.struct(answer.alias("answer"), confidence.alias("confidence"))

    text = F.coalesce(F.col(context), F.lit(""))
    return (df.withColumn("_made", let(important_words(F.col(question)), lambda wanted: let(
                answer_sentences(text), lambda sents: let(
                    _best(wanted, _split_words(sents)), lambda top: made(wanted, sents, top)))))
            .withColumns({"answer": F.col("_made.answer"), "confidence": F.col("_made.confidence")})
            .drop("_made"))


def confidence_gate(df: DataFrame, threshold: float = CONFIDENCE_THRESHOLD) -> DataFrame:
    """Replace answers below the threshold by a fixed reply with confidence 0."""
    low = F.col("confidence") < threshold
    return df.withColumns({"answer": F.when(low, NOT_CONFIDENT).otherwise(F.col("answer")),
                           "confidence": F.when(low, 0.0).otherwise(F.col("confidence"))})


def answer_questions(questions: DataFrame, hits: DataFrame, documents: DataFrame,
                     per_copy: int = QUESTIONS_PER_COPY) -> DataFrame:
    """One answer per question from its retrieved documents:
    ``(query_id, answer, confidence, doc_id)``.

    Each document proposes its best sentence, weighted by the retrieval score;
    the largest weight above 0 wins, ties go to the better rank.

    A document is cut into sentences once for about ``per_copy`` questions. One
    retrieved by very many questions goes out in as many copies as it needs,
    each to its own task, and its text goes no further than that task.
    """
    hits = staged(hits.select("query_id", "doc_id", "score", "rank"), "hits")
    copies = _copies(hits, ["doc_id"], per_copy)
    wanted = questions.select("query_id", important_words(F.col("question")).alias("important"))
    asked = (_dealt(hits, copies, ["doc_id"]).join(wanted, "query_id").groupBy("doc_id", "copy")
             .agg(F.collect_list(F.struct("query_id", "rank", "score", "important")).alias("asked")))

    matched = best_sentences(
        _copied(documents.select("doc_id", "text"), copies, ["doc_id"]).join(asked, ["doc_id", "copy"])
        .select("doc_id", _split_words(answer_sentences(F.col("text"))).alias("words"), "asked"))
    confidence = F.when(F.col("hits") > 0, F.round(F.col("hits") / F.col("n_important"), 6)) \
        .otherwise(F.lit(FALLBACK_CONFIDENCE))
    proposals = (matched.join(wanted.select("query_id", F.size("important").alias("n_important")), "query_id")
                 .select("query_id", "rank", "doc_id", F.col("sentence").alias("answer"),
                         F.round(confidence * F.col("score"), 6).alias("weight")))
    best = (proposals.groupBy("query_id")
            .agg(F.max_by(F.struct("answer", "weight", "doc_id"),
                          F.struct("weight", -F.col("rank"))).alias("best")))
    found = F.col("best").isNotNull()
    won = F.col("best.weight") > 0
    return (questions.select("query_id").join(best, "query_id", "left")
            .select("query_id",
                    F.when(~found, NO_DOCUMENT).when(won, F.col("best.answer")).otherwise("").alias("answer"),
                    F.when(found & won, F.col("best.weight")).otherwise(0.0).alias("confidence"),
                    F.when(found & won, F.col("best.doc_id")).alias("doc_id")))


def assemble_context(hits: DataFrame, separator: str = "\n\n", cut: int | None = None, text: str = "text") -> DataFrame:
    """Retrieved text per question, joined in rank order: ``(query_id, context)``.
    A question holds at most k texts."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("rank", F.col(text).alias("t")))), lambda s: s["t"])
    joined = F.array_join(parts, separator)
    return hits.groupBy("query_id").agg((F.left(joined, F.lit(cut)) if cut else joined).alias("context"))


def join_chunk_document(chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """Chunks with the fields of their document; chunks without one are dropped."""
    return chunks.join(documents, "doc_id")


def _sources() -> Column:
    fields = F.struct("rank", "doc_id", "source", "title", "score", "normalized_score")
    return F.array_sort(F.collect_list(fields))


def answer_with_sources(questions: DataFrame, hits: DataFrame, chunks: DataFrame, documents: DataFrame,
                        threshold: float = CONFIDENCE_THRESHOLD) -> DataFrame:
    """``(query_id, answer, confidence, sources)`` from retrieved chunks.

    The answer is taken from all chunk texts of the question joined in rank
    order and gated by confidence; sources are ordered by rank.
    """
    keys = [c for c in ("doc_id", "pos") if c in hits.columns]
    detail = normalized_scores(join_chunk_document(
        join_hits(hits, chunks.select(*keys, "text"), keys), documents.select("doc_id", "source", "title")))
    grouped = detail.groupBy("query_id").agg(
        _sources().alias("sources"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "text"))),
                                 lambda s: s["text"]), "\n\n").alias("context"))
    answered = confidence_gate(with_answer(
        questions.select("query_id", "question").join(grouped, "query_id")), threshold)
    out = questions.select("query_id").join(
        answered.select("query_id", "answer", "confidence", "sources"), "query_id", "left")
    return out.withColumns({
        "answer": F.coalesce("answer", F.lit(NO_CHUNK)),
        "confidence": F.coalesce("confidence", F.lit(0.0)),
        "sources": F.coalesce("sources", F.array().cast(answered.schema["sources"].dataType))})


def source_line(rank: Column, name: Column, score: Column) -> Column:
    return F.format_string("[%d] %s (score: %s)", rank, name,
                           F.round(score.cast("decimal(20,6)"), 2).cast("string"))


def source_references(answers: DataFrame, sources: DataFrame, include_sources: bool = True) -> DataFrame:
    """``(query_id, formatted)``: the answer and, below ``Sources:``, one line
    per source with its rank, file name or id, and score."""
    name = F.coalesce(basename(F.col("source")), F.col("doc_id").cast("string"))
    line = source_line(F.col("rank"), name, F.col("score"))
    lines = sources.groupBy("query_id").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("rank", line.alias("line")))), lambda s: s["line"]), "\n").alias("lines"))
    text = F.when(F.col("lines").isNull() | F.lit(not include_sources), F.col("answer")) \
        .otherwise(F.concat(F.col("answer"), F.lit("\n\nSources:\n"), F.col("lines")))
    return answers.join(lines, "query_id", "left").select("query_id", text.alias("formatted"))


def retrieve_auto(questions: DataFrame, k: int = 5, vectors: DataFrame | None = None,
                  index: LexicalIndex | None = None) -> DataFrame:
    """Chunks for each question by whatever is available: vector search when
    ``vectors`` (doc_id, pos, vector) exist, else BM25, else one row per
    question with a fixed reply. Columns ``(query_id, doc_id, pos, score, rank, reply)``."""
    none = F.lit(None).cast("string").alias("reply")
    if vectors is not None:
        asked = embed_text(questions, "question").select("query_id", "vector")
        hits = knn_l2(vectors, asked, ["doc_id", "pos"], k)
        return hits.select("query_id", "doc_id", "pos", "score", "rank", none)
    if index is not None:
        return search_bm25(index, questions, k).select("query_id", "doc_id", "pos", "score", "rank", none)
    return questions.select(
        "query_id", F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("int").alias("pos"),
        F.lit(None).cast("double").alias("score"), F.lit(None).cast("int").alias("rank"), F.lit(NO_INDEX).alias("reply"))
