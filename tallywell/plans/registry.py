"""Registered queries: one per operator, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.functions import numeric, text
from tallywell.operators import (answers, chunking, distribution, explain, features, lexical, metrics,
                                 prep, profile, risk, split, training, vectors)
from tallywell.plans.customer_view import (CATEGORICAL, NUMERIC, customer_features,
                                           scored_customers)
from tallywell.plans.document_run import answer_batch, index_documents
from tallywell.plans.pipeline import run_risk_pipeline
from tallywell.session import scratch_path, staged
from tallywell.plans.questions import (chunk_table, documents, questions, spread_documents,
                                       stored_vectors)
from tallywell.sources import corpus, tables

Query = Callable[[SparkSession, str], DataFrame]

LINE_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _cf(spark, base):
    return customer_features(spark, base)


def _scan_table(spark, base):
    """The feature view through CSV: written, read back, types found from the values."""
    path = tables.write_csv(_cf(spark, base), scratch_path(spark, "customers"))
    found = tables.load_table(spark, path, fmt="csv")
    return found.select(*[F.col(f.name).cast(f.dataType) for f in _cf(spark, base).schema.fields])


def _cf_staged(spark, base):
    return staged(customer_features(spark, base), "customer_features")


def _banded(spark, base):
    return risk.with_risk(scored_customers(spark, base), "rule_score")


def _derived(*names):
    def run(spark, base):
        df = _cf(spark, base)
        derived = features.derived_features(df.columns)
        return df.select("customer_id", *[derived[n].alias(n) for n in names])
    return run


def _split_features_target(spark, base):
    x, y = features.split_target(_cf(spark, base), "Churn", ["customer_id"])
    assert "Churn" not in x.columns
    return y.withColumnRenamed("Churn", "target")


def _concat_columns(spark, base):
    df = _cf(spark, base)
    return df.select("customer_id", *[e.alias(n) for n, e in features.derived_features(df.columns).items()], "Churn")


def _bool_target(spark, base):
    df = _cf(spark, base).withColumn("Churn", F.col("Churn") == 1)
    return profile.target_correlation(df, NUMERIC, "Churn")


def _feature_types(spark, base):
    numeric, categorical = features.feature_types(
        features.engineer_features(_cf(spark, base)), "Churn", ["customer_id"])
    kinds = [("numeric", c) for c in numeric] + [("categorical", c) for c in categorical]
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(k).alias("kind")) for k, c in kinds])
    counts = _cf(spark, base).agg(F.count("*").alias("n_rows"))
    return counts.select(F.inline(rows), "n_rows")


def _sink_csv(spark, base):
    df = _banded(spark, base).select("customer_id", "contract_type", "tenure", "revenue",
                                     "rule_score", "risk_category")
    path = tables.write_csv(df, scratch_path(spark, "predictions"))
    return tables.load_table(spark, path, df.schema, "csv")


def _sink_json(spark, base):
    report = profile.profile_missing(_cf(spark, base))
    path = tables.write_json(report, scratch_path(spark, "report"))
    return tables.load_table(spark, path, report.schema, "json")


def _join_topcat(spark, base):
    part = tables.table(spark, base, "part")
    # At most 15 rows by construction, so the broadcast is bounded.
    top = part.groupBy("p_name").count().orderBy(F.desc("count"), "p_name").limit(15).select("p_name")
    return part.select("p_partkey", "p_name").join(F.broadcast(top), "p_name", "left_semi")


def _table_queries() -> dict[str, Query]:
    def lineitem(spark, base):
        return tables.table(spark, base, "lineitem")

    return {
        "scan_table": _scan_table,
        "feature_types": _feature_types,
        "split_features_target": _split_features_target,
        "feat_usage_per_month": _derived("usage_per_month"),
        "feat_margin": _derived("margin", "margin_percentage"),
        "feat_tenure_group": _derived("tenure_group"),
        "feat_total_services": lambda s, b: _derived("total_services")(s, b).withColumn(
            "total_services", F.col("total_services").cast("bigint")),
        "feat_support_per_month": _derived("support_calls_per_month"),
        "engineer_features": lambda s, b: features.engineer_features(_cf(s, b)),
        "concat_columns": _concat_columns,
        "rule_score": lambda s, b: scored_customers(s, b).select("customer_id", "rule_score"),
        "risk_category": lambda s, b: _banded(s, b).select("customer_id", "rule_score", "risk_category"),
        "high_risk_filter": lambda s, b: risk.high_risk(_banded(s, b)).select("customer_id", "rule_score"),
        "bool_target_to_int": _bool_target,
        "lump_other": lambda s, b: features.lump_other(
            tables.table(s, b, "part").select("p_partkey", "p_name"), "p_name",
            into="p_name_lumped").select("p_partkey", "p_name_lumped"),
        "join_topcat_semi": _join_topcat,
        "sink_csv": _sink_csv,
        "sink_json_report": _sink_json,
        "profile_shape": lambda s, b: profile.profile_shape(_cf(s, b)),
        "profile_missing": lambda s, b: profile.profile_missing(_cf(s, b)),
        "missing_only_filter": lambda s, b: profile.missing_only(profile.profile_missing(_cf(s, b))),
        "profile_target": lambda s, b: profile.profile_target(_cf(s, b), "Churn"),
        "profile_numeric": lambda s, b: profile.profile_numeric(_cf_staged(s, b), NUMERIC),
        "profile_numeric_lineitem": lambda s, b: profile.profile_numeric(lineitem(s, b), LINE_NUMERIC),
        "profile_categorical": lambda s, b: profile.profile_categorical(_cf(s, b), CATEGORICAL),
        "profile_categorical_orders": lambda s, b: profile.profile_categorical(
            tables.table(s, b, "orders"), ["o_orderstatus", "o_orderpriority"]),
        "dq_constant_columns": lambda s, b: profile.dq_constant_columns(lineitem(s, b)),
        "dq_outliers_iqr": lambda s, b: profile.dq_outliers_iqr(_cf_staged(s, b), NUMERIC),
        "dq_outliers_iqr_lineitem": lambda s, b: profile.dq_outliers_iqr(lineitem(s, b), LINE_NUMERIC),
        "dq_skewness": lambda s, b: profile.dq_skewness(_cf(s, b), NUMERIC),
        "dq_imbalanced": lambda s, b: profile.dq_imbalanced(
            _cf(s, b), CATEGORICAL + ["service_view", "service_signup"]),
        "dq_report": lambda s, b: profile.dq_report(_cf_staged(s, b), "Churn", ["customer_id"]),
        "correlation_matrix": lambda s, b: profile.correlation_matrix(_cf_staged(s, b), NUMERIC),
        "target_correlation": lambda s, b: profile.target_correlation(_cf(s, b), NUMERIC, "Churn"),
        "topk_numeric_by_corr": lambda s, b: profile.topk_numeric_by_corr(_cf(s, b), NUMERIC, "Churn"),
        "topk_categorical_by_cardinality": lambda s, b: profile.topk_categorical_by_cardinality(_cf(s, b), CATEGORICAL),
        "crosstab_pct": lambda s, b: profile.crosstab_pct(_cf(s, b), "contract_type", "Churn", [0, 1]),
        "category_counts": lambda s, b: profile.category_counts(_cf(s, b), "region"),
        "label_rate": lambda s, b: profile.label_rate(_cf(s, b), "Churn"),
        "histogram_by_class": lambda s, b: distribution.histogram_by_class(_cf_staged(s, b), NUMERIC, "Churn"),
        "density_curve": lambda s, b: distribution.density_curve(
            _cf_staged(s, b), NUMERIC),
        "boxplot_stats": lambda s, b: distribution.boxplot_stats(_cf_staged(s, b), NUMERIC, "Churn", [0, 1]),
        "risk_distribution": lambda s, b: risk.risk_distribution(_banded(s, b)),
        "data_summary": lambda s, b: profile.data_summary(_cf_staged(s, b), "Churn", ["customer_id"]),
        "topk_risk": lambda s, b: risk.top_risk(_banded(s, b), "rule_score"),
    }


def _metric(fn):
    return lambda s, b: fn(scored_customers(s, b), "Churn", "rule_score")


def _best_rule(spark, base):
    # Three scorers of one table, compared by their exact ROC area.
    df = staged(scored_customers(spark, base), "scored")
    rivals = {"rule": F.col("rule_score"), "late_payments": F.coalesce("late_payments", F.lit(0)) / 5.0,
              "short_tenure": 1.0 / (1 + F.coalesce("tenure", F.lit(0)))}
    out = None
    for i, (name, score) in enumerate(rivals.items()):
        one = metrics.roc_auc(df.withColumn("s", F.round(score, 6)), "Churn", "s").select(
            F.lit(name).alias("model"), F.lit(i).alias("ordinal"), "roc_auc")
        out = one if out is None else out.unionByName(one)
    return metrics.best_model(out)


def _ids_and_labels(spark, base):
    return staged(_cf(spark, base).select("customer_id", "Churn"), "labels")


def _evaluation_queries() -> dict[str, Query]:
    return {
        "stratified_split": lambda s, b: split.stratified_split(
            _ids_and_labels(s, b), "Churn", "customer_id").select("customer_id", "Churn", F.col("is_test").cast("int").alias("is_test")),
        "stratified_kfold": lambda s, b: split.stratified_kfold(
            _ids_and_labels(s, b), "Churn", "customer_id").select("customer_id", "Churn", "fold"),
        "class_weights": lambda s, b: split.class_weight_table(_ids_and_labels(s, b), "Churn"),
        "confusion_matrix": lambda s, b: metrics.confusion_matrix(scored_customers(s, b), "Churn", "pred"),
        "classification_metrics": lambda s, b: metrics.classification_metrics(scored_customers(s, b), "Churn", "pred"),
        "roc_curve": _metric(metrics.roc_curve),
        "roc_auc": _metric(metrics.roc_auc),
        "pr_curve": _metric(metrics.pr_curve),
        "pr_auc": _metric(metrics.pr_auc),
        "best_model": _best_rule,
    }


KEYS = ["doc_id", "pos"]


def _big(df, *names):
    return df.withColumns({c: F.col(c).cast("bigint") for c in names})


def _chunk_id():
    return F.concat_ws(":", F.col("doc_id").cast("string"), F.col("pos").cast("string")).alias("chunk_id")


#: Files that one task writes, about.
FILES_PER_TASK = 1_000


def _write_files(rows, path, tasks):
    """One file ``.txt`` for each key of ``(file, value)``, in a folder for each task; the texts of a key that
    repeats are lines of its file. A task that is run again writes the same files."""
    def write(batches):
        store, root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
        root = f"{root}/{TaskContext.get().partitionId()}"
        store.create_dir(root)
        held, n = [], 0

        def put():
            with store.open_output_stream(f"{root}/file={held[0][0]}.txt") as out:
                out.write(b"\n".join(text for _, text in held))

        for batch in batches:
            texts = pc.fill_null(batch.column("value"), "").cast(pa.binary())
            for row in zip(batch.column("file").to_pylist(), texts.to_pylist()):
                if held and held[0][0] != row[0]:
                    put()
                    held, n = [], n + 1
                held.append(row)
        if held:
            put()
            n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    rows.repartition(tasks, "file").sortWithinPartitions("file").mapInArrow(write, "n long").agg(F.sum("n")).collect()


def _scan_texts(name, key, column):
    def run(spark, base):
        # One file for each row, named by its key.
        path = scratch_path(spark, f"{name}-files")
        rows = tables.table(spark, base, name).select(F.col(key).alias("file"), F.col(column).alias("value"))
        cores = spark.sparkContext.defaultParallelism
        tasks = max(cores, -(-rows.count() // FILES_PER_TASK))
        _write_files(rows, path, tasks)
        return corpus.read_corpus(spark, path).select(
            F.regexp_extract("source", r"/file=([^/]+)\.txt$", 1).cast("bigint").alias(key),
            F.length("text").cast("bigint").alias("text_length"), F.md5("text").alias("text_md5"))
    return run


def _chunks_with_metadata(spark, base):
    docs = documents(spark, base).select("doc_id", "lang", "source")
    meta = F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source"))
    return (answers.join_chunk_document(chunk_table(spark, base), docs)
            .select("chunk_id", "text", meta.alias("metadata")))


def _scan_chunks_json(spark, base):
    path = corpus.write_chunks_json(_chunks_with_metadata(spark, base), scratch_path(spark, "chunks-json"))
    return corpus.read_chunks_json(spark, path, lines=True).select(
        "chunk_id", F.md5("text").alias("text_md5"), F.col("metadata")["lang"].alias("lang"),
        F.col("metadata")["source"].alias("source"))


def _corpus_store(spark, base):
    path = corpus.save_corpus(documents(spark, base), scratch_path(spark, "corpus"))
    docs, chunks = corpus.load_corpus(spark, path)
    counts = chunks.groupBy("doc_id").agg(F.count("*").alias("num_chunks"))
    return (docs.join(counts, "doc_id", "left")
            .select("doc_id", "title", "source", F.length("text").cast("bigint").alias("text_length"),
                    F.md5("text").alias("text_md5"), F.coalesce("num_chunks", F.lit(0)).alias("num_chunks")))


def _embedding_store(spark, base):
    stored = stored_vectors(spark, base).select(
        F.col("vec_id").alias("chunk_id"), "vector",
        F.create_map(F.lit("label"), F.col("label").cast("string")).alias("metadata"))
    path = corpus.save_embeddings(stored, scratch_path(spark, "vectors"), "stored-64")
    vecs, info = corpus.load_embeddings(spark, path, "stored-64")
    one = info.first()
    return vecs.select("chunk_id", F.col("metadata")["label"].alias("label"),
                       F.round(numeric.norm(F.col("vector")), 6).alias("norm"),
                       F.lit(one["num_chunks"]).alias("num_chunks"),
                       F.lit(one["embedding_size"]).cast("bigint").alias("embedding_size"))


def _own_queries(spark, base):
    return stored_vectors(spark, base).select(F.col("vec_id").alias("query_id"), "vector")


def _knn_l2(spark, base):
    hits = vectors.knn_l2(stored_vectors(spark, base), _own_queries(spark, base), ["vec_id"])
    return _big(hits, "rank").withColumns({c: F.round(c, 6) for c in ("distance", "score")})


def _search_cosine(threshold):
    def run(spark, base):
        return _big(vectors.search_cosine(stored_vectors(spark, base), _own_queries(spark, base), ["vec_id"],
                                          threshold=threshold), "rank")
    return run


def _bm25_hits(spark, base, k=5):
    chunks = staged(chunk_table(spark, base), "chunks")
    index = lexical.lexical_index(chunks, KEYS)
    return chunks, lexical.search_bm25(index, questions(spark, base), k)


def _search_bm25(spark, base):
    _, hits = _bm25_hits(spark, base)
    return _big(hits.select("query_id", _chunk_id(), "score", "rank"), "rank")


def _normalized_score(spark, base):
    _, hits = _bm25_hits(spark, base)
    return _big(lexical.normalized_scores(hits).select(
        "query_id", _chunk_id(), "score", "normalized_score", "rank"), "rank")


def _document_index(spark, base):
    return lexical.lexical_index(spread_documents(spark, base), ["doc_id"], text.VECTOR_TOKEN)


def _tfidf_hits(spark, base, threshold=0.0):
    return lexical.search_tfidf(_document_index(spark, base), questions(spark, base), threshold=threshold)


def _assemble_context(spark, base):
    chunks, hits = _bm25_hits(spark, base)
    found = staged(answers.join_hits(hits, chunks.select(*KEYS, "text"), KEYS), "found")
    whole = answers.assemble_context(found)
    cut = answers.assemble_context(found, " ", answers.CONTEXT_CUT).withColumnRenamed("context", "cut_context")
    return whole.join(cut, "query_id").select(
        "query_id", F.length("context").cast("bigint").alias("context_length"),
        F.md5("context").alias("context_md5"), "cut_context")


def _turn_pairs(spark, base):
    """Each user turn with the turn that follows it, if any, as context."""
    conv = tables.table(spark, base, "conversations")
    reply = conv.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reply"))
    asked = conv.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
    return (asked.join(reply, ["conv_id", "turn"], "left")
            .select("conv_id", "turn", "question", F.coalesce("reply", F.lit("")).alias("context")))


def _extract_answer(spark, base):
    return answers.with_answer(_turn_pairs(spark, base)).select("conv_id", "turn", "answer", "confidence")


def _word_set_ops(spark, base):
    names = ["n_left", "n_right", "n_common", "n_only_left"]
    pairs = answers.word_sets(_turn_pairs(spark, base), "question", "context")
    return _big(pairs.select("conv_id", "turn", *names), *names)


def _confidence_gate(spark, base):
    pairs = answers.with_answer(_turn_pairs(spark, base)).select("conv_id", "turn", "answer", "confidence")
    # The fallback confidence is 0.1; a threshold just above it gates those.
    return answers.confidence_gate(pairs, 0.15)


def _answered(spark, base):
    return answers.answer_questions(questions(spark, base), _tfidf_hits(spark, base), spread_documents(spark, base))


def _sourced(spark, base):
    chunks, hits = _bm25_hits(spark, base)
    return answers.answer_with_sources(questions(spark, base), hits, chunks, documents(spark, base))


def _answer_with_sources(spark, base):
    flat = _sourced(spark, base).select("query_id", "answer", "confidence", F.inline_outer("sources"))
    return _big(flat, "rank")


def _source_references(spark, base):
    asked, docs = questions(spark, base), spread_documents(spark, base)
    hits = staged(_tfidf_hits(spark, base), "hits")
    sources = hits.join(docs.select("doc_id", "source"), "doc_id")
    return answers.source_references(answers.answer_questions(asked, hits, docs), sources)


def _semantic(spark, base):
    # Every block of questions passes over the vectors.
    vecs = staged(vectors.embed_chunks(chunk_table(spark, base)).select("doc_id", "pos", "vector"), "vectors")
    hits = answers.retrieve_auto(questions(spark, base), vectors=vecs)
    return _big(hits.select("query_id", _chunk_id(), F.round("score", 6).alias("score"), "rank"), "rank")


def _answer_batch(spark, base):
    """From documents to a stored index, and from it to answers with sources."""
    store = index_documents(documents(spark, base), scratch_path(spark, "index"))
    return answer_batch(spark, store, questions(spark, base)).select(
        "query_id", "answer", "confidence", F.size("sources").cast("bigint").alias("n_sources"))


def _slots_text(vector):
    """Non-zero slots as ``index:weight in millionths``."""
    pairs = F.transform(vector, lambda v, i: F.when(v > 0, F.concat_ws(
        ":", i.cast("string"), F.round(v.cast("double") * 1000).cast("bigint").cast("string"))))
    return F.array_join(F.array_compact(pairs), " ")


def _embed_text(spark, base):
    return (vectors.embed_text(questions(spark, base), "question")
            .select("query_id", _slots_text(F.col("vector")).alias("slots")))


def _embed_chunks(spark, base):
    return (vectors.embed_chunks(chunk_table(spark, base))
            .select("chunk_id", F.md5(_slots_text(F.col("vector"))).alias("slots_md5")))


def _pages_as_documents(spark, base):
    return tables.table(spark, base, "pages").select(F.col("page_id").alias("doc_id"), F.col("html").alias("text"))


def _union_chunks(spark, base):
    first = documents(spark, base).select("doc_id", "text")
    chunks, latest = chunking.union_chunks([first, _pages_as_documents(spark, base)])
    counts = chunks.groupBy("doc_id").agg(F.count("*").alias("num_chunks"))
    return (latest.join(counts, "doc_id", "left")
            .select("doc_id", F.md5("text").alias("text_md5"), F.coalesce("num_chunks", F.lit(0)).alias("num_chunks")))


def _join_doc_embedding(spark, base):
    vecs = stored_vectors(spark, base).select(F.col("vec_id").alias("doc_id"), "label", "vector")
    return vectors.join_vectors(documents(spark, base).select("doc_id", "lang", "source"), vecs).select(
        "doc_id", "lang", "source", "label", F.size("vector").cast("bigint").alias("dims"))


def _join_positional(spark, base):
    ids = tables.table(spark, base, "pages").select(F.col("page_id").alias("ordinal"), F.col("url").alias("chunk_id"))
    vecs = stored_vectors(spark, base).select(F.col("vec_id").alias("ordinal"), "label", "vector")
    return vectors.zip_by_ordinal(ids, vecs, "ordinal").select(
        "ordinal", "chunk_id", "label", F.round(numeric.norm(F.col("vector")), 6).alias("norm"))


def _fn_string(spark, base):
    url, html = F.col("url"), F.col("html")
    return tables.table(spark, base, "pages").select(
        "page_id", F.lower(url).alias("lowered"), text.basename(url).alias("base"),
        F.length(text.squashed(html)).cast("bigint").alias("squashed_length"),
        F.startswith(url, F.lit("https")).cast("int").alias("is_https"),
        text.is_blank(html).cast("int").alias("is_blank"),
        text.extension(F.substring_index(F.substring_index(url, "?", 1), "#", 1)).alias("extension"),
        F.left(html, F.lit(answers.CONTEXT_CUT)).alias("cut"), F.md5(F.array_join(text.words(html), "|")).alias("words_md5"),
        F.format_string("CUST_%06d", F.col("page_id")).alias("formatted"))


def _fn_math(spark, base):
    df = customer_features(spark, base)
    return df.select(
        "customer_id", numeric.clip(F.col("c_acctbal"), 0.0, 5000.0).alias("clipped"),
        F.round("c_acctbal", 0).alias("rounded"), F.abs(F.col("c_acctbal") - 5000).alias("away"),
        F.round(features.ratio(F.col("cost"), F.col("revenue")) * 100, 6).alias("cost_share"),
        F.round(numeric.similarity_from_distance(F.abs("c_acctbal")), 9).alias("closeness"))


def _fn_array(spark, base):
    v = F.col("vector")
    unit = F.array(*[F.lit(1.0 if i == 0 else 0.0) for i in range(64)])
    return stored_vectors(spark, base).select(
        "vec_id", F.round(numeric.squared_l2(v, numeric.zero_vector(64)), 6).alias("l2_to_zero"),
        F.round(numeric.cosine(v, unit), 6).alias("cosine_to_first"),
        F.round(numeric.dot(v, v), 6).alias("self_dot"), F.round(F.try_element_at("vector", F.lit(64)).cast("double"), 6).alias("last"),
        F.try_element_at("vector", F.lit(65)).cast("double").alias("beyond"))


def _fn_default_title(spark, base):
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    return tables.table(spark, base, "pages").select(
        "page_id", text.default_title(title, F.col("url")).alias("title"))


def _fn_date_coalesce(spark, base):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    meta = (F.when(F.col("o_orderstatus") == "P", F.create_map(F.lit("creation_date"), day, F.lit("created"), F.lit("x")))
            .when(F.col("o_orderstatus") == "O", F.create_map(F.lit("created"), day))
            .otherwise(F.create_map(F.lit("other"), day)))
    return tables.table(spark, base, "orders").select("o_orderkey", text.document_date(meta).alias("document_date"))


def _text_queries() -> dict[str, Query]:
    return {
        "scan_corpus": _scan_texts("documents", "doc_id", "text"),
        "scan_pages_raw": _scan_texts("pages", "page_id", "html"),
        "scan_chunks_json": _scan_chunks_json,
        "corpus_store": _corpus_store,
        "embedding_store": _embedding_store,
        "similarity_threshold": _search_cosine(0.5),
        "confidence_gate": _confidence_gate,
        "join_chunk_document": lambda s, b: answers.join_chunk_document(
            chunk_table(s, b), documents(s, b).select("doc_id", "lang", "source")).select(
                "chunk_id", "doc_id", "lang", "source", F.col("end_idx").cast("bigint").alias("end_idx")),
        "join_doc_embedding": _join_doc_embedding,
        "join_query_corpus": lambda s, b: vectors.similarity_summary(stored_vectors(s, b), _own_queries(s, b), ["vec_id"]),
        "join_query_postings": lambda s, b: lexical.lexical_matches(
            lexical.lexical_index(chunk_table(s, b), KEYS), questions(s, b)),
        "join_positional": _join_positional,
        "document_stats": lambda s, b: chunking.document_stats(spread_documents(s, b)),
        "corpus_stats": lambda s, b: lexical.corpus_stats(chunk_table(s, b), KEYS),
        "chunk_documents": lambda s, b: _big(chunk_table(s, b), "pos", "start_idx", "end_idx"),
        "knn_l2": _knn_l2,
        "search_cosine": _search_cosine(0.0),
        "search_tfidf": lambda s, b: _big(_tfidf_hits(s, b), "rank"),
        "search_bm25": _search_bm25,
        "retrieve_auto": _semantic,
        "normalized_score": _normalized_score,
        "assemble_context": _assemble_context,
        "extract_answer": _extract_answer,
        "answer_question": _answered,
        "answer_with_sources": _answer_with_sources,
        "source_references": _source_references,
        "answer_batch": _answer_batch,
        "embed_text": _embed_text,
        "embed_chunks": _embed_chunks,
        "union_chunks": _union_chunks,
        "word_set_ops": _word_set_ops,
        "fn_string": _fn_string,
        "fn_math": _fn_math,
        "fn_array": _fn_array,
        "fn_default_title": _fn_default_title,
        "fn_date_coalesce": _fn_date_coalesce,
    }


ID = "customer_id"
LABEL = "label_sig"


def _impute_median(spark, base):
    df = _cf_staged(spark, base).select(ID, *NUMERIC)
    return prep.impute_median(df, prep.medians(df, NUMERIC))


def _impute_mode(spark, base):
    df = _cf_staged(spark, base).select(ID, *CATEGORICAL)
    return prep.impute_mode(df, prep.modes(df, CATEGORICAL))


def _standardize(spark, base):
    df = _impute_median(spark, base)
    return prep.standardize(df, prep.scaling(df, NUMERIC)).select(ID, *[F.round(c, 6).alias(c) for c in NUMERIC])


def _one_hot(spark, base):
    filled = _impute_mode(spark, base)
    df = staged(filled.select(ID, *[F.col(c).alias(f"cat_{c}") for c in CATEGORICAL]), "categories")
    indexer, encoder = prep.one_hot_stages(CATEGORICAL)
    index = indexer.fit(df)
    indexed = index.transform(df)
    coded = encoder.fit(indexed).transform(indexed)

    def slots(column, names):
        return F.transform(vector_to_array(f"onehot_{column}"), lambda v, i: F.struct(
            F.lit(column).alias("column_name"), F.lit(list(names))[i].alias("category"),
            v.cast("int").alias("value")))

    rows = F.concat(*[slots(c, names) for c, names in zip(CATEGORICAL, index.labelsArray)])
    return coded.select(ID, F.inline(F.filter(rows, lambda r: r["value"] > 0)))


def _prep_pipeline(spark, base):
    df = staged(split.stratified_split(_cf_staged(spark, base), "Churn", ID), "split")
    train, _ = split.train_test(df)
    fitted = prep.fit_preparation(train, "Churn", [ID])
    values = vector_to_array("features")
    return fitted.transform(df).select(
        ID, F.col("is_test").cast("int").alias("is_test"), F.size(values).cast("bigint").alias("n_slots"),
        F.round(F.aggregate(values, F.lit(0.0), lambda a, v: a + v), 4).alias("slot_sum"))


def _labelled(spark, base):
    """The feature view with the learnable label, without what it is made of."""
    return scored_customers(spark, base).drop("rule_score", "pred", "Churn")


def _trained(spark, base, kind, params=None):
    train, test = training.hold_out(_labelled(spark, base), LABEL, ID)
    prepared = training.prepare_training(train, LABEL, [ID])
    return training.fit_model(prepared, kind, params), prepared, train, test


def _train(kind):
    def run(spark, base):
        model, _, _, test = _trained(spark, base, kind)
        row = {"model": kind, "ordinal": 0, **training.evaluate_model(model, test, LABEL)}
        return spark.createDataFrame([tuple(row[f.name] for f in training.METRIC_SCHEMA.fields)], training.METRIC_SCHEMA)
    return run


def _score(spark, base):
    model, _, train, test = _trained(spark, base, "LogisticRegression")
    scored = training.score(model, train.unionByName(test))
    p, band = F.col("churn_probability"), F.col("risk_category")
    agrees = F.when(p <= 0, band.isNull()).when(p <= 0.3, band == "Low Risk").when(p <= 0.7, band == "Medium Risk") \
        .otherwise(band == "High Risk")
    return scored.select(
        ID, LABEL, p.between(0, 1).cast("int").alias("in_range"), agrees.cast("int").alias("band_agrees"),
        ((F.col("churn_prediction") == 1) == (p > 0.5)).cast("int").alias("prediction_agrees"))


def _compare_models(spark, base):
    train, test = training.hold_out(_labelled(spark, base), LABEL, ID)
    return training.compare_models(train, test, LABEL, [ID]).metrics


def _grid_search(spark, base):
    train, _ = training.hold_out(_labelled(spark, base), LABEL, ID)
    return training.grid_search(train, LABEL, ID, "LogisticRegression", [ID]).results


def _model_store(spark, base):
    model, _, train, test = _trained(spark, base, "LogisticRegression")
    folder = scratch_path(spark, "models")
    training.save_model(model, folder, spark)
    again = training.load_model(folder, spark)
    rows = train.unionByName(test)
    first = training.score(model, rows).select(ID, F.col("churn_probability").alias("saved"))
    second = training.score(again, rows).select(ID, F.col("churn_probability").alias("loaded"))
    return first.join(second, ID).select(ID, (F.col("saved") == F.col("loaded")).cast("int").alias("same"))


def _model_metadata(spark, base):
    model, prepared, _, test = _trained(spark, base, "LogisticRegression")
    performance = training.evaluate_model(model, test, LABEL)
    path = training.save_model(model, scratch_path(spark, "models"), spark)
    meta = training.model_metadata(spark, "LogisticRegression", LABEL, performance,
                                   prepared.preparation.numeric + prepared.preparation.categorical, path)
    stored = tables.load_table(spark, tables.write_json(meta, scratch_path(spark, "metadata")), meta.schema, "json")
    return stored.select("model_type", "target_column", F.col("performance")["roc_auc"].alias("roc_auc"),
                         F.array_join("feature_names", ",").alias("feature_names"))


def _rule_explained(spark, base):
    df = staged(scored_customers(spark, base), "scored")
    return df, explain.centred_terms(df, risk.rule_terms())


def _explain_rows(spark, base):
    df, terms = _rule_explained(spark, base)
    return explain.long_contributions(explain.riskiest(df, "rule_score", 5, ID), terms, ID)


def _topk_factors(spark, base):
    df, terms = _rule_explained(spark, base)
    factors = explain.top_factors(df, terms, ID, k=3)
    return _big(factors.select(ID, "feature", "importance", "rank"), "rank")


def _explanation_report(spark, base):
    df, terms = _rule_explained(spark, base)
    rows = staged(explain.riskiest(df, "rule_score", 5, ID), "riskiest")
    factors = explain.top_factors(rows, terms, ID)
    report = explain.explanation_report(rows, factors, ID, "rule_score")
    return report.select(ID, "risk_probability", F.posexplode("top_factors").alias("pos", "f")).select(
        ID, "risk_probability", (F.col("pos") + 1).cast("bigint").alias("rank"), "f.feature", "f.importance")


def _explain_linear(spark, base):
    model, prepared, train, test = _trained(spark, base, "LogisticRegression")
    rows = training.score(model, test).orderBy(F.desc("churn_probability"), ID).limit(5).select(*test.columns)
    return explain.linear_contributions(model, prepared.preparation, rows, train, ID)


def _explain_shapley(spark, base):
    model, prepared, _, test = _trained(spark, base, "RandomForest", {})
    rows = training.score(model, test).orderBy(F.desc("churn_probability"), ID).limit(5).select(*test.columns)
    names = [c for c in test.columns if c in prepared.preparation.numeric + prepared.preparation.categorical]
    return explain.sampled_shapley(model, prepared.preparation, rows, ID, names)


def _risk_pipeline(spark, base):
    run = run_risk_pipeline(spark, _labelled(spark, base), scratch_path(spark, "risk-run"), LABEL, ID)
    return run.distribution


def _model_queries() -> dict[str, Query]:
    return {
        "impute_median": _impute_median,
        "impute_mode": _impute_mode,
        "standardize": _standardize,
        "one_hot": _one_hot,
        "prep_pipeline": _prep_pipeline,
        "train_lr": _train("LogisticRegression"),
        "train_rf": _train("RandomForest"),
        "train_gbt": _train("GradientBoosting"),
        "score": _score,
        "compare_models": _compare_models,
        "grid_search": _grid_search,
        "model_store": _model_store,
        "model_metadata": _model_metadata,
        "explain_rows": _explain_rows,
        "explain_rows_linear": _explain_linear,
        "explain_rows_shapley": _explain_shapley,
        "topk_factors": _topk_factors,
        "feature_importance": lambda s, b: explain.feature_importance(*_rule_explained(s, b)),
        "explanation_report": _explanation_report,
        "risk_pipeline": _risk_pipeline,
    }


def queries() -> dict[str, Query]:
    return {**_table_queries(), **_evaluation_queries(), **_text_queries(), **_model_queries()}
