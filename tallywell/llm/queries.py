"""Registered queries of the numbered operators, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.llm import (byte_bpe, centroid_clusters, chat_format, decontamination, exact_topk, license_scan, line_dedup,
                           maxent_lm, near_dedup, phrases, quality_rules, token_counts, toxicity)

Query = Callable[[SparkSession, str], DataFrame]


def read(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}.parquet")


def op1_token_counts(spark, base):
    return token_counts.count_tokens(read(spark, base, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_decontamination(spark, base):
    found = decontamination.find_leaks(read(spark, base, "documents"), read(spark, base, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "score",
                        F.col("question").alias("question_overlap"), F.col("answer").alias("answer_overlap"))


def op3_quality_rules(spark, base):
    docs = read(spark, base, "documents").select("doc_id", "text")
    model = quality_rules.fit(docs, read(spark, base, "labels"))
    doc = F.col("doc_id")
    return quality_rules.score_quality(docs, model).select(
        "doc_id", quality_rules.held_out(doc).alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op4_near_dedup(spark, base):
    found = near_dedup.near_duplicates(read(spark, base, "documents"))
    return found.select(F.col("doc").alias("doc_id"), "class_id", "class_size", "kept")


def op5_license_scan(spark, base):
    return license_scan.scan_licenses(read(spark, base, "documents"))


def op6_byte_bpe(spark, base):
    return byte_bpe.round_trip(read(spark, base, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                               public_tokenizers.PATTERN)


def op7_chat_format(spark, base):
    told = read(spark, base, "conversations").select("conv_id", "turn", "role", "text")
    line = F.lit("\\### Assistant: </turn> ok")
    added = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  line.alias("text"))
    done = chat_format.format_conversations(told.unionByName(added))
    return done.select(F.col("conv").alias("conv_id"), "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                       "formatted_chars")


def op8_toxicity(spark, base):
    docs = read(spark, base, "documents").select("doc_id", "text")
    labels = read(spark, base, "labels").where(~quality_rules.held_out(F.col("doc_id")))
    model = toxicity.fit(docs, labels, "toxic", split_top=toxicity.GRADES)
    return toxicity.score_severity(docs, model)


def op9_line_dedup(spark, base):
    return line_dedup.dedup_lines(read(spark, base, "documents").select("doc_id", "text"))


def op10_exact_topk(spark, base):
    vectors = read(spark, base, "embeddings")
    found = exact_topk.exact_topk(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5, scale=256.0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op11_centroid_clusters(spark, base):
    found = centroid_clusters.cluster_vectors(read(spark, base, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_maxent_lm(spark, base):
    docs = read(spark, base, "documents").select("doc_id", "text")
    return maxent_lm.score_texts(docs, maxent_lm.fit(docs)).withColumnRenamed("id", "doc_id")


def op13_phrases(spark, base):
    return phrases.mine_phrases(read(spark, base, "documents"))


OP7_SQL = r"""
WITH told AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
escaped AS (
    SELECT *, replace(replace(replace(text, '\', '\\'), '### ', '#\## '), '</turn>', '<\/turn>') AS text_out,
        replace(replace(replace(replace(role, '\', '\\'), '### ', '#\## '), '</turn>', '<\/turn>'), ':', '\:') AS role_out
    FROM told)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length('### ' || role_out || ':' || chr(10) || text_out || '</turn>' || chr(10))) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""

OP9_SQL = r"""
WITH lined AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
numbered AS (SELECT doc_id, lines, unnest(range(1, greatest(len(lines) - 1, 1))) AS place FROM lined WHERE len(lines) >= 3),
windows AS (
    SELECT doc_id, place, lines[place:place + 2] AS own FROM numbered
    WHERE trim(lines[place], ' ') <> '' OR trim(lines[place + 1], ' ') <> '' OR trim(lines[place + 2], ' ') <> ''),
ranked AS (SELECT doc_id, place, row_number() OVER (PARTITION BY own ORDER BY doc_id, place) AS seen FROM windows),
covered AS (
    SELECT doc_id, list(DISTINCT line) AS gone
    FROM (SELECT doc_id, unnest(range(place, place + 3)) AS line FROM ranked WHERE seen > 1) GROUP BY doc_id)
SELECT doc_id,
    CASE WHEN gone IS NULL THEN text ELSE coalesce(array_to_string(
        [lines[i] FOR i IN range(1, len(lines) + 1) IF NOT list_contains(gone, i)], chr(10)), '') END AS text,
    CAST(coalesce(len(lines), 0) AS BIGINT) AS dedup_lines, CAST(coalesce(len(gone), 0) AS BIGINT) AS dedup_removed
FROM lined LEFT JOIN covered USING (doc_id)
"""

OP10_SQL = """
WITH usable AS (
    SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
        AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
        CAST(list_sum([q.v[i] * c.v[i] FOR i IN range(1, least(len(q.v), len(c.v)) + 1)]) AS BIGINT) AS score
    FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


OP11_ROUND = """
near{n} AS MATERIALIZED (
    SELECT row, vec_id, v, arg_min(struct_pack(c, d), struct_pack(d, c)) AS hit FROM (
        SELECT row, vec_id, v, c, list_sum([(v[i] - w[i]) * (v[i] - w[i]) FOR i IN range(1, 65)]) AS d
        FROM kept, centroids{n}) GROUP BY row, vec_id, v),
sums{n} AS (
    SELECT c, i, sum(x) AS s, count(*) AS n
    FROM (SELECT hit.c AS c, unnest(range(1, 65)) AS i, unnest(v) AS x FROM near{n}) GROUP BY c, i),
moved{n} AS (
    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS w FROM sums{n} GROUP BY c),
centroids{m} AS MATERIALIZED (SELECT o.c, coalesce(m.w, o.w) AS w FROM centroids{n} o LEFT JOIN moved{n} m USING (c)),"""

OP11_SQL = """
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS row, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
    FROM embeddings WHERE len(embedding) = 64 AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
centroids0 AS MATERIALIZED (
    SELECT CAST(row_number() OVER (ORDER BY h, v) - 1 AS INTEGER) AS c, v AS w
    FROM (SELECT sha256('2:' || vec_id) AS h, v FROM kept WHERE vec_id IS NOT NULL) QUALIFY c < 40),""" + "".join(
    OP11_ROUND.format(n=n, m=n + 1) for n in range(5)) + """
last AS MATERIALIZED (
    SELECT row, vec_id, arg_min(struct_pack(c, d), struct_pack(d, c)) AS hit FROM (
        SELECT row, vec_id, c, list_sum([(v[i] - w[i]) * (v[i] - w[i]) FOR i IN range(1, 65)]) AS d
        FROM kept, centroids5) GROUP BY row, vec_id)
SELECT vec_id, hit.c AS cluster, CAST(hit.d AS BIGINT) AS distance,
    CAST(sum(hit.d) OVER (PARTITION BY hit.c) AS BIGINT) AS cluster_inertia, CAST(sum(hit.d) OVER () AS BIGINT) AS inertia,
    sha256(array_to_string(w, ',')) AS centroid_sha256
FROM last JOIN centroids5 ON hit.c = centroids5.c
"""

OP13_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS piece, words FROM (
        SELECT lang, [w FOR w IN regexp_split_to_array(piece, '[ \t]+') IF w <> ''] AS words FROM (
            SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n-\r]')) AS piece FROM documents))
    WHERE len(words) > 0),
totals AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM pieces GROUP BY lang),
runs AS (
    SELECT lang, array_to_string(words[p:p + size - 1], ' ') AS phrase, size FROM (
        SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS p
        FROM (SELECT lang, words, unnest(range(1, 5)) AS size FROM pieces))),
counts AS MATERIALIZED (SELECT lang, phrase, size, count(*) AS f FROM runs GROUP BY lang, phrase, size HAVING count(*) >= 30),
cuts AS (
    SELECT lang, phrase, f AS a, k, string_split(phrase, ' ') AS w
    FROM (SELECT *, unnest(range(1, size)) AS k FROM counts WHERE size >= 2)),
told AS (
    SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, CAST(CAST(2000000 AS HUGEINT) * c.a // (x.f + y.f) AS BIGINT) AS score
    FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
    JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:len(c.w)], ' ')),
worst AS (SELECT * FROM told QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_runs AS (
    SELECT lang, array_to_string(w[p:p + n - 1], ' ') AS phrase, f FROM (
        SELECT lang, f, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM (
            SELECT lang, f, string_split(phrase, ' ') AS w, unnest(range(2, size)) AS n FROM counts WHERE size >= 3))),
longer AS (SELECT lang, phrase, max(f) AS longer FROM inner_runs GROUP BY lang, phrase),
ranked AS (
    SELECT w.*, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank
    FROM worst w LEFT JOIN longer g ON g.lang = w.lang AND g.phrase = w.phrase
    WHERE longer IS NULL OR CAST(100 AS HUGEINT) * longer < CAST(80 AS HUGEINT) * a)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_token_counts, op2_decontamination, op3_quality_rules, op4_near_dedup,
                                    op5_license_scan, op6_byte_bpe, op7_chat_format, op8_toxicity, op9_line_dedup,
                                    op10_exact_topk, op11_centroid_clusters, op12_maxent_lm,
                                    op13_phrases)}


def oracle_sql() -> dict[str, str]:
    return {"op7_chat_format": OP7_SQL, "op9_line_dedup": OP9_SQL, "op10_exact_topk": OP10_SQL,
            "op11_centroid_clusters": OP11_SQL, "op13_phrases": OP13_SQL}
