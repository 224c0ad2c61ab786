"""Exact top-k inner products by exhaustive term-at-a-time accumulation.

Every component position is a term; its posting list in a block of candidates
holds the candidates with a weight there. The queries' rows are sparse: for
each term the queries hold, the weighted postings are scattered into a dense
array of scores, one row per query and one column per candidate of the block.
Partition selection keeps each query's k best of a task, and one shuffle of at
most k rows per query and task merges them.

Queries are taken in blocks of about ``QUERY_BLOCK`` rows, one after the other: a
block is broadcast, its best rows are written, and the broadcast is released
before the next, whatever the number of queries. The candidates stay where they
lie.

Cases: vectors that are null, empty, or hold null or non-finite components take
no part, nor do rows without an id; ties go to the smaller id; fewer candidates
than k give fewer rows; vectors of different lengths share the positions they
both have; repeated ids: a query's own id is no candidate, further rows of
another id are candidates each, and a query id with several rows gets the best
k of all their scores, row by row; components and scores beyond a long are cut to its range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywell.llm.rows import quoted
from tallywell.session import staged

#: Queries in one broadcast, candidates in one block of scores, queries in one block of scores.
QUERY_BLOCK, CANDIDATE_BLOCK, QUERY_ROWS = 20_000, 4096, 256


def quantised(df: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """``id, vector`` with each component x as floor(scale * x); rows that take part only."""
    vector = F.col(quoted(vector_col)).cast("array<double>")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (df.select(F.col(quoted(id_col)).cast("long").alias("id"), vector.alias("vector"))
            .where(F.col("id").isNotNull() & F.col("vector").isNotNull())
            .where((F.size("vector") > 0) & ~bad)
            .withColumn("vector", F.transform("vector", lambda x: F.floor(F.lit(float(scale)) * x))))


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Rows of the integers; shorter rows end in zeros."""
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    wide = int(sizes.max(initial=0))
    if len(sizes) and (sizes == wide).all():
        return values[offsets[0]:offsets[-1]].reshape(len(sizes), wide)
    out = np.zeros((len(sizes), wide), np.int64)
    out[np.arange(wide) < sizes[:, None]] = values[offsets[0]:offsets[-1]]
    return out


def accumulate(queries: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Scores of every query with every candidate of the block, term at a time."""
    terms = min(queries.shape[1], block.shape[1])
    reach = float(np.abs(queries.astype(float)).max(initial=0)) * float(np.abs(block.astype(float)).max(initial=0)) * terms
    kind = np.int32 if reach < 2**31 else np.int64 if reach < 2**63 else object
    scores = np.zeros((len(queries), len(block)), kind)
    weights, held = block.T.astype(kind), queries.astype(kind)
    for term in range(terms):
        postings = np.flatnonzero(weights[term])
        rows = np.flatnonzero(held[:, term])
        if not len(postings) or not len(rows):
            continue
        # A list that nearly every candidate is in needs no index: the others add nothing.
        if 2 * len(postings) > len(block) and 2 * len(rows) > len(held):
            scores += held[:, term, None] * weights[term]
        else:
            scores[np.ix_(rows, postings)] += held[rows, term, None] * weights[term, postings]
    return scores if kind is not object else np.clip(scores, -2**63, 2**63 - 1).astype(np.int64)


def select(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row its k largest scores, ties to the smaller id: (row, id, score)."""
    if scores.shape[1] > k:
        cut = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]
        rows, at = np.nonzero(scores >= cut[:, None])
    else:
        rows, at = np.indices(scores.shape).reshape(2, -1)
    found, value = ids[at], scores[rows, at].astype(np.int64)
    return best(rows, found, value, k)


def best(rows, found, value, k):
    order = np.lexsort((found, -value, rows))
    rows, found, value = rows[order], found[order], value[order]
    first = np.searchsorted(rows, rows, side="left")
    keep = np.arange(len(rows)) - first < k
    return rows[keep], found[keep], value[keep]


def _search(df: DataFrame, k: int, shared) -> DataFrame:
    """Each task's k best candidates per row of the queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_ids, held = shared.value
        kept = [np.empty(0, np.int64)] * 3
        for batch in batches:
            for start in range(0, batch.num_rows, CANDIDATE_BLOCK):
                part = batch.slice(start, CANDIDATE_BLOCK)
                ids, block = part.column(0).to_numpy(), _matrix(part.column(1))
                parts = [kept]
                for at in range(0, len(held), QUERY_ROWS):
                    # k rows more than asked for could be the query's own; they go after the selection.
                    scores = accumulate(held[at:at + QUERY_ROWS], block)
                    same = own_ids[at:at + QUERY_ROWS]
                    many = int(np.unique(ids, return_counts=True)[1].max(initial=0))
                    rows, found, value = select(scores, ids, k + many)
                    fine = found != same[rows]
                    parts.append([rows[fine] + at, found[fine], value[fine]])
                kept = list(best(*[np.concatenate(c) for c in zip(*parts)], k))
        yield pa.RecordBatch.from_arrays(
            [pa.array(own_ids[kept[0]]), pa.array(kept[1]), pa.array(kept[2])], names=["query_id", "id", "score"])

    return df.mapInArrow(run, "query_id long, id long, score long")


def exact_topk(df: DataFrame, queries: DataFrame, k: int = 5, scale: float = 256.0, id_col: str = "vec_id",
               vector_col: str = "embedding", query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, id, score``: the k candidates of largest integer inner product of every query.

    ``df`` holds the candidates and ``queries`` the queries, both with an id and
    a vector. The row of a query's own id is no candidate of it.
    """
    spark = df.sparkSession
    candidates = quantised(df, id_col, vector_col, scale)
    asked = staged(quantised(queries, id_col, vector_col, scale).withColumn("row", F.monotonically_increasing_id()), "queries")
    blocks = max(1, -(-asked.count() // query_block))
    found = spark.createDataFrame([], "query_id long, id long, score long")
    for b in range(blocks):
        # About query_block rows.
        table = asked.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b).orderBy("id", "row").toArrow().combine_chunks()
        if not table.num_rows:
            continue
        shared = spark.sparkContext.broadcast((table.column("id").chunk(0).to_numpy(), _matrix(table.column("vector").chunk(0))))
        part = _search(candidates, k, shared)
        if blocks > 1:
            part = staged(_ranked(part, k).drop("rank"), "topk")
            shared.unpersist()
        found = part if blocks == 1 else found.unionByName(part)
    return _ranked(found, k).select("query_id", F.col("rank").cast("int"), "id", "score")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
