"""Clusters of integer vectors around centroids, the nearest centroid found by Orchard's search.

Every centroid has the list of the others, nearest first. A vector's search
starts at one centroid and walks down its list; a centroid that is closer takes
over and the walk goes on in its own list. Centroids already measured are
marked and not measured again. By the triangle inequality a centroid further
than twice the current distance from the current one cannot be closer, so the
walk stops strictly beyond; a centroid as close as the current one lies at
twice the distance at most, so ties are seen and go to the smaller number.

A round hands on one row of sums per cluster and task, whatever the vectors;
the centroids, ``k`` rows, are all that the driver and the broadcasts hold.
The vectors are read once a round and never shuffled.

Cases: vectors that are null, have another number of components, or hold null or
non-finite ones take no part; rows without an id are clustered and never start
a centroid; repeated ids are rows of their own, and of the rows of one id the
smaller vector starts first; fewer vectors than ``k`` give fewer centroids; an
empty cluster keeps its centroid; an empty table gives no row. Components are
cut to the range of a long and distances to its largest value; sums are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.llm.rows import quoted

CENTROIDS, ROUNDS, SEED = 40, 5, 2
#: Vectors searched side by side.
BLOCK = 4096
LONG = 2**63 - 1
#: Largest component whose squared distances, four times, are exact in a double, over 2^10 components.
EXACT = 2**19


def vectors_of(df: DataFrame, dims: int, id_col: str, vector_col: str) -> DataFrame:
    """``id, vector``: rows that take part."""
    vector = F.col(quoted(vector_col)).cast("array<double>")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (df.select(F.col(quoted(id_col)).alias("id"), vector.alias("vector"))
            .where(F.col("vector").isNotNull() & (F.size("vector") == dims)).where(~bad))


def quantised(column: pa.ListArray, dims: int, scale: float) -> np.ndarray:
    """Rows of floor(scale * x), as doubles where they are small enough to be exact."""
    values = np.floor(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims) * scale)
    if not values.size or (np.abs(values).max() <= EXACT and dims <= 1024):
        return values
    whole = np.array([[max(-LONG - 1, min(LONG, int(x))) for x in row] for row in values.tolist()], object)
    return whole.reshape(-1, dims)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    gap = a - b
    return np.einsum("ij,ij->i", gap, gap) if gap.dtype != object else (gap * gap).sum(axis=1)


class Orchard:
    """The centroids with their neighbour lists."""

    def __init__(self, centroids: list[list[int]]):
        self.exact = np.array(centroids, object)
        small = max((abs(x) for c in centroids for x in c), default=0) <= EXACT and len(centroids[0]) <= 1024
        self.at = self.exact.astype(float) if small else self.exact
        apart = np.array([squared(self.at, np.broadcast_to(c, self.at.shape)) for c in self.at])
        number = np.arange(len(centroids))
        # The list of a centroid begins with itself.
        self.near = np.array([sorted(number, key=lambda j: (j != i, apart[i, j], j)) for i in number])
        self.gap = np.take_along_axis(apart, self.near, axis=1)
        # The first guess looks at the few components in which the centroids differ most.
        self.wide = np.argsort(-self.at.astype(float).var(axis=0), kind="stable")[:8]

    def guess(self, rows: np.ndarray) -> np.ndarray:
        own, others = rows[:, self.wide].astype(float), self.at[:, self.wide].astype(float)
        return ((others ** 2).sum(axis=1) - 2 * own @ others.T).argmin(axis=1)

    def search(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Per row its nearest centroid and squared distance, and the number of distances measured."""
        at = self.at if rows.dtype == self.at.dtype else self.exact
        rows = rows if at is self.at else rows.astype(np.int64).astype(object) if rows.dtype != object else rows
        size, k = len(rows), len(at)
        best = self.guess(rows)
        least = squared(rows, at[best])
        seen = np.zeros((size, k), bool)
        seen[np.arange(size), best] = True
        place, measured = np.ones(size, np.int64), size
        walking = np.arange(size) if k > 1 else np.empty(0, np.int64)
        while len(walking):
            own, where = best[walking], place[walking]
            inside = np.asarray(self.gap[own, where] <= 4 * least[walking], bool)
            walking, own, where = walking[inside], own[inside], where[inside]
            other = self.near[own, where]
            place[walking] = where + 1
            new = ~seen[walking, other]
            who, other = walking[new], other[new]
            if len(who):
                seen[who, other] = True
                found = squared(rows[who], at[other])
                measured += len(who)
                closer = np.asarray((found < least[who]) | ((found == least[who]) & (other < best[who])), bool)
                moved = who[closer]
                best[moved], least[moved], place[moved] = other[closer], found[closer], 1
            walking = walking[place[walking] < k]
        return best, least, measured


def _blocks(batches: Iterator[pa.RecordBatch], dims: int, scale: float):
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            part = batch.slice(start, BLOCK)
            yield part.column(0), quantised(part.column(1), dims, scale)


def first_centroids(df: DataFrame, k: int, seed: int, dims: int, scale: float) -> list[list[int]]:
    """The k vectors whose ids have the smallest hashes."""
    rows = (df.where(F.col("id").isNotNull())
            .select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256).alias("hash"), "vector")
            .orderBy("hash", "vector").limit(k).collect())
    if not rows:
        return []
    held = quantised(pa.array([r.vector for r in rows], pa.list_(pa.float64())), dims, scale)
    return [[int(x) for x in row] for row in held.tolist()]


def move_centroids(df: DataFrame, centroids: list[list[int]], dims: int, scale: float) -> list[list[int]]:
    """Centroids after one round: floor of the mean of each non-empty cluster."""
    shared = df.sparkSession.sparkContext.broadcast(Orchard(centroids))
    names = [f"s{i}" for i in range(dims)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, k = shared.value, len(shared.value.at)
        count, sums = np.zeros(k, np.int64), np.zeros((k, dims), object)
        for _, rows in _blocks(batches, dims, scale):
            best, _, _ = search.search(rows)
            count += np.bincount(best, minlength=k)
            for c in np.unique(best):
                part = rows[best == c].sum(axis=0)  # a block's sum of exact doubles is exact
                sums[c] += np.array([int(x) for x in part], object)
        held = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held.astype(np.int32)), pa.array(count[held]),
             *[pa.array([int(x) for x in sums[held, i]], pa.decimal128(38, 0)) for i in range(dims)]],
            names=["cluster", "n", *names])

    kinds = ", ".join(["cluster int", "n long", *[f"{n} decimal(38,0)" for n in names]])
    # One row per centroid.
    found = (df.mapInArrow(run, kinds).groupBy("cluster")
             .agg(F.sum("n").alias("n"), *[F.sum(n).alias(n) for n in names]).collect())
    shared.unpersist()
    moved = list(centroids)
    for row in found:
        moved[row.cluster] = [int(row[n]) // row.n for n in names]
    return moved


def cluster_vectors(df: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, dims: int = 64,
                    scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id, cluster, distance, cluster_inertia, inertia, centroid_sha256, centroid`` of every vector that takes part."""
    spark = df.sparkSession
    rows = vectors_of(df, dims, id_col, vector_col)
    kind = rows.schema["id"].dataType.simpleString()
    centroids = first_centroids(rows, k, seed, dims, scale)
    if not centroids:
        return spark.createDataFrame([], f"id {kind}, cluster int, distance long, cluster_inertia long, inertia long, "
                                         "centroid_sha256 string, centroid array<long>")
    for _ in range(rounds):
        centroids = move_centroids(rows, centroids, dims, scale)
    shared = spark.sparkContext.broadcast(Orchard(centroids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, own in _blocks(batches, dims, scale):
            best, least, _ = shared.value.search(own)
            yield pa.RecordBatch.from_arrays([ids, pa.array(best.astype(np.int32)),
                                              pa.array([min(LONG, int(x)) for x in least.tolist()], pa.int64())],
                                             names=["id", "cluster", "distance"])

    assigned = rows.mapInArrow(run, f"id {kind}, cluster int, distance long")
    # One row per centroid.
    sums = {r.cluster: int(r.total) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    whole = min(LONG, sum(sums.values()))
    told = [(c, min(LONG, s), whole, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest(), centroids[c])
            for c, s in sums.items()]
    per_cluster = spark.createDataFrame(
        told, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string, centroid array<long>")
    return (assigned.join(F.broadcast(per_cluster), "cluster")
            .select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid"))
