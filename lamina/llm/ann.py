"""Nearest neighbours by adaptive dimension scan over probed lists.

Index: centroids (k-means on a bounded sample) deal all vectors into lists. A list is cut into
blocks of bounded size; a block holds its vectors rotated by one random orthogonal matrix,
in column blocks of `STEP` dimensions, next to the originals.

Search: each query goes to its nearest lists. In a block, distances grow column block by
column block for all candidates at once. After d of D dimensions a candidate is given up
if its partial distance, scaled by D / d, exceeds the best known tenth distance by
more than a test at significance `EPSILON` allows: rotated, partial distances are unbiased
estimates with a spread of about 1 / sqrt(d). What is left has its distance computed in double
precision on the original vectors.

The number of lists to probe is the smallest that reaches the wished recall for a sample of queries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STEP = 8
EPSILON = 2.1
BLOCK = 4096  # vectors of a block; with the queries of a block it bounds a task's memory
QUERIES = 256  # queries of one block of queries


@dataclass
class Index:
    centroids: np.ndarray
    rotation: np.ndarray
    probes: int


def usable(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector is no null, zero or empty one and has no null, NaN or infinite component."""
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return df.where(v.isNotNull() & fine & F.exists(v, lambda x: x != 0))


def train(vectors: DataFrame, sample: int = 8192, recall: float = 0.985, k: int = 10, rounds: int = 8) -> Index | None:
    """Fit on at most `sample` of `vec_id`, `embedding`, chosen by a hash; None for an empty table."""
    total = vectors.count()
    if not total:
        return None
    kept = vectors.select("embedding", F.xxhash64("vec_id", F.lit("fit")).alias("h")).orderBy("h").limit(sample)
    rows = [r["embedding"] for r in kept.collect()]
    sizes = np.bincount([len(r) for r in rows])
    data = np.array([r for r in rows if len(r) == sizes.argmax()], np.float64)  # the usual dimension
    count, dims = data.shape
    rng = np.random.default_rng(7)
    lists = int(max(1, min(1024, count // 16, round(np.sqrt(total)))))
    centroids = data[rng.choice(count, lists, replace=False)]
    for _ in range(rounds):
        own = _nearest(data, centroids)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, data)
        sizes = np.bincount(own, minlength=lists)
        centroids = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centroids)
    rotation = np.linalg.qr(rng.normal(size=(dims, dims)))[0]
    # How many lists do the sample's own neighbours lie in?
    own, asked = _nearest(data, centroids), min(count, 200)
    d = ((data[:asked, None, :] - data[None]) ** 2).sum(-1) if asked * count * dims < 2e7 else np.stack(
        [((q - data) ** 2).sum(-1) for q in data[:asked]])
    d[np.arange(asked), np.arange(asked)] = np.inf
    near = np.argsort(d, axis=1)[:, :max(1, min(k, count - 1))]
    order = np.argsort(np.argsort(_distances(data[:asked], centroids), axis=1), axis=1)
    places = np.sort(order[np.arange(asked)[:, None], own[near]].ravel())
    probes = int(places[min(len(places) - 1, int(np.ceil(recall * len(places))))]) + 1
    return Index(centroids, rotation, min(lists, probes + 1))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None]


def _nearest(data: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.concatenate([_distances(data[i: i + 4096], centroids).argmin(1) for i in range(0, len(data), 4096)])


def _matrix(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of `dims` components as a matrix, and which rows have that many."""
    sizes = np.asarray(column.value_lengths().fill_null(0))
    fits = sizes == dims
    flat = column.filter(pa.array(fits)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(-1, dims), np.flatnonzero(fits)


def _assigned(shared):
    """The list of each vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        for batch in batches:
            data, rows = _matrix(batch.column("embedding"), index.centroids.shape[1])
            own = _nearest(data, index.centroids) if len(data) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own.astype(np.int32)), *(batch.column(c).take(pa.array(rows)) for c in ("vec_id", "embedding"))],
                ["list", "vec_id", "embedding"])
    return run


def _probed(shared):
    """The lists that each query goes to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        for batch in batches:
            data, rows = _matrix(batch.column("embedding"), index.centroids.shape[1])
            if not len(data):
                continue
            order = np.argpartition(_distances(data, index.centroids), index.probes - 1, axis=1)[:, :index.probes]
            take = pa.array(np.repeat(rows, index.probes))
            yield pa.RecordBatch.from_arrays(
                [pa.array(order.ravel().astype(np.int32)), *(batch.column(c).take(take) for c in ("vec_id", "embedding"))],
                ["list", "vec_id", "embedding"])
    return run


def scan(query: np.ndarray, turned: np.ndarray, rows: np.ndarray, columns: list[np.ndarray], data: np.ndarray,
         ids: np.ndarray, own: int, best: list[tuple[float, int]], k: int) -> list[tuple[float, int]]:
    """`best` (distance, id) pairs, improved by a block. Candidates are dropped as the tests say."""
    dims = len(query)
    alive = rows
    partial = np.zeros(len(alive))
    bound = best[-1][0] ** 2 if len(best) == k else np.inf
    for j, column in enumerate(columns):
        low = j * STEP
        partial = partial + ((column[:, alive] - turned[low: low + STEP, None]) ** 2).sum(axis=0)
        seen = min(dims, low + STEP)
        if np.isfinite(bound):
            limit = bound * seen / dims * (1 + EPSILON / np.sqrt(seen)) ** 2 if seen < dims else bound * (1 + 1e-9) + 1e-12
            stay = partial <= limit
            alive, partial = alive[stay], partial[stay]
            if not len(alive):
                return best
    alive = alive[ids[alive] != own]
    if len(alive) > k:  # what rotation's rounding could have moved stays in
        exact = np.sqrt(((data[alive] - query) ** 2).sum(axis=1))
        order = np.lexsort((ids[alive], exact))[:k]
        found = list(zip(exact[order].tolist(), ids[alive[order]].tolist(), strict=True))
    else:
        found = list(zip(np.sqrt(((data[alive] - query) ** 2).sum(axis=1)).tolist(), ids[alive].tolist(), strict=True))
    return sorted(set(best) | set(found))[:k]


def _searched(shared, k: int):
    """One row is a block of a list and a block of the queries that probe the list."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        dims = index.centroids.shape[1]
        for batch in batches:
            for i in range(batch.num_rows):
                members, asked = batch.column("members")[i].values, batch.column("asked")[i].values
                data = members.field("embedding").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
                ids, once = np.unique(members.field("vec_id").to_numpy(), return_index=True)
                data = data[once]
                queries = asked.field("embedding").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
                numbers = asked.field("vec_id").to_numpy()
                turned = np.ascontiguousarray((data @ index.rotation).T)
                columns = [turned[j: j + STEP] for j in range(0, dims, STEP)]
                turned_queries = queries @ index.rotation
                everyone = np.arange(len(ids))
                out: list[tuple[int, float, int]] = []
                for q in range(len(numbers)):
                    best: list[tuple[float, int]] = []
                    for low in (0, 256):  # the first part gives the bound for the rest
                        rows = everyone[low: 256 if low == 0 else None]
                        if len(rows):
                            best = scan(queries[q], turned_queries[q], rows, columns, data, ids, int(numbers[q]), best, k)
                    out += [(int(numbers[q]), d, v) for d, v in best]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.int64()),
                     pa.array([r[1] for r in out], pa.float64())], ["query_id", "vec_id", "score"])
    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, index: Index | None = None) -> DataFrame:
    """`query_id`, `rank`, `vec_id`, `score`: the `k` nearest found of each query, by Euclidean distance.

    Both frames have vec_id and embedding. A query's own vec_id is no candidate. Vectors that are
    null, empty, zero, of another dimension than the index, or hold null or
    non-finite components take no part, nor rows without a vec_id. Equal distances: smaller vec_id first.
    Rows repeated whole count once. Empty tables give no rows.
    """
    spark = vectors.sparkSession
    vectors, queries = (usable(d.where("vec_id is not null").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")))
        for d in (vectors, queries))
    index = index or train(vectors)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shared = spark.sparkContext.broadcast(index)
    schema = "list int, vec_id long, embedding array<double>"
    both = F.struct("vec_id", "embedding")

    def blocked(frame: DataFrame, size: int, name: str) -> DataFrame:
        """Blocks of about `size` rows of a list, by a hash of the rows: no list is one group."""
        counts = frame.groupBy("list").agg(F.ceil(F.count("*") / F.lit(size)).alias("parts"))
        return (frame.join(F.broadcast(counts), "list")  # a row for each list, 1,024 at most
                .withColumn("part", F.pmod(F.xxhash64("vec_id"), "parts"))
                .groupBy("list", "part").agg(F.collect_list(both).alias(name)).drop("part"))

    members = blocked(vectors.mapInArrow(_assigned(shared), schema), BLOCK, "members")
    asked = blocked(queries.mapInArrow(_probed(shared), schema), QUERIES, "asked")
    found = members.join(asked, "list").select("members", "asked").mapInArrow(
        _searched(shared, k), "query_id long, vec_id long, score double").distinct()
    first = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(first)).where(f"rank <= {k}")
            .select("query_id", "rank", "vec_id", "score"))
