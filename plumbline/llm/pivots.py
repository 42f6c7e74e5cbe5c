"""Centroid clustering of integer vectors; a table of distances to fixed pivots (LAESA) tells which centroids need an exact distance."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import stored

#: Pivots: those of the starting vectors that lie farthest from each other.
PIVOTS = 12
#: Components up to this size have squared distances that fit a long; up to the second, a double holds every product sum.
LARGEST, EXACT_DOUBLE = 1 << 27, 1 << 22
#: Vectors that meet the centroids at once.
BATCH_ROWS = 8192
#: Relative slack of a bound from square roots in double precision.
SLACK = 1e-9


def kept_vectors(df: DataFrame, id_col: str, vec_col: str, dim: int, scale: float) -> DataFrame:
    """(vec_id, v): components as floor(scale * x) of the vectors with a known id and exactly dim components, none null or non-finite."""
    x = F.col(vec_col).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    whole = df.where(F.col(id_col).isNotNull() & (F.size(vec_col) == dim) & ~bad).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda c: c * scale).alias("y"))
    large = F.exists("y", lambda c: F.abs(c) >= float(LARGEST))
    y = F.when(large, F.raise_error(F.lit(f"a scaled component of {LARGEST} or more has no exact distance"))).otherwise(F.col("y"))
    return whole.select("vec_id", F.transform(y, lambda c: F.floor(c)).cast("array<int>").alias("v"))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest digest of seed and id, in its order; rows of one id follow by components. k rows at most."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(digest, "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def spread(points: np.ndarray, n: int) -> np.ndarray:
    """Up to n of the points: the first one, then each time the one farthest from those taken."""
    taken = [0]
    near = ((points - points[0]) ** 2).sum(1)
    while len(taken) < min(n, len(points)) and near.max() > 0:
        taken.append(int(near.argmax()))
        near = np.minimum(near, ((points - points[taken[-1]]) ** 2).sum(1))
    return points[taken]


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of v to the point, or row by row to the points, c."""
    d = v - c
    if v.dtype == np.float64:
        return np.einsum("ij,ij->i", d, d).astype(np.int64)
    return (d * d).sum(1)


def nearest(v: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, squared distance, exact distances told) for each vector; of equally near ones the smaller number.

    By the triangle inequality a centroid is at least as far as the largest difference of its and the vector's distances to a pivot. The
    centroid with the smallest bound is told exactly, and then those whose bound does not pass that distance.
    """
    small = max(np.abs(v).max(initial=0), np.abs(centroids).max(initial=0)) <= EXACT_DOUBLE
    v, centroids = (x.astype(np.float64 if small else np.int64) for x in (v, centroids))
    own = np.sqrt(((centroids[:, None, :] - pivots[None].astype(centroids.dtype)) ** 2).sum(2).astype(np.float64))
    bound = np.zeros((len(v), len(centroids)))
    for p in range(len(pivots)):
        np.maximum(bound, np.abs(to_pivots[:, p, None] - own[None, :, p]), out=bound)
    guess = bound.argmin(1)
    best = squared(v, centroids[guess])
    who = guess.copy()
    # rounding never hides a centroid: the bound gives way by far more than square roots err
    reach = np.sqrt(best.astype(np.float64)) * (1 + SLACK) + SLACK * (1 + to_pivots.max(1))
    open_ = bound <= reach[:, None]
    open_[np.arange(len(v)), guess] = False
    told = len(v)
    for c in range(len(centroids)):
        rows = np.flatnonzero(open_[:, c])
        if len(rows):
            told += len(rows)
            d = squared(v[rows], centroids[c])
            better = (d < best[rows]) | (d == best[rows]) & (c < who[rows])
            best[rows[better]], who[rows[better]] = d[better], c
    return who, best, told


def _matrix(batch: pa.RecordBatch, name: str, kind) -> np.ndarray:
    lists = batch.column(batch.schema.get_field_index(name))
    return lists.flatten().to_numpy().reshape(len(lists), -1).astype(kind)


def pivot_table(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(vec_id, v, to_pivots): the distances of every vector to the pivots, written once for all rounds."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch, "v", np.int64)
            far = np.sqrt(np.stack([squared(v, p) for p in pivots], 1).astype(np.float64))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(far.ravel()), len(pivots)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["vec_id", "v", "to_pivots"])

    return stored(vectors.mapInArrow(run, "vec_id long, v array<int>, to_pivots array<double>"), "pivots")


def _assigned(batch: pa.RecordBatch, centroids: np.ndarray, pivots: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, int]]:
    for a in range(0, batch.num_rows, BATCH_ROWS):
        part = batch.slice(a, BATCH_ROWS)
        v = _matrix(part, "v", np.int64)
        yield a, v, *nearest(v, _matrix(part, "to_pivots", np.float64), centroids, pivots)


def moved(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, float]:
    """(the centroids after a round, the share of all pairs that were told exactly). A task sums its own vectors; a row for each centroid
    comes to the driver."""
    k, dim = centroids.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts, told = np.zeros((k, dim), np.int64), np.zeros(k, np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for _, v, who, _, n in _assigned(batch, centroids, pivots):
                order = np.argsort(who, kind="stable")
                own, first = np.unique(who[order], return_index=True)
                sums[own] += np.add.reduceat(v[order], first)
                counts += np.bincount(who, minlength=k)
                told[0] += n
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), pa.array(counts), pa.array(told), *map(pa.array, sums.T.copy())], names=["cluster", "n", "told", *columns])

    columns = [f"s{i}" for i in range(dim)]
    part = table.mapInArrow(run, "cluster int, n long, told long, " + ", ".join(f"{c} long" for c in columns))
    out, rows, told = centroids.copy(), 0, 0
    for r in part.groupBy("cluster").agg(*[F.sum(c).alias(c) for c in ("n", "told", *columns)]).collect():
        rows, told = rows + r["n"], told + r["told"]
        if r["n"]:
            out[r["cluster"]] = [r[c] // r["n"] for c in columns]
    return out, told / max(1, rows * k)


def clustered(df: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2, dim: int = 64, scale: float = 256.0, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector after the given rounds.

    Vectors that are null, hold a null or non-finite component or have another number of components are left out, as are rows without an
    id. Rows of one id are vectors of their own. With fewer than k vectors there are as many centroids as vectors; equal centroids stay
    apart, the smaller number takes their vectors and the others stay as they are. Without vectors there are no rows. A component whose
    scaled size reaches LARGEST raises, since distances would not fit a long. Other columns are not read.
    """
    spark = df.sparkSession
    vectors = kept_vectors(df, id_col, vec_col, dim, scale)
    centroids = first_centroids(vectors, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    pivots = spread(centroids, PIVOTS)
    table = pivot_table(vectors, pivots)
    for _ in range(rounds):
        centroids, _told = moved(table, centroids, pivots)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, _, who, best, _ in _assigned(batch, centroids, pivots):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, len(who)), pa.array(who.astype(np.int32)), pa.array(best)], names=["vec_id", "cluster", "distance"])

    final = stored(table.mapInArrow(run, "vec_id long, cluster int, distance long"), "clusters")
    sums = {r["cluster"]: r["s"] for r in final.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    told = spark.createDataFrame([(c, sums[c], sum(sums.values()), digests[c]) for c in sums], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # a row for each centroid
    return final.join(F.broadcast(told), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
