"""Exact top-k inner products by block-at-a-time pruning."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import stored

#: Vectors of a document-range block, and components of the range that one task holds.
BLOCK, RANGE_VALUES = 1024, 4_000_000
#: Queries that meet a range at once.
QUERIES_AT_ONCE = 4096
#: Sums of products below this are exact in a double.
EXACT = float(1 << 53)


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: float = 256.0) -> DataFrame:
    """(vec_id, dim, v): components as floor(scale * x). Rows with a null id, a null vector or a null or non-finite component
    are left out. Repeated ids stay as rows of their own."""
    x = F.col(vec_col).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return (df.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & ~bad)
            .select(F.col(id_col).cast("long").alias("vec_id"), F.size(vec_col).alias("dim"), F.transform(x, lambda c: F.floor(c * scale)).alias("v")))


def _merge(score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best columns of each row: higher score, then smaller id. Unused places hold -inf."""
    order = np.lexsort((ids, -score), axis=1)[:, :k]
    return np.take_along_axis(score, order, 1), np.take_along_axis(ids, order, 1)


def search_range(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, v: np.ndarray, k: int, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """The k best of the rows v for each query: blocks of the id range are visited in order of the query's bound, the sum over its
    terms of the block's largest product, until no open bound reaches the k-th score."""
    order = np.argsort(ids, kind="stable")
    ids, v = ids[order], v[order]
    cuts = range(0, len(ids), block)
    top = np.stack([v[i:i + block].max(0) for i in cuts])
    low = np.stack([v[i:i + block].min(0) for i in cuts])
    bound = np.maximum(q, 0) @ top.T + np.minimum(q, 0) @ low.T
    visit = np.argsort(-bound, axis=1, kind="stable")
    none = np.iinfo(np.int64).max
    best, who = np.full((len(q), k), -np.inf), np.full((len(q), k), none, np.int64)
    for step in range(len(top)):
        at = visit[:, step]
        # an equal bound may still hold an equal score with a smaller id
        alive = bound[np.arange(len(q)), at] >= best[:, -1]
        if not alive.any():
            break
        for b in np.unique(at[alive]):
            rows = np.flatnonzero(alive & (at == b))
            i = b * block
            score = q[rows] @ v[i:i + block].T
            own = ids[i:i + block]
            score[q_ids[rows][:, None] == own[None, :]] = -np.inf
            if score.shape[1] > 4 * k:  # all that can enter: the k-th score and its ties
                kth = -np.partition(-score, k - 1, axis=1)[:, k - 1]
                reach = np.maximum(kth, best[rows, -1])
                cols = np.flatnonzero((score >= reach[:, None]).any(0))
                score, own = score[:, cols], own[cols]
            if score.shape[1]:
                s = np.concatenate([best[rows], score], 1)
                o = np.concatenate([who[rows], np.broadcast_to(own, score.shape)], 1)
                best[rows], who[rows] = _merge(s, o, k)
    return best, who


def top_k(df: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5, scale: float = 256.0) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that is_query selects, the k highest integer inner products with all other
    rows, ties to the smaller id.

    Vectors are compared with vectors of the same length only. A query's own id never answers it; repeated rows of a query or a
    candidate id count as often as they stand. Null ids and vectors that are null or hold a null or non-finite component take no
    part; an empty table gives no rows. Candidates are dealt in id ranges, queries in chunks; a range and a chunk meet in one
    task, which gives k rows per query, and those partial lists are merged by an aggregation.
    """
    spark = df.sparkSession
    vectors = integer_vectors(df, id_col, vec_col, scale)
    n_queries = vectors.where(is_query(F.col("vec_id"))).count()
    chunks = max(1, -(-n_queries // QUERIES_AT_ONCE))
    n, values = vectors.agg(F.count("*"), F.sum("dim")).first()
    if not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # equal-count ranges of ids; a repeated id is dealt over the ranges by its place
    cores = spark.sparkContext.defaultParallelism
    ranges = max(1, min(-(-n // BLOCK), max(2 * cores, -(-values // RANGE_VALUES))))
    most = 2 * -(-n // ranges)
    cut = vectors.approxQuantile("vec_id", [i / ranges for i in range(1, ranges)], 0.1 / ranges) if ranges > 1 else []
    cuts = F.array(*[F.lit(float(c)) for c in sorted(set(cut))]) if cut else F.array().cast("array<double>")
    ranged = vectors.withColumn("r", F.size(F.filter(cuts, lambda c: c < F.col("vec_id"))))
    # a range that copies of one id overfill is cut by a hash
    deal = F.pmod(F.xxhash64("vec_id", "v", F.monotonically_increasing_id()), F.lit(1 << 20))
    sizes = {(r["r"], r["dim"]): -(-r["count"] // most) for r in ranged.groupBy("r", "dim").count().where(F.col("count") > most).collect()}
    salt = F.lit(0)
    for (r, d), parts in sizes.items():
        salt = F.when((F.col("r") == r) & (F.col("dim") == d), F.pmod(deal, F.lit(parts))).otherwise(salt)
    candidates = ranged.withColumn("s", salt.cast("int")).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    queries = (vectors.where(is_query(F.col("vec_id")))
               .withColumn("qrow", F.monotonically_increasing_id())
               .withColumn("c", F.pmod(F.xxhash64("vec_id", "qrow"), F.lit(chunks)).cast("int")))
    keys = ["dim", "c", "r", "s"]
    homes = stored(candidates.select(*keys).distinct(), "homes")  # the ranges that hold rows: a chunk of queries goes to those alone
    asked = queries.join(homes, ["dim", "c"]).select(*keys, "qrow", "vec_id", "v")
    held = candidates.select(*keys, F.lit(None).cast("long").alias("qrow"), "vec_id", "v")

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        is_q = pdf.qrow.notna().to_numpy()
        left, right = pdf[is_q], pdf[~is_q]
        if not len(left) or not len(right):
            return pd.DataFrame({"qrow": [], "query_id": [], "vec_id": [], "score": []}).astype("int64")
        if not left.dim.iat[0]:
            q, v = np.zeros((len(left), 1)), np.zeros((len(right), 1))
        else:
            q, v = np.array(left.v.tolist(), dtype=np.float64), np.array(right.v.tolist(), dtype=np.float64)
        if np.abs(q).sum(1).max() * np.abs(v).max(initial=0) >= EXACT:
            raise ValueError("inner products of these vectors leave the exact range of a double")
        best, who = search_range(left.vec_id.to_numpy(), q, right.vec_id.to_numpy(), v, k)
        rows, cols = np.nonzero(np.isfinite(best))
        return pd.DataFrame({"qrow": left.qrow.to_numpy()[rows].astype("int64"), "query_id": left.vec_id.to_numpy()[rows], "vec_id": who[rows, cols], "score": best[rows, cols].astype("int64")})

    part = asked.union(held).groupBy(*keys).applyInPandas(answer, "qrow long, query_id long, vec_id long, score long")
    lists = part.groupBy("qrow", "query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("m"), "vec_id"))), 1, k).alias("t"))
    flat = lists.select("query_id", F.posexplode("t").alias("p", "x"))
    return flat.select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.m")).alias("score"))

