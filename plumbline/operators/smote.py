"""Synthetic positives by interpolation between nearest neighbours, with an exact distributed k-NN.

Positives first collapse to distinct points with a multiplicity, so a group of copies is one point. The
space is cut into boxes of about BOX_POINTS points by a k-d tree over a hashed sample; the tree only
balances the work. Each box finds the k nearest points it holds, which bounds the k-th distance of every
point; a point then visits only the other boxes its ball reaches, and the candidates are merged. No pair
leaves a task: what is shuffled is points, their visits, and k candidates per visit.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import unit_hash

BOX_POINTS = 2_000
MAX_SAMPLE = 200_000  # rows of the balancing sample the driver reads
CHUNK = 256  # points of a box compared at once


def _split(points: np.ndarray, lo: np.ndarray, hi: np.ndarray, leaf: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Boxes (lo, hi] that cover the space, cut at medians of the widest side until a box is small."""
    if len(points) > leaf:
        for axis in np.argsort(-(points.max(0) - points.min(0))):
            cut = float(np.median(points[:, axis]))
            left = points[:, axis] <= cut
            if 0 < left.sum() < len(points):
                hi_left, lo_right = hi.copy(), lo.copy()
                hi_left[axis], lo_right[axis] = cut, cut
                return _split(points[left], lo, hi_left, leaf) + _split(points[~left], lo_right, hi, leaf)
    return [(lo, hi)]


def _boxes(points: DataFrame, cols: Sequence[str], box_points: int) -> tuple[np.ndarray, np.ndarray]:
    n = points.count()
    wanted = max(1, -(-n // box_points))
    share = min(1.0, min(MAX_SAMPLE, 64 * wanted) / max(n, 1))
    u = unit_hash(*[F.col(c) for c in cols], seed=17)
    sample = points.where(u < share).select(*cols).limit(MAX_SAMPLE).toPandas().to_numpy(dtype=float)
    d = len(cols)
    leaf = max(1, len(sample) // wanted)
    cells = _split(sample, np.full(d, -np.inf), np.full(d, np.inf), leaf)
    return np.array([c[0] for c in cells]), np.array([c[1] for c in cells])


def _nearest(x: np.ndarray, pool: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distances and positions of the k nearest pool points per row of x, a point itself left out."""
    d2 = np.zeros((len(x), len(pool)))
    for j in range(x.shape[1]):
        d2 += (x[:, j][:, None] - pool[:, j][None, :]) ** 2
    d2[(x[:, None, :] == pool[None, :, :]).all(2)] = np.inf
    take = min(k, len(pool))
    at = np.argpartition(d2, take - 1, axis=1)[:, :take]
    dist = np.take_along_axis(d2, at, 1)
    order = np.argsort(dist, axis=1, kind="stable")
    return np.sqrt(np.take_along_axis(dist, order, 1)), np.take_along_axis(at, order, 1)


def nearest_points(points: DataFrame, cols: Sequence[str], weight: str, k: int, box_points: int = BOX_POINTS) -> DataFrame:
    """(cols, weight, near): for each distinct point its k nearest others as (distance, weight, point), nearest first."""
    cols = list(cols)
    lows, highs = _boxes(points, cols, box_points)
    vector = ", ".join(f"`{c}` double" for c in cols)
    found = "near array<struct<distance: double, weight: long, point: array<double>>>"

    def place(batches):
        for pdf in batches:
            x = pdf[cols].to_numpy(dtype=float)
            box = np.empty(len(x), dtype=np.int64)
            for at in range(0, len(x), CHUNK):
                part = x[at : at + CHUNK, None, :]
                box[at : at + CHUNK] = ((part > lows[None]) & (part <= highs[None])).all(2).argmax(1)
            yield pdf.assign(box=box)

    placed = points.select(*[F.col(c).cast("double").alias(c) for c in cols], F.col(weight).cast("long").alias("weight")).mapInPandas(
        place, f"{vector}, weight long, box long"
    )

    def listed(dist: np.ndarray, at: np.ndarray, pool: np.ndarray, w: np.ndarray) -> list:
        return [{"distance": float(a), "weight": int(w[i]), "point": pool[i].tolist()} for a, i in zip(dist, at) if np.isfinite(a)]

    def inside(pdf: pd.DataFrame) -> pd.DataFrame:
        """k nearest within the box, and the other boxes the ball of the k-th distance reaches."""
        x, w, own = pdf[cols].to_numpy(dtype=float), pdf["weight"].to_numpy(), int(pdf["box"].iloc[0])
        near, visits = [], []
        for at in range(0, len(x), CHUNK):
            part = x[at : at + CHUNK]
            dist, pos = _nearest(part, x, k)
            reach = dist[:, -1] if dist.shape[1] == k else np.full(len(part), np.inf)
            for i in range(len(part)):
                near.append(listed(dist[i], pos[i], x, w))
                gap = np.maximum(np.maximum(lows - part[i], part[i] - highs), 0.0)
                hit = np.flatnonzero((gap**2).sum(1) <= reach[i] ** 2)
                visits.append([int(b) for b in hit if b != own])
        return pdf[[*cols, "weight"]].assign(near=near, visits=visits)

    local = placed.groupBy("box").applyInPandas(inside, f"{vector}, weight long, {found}, visits array<long>")

    def visit(guests: pd.DataFrame, hosts: pd.DataFrame) -> pd.DataFrame:
        if not len(guests) or not len(hosts):
            return pd.DataFrame({**{c: pd.Series(dtype=float) for c in cols}, "weight": pd.Series(dtype="int64"), "near": pd.Series(dtype=object)})
        x, pool, w = guests[cols].to_numpy(dtype=float), hosts[cols].to_numpy(dtype=float), hosts["weight"].to_numpy()
        near = []
        for at in range(0, len(x), CHUNK):
            dist, pos = _nearest(x[at : at + CHUNK], pool, k)
            near += [listed(dist[i], pos[i], pool, w) for i in range(len(dist))]
        return guests[[*cols, "weight"]].assign(near=near)

    guests = local.select(*cols, "weight", F.explode("visits").alias("box"))
    away = guests.groupBy("box").cogroup(placed.groupBy("box")).applyInPandas(visit, f"{vector}, weight long, {found}")
    # Candidates merge pairwise in the aggregation, which never holds more than a point's own visits.
    every = local.select(*cols, "weight", "near").unionByName(away)
    return every.groupBy(*cols, "weight").agg(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k).alias("near"))


def smote(
    df: DataFrame, y: str, cols: Sequence[str], key: Sequence[str], k: int = 5, ratio: float = 1.0, seed: int = 0,
    box_points: int = BOX_POINTS,
) -> DataFrame:
    """All rows plus synthetic positives up to `ratio` positives per negative (in expectation).

    A synthetic row lies between a positive and one of its k nearest positives, copies of the point itself
    counting as neighbours. The output holds cols, y and `synthetic`.
    """
    cols = list(cols)
    counts = df.agg(F.count_if(F.col(y) == 1).alias("p"), F.count_if(F.col(y) == 0).alias("q")).first()
    pos, neg = counts["p"], counts["q"]
    kept = df.select(*[F.col(c).cast("double").alias(c) for c in cols], F.col(y).cast("int").alias(y), F.lit(False).alias("synthetic"))
    new = int(neg * ratio) - pos
    if pos < 2 or new <= 0:
        return kept
    k = min(k, pos - 1)
    positives = df.where(F.col(y) == 1).select(F.xxhash64(*[F.col(c) for c in key]).alias("_key"), *[(F.col(c).cast("double") + F.lit(0.0)).alias(c) for c in cols]).dropna()
    points = positives.groupBy(*cols).agg(F.count("*").alias("weight"))
    near = nearest_points(points, cols, "weight", k, box_points)
    mean = new / pos
    whole = int(mean)
    copies = F.lit(whole) + (unit_hash(F.col("_key"), seed=seed) < F.lit(mean - whole)).cast("int")
    drawn = positives.withColumn("_c", F.explode(F.when(copies > 0, F.sequence(F.lit(1), copies)))).join(near, cols)
    # The r-th neighbour in order of distance: the point's own copies come first.
    r = F.floor(unit_hash(F.col("_key"), F.col("_c"), seed=seed + 1) * k).cast("long") - (F.col("weight") - 1)
    walk = F.aggregate(
        "near", F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("array<double>").alias("point")),
        lambda a, n: F.struct((a["seen"] + n["weight"]).alias("seen"), F.coalesce(a["point"], F.when(a["seen"] + n["weight"] > F.col("_r"), n["point"])).alias("point")),
    )
    step = unit_hash(F.col("_key"), F.col("_c"), seed=seed + 2)
    chosen = drawn.withColumn("_r", r).withColumn("_n", F.when(F.col("_r") >= 0, walk["point"])).withColumn("_u", step)
    made = chosen.select(
        *[(F.col(c) + F.col("_u") * (F.coalesce(F.get("_n", F.lit(i)), F.col(c)) - F.col(c))).alias(c) for i, c in enumerate(cols)],
        F.lit(1).alias(y), F.lit(True).alias("synthetic"),
    )
    return kept.unionByName(made)
