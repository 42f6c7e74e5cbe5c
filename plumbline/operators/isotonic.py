"""Isotonic regression whose pools stay a table: ranges are pooled on their own, then over their seams, and looked up by order.

Pooling adjacent violators may start anywhere: pools made inside a range are pools of the whole, so a round pools every range of at most
RANGE_ROWS pools in a task of its own and the next one cuts in the middle of these ranges. A seam that two such rounds leave alone is no
violation. Pools that reach over many ranges have shrunk to a row in each by then, so they meet within a few rounds.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.session import ensure_checkpoint_dir

#: Pools that a task merges at once.
RANGE_ROWS = 100_000
POOLS = "lo double, hi double, total double, weight double"


def pooled(total: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The first row of every pool after adjacent violators are merged: means ascend strictly from pool to pool."""
    starts: list[int] = []
    sums: list[tuple[float, float]] = []
    for i, (t, w) in enumerate(zip(total.tolist(), weight.tolist())):
        at = i
        while sums and sums[-1][0] * w >= t * sums[-1][1]:
            a, b = sums.pop()
            at = starts.pop()
            t, w = t + a, w + b
        starts.append(at)
        sums.append((t, w))
    return np.array(starts, np.int64)


def _written(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/plumbline-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _placed(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """A written table with the dense place (from 0) of each row in the order of its group: places inside a range, plus the rows of the group
    in the ranges before, which is one row for each range and group."""
    keys = [*by, *order]
    ranged = _written(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()), name)
    ranged = ranged.withColumn("_part", F.shiftright("_at", 33))
    per = ranged.groupBy(*by, "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(*by, "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return ranged.join(F.broadcast(per), [*by, "_part"]).withColumn("_place", F.col("_before") + F.col("_at") - F.col("_first")).drop("_at", "_part", "_first", "_before")


def fit(df: DataFrame, score: str, y: str, by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """(by..., lo, hi, mean, next_lo, next_mean): the pools of the weighted isotonic fit of y on the score, in each group. Equal scores are one
    point first. Null and NaN scores and null outcomes teach nothing; without rows there are no pools."""
    by = list(by)
    s, w = F.col(score).cast("double"), F.lit(1.0) if weight is None else F.col(weight).cast("double")
    known = df.where(s.isNotNull() & ~F.isnan(s) & F.col(y).isNotNull())
    points = known.groupBy(*by, (s + 0.0).alias("lo")).agg(F.sum(F.col(y).cast("double") * w).alias("total"), F.sum(w).alias("weight"))
    pools = points.select(*by, "lo", F.col("lo").alias("hi"), "total", "weight")
    schema = pools.schema

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lo")
        first = pooled(pdf.total.to_numpy(), pdf.weight.to_numpy())
        last = np.r_[first[1:], len(pdf)] - 1
        out = pdf.iloc[first].copy()
        out["hi"] = pdf.hi.to_numpy()[last]
        out["total"], out["weight"] = np.add.reduceat(pdf.total.to_numpy(), first), np.add.reduceat(pdf.weight.to_numpy(), first)
        return out[schema.names]

    quiet, rounds, rows = 0, 0, None
    while quiet < 2:
        placed = _placed(pools, by, ["lo"], "pools")
        if rows is None:
            rows = placed.count()
        # cuts move by half a range from round to round
        cut = F.floor((F.col("_place") + (RANGE_ROWS // 2) * (rounds % 2)) / RANGE_ROWS)
        pools = _written(placed.withColumn("_range", cut).groupBy(*by, "_range").applyInPandas(merge, schema), "pooled")
        left = pools.count()
        whole = rows <= RANGE_ROWS // 2  # every group fits in a range, wherever it is cut from
        quiet = 2 if whole and rounds % 2 == 0 else quiet + 1 if left == rows else 0
        rows, rounds = left, rounds + 1
    mean = F.col("total") / F.col("weight")
    placed = _placed(pools.select(*by, "lo", "hi", mean.alias("mean")), by, ["lo"], "pools")
    after = placed.select(*by, (F.col("_place") - 1).alias("_place"), F.col("lo").alias("next_lo"), F.col("mean").alias("next_mean"))
    return _written(placed.join(after, [*by, "_place"], "left").select(*by, "lo", "hi", "mean", "next_lo", "next_mean"), "isotonic")


def read_at(scores: DataFrame, score: str, pools: DataFrame, by: Sequence[str] = (), name: str = "calibrated") -> DataFrame:
    """(by..., score, name) for each distinct score of each group: the mean of the pool it lies in, a straight line between pools, the first or
    last mean outside. Scores and pools are ordered together in ranges; the last pool before a range is carried into it."""
    by = list(by)
    s = F.col(score).cast("double")
    asked = scores.where(s.isNotNull() & ~F.isnan(s)).select(*by, (s + 0.0).alias("at")).distinct().withColumn("pool", F.lit(None).cast("struct<lo:double,hi:double,mean:double,next_lo:double,next_mean:double>"))
    held = pools.select(*by, F.col("lo").alias("at"), F.struct("lo", "hi", "mean", "next_lo", "next_mean").alias("pool"))
    # a pool stands before a score equal to its start
    order = ["at", "first"]
    both = asked.withColumn("first", F.lit(1)).unionByName(held.withColumn("first", F.lit(0)))
    ranged = _written(both.repartitionByRange(*by, *order).withColumn("_part", F.spark_partition_id()), "scores")
    ends = ranged.where("pool IS NOT NULL").groupBy(*by, "_part").agg(F.max_by("pool", "at").alias("last"), F.min_by("pool", "at").alias("low"))
    parts = ranged.select(*by, "_part").distinct().join(ends, [*by, "_part"], "left")
    w = Window.partitionBy(*by).orderBy("_part")  # a row for each range and group
    carried = parts.select(*by, "_part", F.last("last", True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("carried"),
                           F.first("low", True).over(w.rowsBetween(0, Window.unboundedFollowing)).alias("ahead"))
    inside = Window.partitionBy(*by, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    j = ranged.withColumn("own", F.last("pool", True).over(inside)).where("first = 1").join(F.broadcast(carried), [*by, "_part"])
    p = F.coalesce("own", "carried")
    x = F.col("at")
    share = (x - p["hi"]) / (p["next_lo"] - p["hi"])
    value = (F.when(p.isNull(), F.col("ahead")["mean"]).when((x <= p["hi"]) | p["next_lo"].isNull(), p["mean"])
             .otherwise(p["mean"] + (p["next_mean"] - p["mean"]) * share))
    return j.select(*by, x.alias(score), value.alias(name))
