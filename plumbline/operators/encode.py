"""Encodings learned from a labelled table: weight of evidence and smoothed target means."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import bucket_index
from plumbline.operators.quantiles import exact_quantiles
from plumbline.operators.ranking import null_safe_join


@dataclass(frozen=True)
class WoeState:
    edges: dict[str, list[float]]
    woe: dict[str, list[float]]


def _totals(df: DataFrame, y: str) -> tuple[Column, Column]:
    """Rows and positives of the table as one scalar subquery."""
    both = df.agg(F.struct(F.count("*").cast("double").alias("n"), F.sum(F.col(y).cast("double")).alias("s")).alias("t")).scalar()
    return both["n"], both["s"]


def woe_edges(df: DataFrame, cols: Sequence[str], bins: int = 5) -> dict[str, list[float]]:
    """Interior quantile edges of each column, repeats merged."""
    q = exact_quantiles(df, list(cols), [j / bins for j in range(1, bins)])
    return {c: sorted(set(v for v in q[c] if v is not None)) for c in cols}


def woe_bins(df: DataFrame, edges: dict[str, list[float]], y: str, smoothing: float = 0.5) -> DataFrame:
    """(column, bin, n, pos, woe) for left-closed bins, from one scan of stacked bin numbers.

    Every bin is listed, an empty one too: smoothing gives it a finite value.
    """
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), bucket_index(F.col(c).cast("double"), e, side="right").alias("bin"))
        for c, e in edges.items()
    ])
    counts = (
        df.select(F.col(y).cast("int").alias("_y"), F.explode(cells).alias("_c"))
        .where("_c.bin is not null")
        .groupBy("_c.column", "_c.bin").agg(F.count("*").alias("n"), F.sum("_y").cast("long").alias("pos"))
    )
    every = df.sparkSession.createDataFrame(
        [(c, b) for c, e in edges.items() for b in range(len(e) + 1)], "column string, bin int"
    ).select("column", "bin", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("pos"))
    full = counts.unionByName(every).groupBy("column", "bin").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    rows, pos = _totals(df, y)
    p, q = F.col("pos") + smoothing, F.col("n") - F.col("pos") + smoothing
    return full.select("column", "bin", "n", "pos", F.log((p / pos) / (q / (rows - pos))).alias("woe"))


def fit_woe(df: DataFrame, cols: Sequence[str], y: str, bins: int = 5, smoothing: float = 0.5) -> WoeState:
    """Interior quantile edges (repeats merged) and the weight of evidence of each bin."""
    edges = woe_edges(df, cols, bins)
    rows = woe_bins(df, edges, y, smoothing).collect()  # len(cols) * bins rows
    woe = {c: [0.0] * (len(edges[c]) + 1) for c in cols}
    for r in rows:
        woe[r["column"]][r["bin"]] = r["woe"]
    return WoeState(edges, woe)


def apply_woe(df: DataFrame, state: WoeState, keep_original: bool = True) -> DataFrame:
    def value(c: str) -> Column:
        i = bucket_index(F.col(c).cast("double"), state.edges[c], side="right")
        out = None
        for k, w in enumerate(state.woe[c]):
            out = F.when(i == k, F.lit(w)) if out is None else out.when(i == k, F.lit(w))
        return out

    out = df.withColumns({f"{c}_woe": value(c) for c in state.edges})
    return out if keep_original else out.drop(*state.edges)


def _level(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("NA"))


def _shrunk(n: Column, s: Column, gn: Column, gs: Column, smooth: float | None) -> Column:
    """Mean pulled to the global mean: fixed weight, or the empirical-Bayes weight of a 0/1 outcome.

    Empirical Bayes weighs a level by n * var_y / (n * var_y + var_level), var_level being its own
    sample spread.
    """
    mean_y = gs / gn
    if smooth is not None:
        return (s + smooth * mean_y) / (n + smooth)
    var_y = mean_y * (1 - mean_y)
    mean = s / n
    within = mean * (1 - mean)
    lam = F.try_divide(n * var_y, n * var_y + within)
    return F.coalesce(lam, F.lit(1.0)) * mean + (1 - F.coalesce(lam, F.lit(1.0))) * mean_y


def fit_target_encoding(df: DataFrame, cols: Sequence[str], y: str, smooth: float | None = None) -> DataFrame:
    """(column, level, n, encoding) over all given rows, for rows whose label is not in them."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), _level(c).alias("level")) for c in cols])
    g = (
        df.select(F.col(y).cast("double").alias("_y"), F.explode(cells).alias("_c"))
        .groupBy("_c.column", "_c.level").agg(F.count("*").alias("n"), F.sum("_y").alias("s"))
    )
    gn, gs = _totals(df, y)
    return g.select("column", "level", "n", _shrunk(F.col("n"), F.col("s"), gn, gs, smooth).alias("encoding"))


def apply_target_encoding(df: DataFrame, state: DataFrame, cols: Sequence[str], prior: float) -> DataFrame:
    """Adds <col>_te; a level the fit never saw gets the prior."""
    out = df
    for c in cols:
        mine = state.where(F.col("column") == c).select(F.col("level").alias("_l"), F.col("encoding").alias(f"{c}_te"))
        out = out.join(mine, _level(c) == F.col("_l"), "left").drop("_l").withColumn(f"{c}_te", F.coalesce(f"{c}_te", F.lit(prior)))
    return out


def target_encode(
    df: DataFrame, cols: Sequence[str], y: str, key: Sequence[str], k: int = 5, seed: int = 0, smooth: float | None = None
) -> DataFrame:
    """Cross-fitted encodings for the fit rows: a row's own fold never enters its encoding.

    Sums per (level, fold) are small; "all folds but mine" is total minus mine, so no refit per fold.
    """
    fold = F.pmod(F.xxhash64(*[F.col(c) for c in key], F.lit(seed)), F.lit(k)).cast("int")
    rows = df.withColumn("_fold", fold)
    per_fold = rows.groupBy("_fold").agg(F.count("*").cast("double").alias("_fn"), F.sum(F.col(y).cast("double")).alias("_fs"))
    gn, gs = _totals(df, y)
    out = rows
    for c in cols:
        cell = rows.groupBy(_level(c).alias("_l"), "_fold").agg(F.count("*").alias("_n"), F.sum(F.col(y).cast("double")).alias("_s"))
        level = cell.groupBy("_l").agg(F.sum("_n").alias("_tn"), F.sum("_s").alias("_ts"))
        j = null_safe_join(null_safe_join(cell, level, ["_l"]), per_fold, ["_fold"])
        n, s = F.col("_tn") - F.col("_n"), F.col("_ts") - F.col("_s")
        rn, rs = gn - F.col("_fn"), gs - F.col("_fs")
        enc = F.when(n > 0, _shrunk(n, s, rn, rs, smooth)).otherwise(rs / rn)
        mine = j.select(F.col("_l").alias(f"_l_{c}"), F.col("_fold").alias(f"_f_{c}"), enc.alias(f"{c}_te"))
        out = out.join(mine, (_level(c) == F.col(f"_l_{c}")) & (F.col("_fold") == F.col(f"_f_{c}"))).drop(f"_l_{c}", f"_f_{c}")
    return out.drop("_fold")
