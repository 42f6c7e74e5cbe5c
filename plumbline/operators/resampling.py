"""Bootstrap intervals for ranking metrics on tables of any size.

Every row carries its own Poisson(1) count per replicate, computed from a hash of its key: the same row
gets the same counts for every score, every bucket and every retry, which is what pairs two models.
Rows are cut into value buckets of the score and never multiplied by the number of replicates: inside a
bucket the replicates are a numpy axis. Pass one returns the positives and negatives per (bucket,
replicate); running totals over the buckets give each bucket its starting point; pass two finishes the
metrics. A score repeated more often than HOT_ROWS leaves the buckets: its rows are summed where they are
read and re-enter as one total per replicate. The other rows are shuffled once for both passes. Every score
that more rows than one and a half buckets share is an edge of the buckets, so the edges are the scores to count.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.columns import as_column
from plumbline.operators import ranking
from plumbline.operators.association import slope_from_counts
from plumbline.operators.quantiles import Buckets
from plumbline.operators.ranking import null_safe_join
from plumbline.session import written

METRICS = ("roc_auc", "gini", "pr_auc", "f1", "precision", "recall")
CHUNK = 32  # replicates held in memory at once inside a task
BLOCK = 4096  # rows whose counts are held at once: few enough for the processor's cache
HOT_ROWS = 200_000
MAX_CELLS = 4096  # group totals a task holds before it passes them on

# Cumulative Poisson(1) probabilities; the last one leaves less than 1e-16.
_POISSON = np.cumsum([np.exp(-1.0) / float(np.prod(np.arange(1, k + 1, dtype=float))) for k in range(18)])


# Counts by the first 16 bits of a hash; 255 where a cumulative probability falls between two hashes that share them.
_FIRST, _LAST = (np.searchsorted(_POISSON, ((np.arange(1 << 16) << 37) + at).astype(np.float64) / float(1 << 53), side="right") for at in (0, (1 << 37) - 1))
_COUNTS = np.where(_FIRST == _LAST, _FIRST, 255).astype(np.uint8)


def _drawn(keys: np.ndarray, replicates: np.ndarray, seed: int) -> np.ndarray:
    salt = np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    with np.errstate(over="ignore"):
        x = keys.astype(np.int64).view(np.uint64)[:, None] ^ (replicates.astype(np.uint64) * np.uint64(0xD1342543DE82EF95) + salt)[None, :]
        t = np.empty_like(x)
        for shift, mult in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            np.right_shift(x, np.uint64(shift), out=t)
            np.bitwise_xor(x, t, out=x)
            np.multiply(x, np.uint64(mult), out=x)
        np.right_shift(x, np.uint64(31), out=t)
        np.bitwise_xor(x, t, out=x)
    counts = np.take(_COUNTS, np.right_shift(x, np.uint64(48), out=t).view(np.int64))
    close = np.flatnonzero(counts == 255)
    if len(close):
        u = (x.ravel()[close] >> np.uint64(11)).astype(np.float64) / float(1 << 53)
        counts.ravel()[close] = np.searchsorted(_POISSON, u, side="right")
    counts[:, replicates == 0] = 1
    return counts


def poisson_counts(keys: np.ndarray, replicates: np.ndarray, seed: int) -> np.ndarray:
    """Poisson(1) counts, one row per key hash and one column per replicate; replicate 0 counts each row once."""
    return _drawn(keys, replicates, seed).astype(np.int64)


def _labels(pdf: pd.DataFrame) -> np.ndarray:
    if pdf["y"].isna().any():
        raise ValueError("a bootstrap needs a label in every row")
    return pdf["y"].to_numpy().astype(np.int64)


def _sums(keys: np.ndarray, label: np.ndarray, starts: np.ndarray, replicates: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and positives in every replicate, summed over the stretches of rows that begin at `starts`."""
    n, cases = (np.zeros((len(starts), len(replicates)), dtype=np.int64) for _ in range(2))
    for lo in range(0, len(keys), BLOCK):
        hi = min(lo + BLOCK, len(keys))
        first, last = np.searchsorted(starts, lo, side="right") - 1, np.searchsorted(starts, hi, side="left")
        cuts = np.maximum(starts[first:last] - lo, 0)
        for at in range(0, len(replicates), CHUNK):
            w = poisson_counts(keys[lo:hi], replicates[at : at + CHUNK], seed)
            n[first:last, at : at + CHUNK] += np.add.reduceat(w, cuts, axis=0)
            cases[first:last, at : at + CHUNK] += np.add.reduceat(w * label[lo:hi, None], cuts, axis=0)
    return n, cases


def _stretches(rows: int, starts: np.ndarray, places: np.ndarray):
    """Stretches (first, last, hot) of distinct scores, about BLOCK rows each, with every hot score at its place as one of its own."""
    ends = np.r_[starts, rows]
    at = 0
    for hot, place in enumerate([*places, len(starts)]):
        while at < place:
            to = max(at + 1, min(place, int(np.searchsorted(ends, ends[at] + BLOCK, side="right")) - 1))
            yield at, to, None
            at = to
        if hot < len(places):
            yield place, place, hot


def bootstrap_replicates(
    df: DataFrame, score: str, y: str, key: Sequence[str], replicates: int = 1000, seed: int = 0,
    by: Sequence[str] = (), share: float | None = None, buckets: Buckets | None = None, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """(by, rep, n, positives, metrics) for replicate 0 (the data as they are) to `replicates`.

    `share` adds F1, precision and recall with the threshold refitted to the replicate's own quantile.
    """
    by = list(by)
    rows = df.select(
        *by, (as_column(score).cast("double") + F.lit(0.0)).alias("score"), as_column(y).cast("int").alias("y"),
        F.xxhash64(*[F.col(c) for c in key]).alias("key"),
    ).where(F.col("score") <= float("inf"))
    buckets = buckets or ranking.buckets_for(rows, "score")
    rows = rows.withColumn("b", buckets.index("score"))
    reps = np.arange(replicates + 1)
    key_ddl = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in by)

    def totals(k: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        n, cases = _sums(pdf["key"].to_numpy(), _labels(pdf), np.zeros(1, dtype=np.int64), reps, seed)
        out = pd.DataFrame({"rep": reps, "p": cases[0], "q": (n - cases)[0]})
        for name, v in zip([*by, "b"], k):
            out[name] = v
        return out[[*by, "b", "rep", "p", "q"]]

    common = sorted({float(e) for e in (*buckets.edges, buckets.lo, buckets.hi) if e is not None})
    seen = rows.where(F.col("score").isin(common)).groupBy("score").agg(F.count("*").alias("n")).where(F.col("n") > hot_rows)
    heavy = F.col("score").isin([r["score"] for r in seen.collect()])
    cold = rows.where(~heavy)
    hot = _cell_sums(rows.where(heavy), [*by, "b", "score"], replicates, seed, _labels).select(
        *by, "b", F.col("score").alias("hot"), "rep", F.col("cases").alias("p"), (F.col("n") - F.col("cases")).alias("q")
    )
    per_cold = cold.groupBy(*by, "b").applyInPandas(totals, f"{key_ddl}b int, rep int, p long, q long")
    per = per_cold.unionByName(hot.drop("hot")).groupBy(*by, "b", "rep").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
    below = Window.partitionBy(*by, "rep").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(*by, "rep")
    start = per.select(
        *by, "b", "rep",
        F.coalesce(F.sum("p").over(below), F.lit(0)).alias("p0"), F.coalesce(F.sum("q").over(below), F.lit(0)).alias("q0"),
        F.sum("p").over(every).alias("tp"), F.sum("q").over(every).alias("tq"),
    )
    aside = start.unionByName(hot, allowMissingColumns=True)
    columns = [*by, "b", "rep", "u", "ap", "f_pos", "f_all"]

    def finish(k: tuple, pdf: pd.DataFrame, info: pd.DataFrame) -> pd.DataFrame:
        hot_totals = info[info["hot"].notna()].sort_values(["hot", "rep"])
        offsets = info[info["hot"].isna()].sort_values("rep")
        values = hot_totals["hot"].unique()
        hot_p, hot_q = (hot_totals[c].to_numpy().astype(np.float64).reshape(len(values), len(offsets)) for c in ("p", "q"))
        score = pdf["score"].to_numpy(dtype=np.float64)
        order = np.argsort(score, kind="stable")
        score, keys, label = score[order], pdf["key"].to_numpy()[order], _labels(pdf)[order]
        starts = np.flatnonzero(np.r_[True, score[1:] != score[:-1]]) if len(score) else np.array([], dtype=int)
        ends = np.r_[starts, len(score)]
        stretches = [*_stretches(len(score), starts, np.searchsorted(score[starts], values))]
        frames = []
        for at in range(0, len(reps), CHUNK):
            part = reps[at : at + CHUNK]
            off = offsets.iloc[at : at + CHUNK]
            p0, q0, tp, tq = (off[c].to_numpy().astype(np.float64) for c in ("p0", "q0", "tp", "tq"))
            # positives and rows below, then up to each score
            below_p, below = p0, p0 + q0
            u, ap = np.zeros(len(part)), np.zeros(len(part))
            f_pos, f_all = np.full(len(part), np.nan), np.full(len(part), np.nan)
            # Everything at or above this order statistic is flagged.
            target = None if share is None else np.ceil((tp + tq - 1) * (1 - share) - 1e-12)
            for first, last, h in stretches:
                if h is None:
                    a, z = ends[first], ends[last]
                    n = _drawn(keys[a:z], part, seed).astype(np.float64)
                    pos, some = n * label[a:z, None], label[a:z] != 0
                    if last - first < z - a:
                        cuts = starts[first:last] - a
                        n, pos, some = np.add.reduceat(n, cuts, axis=0), np.add.reduceat(pos, cuts, axis=0), np.logical_or.reduceat(some, cuts)
                else:
                    pos, some = hot_p[h : h + 1, at : at + CHUNK], slice(None)
                    n = pos + hot_q[h : h + 1, at : at + CHUNK]
                cum_p, cum = below_p + pos.cumsum(0), below + n.cumsum(0)
                if target is not None:
                    for j in np.flatnonzero((below <= target) & (target < cum[-1])):
                        i = int(np.searchsorted(cum[:, j], target[j], side="right"))
                        f_pos[j] = tp[j] - cum_p[i, j] + pos[i, j]
                        f_all[j] = tp[j] + tq[j] - cum[i, j] + n[i, j]
                below_p, below = cum_p[-1], cum[-1]
                # scores without a positive add to neither sum
                n, pos, cum_p, cum = n[some], pos[some], cum_p[some], cum[some]
                u += (pos * (cum - cum_p - (n - pos) / 2)).sum(0)
                hits = tp - cum_p + pos  # positives at or above each score
                flagged = tp + tq - cum + n
                ap += (pos * hits / np.maximum(flagged, 1)).sum(0)
            frames.append(pd.DataFrame({"rep": part, "u": u, "ap": ap, "f_pos": f_pos, "f_all": f_all}))
        out = pd.concat(frames, ignore_index=True)
        for name, v in zip([*by, "b"], k):
            out[name] = v
        return out[columns]

    done = cold.groupBy(*by, "b").cogroup(aside.groupBy(*by, "b")).applyInPandas(
        finish, f"{key_ddl}b int, rep int, u double, ap double, f_pos double, f_all double"
    )

    def known(c: str):
        return F.max(F.when(~F.isnan(c), F.col(c))).alias(c)

    sums = done.groupBy(*by, "rep").agg(F.sum("u").alias("u"), F.sum("ap").alias("ap"), known("f_pos"), known("f_all"))
    sizes = per.groupBy(*by, "rep").agg(F.sum("p").alias("positives"), F.sum("q").alias("negatives"))
    j = null_safe_join(sums, sizes, [*by, "rep"]).where("positives > 0 and negatives > 0")
    p, q = F.col("positives").cast("double"), F.col("negatives").cast("double")
    auc = F.col("u") / (p * q)
    out = {"roc_auc": auc, "gini": 2 * auc - 1, "pr_auc": F.col("ap") / p}
    if share is not None:
        out |= {
            "f1": 2 * F.col("f_pos") / (F.col("f_all") + p),
            "precision": F.coalesce(F.try_divide("f_pos", "f_all"), F.lit(0.0)), "recall": F.col("f_pos") / p,
        }
    return j.select(*by, "rep", (F.col("positives") + F.col("negatives")).alias("n"), "positives", *[v.alias(n) for n, v in out.items()])


def interval(replicates: DataFrame, metrics: Sequence[str], by: Sequence[str] = (), level: float = 0.95) -> DataFrame:
    """(by, metric, point, lo, hi): replicate 0 is the point, the rest give the percentile interval."""
    by = list(by)
    long = replicates.unpivot([*by, "rep"], list(metrics), "metric", "value")
    return long.groupBy(*by, "metric").agg(F.max(F.when(F.col("rep") == 0, F.col("value"))).alias("point"), *_bounds("value", level))


def _bounds(value: str, level: float = 0.95):
    """Percentile bounds over replicates; a group holds one value per replicate, so the plain aggregate does."""
    tail = (1 - level) / 2
    drawn = F.when(F.col("rep") > 0, F.col(value))
    return F.percentile(drawn, F.lit(tail)).alias("lo"), F.percentile(drawn, F.lit(1 - tail)).alias("hi")


def bootstrap_ci(
    df: DataFrame, score: str, y: str, key: Sequence[str], metrics: Sequence[str] = ("pr_auc", "roc_auc"),
    replicates: int = 1000, seed: int = 0, by: Sequence[str] = (), share: float | None = None, level: float = 0.95,
) -> DataFrame:
    return interval(bootstrap_replicates(df, score, y, key, replicates, seed, by, share), metrics, by, level)


def paired_bootstrap(
    df: DataFrame, a: str, b: str, y: str, key: Sequence[str], metrics: Sequence[str] = ("pr_auc",),
    replicates: int = 1000, seed: int = 0, share: float | None = None, level: float = 0.95,
) -> DataFrame:
    """(metric, point, lo, hi) of metric(a) - metric(b) with both scores on the same resampled rows.

    One score comes after the other, in the same buckets, and what the first shuffles is gone before the second begins. The table is
    read several times, so it should be stored.
    """
    both = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    rows = {m: both.select(F.lit(m).alias("model"), *key, y, F.col(c).cast("double").alias("score")) for m, c in (("a", a), ("b", b))}
    buckets = ranking.buckets_for(rows["a"].unionByName(rows["b"]), F.col("score") + F.lit(0.0))
    parts = [written(bootstrap_replicates(r, "score", y, key, replicates, seed, ["model"], share, buckets), "replicates") for r in rows.values()]
    reps = parts[0].unionByName(parts[1])
    return paired_interval(reps, "model", "a", "b", metrics, level)


def paired_interval(replicates: DataFrame, name: str, a: str, b: str, metrics: Sequence[str], level: float = 0.95) -> DataFrame:
    """(metric, point, lo, hi) of metric(a) - metric(b) from replicates of both on the same rows."""
    diff = replicates.groupBy("rep").agg(*[
        (F.max(F.when(F.col(name) == a, F.col(m))) - F.max(F.when(F.col(name) == b, F.col(m)))).alias(m) for m in metrics
    ])
    return interval(diff, metrics, (), level)


def rate_bootstrap(
    df: DataFrame, cells: Sequence[str], y: str, key: Sequence[str], replicates: int = 500, seed: int = 0
) -> DataFrame:
    """(cells, rep, n, cases): resampled counts per cell of a grouping with few levels.

    Partial sums are taken per task with the replicates as a numpy axis; only cells x replicates totals
    per task are shuffled.
    """
    rows = df.select(*cells, F.col(y).cast("int").alias("y"), F.xxhash64(*[F.col(c) for c in key]).alias("key"))
    return _cell_sums(rows, list(cells), replicates, seed, lambda pdf: pdf["y"].to_numpy().astype(bool).astype(np.int64))


def _cell_sums(rows: DataFrame, cells: list[str], replicates: int, seed: int, labels: Callable[[pd.DataFrame], np.ndarray]) -> DataFrame:
    ddl = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in cells)
    reps = np.arange(replicates + 1)

    def partial(batches):
        sums: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}

        def flush():
            for k, (n, cases) in sums.items():
                out = pd.DataFrame({"rep": reps, "n": n, "cases": cases})
                for c, v in zip(cells, k):
                    out[c] = v
                yield out[[*cells, "rep", "n", "cases"]]
            sums.clear()

        for pdf in batches:
            if not len(pdf):
                continue
            cell = pdf.groupby(cells, dropna=False, sort=False).ngroup().to_numpy()
            order = np.argsort(cell, kind="stable")
            starts = np.flatnonzero(np.r_[True, np.diff(cell[order]) != 0])
            n, cases = _sums(pdf["key"].to_numpy()[order], labels(pdf)[order], starts, reps, seed)
            for i, k in enumerate(pdf[cells].iloc[order[starts]].itertuples(index=False, name=None)):
                have = sums.get(k)
                sums[k] = (n[i], cases[i]) if have is None else (have[0] + n[i], have[1] + cases[i])
            if len(sums) > MAX_CELLS:
                yield from flush()
        yield from flush()

    return (
        rows.mapInPandas(partial, f"{ddl}rep int, n long, cases long")
        .groupBy(*cells, "rep").agg(F.sum("n").alias("n"), F.sum("cases").alias("cases"))
    )


def missing_lift_ci(
    df: DataFrame, flags: Sequence[str], y: str, key: Sequence[str], replicates: int = 500, seed: int = 0, minimum: int = 5
) -> DataFrame:
    """Rate when absent over rate when present with a percentile interval, for flags set at least `minimum` times."""
    cells = F.array(*[F.struct(F.lit(c).alias("flag"), F.col(c).cast("boolean").alias("absent")) for c in flags])
    long = df.select(*key, y, F.explode(cells).alias("_c")).select(*key, y, "_c.flag", "_c.absent")
    counts = rate_bootstrap(long, ["flag", "absent"], y, key, replicates, seed)
    a = F.col("absent")
    per = counts.groupBy("flag", "rep").agg(
        F.coalesce(F.sum(F.when(a, F.col("n"))), F.lit(0)).alias("n_absent"), F.sum("n").alias("n"),
        F.try_divide(F.sum(F.when(a, F.col("cases"))).cast("double"), F.sum(F.when(a, F.col("n")))).alias("rate_absent"),
        F.try_divide(F.sum(F.when(~a, F.col("cases"))).cast("double"), F.sum(F.when(~a, F.col("n")))).alias("rate_present"),
    ).withColumn("lift", F.try_divide("rate_absent", "rate_present"))
    here = F.col("rep") == 0
    g = per.groupBy("flag").agg(
        *[F.max(F.when(here, F.col(c))).alias(c) for c in ("n_absent", "n", "rate_absent", "rate_present", "lift")], *_bounds("lift")
    )
    return g.where(F.col("n_absent") >= minimum).select(
        "flag", (F.col("n_absent") / F.col("n").cast("double")).alias("share_absent"), "n_absent", "rate_absent", "rate_present",
        "lift", "lo", "hi",
    )


def month_slope_ci(
    df: DataFrame, month_index: str, y: str, key: Sequence[str], subsets: dict, replicates: int = 300, seed: int = 0
) -> DataFrame:
    """Logistic month slope with a bootstrap interval for named row subsets (name -> condition)."""
    tags = F.explode(F.array_compact(F.array(*[F.when(cond, F.lit(n)) for n, cond in subsets.items()])))
    rows = df.select(*key, y, month_index, tags.alias("subset"))
    counts = rate_bootstrap(rows, ["subset", month_index], y, key, replicates, seed)
    slopes = slope_from_counts(counts, month_index, ["subset", "rep"])
    return slopes.groupBy("subset").agg(
        F.max(F.when(F.col("rep") == 0, F.col("n"))).alias("n"),
        F.max(F.when(F.col("rep") == 0, F.col("slope"))).alias("slope_per_month"), *_bounds("slope"),
    )
