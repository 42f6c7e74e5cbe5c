"""Descriptions of a table: columns, distributions, frequencies, outliers, rates by group and by month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import as_column, band, bucket_index, finite, wilson
from plumbline.operators.quantiles import exact_quantiles
from plumbline.operators.ranking import merge_rows, null_safe_join


def long_values(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., column, value): numeric columns stacked as doubles, unknown values left out."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), finite(c).alias("value")) for c in cols])
    return df.select(*keep, F.explode(cells).alias("_c")).select(*keep, "_c.column", "_c.value").where("value is not null")


def long_levels(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (), nulls: bool = False) -> DataFrame:
    """(keep..., column, level): columns stacked as text."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in cols])
    out = df.select(*keep, F.explode(cells).alias("_c")).select(*keep, "_c.column", "_c.level")
    return out if nulls else out.where("level is not null")


def profile(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = False) -> DataFrame:
    """Type, NULLs, share of NULLs and distinct values per column, from one scan.

    Distinct values are sketched; exact=True counts them by grouping (column, value) pairs, which
    spreads over the cluster instead of expanding every row once per column and sorting it.
    """
    names = list(cols) if cols else df.columns
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    wide = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(names)],
        *([] if exact else [F.approx_count_distinct(c, 0.01).alias(f"d_{i}") for i, c in enumerate(names)]),
    )
    rows = F.array(*[
        F.struct(
            F.lit(c).alias("column"), F.lit(types[c]).alias("type"), F.col(f"n_{i}").alias("nulls"),
            F.try_divide(F.col(f"n_{i}") * 100.0, F.col("_rows")).alias("pct_null"),
            *([] if exact else [F.col(f"d_{i}").alias("distinct")]),
        )
        for i, c in enumerate(names)
    ])
    out = wide.select(F.inline(rows))
    if not exact:
        return out
    distinct = (
        long_levels(df, names).groupBy("column", "level").agg(F.lit(1).alias("_one"))
        .groupBy("column").agg(F.count("*").alias("distinct"))
    )
    return merge_rows([out, distinct], ["column"]).withColumn("distinct", F.coalesce("distinct", F.lit(0)))


def base_rate(df: DataFrame, y: str) -> DataFrame:
    return df.agg(F.count("*").alias("n"), F.sum(F.col(y).cast("int")).alias("cases"), F.avg(F.col(y).cast("double")).alias("rate"))


def modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, mode, mode_share): most frequent value, smallest on a tie."""
    counts = long_values(df, cols).groupBy("column", "value").agg(F.count("*").alias("n"))
    return counts.groupBy("column").agg(
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"),
        (F.max("n") / F.sum("n").cast("double")).alias("mode_share"),
    )


def _corrected_skew(skew: Column, n: Column) -> Column:
    return F.when(n > 2, skew * F.sqrt(n * (n - 1)) / (n - 2))


def _corrected_kurt(excess: Column, n: Column) -> Column:
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * excess + 6))


def moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column: n, mean, sample variance and deviation, bias-corrected skew and kurtosis, range."""
    wide, parts = [], []
    for i, c in enumerate(cols):
        v = finite(c)
        wide += [
            F.count(v).alias(f"n{i}"), F.avg(v).alias(f"m{i}"), F.var_samp(v).alias(f"v{i}"), F.min(v).alias(f"a{i}"),
            F.max(v).alias(f"z{i}"), F.skewness(v).alias(f"s{i}"), F.kurtosis(v).alias(f"k{i}"),
            F.skewness(F.when(v >= 0, F.log1p(v))).alias(f"ls{i}"), F.count_if(v >= 0).alias(f"ln{i}"),
        ]
        n = F.col(f"n{i}").cast("double")
        parts.append(F.struct(
            F.lit(c).alias("column"), F.col(f"n{i}").alias("n"), F.col(f"m{i}").alias("mean"),
            F.col(f"v{i}").alias("variance"), F.sqrt(f"v{i}").alias("sd"),
            F.col(f"a{i}").alias("min"), F.col(f"z{i}").alias("max"),
            F.try_divide(F.sqrt(f"v{i}"), F.col(f"m{i}")).alias("cv"),
            _corrected_skew(F.col(f"s{i}"), n).alias("skew"), _corrected_kurt(F.col(f"k{i}"), n).alias("kurtosis"),
            F.col(f"s{i}").alias("skew_biased"), F.col(f"k{i}").alias("kurtosis_biased"),
            _corrected_skew(F.col(f"ls{i}"), F.col(f"ln{i}").cast("double")).alias("skew_log1p"),
        ))
    return df.agg(*wide).select(F.inline(F.array(*parts)))


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, median, mode, range, quartiles, IQR, variance, deviation, CV, skew and kurtosis."""
    q = exact_quantiles(df, list(cols), [0.25, 0.5, 0.75])
    quart = F.create_map(*[
        x for c in cols for x in (F.lit(c), F.array(*[F.lit(v).cast("double") for v in q[c]]))
    ])
    base = merge_rows([moments(df, cols), modes(df, cols)], ["column"])
    at = F.element_at(quart, F.col("column"))
    return base.select(
        "column", "n", "mean", at[1].alias("median"), "mode", "min", "max",
        (F.col("max") - F.col("min")).alias("range"), at[0].alias("q1"), at[2].alias("q3"),
        (at[2] - at[0]).alias("iqr"), "variance", "sd", "cv", "skew", "kurtosis",
    )


def shape_class(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distribution family of each column from its mode share, skew, kurtosis and the skew of log1p."""
    base = merge_rows([moments(df, cols), modes(df, cols)], ["column"])
    a, k = F.col("skew"), F.col("kurtosis")
    kind = (
        F.when(F.col("mode_share") > 0.90, "quasi-constant")
        .when((F.abs(a) < 0.5) & (F.abs(k) < 1), "symmetric")
        .when(a <= -0.5, "left-skewed")
        .when(F.abs("skew_log1p") < F.abs(a) / 2, "right-skewed, log fixes")
        .otherwise("right-skewed, heavy tail")
    )
    return base.select("column", "skew", "kurtosis", "skew_log1p", "mode_share", kind.alias("shape"))


def normality(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """D'Agostino-Pearson test from biased skew and kurtosis: K2 and p = exp(-K2 / 2)."""
    m = moments(df, cols)
    n = F.col("n").cast("double")
    g1, b2 = F.col("skew_biased"), F.col("kurtosis_biased") + 3
    # skewness part
    y = g1 * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    beta2 = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.sqrt(2 * (beta2 - 1)) - 1
    z1 = 1 / F.sqrt(F.log(F.sqrt(w2))) * F.asinh(y / F.sqrt(2 / (w2 - 1)))
    # kurtosis part
    mean = 3 * (n - 1) / (n + 1)
    var = 24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (b2 - mean) / F.sqrt(var)
    third = 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6 + 8 / third * (2 / third + F.sqrt(1 + 4 / (third * third)))
    denom = 1 + x * F.sqrt(2 / (a - 4))
    z2 = (1 - 2 / (9 * a) - F.signum(denom) * F.cbrt((1 - 2 / a) / F.abs(denom))) / F.sqrt(2 / (9 * a))
    return m.select("column", "n", (z1 * z1 + z2 * z2).alias("k2")).withColumn("p_value", F.exp(-F.col("k2") / 2))


def frequencies(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count and share of every level per column, NULL included as a level."""
    counts = long_levels(df, cols, nulls=True).groupBy("column", "level").agg(F.count("*").alias("n"))
    totals = counts.groupBy("column").agg(F.sum("n").alias("_t"))
    return null_safe_join(counts, totals, ["column"]).select(
        "column", "level", "n", (F.col("n") * 100.0 / F.col("_t")).alias("pct")
    )


def histogram(df: DataFrame, col: str, bins: int = 40) -> DataFrame:
    """Equal-width bins, over log10(x + 1) when the column is non-negative and its skew exceeds 2.

    The bin bounds are a handful of numbers from a first scan; the second scan only counts.
    """
    m = moments(df, [col]).first()
    log = m["skew"] is not None and m["skew"] > 2 and m["min"] >= 0
    v = F.log10(finite(col) + 1) if log else finite(col)
    lo, hi = df.agg(F.min(v), F.max(v)).first()
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, log_scale boolean, n long")
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    b = F.least(F.floor((v - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(bins - 1))
    return (
        df.select(b.alias("bin")).where("bin is not null").groupBy("bin").agg(F.count("*").alias("n"))
        .select("bin", (F.lit(lo) + F.col("bin") * width).alias("lo"), (F.lit(lo) + (F.col("bin") + 1) * width).alias("hi"),
                F.lit(log).alias("log_scale"), "n")
    )


def iqr_outliers(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Upper fence Q3 + 1.5 IQR, rows above it, p99, maximum and maximum over p99, one row per column."""
    q = exact_quantiles(df, list(cols), [0.25, 0.75, 0.99])
    wide, parts = [], []
    for i, c in enumerate(cols):
        v = finite(c)
        q1, q3, p99 = q[c]
        fence = None if q1 is None else q3 + 1.5 * (q3 - q1)
        wide += [F.count(v).alias(f"n{i}"), F.count_if(v > F.lit(fence)).alias(f"o{i}"), F.max(v).alias(f"z{i}")]
        lit99 = F.lit(p99).cast("double")
        parts.append(F.struct(
            F.lit(c).alias("column"), F.col(f"n{i}").alias("n"), F.lit(fence).cast("double").alias("fence"),
            F.col(f"o{i}").alias("outliers"), F.try_divide(F.col(f"o{i}") * 100.0, F.col(f"n{i}")).alias("pct"),
            lit99.alias("p99"), F.col(f"z{i}").alias("max"),
            F.when(lit99 > 0, F.col(f"z{i}") / lit99).alias("max_over_p99"),
        ))
    return df.agg(*wide).select(F.inline(F.array(*parts)))


def group_rate(df: DataFrame, by: Sequence[str], y: str | Column, z: float = 1.96) -> DataFrame:
    """Rows, cases and the event rate with its Wilson interval per group; NULL groups are left out."""
    present = F.lit(True)
    for c in by:
        present = present & F.col(c).isNotNull()
    g = df.where(present).groupBy(*by).agg(F.count("*").alias("n"), F.sum(as_column(y).cast("int")).alias("cases"))
    rate, lo, hi = wilson(F.col("cases"), F.col("n"), z)
    return g.select(*by, "n", "cases", rate.alias("rate"), lo.alias("lo"), hi.alias("hi"))


def lift(df: DataFrame, by: Sequence[str], y: str) -> DataFrame:
    """group_rate with each group's rate over the rate of all rows (a scalar subquery, not a join)."""
    base = df.agg(F.avg(F.col(y).cast("double")).alias("b")).scalar()
    return group_rate(df, by, y).withColumn("lift", F.try_divide(F.col("rate"), base))


def level_lifts(df: DataFrame, cols: Sequence[str], y: str) -> DataFrame:
    """Rate, interval and lift of every level of several columns, from one pass with grouping sets."""
    rows = df.select(*[F.col(c).cast("string").alias(c) for c in cols], F.col(y).cast("int").alias("_y"))
    keys = [F.col(c) for c in cols]
    g = rows.groupingSets([[c] for c in keys], *keys).agg(
        F.count("*").alias("n"), F.sum("_y").alias("cases"), F.grouping_id(*keys).alias("_g")
    )
    base = df.agg(F.avg(F.col(y).cast("double")).alias("b")).scalar()
    full = (1 << len(cols)) - 1
    col, level = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, c in enumerate(cols):
        mine = F.col("_g") == full - (1 << (len(cols) - 1 - i))
        col, level = F.when(mine, c).otherwise(col), F.when(mine, F.col(c)).otherwise(level)
    rate, lo, hi = wilson(F.col("cases"), F.col("n"))
    tagged = g.select(col.alias("column"), level.alias("level"), "n", "cases").where("level is not null")
    return tagged.select(
        "column", "level", "n", "cases", rate.alias("rate"), lo.alias("lo"), hi.alias("hi"),
        F.try_divide(rate, base).alias("lift"),
    )


def rate_pivot(df: DataFrame, row: str, col: str, y: str, levels: Sequence[str]) -> DataFrame:
    """Rate and count of each row level by column level; the column levels are declared, never discovered."""
    out = df.where(F.col(row).isNotNull()).groupBy(row).pivot(col, list(levels)).agg(
        F.avg(F.col(y).cast("double")).alias("rate"), F.count(F.lit(1)).alias("n")
    )
    return out.fillna(0, subset=[f"{v}_n" for v in levels])


def qcut(df: DataFrame, col: str, n: int, labels: Sequence[str] | None = None, name: str | None = None) -> DataFrame:
    """Equal-frequency bands of the values: right-closed, the lowest edge included, repeated edges merged."""
    q = exact_quantiles(df, [col], [j / n for j in range(n + 1)])[col]
    name = name or f"{col}_band"
    if q[0] is None:
        return df.withColumn(name, F.lit(None).cast("string" if labels else "int"))
    edges = sorted(set(q))
    if labels and len(labels) != len(edges) - 1:
        raise ValueError(f"{col}: {len(edges) - 1} distinct bands but {len(labels)} labels")
    i = bucket_index(finite(col), edges[1:-1])
    if labels is None:
        return df.withColumn(name, i)
    return df.withColumn(name, F.when(i.isNotNull(), F.element_at(F.array(*[F.lit(x) for x in labels]), i + 1)))


def cut(df: DataFrame, col: str, edges: Sequence, labels: Sequence[str], name: str | None = None) -> DataFrame:
    return df.withColumn(name or f"{col}_band", band(col, edges, labels))


def max_value_leak(df: DataFrame, col: str, y: str) -> DataFrame:
    """Outcome shares for rows at the column's maximum and below it: a leaking column separates them."""
    top = df.agg(F.max(col).alias("m")).scalar()
    at_max = (F.col(col) == top).alias("at_max")
    return df.select(at_max, F.col(y).cast("int").alias("_y")).groupBy(F.coalesce("at_max", F.lit(False)).alias("at_max")).agg(
        F.count("*").alias("n"), (100 * F.avg(F.col("_y").cast("double"))).alias("pct_event"),
        (100 - 100 * F.avg(F.col("_y").cast("double"))).alias("pct_clear"),
    )


def volume(df: DataFrame, month: str) -> DataFrame:
    return df.groupBy(month).agg(F.count("*").alias("n"))


def volume_summary(df: DataFrame, month: str, tail: int = 4) -> DataFrame:
    """Peak month, its volume, and the volume of the last `tail` months."""
    per = volume(df, month)
    last = F.slice(F.reverse(F.array_sort(F.collect_list(F.struct(month, "n")))), 1, tail)  # one item per calendar month
    return per.agg(
        F.max_by(month, F.struct("n", month)).alias("peak"), F.max("n").alias("peak_n"), F.sum("n").alias("n"),
        last.alias("_tail"),
    ).select("peak", "peak_n", "n", F.aggregate("_tail", F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("tail_n"))


def maturity(df: DataFrame, month: str, y: str, term: str, long_term: float = 12) -> DataFrame:
    """Loans, defaults, rate, mean term and share of long terms per month."""
    return df.groupBy(month).agg(
        F.count("*").alias("loans"), F.sum(F.col(y).cast("int")).alias("defaults"),
        F.avg(F.col(y).cast("double")).alias("rate"), F.avg(term).alias("mean_term"),
        F.avg((F.col(term) > long_term).cast("double")).alias("share_long"),
    )


def segments(df: DataFrame, bands: Sequence[str], y: str, min_n: int = 100, k: int = 5) -> DataFrame:
    """The k riskiest and k safest combinations of bands with at least min_n rows, with interval and lift."""
    label = F.concat_ws(" / ", *[F.coalesce(F.col(b).cast("string"), F.lit("nan")) for b in bands])
    rated = lift(df.select(label.alias("segment"), F.col(y).cast("int").alias("_y")), ["segment"], "_y").where(F.col("n") >= min_n)
    top = rated.orderBy(F.desc("rate"), "segment").limit(k).withColumn("end", F.lit("riskiest"))
    bottom = rated.orderBy(F.asc("rate"), F.desc("segment")).limit(k).withColumn("end", F.lit("safest"))
    return top.unionByName(bottom)
