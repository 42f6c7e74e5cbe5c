"""Association between columns and a binary outcome, and among columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.columns import finite
from plumbline.functions.pvalues import KS_EXACT, p_binomial, p_chi2, p_ks_two_sample, p_normal, p_student
from plumbline.operators import ranking
from plumbline.operators.profile import group_rate, long_levels, long_values
from plumbline.operators.rankcorr import spearman  # noqa: F401
from plumbline.operators.ranking import merge_rows, null_safe_join
from plumbline.session import written


def mann_whitney_stats(df: DataFrame, cols: Sequence[str], y: str) -> DataFrame:
    """U of the positives, class counts, AUC effect and the tie-corrected z per numeric column."""
    long = long_values(df, cols, [y])
    a = ranking.auc(long, "value", y, ["column"])
    n1, n0 = F.col("n_pos").cast("double"), F.col("n_neg").cast("double")
    n = n1 + n0
    sd = F.sqrt(n1 * n0 / 12 * ((n + 1) - F.try_divide(F.col("ties"), n * (n - 1))))
    # two-sided with continuity correction
    z = F.try_divide(F.abs(F.col("u") - n1 * n0 / 2) - 0.5, sd)
    return a.select("column", F.col("u"), "n_pos", "n_neg", F.col("auc").alias("effect"), F.greatest(z, F.lit(0.0)).alias("z"))


def mann_whitney(df: DataFrame, cols: Sequence[str], y: str) -> DataFrame:
    return mann_whitney_stats(df, cols, y).withColumn("p_value", p_normal("z"))


def chi_square_stats(df: DataFrame, cols: Sequence[str], y: str) -> DataFrame:
    """Chi-square of independence with the 0/1 outcome and Cramer's V per categorical column.

    Yates' correction applies with one degree of freedom, and V is taken from the corrected value.
    """
    counts = long_levels(df, cols, [y]).groupBy("column", "level").agg(
        F.count("*").alias("n"), F.sum(F.col(y).cast("int")).cast("long").alias("pos")
    )
    return chi_square_from_counts(counts, ["column"])


def chi_square_from_counts(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, chi2, dof, cramers_v, n_pos, n_neg) from one row (n, pos) per level."""
    by = list(by)
    totals = counts.groupBy(*by).agg(F.sum("n").alias("_n"), F.sum("pos").alias("_p"), F.count("*").alias("_k"))
    j = null_safe_join(counts, totals, by)
    n, p = F.col("_n").cast("double"), F.col("_p").cast("double")
    dof = F.col("_k") - 1

    def term(observed: Column, share: Column) -> Column:
        expected = F.col("n") * share
        gap = F.abs(observed - expected)
        gap = F.when(dof == 1, gap - F.least(F.lit(0.5), gap)).otherwise(gap)
        return F.try_divide(gap * gap, expected)

    both = term(F.col("pos"), p / n) + term(F.col("n") - F.col("pos"), (n - p) / n)
    usable = F.col("_p").between(1, F.col("_n") - 1) & (F.col("_k") > 1)
    g = j.groupBy(*by).agg(
        F.sum(F.when(usable, both)).alias("chi2"), F.max(dof).alias("dof"),
        F.max("_p").alias("n_pos"), F.max(F.col("_n") - F.col("_p")).alias("n_neg"), F.max("_n").alias("_n"),
    )
    # two outcome columns, so min(rows, columns) - 1 is one
    return g.select(*by, "chi2", "dof", F.sqrt(F.col("chi2") / F.col("_n")).alias("cramers_v"), "n_pos", "n_neg")


def chi_square(df: DataFrame, cols: Sequence[str], y: str) -> DataFrame:
    return chi_square_stats(df, cols, y).withColumn("p_value", p_chi2("chi2", F.col("dof").cast("double")))


def bivariate_rank(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], y: str, alpha: float = 0.05) -> DataFrame:
    """Every column's effect on one 0..1 strength scale with a Bonferroni flag, strongest first."""
    num = mann_whitney(df, numeric, y).select(
        "column", F.lit("numeric").alias("kind"), F.col("u").alias("statistic"), "p_value", "effect",
        (F.abs(F.col("effect") - 0.5) * 2).alias("strength"), "n_pos", "n_neg",
    )
    cat = chi_square(df, categorical, y).select(
        "column", F.lit("categorical").alias("kind"), F.col("chi2").alias("statistic"), "p_value",
        F.col("cramers_v").alias("effect"), F.col("cramers_v").alias("strength"), "n_pos", "n_neg",
    )
    tests = len(numeric) + len(categorical)
    return (
        num.unionByName(cat).withColumn("significant", F.col("p_value") < alpha / tests)
        .orderBy(F.desc_nulls_last("strength"), "column")
    )


def ks_test(df: DataFrame, col: str, y: str, by: Sequence[str] = (), method: str = "limit") -> DataFrame:
    """Two-sample KS distance between the outcome classes with its p-value, for the table or each group: limit for the limit law, exact for
    lattice paths that know the runs of equal values, auto for the exact law up to KS_EXACT values a class."""
    if method == "limit":
        k = ranking.ks_two_sample(df, col, y, by)
        return k.withColumn("p_value", p_ks_two_sample(F.col("ks"), F.col("n1"), F.col("n0"), method=method))
    k = ranking.ks_two_sample(df, col, y, by, runs_up_to=KS_EXACT)
    return k.withColumn("p_value", p_ks_two_sample(F.col("ks"), F.col("n1"), F.col("n0"), F.col("ends"), method)).drop("ends")


def missing_effect_stats(df: DataFrame, cols: Sequence[str], y: str) -> DataFrame:
    """Event rate where each column is absent and present, with the chi-square of absence against outcome."""
    flags = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).isNull().cast("string").alias("level")) for c in cols])
    counts = (
        df.select(F.col(y).cast("int").alias("_y"), F.explode(flags).alias("_c"))
        .groupBy("_c.column", "_c.level").agg(F.count("*").alias("n"), F.sum("_y").cast("long").alias("pos"))
    )
    absent = F.col("level") == "true"
    rates = counts.groupBy("column").agg(
        F.coalesce(F.sum(F.when(absent, F.col("n"))), F.lit(0)).alias("n_absent"),
        F.try_divide(F.sum(F.when(absent, F.col("pos"))).cast("double"), F.sum(F.when(absent, F.col("n")))).alias("rate_absent"),
        F.try_divide(F.sum(F.when(~absent, F.col("pos"))).cast("double"), F.sum(F.when(~absent, F.col("n")))).alias("rate_present"),
    )
    return merge_rows([rates, chi_square_from_counts(counts, ["column"]).select("column", "chi2", "dof")], ["column"])


def missing_effect(df: DataFrame, cols: Sequence[str], y: str) -> DataFrame:
    out = missing_effect_stats(df, cols, y)
    return out.withColumn("p_value", p_chi2("chi2", F.col("dof").cast("double"))).drop("dof")


def missing_sign_test(effects: DataFrame) -> DataFrame:
    """How many columns show a higher rate when absent, and the one-sided binomial tail of that count."""
    g = effects.agg(F.count_if(F.col("rate_absent") > F.col("rate_present")).alias("higher"), F.count("*").alias("columns"))
    return g.withColumn("p_value", p_binomial(F.col("higher").cast("double"), F.col("columns").cast("double")))


def vintage_trend(df: DataFrame, month: str, y: str, min_n: int = 200) -> DataFrame:
    """Month table with interval, maturity mark and month rank: mature up to the last month with min_n rows."""
    per = group_rate(df, [month], y)
    last = per.where(F.col("n") >= min_n).agg(F.max(month).alias("m")).scalar()
    order = Window.orderBy(month)  # over one row per calendar month
    return per.select(
        month, "n", "cases", "rate", "lo", "hi",
        F.coalesce(F.col(month) <= last, F.lit(False)).alias("mature"), (F.row_number().over(order) - 1).alias("position"),
    )


def trend_correlation(trend: DataFrame) -> DataFrame:
    """Spearman rank correlation of month position and rate, over all and over mature months."""
    sets = trend.select(F.explode(F.when(F.col("mature"), F.array(F.lit("all"), F.lit("mature"))).otherwise(F.array(F.lit("all")))).alias("months"), "position", "rate")
    w = Window.partitionBy("months")

    def shared(c: str) -> Column:
        lower = F.rank().over(w.orderBy(c))
        return lower + (F.count("*").over(w.partitionBy("months", c)) - 1) / 2

    ranked = sets.select("months", shared("position").alias("a"), shared("rate").alias("b"))
    g = ranked.groupBy("months").agg(F.corr("a", "b").alias("rho"), F.count("*").alias("n"))
    n = F.col("n").cast("double")
    t = F.col("rho") * F.sqrt(F.try_divide(n - 2, F.greatest(1 - F.col("rho") * F.col("rho"), F.lit(1e-300))))
    return g.withColumn("p_value", F.when(n > 2, p_student(t, n - 2)))


def redundant_pairs(corr: DataFrame, strength: DataFrame, t: float = 0.7) -> DataFrame:
    """Pairs with |rho| >= t and which of the two to keep: the one with more strength (column, strength)."""
    s = strength.select(F.col("column").alias("_c"), F.col("strength").alias("_v"))
    out = corr.where(F.abs("rho") >= t)
    for side in ("a", "b"):
        mine = s.select(F.col("_c").alias(side), F.col("_v").alias(f"strength_{side}"))
        out = out.join(mine, side, "left")
    first = F.round("strength_a", 3) >= F.round("strength_b", 3)
    return out.select(
        "a", "b", "rho", "strength_a", "strength_b",
        F.when(first, F.col("a")).otherwise(F.col("b")).alias("keep"),
        F.when(first, F.col("b")).otherwise(F.col("a")).alias("drop"),
    )


def univariate_auc(df: DataFrame, cols: Sequence[str], y: str, month: str | None = None) -> DataFrame:
    """AUC, direction and share of missing per column (gaps filled with the median), optionally with the
    number of months whose AUC points the same way."""
    from plumbline.operators.quantiles import exact_quantiles

    med = exact_quantiles(df, list(cols), [0.5])
    keep = [y] + ([month] if month else [])
    filled = df.select(*keep, *[F.coalesce(finite(c), F.lit(med[c][0])).alias(c) for c in cols])
    share = df.agg(*[F.avg(finite(c).isNull().cast("double")).alias(c) for c in cols]).unpivot([], list(cols), "column", "missing")
    long = long_values(filled, cols, keep)
    buckets = ranking.buckets_for(long, "value")
    whole = ranking.auc(long, "value", y, ["column"], buckets).select("column", "auc")
    parts = [whole, share]
    if month:
        whole = parts[0] = written(whole, "auc")  # read beside the months; what it shuffled is gone before they begin
        per = ranking.auc(long, "value", y, ["column", month], buckets).select("column", F.col("auc").alias("_m"))
        signed = null_safe_join(per.where("_m is not null"), whole, ["column"])
        parts.append(signed.groupBy("column").agg(
            F.count("*").alias("months"), F.count_if((F.col("_m") > 0.5) == (F.col("auc") > 0.5)).alias("months_same_sign")
        ))
    out = merge_rows(parts, ["column"])
    return out.withColumns({
        "direction": F.when(F.col("auc") > 0.5, "+").otherwise("-"), "strength": F.abs(F.col("auc") - 0.5)
    })


def engineering_effect(raw: DataFrame, engineered: DataFrame, cols: Sequence[str], y: str) -> DataFrame:
    """Univariate AUC before and after the fitted transforms."""
    a = univariate_auc(raw, cols, y).select("column", F.col("auc").alias("auc_raw"))
    b = ranking.auc(long_values(engineered, cols, [y]), "value", y, ["column"]).select("column", F.col("auc").alias("auc_engineered"))
    return merge_rows([a, b], ["column"]).withColumn("delta", F.col("auc_engineered") - F.col("auc_raw"))


def month_slope(df: DataFrame, month_index: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Slope of a one-variable logistic regression of the outcome on the month number, per group."""
    cells = df.groupBy(*by, month_index).agg(F.count("*").alias("n"), F.sum(F.col(y).cast("int")).alias("cases"))
    return slope_from_counts(cells, month_index, by)


def slope_from_counts(cells: DataFrame, month_index: str, by: Sequence[str] = (), steps: int = 25) -> DataFrame:
    """(by, n, slope) from counts (n, cases) per group and month.

    A group holds at most one row per calendar month; Newton steps run as an array fold over them.
    """
    g = cells.groupBy(*by).agg(
        F.sort_array(F.collect_list(F.struct(
            F.col(month_index).cast("double").alias("t"), F.col("n").cast("double").alias("n"), F.col("cases").cast("double").alias("k")
        ))).alias("_m"),
        F.sum("n").cast("long").alias("n"),
    )
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("b"))

    def bind(value: Column, use) -> Column:
        """use(value) with the value computed once."""
        return F.get(F.transform(F.array(value), use), F.lit(0))

    def newton(state, _):
        def add(acc, m):
            def grow(p):
                w, r = m["n"] * p * (1 - p), m["k"] - m["n"] * p
                return F.struct(
                    (acc["g0"] + r).alias("g0"), (acc["g1"] + r * m["t"]).alias("g1"), (acc["h00"] + w).alias("h00"),
                    (acc["h01"] + w * m["t"]).alias("h01"), (acc["h11"] + w * m["t"] * m["t"]).alias("h11"),
                )

            return bind(1 / (1 + F.exp(-(state["a"] + state["b"] * m["t"]))), grow)

        def step(s):
            det = s["h00"] * s["h11"] - s["h01"] * s["h01"]
            return F.struct(
                (state["a"] + F.coalesce(F.try_divide(s["h11"] * s["g0"] - s["h01"] * s["g1"], det), F.lit(0.0))).alias("a"),
                (state["b"] + F.coalesce(F.try_divide(s["h00"] * s["g1"] - s["h01"] * s["g0"], det), F.lit(0.0))).alias("b"),
            )

        start = F.struct(*[F.lit(0.0).alias(x) for x in ("g0", "g1", "h00", "h01", "h11")])
        return bind(F.aggregate("_m", start, add), step)

    fitted = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), zero, newton)
    return g.select(*by, "n", fitted.alias("_f")).select(*by, "n", F.col("_f.b").alias("slope"))
