"""Time-ordered splits, folds and samples. Months are labels like 2025-06; their count is calendar-bound."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.columns import unit_hash

#: Rows that a slice of the exact fold deal holds on average.
SLICE_ROWS = 50_000


def month_counts(df: DataFrame, month: str) -> DataFrame:
    """Rows per month with the cumulative share: one row per calendar month."""
    per = df.where(F.col(month).isNotNull()).groupBy(month).agg(F.count("*").alias("n"))
    # The window has no partition key on purpose: its input is the month table, not the rows.
    upto = Window.orderBy(month).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.orderBy(month).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return per.select(
        month, "n",
        (F.sum("n").over(upto) / F.sum("n").over(every).cast("double")).alias("cum_share"),
    )


def vintage_cutoff(df: DataFrame, month: str, fraction: float) -> DataFrame:
    """One row (cut): the first month whose cumulative share reaches the fraction, else the last month."""
    reached = F.min(F.when(F.col("cum_share") >= fraction, F.col(month)))
    return month_counts(df, month).agg(F.coalesce(reached, F.max(month)).alias("cut"))


def cutoff_value(df: DataFrame, month: str, fraction: float) -> str:
    cut = vintage_cutoff(df, month, fraction).first()["cut"]
    if cut is None:
        raise ValueError("no months to cut")
    return cut


def split_out_of_time(df: DataFrame, month: str, fraction: float) -> tuple[DataFrame, DataFrame, str]:
    """(train, test, cut): months before the cut train, the rest is held out. An empty side is an error."""
    cut = cutoff_value(df, month, fraction)
    if not df.where(F.col(month) < cut).limit(1).count():
        raise ValueError(f"the cut {cut} leaves a side empty")
    return df.where(F.col(month) < cut), df.where(F.col(month) >= cut), cut


def split_labels(cut_test: str, cut_validate: str, month: str, labels: Sequence[str] = ("TRAIN", "VALIDATE", "TEST")) -> Column:
    train, validate, test = labels
    m = F.col(month)
    return F.when(m >= cut_test, test).when(m >= cut_validate, validate).otherwise(train)


def assign_split(
    df: DataFrame, month: str, train_fraction: float, validation_fraction: float, name: str = "split",
    labels: Sequence[str] = ("TRAIN", "VALIDATE", "TEST"),
) -> DataFrame:
    """TEST is the newest months, VALIDATE the newest slice of what remains, TRAIN the rest.

    Both cuts come from one count per month; rows are labelled by comparing with the two literals.
    """
    per = month_counts(df, month).collect()  # one row per calendar month
    per = sorted((r[month], r["n"]) for r in per)
    cut_test = _first_reaching(per, train_fraction)
    rest = [(m, n) for m, n in per if m < cut_test]
    cut_validate = _first_reaching(rest, 1 - validation_fraction) if rest else cut_test
    return df.withColumn(name, split_labels(cut_test, cut_validate, month, labels))


def _first_reaching(per: list[tuple[str, int]], fraction: float) -> str:
    total, run = sum(n for _, n in per), 0
    for m, n in per:
        run += n
        if run / total >= fraction:
            return m
    return per[-1][0]


def split_summary(df: DataFrame, split: str, y: str) -> DataFrame:
    return df.groupBy(split).agg(F.count("*").alias("n"), F.avg(F.col(y).cast("double")).alias("rate"))


def split_frame(df: DataFrame, split: str, train_values: Sequence[str], test_value: str) -> tuple[DataFrame, DataFrame]:
    """(development rows, test rows); a split value that is neither fails the job that reads it."""
    known = [*train_values, test_value]
    check = F.when(F.col(split).isin(known), F.col(split)).otherwise(
        F.raise_error(F.concat(F.lit("unknown split value: "), F.coalesce(F.col(split), F.lit("NULL")))).cast("string")
    )
    checked = df.withColumn(split, check)
    return checked.where(F.col(split).isin(list(train_values))), checked.where(F.col(split) == test_value)


def evaluation_rows(df: DataFrame, split: str, test_value: str) -> DataFrame:
    """The test rows when the table carries a split column, otherwise every row."""
    return df.where(F.col(split) == test_value) if split in df.columns else df


def development_only(df: DataFrame, month: str, cut: str) -> DataFrame:
    """Everything at or after the cut is dropped at load, so nothing downstream can read it."""
    return df.where(F.col(month) < cut)


def time_folds(df: DataFrame, month: str, n_val: int) -> DataFrame:
    """Expanding-origin folds as rows (fold, role, ...): each of the last months validated on all earlier ones.

    A row takes part in at most n_val folds; the months are literals, so no join is needed.
    """
    months = sorted(r[0] for r in df.select(month).where(F.col(month).isNotNull()).distinct().collect())[-n_val:]
    folds = F.array(*[F.struct(F.lit(k).alias("fold"), F.lit(m).alias("fold_month")) for k, m in enumerate(months)])
    out = df.withColumn("_f", F.explode(folds)).where(F.col(month) <= F.col("_f.fold_month"))
    role = F.when(F.col(month) == F.col("_f.fold_month"), "validate").otherwise("train")
    return out.select(F.col("_f.fold").alias("fold"), F.col("_f.fold_month").alias("fold_month"), role.alias("role"), *df.columns)


def stratified_folds(
    df: DataFrame, y: str, key: Sequence[str], k: int, repeats: int = 1, seed: int = 0, exact: bool = False
) -> DataFrame:
    """Adds (repeat, fold) so that every fold holds the same share of each class.

    The default reads the fold off a hash of the key: no shuffle, class shares equal up to sampling.
    exact=True deals the rows of a class round-robin in hash order, so class counts per fold differ by
    at most one. The position within a class is counted in two levels (hash slice, then inside the
    slice), so a class with most of the rows is never sorted in one task.
    """
    reps = df.withColumn("repeat", F.explode(F.array(*[F.lit(r) for r in range(repeats)]))) if repeats > 1 else df.withColumn("repeat", F.lit(0))
    keys = [F.col(c) for c in key]
    h = F.xxhash64(*keys, F.col("repeat"), F.lit(seed))
    if not exact:
        return reps.withColumn("fold", F.pmod(h, F.lit(k)).cast("int"))
    slices = max(1, -(-df.count() * repeats // SLICE_ROWS))
    marked = reps.withColumn("_h", h).withColumn("_s", F.pmod("_h", F.lit(slices)))
    per = marked.groupBy("repeat", y, "_s").agg(F.count("*").alias("_c"))
    before = Window.partitionBy("repeat", y).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    start = per.select("repeat", y, "_s", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("repeat", y, "_s").orderBy("_h", *keys)
    placed = marked.withColumn("_i", F.row_number().over(inside)).join(start, ["repeat", y, "_s"])
    return placed.withColumn("fold", F.pmod(F.col("_start") + F.col("_i") - 1, F.lit(k)).cast("int")).select(
        *df.columns, "repeat", "fold"
    )


def learning_curve_samples(
    df: DataFrame, key: Sequence[str], fractions: Sequence[float], replicates: int, seed: int = 0
) -> DataFrame:
    """Rows (frac, rep, ...) of nested subsamples: a row is in every fraction above its hash.

    The full fraction appears once, the others once per replicate.
    """
    pairs = [(f, r) for f in fractions for r in range(replicates if f < 1 else 1)]
    sets = F.array(*[F.struct(F.lit(float(f)).alias("frac"), F.lit(r).alias("rep")) for f, r in pairs])
    out = df.withColumn("_p", F.explode(sets))
    u = unit_hash(*[F.col(c) for c in key], F.col("_p.rep"), seed=seed)
    return out.where(u < F.col("_p.frac")).select(F.col("_p.frac").alias("frac"), F.col("_p.rep").alias("rep"), *df.columns)


def resample(
    df: DataFrame, y: str, key: Sequence[str], method: str, ratio: float, seed: int = 0
) -> DataFrame:
    """Random over- or under-sampling of a 0/1 class to `ratio` positives per negative, in expectation.

    under keeps negatives by hash; over repeats positives by a hashed number of copies whose mean
    reaches the ratio. Class counts are two numbers; no rows move.
    """
    counts = df.agg(F.count_if(F.col(y) == 1).alias("p"), F.count_if(F.col(y) == 0).alias("q")).first()
    pos, neg = counts["p"], counts["q"]
    if not pos or not neg:
        raise ValueError("resampling needs both classes")
    u = unit_hash(*[F.col(c) for c in key], seed=seed)
    if method == "under":
        return df.where((F.col(y) == 1) | (u < F.lit(min(1.0, pos / ratio / neg))))
    if method == "over":
        mean = max(1.0, neg * ratio / pos)
        whole = int(mean)
        copies = F.when(F.col(y) == 1, F.lit(whole) + (u < F.lit(mean - whole)).cast("int")).otherwise(1)
        return df.withColumn("_c", F.explode(F.sequence(F.lit(1), copies))).drop("_c")
    raise ValueError(f"unknown resampling method {method!r}")
