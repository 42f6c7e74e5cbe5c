"""Drift over the whole history of a stream: cumulative bin counts per window and column against a reference profiled once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from plumbline.functions.columns import bucket_index, finite
from plumbline.functions.pvalues import p_chi2
from plumbline.operators.drift import DriftSpec, shared_columns
from plumbline.operators.quantiles import exact_quantiles

PROFILE = "column string, numeric boolean, edges array<double>, levels array<string>, counts array<long>"
PARTS = 64


@dataclass(frozen=True)
class ColumnBins:
    """How the values of one column are binned: right-closed intervals between edges, or one bin per listed level.

    Every array of counts has the same width: value bins first, then a bin of other levels, then one of absent values.
    """

    column: str
    numeric: bool
    edges: tuple[float, ...] = ()
    levels: tuple[str, ...] = ()


def _bin(b: ColumnBins, df: DataFrame, width: int) -> Column:
    if b.numeric:
        kind = df.schema[b.column].dataType
        c = F.col(f"`{b.column}`")
        v = c.cast("int").cast("double") if isinstance(kind, T.BooleanType) else finite(c if isinstance(kind, T.NumericType) else c.try_cast("double"))
        inside = bucket_index(v, list(b.edges)) if b.edges else F.lit(0)
        return F.when(v.isNull(), F.lit(width - 1)).otherwise(inside)
    v = F.col(f"`{b.column}`").cast("string")
    at = F.array_position(F.array(*[F.lit(x) for x in b.levels]), v) if b.levels else F.lit(0)
    return F.when(v.isNull(), F.lit(width - 1)).when(at > 0, (at - 1).cast("int")).otherwise(F.lit(width - 2))


def bin_counts(df: DataFrame, binned: Sequence[ColumnBins], width: int, by: Sequence[Column] = ()) -> DataFrame:
    """(by, column, counts): how many rows of each group fall into every bin of every column. Counts of disjoint tables add up.

    Every task sends one row per group and column, so neither a hot level nor a hot window makes a large task.
    """
    cells = F.array(*[F.struct(F.lit(b.column).alias("column"), _bin(b, df, width).cast("int").alias("bin")) for b in binned])
    long = df.select(*by, F.explode(cells).alias("_c"))
    names = [c for c in long.columns if c != "_c"]
    return long.groupBy(*names, F.col("_c.column").alias("column")).agg(F.array(*[F.count_if(F.col("_c.bin") == i) for i in range(width)]).alias("counts"))


def store_profile(reference: DataFrame, path: str, exclude: Sequence[str] = (), bins: int = 10) -> None:
    """Profiles the reference once and writes one row per column: intervals between its exact quantiles, or its commonest levels.

    Rarer levels share one bin, so a profile holds at most bins + 2 counts per column whatever the cardinality. A table that stands
    at the path is replaced. An empty reference gives bins without counts; a column of no value bins all present values together.
    """
    numeric, categorical = shared_columns(reference, reference, exclude)
    if not numeric and not categorical:
        raise ValueError("the reference has no column to profile")
    spark = reference.sparkSession
    binned = []
    if numeric:
        kinds = {f.name: f.dataType for f in reference.schema}
        values = {c: F.col(f"`{c}`").cast("int").cast("double") if isinstance(kinds[c], T.BooleanType) else F.col(f"`{c}`").cast("double") for c in numeric}
        cuts = exact_quantiles(reference, values, [i / bins for i in range(1, bins)])
        binned += [ColumnBins(c, True, edges=tuple(sorted({q for q in cuts[c] if q is not None}))) for c in numeric]
    if categorical:
        cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("level")) for c in categorical])
        counted = reference.select(F.inline(cells)).where("level is not null").groupBy("column", "level").agg(F.count("*").alias("n"))
        order = [F.desc("n"), F.col("level")]
        part = Window.partitionBy("column", F.pmod(F.hash("level"), F.lit(PARTS))).orderBy(*order)
        some = counted.withColumn("_i", F.row_number().over(part)).where(F.col("_i") <= bins)  # the first of each part hold the first of all
        first = some.withColumn("_i", F.row_number().over(Window.partitionBy("column").orderBy(*order))).where(F.col("_i") <= bins).collect()
        for c in categorical:
            mine = sorted((r for r in first if r["column"] == c), key=lambda r: r["_i"])
            binned.append(ColumnBins(c, False, levels=tuple(r.level for r in mine)))
    counts = bin_counts(reference, binned, bins + 2)
    state = spark.createDataFrame([(b.column, b.numeric, list(b.edges), list(b.levels)) for b in binned], "column string, numeric boolean, edges array<double>, levels array<string>")
    none = F.array_repeat(F.lit(0).cast("long"), bins + 2)
    state.join(counts, "column", "left").withColumn("counts", F.coalesce("counts", none)).coalesce(1).write.mode("overwrite").parquet(path)


def load_profile(spark: SparkSession, path: str) -> tuple[list[ColumnBins], int]:
    """The bins of every column and the width of their counts; a bounded number of values per column."""
    rows = spark.read.schema(PROFILE).parquet(path).orderBy("column").collect()
    return [ColumnBins(r["column"], r.numeric, tuple(r.edges), tuple(r.levels)) for r in rows], len(rows[0].counts)


def compare_counts(counted: DataFrame, profile: DataFrame, alpha: float = DriftSpec.alpha, psi_limit: float = 0.2, min_rows: int = DriftSpec.min_current_rows) -> DataFrame:
    """Adds n, chi2, dof, p_value, psi, ks and drifted to (.., column, counts) by the profile's counts.

    Bins empty on both sides take no part; a bin empty on one side counts as half a row there. ks is the largest gap of the two
    distribution functions at the edges, null for levels. A column drifts if the change is both significant (p_value below alpha) and
    large (psi at the limit or above); below min_rows, or without reference rows, drifted is null. psi does not grow with the number
    of rows, so a long history is judged as a short one.
    """
    ref = profile.select("column", "numeric", F.col("counts").alias("_r"))
    j = counted.join(ref, "column")
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)
    pairs = lambda a, b: F.zip_with(a, b, lambda c, r: F.struct(c.alias("c"), r.alias("r")))
    j = j.withColumns({"n": total("counts"), "_n": total("_r"), "_k": F.filter(pairs("counts", "_r"), lambda x: (x["c"] > 0) | (x["r"] > 0))})
    half = lambda x: F.greatest(x.cast("double"), F.lit(0.5))
    expected = lambda x: half(x["r"]) * F.col("n") / F.col("_n")
    chi2 = F.aggregate("_k", F.lit(0.0), lambda a, x: a + F.pow(x["c"] - expected(x), 2) / expected(x))
    share = lambda x: (half(x["c"]) / F.col("n"), half(x["r"]) / F.col("_n"))
    psi = F.aggregate("_k", F.lit(0.0), lambda a, x: a + (share(x)[0] - share(x)[1]) * F.ln(share(x)[0] / share(x)[1]))
    width = F.size("counts")
    present = lambda c: F.slice(c, 1, width - 1)
    seen = j.withColumns({"_c1": total(present("counts")), "_r1": total(present("_r")), "_z": pairs(present("counts"), present("_r"))})
    walk = F.aggregate(
        "_z", F.struct(F.lit(0.0).alias("gap"), F.lit(0).cast("long").alias("c"), F.lit(0).cast("long").alias("r")),
        lambda a, x: F.struct(
            F.greatest(a["gap"], F.abs((a["c"] + x["c"]) / F.col("_c1") - (a["r"] + x["r"]) / F.col("_r1"))).alias("gap"),
            (a["c"] + x["c"]).alias("c"), (a["r"] + x["r"]).alias("r"),
        ),
    )
    known = (F.col("n") > 0) & (F.col("_n") > 0)
    out = seen.withColumns({
        "dof": F.size("_k") - 1, "chi2": F.when(known, chi2), "psi": F.when(known, psi),
        "ks": F.when(F.col("numeric") & (F.col("_c1") > 0) & (F.col("_r1") > 0), walk["gap"]),
    })
    out = out.withColumn("p_value", F.when(known, F.when(F.col("dof") > 0, p_chi2("chi2", F.col("dof").cast("double"))).otherwise(1.0)))
    out = out.withColumn("drifted", F.when(known & (F.col("n") >= min_rows), (F.col("p_value") < alpha) & (F.col("psi") >= psi_limit)))
    return out.drop("_r", "_n", "_k", "_c1", "_r1", "_z")


def stream_drift_history(
    current: DataFrame, profile: str, sink: str, checkpoint: str, ts: str | None = None, window: str | None = None, delay: str = "10 minutes",
    spec: DriftSpec = DriftSpec(), psi_limit: float = 0.2, available_now: bool = False,
) -> StreamingQuery:
    """Cumulative drift of every column, per event-time window or over the whole stream, renewed with every micro-batch.

    The state is one array of bin counts per open window and column: no row of the history is kept or read again, and the reference
    is only its stored profile. Windows end with the watermark, rows later than the delay are dropped. A batch writes the windows it
    touched to its own batch_id folder in place of what stood there, so a replayed batch leaves one answer.
    """
    spark = current.sparkSession
    binned, width = load_profile(spark, profile)
    binned = [b for b in binned if b.column in current.columns]
    if not binned:
        raise ValueError("profile and stream share no column")
    if window:
        if not ts:
            raise ValueError("windows need an event time")
        counted = bin_counts(current.withWatermark(ts, delay), binned, width, [F.window(ts, window).alias("window")])
    else:
        counted = bin_counts(current, binned, width)

    def judge(batch: DataFrame, batch_id: int) -> None:
        reference = batch.sparkSession.read.schema(PROFILE).parquet(profile)
        out = compare_counts(batch, reference, spec.alpha, psi_limit, spec.min_current_rows)
        span = [F.col("window.start").alias("start"), F.col("window.end").alias("end")] if window else [F.lit(None).cast("timestamp").alias(c) for c in ("start", "end")]
        out.select(*span, "column", "n", "chi2", "dof", "p_value", "psi", "ks", "drifted", "counts").write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    writer = counted.writeStream.outputMode("update").foreachBatch(judge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


HISTORY = (
    "start timestamp, end timestamp, column string, n long, chi2 double, dof int, p_value double, psi double, ks double, drifted boolean, "
    "counts array<long>, batch_id long"
)


def latest_history(spark: SparkSession, sink: str) -> DataFrame:
    """The last answer for every window and column; one without windows has null as start and end."""
    t = spark.read.schema(HISTORY).parquet(sink)
    rest = [c for c in t.columns if c not in ("start", "end", "column")]
    last = t.groupBy("start", "end", "column").agg(F.max_by(F.struct(*rest), "batch_id").alias("_l"))
    return last.select("start", "end", "column", "_l.*")


def history_verdicts(latest: DataFrame, spec: DriftSpec = DriftSpec()) -> DataFrame:
    """(start, end, verdict, tested, drift_share, drifted_features): one verdict per window; without a testable column, `insufficient`."""
    share = F.try_divide(F.count_if("drifted").cast("double"), F.count("drifted"))
    g = latest.groupBy("start", "end").agg(
        F.count("drifted").cast("int").alias("tested"), share.alias("drift_share"),
        F.array_sort(F.collect_list(F.when(F.col("drifted"), F.col("column")))).alias("drifted_features"),
    )
    verdict = F.when(F.col("tested") == 0, "insufficient").when(F.col("drift_share") > spec.drift_share_threshold, "drift").otherwise("stable")
    return g.select("start", "end", verdict.alias("verdict"), "tested", "drift_share", "drifted_features")


def merge_counts(parts: DataFrame, by: Sequence[str] = ("column",)) -> DataFrame:
    """Counts of several windows added bin by bin, so that a month is judged from its days without reading a row."""
    cells = parts.select(*by, F.posexplode("counts").alias("_i", "_k")).groupBy(*by, "_i").agg(F.sum("_k").alias("_k"))
    ordered = cells.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("_i", "_k"))).alias("_a"))
    return ordered.select(*by, F.transform("_a", lambda x: x["_k"]).alias("counts"))
