"""Request health of service versions, and timing and cost of job phases, from logs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import as_column
from plumbline.operators.quantiles import grouped_quantiles
from plumbline.operators.ranking import merge_rows, null_safe_join


@dataclass(frozen=True)
class HealthSpec:
    # The published limits of a version comparison.
    min_requests: int = 20
    max_error_rate: float = 0.02
    max_p95_ms: float = 6000.0
    max_p95_ratio: float = 2.0


def version_stats(log: DataFrame, version: str, error: str | Column, latency: str, by: Sequence[str] = ()) -> DataFrame:
    """Requests, errors, error rate and exact p95 latency per version."""
    rows = log.select(*by, version, as_column(error).cast("int").alias("_e"), F.col(latency).cast("double").alias("_l"))
    counts = rows.groupBy(*by, version).agg(F.count("*").alias("requests"), F.sum("_e").alias("errors"), F.avg(F.col("_e").cast("double")).alias("error_rate"))
    return merge_rows([counts, grouped_quantiles(rows, [*by, version], "_l", {"p95_ms": 0.95})], [*by, version])


def compare_versions(stats: DataFrame, version: str, candidate: str, previous: str | None, spec: HealthSpec = HealthSpec(), by: Sequence[str] = ()) -> DataFrame:
    """(by, version, requests, error_rate, p95_ms, passed, reasons) for the candidate against its predecessor."""
    by = list(by)
    mine = stats.where(F.col(version) == candidate)
    if previous is not None:
        older = stats.where(F.col(version) == previous).select(*by, F.col("p95_ms").alias("_prev"))
        mine = null_safe_join(mine, older, by, "left") if by else mine.withColumn("_prev", older.select("_prev").scalar())
    else:
        mine = mine.withColumn("_prev", F.lit(None).cast("double"))
    p95, prev = F.col("p95_ms"), F.col("_prev")
    few = F.col("requests") < spec.min_requests
    reasons = F.array_compact(F.array(
        F.when(few, F.lit("too few requests")),
        F.when(~few & (F.col("error_rate") > spec.max_error_rate), F.lit("error rate above the limit")),
        F.when(p95.isNull(), F.lit("no latency data")),
        F.when(p95 > spec.max_p95_ms, F.lit("p95 above the cap")),
        F.when((prev > 0) & (p95 > prev * spec.max_p95_ratio), F.lit("p95 too far above the previous version")),
    ))
    return mine.select(*by, version, "requests", "error_rate", "p95_ms", (F.size(reasons) == 0).alias("passed"), reasons.alias("reasons"))


def phase_costs(
    transitions: DataFrame, job: str, phase: str, start: str, end: str, price_per_hour: float, startup: Sequence[str] = ("Starting", "Downloading"),
    billable: Sequence[str] = ("Training",), instances: int = 1,
) -> DataFrame:
    """Seconds before the work begins, billable seconds and cost per job, from its phase transitions.

    Start and end are epoch seconds or timestamps.
    """
    def epoch(c: str) -> Column:
        kind = transitions.schema[c].dataType.simpleString()
        return F.unix_micros(F.col(c).cast("timestamp")) / 1e6 if "timestamp" in kind else F.col(c).cast("double")

    seconds = epoch(end) - epoch(start)

    def total(names: Sequence[str]) -> Column:
        return F.coalesce(F.sum(F.when(F.col(phase).isin(list(names)), seconds)), F.lit(0.0))

    out = transitions.groupBy(job).agg(total(startup).alias("startup_s"), total(billable).alias("billable_s"), F.sum(seconds).alias("total_s"))
    return out.withColumn("cost", F.col("billable_s") / 3600 * price_per_hour * instances)
