"""Scoring, live statistics and drift over streams of requests and logged predictions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plumbline.functions.columns import as_column
from plumbline.operators.drift import DriftSpec, drift_report, drift_summary
from plumbline.sources.log import to_log


def stream_score(
    requests: DataFrame, score: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Scores a stream of requests into the prediction log. The file sink commits each batch once."""
    writer = to_log(score(requests)).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def stream_window_stats(
    log: DataFrame, ts: str, flag: str | Column, error: str | Column, window: str = "1 hour", slide: str | None = None,
    delay: str = "10 minutes", session_gap: str | None = None,
) -> DataFrame:
    """Volume, flagged share and error share per tumbling, sliding or session window, late rows bounded by the watermark.

    The state is one partial aggregate per open window, not the rows.
    """
    bounded = log.withWatermark(ts, delay)
    span = F.session_window(ts, session_gap) if session_gap else F.window(ts, window, slide)
    g = bounded.groupBy(span.alias("w")).agg(
        F.count("*").alias("n"), F.avg(as_column(flag).cast("int").cast("double")).alias("flagged_share"),
        F.avg(as_column(error).cast("int").cast("double")).alias("error_share"),
    )
    return g.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "flagged_share", "error_share")


def stream_drift(
    current: DataFrame, reference: DataFrame, sink: str, checkpoint: str, spec: DriftSpec = DriftSpec(), available_now: bool = False
) -> StreamingQuery:
    """A drift verdict per micro-batch against a fixed reference, written as one row per batch.

    A batch below the minimum of rows is recorded as insufficient instead of being judged. Each batch
    overwrites its own batch_id directory, so a replayed batch leaves one verdict.
    """

    def judge(batch: DataFrame, batch_id: int) -> None:
        rows = batch.limit(spec.min_current_rows).count()
        if rows < spec.min_current_rows:
            out = batch.sparkSession.createDataFrame([("insufficient", rows, None, None, None)], VERDICT)
        else:
            out = drift_summary(drift_report(reference, batch, spec), spec).select(
                F.when(F.col("dataset_drift"), "drift").otherwise("stable").alias("verdict"), F.col("tested").cast("int").alias("tested"),
                "drift_share", "dataset_drift", "drifted_features",
            )
        out.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    writer = current.writeStream.foreachBatch(judge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


VERDICT = "verdict string, tested int, drift_share double, dataset_drift boolean, drifted_features array<string>"
