"""Batch scoring with a frozen threshold."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def score_batch(
    requests: DataFrame, prepare: Callable[[DataFrame], DataFrame], score: Callable[[DataFrame], DataFrame], threshold: float,
    key: str = "application_id", custom_threshold: float | None = None, features: Sequence[str] = (), name: str = "probability_default",
) -> DataFrame:
    """Probability and decision per request, the request id echoed.

    `prepare` turns raw requests into features (absent columns defaulted), `score` adds `name`. The
    frozen threshold decides review_flag; a custom threshold only adds a what-if column.
    """
    what_if = F.lit(None).cast("boolean") if custom_threshold is None else F.col(name) >= F.lit(custom_threshold)
    scored = score(prepare(requests))
    lacking = [c for c in features if c not in scored.columns]
    if lacking:
        raise ValueError(f"the feature view lacks {lacking}")
    return scored.select(
        key, *features, name, (F.col(name) >= F.lit(threshold)).alias("review_flag"), F.lit(threshold).alias("threshold"),
        what_if.alias("review_flag_at_custom_threshold"),
    )
