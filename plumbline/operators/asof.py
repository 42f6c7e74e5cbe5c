"""Point-in-time retrieval: the newest feature row at or before each asked moment.

Asks and feature rows meet in one union that is grouped by entity and a slice of time. Inside a slice a
window carries the last feature row forward; what entered a slice from earlier ones comes from a table
with one row per entity and slice. An entity that owns a large part of all rows is thereby spread over
the time slices, and no pair of rows is ever formed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.operators.quantiles import Buckets, quantile_buckets
from plumbline.operators.ranking import null_safe_join


def latest_per_moment(feats: DataFrame, key: Sequence[str], ts: str, cols: Sequence[str]) -> DataFrame:
    """One feature row per (entity, moment): repeats of a moment resolve to the largest row."""
    return feats.groupBy(*key, ts).agg(F.max(F.struct(*cols)).alias("_f"))


def asof_join(
    asks: DataFrame,
    feats: DataFrame,
    key: str | Sequence[str],
    ask_ts: str,
    feat_ts: str,
    cols: Sequence[str],
    ttl: str | None = None,
    early: str = "drop",
    found_ts: str | None = None,
    slices: Buckets | None = None,
) -> DataFrame:
    """(key, ask_ts, cols) with the newest feature row whose moment is <= the asked one.

    Repeated (key, ask_ts) asks collapse. A known entity asked before its first row is dropped
    (early='drop') or kept with NULLs (early='null'); an unknown entity always gives a row of NULLs.
    `ttl` is an interval text such as '30 days'; older rows then count as unknown. `found_ts` names an
    output column for the moment of the row that was found.
    """
    key = [key] if isinstance(key, str) else list(key)
    if early not in ("drop", "null"):
        raise ValueError(f"early must be 'drop' or 'null', not {early!r}")
    if slices is None:
        moments = asks.select(F.col(ask_ts).cast("timestamp").alias("t")).unionAll(
            feats.select(F.col(feat_ts).cast("timestamp").alias("t"))
        )
        slices = quantile_buckets(moments, F.unix_micros("t"))
    slice_of = slices.index(F.unix_micros(F.col("_ts").cast("timestamp")))
    ask_type = asks.schema[ask_ts].dataType

    wanted = asks.select(*key, F.col(ask_ts).alias("_ts")).dropDuplicates()
    known = latest_per_moment(feats, key, feat_ts, cols).withColumnRenamed(feat_ts, "_ts")
    payload = F.struct(F.col("_ts").alias("ts"), F.col("_f").alias("f"))
    events = (
        wanted.select(*key, F.col("_ts").cast("timestamp").alias("_ts"), F.lit(True).alias("_ask"))
        .unionByName(
            known.select(*key, F.col("_ts").cast("timestamp").alias("_ts"), F.lit(False).alias("_ask"), payload.alias("_p")),
            allowMissingColumns=True,
        )
        .withColumn("_s", slice_of)
    )
    # What an entity carries into a slice: the last feature row of the slices before it.
    per_slice = events.where("not _ask").groupBy(*key, "_s").agg(F.max_by("_p", "_ts").alias("_last"))
    occupied = events.where("_ask").groupBy(*key, "_s").agg(F.lit(True).alias("_asked"))
    over = Window.partitionBy(*key).orderBy("_s")
    both = occupied.unionByName(per_slice, allowMissingColumns=True).groupBy(*key, "_s").agg(
        F.first("_asked", ignorenulls=True).alias("_asked"), F.first("_last", ignorenulls=True).alias("_last")
    )
    carried = both.select(
        *key, "_s", "_asked",
        F.last("_last", ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, -1)).alias("_in"),
        F.max(F.col("_last").isNotNull()).over(Window.partitionBy(*key)).alias("_known"),
    ).where("_asked")

    w = Window.partitionBy(*key, "_s").orderBy("_ts", "_ask").rowsBetween(Window.unboundedPreceding, 0)
    answered = events.withColumn("_local", F.last("_p", ignorenulls=True).over(w)).where("_ask")
    out = null_safe_join(answered.select(*key, "_s", "_ts", "_local"), carried, [*key, "_s"], "left")
    hit = F.coalesce("_local", "_in")
    if ttl:
        hit = F.when(hit["ts"] >= F.col("_ts") - F.expr(f"INTERVAL {ttl}"), hit)
    out = out.withColumn("_hit", hit)
    if early == "drop":
        # "known but nothing yet": no row exists at or before the ask, whatever the ttl.
        out = out.where(~(F.coalesce("_known", F.lit(False)) & F.coalesce("_local", "_in").isNull()))
    picked = [F.col("_hit")["f"][c].alias(c) for c in cols]
    if found_ts:
        picked.append(F.col("_hit")["ts"].cast(ask_type).alias(found_ts))
    return out.select(*key, F.col("_ts").cast(ask_type).alias(ask_ts), *picked)


def leakage_probe(
    asks: DataFrame, feats: DataFrame, key: str, ask_ts: str, feat_ts: str, cols: Sequence[str],
    offsets: dict[str, str], slices: Buckets | None = None,
) -> DataFrame:
    """Rows returned and rows with any value when every ask is shifted by each offset (label -> interval)."""
    shifts = F.explode(F.array(*[
        F.struct(F.lit(label).alias("offset"), (F.col(ask_ts) + F.expr(f"INTERVAL {gap}")).alias("at"))
        for label, gap in offsets.items()
    ]))
    # One as-of join answers every offset: the shifted moments are simply more asks.
    shifted = asks.select(key, shifts.alias("o")).select(key, F.col("o.offset").alias("offset"), F.col("o.at").alias(ask_ts))
    got = asof_join(shifted, feats, key, ask_ts, feat_ts, cols, slices=slices)
    any_value = F.lit(False)
    for c in cols:
        any_value = any_value | F.col(c).isNotNull()
    per_moment = got.select(key, ask_ts, any_value.alias("has"))
    distinct = shifted.dropDuplicates(["offset", key, ask_ts])
    return (
        null_safe_join(distinct, per_moment, [key, ask_ts])
        .groupBy("offset")
        .agg(F.count("*").alias("rows"), F.count_if("has").alias("with_features"))
    )


def mismatched(a: DataFrame, b: DataFrame, key: str | Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Per column, how many rows with the same key hold different values (NULL equals NULL)."""
    key = [key] if isinstance(key, str) else list(key)
    other = b.select(*key, *[F.col(c).alias(f"_b_{c}") for c in cols])
    both = null_safe_join(a.select(*key, *cols), other, key)
    wide = both.agg(*[F.count_if(~F.col(c).eqNullSafe(F.col(f"_b_{c}"))).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "column", "mismatches")


def attach_label(df: DataFrame, labels: DataFrame, key: str | Sequence[str], target: str, name: str = "defaulted") -> DataFrame:
    """Joins the outcome from outside the feature table and turns "paid" into "defaulted"."""
    key = [key] if isinstance(key, str) else list(key)
    return df.join(labels.select(*key, (~F.col(target)).alias(name)), key, "inner")


def collect_predictions(base: DataFrame, scored: dict[str, DataFrame], key: str, score: str = "score") -> DataFrame:
    """One score column per model next to every base row; a row a model did not score stays NULL.

    The score tables stack into one and pivot on the model name, so the base is shuffled once however
    many models are compared.
    """
    stacked = None
    for name, df in scored.items():
        part = df.select(key, F.lit(name).alias("_m"), F.col(score).cast("double").alias("_s"))
        stacked = part if stacked is None else stacked.unionByName(part)
    wide = stacked.groupBy(key).agg(*[F.max(F.when(F.col("_m") == m, F.col("_s"))).alias(m) for m in scored])
    return base.join(wide, key, "left")


def fill_unscored(df: DataFrame, scores: Sequence[str]) -> DataFrame:
    """An unscored row is never flagged: its score counts as 0."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in scores})
