"""Transforms with statistics learned from training rows and applied to any rows.

Fitted state is a handful of numbers per column, held in a frozen dataclass and applied as literals, so
applying is one projection. `to_frame` and `from_frame` turn it into a table for storage.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.columns import finite
from plumbline.operators.quantiles import exact_quantiles
from plumbline.spec import PortfolioSpec

_NUMERIC = (T.NumericType, T.BooleanType)


def _as_double(df: DataFrame, c: str) -> Column:
    if isinstance(df.schema[c].dataType, T.BooleanType):
        return F.col(c).cast("int").cast("double")
    v = F.col(c).cast("double")
    return F.when(~F.isnan(v), v)


def check_numeric(df: DataFrame, spec: PortfolioSpec) -> list[str]:
    """The numeric feature names; a column that is neither numeric nor a declared category is refused."""
    opaque = {
        f.name: f.dataType.simpleString() for f in df.schema
        if f.name not in spec.categoricals and not isinstance(f.dataType, _NUMERIC)
    }
    if opaque:
        raise ValueError(f"only numeric or declared categorical columns can be engineered: {opaque}")
    return [c for c in df.columns if c not in spec.categoricals]


@dataclass(frozen=True)
class EngineerState:
    columns: tuple[str, ...]
    caps: dict[str, float]
    medians: dict[str, float]
    log_scale: tuple[str, ...]
    levels: dict[str, tuple[str, ...]] = field(default_factory=dict)

    @property
    def output(self) -> list[str]:
        return [*self.columns, *[f"{c}_{v}" for c, vs in self.levels.items() for v in vs]]

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(json.dumps(asdict(self)),)], "state string")

    @classmethod
    def from_frame(cls, df: DataFrame) -> EngineerState:
        d = json.loads(df.first()["state"])
        return cls(tuple(d["columns"]), d["caps"], d["medians"], tuple(d["log_scale"]), {k: tuple(v) for k, v in d["levels"].items()})


def fit_engineer(train: DataFrame, spec: PortfolioSpec, quantile: float | None = None) -> EngineerState:
    """Caps (a high quantile) of the heavy-tailed columns and medians of all numeric ones, on finite values.

    A column without a finite value gets no cap and a median of zero.
    """
    numeric = check_numeric(train, spec)
    q = spec.winsor_quantile if quantile is None else quantile
    got = exact_quantiles(train, {c: _as_double(train, c) for c in numeric}, [0.5, q])
    return EngineerState(
        columns=tuple(numeric),
        caps={c: got[c][1] for c in spec.heavy_tailed if c in got and got[c][1] is not None},
        medians={c: (0.0 if got[c][0] is None else got[c][0]) for c in numeric},
        log_scale=tuple(c for c in spec.log_scale if c in numeric),
        levels={c: tuple(v) for c, v in spec.categoricals.items() if c in train.columns},
    )


def apply_engineer(df: DataFrame, state: EngineerState, keep: Sequence[str] = ()) -> DataFrame:
    """Clip at the cap, infinities to unknown, impute the median, log1p, one-hot: always in this order.

    One-hot columns come from the declared vocabulary, so a batch without a level still has its column
    and an unknown or missing level is all zeros.
    """
    inf = float("inf")
    out = []
    for c in state.columns:
        v = F.col(c).cast("int").cast("double") if isinstance(df.schema[c].dataType, T.BooleanType) else F.col(c).cast("double")
        gap = F.lit(state.medians[c])
        # One flat condition per column keeps the generated code small enough to be compiled: NULL, NaN
        # and infinities the cap did not catch fall through to the median.
        if c in state.caps:
            cap = F.lit(state.caps[c])
            v = F.when((v <= cap) & (v > -inf), v).when((v > cap) & ~F.isnan(v), cap).otherwise(gap)
        else:
            v = F.when(F.abs(v) < inf, v).otherwise(gap)
        if c in state.log_scale:
            v = F.log1p(F.greatest(v, F.lit(0.0)))
        out.append(v.alias(c))
    for c, levels in state.levels.items():
        out += [F.when(F.col(c) == v, 1.0).otherwise(0.0).alias(f"{c}_{v}") for v in levels]
    return df.select(*keep, *out)


def impute_from_train(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], split: str, train_value: str, label: str = "missing"
) -> DataFrame:
    """Gaps take the median of the TRAIN rows (numeric) or a constant label (categorical)."""
    med = exact_quantiles(df.where(F.col(split) == train_value), list(numeric), [0.5])
    return df.withColumns({
        **{c: F.coalesce(F.col(c).cast("double"), F.lit(med[c][0]).cast("double")) for c in numeric},
        **{c: F.coalesce(F.col(c).cast("string"), F.lit(label)) for c in categorical},
    })


@dataclass(frozen=True)
class ScalerState:
    mean: dict[str, float]
    scale: dict[str, float]


def fit_scaler(train: DataFrame, cols: Sequence[str]) -> ScalerState:
    """Mean and population deviation; a constant column keeps scale 1."""
    row = train.agg(*[f(c).alias(f"{t}{i}") for i, c in enumerate(cols) for t, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    return ScalerState(
        {c: row[f"m{i}"] or 0.0 for i, c in enumerate(cols)},
        {c: (row[f"s{i}"] or 1.0) for i, c in enumerate(cols)},
    )


def apply_scaler(df: DataFrame, state: ScalerState) -> DataFrame:
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(state.scale[c]) for c, m in state.mean.items()})
