"""Points scorecards: a sum of banded rules, each a Column expression over one row."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Banded:
    """Points by numeric band. closed='right' puts an edge in the band below it, 'left' in the one above."""

    column: str
    edges: tuple
    points: tuple[int, ...]
    missing: int = 0
    closed: str = "right"

    def __post_init__(self):
        if len(self.points) != len(self.edges) + 1:
            raise ValueError(f"{self.column}: {len(self.edges)} edges need {len(self.edges) + 1} points")
        if list(self.edges) != sorted(self.edges):
            raise ValueError(f"{self.column}: edges must ascend: {self.edges}")

    @property
    def inputs(self) -> tuple[str, ...]:
        return (self.column,)

    def column_expr(self) -> Column:
        v = F.col(self.column)
        out = F.when(v.isNull(), self.missing)
        for edge, p in zip(self.edges, self.points):
            out = out.when(v <= F.lit(edge) if self.closed == "right" else v < F.lit(edge), p)
        return out.otherwise(self.points[-1])


@dataclass(frozen=True)
class Lookup:
    """Points by label; a label without points fails the job instead of scoring zero."""

    column: str
    points: dict[str, int]
    missing: int = 0

    @property
    def inputs(self) -> tuple[str, ...]:
        return (self.column,)

    def column_expr(self) -> Column:
        out = F.when(F.col(self.column).isNull(), self.missing)
        for label, p in self.points.items():
            out = out.when(F.col(self.column) == label, p)
        return out.otherwise(
            F.raise_error(F.concat(F.lit(f"{self.column}: no points for band "), F.col(self.column))).cast("int")
        )


@dataclass(frozen=True)
class Condition:
    """Points where a condition over several columns holds; unknown inputs score zero."""

    inputs: tuple[str, ...]
    condition: Callable[[], Column]
    points: int

    def column_expr(self) -> Column:
        return F.when(F.coalesce(self.condition(), F.lit(False)), self.points).otherwise(0)


@dataclass(frozen=True)
class Scorecard:
    rules: dict[str, Banded | Lookup | Condition]
    threshold: int
    bands: int = 10
    band_minimum: int = 200
    base_rate: float | None = None
    lift_multiplier: int = 4
    key: tuple[str, ...] = field(default=())

    @property
    def required(self) -> set[str]:
        return {c for r in self.rules.values() for c in r.inputs}


def _check(df: DataFrame, card: Scorecard) -> None:
    lacking = sorted(card.required - set(df.columns))
    if lacking:
        raise KeyError(f"columns the rules score are absent: {', '.join(lacking)}")


def score_card(df: DataFrame, card: Scorecard, name: str = "points") -> DataFrame:
    """Adds the total points (higher = riskier)."""
    _check(df, card)
    total = F.lit(0)
    for r in card.rules.values():
        total = total + r.column_expr()
    return df.withColumn(name, total)


def explain(df: DataFrame, card: Scorecard, prefix: str = "") -> DataFrame:
    """Adds one column of points per rule."""
    _check(df, card)
    return df.withColumns({f"{prefix}{n}": r.column_expr() for n, r in card.rules.items()})


def predict(df: DataFrame, card: Scorecard, threshold: int | None = None, name: str = "flag") -> DataFrame:
    cut = card.threshold if threshold is None else threshold
    return score_card(df, card, "_points").withColumn(name, F.col("_points") >= cut).drop("_points")


def derive_weights(df: DataFrame, band: str, y: str, multiplier: int = 4, by: Sequence[str] = ()) -> DataFrame:
    """Points a band earns from its rate: round((rate / base - 1) * multiplier), half to even."""
    from plumbline.operators.profile import lift

    out = lift(df, [*by, band], y)
    return out.select(
        *by, band, "n", "rate", F.bround((F.col("lift") - 1) * multiplier).cast("int").alias("points")
    )
