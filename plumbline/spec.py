"""Declarative description of a portfolio table: column roles, bounds, vocabularies, views, transforms."""

from __future__ import annotations

from dataclasses import dataclass, field
from zoneinfo import ZoneInfo


@dataclass(frozen=True)
class PortfolioSpec:
    """Roles, rules and fitted-transform lists of one table. Inconsistent specs fail at construction."""

    entity_key: str
    event_timestamp: str
    target: str
    withheld: tuple[str, ...] = ()
    categoricals: dict[str, tuple[str, ...]] = field(default_factory=dict)  # column -> vocabulary
    integers: tuple[str, ...] = ()
    dropped: tuple[str, ...] = ()
    watched: tuple[str, ...] = ()  # a missing flag is derived for each
    missing_prefix: str = "missing_"
    scaled: tuple[str, ...] = ()
    scale_factor: int = 1
    heavy_tailed: tuple[str, ...] = ()
    log_scale: tuple[str, ...] = ()
    winsor_quantile: float = 0.99
    band_edges: tuple[float, ...] = ()
    band_labels: tuple[str, ...] = ()
    band_range: tuple[float, float] | None = None  # accepted values the bands must cover
    views: dict[str, tuple[str, ...]] = field(default_factory=dict)
    timezone: str = "UTC"

    def __post_init__(self):
        roles = [self.entity_key, self.event_timestamp, self.target, *self.withheld]
        repeated = sorted({r for r in roles if roles.count(r) > 1})
        if repeated:
            raise ValueError(f"columns claimed by two roles: {repeated}")
        if not 0.5 < self.winsor_quantile < 1:
            raise ValueError(f"winsor_quantile must be in (0.5, 1), got {self.winsor_quantile}")
        loose = sorted(set(self.log_scale) - set(self.heavy_tailed))
        if loose:
            raise ValueError(f"log_scale columns that are not heavy_tailed: {loose}")
        if self.band_labels and len(self.band_edges) != len(self.band_labels) + 1:
            raise ValueError("bands need one more edge than labels")
        if list(self.band_edges) != sorted(set(self.band_edges)):
            raise ValueError(f"band edges must ascend: {self.band_edges}")
        if self.band_range and not (self.band_edges[0] < self.band_range[0] and self.band_range[1] <= self.band_edges[-1]):
            raise ValueError(f"bands {self.band_edges} do not cover {self.band_range}")
        claimed: dict[str, str] = {}
        for view, cols in self.views.items():
            for c in cols:
                if c in self.reserved:
                    raise ValueError(f"view {view} claims the reserved column {c}")
                if c in claimed:
                    raise ValueError(f"column {c} is in views {claimed[c]} and {view}")
                claimed[c] = view
        ZoneInfo(self.timezone)

    @property
    def reserved(self) -> frozenset[str]:
        return frozenset({self.entity_key, self.event_timestamp, self.target, *self.withheld})

    @property
    def view_columns(self) -> list[str]:
        return [c for cols in self.views.values() for c in cols]

    def feature_names(self, columns) -> list[str]:
        return [c for c in columns if c not in self.reserved]


def features(df, spec: PortfolioSpec):
    """The only columns a model may be fitted or scored on."""
    return df.select(*spec.feature_names(df.columns))


def entity_frame(df, spec: PortfolioSpec):
    return df.select(spec.entity_key, spec.event_timestamp)


def view(df, name: str, spec: PortfolioSpec):
    """Entity key, event timestamp and the columns of one named view."""
    return df.select(spec.entity_key, spec.event_timestamp, *spec.views[name])


def uncovered_columns(df, spec: PortfolioSpec) -> list[str]:
    """Feature columns no view claims, and view columns the table lacks."""
    have = set(spec.feature_names(df.columns))
    return sorted(have ^ set(spec.view_columns))
