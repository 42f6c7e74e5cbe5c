"""Column builders shared by the operators. Everything here stays inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite(c: str | Column) -> Column:
    """The value as a double, with NaN and infinities turned into NULL."""
    v = as_column(c).cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))), v)


def ratio(a: str | Column, b: str | Column) -> Column:
    """a / b in doubles; NULL when either side is unknown or the denominator is zero."""
    return F.try_divide(as_column(a).cast("double"), as_column(b).cast("double"))


def bucket_index(c: str | Column, edges: Sequence, side: str = "left") -> Column:
    """Position of a value among sorted edges, NULL for NULL.

    side='left' counts the edges strictly below the value (right-closed bands);
    side='right' counts the edges at or below it (left-closed bands). The comparison is a
    balanced tree of conditions, so a row costs log2(len(edges)) comparisons.
    """
    v = as_column(c)
    ordered = list(edges)

    def descend(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        goes_left = v <= F.lit(ordered[mid]) if side == "left" else v < F.lit(ordered[mid])
        return F.when(goes_left, descend(lo, mid)).otherwise(descend(mid + 1, hi))

    return F.when(v.isNotNull(), descend(0, len(ordered)))


def band(c: str | Column, edges: Sequence, labels: Sequence[str]) -> Column:
    """Right-closed bands (lo, hi]; values outside every band are NULL."""
    if len(edges) != len(labels) + 1:
        raise ValueError(f"{len(labels)} labels need {len(labels) + 1} edges, got {len(edges)}")
    if list(edges) != sorted(edges):
        raise ValueError(f"band edges must ascend: {list(edges)}")
    v = as_column(c)
    out = F.when(v <= F.lit(edges[0]), F.lit(None).cast("string"))
    for hi, label in zip(edges[1:], labels):
        out = out.when(v <= F.lit(hi), F.lit(label))
    return out


def vintage(c: str | Column) -> Column:
    """Month of a timestamp as yyyy-MM text, whose lexical order is time order."""
    return F.date_format(as_column(c), "yyyy-MM")


def parse_decimal_comma(c: str | Column) -> Column:
    return F.replace(as_column(c).cast("string"), F.lit(","), F.lit(".")).try_cast("double")


def parse_dayfirst(c: str | Column) -> Column:
    """Day-first text such as 7/01/2025 14:40, with or without the time of day."""
    text = F.trim(as_column(c).cast("string"))
    return F.coalesce(
        F.try_to_timestamp(text, F.lit("d/M/yyyy H:m")), F.try_to_timestamp(text, F.lit("d/M/yyyy"))
    )


def to_long(c: str | Column) -> Column:
    """Round half to even, then a nullable integer."""
    return F.bround(as_column(c).cast("double")).cast("long")


def canon_code(c: str | Column) -> Column:
    """4, 4.0 and '4' are one code; NULL becomes the empty text."""
    text = F.trim(as_column(c).cast("string"))
    return F.coalesce(F.regexp_replace(text, r"^(-?\d+)\.0+$", "$1"), F.lit(""))


def null_outside(c: str | Column, lo, hi) -> Column:
    v = as_column(c)
    return F.when(v.between(lo, hi), v)


def null_where(c: str | Column, condition: Column) -> Column:
    """NULL where the condition holds; an unknown condition keeps the value."""
    return F.when(~F.coalesce(condition, F.lit(False)), as_column(c))


def null_unless_in(c: str | Column, vocabulary: Sequence) -> Column:
    v = as_column(c)
    return F.when(v.isin(list(vocabulary)), v)


def ordered_rank(c: str | Column, vocabulary: Sequence[str]) -> Column:
    """Zero-based position in an ordered vocabulary, NULL outside it."""
    pos = F.array_position(F.array(*[F.lit(v) for v in vocabulary]), as_column(c))
    return F.when(pos > 0, (pos - 1).cast("int"))


def unit_hash(*cols: Column, seed: int = 0) -> Column:
    """A reproducible uniform number in [0, 1) for a row, fixed by its key and never by its partition."""
    h = F.xxhash64(*cols, F.lit(seed))
    return F.pmod(h, F.lit(1 << 53)).cast("double") / F.lit(float(1 << 53))


def wilson(successes: Column, n: Column, z: float = 1.96) -> tuple[Column, Column, Column]:
    """Rate with the bounds of its Wilson score interval."""
    total = n.cast("double")
    p = successes.cast("double") / total
    z2 = F.lit(z * z)
    centre = (p + z2 / (2 * total)) / (1 + z2 / total)
    margin = F.lit(z) / (1 + z2 / total) * F.sqrt(p * (1 - p) / total + z2 / (4 * total * total))
    return p, centre - margin, centre + margin
