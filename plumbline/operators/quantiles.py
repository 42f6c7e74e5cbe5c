"""Exact quantiles at any size.

The built-in exact percentile keeps every distinct value of a group in one aggregation buffer.
Here a sketch first brackets each wanted rank within its error bound; one more scan then counts
what lies outside the brackets and keeps only the distinct values inside them. The shuffle carries
a sliver of the column, and the answer equals linear interpolation between order statistics. Every
size takes this path. In small tables a bracket is one value, so the counted stretches also carry
their least and greatest value: the ranks next to a bracket.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.columns import as_column, bucket_index, finite

SKETCH_ACCURACY = 10_000
BRACKET_ROWS = 1_000_000  # a bracket expected to hold more rows is sketched again inside


def _bracket_probs(p: float, accuracy: int) -> tuple[float, float]:
    margin = 2.0 / accuracy
    return max(0.0, p - margin), min(1.0, p + margin)


def _narrowed(values: DataFrame, brackets: dict, ranks: dict, counts: dict, accuracy: int, bracket_rows: int) -> dict:
    """Brackets (column, probability) -> (lo, hi), sketched again inside until none is expected to hold more than bracket_rows rows.

    A round counts what lies below and inside the wide brackets, then sketches the wanted ranks among the values inside. A bracket
    that a round cannot narrow is held apart by its ends alone: nearly all its rows repeat one of a few values.
    """
    expected = {k: counts[k[0]] * 6.0 / accuracy for k in brackets}
    fixed = set()
    while wide := [k for k, (lo, hi) in brackets.items() if expected[k] > bracket_rows and lo < hi and k not in fixed]:
        v = {k: F.col(f"v{k[0]}") for k in wide}
        inside = {k: F.when(v[k].between(*brackets[k]), v[k]) for k in wide}
        tallies = [F.count(F.when(v[k] < brackets[k][0], 1)).alias(f"below{j}") for j, k in enumerate(wide)]
        tallies += [F.count(inside[k]).alias(f"inside{j}") for j, k in enumerate(wide)]
        tally = values.agg(*tallies).first()
        asked = []
        for j, k in enumerate(wide):
            n = max(1, tally[f"inside{j}"])
            low, high = ((r - tally[f"below{j}"] + e) / n for r, e in zip(ranks[k], (0, 1)))
            share = [_bracket_probs(min(1.0, max(0.0, low)), accuracy)[0], _bracket_probs(min(1.0, max(0.0, high)), accuracy)[1]]
            asked.append(F.percentile_approx(inside[k], share, accuracy).alias(f"q{j}"))
            expected[k] = n * 6.0 / accuracy
        found = values.agg(*asked).first()
        for j, k in enumerate(wide):
            new = tuple(found[f"q{j}"])
            if new == brackets[k]:
                fixed.add(k)
            brackets[k] = new
    return brackets


def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str] | dict[str, Column],
    probs: Sequence[float],
    accuracy: int = SKETCH_ACCURACY,
    bracket_rows: int = BRACKET_ROWS,
) -> dict[str, list[float | None]]:
    """Quantiles of each column over finite values, as fitted state: len(cols) * len(probs) numbers.

    A column without a finite value gives None for every probability. The window over what is kept of a column sees about
    bracket_rows rows for each probability, whatever the size of the table.
    """
    named = {c: F.col(c) for c in cols} if not isinstance(cols, dict) else cols
    names = list(named)
    values = df.select(*[finite(named[n]).alias(f"v{i}") for i, n in enumerate(names)])
    wanted = [b for p in probs for b in _bracket_probs(p, accuracy)]
    sketch = []
    for i in range(len(names)):
        v = F.col(f"v{i}")
        sketch += [
            F.count(v).alias(f"n{i}"),
            F.min(v).alias(f"lo{i}"),
            F.max(v).alias(f"hi{i}"),
            F.percentile_approx(v, wanted, accuracy).alias(f"q{i}"),
        ]
    first = values.agg(*sketch).first()

    counts = {i: first[f"n{i}"] for i in range(len(names)) if first[f"n{i}"]}
    if not counts:
        return {n: [None] * len(probs) for n in names}
    brackets, ranks = {}, {}
    for i, n in counts.items():
        for k, p in enumerate(probs):
            brackets[i, k] = tuple(first[f"q{i}"][2 * k : 2 * k + 2])
            ranks[i, k] = (math.floor((n - 1) * p), math.ceil((n - 1) * p))
    brackets = _narrowed(values, brackets, ranks, counts, accuracy, bracket_rows)
    keyed = []
    for i in counts:
        spans = _merge([brackets[i, k] for k in range(len(probs))])
        keyed.append(F.struct(F.lit(i).alias("c"), *_segment(F.col(f"v{i}"), spans), F.col(f"v{i}").alias("x")))

    counted = (
        values.select(F.explode(F.array(*keyed)).alias("k"))
        .where("k.seg is not null")
        .groupBy("k.c", "k.seg", "k.v")
        .agg(F.count("*").alias("n"), F.min("k.x").alias("least"), F.max("k.x").alias("most"))
    )
    w = Window.partitionBy("c").orderBy("seg", "v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumn("upto", F.sum("n").over(w))
    wanted = F.array(*[F.array(*[F.lit(r) for r in sorted({r for k in range(len(probs)) for r in ranks[i, k]})] if i in counts else [F.lit(-1)]) for i in range(len(names))])
    holds = F.exists(F.get(wanted, F.col("c")), lambda r: (r < F.col("upto")) & (r >= F.col("upto") - F.col("n")))
    found: dict[int, list] = {i: [] for i in counts}
    for row in ranked.where(holds).collect():  # at most two rows for each column and probability
        found[row["c"]].append(row)

    out: dict[str, list[float | None]] = {}
    for i, name in enumerate(names):
        n = first[f"n{i}"]
        if not n:
            out[name] = [None] * len(probs)
            continue
        qs = []
        for j, p in enumerate(probs):
            a, b = (_at_rank(found[i], r) for r in ranks[i, j])
            if a is None or b is None:
                raise ArithmeticError(f"quantile {p} of {name} left its sketch bracket; raise the accuracy")
            pos = (n - 1) * p
            qs.append(a + (b - a) * (pos - int(pos)))
        out[name] = qs
    return out


def _at_rank(rows: list, rank: int) -> float | None:
    """The value at a rank: the kept value of the row that holds it, or one end of a counted stretch."""
    for row in rows:
        if row["upto"] - row["n"] <= rank < row["upto"]:
            ends = {row["upto"] - 1: row["most"], row["upto"] - row["n"]: row["least"]}
            return row["v"] if row["v"] is not None else ends.get(rank)
    return None


def _merge(spans: list[tuple[float, float]]) -> list[tuple[float, float]]:
    merged: list[tuple[float, float]] = []
    for lo, hi in sorted(spans):
        if merged and lo <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(hi, merged[-1][1]))
        else:
            merged.append((lo, hi))
    return merged


def _segment(v: Column, spans: list[tuple[float, float]]) -> tuple[Column, Column]:
    """Even segments are the gaps between brackets (counted only); odd ones keep the value."""
    seg, kept = None, None
    for k, (lo, hi) in enumerate(spans):
        below, inside = v < F.lit(lo), v <= F.lit(hi)
        seg = F.when(below, 2 * k) if seg is None else seg.when(below, 2 * k)
        seg = seg.when(inside, 2 * k + 1)
        kept = F.when(below, F.lit(None).cast("double")) if kept is None else kept.when(below, F.lit(None).cast("double"))
        kept = kept.when(inside, v)
    seg = seg.when(v.isNotNull(), 2 * len(spans))
    return seg.alias("seg"), kept.alias("v")


def quantile_row(df: DataFrame, col: str, probs: Sequence[float]) -> list[float | None]:
    return exact_quantiles(df, [col], probs)[col]


def grouped_quantiles(
    df: DataFrame,
    by: Sequence[str],
    col: str,
    probs: dict[str, float],
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """One row per group with an exact quantile per entry of `probs` (output name -> probability).

    Lazy. The per-group brackets join back on the group key; values outside every bracket collapse
    into counts in the map-side aggregation, so a group holding most of the rows stays cheap. The
    window of a group sees the distinct values of its brackets, at most 6 / accuracy of its rows for
    each probability.
    """
    by = list(by)
    rows = df.select(*by, finite(col).alias("_v")).where("_v is not null")
    wanted = [b for p in probs.values() for b in _bracket_probs(p, accuracy)]
    brackets = rows.groupBy(*by).agg(
        F.count("*").alias("_n"),
        F.percentile_approx("_v", wanted, accuracy).alias("_q"),
    )
    inside = F.lit(False)
    cut = F.lit(0)
    for j in range(len(probs)):
        lo, hi = F.col("_q")[2 * j], F.col("_q")[2 * j + 1]
        inside = inside | F.col("_v").between(lo, hi)
        # Values between two brackets must keep their order, so the collapsed ones carry the number
        # of bracket starts at or below them.
        cut = cut + F.when(F.col("_v") >= lo, 1).otherwise(0)
    left, right = rows.alias("l"), brackets.alias("r")
    same = F.lit(True)
    for c in by:
        same = same & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    joined = left.join(right, same).select(*[F.col(f"l.{c}").alias(c) for c in by], "_v", "_n", "_q")
    counted = (
        joined.select(
            *by, "_n",
            cut.alias("_cut"),
            F.when(inside, F.col("_v")).alias("_kept"),
            "_v",
        )
        .groupBy(*by, "_n", "_cut", "_kept")
        .agg(F.count("*").alias("_k"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
    )
    # Within one cut level the kept values precede the collapsed ones: they sit inside the bracket
    # that opens the level, and the collapsed ones lie above its end.
    w = (
        Window.partitionBy(*by)
        .orderBy("_cut", F.col("_kept").asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    ranked = counted.withColumn("_upto", F.sum("_k").over(w))
    pos = {name: (F.col("_n") - 1) * F.lit(float(p)) for name, p in probs.items()}
    wanted = F.array(*[rank(x) for x in pos.values() for rank in (F.floor, F.ceil)])
    row = F.struct((F.col("_upto") - F.col("_k")).alias("first"), (F.col("_upto") - 1).alias("last"), "_kept", "_least", "_most")
    held = ranked.select(*by, "_n", row.alias("_row")).where(F.exists(wanted, lambda r: r.between(F.col("_row.first"), F.col("_row.last"))))
    # at most two rows of a group for each probability
    out = held.groupBy(*by).agg(F.max("_n").alias("_n"), F.collect_list("_row").alias("_rows"))

    def at(rank: Column) -> Column:
        held = F.get(F.filter("_rows", lambda x: rank.between(x["first"], x["last"])), 0)
        ends = F.when(rank == held["first"], held["_least"]).when(rank == held["last"], held["_most"])
        return F.coalesce(held["_kept"], ends, F.raise_error(F.lit("quantile left its bracket")).cast("double"))

    final = []
    for name, x in pos.items():
        ends = F.array(at(F.floor(x)), at(F.ceil(x)))
        final.append(F.element_at(F.transform(F.array(ends), lambda e: e[0] + (e[1] - e[0]) * (x - F.floor(x))), 1).alias(name))
    return out.select(*by, *final)


ROWS_PER_BUCKET = 500_000
TREE_EDGES = 256
MAX_EDGES = 4096


@dataclass(frozen=True)
class Buckets:
    """A monotone cut of a value range into buckets of similar row counts; it balances work only.

    Up to TREE_EDGES equal-frequency edges are compared in a balanced tree. More edges are read in two
    steps, a tree over every 64th edge and then the 64 edges of that stretch. Where even MAX_EDGES
    buckets are too few, each interval is cut further into `subs` equal widths. Results never depend on
    where the edges fall.
    """

    edges: tuple
    lo: float | None = None
    hi: float | None = None
    subs: int = 1

    def index(self, c: str | Column) -> Column:
        v = as_column(c)
        if len(self.edges) < TREE_EDGES:
            i = bucket_index(v, self.edges)
        else:
            coarse = bucket_index(v, self.edges[63::64])
            stretches = F.array(*[F.array(*[F.lit(e) for e in self.edges[k : k + 64]]) for k in range(0, len(self.edges), 64)])
            inside = F.get(stretches, coarse)
            i = coarse * 64 + F.coalesce(F.size(F.filter(inside, lambda e: e < v)), F.lit(0))
            i = F.when(v.isNotNull(), i)
        if self.subs == 1 or self.lo is None:
            return i
        table = F.array(*[F.lit(float(x)) for x in (self.lo, *self.edges, self.hi)])
        start, end = F.get(table, i), F.get(table, i + 1)
        part = F.floor(F.coalesce(F.try_divide(v.cast("double") - start, end - start), F.lit(0.0)) * self.subs)
        return i * self.subs + F.greatest(F.lit(0), F.least(part.cast("int"), F.lit(self.subs - 1)))


def quantile_buckets(
    df: DataFrame, value: str | Column, rows_per_bucket: int = ROWS_PER_BUCKET, at_least: int = 16, max_edges: int = MAX_EDGES
) -> Buckets:
    """Buckets for a value column, as many as its row count asks for.

    One sketch of the column gives the count and a first set of edges; a table that needs more than
    TREE_EDGES buckets is sketched once more in finer steps.
    """
    row = _sketch(df, value, TREE_EDGES)
    if not row["n"]:
        return Buckets(())
    needed = max(at_least, -(-row["n"] // rows_per_bucket))
    parts = TREE_EDGES
    if needed > TREE_EDGES:
        row, parts = _sketch(df, value, max_edges), max_edges
    count = 1 << max(0, (min(needed, parts) - 1).bit_length())
    step = max(1, parts // count)
    edges = sorted({row["q"][i - 1] for i in range(step, parts, step)})
    return Buckets(tuple(edges), row["lo"], row["hi"], max(1, -(-needed // parts)))


def _sketch(df: DataFrame, value: str | Column, parts: int):
    v = df.select(as_column(value).alias("v"))
    probs = ", ".join(f"{i / parts!r}D" for i in range(1, parts))
    return v.selectExpr(
        "count(v) AS n", "min(v) AS lo", "max(v) AS hi", f"percentile_approx(v, array({probs}), {4 * parts}) AS q"
    ).first()
