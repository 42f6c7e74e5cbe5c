"""Spearman rank correlation of all pairs of columns at once, each pair on the rows where both are known."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.columns import finite
from plumbline.operators.ranking import buckets_for
from plumbline.session import written_at
from plumbline.sources import paths

FEW_VALUES = 10_000  # ranks of so many values are joined without a copy of the rows


def _partial_ranks(cells: DataFrame, classes: int) -> DataFrame:
    """(column, value, ranks): the centred share rank of every distinct value among its column's rows of each class.

    Class 0 is every row of the column, class i the rows whose i-th gapped column is known. Counts of the values stand in value
    buckets; running totals are taken inside a bucket and the totals of the lower buckets added, so no window holds a whole column.
    """
    kinds = range(classes)
    counts = cells.groupBy("column", "value").agg(*[F.sum(F.when(F.get("known", F.lit(k)), F.col("w")).otherwise(0)).alias(f"n{k}") for k in kinds])
    bucketed = counts.withColumn("_b", buckets_for(cells, "value").index("value"))
    totals = bucketed.groupBy("column", "_b").agg(*[F.sum(f"n{k}").alias(f"t{k}") for k in kinds])
    whole = Window.partitionBy("column")
    lower = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("column", "_b", *[c for k in kinds for c in (F.coalesce(F.sum(f"t{k}").over(lower), F.lit(0)).alias(f"o{k}"), F.sum(f"t{k}").over(whole).alias(f"s{k}"))])
    inside = Window.partitionBy("column", "_b").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    local = bucketed.select("column", "_b", "value", *[c for k in kinds for c in (F.col(f"n{k}"), F.sum(f"n{k}").over(inside).alias(f"c{k}"))])
    # the mean position of equal values less the middle position, as a share of the rows: between -1/2 and 1/2, of mean 0
    rank = lambda k: F.try_divide(F.col(f"o{k}") + F.col(f"c{k}") - (F.col(f"n{k}") + F.col(f"s{k}")) / F.lit(2.0), F.col(f"s{k}"))
    return local.join(offsets, ["column", "_b"]).select("column", "value", F.array(*[rank(k) for k in kinds]).alias("ranks"))


def spearman(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(a, b, rho, n) for every pair of columns with a complete row, on the rows where both are known; rho is null for a constant.

    Equal rows collapse to a multiplicity. Then the columns come one after the other: the ranks of a column's values are written, and
    rows take theirs by value in place of it, in one shuffle of the rows or in none where the values are few. A value's rank depends
    on which rows its partner has; its counts per gapped partner give all of those ranks at once. Only the last copy of the rows is
    kept, so the disk holds two copies of them and one shuffle whatever the number of columns. A value that many different rows share
    is split by the skew join of adaptive execution.
    """
    if len(cols) < 2:
        raise ValueError("a correlation needs two columns")
    spark = df.sparkSession
    values = [f"v{i}" for i in range(len(cols))]
    cells, source = written_at(df.select(*[(finite(c) + F.lit(0.0)).alias(v) for c, v in zip(cols, values)]), "cells")
    rows, kept = written_at(cells.groupBy(*values).agg(F.count("*").alias("w")), "spearman")
    paths.delete(spark, source)
    known = rows.agg(*[F.coalesce(F.sum(F.when(F.col(v).isNull(), F.col("w"))), F.lit(0)).alias(v) for v in values]).first()
    gapped = [i for i, v in enumerate(values) if known[v]]
    kind = {i: gapped.index(i) + 1 if i in gapped else 0 for i in range(len(cols))}
    have = list(values)  # what tells whether a row knows a column: its value, then its first rank
    for i, v in enumerate(values):
        flags = F.array(F.lit(True), *[F.col(have[j]).isNotNull() for j in gapped])
        mine = rows.select(F.lit(i).alias("column"), F.col(v).alias("value"), "w", flags.alias("known")).where("value is not null")
        names = [f"r{i}_{k}" for k in range(len(gapped) + 1)]
        ranks, at = written_at(_partial_ranks(mine, len(names)).select("value", *[F.get("ranks", F.lit(k)).alias(n) for k, n in enumerate(names)]), "ranks")
        rows = rows.join(ranks, F.col(v) == F.col("value"), "left").drop(v, "value")
        have[i] = names[0]
        if i + 1 < len(values) and ranks.count() > FEW_VALUES:
            rows, new = written_at(rows, "spearman")
            paths.delete(spark, kept)
            paths.delete(spark, at)
            kept = new
    pairs = list(combinations(range(len(cols)), 2))
    points = F.array(*[F.struct(F.lit(p).alias("pair"), F.col(f"r{i}_{kind[j]}").alias("x"), F.col(f"r{j}_{kind[i]}").alias("y")) for p, (i, j) in enumerate(pairs)])
    each = rows.select("w", F.explode(points).alias("_p")).select("w", "_p.*").where("x is not null and y is not null")
    w, x, y = F.col("w"), F.col("x"), F.col("y")
    g = each.groupBy("pair").agg(F.sum(w * x * y).alias("xy"), F.sum(w * x * x).alias("xx"), F.sum(w * y * y).alias("yy"), F.sum("w").alias("n"))
    names = F.array(*[F.struct(F.lit(cols[i]).alias("a"), F.lit(cols[j]).alias("b")) for i, j in pairs])
    label = F.get(names, F.col("pair"))
    return g.select(label["a"].alias("a"), label["b"].alias("b"), F.try_divide(F.col("xy"), F.sqrt(F.col("xx") * F.col("yy"))).alias("rho"), "n")
