"""Queries that read the book many times join its tables once, and what they shuffle leaves the disk."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline import session
from plumbline.operators import association, models, rankcorr, resampling
from plumbline.plans import book, evaluation, fitted, statistics
from plumbline.session import SHUFFLE_CLEANUP, written
from tests.test_ranking import brute_auc


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A few hundred lines of orders in three years, with an order that has no customer and a line that has no order."""
    d, rng = tmp_path_factory.mktemp("tables"), np.random.default_rng(3)
    day = lambda i: datetime.datetime(1995 + i % 3, 1 + i % 12, 5)
    orders = [(i, i % 20, day(i), float(1000 + 37 * i), "1-URGENT" if i % 2 else "5-LOW", "F") for i in range(120)] + [(500, 999, day(1), 5.0, "5-LOW", "F")]
    customers = [(i, float(100 * i - 200), "BUILDING" if i % 3 else "MACHINERY") for i in range(20)]
    lines = [(int(k % 120), int(rng.integers(9)), int(rng.integers(5)), k, float(rng.integers(1, 50)), float(rng.integers(100, 900)), k % 10 / 100, 0.01, "RAN"[int(rng.integers(3))]) for k in range(400)]
    lines += [(500, 1, 1, 1, 3.0, 50.0, 0.0, 0.0, "R"), (700, 1, 1, 1, 3.0, 50.0, 0.0, 0.0, "R")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp, o_totalprice double, o_orderpriority string, o_orderstatus string").write.parquet(f"{d}/orders.parquet")
    spark.createDataFrame(customers, "c_custkey long, c_acctbal double, c_mktsegment string").write.parquet(f"{d}/customer.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string").write.parquet(f"{d}/lineitem.parquet")
    return str(d)


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getName() for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith("shuffle_")}


def test_a_stored_table_leaves_no_shuffle_behind(spark):
    before = _shuffle_files(spark)
    df = written(spark.range(1000).repartition(3).groupBy((F.col("id") % 7).alias("k")).count(), "t")
    assert not _shuffle_files(spark) - before
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"
    assert sorted((r.k, r["count"]) for r in df.collect()) == [(k, 143 if k < 6 else 142) for k in range(7)]


def _reads_no_table(df):
    plan = df._jdf.queryExecution().toString()
    assert "lineitem.parquet" not in plan and "orders.parquet" not in plan
    return df.collect()


def test_time_fold_scores_joins_its_tables_once(spark, tables):
    got = {r.fold: r for r in _reads_no_table(fitted.time_fold_scores(spark, tables))}
    assert set(got) == {-1, 0, 1} and all(0 < r.roc_auc < 1 for r in got.values())


def test_fold_model_is_that_of_a_fit_on_its_rows(spark, tables):
    b = book.book(spark, tables).select(*fitted.KEY, F.substring("month", 1, 4).alias("year"), "defaulted", *fitted.FEATURES)
    model = models.fit_candidate(b.where("year < '1997'"), fitted.LOGISTIC, fitted.BOOK_SPEC, "defaulted", fitted.FEATURES)
    held = [(r.score, r.defaulted) for r in model.score(b.where("year = '1997'"), "score", [*fitted.KEY, "defaulted"]).collect()]
    got = {r.fold: r.roc_auc for r in fitted.time_fold_scores(spark, tables).collect()}
    assert got[1] == pytest.approx(brute_auc(*map(np.array, zip(*held))))


def test_metrics_table_compares_on_the_replicates_it_has(spark, tables, monkeypatch):
    b = book.book(spark, tables).select(*evaluation.KEY, "defaulted", "price", "quantity", F.when(F.col("quantity") > 5, F.col("price")).alias("partial")).cache()
    want = {m: resampling.paired_bootstrap(b, m, "quantity", "defaulted", evaluation.KEY, ("pr_auc",), 20, 0, 0.2).first() for m in ("price", "partial")}
    real, asked = resampling.paired_bootstrap, []
    monkeypatch.setattr(resampling, "paired_bootstrap", lambda df, a, *rest: asked.append(a) or real(df, a, *rest))
    table = models.metrics_table(b, [{"id": "price"}, {"id": "quantity"}, {"id": "partial"}], "defaulted", evaluation.KEY, 0.2, 20, 0, "quantity")
    got = {r.id: r for r in table.collect()}
    assert asked == ["partial"]
    for m, w in want.items():
        assert (got[m].diff_lo, got[m].diff_hi) == pytest.approx((w.lo, w.hi), abs=1e-12)
    own = resampling.bootstrap_ci(b, "partial", "defaulted", evaluation.KEY, ("f1",), 20, 0, share=0.2).first()
    assert (got["partial"].f1_lo, got["partial"].f1_hi) == pytest.approx((own.lo, own.hi))
    b.unpersist()


def test_metrics_table_joins_its_tables_once(spark, tables):
    got = {r.id: r for r in _reads_no_table(evaluation.metrics_table(spark, tables))}
    assert got["external"].status == "pending" and got["price"].pr_auc_lo < got["price"].pr_auc_hi


def test_promotion_gate_joins_its_tables_once(spark, tables):
    got = {r.check: r for r in _reads_no_table(evaluation.promotion_gate(spark, tables))}
    assert got["decision"].passed and got["bootstrap_excludes_zero"].value > 0


def test_univariate_audit_joins_its_tables_once(spark, tables):
    got = {r.column: r for r in _reads_no_table(statistics.univariate_audit(spark, tables))}
    b = book.book(spark, tables).withColumn("year", F.substring("month", 1, 4))
    for r in association.univariate_auc(b, statistics.NUMERIC, "defaulted", "year").collect():
        mine = got[r.column]
        assert mine.point == pytest.approx(r.auc) and mine.lo < mine.point < mine.hi
        assert (mine.missing, mine.months, mine.months_same_sign, mine.direction) == (r.missing, r.months, r.months_same_sign, r.direction)


def test_hot_scores_are_summed_where_they_are_read(frame, spark):
    rng = np.random.default_rng(5)
    df = frame([(i, float(v), int(y)) for i, (v, y) in enumerate(zip(rng.integers(0, 5, 300), rng.integers(0, 2, 300)))], "id int, s double, y int")
    few = resampling.bootstrap_replicates(df, "s", "y", ["id"], 40, 1, share=0.3, hot_rows=10)
    plan = few._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInPandas" in plan and "_salt" not in plan
    want = {r.rep: r.asDict() for r in resampling.bootstrap_replicates(df, "s", "y", ["id"], 40, 1, share=0.3).collect()}
    got = {r.rep: r.asDict() for r in few.collect()}
    assert set(got) == set(want) == set(range(41))
    for k in want:
        assert got[k] == pytest.approx(want[k])


def test_counts_by_table_are_those_of_the_distribution():
    keys = np.random.default_rng(0).integers(-(2**63), 2**63 - 1, 5000)
    reps = np.arange(7)
    x = keys.view(np.uint64)[:, None] ^ (reps.astype(np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64((9 * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1)))[None, :]
    for shift, mult in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(mult)
    u = ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) / 2**53
    want = np.searchsorted(resampling._POISSON, u, side="right")
    want[:, 0] = 1
    assert (resampling.poisson_counts(keys, reps, 9) == want).all()
    close = np.flatnonzero(resampling._COUNTS == 255)
    assert 0 < len(close) < 18


def test_a_row_without_a_label_is_refused(frame):
    df = frame([(i, float(i), i % 2 if i else None) for i in range(40)], "id int, s double, y int")
    with pytest.raises(Exception, match="label in every row"):
        resampling.bootstrap_replicates(df, "s", "y", ["id"], 3, 0).collect()


@pytest.mark.parametrize("few", [2, 1000])
def test_rank_correlation_keeps_one_copy_of_its_rows(spark, frame, tmp_path, monkeypatch, few):
    rng = np.random.default_rng(8)
    a, b, c = rng.integers(0, 6, 200).astype(float), rng.normal(size=200), rng.integers(-2, 3, 200).astype(float)
    a[:30], c[20:60] = np.nan, np.nan
    b[60:] += a[60:]
    df = frame([tuple(None if np.isnan(x) else float(x) for x in r) for r in zip(a, b, c)], "a double, b double, c double")
    monkeypatch.setattr(rankcorr, "FEW_VALUES", few)
    monkeypatch.setattr(session, "ensure_checkpoint_dir", lambda spark: str(tmp_path))
    got = {(r.a, r.b): (r.rho, r.n) for r in rankcorr.spearman(df, ["a", "b", "c"]).collect()}
    left = [p.name.split("-")[1] for p in tmp_path.iterdir()]
    assert left.count("spearman") == 1 and "cells" not in left
    rank = lambda x: np.array([(x < v).sum() + ((x == v).sum() + 1) / 2 for v in x])
    for (i, x), (j, y) in (((n, u), (m, v)) for n, u in zip("abc", (a, b, c)) for m, v in zip("abc", (a, b, c)) if n < m):
        both = ~np.isnan(x) & ~np.isnan(y)
        assert got[i, j] == (pytest.approx(np.corrcoef(rank(x[both]), rank(y[both]))[0, 1]), both.sum())


def test_redundant_pairs_reads_its_pairs_once(spark, tables):
    for r in _reads_no_table(statistics.redundant_pairs(spark, tables)):
        assert abs(r.rho) >= 0.5 and {r.keep, r.drop} == {r.a, r.b}
    assert "spearman" not in statistics.redundant_pairs(spark, tables)._jdf.queryExecution().toString()
