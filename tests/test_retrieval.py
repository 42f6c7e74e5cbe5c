import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import asof, split
from plumbline.operators.quantiles import Buckets

T0 = dt.datetime(2025, 1, 1)


def day(n):
    return T0 + dt.timedelta(days=n)


@pytest.fixture
def feats(frame):
    return frame([("a", day(5), 1), ("a", day(10), 2), ("b", day(7), 3), ("a", day(10), 1)], "k string, ts timestamp, v int")


def ask(frame, feats, rows, **kw):
    out = asof.asof_join(frame(rows, "k string, at timestamp"), feats, "k", "at", "ts", ["v"], **kw)
    return {(r.k, r["at"]): r.v for r in out.collect()}


def test_inclusive_backward_and_future_blind(frame, feats):
    got = ask(frame, feats, [("a", day(5)), ("a", day(9)), ("a", day(10)), ("a", day(40)), ("b", day(6))])
    # the repeated moment resolves to the largest row; b at day 6 is known but too early
    assert got == {("a", day(5)): 1, ("a", day(9)): 1, ("a", day(10)): 2, ("a", day(40)): 2}


def test_early_unknown_empty_and_repeated(frame, feats):
    rows = [("b", day(6)), ("z", day(6)), ("z", day(6))]
    assert ask(frame, feats, rows) == {("z", day(6)): None}
    assert ask(frame, feats, rows, early="null") == {("b", day(6)): None, ("z", day(6)): None}
    empty = asof.asof_join(frame([], "k string, at timestamp"), feats, "k", "at", "ts", ["v"])
    assert empty.columns == ["k", "at", "v"] and empty.count() == 0
    with pytest.raises(ValueError):
        ask(frame, feats, rows, early="keep")


def test_ttl_hides_old_rows_but_keeps_the_ask(frame, feats):
    got = ask(frame, feats, [("a", day(11)), ("a", day(30))], ttl="3 days")
    assert got == {("a", day(11)): 2, ("a", day(30)): None}


@pytest.mark.parametrize("seed", range(2))
def test_brute_force_for_any_slices(frame, seed):
    rng = np.random.default_rng(seed)
    # one entity holds most rows
    key = lambda: "hot" if rng.random() < 0.6 else f"k{rng.integers(4)}"
    f = [(key(), day(int(d)), int(i)) for i, d in enumerate(rng.integers(0, 200, 80))]
    a = [(key(), day(int(d))) for d in rng.integers(0, 220, 100)]
    want = {}
    for k, at in set(a):
        mine = [(t, v) for kk, t, v in f if kk == k]
        past = [m for m in mine if m[0] <= at]
        if past:
            want[(k, at)] = max(past)[1]
        elif not mine:
            want[(k, at)] = None
    feats = frame(f, "k string, ts timestamp, v int")
    micros = lambda n: int(day(n).replace(tzinfo=dt.timezone.utc).timestamp() * 1e6)
    for slices in (Buckets(()), Buckets(tuple(micros(n) for n in range(10, 200, 15))), None):
        assert ask(frame, feats, a, slices=slices) == want


def test_leakage_probe_and_reconciliation(frame, feats):
    src = feats.dropDuplicates(["k", "ts"])
    got = {r.offset: (r.rows, r.with_features) for r in asof.leakage_probe(
        src.where("not (k = 'a' and v > 1) and ts < '2025-01-10'").select("k", "ts"), src.where("ts < '2025-01-10'"), "k", "ts", "ts", ["v"],
        {"before": "'-1' DAY", "at": "'0' DAY", "after": "'30' DAY"}).collect()}
    assert got == {"at": (2, 2), "after": (2, 2)}
    a = frame([(1, "x", None), (2, "y", 1.0)], "k int, s string, d double")
    b = frame([(1, "x", None), (2, "z", 1.0), (3, "q", 2.0)], "k int, s string, d double")
    assert {r.column: r.mismatches for r in asof.mismatched(a, b, "k", ["s", "d"]).collect()} == {"s": 1, "d": 0}


def test_predictions_side_by_side(frame):
    base = frame([(i,) for i in range(4)], "row int")
    scored = {"m": frame([(2, 0.3), (0, 0.9)], "row int, score double"), "n": frame([], "row int, score double")}
    wide = asof.collect_predictions(base, scored, "row")
    got = {r.row: (r.m, r.n) for r in wide.collect()}
    assert got == {0: (0.9, None), 1: (None, None), 2: (0.3, None), 3: (None, None)}
    assert [r.m for r in asof.fill_unscored(wide, ["m"]).orderBy("row").collect()] == [0.9, 0.0, 0.3, 0.0]


@pytest.fixture
def months(frame):
    return frame([(m * 10 + i, f"2025-{m + 1:02d}", int(i == 0)) for m in range(10) for i in range(10)], "id int, month string, y int")


def test_cutoff_and_split_labels(months):
    assert split.cutoff_value(months, "month", 0.6) == "2025-06" and split.cutoff_value(months, "month", 2.0) == "2025-10"
    train, test, cut = split.split_out_of_time(months, "month", 0.6)
    assert (cut, train.count(), test.count()) == ("2025-06", 50, 50)
    got = {r.split: (r.n, r.first, r.last) for r in split.assign_split(months, "month", 0.6, 0.2).groupBy("split").agg(
        F.count("*").alias("n"), F.min("month").alias("first"), F.max("month").alias("last")).collect()}
    assert got == {"TRAIN": (30, "2025-01", "2025-03"), "VALIDATE": (20, "2025-04", "2025-05"), "TEST": (50, "2025-06", "2025-10")}
    with pytest.raises(ValueError, match="empty"):
        split.split_out_of_time(months.where("month = '2025-01'"), "month", 0.6)


def test_unknown_split_value_fails(frame):
    dev, _ = split.split_frame(frame([("TRAIN",), ("WHAT",)], "split string"), "split", ["TRAIN"], "TEST")
    with pytest.raises(Exception, match="unknown split value"):
        dev.collect()


def test_time_folds_never_train_on_the_future(months):
    f = split.time_folds(months, "month", 3)
    assert f.where("role = 'validate' and month <> fold_month or role = 'train' and month >= fold_month").count() == 0
    assert {r.fold: r["count"] for r in f.where("role = 'validate'").groupBy("fold").count().collect()} == {0: 10, 1: 10, 2: 10}


def test_folds_are_fixed_by_the_key_and_balanced(months):
    one = split.stratified_folds(months, "y", ["id"], 5, 2, exact=True)
    per = one.groupBy("repeat", "fold", "y").count().collect()
    assert {(r.y, r["count"]) for r in per} == {(0, 18), (1, 2)} and len(per) == 20
    again = split.stratified_folds(months.repartition(7), "y", ["id"], 5, 2, exact=True)
    assert sorted(one.collect()) == sorted(again.collect())


def test_subsamples_are_nested_and_resampling_hits_the_ratio(spark):
    df = spark.range(20_000).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    s = split.learning_curve_samples(df, ["id"], [0.1, 0.5, 1.0], 2)
    n = {(r.frac, r.rep): r["count"] for r in s.groupBy("frac", "rep").count().collect()}
    assert n[(1.0, 0)] == 20_000 and (1.0, 1) not in n and abs(n[(0.1, 0)] - 2000) < 200
    small = s.where("frac = 0.1 and rep = 0").select("id")
    assert small.join(s.where("frac = 0.5 and rep = 0").select("id"), "id", "left_anti").count() == 0
    for method in ("over", "under"):
        c = {r.y: r["count"] for r in split.resample(df, "y", ["id"], method, 0.5).groupBy("y").count().collect()}
        assert c[1] / c[0] == pytest.approx(0.5, rel=0.05)
    with pytest.raises(ValueError):
        split.resample(df, "y", ["id"], "middle", 1.0)
