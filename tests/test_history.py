import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators.drift import DriftSpec
from plumbline.streaming import history

SCHEMA = "at timestamp, v double, k string, f boolean"
T0 = dt.datetime(2025, 3, 1)


def rows(n, days, seed, shift=0.0, levels="aabbc", every=0):
    rng = np.random.default_rng(seed)
    return [
        (T0 + dt.timedelta(days=int(rng.integers(*days)), minutes=i % 1000), None if every and i % every == 0 else float(rng.normal(shift)), levels[i % len(levels)], i % 3 == 0)
        for i in range(n)
    ]


def run(spark, src, profile, root, **how):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    history.stream_drift_history(stream, profile, f"{root}/out", f"{root}/state", available_now=True, **how).awaitTermination()
    return history.latest_history(spark, f"{root}/out")


def plain(values, b, width):
    out = [0] * width
    for v in values:
        if v is None:
            out[width - 1] += 1
        elif b.numeric:
            out[sum(float(v) > e for e in b.edges)] += 1
        else:
            out[b.levels.index(v) if v in b.levels else width - 2] += 1
    return out


def test_cumulative_counts_over_files_equal_those_of_all_rows(spark, frame, tmp_path):
    ref = rows(900, (0, 5), 1, every=9)
    cur = [rows(200, (0, 3), 10 + i, shift=0.2 * i, levels="abz", every=7) for i in range(4)]
    profile, src = f"{tmp_path}/p", f"{tmp_path}/in"
    history.store_profile(frame(ref, SCHEMA), profile, exclude=["at"])
    for part in cur:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(src)
    binned, width = history.load_profile(spark, profile)
    assert width == 12 and {b.column for b in binned} == {"v", "k", "f"}
    got = run(spark, src, profile, f"{tmp_path}/a").collect()
    every = [r for part in cur for r in part]
    at = {"v": 1, "k": 2, "f": 3}
    assert {r["column"] for r in got} == set(at) and all(r.start is None and r.n == 800 and r.batch_id == 3 for r in got)
    for r in got:
        b = next(x for x in binned if x.column == r["column"])
        c, e = plain([x[at[b.column]] for x in every], b, width), plain([x[at[b.column]] for x in ref], b, width)
        assert r.counts == c
        used = [(x, y) for x, y in zip(c, e) if x or y]
        want = sum((x - max(y, 0.5) * 800 / 900) ** 2 / (max(y, 0.5) * 800 / 900) for x, y in used)
        psi = sum((max(x, 0.5) / 800 - max(y, 0.5) / 900) * math.log((max(x, 0.5) / 800) / (max(y, 0.5) / 900)) for x, y in used)
        assert (r.chi2, r.psi, r.dof) == (pytest.approx(want), pytest.approx(psi), len(used) - 1)
        if b.numeric:
            cc, ce = np.cumsum(c[:-1]) / sum(c[:-1]), np.cumsum(e[:-1]) / sum(e[:-1])
            assert r.ks == pytest.approx(np.abs(cc - ce).max())
        else:
            assert r.ks is None
    assert {r["column"]: r.drifted for r in got}["k"] is True and {r["column"]: r.drifted for r in got}["f"] is False
    by_day = run(spark, src, profile, f"{tmp_path}/b", ts="at", window="1 day", delay="30 days")
    days = by_day.collect()
    assert len(days) == 9 and sum(r.n for r in days) == 3 * 800
    merged = {r["column"]: r.counts for r in history.merge_counts(by_day).collect()}
    assert merged == {r["column"]: r.counts for r in got}


def test_a_replayed_batch_leaves_one_answer(spark, frame, tmp_path):
    profile, src, root = f"{tmp_path}/p", f"{tmp_path}/in", f"{tmp_path}/a"
    history.store_profile(frame(rows(300, (0, 2), 1), SCHEMA), profile, exclude=["at"])
    spark.createDataFrame(rows(100, (0, 2), 2), SCHEMA).coalesce(1).write.parquet(src)
    first = sorted(map(str, run(spark, src, profile, root).collect()))
    (tmp_path / "a/state/commits/0").unlink()  # as if the driver was lost after the batch was written
    crc = tmp_path / "a/state/commits/.0.crc"
    if crc.exists():
        crc.unlink()
    assert sorted(map(str, run(spark, src, profile, root).collect())) == first
    spark.createDataFrame(rows(50, (0, 2), 3), SCHEMA).coalesce(1).write.mode("append").parquet(src)
    assert {r.n for r in run(spark, src, profile, root).collect()} == {150}


def test_verdicts_few_rows_and_empty_references(spark, frame, tmp_path):
    profile = f"{tmp_path}/p"
    history.store_profile(frame(rows(600, (0, 2), 1), SCHEMA), profile, exclude=["at"])
    binned, width = history.load_profile(spark, profile)
    stored = spark.read.schema(history.PROFILE).parquet(profile)

    def verdict(cur, spec=DriftSpec()):
        counted = history.bin_counts(frame(cur, SCHEMA), binned, width)
        latest = history.compare_counts(counted, stored, min_rows=spec.min_current_rows).select(F.lit(None).alias("start"), F.lit(None).alias("end"), "*")
        return history.history_verdicts(latest, spec).first()

    moved = verdict(rows(400, (0, 2), 2, shift=2.0))
    assert (moved.verdict, moved.drifted_features, moved.tested) == ("drift", ["v"], 3)
    assert verdict(rows(400, (0, 2), 3)).verdict == "stable"
    few = verdict(rows(20, (0, 2), 3))
    assert (few.verdict, few.tested, few.drift_share) == ("insufficient", 0, None)
    history.store_profile(spark.createDataFrame([], SCHEMA), f"{tmp_path}/q", exclude=["at"])
    empty, w = history.load_profile(spark, f"{tmp_path}/q")
    assert len(empty) == 3 and all(not b.edges and not b.levels for b in empty)
    none = history.compare_counts(history.bin_counts(frame(rows(40, (0, 2), 4), SCHEMA), empty, w), spark.read.schema(history.PROFILE).parquet(f"{tmp_path}/q"))
    assert all(r.drifted is None and r.psi is None for r in none.collect())
    with pytest.raises(ValueError):
        history.stream_drift_history(frame(rows(5, (0, 2), 1), SCHEMA).drop("v", "k", "f"), profile, "x", "y")


def test_many_levels_share_a_bin_and_ties_go_by_name(spark, frame, tmp_path):
    ref = [(f"l{i % 40:02d}",) for i in range(400)] + [("big",)] * 50 + [(None,)] * 5
    history.store_profile(frame(ref, "k string"), f"{tmp_path}/p", bins=4)
    (b,), width = history.load_profile(spark, f"{tmp_path}/p")
    assert b.levels == ("big", "l00", "l01", "l02") and width == 6
    assert spark.read.parquet(f"{tmp_path}/p").first().counts == [50, 10, 10, 10, 370, 5]
