import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import drift, health, scoring
from plumbline.sources import log as plog
from plumbline.sources import readers
from plumbline.streaming.scoring import stream_drift, stream_score, stream_window_stats

COLS = "income double, load double, region string, tier string"


def frames(frame, n_ref=450, n_cur=380):
    """A reference and a current table: income and region keep their law, load moves by one and a half of its spread, tier changes its mix."""
    rng = np.random.default_rng(41)
    ref = [(float(a), float(b), "nesw"[i % 4], "xyz"[i % 3]) for i, (a, b) in enumerate(zip(rng.gamma(4, 2, n_ref), rng.uniform(0, 12, n_ref)))]
    cur = [(float(a), float(b), "nesw"[i % 4], "xxxxy"[i % 5]) for i, (a, b) in enumerate(zip(rng.gamma(4, 2, n_cur), rng.uniform(5, 17, n_cur)))]
    return frame(ref, COLS), frame(cur, COLS)


@pytest.mark.parametrize("n_ref,method", [(450, "ks"), (1500, "wasserstein")])
def test_injected_shift_is_found(frame, n_ref, method):
    # the distance limit equals alpha by default, far below what sampling alone gives at this size
    spec = drift.DriftSpec(distance_threshold=0.2)
    ref, cur = frames(frame, n_ref)
    report = {r.column: r for r in drift.drift_report(ref, cur, spec).collect()}
    assert {c: r.method for c, r in report.items() if c in ("income", "load")} == {"income": method, "load": method}
    s = drift.drift_summary(drift.drift_report(ref, cur, spec), spec).first()
    assert (s.tested, s.drift_share, s.dataset_drift, s.drifted_features) == (4, 0.5, True, ["load", "tier"])
    top = drift.drift_magnitude(drift.drift_report(ref, cur, spec)).first()
    assert top.magnitude == 20.0 and top.capped


def test_empty_columns_do_not_dilute_the_share(frame):
    ref, cur = frames(frame)
    ref, cur = ref.select("income", "load"), cur.select((F.col("load")).alias("income"), "load")
    for i in range(4):
        ref = ref.withColumn(f"gone{i}", F.lit(1.0))
        cur = cur.withColumn(f"gone{i}", F.lit(None).cast("string"))
    s = drift.drift_summary(drift.drift_report(ref.withColumn("only_ref", F.lit(1)), cur)).first()
    assert (s.tested, s.drift_share) == (2, 1.0)
    with pytest.raises(ValueError, match="no column"):
        drift.drift_report(ref.select("gone0"), cur.select("income"))


def test_identical_tables_do_not_drift(spark, frame, tmp_path):
    ref, cur = frames(frame)
    readers.write_report(drift.drift_report(ref, cur), str(tmp_path / "report"))
    stored = spark.read.schema("column string, drifted boolean").json(str(tmp_path / "report"))
    assert {r.column for r in stored.where("drifted").collect()} >= {"load", "tier"}
    assert drift.drift_report(ref, ref).where("drifted").count() == 0


def test_live_check_needs_rows_and_raises_alerts(frame):
    ref, cur = frames(frame)
    log = cur.withColumn("review_flag", F.col("income") > 7.3)
    few = drift.live_check(ref.withColumn("review_flag", F.lit(False)), log.limit(29)).collect()
    assert [(r.alert, r.value) for r in few] == [("insufficient_data", 29.0)]
    got = {r.alert: r for r in drift.live_check(ref.withColumn("review_flag", F.lit(False)), log, flagged_share_at_fit=0.157).collect()}
    assert got["dataset_drift"].fired and got["flagged_share"].fired and 0.4 < got["flagged_share"].value < 0.6


def test_log_is_strict_json_and_keeps_types(spark, frame, tmp_path):
    path = str(tmp_path / "log")
    schema = "id string, p double, gone double, ok boolean"
    assert plog.read_log(spark, path, schema).count() == 0
    plog.append_log(frame([("a", float("nan"), None, True), ("b", float("inf"), None, None), ("c", 0.5, None, False)], schema), path, F.lit(dt.datetime(2025, 1, 2)))
    plog.append_log(frame([("d", 0.1, None, True)], schema), path, F.lit(dt.datetime(2025, 1, 1)))
    raw = [json.loads(r.payload, parse_constant=lambda c: pytest.fail(c)) for r in spark.read.parquet(path).collect()]
    assert all(set(r) == {"id", "p", "gone", "ok"} for r in raw)
    back = plog.read_log(spark, path, schema)
    assert back.schema["gone"].dataType.simpleString() == "double"
    rows = back.collect()
    assert rows[0].id == "d" and {r.id: r.p for r in rows} == {"a": None, "b": None, "c": 0.5, "d": 0.1}


def test_scored_lines_in_both_class_orders(spark, tmp_path):
    for name, lines in (("old", []), ("run-1", [{"instance": {"row_id": "2"}, "prediction": {"classes": ["0", "1"], "scores": [0.7, 0.3]}},
                                                {"instance": {"row_id": "0"}, "prediction": {"classes": ["1", "0"], "scores": [0.9, 0.1]}}])):
        (tmp_path / name).mkdir()
        (tmp_path / name / "prediction.results-0").write_text("\n".join(json.dumps(x) for x in lines))
    newest = readers.newest_directory(spark, str(tmp_path / "run-*"))
    got = {r.row_id: r.score for r in readers.read_scored_jsonl(spark, f"{newest}/prediction.results-*", "row_id").collect()}
    assert got == {"2": 0.3, "0": 0.9}


@pytest.mark.parametrize("candidate,passed,reason", [
    ((100, 0, 100.0), True, None), ((10, 0, 100.0), False, "too few requests"), ((100, 3, 100.0), False, "error rate above the limit"), ((100, 2, 100.0), True, None),
    ((100, 0, 7000.0), False, "p95 above the cap"), ((100, 0, 250.0), False, "p95 too far above the previous version"), ((100, 0, None), False, "no latency data"),
])
def test_version_rules(frame, candidate, passed, reason):
    n, errors, ms = candidate
    rows = [("new", i < errors, ms) for i in range(n)] + [("old", False, 120.0)] * 30
    out = health.compare_versions(health.version_stats(frame(rows, "v string, e boolean, ms double"), "v", "e", "ms"), "v", "new", "old").first()
    assert out.passed is passed and (reason is None or reason in out.reasons)
    alone = health.compare_versions(health.version_stats(frame(rows, "v string, e boolean, ms double"), "v", "e", "ms"), "v", "new", None).first()
    assert alone.passed is (passed or reason == "p95 too far above the previous version")


def test_phase_costs(frame):
    rows = [("j", "Starting", 0.0, 40.0), ("j", "Downloading", 40.0, 70.0), ("j", "Training", 70.0, 250.0)]
    r = health.phase_costs(frame(rows, "job string, phase string, s double, e double"), "job", "phase", "s", "e", 0.2, instances=2).first()
    assert (r.startup_s, r.billable_s, r.total_s) == (70.0, 180.0, 250.0) and r.cost == pytest.approx(180 / 3600 * 0.2 * 2)


def test_custom_threshold_never_moves_the_frozen_flag(frame):
    req = frame([("a", 0.2), ("b", 0.6)], "application_id string, x double")
    run = lambda c: {r.application_id: (r.review_flag, r.review_flag_at_custom_threshold) for r in scoring.score_batch(
        req, lambda d: d, lambda d: d.withColumn("probability_default", F.col("x")), 0.5, custom_threshold=c).collect()}
    assert run(None) == {"a": (False, None), "b": (True, None)} and run(0.1) == {"a": (False, True), "b": (True, True)}


def test_streams_run_to_the_end(spark, frame, tmp_path):
    t0 = dt.datetime(2025, 1, 1)
    rows = [(t0 + dt.timedelta(minutes=10 * i), float(i % 10), i % 5 == 0) for i in range(120)]
    src = str(tmp_path / "in")
    frame(rows, "at timestamp, v double, bad boolean").write.parquet(src)
    stream = spark.readStream.schema("at timestamp, v double, bad boolean").parquet(src)
    stats = stream_window_stats(stream, "at", F.col("v") >= 5, "bad", "1 hour", delay="0 seconds")
    q = stats.writeStream.format("memory").queryName("w").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    got = spark.table("w").collect()
    assert len(got) == 19 and all(r.n == 6 for r in got)
    stream_score(stream, lambda d: d.withColumn("review_flag", F.col("v") > 8), str(tmp_path / "log"), str(tmp_path / "c1"), True).awaitTermination()
    assert plog.read_log(spark, str(tmp_path / "log"), "v double, review_flag boolean").where("review_flag").count() == 12
    ref = frame([(float(i % 10) + 50,) for i in range(200)], "v double")
    stream_drift(stream.select("v"), ref, str(tmp_path / "d"), str(tmp_path / "c2"), available_now=True).awaitTermination()
    assert [r.verdict for r in spark.read.parquet(str(tmp_path / "d")).collect()] == ["drift"]
    little = drift.DriftSpec(min_current_rows=1000)
    stream_drift(stream.select("v"), ref, str(tmp_path / "e"), str(tmp_path / "c3"), little, True).awaitTermination()
    assert [r.verdict for r in spark.read.parquet(str(tmp_path / "e")).collect()] == ["insufficient"]
