"""Queries over logs, drift, live checks, version health and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline import loan
from plumbline.operators import drift, health, scorecard, scoring
from plumbline.plans.book import book, raw_loans, table, with_book, with_loans
from plumbline.plans.evaluation import TOTAL_POINTS
from plumbline.plans.fitted import BOOK_SPEC, CUT, FEATURES, KEY, LOGISTIC, windows
from plumbline.plans.registry import query
from plumbline.session import ensure_checkpoint_dir
from plumbline.sources import log as plog
from plumbline.sources import readers

PAYLOAD = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("gap", T.DoubleType()),
])


@query("log_roundtrip", """
  SELECT event_type, count(*) AS n, round(sum(value), 2) AS value, 0 AS gaps, min(ts) AS first_at FROM events GROUP BY 1""", digits=2)
def log_roundtrip(spark, d):
    """Records to strict JSON and back: NaN and infinity become NULL, an all-NULL column keeps its type."""
    odd = F.when(F.col("event_id") % 2 == 0, F.lit(float("nan"))).otherwise(F.lit(float("inf")))
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", "value", odd.alias("gap"), "ts")
    logged = plog.to_log(e, F.col("ts"))
    back = plog.expand_log(logged, PAYLOAD)
    return back.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value"), F.count("gap").cast("int").alias("gaps"), F.min("scored_at").cast("timestamp_ntz").alias("first_at"))


@query("log_payload_fields", """
  SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS k FROM events GROUP BY 1""")
def log_payload_fields(spark, d):
    e = table(spark, d, "events").select(F.col("ts").alias("scored_at"), F.col("props").alias("payload"), "event_type")
    return e.select("event_type", F.from_json("payload", "k long").alias("p")).groupBy("event_type").agg(F.count("*").alias("n"), F.sum("p.k").alias("k"))


@query("scored_json_lines", """
  SELECT CAST(doc_id AS VARCHAR) AS row_id, round(CASE WHEN toxic = 1 THEN 0.75 ELSE 0.25 END, 6) + 0.0 AS score FROM labels""".replace("0.75 ELSE 0.25", "CAST(0.75 AS DOUBLE) ELSE CAST(0.25 AS DOUBLE)"))
def scored_json_lines(spark, d):
    """The positive class's score whatever the order the classes were written in."""
    p = F.when(F.col("toxic") == 1, F.lit(0.75)).otherwise(F.lit(0.25))
    even = F.col("doc_id") % 2 == 0
    lines = table(spark, d, "labels").select(F.to_json(F.struct(
        F.struct(F.col("doc_id").cast("string").alias("row_id")).alias("instance"),
        F.struct(F.when(even, F.array(F.lit("0"), F.lit("1"))).otherwise(F.array(F.lit("1"), F.lit("0"))).alias("classes"),
                 F.when(even, F.array(1 - p, p)).otherwise(F.array(p, 1 - p)).alias("scores")).alias("prediction"))).alias("line"))
    parsed = lines.select(F.from_json("line", readers.SCORED_SCHEMA.format(key="row_id")).alias("r")).select("r.*")
    return readers.positive_score(parsed, "row_id")


@query("csv_scan", "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1", digits=2)
def csv_scan(spark, d):
    """Orders written as ;-separated text with decimal commas and read back through the source registry."""
    from plumbline.functions.columns import parse_decimal_comma

    path = _scratch(spark, "csv")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.translate(F.format_string("%.2f", "o_totalprice"), ".", ",").alias("o_totalprice"))
    o.write.option("header", True).option("sep", ";").csv(path)
    back = readers.read_source(spark, {"type": "csv", "path": path, "schema": "o_orderkey long, o_orderstatus string, o_totalprice string"})
    return back.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum(parse_decimal_comma("o_totalprice")).alias("total"))


@query("feature_sink_pruning", "SELECT month, count(*) AS n FROM (SELECT strftime(o_orderdate, '%Y-%m') AS month FROM orders) WHERE month >= '2001-01' GROUP BY 1")
def feature_sink_pruning(spark, d):
    """The feature table partitioned by month: a time filter reads only its own directories."""
    path = _scratch(spark, "features")
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    readers.write_features(o, path, "month", mode="errorifexists")
    return spark.read.schema("o_orderkey long, o_totalprice double, month string").parquet(path).where("month >= '2001-01'").groupBy("month").agg(F.count("*").alias("n"))


@query("export_split", """
  SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'TEST' ELSE 'TRAIN' END AS split, count(*) AS loans, round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END), 6) AS default_rate FROM orders GROUP BY 1""")
def export_split(spark, d):
    o = table(spark, d, "orders").select("o_totalprice", (F.col("o_orderstatus") == "F").cast("int").alias("label"), F.when(F.col("o_orderkey") % 5 == 0, "TEST").otherwise("TRAIN").alias("split"))
    return readers.export_split(o, _scratch(spark, "split"), "split", "label")


def _scratch(spark, name: str) -> str:
    """A new folder below the cluster's shared checkpoint folder, or a private one where none is set."""
    import uuid

    from plumbline.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/plumbline-{name}-{uuid.uuid4().hex}"


def _periods(spark, d):
    o = table(spark, d, "orders").select("o_totalprice", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    ref = o.where("o_orderdate < timestamp_ntz'1999-01-01'").drop("o_orderdate")
    cur = o.where("o_orderdate >= timestamp_ntz'1999-01-01'").drop("o_orderdate").withColumn("o_totalprice", F.col("o_totalprice") * 1.2)
    return ref, cur.withColumn("o_orderpriority", F.when(F.col("o_orderpriority") == "5-LOW", "4-NOT SPECIFIED").otherwise(F.col("o_orderpriority")))


DRIFT_SRC = "(SELECT CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN {v} ELSE {w} END AS v, CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 1 ELSE 0 END AS y FROM orders)"
NUM_DRIFT = """SELECT '{c}' AS "column", CAST(sum(p) AS BIGINT) AS n_reference, CAST(sum(q) AS BIGINT) AS n_current, round(max(abs(f1 - f0)), 6) AS ks,
  round(sum(abs(f1 - f0) * coalesce(nx - s, 0)) / (SELECT stddev_samp(v) FROM {src} WHERE y = 1), 6) AS distance
  FROM (SELECT *, sum(p) OVER (ORDER BY s) / sum(p) OVER () AS f1, sum(q) OVER (ORDER BY s) / sum(q) OVER () AS f0, lead(s) OVER (ORDER BY s) AS nx
    FROM (SELECT v AS s, count(*) FILTER (WHERE y = 1) AS p, count(*) FILTER (WHERE y = 0) AS q FROM {src} GROUP BY 1))"""
PRICE_SRC, CUST_SRC = DRIFT_SRC.format(v="o_totalprice", w="o_totalprice * 1.2e0"), DRIFT_SRC.format(v="o_custkey", w="o_custkey")


@query("numeric_drift", NUM_DRIFT.format(c="o_totalprice", src=PRICE_SRC) + " UNION ALL " + NUM_DRIFT.format(c="o_custkey", src=CUST_SRC))
def numeric_drift(spark, d):
    ref, cur = _periods(spark, d)
    return drift.numeric_drift_stats(ref, cur, ["o_totalprice", "o_custkey"])


CAT_DRIFT = """SELECT '{c}' AS "column", CAST(max(tr) AS BIGINT) AS n_reference, CAST(max(tc) AS BIGINT) AS n_current, round(sum(power(c - e, 2) / e), 6) AS chi2, count(*) - 1 AS dof
  FROM (SELECT r, c, sum(r) OVER () AS tr, sum(c) OVER () AS tc, CASE WHEN r > 0 THEN r ELSE 0.5 END * sum(c) OVER () / sum(r) OVER () AS e
    FROM (SELECT v, count(*) FILTER (WHERE y = 1) AS r, count(*) FILTER (WHERE y = 0) AS c FROM {src} GROUP BY 1))"""
PRIO_SRC = DRIFT_SRC.format(v="o_orderpriority", w="CASE WHEN o_orderpriority = '5-LOW' THEN '4-NOT SPECIFIED' ELSE o_orderpriority END")
STATUS_SRC = DRIFT_SRC.format(v="o_orderstatus", w="o_orderstatus")


@query("categorical_drift", CAT_DRIFT.format(c="o_orderpriority", src=PRIO_SRC) + " UNION ALL " + CAT_DRIFT.format(c="o_orderstatus", src=STATUS_SRC))
def categorical_drift(spark, d):
    ref, cur = _periods(spark, d)
    return drift.categorical_drift_stats(ref, cur, ["o_orderpriority", "o_orderstatus"])


VERDICTS = """, r AS (SELECT "column", distance >= 0.05 AS drifted FROM nd UNION ALL SELECT "column", CASE dof WHEN 2 THEN exp(-chi2 / 2) WHEN 4 THEN exp(-chi2 / 2) * (1 + chi2 / 2) END < 0.05 FROM cd)"""
PERIOD_VERDICTS = f"""WITH nd AS ({NUM_DRIFT.format(c="o_totalprice", src=PRICE_SRC)} UNION ALL {NUM_DRIFT.format(c="o_custkey", src=CUST_SRC)}),
  cd AS ({CAT_DRIFT.format(c="o_orderpriority", src=PRIO_SRC)} UNION ALL {CAT_DRIFT.format(c="o_orderstatus", src=STATUS_SRC)})""" + VERDICTS


REPORT_SQL = PERIOD_VERDICTS + """, report AS (
  SELECT "column", 'wasserstein' AS method, distance AS value, CAST(0.05 AS DOUBLE) AS threshold, distance >= 0.05 AS drifted FROM nd
  UNION ALL SELECT "column", 'chisquare', CASE dof WHEN 2 THEN exp(-chi2 / 2) WHEN 4 THEN exp(-chi2 / 2) * (1 + chi2 / 2) END, 0.05, CASE dof WHEN 2 THEN exp(-chi2 / 2) WHEN 4 THEN exp(-chi2 / 2) * (1 + chi2 / 2) END < 0.05 FROM cd)"""


@query("drift_report", REPORT_SQL + ' SELECT "column", method, round(value, 5) AS value, threshold, drifted FROM report', digits=5)
def drift_report(spark, d):
    ref, cur = _periods(spark, d)
    return drift.drift_report(ref, cur)


@query("drift_summary", PERIOD_VERDICTS + """ SELECT count(*) AS tested, round(count(*) FILTER (WHERE drifted) / count(*), 6) AS drift_share, count(*) FILTER (WHERE drifted) / count(*) > 0.3 AS dataset_drift,
  list("column" ORDER BY "column") FILTER (WHERE drifted) AS drifted_features FROM r""")
def drift_summary(spark, d):
    ref, cur = _periods(spark, d)
    return drift.drift_summary(drift.drift_report(ref, cur))


@query("drift_magnitude", REPORT_SQL + """, m AS (SELECT *, CASE WHEN method = 'wasserstein' THEN value / threshold ELSE threshold / NULLIF(value, 0) END AS t FROM report)
  SELECT "column", method, drifted, round(least(coalesce(t, 1e9), 20), 3) AS magnitude, coalesce(t, 1e9) > 20 AS capped FROM m""", digits=3)
def drift_magnitude(spark, d):
    ref, cur = _periods(spark, d)
    return drift.drift_magnitude(drift.drift_report(ref, cur))


def _event_log(spark, d, half: str):
    e = table(spark, d, "events").withColumn("review_flag", F.col("value") > 60)
    return e.where(f"ts {half} timestamp_ntz'2024-01-16'").select("value", "event_type", "review_flag")


EVENT_SRC = "(SELECT {v} AS v, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 1 ELSE 0 END AS y FROM events)"


@query("live_check", f"""WITH nd AS ({NUM_DRIFT.format(c="value", src=EVENT_SRC.format(v="value"))}), cd AS ({CAT_DRIFT.format(c="event_type", src=EVENT_SRC.format(v="event_type"))})""" + VERDICTS + """
  SELECT 'dataset_drift' AS alert, count(*) FILTER (WHERE drifted) / count(*) > 0.3 AS fired, round(count(*) FILTER (WHERE drifted) / count(*), 6) AS value, CAST(0.3 AS DOUBLE) AS threshold,
    coalesce(string_agg("column", ', ' ORDER BY "column") FILTER (WHERE drifted), '') AS detail FROM r
  UNION ALL SELECT 'flagged_share', avg(CASE WHEN value > 60 THEN 1.0 ELSE 0.0 END) > 0.25, round(avg(CASE WHEN value > 60 THEN 1.0 ELSE 0.0 END), 6), CAST(0.25 AS DOUBLE), 'at fit 0.157' FROM events WHERE ts >= TIMESTAMP '2024-01-16'""")
def live_check(spark, d):
    return drift.live_check(_event_log(spark, d, "<"), _event_log(spark, d, ">="), flagged_share_at_fit=0.157)


@query("offline_monitor", digits=4)
def offline_monitor(spark, d):
    """Quality of a frozen score in the training and the held-out window, with the drift verdict."""
    b = book(spark, d).withColumn("p", F.least(F.col("price_to_total"), F.lit(1.0)))
    train, test = b.where(F.col("month") < CUT), b.where(F.col("month") >= CUT)
    _, summary, quality = drift.monitor(train, test, ["price", "quantity", "segment"], "p", "defaulted", 0.5)
    return quality.withColumn("drift_share", summary.select("drift_share").scalar())


@query("reference_table", with_book("""
  SELECT price_to_total >= 0.5 AS review_flag, count(*) AS n, round(avg(price_to_total), 6) AS probability_default, CAST(sum(defaulted) AS BIGINT) AS defaults FROM book WHERE month < '2000-01' GROUP BY 1"""))
def reference_table(spark, d):
    train = book(spark, d).where(F.col("month") < CUT)
    ref = drift.build_reference(train, ["price", "quantity"], "price_to_total", 0.5, "defaulted")
    return ref.groupBy("review_flag").agg(F.count("*").alias("n"), F.avg("probability_default").alias("probability_default"), F.sum("defaulted").alias("defaults"))


def _requests(spark, d):
    return table(spark, d, "events").select(F.when(F.col("user_id") % 2 == 0, "v2").otherwise("v1").alias("version"), (F.col("event_type") == "error").alias("error"), (F.col("value") * 10).alias("latency_ms"))


@query("version_stats", """
  SELECT CASE WHEN user_id % 2 = 0 THEN 'v2' ELSE 'v1' END AS version, count(*) AS requests, count(*) FILTER (WHERE event_type = 'error') AS errors,
    round(avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END), 6) AS error_rate, round(quantile_cont(value * 10, 0.95), 6) AS p95_ms FROM events GROUP BY 1""")
def version_stats(spark, d):
    return health.version_stats(_requests(spark, d), "version", "error", "latency_ms")


@query("version_health", """
  WITH s AS (SELECT user_id % 2 AS v, count(*) AS n, avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END) AS e, quantile_cont(value * 10, 0.95) AS p FROM events GROUP BY 1)
  SELECT 'v2' AS version, n AS requests, round(e, 6) AS error_rate, round(p, 6) AS p95_ms, false AS passed, ['error rate above the limit'] AS reasons FROM s WHERE v = 0""")
def version_health(spark, d):
    return health.compare_versions(health.version_stats(_requests(spark, d), "version", "error", "latency_ms"), "version", "v2", "v1")


@query("phase_costs", """
  WITH t AS (SELECT user_id AS job, CASE event_type WHEN 'view' THEN 'Starting' WHEN 'click' THEN 'Downloading' WHEN 'purchase' THEN 'Training' ELSE 'Uploading' END AS phase, value FROM events)
  SELECT job, round(coalesce(sum(value) FILTER (WHERE phase IN ('Starting', 'Downloading')), 0), 4) AS startup_s, round(coalesce(sum(value) FILTER (WHERE phase = 'Training'), 0), 4) AS billable_s,
    round(sum(value), 4) AS total_s, round(coalesce(sum(value) FILTER (WHERE phase = 'Training'), 0) / 3600 * 0.115, 4) AS cost FROM t GROUP BY 1""", digits=4)
def phase_costs(spark, d):
    phase = F.when(F.col("event_type") == "view", "Starting").when(F.col("event_type") == "click", "Downloading").when(F.col("event_type") == "purchase", "Training").otherwise("Uploading")
    t = table(spark, d, "events").select(F.col("user_id").alias("job"), phase.alias("phase"), F.lit(0.0).alias("start"), F.col("value").alias("end"))
    return health.phase_costs(t, "job", "phase", "start", "end", 0.115)


@query("batch_scoring", digits=4)
def batch_scoring(spark, d):
    """A fitted model scores the held-out rows with its frozen threshold; the what-if never changes the flag."""
    from plumbline.operators import evaluate, models

    train, test = windows(spark, d)
    model = models.fit_candidate(train, LOGISTIC, BOOK_SPEC, "defaulted", FEATURES)
    cut = evaluate.freeze_threshold(model.score(train, "p", KEY), "p", 0.157)
    out = scoring.score_batch(test.withColumn("application_id", F.concat_ws("-", *KEY)), lambda r: r, lambda r: model.score(r, "probability_default", ["application_id"]), cut, custom_threshold=0.4)
    return out.groupBy("review_flag").agg(F.count("*").alias("n"), F.avg("probability_default").alias("p"), F.count_if("review_flag_at_custom_threshold").alias("what_if"))


def _store(spark) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/plumbline-models-{uuid.uuid4().hex}"


@query("stored_model_scores", with_book("SELECT CAST(1 AS INT) AS version, count(*) AS n, 0.0::DOUBLE AS max_abs_difference, 0.25::DOUBLE AS threshold FROM book WHERE month >= '2000-01'"))
def stored_model_scores(spark, d):
    """A fitted model is saved with its frozen threshold, loaded by another session and scores the held-out rows as the fitted one does."""
    from plumbline.operators import models, store

    train, test = windows(spark, d)
    model = models.fit_candidate(train, models.Candidate("logistic", "logistic", {"C": 0.08686, "max_iter": 5}, scale=True), BOOK_SPEC, "defaulted", FEATURES)
    root = _store(spark)
    store.save(spark, root, "logistic", model, 0.25, {"cut": "2000-01"})
    got = store.load(spark.newSession(), root, "logistic")
    both = got.model.score(model.score(test, "fitted"), "loaded")
    return both.agg(F.lit(got.version).alias("version"), F.count("*").alias("n"), F.max(F.abs(F.col("fitted") - F.col("loaded"))).alias("max_abs_difference"), F.lit(got.threshold).alias("threshold"))


@query("stored_card_requests", with_loans(f"SELECT cliente_id AS application_id, CAST({TOTAL_POINTS} AS INT) AS points, {TOTAL_POINTS} >= 3 AS review_flag, CAST(3 AS DOUBLE) AS threshold, {TOTAL_POINTS} >= 6 AS review_flag_at_custom_threshold FROM loans"))
def stored_card_requests(spark, d):
    """Raw requests, without the outcome and the columns that serving defaults fill, through the stored card: cleaned, derived, checked, scored."""
    from plumbline.operators import store

    root = _store(spark)
    store.save(spark, root, "loans", loan.LOAN_CARD, 3)
    got = store.load(spark.newSession(), root, "loans", cards={"loans": loan.LOAN_CARD})
    requests = raw_loans(spark, d).withColumnRenamed("cliente_id", "application_id").drop("Pago_atiempo", "saldo_mora_codeudor", "total_otros_prestamos", "creditos_sectorReal")
    prepare = lambda r: loan.prepare_features(loan.serving_frame(r))
    return scoring.score_batch(requests, prepare, lambda r: scorecard.score_card(r, got.model), got.threshold, custom_threshold=6, name="points")


# --- streams over files, run to the end of the available input ---


def _event_stream(spark, d):
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    return raw.withColumn("at", F.col("ts").cast("timestamp"))


def _drain(stream, path: str, checkpoint: str, mode: str = "append") -> None:
    q = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()


@query("stream_window_stats", """
  SELECT date_trunc('day', ts) AS start, date_trunc('day', ts) + INTERVAL 1 DAY AS "end", count(*) AS n, round(avg(CASE WHEN value > 60 THEN 1.0 ELSE 0.0 END), 6) AS flagged_share,
    round(avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END), 6) AS error_share FROM events GROUP BY 1, 2
  HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""")
def stream_window_stats(spark, d):
    """Daily windows of a stream; a window is emitted once the watermark has passed its end."""
    from plumbline.streaming.scoring import stream_window_stats as stats

    path = _scratch(spark, "windows")
    _drain(stats(_event_stream(spark, d), "at", F.col("value") > 60, F.col("event_type") == "error", "1 day"), f"{path}/out", f"{path}/state")
    out = spark.read.schema("start timestamp, end timestamp, n long, flagged_share double, error_share double").parquet(f"{path}/out")
    return out.withColumns({"start": F.col("start").cast("timestamp_ntz"), "end": F.col("end").cast("timestamp_ntz")})


@query("stream_scoring", """
  SELECT value > 60 AS review_flag, count(*) AS n, round(sum(value), 2) AS value FROM events GROUP BY 1""", digits=2)
def stream_scoring(spark, d):
    """A stream of requests scored into the prediction log, then read back."""
    from plumbline.streaming.scoring import stream_score

    path = _scratch(spark, "scored")
    requests = _event_stream(spark, d).select("event_id", "value")
    stream_score(requests, lambda r: r.withColumn("review_flag", F.col("value") > 60), f"{path}/log", f"{path}/state", available_now=True).awaitTermination()
    back = plog.read_log(spark, f"{path}/log", "event_id long, value double, review_flag boolean")
    return back.groupBy("review_flag").agg(F.count("*").alias("n"), F.sum("value").alias("value"))


@query("stream_drift")
def stream_drift(spark, d):
    """A drift verdict per micro-batch of the event stream against its first half."""
    from plumbline.streaming.scoring import stream_drift as judge

    path = _scratch(spark, "drift")
    cur = _event_stream(spark, d).select("value", "event_type")
    judge(cur, _event_log(spark, d, "<").drop("review_flag"), f"{path}/verdicts", f"{path}/state", available_now=True).awaitTermination()
    return spark.read.parquet(f"{path}/verdicts").select("verdict", "tested", "drift_share", "dataset_drift")


EDGES = "(SELECT list_sort(list_distinct(quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]))) FROM events WHERE ts < TIMESTAMP '2024-01-16')"
HISTORY_SQL = f"""
  WITH cells AS (SELECT ts, 'value' AS "column", len(list_filter({EDGES}, lambda e: value > e)) AS bin FROM events UNION ALL SELECT ts, 'event_type', ascii(event_type) * 1000 + ascii(substr(event_type, 2)) FROM events),
    r AS (SELECT "column", bin, count(*) AS r FROM cells WHERE ts < TIMESTAMP '2024-01-16' GROUP BY 1, 2),
    w AS (SELECT date_trunc('day', ts) AS start, "column", bin, count(*) AS c FROM cells GROUP BY 1, 2, 3),
    grid AS (SELECT s.start, r."column", r.bin, r.r, coalesce(w.c, 0) AS c FROM (SELECT DISTINCT start FROM w) s CROSS JOIN r LEFT JOIN w ON w.start = s.start AND w."column" = r."column" AND w.bin = r.bin),
    t AS (SELECT *, sum(r) OVER p AS nr, sum(c) OVER p AS nc, abs(sum(c) OVER o / sum(c) OVER p - sum(r) OVER o / sum(r) OVER p) AS gap FROM grid
      WINDOW p AS (PARTITION BY start, "column"), o AS (PARTITION BY start, "column" ORDER BY bin))
  SELECT start, "column", CAST(max(nc) AS BIGINT) AS n, round(sum(power(c - r * nc / nr, 2) / (r * nc / nr)), 4) AS chi2, CAST(count(*) - 1 AS INT) AS dof,
    round(sum((greatest(c, 0.5) / nc - r / nr) * ln((greatest(c, 0.5) / nc) / (r / nr))), 4) AS psi, CASE WHEN "column" = 'value' THEN round(max(gap), 4) END AS ks
  FROM t GROUP BY 1, 2"""


@query("stream_drift_history", HISTORY_SQL, digits=4)
def stream_drift_history(spark, d):
    """The events as a stream of several files: cumulative counts per day and column against the profile of the first half, stored once."""
    from plumbline.streaming import history

    path = _scratch(spark, "history")
    events = table(spark, d, "events").select(F.col("ts").cast("timestamp").alias("at"), "event_id", "value", "event_type")
    history.store_profile(_event_log(spark, d, "<").drop("review_flag"), f"{path}/profile")
    events.repartition(4, F.pmod("event_id", F.lit(4))).write.parquet(f"{path}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    history.stream_drift_history(stream, f"{path}/profile", f"{path}/out", f"{path}/state", "at", "1 day", delay="60 days", available_now=True).awaitTermination()
    latest = history.latest_history(spark, f"{path}/out")
    return latest.select(F.col("start").cast("timestamp_ntz").alias("start"), "column", "n", "chi2", "dof", "psi", "ks")
