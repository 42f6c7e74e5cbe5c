"""Queries over point-in-time retrieval, label joins and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline import loan
from plumbline.functions.columns import vintage
from plumbline.operators import asof, split
from plumbline.plans.book import BOOK_KEY, book, raw_loans, table, with_book, with_loans
from plumbline.plans.registry import query


def _clicks(spark, d):
    e = table(spark, d, "events").where("event_type = 'click'")
    return e.select("user_id", "ts", "event_id", "value")


def _asks(spark, d):
    return table(spark, d, "events").where("event_type <> 'click'").select("user_id", "ts")


@query("asof_last_click", """
  WITH f AS (SELECT user_id, ts, max((event_id, value)) AS v FROM events WHERE event_type = 'click' GROUP BY ALL),
    a AS (SELECT DISTINCT user_id, ts FROM events WHERE event_type <> 'click')
  SELECT a.user_id, a.ts, f.v[1] AS event_id, f.v[2] AS value, f.ts AS clicked_at
  FROM a ASOF LEFT JOIN f ON a.user_id = f.user_id AND a.ts >= f.ts
  WHERE f.ts IS NOT NULL OR a.user_id NOT IN (SELECT user_id FROM f)""")
def asof_last_click(spark, d):
    return asof.asof_join(_asks(spark, d), _clicks(spark, d), "user_id", "ts", "ts", ["event_id", "value"], found_ts="clicked_at")


@query("asof_unknown_entities", """
  WITH f AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'click' AND user_id % 3 <> 0),
    a AS (SELECT DISTINCT user_id, ts FROM events WHERE event_type = 'error')
  SELECT a.user_id, a.ts, f.event_id FROM a ASOF LEFT JOIN f ON a.user_id = f.user_id AND a.ts >= f.ts""")
def asof_unknown_entities(spark, d):
    """early='null': known-but-too-early and unknown entities both stay, with NULL features."""
    e = table(spark, d, "events")
    asks = e.where("event_type = 'error'").select("user_id", "ts")
    feats = _clicks(spark, d).where("user_id % 3 <> 0")
    return asof.asof_join(asks, feats, "user_id", "ts", "ts", ["event_id"], early="null")


@query("asof_with_ttl", """
  WITH f AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'click'),
    a AS (SELECT DISTINCT user_id, ts FROM events WHERE event_type <> 'click'),
    j AS (SELECT a.user_id, a.ts, f.event_id, f.ts AS fts FROM a ASOF LEFT JOIN f ON a.user_id = f.user_id AND a.ts >= f.ts)
  SELECT user_id, ts, CASE WHEN fts >= ts - INTERVAL 12 HOUR THEN event_id END AS event_id
  FROM j WHERE fts IS NOT NULL OR user_id NOT IN (SELECT user_id FROM f)""")
def asof_with_ttl(spark, d):
    return asof.asof_join(_asks(spark, d), _clicks(spark, d), "user_id", "ts", "ts", ["event_id"], ttl="12 hours")


@query("leakage_probe", """
  WITH f AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'signup'),
    a AS (SELECT user_id, ts, o.label AS "offset", ts + o.gap AS at FROM f, (VALUES ('-1 day', INTERVAL (-1) DAY), ('at', INTERVAL 0 DAY), ('+30 days', INTERVAL 30 DAY)) AS o(label, gap)),
    j AS (SELECT a."offset", a.user_id, a.at, f.event_id, f.ts AS fts FROM a ASOF LEFT JOIN f ON a.user_id = f.user_id AND a.at >= f.ts)
  SELECT "offset", count(*) AS rows, count(event_id) AS with_features FROM j WHERE fts IS NOT NULL GROUP BY 1""")
def leakage_probe(spark, d):
    feats = table(spark, d, "events").where("event_type = 'signup'").select("user_id", "ts", "event_id")
    return asof.leakage_probe(feats.select("user_id", "ts"), feats, "user_id", "ts", "ts", ["event_id"],
                              {"-1 day": "'-1' DAY", "at": "'0' DAY", "+30 days": "'30' DAY"})


@query("value_reconciliation", """
  SELECT 'o_totalprice' AS "column", count(*) FILTER (WHERE o_orderkey % 7 = 0) AS mismatches FROM orders
  UNION ALL SELECT 'o_orderstatus', 0 FROM (SELECT 1)
  UNION ALL SELECT 'o_orderpriority', count(*) FILTER (WHERE o_orderkey % 11 = 0) FROM orders""")
def value_reconciliation(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    k = F.col("o_orderkey")
    other = o.withColumns({
        "o_totalprice": F.when(k % 7 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
        "o_orderpriority": F.when(k % 11 != 0, F.col("o_orderpriority"))})
    return asof.mismatched(o, other, "o_orderkey", ["o_totalprice", "o_orderstatus", "o_orderpriority"])


@query("label_join", with_loans("""
  SELECT rango_edad, NOT "Pago_atiempo" AS defaulted, count(*) AS n FROM loans GROUP BY ALL"""))
def label_join(spark, d):
    """Features without the outcome meet it again on the entity key, inverted."""
    raw = raw_loans(spark, d)
    feats = loan.prepare_features(raw, check=False)
    labels = loan.coerce_types(raw.select("cliente_id", "Pago_atiempo", *loan.LOAN_SPEC.integers, "fecha_prestamo", "tipo_laboral", "tendencia_ingresos"))
    joined = asof.attach_label(feats.select("cliente_id", "rango_edad"), labels, "cliente_id", "Pago_atiempo")
    return joined.groupBy("rango_edad", "defaulted").agg(F.count("*").alias("n"))


@query("collected_predictions", """
  SELECT doc_id, round(n_chars / 20000.0, 6) AS length, round(quality * CAST(0.9 AS DOUBLE), 6) AS quality,
    round(coalesce(quality * CAST(0.9 AS DOUBLE), 0), 6) AS filled FROM documents LEFT JOIN labels USING (doc_id)""")
def collected_predictions(spark, d):
    docs, lab = table(spark, d, "documents"), table(spark, d, "labels")
    scored = {
        "length": docs.select("doc_id", (F.col("n_chars") / 20000.0).alias("score")),
        "quality": lab.select("doc_id", (F.col("quality") * 0.9).alias("score")),
    }
    wide = asof.collect_predictions(docs.select("doc_id"), scored, "doc_id")
    return asof.fill_unscored(wide.withColumn("filled", F.col("quality")), ["filled"])


@query("score_reproducibility", with_book("""
  SELECT round(max(abs(price_to_total - price / total)), 6) AS same, round(max(abs(discount - tax)), 6) AS different FROM book"""))
def score_reproducibility(spark, d):
    from plumbline.operators.evaluate import max_abs_diff

    b = book(spark, d).withColumn("again", F.col("price") / F.col("total"))
    return max_abs_diff(b, {"same": ("price_to_total", "again"), "different": ("discount", "tax")})


MONTHS_SQL = """m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1),
  c AS (SELECT month, n, sum(n) OVER (ORDER BY month) / sum(n) OVER () AS share FROM m)"""


def _orders(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", vintage("o_orderdate").alias("month"), (F.col("o_orderstatus") == "F").cast("int").alias("defaulted"))


@query("month_shares", f"WITH {MONTHS_SQL} SELECT month, n, round(share, 6) AS cum_share FROM c")
def month_shares(spark, d):
    return split.month_counts(_orders(spark, d), "month")


@query("vintage_cutoff", f"WITH {MONTHS_SQL} SELECT min(month) AS cut FROM c WHERE share >= 0.75")
def vintage_cutoff(spark, d):
    return split.vintage_cutoff(_orders(spark, d), "month", 0.75)


@query("out_of_time_split", f"""WITH {MONTHS_SQL}, k AS (SELECT min(month) AS cut FROM c WHERE share >= 0.75)
  SELECT CASE WHEN strftime(o_orderdate, '%Y-%m') < cut THEN 'train' ELSE 'test' END AS side, count(*) AS n,
    round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END), 6) AS rate FROM orders, k GROUP BY 1""")
def out_of_time_split(spark, d):
    train, test, _ = split.split_out_of_time(_orders(spark, d), "month", 0.75)
    both = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return split.split_summary(both, "side", "defaulted")


@query("time_split_summary", f"""WITH {MONTHS_SQL}, k AS (SELECT min(month) AS cut FROM c WHERE share >= 0.75),
  r AS (SELECT month, sum(n) OVER (ORDER BY month) / sum(n) OVER () AS share FROM m, k WHERE month < cut),
  v AS (SELECT min(month) AS vcut FROM r WHERE share >= 0.8)
  SELECT CASE WHEN strftime(o_orderdate, '%Y-%m') >= cut THEN 'TEST' WHEN strftime(o_orderdate, '%Y-%m') >= vcut THEN 'VALIDATE' ELSE 'TRAIN' END AS split,
    count(*) AS n, round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END), 6) AS rate FROM orders, k, v GROUP BY 1""")
def time_split_summary(spark, d):
    return split.split_summary(split.assign_split(_orders(spark, d), "month", 0.75, 0.2), "split", "defaulted")


@query("development_and_test", f"""WITH {MONTHS_SQL}, k AS (SELECT min(month) AS cut FROM c WHERE share >= 0.75)
  SELECT 'development' AS part, count(*) AS n FROM orders, k WHERE strftime(o_orderdate, '%Y-%m') < cut
  UNION ALL SELECT 'test', count(*) FROM orders, k WHERE strftime(o_orderdate, '%Y-%m') >= cut""")
def development_and_test(spark, d):
    labelled = split.assign_split(_orders(spark, d), "month", 0.75, 0.2)
    dev, test = split.split_frame(labelled, "split", ["TRAIN", "VALIDATE"], "TEST")
    return dev.groupBy(F.lit("development").alias("part")).agg(F.count("*").alias("n")).unionByName(
        split.evaluation_rows(test, "split", "TEST").groupBy(F.lit("test").alias("part")).agg(F.count("*").alias("n")))


@query("development_only", """
  SELECT strftime(o_orderdate, '%Y') AS year, count(*) AS n FROM orders WHERE strftime(o_orderdate, '%Y-%m') < '2000-03' GROUP BY 1""")
def development_only(spark, d):
    kept = split.development_only(_orders(spark, d), "month", "2000-03")
    return kept.groupBy(F.substring("month", 1, 4).alias("year")).agg(F.count("*").alias("n"))


@query("time_folds", f"""WITH {MONTHS_SQL}, l AS (SELECT month, CAST(row_number() OVER (ORDER BY month) - 1 AS INT) AS fold FROM (SELECT month FROM m ORDER BY month DESC LIMIT 4))
  SELECT l.fold, l.month AS fold_month, CASE WHEN strftime(o_orderdate, '%Y-%m') = l.month THEN 'validate' ELSE 'train' END AS role, count(*) AS n
  FROM orders JOIN l ON strftime(o_orderdate, '%Y-%m') <= l.month GROUP BY ALL""")
def time_folds(spark, d):
    return split.time_folds(_orders(spark, d), "month", 4).groupBy("fold", "fold_month", "role").agg(F.count("*").alias("n"))


@query("stratified_folds_exact", """
  WITH c AS (SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS defaulted, count(*) AS n FROM orders GROUP BY 1)
  SELECT CAST(r AS INT) AS repeat, CAST(f AS INT) AS fold, defaulted, n // 5 + CASE WHEN f < n % 5 THEN 1 ELSE 0 END AS n
  FROM c, range(2) AS x(r), range(5) AS y(f)""")
def stratified_folds_exact(spark, d):
    folds = split.stratified_folds(_orders(spark, d), "defaulted", ["o_orderkey"], 5, repeats=2, exact=True)
    return folds.groupBy("repeat", "fold", "defaulted").agg(F.count("*").alias("n"))


@query("stratified_folds")
def stratified_folds(spark, d):
    folds = split.stratified_folds(_orders(spark, d), "defaulted", ["o_orderkey"], 5, repeats=3)
    return folds.groupBy("repeat", "fold").agg(F.count("*").alias("n"), F.avg(F.col("defaulted").cast("double")).alias("rate"))


@query("learning_curve_samples")
def learning_curve_samples(spark, d):
    s = split.learning_curve_samples(_orders(spark, d), ["o_orderkey"], [0.1, 0.2, 0.35, 0.5, 0.75, 1.0], 3)
    return s.groupBy("frac", "rep").agg(F.count("*").alias("n"), F.sum("defaulted").alias("cases"))


@query("resampled_classes")
def resampled_classes(spark, d):
    b = book(spark, d).select(*BOOK_KEY, "defaulted")
    over = split.resample(b, "defaulted", list(BOOK_KEY), "over", 1.0)
    under = split.resample(b, "defaulted", list(BOOK_KEY), "under", 1.0)
    both = over.withColumn("method", F.lit("over")).unionByName(under.withColumn("method", F.lit("under")))
    return both.groupBy("method", "defaulted").agg(F.count("*").alias("n"))
