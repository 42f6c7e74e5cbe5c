"""Queries over scorecards, ranking metrics, calibration, bootstrap intervals and result tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline import loan
from plumbline.functions.columns import vintage
from plumbline.operators import evaluate, gate, models, ranking, resampling, scorecard
from plumbline.plans.book import BOOK_KEY, book, raw_loans, stored_book, table, with_book, with_loans
from plumbline.plans.registry import query

KEY = list(BOOK_KEY)

POINTS = {
    "bureau_score_band": "CASE WHEN puntaje_datacredito IS NULL THEN 2 WHEN puntaje_datacredito < 770 THEN 2 WHEN puntaje_datacredito < 813 THEN -1 ELSE -2 END",
    "inquiry_band": "CASE WHEN huella_consulta IS NULL THEN 0 WHEN huella_consulta <= 3 THEN -1 WHEN huella_consulta <= 6 THEN 0 ELSE 2 END",
    "age_band": "CASE WHEN rango_edad IS NULL THEN 2 WHEN rango_edad = '18-25' THEN 3 WHEN rango_edad = '26-35' THEN 1 WHEN rango_edad = '56-65' THEN 0 ELSE -1 END",
    "young_independent": "CASE WHEN tipo_laboral = 'Independiente' AND edad_cliente < 36 THEN 3 ELSE 0 END",
    "income_gap_quartile": "CASE WHEN ratio_ingreso_declarado_bureau IS NULL THEN 0 WHEN ratio_ingreso_declarado_bureau < 1.081 THEN -1 WHEN ratio_ingreso_declarado_bureau < 1.807 THEN -1 WHEN ratio_ingreso_declarado_bureau < 3.594 THEN 0 ELSE 1 END",
    "decreasing_income_trend": "CASE WHEN tendencia_ingresos = 'Decreciente' THEN 1 WHEN tendencia_ingresos = 'Creciente' THEN -1 ELSE 0 END",
    "high_amount_long_term": "CASE WHEN capital_prestado >= 3084840 AND plazo_meses >= 13 THEN 5 ELSE 0 END",
    "missing_bureau_income": "CASE WHEN promedio_ingresos_datacredito IS NULL THEN 1 ELSE 0 END",
}
TOTAL_POINTS = " + ".join(f"({v})" for v in POINTS.values())


def scored_loans(spark, d):
    out = scorecard.score_card(loan.derive(loan.clean(raw_loans(spark, d))), loan.LOAN_CARD)
    return out.withColumn("defaulted", (~F.col("Pago_atiempo")).cast("int"))


SCORED_SQL = f"""WITH scored AS (SELECT *, {TOTAL_POINTS} AS points, CASE WHEN "Pago_atiempo" THEN 0 ELSE 1 END AS defaulted FROM loans)"""


@query("scorecard_points", with_loans(f"SELECT cliente_id, CAST({TOTAL_POINTS} AS INT) AS points, {TOTAL_POINTS} >= 4 AS flag FROM loans"))
def scorecard_points(spark, d):
    out = scorecard.predict(scored_loans(spark, d), loan.LOAN_CARD)
    return out.select("cliente_id", "points", "flag")


@query("scorecard_reasons", with_loans("SELECT cliente_id, " + ", ".join(f"CAST({v} AS INT) AS {k}" for k, v in POINTS.items()) + " FROM loans"))
def scorecard_reasons(spark, d):
    out = scorecard.explain(loan.derive(loan.clean(raw_loans(spark, d))), loan.LOAN_CARD)
    return out.select("cliente_id", *loan.LOAN_CARD.rules)


@query("frozen_threshold", with_book("""
  WITH q AS (SELECT quantile_cont(price_to_total, 0.843) AS t FROM book)
  SELECT segment, count(*) AS n, count(*) FILTER (WHERE price_to_total >= t) AS flagged, round(max(t), 6) AS threshold FROM book, q GROUP BY 1"""))
def frozen_threshold(spark, d):
    b = book(spark, d).select("segment", "price_to_total")
    t = evaluate.freeze_threshold(b, "price_to_total", 0.157)
    return b.groupBy("segment").agg(F.count("*").alias("n"), F.count_if(F.col("price_to_total") >= t).alias("flagged"), F.lit(t).alias("threshold"))


def cum_sql(by: str, score: str, source: str = "book", y: str = "defaulted") -> str:
    """CTEs t and c: distinct scores with cumulative counts per group."""
    part = f"PARTITION BY {by} " if by else ""
    cols = f"{by}, " if by else ""
    return f"""WITH t AS (SELECT {cols}{score} AS s, count(*) AS n, sum({y}) AS p FROM {source} WHERE {score} IS NOT NULL GROUP BY ALL),
  c AS (SELECT *, sum(n) OVER ({part}ORDER BY s) AS cn, sum(p) OVER ({part}ORDER BY s) AS cp, sum(n) OVER ({part.strip()}) AS tn, sum(p) OVER ({part.strip()}) AS tp,
    lead(s) OVER ({part}ORDER BY s) AS nx FROM t)"""


AUC = "sum(p * ((cn - cp) - (n - p) + (n - p) / 2.0)) / NULLIF(max(tp) * (max(tn) - max(tp)), 0)"
AP = "coalesce(sum(p * ((tp - cp + p) * 1.0 / (tn - cn + n))) / NULLIF(max(tp), 0), 0)"


@query("auc_by_segment", with_book(cum_sql("segment", "price") + f"""
  SELECT segment, CAST(max(tp) AS BIGINT) AS n_pos, CAST(max(tn) - max(tp) AS BIGINT) AS n_neg, round({AUC}, 6) AS auc, round(2 * {AUC} - 1, 6) AS gini FROM c GROUP BY 1"""))
def auc_by_segment(spark, d):
    return ranking.auc(book(spark, d), "price", "defaulted", ["segment"]).select("segment", "n_pos", "n_neg", "auc", "gini")


@query("auc_document_length", cum_sql("lang", "n_chars", "(documents JOIN labels USING (doc_id))", "toxic") + f"""
  SELECT lang, round({AUC}, 6) AS auc FROM c GROUP BY 1""")
def auc_document_length(spark, d):
    """Languages without a toxic document have a single class and a NULL metric."""
    j = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    return ranking.auc(j, "n_chars", "toxic", ["lang"]).select("lang", "auc")


@query("average_precision_by_segment", with_book(cum_sql("segment", "price") + f"SELECT segment, round({AP}, 6) AS pr_auc FROM c GROUP BY 1"))
def average_precision_by_segment(spark, d):
    return ranking.average_precision(book(spark, d), "price", "defaulted", ["segment"])


@query("classification_summary", with_book(cum_sql("segment", "discount * 8") + f""", k AS (SELECT segment, round({AP}, 6) AS pr_auc, round({AUC}, 6) AS roc_auc, round(2 * {AUC} - 1, 6) AS gini FROM c GROUP BY 1),
  f AS (SELECT segment, count(*) FILTER (WHERE discount * 8 < 0.5 AND defaulted = 0) AS tn, count(*) FILTER (WHERE discount * 8 >= 0.5 AND defaulted = 0) AS fp,
    count(*) FILTER (WHERE discount * 8 < 0.5 AND defaulted = 1) AS fn, count(*) FILTER (WHERE discount * 8 >= 0.5 AND defaulted = 1) AS tp,
    round(avg(power(discount * 8 - defaulted, 2)), 6) AS brier FROM book GROUP BY 1)
  SELECT segment, tn, fp, fn, tp, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1,
    round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy, round((tp + fp) / (tp + tn + fp + fn), 6) AS flagged_share, brier, pr_auc, roc_auc, gini FROM f JOIN k USING (segment)"""))
def classification_summary(spark, d):
    b = book(spark, d).select("segment", "defaulted", (F.col("discount") * 8).alias("score"))
    return evaluate.classification_summary(b, "score", "defaulted", 0.5, ["segment"])


@query("curve_points", with_book(cum_sql("", "quantity") + """
  SELECT s AS threshold, round(((tn - cn + n) - (tp - cp + p)) / (tn - tp), 6) AS fpr, round((tp - cp + p) / tp, 6) AS tpr, round((tp - cp + p) / (tn - cn + n), 6) AS precision FROM c"""))
def curve_points(spark, d):
    return ranking.curve_points(book(spark, d), "quantity", "defaulted")


BANDS = """, r AS (SELECT *, cn - n + (n + 1) / 2.0 AS rk FROM c),
  x AS (SELECT b.s, b.rk, b.n, b.p FROM r b),
  ranks AS (SELECT rk, generate_subscripts(range(CAST(n AS INT)), 1) FROM x),
  e AS (SELECT list_distinct(list_value({edges})) AS cuts FROM ranks),
  z AS (SELECT s, n, p, rk, len(list_filter(list_sort(cuts)[2:], lambda v: v < rk)) AS band FROM x, e)"""
DECILES = BANDS.format(edges=", ".join(f"quantile_cont(rk, {j / 10})" for j in range(11)))


@query("decile_rates", with_book(cum_sql("", "quantity") + DECILES + """
  SELECT CAST(band AS INT) AS band, CAST(sum(n) AS BIGINT) AS n, CAST(sum(p) AS BIGINT) AS cases, round(sum(p) / sum(n), 6) AS rate FROM z GROUP BY 1"""))
def decile_rates(spark, d):
    return ranking.band_rates(book(spark, d), "quantity", "defaulted", 10)


@query("decile_lift", with_loans(SCORED_SQL + cum_sql("", "points", "scored").replace("WITH t", ", t") + DECILES + """, g AS (SELECT band, sum(n) AS n, sum(p) / sum(n) AS rate FROM z GROUP BY 1)
  SELECT CAST(sum(n) AS BIGINT) AS n, round(arg_max(rate, band), 6) AS top_decile_rate, round(arg_min(rate, band), 6) AS bottom_decile_rate,
    round(arg_max(rate, band) / NULLIF(arg_min(rate, band), 0), 6) AS decile_lift FROM g"""))
def decile_lift(spark, d):
    return ranking.decile_lift(scored_loans(spark, d), "points", "defaulted", 10, 200)


@query("portfolio_evaluation", with_loans(SCORED_SQL + cum_sql("", "points", "scored").replace("WITH t", ", t") + DECILES + f""", g AS (SELECT band, sum(n) AS n, sum(p) / sum(n) AS rate FROM z GROUP BY 1),
  q AS (SELECT count(*) FILTER (WHERE points >= 4) AS f, count(*) FILTER (WHERE points >= 4 AND defaulted = 1) AS h, sum(defaulted) AS d, count(*) AS m FROM scored)
  SELECT round((SELECT {AUC} FROM c), 6) AS auc, round(2 * (SELECT {AUC} FROM c) - 1, 6) AS gini, CAST(sum(n) AS BIGINT) AS n, round(arg_max(rate, band), 6) AS top_decile_rate,
    round(arg_min(rate, band), 6) AS bottom_decile_rate, round(arg_max(rate, band) / NULLIF(arg_min(rate, band), 0), 6) AS decile_lift,
    round((SELECT h / f FROM q), 6) AS precision, round((SELECT h / d FROM q), 6) AS recall, round((SELECT f / m FROM q), 6) AS flagged_share FROM g"""))
def portfolio_evaluation(spark, d):
    return evaluate.evaluate_portfolio(scored_loans(spark, d), "points", "defaulted", loan.LOAN_CARD.threshold)


@query("threshold_sweep", with_book("""
  SELECT t.v AS threshold, CAST(sum(defaulted) FILTER (WHERE quantity >= t.v) AS BIGINT) AS tp, count(*) FILTER (WHERE quantity >= t.v) AS flagged,
    round(sum(defaulted) FILTER (WHERE quantity >= t.v) / count(*) FILTER (WHERE quantity >= t.v), 6) AS precision,
    round(sum(defaulted) FILTER (WHERE quantity >= t.v) / sum(defaulted), 6) AS recall, round(count(*) FILTER (WHERE quantity >= t.v) / count(*), 6) AS flagged_share
  FROM book, (VALUES (CAST(5 AS DOUBLE)), (10), (20), (30), (40), (45)) AS t(v) GROUP BY 1"""))
def threshold_sweep(spark, d):
    return evaluate.threshold_sweep(book(spark, d), "quantity", "defaulted", [5, 10, 20, 30, 40, 45])


@query("flagged_top_share", with_book("""
  WITH q AS (SELECT quantile_cont(price, 0.843) AS t FROM book)
  SELECT price >= t AS flagged, count(*) AS n, round(avg(defaulted), 6) AS rate, round(min(price), 6) AS lowest FROM book, q GROUP BY 1"""))
def flagged_top_share(spark, d):
    b = evaluate.flag_top_share(book(spark, d).select("price", "defaulted"), "price", 0.157)
    return b.groupBy("flagged").agg(F.count("*").alias("n"), F.avg("defaulted").alias("rate"), F.min("price").alias("lowest"))


@query("precision_recall_at_points", with_loans(SCORED_SQL + """
  SELECT rango_edad, round(coalesce(sum(defaulted) FILTER (WHERE points >= 4) / NULLIF(count(*) FILTER (WHERE points >= 4), 0), 0), 6) AS precision,
    round(coalesce(sum(defaulted) FILTER (WHERE points >= 4) / NULLIF(sum(defaulted), 0), 0), 6) AS recall, round(count(*) FILTER (WHERE points >= 4) / count(*), 6) AS flagged_share
  FROM scored GROUP BY 1"""))
def precision_recall_at_points(spark, d):
    return evaluate.precision_recall(scored_loans(spark, d), "points", "defaulted", 4, ["rango_edad"])


@query("trivial_baseline", with_book("""
  SELECT segment, round(1 - avg(defaulted), 6) AS accuracy, CAST(0 AS DOUBLE) AS precision, CAST(0 AS DOUBLE) AS recall, CAST(0 AS DOUBLE) AS f1 FROM book GROUP BY 1"""))
def trivial_baseline(spark, d):
    return evaluate.trivial_baseline(book(spark, d), "defaulted", ["segment"])


CAL_EDGES = "list_distinct(list_value(" + ", ".join(f"quantile_cont(p, {j / 10})" for j in range(1, 10)) + "))"
CAL_SQL = f"""WITH x AS (SELECT 0.2 + 0.3 * price_to_total / (1 + price_to_total) AS p, defaulted AS y FROM book), e AS (SELECT {CAL_EDGES} AS cuts FROM x),
  b AS (SELECT len(list_filter(cuts, lambda v: v < p)) AS band, p, y FROM x, e), g AS (SELECT band, count(*) AS n, avg(p) AS mean_pred, avg(y) AS observed FROM b GROUP BY 1)"""


def _probabilities(spark, d):
    r = F.col("price_to_total")
    return book(spark, d).select(*KEY, "segment", "defaulted", (0.2 + 0.3 * r / (1 + r)).alias("p"), "discount")


@query("reliability_bands", with_book(CAL_SQL + "SELECT CAST(band AS INT) AS band, n, round(mean_pred, 6) AS mean_pred, round(observed, 6) AS observed FROM g"))
def reliability_bands(spark, d):
    return evaluate.calibration_bands(_probabilities(spark, d), "p", "defaulted", 10)


@query("ece_table", with_book(CAL_SQL + "SELECT round(sum(n * abs(observed - mean_pred)) / sum(n), 6) AS ece FROM g"))
def ece_table(spark, d):
    return evaluate.ece(_probabilities(spark, d), "p", "defaulted", 10)


@query("calibration_table", with_book("""
  WITH x AS (SELECT segment, 0.2 + 0.3 * price_to_total / (1 + price_to_total) AS p, defaulted AS y FROM book)
  SELECT segment, count(*) AS n, round(avg(power(p - y, 2)), 6) AS brier, round(avg(-(y * ln(p) + (1 - y) * ln(1 - p))), 6) AS logloss, round(avg(p), 6) AS mean_pred,
    round(avg(y), 6) AS observed, round(avg(y) * (1 - avg(y)), 6) AS brier_constant FROM x GROUP BY 1"""))
def calibration_table(spark, d):
    return evaluate.calibration_table(_probabilities(spark, d), "p", "defaulted", ["segment"])


@query("flag_overlap", with_book("""
  WITH q AS (SELECT quantile_cont(price, 0.843) AS a, quantile_cont(quantity, 0.843) AS b FROM book)
  SELECT count(*) FILTER (WHERE price >= a) AS flagged_a, count(*) FILTER (WHERE quantity >= b) AS flagged_b,
    round(count(*) FILTER (WHERE price >= a AND quantity >= b) / count(*) FILTER (WHERE price >= a), 6) AS overlap,
    round(count(*) FILTER (WHERE quantity = b) / count(*), 6) AS ties_share_at_cut FROM book, q"""))
def flag_overlap(spark, d):
    return evaluate.flag_overlap(book(spark, d), "price", "quantity", 0.157)


@query("bootstrap_auc_ci")
def bootstrap_auc_ci(spark, d):
    return resampling.bootstrap_ci(book(spark, d), "price", "defaulted", KEY, ("pr_auc", "roc_auc", "gini", "f1"), 200, 0, share=0.157)


@query("bootstrap_points", with_book(cum_sql("", "price") + f"SELECT 'pr_auc' AS metric, round({AP}, 6) AS point FROM c UNION ALL SELECT 'roc_auc', round({AUC}, 6) FROM c"))
def bootstrap_points(spark, d):
    """The bootstrap's replicate zero is the data itself, so its metrics are the exact ones."""
    ci = resampling.bootstrap_ci(book(spark, d), "price", "defaulted", KEY, ("pr_auc", "roc_auc"), 4, 0)
    return ci.select("metric", "point")


@query("paired_bootstrap")
def paired_bootstrap(spark, d):
    b = stored_book(spark, d, *KEY, "defaulted", "price", "quantity")
    return resampling.paired_bootstrap(b, "price", "quantity", "defaulted", KEY, ("pr_auc", "roc_auc"), 200)


# --- result tables: every month is a fold, every segment a run ---

RESULTS_SQL = """WITH long AS (SELECT segment, 'price' AS model, price AS s, defaulted AS y, month FROM book UNION ALL SELECT segment, 'quantity', quantity, defaulted, month FROM book
    UNION ALL SELECT segment, 'discount', discount, defaulted, month FROM book),
  t AS (SELECT segment, model, s, count(*) AS n, sum(y) AS p FROM long GROUP BY ALL),
  c AS (SELECT *, sum(n) OVER (PARTITION BY segment, model ORDER BY s) AS cn, sum(p) OVER (PARTITION BY segment, model ORDER BY s) AS cp, sum(n) OVER (PARTITION BY segment, model) AS tn,
    sum(p) OVER (PARTITION BY segment, model) AS tp FROM t),
  res AS (SELECT segment, model, """ + AUC + """ AS roc_auc, """ + AP + """ AS pr_auc FROM c GROUP BY ALL)"""


def _results(spark, d):
    """Model results per segment: three scores judged on the same rows."""
    cells = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("s")) for m in ("price", "quantity", "discount")]))
    long = book(spark, d).select("segment", "defaulted", cells.alias("c")).select("segment", "defaulted", "c.model", "c.s")
    cum = ranking.cumulative_counts(long, "s", "defaulted", ["segment", "model"])
    return evaluate._auc_and_ap(cum, ["segment", "model"]).select("segment", "model", "roc_auc", "pr_auc")


@query("champion_by_segment", with_book(RESULTS_SQL + """
  SELECT segment, arg_max(model, (round(pr_auc, 4), roc_auc)) AS model, round(max(pr_auc), 4) AS pr_auc FROM res GROUP BY 1"""), digits=4)
def champion_by_segment(spark, d):
    r = _results(spark, d).withColumn("cv_std", 1 - F.col("roc_auc"))  # a stand-in spread, smaller is better
    return models.select_champion(r, "pr_auc", ["segment"]).select("segment", "model", "pr_auc")


@query("comparison_table", with_book(RESULTS_SQL + """
  SELECT segment, model, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc, CAST(row_number() OVER w AS INT) AS rank, lead(model) OVER w AS next_best,
    round(pr_auc - lead(pr_auc) OVER w, 6) AS lead_over_next FROM res WINDOW w AS (PARTITION BY segment ORDER BY pr_auc DESC, model)"""))
def comparison_table(spark, d):
    return models.comparison_table(_results(spark, d), "pr_auc", ["segment"])


@query("deltas_to_reference", with_book(RESULTS_SQL + """
  SELECT a.segment, a.model, round(a.pr_auc - b.pr_auc, 6) AS pr_auc_delta, round(a.roc_auc - b.roc_auc, 6) AS roc_auc_delta
  FROM res a JOIN res b ON a.segment = b.segment AND b.model = 'quantity'"""))
def deltas_to_reference(spark, d):
    return models.deltas(_results(spark, d), "quantity", ["pr_auc", "roc_auc"], ["segment"])


@query("cv_gap", with_book(RESULTS_SQL + """
  SELECT model, round(avg(roc_auc), 6) AS cv_mean, round(stddev_samp(roc_auc), 6) AS cv_std, round(avg(pr_auc), 6) AS pr_auc, round(avg(roc_auc) - avg(pr_auc), 6) AS gap FROM res GROUP BY 1"""))
def cv_gap(spark, d):
    r = _results(spark, d).groupBy("model").agg(F.avg("roc_auc").alias("cv_mean"), F.stddev_samp("roc_auc").alias("cv_std"), F.avg("pr_auc").alias("pr_auc"))
    return models.cv_gap(r)


@query("normalised_metrics", with_book(RESULTS_SQL + """, l AS (SELECT model, 'pr_auc' AS metric, avg(pr_auc) AS value FROM res GROUP BY 1 UNION ALL SELECT model, 'roc_auc', avg(roc_auc) FROM res GROUP BY 1)
  SELECT model, metric, round(value, 6) AS value, round((value - min(value) OVER w) / (max(value) OVER w - min(value) OVER w), 6) AS scaled FROM l WINDOW w AS (PARTITION BY metric)"""))
def normalised_metrics(spark, d):
    wide = _results(spark, d).groupBy("model").agg(F.avg("pr_auc").alias("pr_auc"), F.avg("roc_auc").alias("roc_auc"))
    return evaluate.normalise_metrics(wide.unpivot(["model"], ["pr_auc", "roc_auc"], "metric", "value"))


@query("metric_floors", with_book(RESULTS_SQL + """, v AS (SELECT max(pr_auc) AS pr_auc, max(roc_auc) AS roc_auc FROM res)
  SELECT 'pr_auc' AS metric, CAST(0.2 AS DOUBLE) AS minimum, round(pr_auc, 6) AS value, pr_auc >= 0.2 AS passed, CASE WHEN pr_auc < 0.2 THEN 'below the minimum' ELSE '' END AS problem FROM v
  UNION ALL SELECT 'roc_auc', 0.9, round(roc_auc, 6), roc_auc >= 0.9, CASE WHEN roc_auc < 0.9 THEN 'below the minimum' ELSE '' END FROM v
  UNION ALL SELECT 'brier', 0.1, NULL, false, 'missing or not a number' FROM v"""))
def metric_floors(spark, d):
    r = _results(spark, d).agg(F.max("pr_auc").alias("pr_auc"), F.max("roc_auc").alias("roc_auc"))
    return models.metric_floors(r.unpivot([], ["pr_auc", "roc_auc"], "metric", "value"), {"pr_auc": 0.2, "roc_auc": 0.9, "brier": 0.1})


FOLDS_SQL = """WITH t AS (SELECT month, price AS s, count(*) AS n, sum(defaulted) AS p FROM book GROUP BY ALL),
  c AS (SELECT *, sum(n) OVER (PARTITION BY month ORDER BY s) AS cn, sum(p) OVER (PARTITION BY month ORDER BY s) AS cp, sum(n) OVER (PARTITION BY month) AS tn, sum(p) OVER (PARTITION BY month) AS tp FROM t),
  f AS (SELECT month, """ + AUC + " AS roc_auc, " + AP + " AS pr_auc FROM c GROUP BY 1)"


def _month_folds(spark, d):
    cum = ranking.cumulative_counts(book(spark, d), "price", "defaulted", ["month"])
    return evaluate._auc_and_ap(cum, ["month"])


@query("fold_summary", with_book(FOLDS_SQL + """
  SELECT 'pr_auc' AS metric, round(avg(pr_auc), 6) AS mean, round(stddev_samp(pr_auc), 6) AS sd, round(min(pr_auc), 6) AS min, round(max(pr_auc), 6) AS max FROM f
  UNION ALL SELECT 'roc_auc', round(avg(roc_auc), 6), round(stddev_samp(roc_auc), 6), round(min(roc_auc), 6), round(max(roc_auc), 6) FROM f"""))
def fold_summary(spark, d):
    return evaluate.fold_summary(_month_folds(spark, d).select("pr_auc", "roc_auc"), ["pr_auc", "roc_auc"])


@query("fold_verdict", with_book(FOLDS_SQL + """, v AS (SELECT substr(month, 1, 4) AS year, roc_auc - 0.5 AS diff FROM f)
  SELECT year, round(avg(diff), 6) AS mean, round(stddev_samp(diff), 6) AS sd, round(stddev_samp(diff) / sqrt(count(*)), 6) AS se, count(*) FILTER (WHERE diff > 0) AS wins, count(*) AS folds,
    avg(diff) > 2 * stddev_samp(diff) / sqrt(count(*)) AND min(diff) > 0 AS real FROM v GROUP BY 1"""))
def fold_verdict(spark, d):
    f = _month_folds(spark, d).select(F.substring("month", 1, 4).alias("year"), (F.col("roc_auc") - 0.5).alias("diff"))
    return evaluate.fold_verdict(f, "diff", ["year"])


@query("metrics_table")
def metrics_table(spark, d):
    entries = [{"id": "price"}, {"id": "quantity"}, {"id": "discount", "probabilistic": True}, {"id": "external", "optional": True}]
    b = stored_book(spark, d, *KEY, "defaulted", "price", "quantity", "discount")
    return models.metrics_table(b, entries, "defaulted", KEY, 0.157, 100, 0, "quantity")


@query("promotion_gate")
def promotion_gate(spark, d):
    b = stored_book(spark, d, *KEY, "defaulted", "price").withColumn("oracle", F.col("price") + F.col("defaulted") * 20_000)
    cut = evaluate.freeze_threshold(b, "oracle", 0.157)
    cand = gate.Entrant("oracle", ["price"], cut, 0.157)
    return gate.promotion_gate(b, cand, gate.Entrant("price", ["price"], None, 0.157), "defaulted", KEY, gate.GateSpec(replicates=100)).drop("position")


@query("promotion_gate_missing", with_book("""
  SELECT x.* FROM (SELECT count(*) FILTER (WHERE quantity <= 6) AS bad, avg(CASE WHEN quantity > 6 AND price >= 60000 THEN 1.0 ELSE 0.0 END) AS share FROM book),
    LATERAL (SELECT share BETWEEN 0.5 * 0.157 AND 2.0 * 0.157 AS band), LATERAL (
      SELECT 'meta_has_threshold' AS "check", true AS passed, CAST(NULL AS DOUBLE) AS value, 'a threshold was frozen when the candidate was fitted' AS detail
      UNION ALL SELECT 'same_features', true, NULL, 'both score from one list of features'
      UNION ALL SELECT 'no_missing_scores', bad = 0, bad, 'rows that lack a score of either model'
      UNION ALL SELECT 'flagged_share_in_band', band, round(share, 6), 'flagged at the frozen threshold, allowed 0.5 to 2.0 times 0.157'
      UNION ALL SELECT 'decision', false, CASE WHEN band THEN 1 ELSE 2 END, 'keep: ' || CASE WHEN band THEN '' ELSE 'flagged_share_in_band, ' END || 'no_missing_scores') x"""))
def promotion_gate_missing(spark, d):
    """A candidate that scores no short line: the gate names what is missing and compares nothing."""
    b = book(spark, d).withColumn("partial", F.when(F.col("quantity") > 6, F.col("price")))
    return gate.promotion_gate(b, gate.Entrant("partial", ["price"], 60_000, 0.157), gate.Entrant("price", ["price"], None, 0.157), "defaulted", KEY).drop("position")


@query("scorecard_weights", with_book("""
  SELECT quantity_band, count(*) AS n, round(avg(defaulted), 6) AS rate, CAST(round_even((avg(defaulted) / (SELECT avg(defaulted) FROM book) - 1) * 40, 0) AS INT) AS points
  FROM book WHERE quantity_band IS NOT NULL GROUP BY 1"""))
def scorecard_weights(spark, d):
    return scorecard.derive_weights(book(spark, d), "quantity_band", "defaulted", 40)
