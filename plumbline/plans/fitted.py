"""Queries over fitted transforms, encodings and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import association, encode, engineer, evaluate, isotonic, models, split
from plumbline.operators.smote import smote
from plumbline.plans.book import BOOK_KEY, book, stored_book, with_book
from plumbline.plans.registry import query
from plumbline.spec import PortfolioSpec

KEY = list(BOOK_KEY)
FEATURES = ["price", "quantity", "discount", "tax", "total", "balance", "total_to_balance", "price_to_total", "missing_balance", "segment", "priority"]
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
BOOK_SPEC = PortfolioSpec(
    entity_key="l_orderkey", event_timestamp="ordered_at", target="defaulted", withheld=("month",),
    categoricals={"segment": SEGMENTS, "priority": PRIORITIES},
    heavy_tailed=("price", "total", "balance", "total_to_balance", "price_to_total"),
    log_scale=("price", "total", "balance", "total_to_balance", "price_to_total"), winsor_quantile=0.99,
    views={"order": ("price", "quantity", "discount", "tax", "total", "price_to_total", "priority"), "customer": ("balance", "total_to_balance", "missing_balance", "segment")},
)
CUT = "2000-01"


def windows(spark, d):
    """(train, test): orders before and after the cut month."""
    b = book(spark, d).select(*KEY, "month", "defaulted", *FEATURES)
    return b.where(F.col("month") < CUT), b.where(F.col("month") >= CUT)


ENGINEERED = {"price": True, "total": True, "balance": True, "total_to_balance": True, "quantity": False}
STATE_SQL = "WITH tr AS (SELECT * FROM book WHERE month < '2000-01'), st AS (SELECT " + ", ".join(
    f"quantile_cont({c}, 0.99) AS cap_{c}, median({c}) AS med_{c}" for c in ENGINEERED) + " FROM tr)"


def engineered_sql(c: str, heavy: bool) -> str:
    v = f"coalesce(least({c}, cap_{c}), med_{c})" if heavy else f"coalesce({c}, med_{c})"
    v = v.replace("least(", f"CASE WHEN {c} IS NOT NULL THEN least(", 1).replace(f", cap_{c})", f", cap_{c}) END", 1) if heavy else v
    return f"round(avg({'ln(1 + greatest(' + v + ', 0))' if heavy else v}), 6) AS {c}"


@query("winsor_log_engineer", with_book(STATE_SQL + " SELECT segment, " + ", ".join(engineered_sql(c, h) for c, h in ENGINEERED.items())
       + ", round(avg(CASE WHEN priority = '5-LOW' THEN 1.0 ELSE 0.0 END), 6) AS \"priority_5-LOW\", count(*) AS n FROM book, st WHERE month >= '2000-01' GROUP BY 1"))
def winsor_log_engineer(spark, d):
    """Caps and medians of the training months applied to the held-out ones."""
    train, test = windows(spark, d)
    state = engineer.fit_engineer(train.select(*FEATURES), BOOK_SPEC)
    z = engineer.apply_engineer(test.withColumn("by", F.col("segment")), state, ["by"])
    return z.groupBy(F.col("by").alias("segment")).agg(*[F.avg(c).alias(c) for c in (*ENGINEERED, "priority_5-LOW")], F.count("*").alias("n"))


@query("engineer_state", with_book("WITH tr AS (SELECT * FROM book WHERE month < '2000-01') " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {'round(quantile_cont(' + c + ', 0.99), 6)' if h else 'CAST(NULL AS DOUBLE)'} AS cap, round(median({c}), 6) AS median FROM tr" for c, h in ENGINEERED.items())))
def engineer_state(spark, d):
    """The fitted state as a table: survives storage and comes back equal."""
    train, _ = windows(spark, d)
    fitted = engineer.fit_engineer(train.select(*ENGINEERED), BOOK_SPEC)
    state = engineer.EngineerState.from_frame(fitted.to_frame(spark))
    rows = [(c, state.caps.get(c), state.medians[c]) for c in state.columns]
    return spark.createDataFrame(rows, "column string, cap double, median double")


@query("one_hot_levels", with_book("SELECT " + ", ".join(f"CAST(count(*) FILTER (WHERE segment = '{s}') AS DOUBLE) AS \"segment_{s}\"" for s in SEGMENTS) + ", CAST(0 AS DOUBLE) AS segment_UNSEEN FROM book"))
def one_hot_levels(spark, d):
    """A declared level nobody has still gets its column, all zeros."""
    spec = PortfolioSpec(entity_key="k", event_timestamp="t", target="y", categoricals={"segment": (*SEGMENTS, "UNSEEN")})
    b = book(spark, d).select("segment")
    z = engineer.apply_engineer(b, engineer.EngineerState((), {}, {}, (), spec.categoricals))
    return z.agg(*[F.sum(c).alias(c) for c in z.columns])


@query("train_median_impute", with_book("""
  WITH m AS (SELECT median(balance) AS b, median(total_to_balance) AS t FROM book WHERE month < '2000-01')
  SELECT coalesce(CASE WHEN segment <> 'FURNITURE' THEN segment END, 'missing') AS segment, count(*) AS n, round(avg(coalesce(balance, b)), 4) AS balance,
    round(avg(coalesce(total_to_balance, t)), 4) AS total_to_balance FROM book, m GROUP BY 1"""), digits=4)
def train_median_impute(spark, d):
    b = book(spark, d).select("balance", "total_to_balance", F.when(F.col("segment") != "FURNITURE", F.col("segment")).alias("segment"),
                              F.when(F.col("month") < CUT, "TRAIN").otherwise("TEST").alias("split"))
    out = engineer.impute_from_train(b, ["balance", "total_to_balance"], ["segment"], "split", "TRAIN")
    return out.groupBy("segment").agg(F.count("*").alias("n"), F.avg("balance").alias("balance"), F.avg("total_to_balance").alias("total_to_balance"))


@query("standardised", with_book("""
  WITH s AS (SELECT avg(price) AS pm, stddev_pop(price) AS ps, avg(quantity) AS qm, stddev_pop(quantity) AS qs FROM book WHERE month < '2000-01')
  SELECT segment, round(avg((price - pm) / ps), 6) AS price, round(stddev_pop((quantity - qm) / qs), 6) AS quantity, CAST(0 AS DOUBLE) AS constant FROM book, s WHERE month >= '2000-01' GROUP BY 1"""))
def standardised(spark, d):
    train, test = (w.select("segment", "price", "quantity", F.lit(7.0).alias("constant")) for w in windows(spark, d))
    z = engineer.apply_scaler(test, engineer.fit_scaler(train, ["price", "quantity", "constant"]))
    return z.groupBy("segment").agg(F.avg("price").alias("price"), F.stddev_pop("quantity").alias("quantity"), F.avg("constant").alias("constant"))


WOE_SQL = """WITH e AS (SELECT list_distinct(list_value(quantile_cont({c}, 0.2), quantile_cont({c}, 0.4), quantile_cont({c}, 0.6), quantile_cont({c}, 0.8))) AS cuts FROM book),
  b AS (SELECT len(list_filter(cuts, lambda v: v <= {c})) AS bin, defaulted FROM book, e),
  g AS (SELECT bin, count(*) AS n, sum(defaulted) AS pos FROM b GROUP BY 1)
  SELECT '{c}' AS "column", CAST(bin AS INT) AS bin, n, CAST(pos AS BIGINT) AS pos, round(ln(((pos + 0.5) / (SELECT sum(defaulted) FROM book)) / ((n - pos + 0.5) / (SELECT count(*) - sum(defaulted) FROM book))), 6) AS woe FROM g"""


@query("woe_bins", with_book("SELECT * FROM (" + WOE_SQL.format(c="quantity") + ") UNION ALL SELECT * FROM (" + WOE_SQL.format(c="price") + ")"))
def woe_bins(spark, d):
    b = book(spark, d).select("quantity", "price", "defaulted")
    return encode.woe_bins(b, encode.woe_edges(b, ["quantity", "price"], 5), "defaulted")


@query("woe_applied", with_book(f"WITH w AS ({WOE_SQL.format(c='quantity')}), e AS (SELECT list_distinct(list_value(quantile_cont(quantity, 0.2), quantile_cont(quantity, 0.4), quantile_cont(quantity, 0.6), quantile_cont(quantity, 0.8))) AS cuts FROM book) SELECT segment, round(avg(woe), 4) AS woe FROM (SELECT segment, len(list_filter(cuts, lambda v: v <= quantity)) AS bin FROM book, e) JOIN w USING (bin) GROUP BY 1"), digits=4)
def woe_applied(spark, d):
    b = book(spark, d).select("segment", "quantity", "defaulted")
    z = encode.apply_woe(b, encode.fit_woe(b, ["quantity"], "defaulted", 5), keep_original=False)
    return z.groupBy("segment").agg(F.avg("quantity_woe").alias("woe"))


@query("target_encoding", with_book("""
  WITH t AS (SELECT avg(defaulted) AS m FROM book), g AS (SELECT 'segment' AS "column", segment AS level, count(*) AS n, sum(defaulted) AS s FROM book GROUP BY 2
    UNION ALL SELECT 'quantity_band', coalesce(quantity_band, 'NA'), count(*), sum(defaulted) FROM book GROUP BY 2)
  SELECT "column", level, n, round((n * m * (1 - m) / (n * m * (1 - m) + s / n * (1 - s / n))) * s / n + (1 - n * m * (1 - m) / (n * m * (1 - m) + s / n * (1 - s / n))) * m, 6) AS encoding FROM g, t"""))
def target_encoding(spark, d):
    return encode.fit_target_encoding(book(spark, d), ["segment", "quantity_band"], "defaulted")


@query("target_encoding_cross_fitted")
def target_encoding_cross_fitted(spark, d):
    b = book(spark, d).select(*KEY, "segment", "priority", "defaulted")
    out = encode.target_encode(b, ["segment", "priority"], "defaulted", KEY, 5)
    return out.groupBy("segment").agg(F.count("*").alias("n"), F.min("segment_te").alias("lo"), F.max("segment_te").alias("hi"), F.avg("priority_te").alias("priority_te"))


@query("engineering_effect")
def engineering_effect(spark, d):
    train, _ = windows(spark, d)
    z = engineer.apply_engineer(train, engineer.fit_engineer(train.select(*FEATURES), BOOK_SPEC), ["defaulted"])
    return association.engineering_effect(train, z, ["price", "balance", "total_to_balance"], "defaulted")


LOGISTIC = models.Candidate("logistic", "logistic", {"C": 0.08686, "max_iter": 50}, scale=True)
GBT = models.Candidate("gbt", "gbt", {"n_estimators": 5, "max_depth": 3, "learning_rate": 0.1, "subsample": 0.8, "scale_pos_weight": 2.0})
FOREST = models.Candidate("forest", "forest", {"n_estimators": 10, "max_depth": 6, "min_leaf": 50})


def _held_out(spark, d, candidate):
    train, test = windows(spark, d)
    out, _ = models.evaluate_candidate(candidate.name, train, test, candidate, BOOK_SPEC, "defaulted", FEATURES, KEY, 0.157)
    return out.drop("fit_s", "predict_ms_1k")


@query("logistic_oot", digits=4)
def logistic_oot(spark, d):
    return _held_out(spark, d, LOGISTIC)


@query("logistic_l1_oot", digits=4)
def logistic_l1_oot(spark, d):
    return _held_out(spark, d, models.Candidate("l1", "logistic", {"C": 0.05, "penalty": "l1", "class_weight": "balanced", "max_iter": 50}, scale=True))


@query("gbt_oot", digits=4)
def gbt_oot(spark, d):
    return _held_out(spark, d, GBT)


@query("forest_oot", digits=4)
def forest_oot(spark, d):
    return _held_out(spark, d, FOREST)


@query("importances", digits=4)
def importances(spark, d):
    train, _ = windows(spark, d)
    return models.fit_candidate(train, LOGISTIC, BOOK_SPEC, "defaulted", FEATURES).importances(spark)


@query("time_fold_scores", digits=4)
def time_fold_scores(spark, d):
    """Expanding-origin folds, every transform refitted inside each fold; pooled out-of-fold metrics last."""
    b = stored_book(spark, d, *KEY, F.substring("month", 1, 4).alias("year"), "defaulted", *FEATURES)
    folded = split.time_folds(b, "year", 2)
    metrics, oof = models.score_folds(folded, [0, 1], lambda t: models.fit_candidate(t, LOGISTIC, BOOK_SPEC, "defaulted", FEATURES), "defaulted", KEY, role="role")
    pooled = evaluate.classification_summary(oof, "score", "defaulted", 0.5).select(F.lit(-1).alias("fold"), "pr_auc", "roc_auc")
    return metrics.unionByName(pooled)


@query("hyperparameter_search", digits=4)
def hyperparameter_search(spark, d):
    train, _ = windows(spark, d)
    cand = models.Candidate("logistic", "logistic", {"max_iter": 30}, True, {"C": models.Space("float", 0.001, 100.0, log=True), "class_weight": models.Space("categorical", choices=("balanced", None))})
    trials, _ = models.search(train, cand, BOOK_SPEC, "defaulted", ["price", "quantity", "discount"], KEY, n_trials=2, folds=2)
    return trials


@query("isotonic_calibration", digits=4)
def isotonic_calibration(spark, d):
    b = book(spark, d).select(*KEY, "defaulted", (F.col("quantity") / 60).alias("score"))
    z = models.calibrate(b, "score", "defaulted", KEY, 3, "isotonic")(b)
    return evaluate.calibration_table(z, "calibrated", "defaulted")


@query("isotonic_fit", with_book("""
  WITH p AS (SELECT floor(price / 700) AS x, CAST(sum(defaulted) AS DOUBLE) AS t, CAST(count(*) AS DOUBLE) AS w FROM book GROUP BY 1),
  c AS (SELECT x, t, w, row_number() OVER (ORDER BY x) AS i, sum(t) OVER (ORDER BY x) AS ct, sum(w) OVER (ORDER BY x) AS cw FROM p),
  m AS (SELECT a.i AS j, b.i AS k, (b.ct - a.ct + a.t) / (b.cw - a.cw + a.w) AS mean FROM c a JOIN c b ON a.i <= b.i),
  l AS (SELECT c.i, m.j, min(m.mean) AS low FROM c JOIN m ON m.j <= c.i AND m.k >= c.i GROUP BY 1, 2),
  f AS (SELECT i, max(low) AS fitted FROM l GROUP BY 1)
  SELECT x AS score, round(fitted, 6) AS fitted FROM c JOIN f USING (i)"""))
def isotonic_fit(spark, d):
    """The fit at every score is the largest of the smallest means of stretches around it; the pools tell the same."""
    b = book(spark, d).select("defaulted", F.floor(F.col("price") / 700).cast("double").alias("score"))
    return isotonic.read_at(b, "score", isotonic.fit(b, "score", "defaulted"), name="fitted")


@query("platt_calibration", digits=4)
def platt_calibration(spark, d):
    b = book(spark, d).select(*KEY, "defaulted", (F.col("quantity") / 60).alias("score"))
    z = models.calibrate(b, "score", "defaulted", KEY, 3, "sigmoid")(b)
    return evaluate.calibration_table(z, "calibrated", "defaulted")


@query("foreign_model_scores", with_book("SELECT segment, round(avg(0.5 * discount + 0.01 * quantity), 6) AS score FROM book GROUP BY 1"))
def foreign_model_scores(spark, d):
    """Any callable over a pandas frame scores the table in Arrow batches."""
    out = models.score_with(book(spark, d).select("segment", "discount", "quantity"), lambda x: 0.5 * x["discount"] + 0.01 * x["quantity"], ["discount", "quantity"])
    return out.groupBy("segment").agg(F.avg("score").alias("score"))


@query("smote_sample", digits=4)
def smote_sample(spark, d):
    b = book(spark, d).select(*KEY, "defaulted", "quantity", "discount", "tax")
    made = smote(b, "defaulted", ["quantity", "discount", "tax"], KEY, k=5, ratio=1.0)
    return made.groupBy("defaulted", "synthetic").agg(F.count("*").alias("n"), F.avg("quantity").alias("quantity"), F.avg("discount").alias("discount"))
