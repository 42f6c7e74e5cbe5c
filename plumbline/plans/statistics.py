"""Queries over profiles, distributions, associations and cohorts."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import finite
from plumbline.operators import association, planning, profile, ranking, resampling
from plumbline.operators.quantiles import exact_quantiles
from plumbline.plans.book import BOOK_KEY, book, stored_book, table, with_book
from plumbline.plans.preparation import WILSON
from plumbline.plans.registry import query
from plumbline.session import written

KEY = list(BOOK_KEY)
NUMERIC = ["price", "total", "quantity", "balance"]


def union_sql(cols, template: str) -> str:
    return " UNION ALL ".join(template.format(c=c) for c in cols)


@query("column_profile", union_sql(
    [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"), ("c_mktsegment", "string")],
    "SELECT '{c[0]}' AS \"column\", '{c[1]}' AS type, count(*) - count({c[0]}) AS nulls, CAST(0 AS DOUBLE) AS pct_null, count(DISTINCT {c[0]}) AS \"distinct\" FROM customer"))
def column_profile(spark, d):
    return profile.profile(table(spark, d, "customer"), exact=True).select(
        "column", "type", "nulls", "pct_null", F.col("distinct").cast("long").alias("distinct"))


@query("base_rate", with_book("SELECT count(*) AS n, CAST(sum(defaulted) AS BIGINT) AS cases, round(avg(defaulted), 6) AS rate FROM book"))
def base_rate(spark, d):
    return profile.base_rate(book(spark, d), "defaulted")


DESCRIBE = """SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 4) AS mean, round(median({c}), 4) AS median,
  (SELECT round(x, 4) FROM (SELECT {c} AS x, count(*) AS k FROM book WHERE {c} IS NOT NULL GROUP BY 1) ORDER BY k DESC, x LIMIT 1) AS mode,
  min({c}) AS min, max({c}) AS max, round(max({c}) - min({c}), 4) AS range, round(quantile_cont({c}, 0.25), 4) AS q1, round(quantile_cont({c}, 0.75), 4) AS q3,
  round(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 4) AS iqr, round(var_samp({c}), 2) AS variance, round(stddev_samp({c}), 4) AS sd,
  round(stddev_samp({c}) / avg({c}), 4) AS cv, round(skewness({c}), 4) AS skew, round(kurtosis({c}), 4) AS kurtosis FROM book"""


@query("describe_numeric", with_book(union_sql(NUMERIC, DESCRIBE)), digits=4)
def describe_numeric(spark, d):
    return profile.describe(book(spark, d).select(*NUMERIC), NUMERIC).withColumn("variance", F.round("variance", 2))


@query("shape_classes", union_sql(["value"], """
  WITH m AS (SELECT skewness({c}) AS a, kurtosis({c}) AS k, skewness(ln(1 + {c})) AS la FROM events),
    s AS (SELECT max(n) / sum(n) AS share FROM (SELECT {c}, count(*) AS n FROM events GROUP BY 1))
  SELECT '{c}' AS "column", round(a, 4) AS skew, round(k, 4) AS kurtosis, round(la, 4) AS skew_log1p, round(share, 4) AS mode_share,
    CASE WHEN share > 0.9 THEN 'quasi-constant' WHEN abs(a) < 0.5 AND abs(k) < 1 THEN 'symmetric' WHEN a <= -0.5 THEN 'left-skewed'
      WHEN abs(la) < abs(a) / 2 THEN 'right-skewed, log fixes' ELSE 'right-skewed, heavy tail' END AS shape FROM m, s"""), digits=4)
def shape_classes(spark, d):
    return profile.shape_class(table(spark, d, "events"), ["value"])


NORMAL_SQL = """SELECT '{c}' AS "column", n, k2 FROM (SELECT n, z1 * z1 + z2 * z2 AS k2 FROM (SELECT n,
    1 / sqrt(ln(sqrt(sqrt(2 * (b2 - 1)) - 1))) * asinh(y / sqrt(2 / (sqrt(2 * (b2 - 1)) - 2))) AS z1,
    (1 - 2 / (9 * a) - sign(1 + x * sqrt(2 / (a - 4))) * cbrt((1 - 2 / a) / abs(1 + x * sqrt(2 / (a - 4))))) / sqrt(2 / (9 * a)) AS z2
  FROM (SELECT n, y, b2, x, 6 + 8 / th * (2 / th + sqrt(1 + 4 / (th * th))) AS a FROM (SELECT n, g1 * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) AS y,
      3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) AS b2,
      (g2 - 3 * (n - 1) / (n + 1)) / sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))) AS x,
      6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS th
    FROM (SELECT CAST(count({c}) AS DOUBLE) AS n, avg(power({c} - mu, 3)) / power(avg(power({c} - mu, 2)), 1.5) AS g1, avg(power({c} - mu, 4)) / power(avg(power({c} - mu, 2)), 2) AS g2
      FROM events, (SELECT avg({c}) AS mu FROM events))))))"""


@query("normality_test", "SELECT \"column\", CAST(n AS BIGINT) AS n, round(k2, 2) AS k2, round(exp(-k2 / 2), 2) AS p_value FROM (" + NORMAL_SQL.format(c="value") + ")", digits=2)
def normality_test(spark, d):
    return profile.normality(table(spark, d, "events"), ["value"])


@query("frequency_tables", union_sql(["o_orderpriority", "o_orderstatus"], """
  SELECT '{c}' AS "column", CASE WHEN {c} = 'O' THEN NULL ELSE {c} END AS level, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM orders), 6) AS pct FROM orders GROUP BY 2"""))
def frequency_tables(spark, d):
    o = table(spark, d, "orders").withColumn("o_orderstatus", F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus")))
    return profile.frequencies(o, ["o_orderpriority", "o_orderstatus"])


@query("histogram", """
  WITH b AS (SELECT min(o_totalprice) AS lo, (max(o_totalprice) - min(o_totalprice)) / 40 AS w FROM orders),
    x AS (SELECT least(CAST(floor((o_totalprice - lo) / w) AS INT), 39) AS bin, lo, w FROM orders, b)
  SELECT bin, round(lo + bin * w, 4) AS lo, round(lo + (bin + 1) * w, 4) AS hi, false AS log_scale, count(*) AS n FROM x GROUP BY bin, x.lo, w""", digits=4)
def histogram(spark, d):
    return profile.histogram(table(spark, d, "orders"), "o_totalprice", 40)


@query("histogram_log", """
  WITH v AS (SELECT log10(power(l_extendedprice, 8) + 1) AS x FROM lineitem WHERE l_extendedprice > 0),
    b AS (SELECT min(x) AS lo, (max(x) - min(x)) / 20 AS w FROM v)
  SELECT least(CAST(floor((x - lo) / w) AS INT), 19) AS bin, true AS log_scale, count(*) AS n FROM v, b GROUP BY 1""")
def histogram_log(spark, d):
    t = table(spark, d, "lineitem").where("l_extendedprice > 0").select(F.pow("l_extendedprice", F.lit(8.0)).alias("steep"))
    return profile.histogram(t, "steep", 20).select("bin", "log_scale", "n")


@query("ecdf_points", """
  SELECT l_quantity AS value, count(*) AS n, round(sum(count(*)) OVER (ORDER BY l_quantity) / sum(count(*)) OVER (), 6) AS share FROM lineitem GROUP BY 1""")
def ecdf_points(spark, d):
    return ranking.ecdf(table(spark, d, "lineitem"), "l_quantity")


@query("ecdf_continuous", """
  WITH c AS (SELECT o_orderpriority, o_totalprice AS value, count(*) AS n FROM orders GROUP BY ALL)
  SELECT o_orderpriority, value, n, round(sum(n) OVER (PARTITION BY o_orderpriority ORDER BY value) / sum(n) OVER (PARTITION BY o_orderpriority), 6) AS share FROM c""")
def ecdf_continuous(spark, d):
    return ranking.ecdf(table(spark, d, "orders"), "o_totalprice", ["o_orderpriority"])


@query("iqr_outliers", union_sql(["value"], """
  WITH q AS (SELECT quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS fence, quantile_cont({c}, 0.99) AS p99 FROM events)
  SELECT '{c}' AS "column", count({c}) AS n, round(max(fence), 6) AS fence, count(*) FILTER (WHERE {c} > fence) AS outliers, round(count(*) FILTER (WHERE {c} > fence) * 100.0 / count({c}), 6) AS pct,
    round(max(p99), 6) AS p99, max({c}) AS max, round(max({c}) / max(p99), 6) AS max_over_p99 FROM events, q"""))
def iqr_outliers(spark, d):
    return profile.iqr_outliers(table(spark, d, "events"), ["value"])


@query("wilson_by_band", with_book(f"""
  WITH g AS (SELECT quantity_band, count(*) AS n, CAST(sum(defaulted) AS BIGINT) AS cases FROM book WHERE quantity_band IS NOT NULL GROUP BY 1)
  SELECT quantity_band, n, cases, {WILSON} FROM g"""))
def wilson_by_band(spark, d):
    return profile.group_rate(book(spark, d), ["quantity_band"], "defaulted")


@query("lift_by_priority", with_book(f"""
  WITH g AS (SELECT priority, count(*) AS n, CAST(sum(defaulted) AS BIGINT) AS cases FROM book GROUP BY 1)
  SELECT priority, n, cases, {WILSON}, round(cases / n / (SELECT avg(defaulted) FROM book), 6) AS lift FROM g"""))
def lift_by_priority(spark, d):
    return profile.lift(book(spark, d), ["priority"], "defaulted")


LEVELS = ["segment", "priority", "status", "quantity_band"]


@query("lift_grouping_sets", with_book("WITH g AS (" + union_sql(LEVELS, "SELECT '{c}' AS \"column\", {c} AS level, count(*) AS n, CAST(sum(defaulted) AS BIGINT) AS cases FROM book WHERE {c} IS NOT NULL GROUP BY 2")
       + f") SELECT \"column\", level, n, cases, {WILSON}, round(cases / n / (SELECT avg(defaulted) FROM book), 6) AS lift FROM g"))
def lift_grouping_sets(spark, d):
    return profile.level_lifts(book(spark, d), LEVELS, "defaulted")


@query("wilson_pivot", with_book("SELECT segment, " + ", ".join(
    f"round(avg(defaulted) FILTER (WHERE status = '{s}'), 6) AS \"{s}_rate\", count(*) FILTER (WHERE status = '{s}') AS \"{s}_n\"" for s in "FOP") + " FROM book GROUP BY 1"))
def wilson_pivot(spark, d):
    return profile.rate_pivot(book(spark, d), "segment", "status", "defaulted", ["F", "O", "P"])


@query("qcut_terciles", with_book("""
  WITH q AS (SELECT quantile_cont(price, 1/3) AS a, quantile_cont(price, 2/3) AS b FROM book)
  SELECT CASE WHEN price <= a THEN 'low' WHEN price <= b THEN 'mid' ELSE 'high' END AS tercile, count(*) AS n, round(avg(defaulted), 6) AS rate FROM book, q GROUP BY 1"""))
def qcut_terciles(spark, d):
    b = profile.qcut(book(spark, d).select("price", "defaulted"), "price", 3, ["low", "mid", "high"], "tercile")
    return b.groupBy("tercile").agg(F.count("*").alias("n"), F.avg("defaulted").alias("rate"))


@query("fixed_cut", "SELECT CASE WHEN p_size <= 0 THEN NULL WHEN p_size <= 12 THEN 'S' WHEN p_size <= 24 THEN 'M' WHEN p_size <= 40 THEN 'L' END AS size, count(*) AS n FROM part GROUP BY 1")
def fixed_cut(spark, d):
    return profile.cut(table(spark, d, "part"), "p_size", (0, 12, 24, 40), ("S", "M", "L"), "size").groupBy("size").agg(F.count("*").alias("n"))


MW = """t{c} AS (SELECT {c} AS s, count(*) AS n, sum(defaulted) AS p FROM book WHERE {c} IS NOT NULL GROUP BY 1), c{c} AS (SELECT *, sum(n - p) OVER (ORDER BY s) - (n - p) AS nb FROM t{c}),
  u{c} AS (SELECT sum(p * (nb + (n - p) / 2.0)) AS u, CAST(sum(p) AS DOUBLE) AS n1, CAST(sum(n - p) AS DOUBLE) AS n0, sum(CAST(n AS DOUBLE) * n * n - n) AS ties FROM c{c})"""
MW_ROW = """SELECT '{c}' AS "column", round(u, 6) AS u, CAST(n1 AS BIGINT) AS n_pos, CAST(n0 AS BIGINT) AS n_neg, round(u / (n1 * n0), 6) AS effect,
  round(greatest((abs(u - n1 * n0 / 2) - 0.5) / sqrt(n1 * n0 / 12 * ((n1 + n0 + 1) - ties / ((n1 + n0) * (n1 + n0 - 1)))), 0), 6) AS z FROM u{c}"""


@query("mann_whitney", with_book("WITH " + ", ".join(MW.format(c=c) for c in NUMERIC) + " " + union_sql(NUMERIC, MW_ROW)))
def mann_whitney(spark, d):
    return association.mann_whitney_stats(book(spark, d), NUMERIC, "defaulted")


CHI = """SELECT '{c}' AS "column", {c} AS level, count(*) AS n, sum(defaulted) AS p FROM book WHERE {c} IS NOT NULL GROUP BY 2"""
CHI_SQL = """, w AS (SELECT *, sum(n) OVER (PARTITION BY "column") AS tn, sum(p) OVER (PARTITION BY "column") AS tp, count(*) OVER (PARTITION BY "column") - 1 AS dof FROM g),
  e AS (SELECT *, n * tp / tn AS e1, n * (tn - tp) / tn AS e0, CASE WHEN dof = 1 THEN 0.5 ELSE 0 END AS fix FROM w),
  x AS (SELECT "column", max(dof) AS dof, max(tp) AS tp, max(tn) AS tn, sum(power(abs(p - e1) - least(fix, abs(p - e1)), 2) / e1 + power(abs(n - p - e0) - least(fix, abs(n - p - e0)), 2) / e0) AS chi2 FROM e GROUP BY 1)
  SELECT "column", round(chi2, 6) AS chi2, dof, round(sqrt(chi2 / tn), 6) AS cramers_v, CAST(tp AS BIGINT) AS n_pos, CAST(tn - tp AS BIGINT) AS n_neg FROM x"""
CATEGORICAL = ["segment", "priority", "status", "quantity_band", "missing_balance"]


@query("chi_square_table", with_book("WITH g AS (" + union_sql(CATEGORICAL, CHI.replace("{c} AS level", "CAST({c} AS VARCHAR) AS level")) + ")" + CHI_SQL))
def chi_square_table(spark, d):
    return association.chi_square_stats(book(spark, d), CATEGORICAL, "defaulted")


# erfc by the series of erf, which is plenty for the moderate values of these tables
ERFC = "1 - 2 / sqrt(pi()) * list_sum(list_transform(range(0, 80), lambda i: (CASE WHEN i % 2 = 0 THEN 1 ELSE -1 END) * power({x}, 2 * i + 1) / (gamma(i + 1) * (2 * i + 1))))"


@query("bivariate_rank", with_book("WITH " + ", ".join(MW.format(c=c) for c in NUMERIC) + ", g AS (" + union_sql(CATEGORICAL, CHI.replace("{c} AS level", "CAST({c} AS VARCHAR) AS level")) + ")" + CHI_SQL.replace(
    '  SELECT "column", round(chi2, 6)', '  , z AS (SELECT "column", round(chi2, 6)') + "), mw AS (" + union_sql(NUMERIC, MW_ROW) + """), pv AS (
  SELECT "column", 'numeric' AS kind, u AS statistic, """ + ERFC.format(x="(z / sqrt(2))") + """ AS p_value, effect, abs(effect - 0.5) * 2 AS strength, n_pos, n_neg FROM mw
  UNION ALL SELECT "column", 'categorical', chi2, CASE dof WHEN 1 THEN """ + ERFC.format(x="sqrt(chi2 / 2)") + """ WHEN 2 THEN exp(-chi2 / 2) WHEN 4 THEN exp(-chi2 / 2) * (1 + chi2 / 2) END, cramers_v, cramers_v, n_pos, n_neg FROM z)
  SELECT "column", kind, round(statistic, 3) AS statistic, round(p_value, 3) AS p_value, round(effect, 3) AS effect, round(strength, 3) AS strength, n_pos, n_neg, p_value < 0.05 / 9 AS significant FROM pv"""), digits=3)
def bivariate_rank(spark, d):
    return association.bivariate_rank(book(spark, d), NUMERIC, CATEGORICAL, "defaulted")


KS_SQL = """WITH t AS (SELECT {v} AS s, count(*) FILTER (WHERE {y} = 1) AS p, count(*) FILTER (WHERE {y} = 0) AS q FROM {src} WHERE {v} IS NOT NULL GROUP BY 1),
  c AS (SELECT *, sum(p) OVER (ORDER BY s) / sum(p) OVER () AS f1, sum(q) OVER (ORDER BY s) / sum(q) OVER () AS f0, lead(s) OVER (ORDER BY s) AS nx FROM t)"""


@query("ks_statistic", with_book(KS_SQL.format(v="price", y="defaulted", src="book") + """
  SELECT round(max(abs(f1 - f0)), 6) AS ks, round(sum(abs(f1 - f0) * coalesce(nx - s, 0)), 4) AS area, CAST(sum(p) AS BIGINT) AS n1, CAST(sum(q) AS BIGINT) AS n0 FROM c"""))
def ks_statistic(spark, d):
    return ranking.ks_two_sample(book(spark, d), "price", "defaulted").withColumn("area", F.round("area", 4))


KS_EXACT_SQL = """
  WITH RECURSIVE v AS (SELECT n_regionkey AS region, floor(s_acctbal / 1000) AS x, s_suppkey % 2 AS side FROM supplier JOIN nation ON s_nationkey = n_nationkey),
  g AS (SELECT region, x, sum(side) AS p, count(*) AS n FROM v GROUP BY 1, 2),
  c AS (SELECT region, x, sum(p) OVER w AS cp, sum(n) OVER w AS cn, sum(p) OVER r AS n1, sum(n) OVER r - sum(p) OVER r AS n0 FROM g
    WINDOW w AS (PARTITION BY region ORDER BY x), r AS (PARTITION BY region)),
  k AS (SELECT region, CAST(max(n1) AS BIGINT) AS n1, CAST(max(n0) AS BIGINT) AS n0, max(abs(cp / n1 - (cn - cp) / n0)) AS ks, list(cn) AS ends FROM c GROUP BY 1),
  walk AS (
    SELECT region, n1, n0, ks, ends, CAST(round(ks * n1 * n0) AS BIGINT) AS reach, CAST(0 AS BIGINT) AS t,
      list_transform(range(0, n1 + 1), lambda i: CASE WHEN i = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS p, 0.0::DOUBLE AS hit FROM k
    UNION ALL
    SELECT region, n1, n0, ks, ends, reach, t + 1,
      list_transform(range(0, n1 + 1), lambda i: CASE WHEN list_contains(ends, t + 1) AND abs(i * n0 - (t + 1 - i) * n1) >= reach THEN 0.0::DOUBLE ELSE q[i + 1] END),
      hit + list_sum(list_transform(range(0, n1 + 1), lambda i: CASE WHEN list_contains(ends, t + 1) AND abs(i * n0 - (t + 1 - i) * n1) >= reach THEN q[i + 1] ELSE 0.0::DOUBLE END))
    FROM (SELECT *, list_transform(range(0, n1 + 1), lambda i: (p[i + 1] * greatest(n0 - t + i, 0) + coalesce(p[i], 0) * (n1 - i + 1)) / (n1 + n0 - t)) AS q FROM walk WHERE t < n1 + n0))
  SELECT region, round(ks, 6) AS ks, n1, n0, round(least(hit, 1), 6) AS p_value FROM walk WHERE t = n1 + n0"""


@query("ks_exact_by_region", KS_EXACT_SQL)
def ks_exact_by_region(spark, d):
    """Balances of suppliers with odd and even keys in each region, in thousands, so that values tie: a few hundred rows take the exact law."""
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    rows = s.select(F.col("n_regionkey").alias("region"), F.floor(F.col("s_acctbal") / 1000).cast("double").alias("x"), (F.col("s_suppkey") % 2).cast("int").alias("side"))
    return association.ks_test(rows, "x", "side", ["region"], "auto").select("region", "ks", "n1", "n0", "p_value")


@query("ks_test", with_book(KS_SQL.format(v="price", y="defaulted", src="book") + """, k AS (SELECT max(abs(f1 - f0)) AS ks, sum(abs(f1 - f0) * coalesce(nx - s, 0)) AS area, sum(p) AS n1, sum(q) AS n0 FROM c),
  x AS (SELECT *, ks * sqrt(n1 * n0 / (n1 + n0)) AS z FROM k)
  SELECT round(ks, 6) AS ks, round(area, 4) AS area, CAST(n1 AS BIGINT) AS n1, CAST(n0 AS BIGINT) AS n0,
    round(2 * list_sum(list_transform(range(1, 101), lambda i: (CASE WHEN i % 2 = 1 THEN 1 ELSE -1 END) * exp(-2 * CAST(i * i AS DOUBLE) * z * z))), 6) AS p_value FROM x"""))
def ks_test(spark, d):
    return association.ks_test(book(spark, d), "price", "defaulted").withColumn("area", F.round("area", 4))


@query("missing_effect", with_book("WITH g AS (" + union_sql(["balance", "quantity_band"], """
  SELECT '{c}' AS "column", {c} IS NULL AS absent, count(*) AS n, sum(defaulted) AS p FROM book GROUP BY 2""") + """), w AS (SELECT *, sum(n) OVER (PARTITION BY "column") AS tn, sum(p) OVER (PARTITION BY "column") AS tp,
    count(*) OVER (PARTITION BY "column") - 1 AS dof FROM g),
  e AS (SELECT *, n * tp / tn AS e1, n * (tn - tp) / tn AS e0 FROM w)
  SELECT "column", CAST(coalesce(sum(n) FILTER (WHERE absent), 0) AS BIGINT) AS n_absent, round(sum(p) FILTER (WHERE absent) / sum(n) FILTER (WHERE absent), 6) AS rate_absent,
    round(sum(p) FILTER (WHERE NOT absent) / sum(n) FILTER (WHERE NOT absent), 6) AS rate_present,
    CASE WHEN max(dof) > 0 THEN round(sum(power(abs(p - e1) - least(0.5, abs(p - e1)), 2) / e1 + power(abs(n - p - e0) - least(0.5, abs(n - p - e0)), 2) / e0), 6) END AS chi2, max(dof) AS dof
  FROM e GROUP BY 1"""))
def missing_effect(spark, d):
    return association.missing_effect_stats(book(spark, d), ["balance", "quantity_band"], "defaulted")


@query("missing_sign_test", with_book("WITH e AS (" + union_sql(["balance", "total_to_balance"], "SELECT '{c}' AS c, avg(defaulted) FILTER (WHERE {c} IS NULL) > avg(defaulted) FILTER (WHERE {c} IS NOT NULL) AS h FROM book") + """),
  k AS (SELECT count(*) FILTER (WHERE h) AS higher, count(*) AS n FROM e)
  SELECT higher, n AS columns, round(list_sum(list_transform(range(higher, n + 1), lambda i: gamma(n + 1) / (gamma(i + 1) * gamma(n - i + 1)) / power(2, n))), 6) AS p_value FROM k"""))
def missing_sign_test(spark, d):
    return association.missing_sign_test(association.missing_effect(book(spark, d), ["balance", "total_to_balance"], "defaulted"))


@query("missing_lift_ci")
def missing_lift_ci(spark, d):
    return resampling.missing_lift_ci(book(spark, d), ["missing_balance"], "defaulted", KEY, 200)


TREND_SQL = f"""WITH g AS (SELECT month, count(*) AS n, CAST(sum(defaulted) AS BIGINT) AS cases FROM book GROUP BY 1), m AS (SELECT max(month) AS last FROM g WHERE n >= 700),
  v AS (SELECT month, n, cases, {WILSON}, month <= last AS mature, CAST(row_number() OVER (ORDER BY month) - 1 AS INT) AS position, cases / n AS raw FROM g, m)"""


@query("vintage_trend", with_book(TREND_SQL + " SELECT month, n, cases, rate, lo, hi, mature, position FROM v"))
def vintage_trend(spark, d):
    return association.vintage_trend(book(spark, d), "month", "defaulted", 700)


@query("trend_correlation", with_book(TREND_SQL + """, s AS (SELECT 'all' AS months, position, raw FROM v UNION ALL SELECT 'mature', position, raw FROM v WHERE mature),
  r AS (SELECT months, rank() OVER (PARTITION BY months ORDER BY position) AS a, rank() OVER (PARTITION BY months ORDER BY raw) + (count(*) OVER (PARTITION BY months, raw) - 1) / 2.0 AS b FROM s)
  SELECT months, round(corr(a, b), 6) AS rho, count(*) AS n FROM r GROUP BY 1"""))
def trend_correlation(spark, d):
    return association.trend_correlation(association.vintage_trend(book(spark, d), "month", "defaulted", 700)).select("months", "rho", "n")


@query("maturity_by_month", with_book("""
  SELECT month, count(*) AS loans, CAST(sum(defaulted) AS BIGINT) AS defaults, round(avg(defaulted), 6) AS rate, round(avg(quantity), 6) AS mean_term,
    round(avg(CASE WHEN quantity > 12 THEN 1.0 ELSE 0.0 END), 6) AS share_long FROM book GROUP BY 1"""))
def maturity_by_month(spark, d):
    return profile.maturity(book(spark, d), "month", "defaulted", "quantity")


def _month_number(df):
    m = F.col("month")
    return df.withColumn("t", (F.substring(m, 1, 4).cast("int") - 1995) * 12 + F.substring(m, 6, 2).cast("int") - 1)


@query("month_slope")
def month_slope(spark, d):
    return association.month_slope(_month_number(book(spark, d)), "t", "defaulted", ["segment"])


@query("month_slope_ci")
def month_slope_ci(spark, d):
    q = F.col("quantity")
    return resampling.month_slope_ci(_month_number(book(spark, d)), "t", "defaulted", KEY, {"all": F.lit(True), "short": q <= 12, "shortest": q <= 6}, 100)


def spearman_sql(a: str, b: str) -> str:
    return f"""SELECT '{a}' AS a, '{b}' AS b, round(corr(x, y), 6) AS rho, count(*) AS n FROM (SELECT rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2.0 AS x,
    rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2.0 AS y FROM book WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"""


PAIRS = [(a, b) for i, a in enumerate(NUMERIC) for b in NUMERIC[i + 1:]]


@query("spearman_pairs", with_book(" UNION ALL ".join(spearman_sql(a, b) for a, b in PAIRS)))
def spearman_pairs(spark, d):
    return association.spearman(book(spark, d), NUMERIC)


RED = ["price", "quantity", "price_to_total"]


@query("redundant_pairs", with_book("WITH c AS (" + " UNION ALL ".join(spearman_sql(a, b) for a, b in (("price", "quantity"), ("price", "price_to_total"), ("quantity", "price_to_total"))) + """),
  s AS (SELECT * FROM (VALUES ('price', CAST(0.3 AS DOUBLE)), ('quantity', 0.1), ('price_to_total', 0.5)) AS v(c, s))
  SELECT a, b, rho, x.s AS strength_a, y.s AS strength_b, CASE WHEN x.s >= y.s THEN a ELSE b END AS keep, CASE WHEN x.s >= y.s THEN b ELSE a END AS "drop"
  FROM c JOIN s x ON a = x.c JOIN s y ON b = y.c WHERE abs(rho) >= 0.5"""))
def redundant_pairs(spark, d):
    corr = written(association.spearman(book(spark, d), RED).drop("n"), "pairs")  # read twice
    strength = corr.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(s).alias("strength")) for c, s in zip(RED, (0.3, 0.1, 0.5))])).alias("_s")).select("_s.*").dropDuplicates()
    return association.redundant_pairs(corr, strength, 0.5)


SEG = "concat_ws(' / ', quantity_band, priority, status)"


@query("segment_top_bottom", with_book(f"""
  WITH g AS (SELECT {SEG} AS segment, count(*) AS n, CAST(sum(defaulted) AS BIGINT) AS cases FROM book GROUP BY 1 HAVING count(*) >= 100),
    r AS (SELECT segment, n, cases, {WILSON}, round(cases / n / (SELECT avg(defaulted) FROM book), 6) AS lift, cases / n AS raw FROM g),
    a AS (SELECT *, 'riskiest' AS "end" FROM r ORDER BY raw DESC, segment LIMIT 5), b AS (SELECT *, 'safest' AS "end" FROM r ORDER BY raw, segment DESC LIMIT 5)
  SELECT * EXCLUDE (raw) FROM a UNION ALL SELECT * EXCLUDE (raw) FROM b"""))
def segment_top_bottom(spark, d):
    return profile.segments(book(spark, d), ["quantity_band", "priority", "status"], "defaulted", 100, 5)


@query("max_value_leak", with_book("""
  SELECT quantity = (SELECT max(quantity) FROM book) AS at_max, count(*) AS n, round(100 * avg(defaulted), 6) AS pct_event, round(100 - 100 * avg(defaulted), 6) AS pct_clear FROM book GROUP BY 1"""))
def max_value_leak(spark, d):
    return profile.max_value_leak(book(spark, d), "quantity", "defaulted")


@query("transform_plan")
def transform_plan(spark, d):
    cols = ["price", "quantity", "balance", "total_to_balance", "segment", "priority", "missing_balance", "defaulted", "month"]
    return planning.transform_plan(book(spark, d).select(*cols), ["price", "quantity", "balance", "total_to_balance"], {"defaulted": "target", "month": "cohort control"}, ordered=["priority"])


@query("univariate_auc", with_book("WITH md AS (SELECT " + ", ".join(f"median({c}) AS m_{c}" for c in NUMERIC) + " FROM book), l AS (" + union_sql(NUMERIC, "SELECT '{c}' AS \"column\", substr(month, 1, 4) AS yr, coalesce({c}, m_{c}) AS s, defaulted AS y, CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END AS gap FROM book, md") + """),
  a AS (SELECT *, rank() OVER (PARTITION BY "column" ORDER BY s) + (count(*) OVER (PARTITION BY "column", s) - 1) / 2.0 AS r, rank() OVER (PARTITION BY "column", yr ORDER BY s) + (count(*) OVER (PARTITION BY "column", yr, s) - 1) / 2.0 AS ry FROM l),
  w AS (SELECT "column", (sum(r) FILTER (WHERE y = 1) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y))) AS auc, avg(gap) AS missing FROM a GROUP BY 1),
  v AS (SELECT "column", yr, (sum(ry) FILTER (WHERE y = 1) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y))) AS ya FROM a GROUP BY ALL)
  SELECT "column", round(max(auc), 6) AS auc, round(max(missing), 6) AS missing, count(*) AS months, count(*) FILTER (WHERE (ya > 0.5) = (auc > 0.5)) AS months_same_sign,
    CASE WHEN max(auc) > 0.5 THEN '+' ELSE '-' END AS direction, round(abs(max(auc) - 0.5), 6) AS strength FROM w JOIN v USING ("column") GROUP BY 1"""))
def univariate_auc(spark, d):
    b = book(spark, d).withColumn("year", F.substring("month", 1, 4))
    return association.univariate_auc(b, NUMERIC, "defaulted", "year")


@query("univariate_audit")
def univariate_audit(spark, d):
    """One row per numeric column: univariate AUC with its bootstrap interval, direction, share of missing and years of the same sign.
    Gaps are filled with the median in both."""
    b = stored_book(spark, d, *KEY, "defaulted", F.substring("month", 1, 4).alias("year"), *NUMERIC)
    median = exact_quantiles(b, NUMERIC, [0.5])
    filled = b.select(*KEY, "defaulted", *[F.coalesce(finite(c), F.lit(median[c][0])).alias(c) for c in NUMERIC])
    rows = []
    for c in NUMERIC:  # what a column shuffles is gone before the next begins
        interval = written(resampling.bootstrap_ci(filled, c, "defaulted", KEY, ("roc_auc",), 50, 0).select(F.lit(c).alias("column"), "*"), "interval")
        audit = association.univariate_auc(b, [c], "defaulted", "year")
        rows.append(written(interval.join(audit.select("column", "missing", "months", "months_same_sign", "direction", "strength"), "column"), "audit"))
    return functools.reduce(DataFrame.unionByName, rows)


@query("level_rates", with_book("WITH g AS (" + union_sql(["segment", "status"], "SELECT '{c}' AS \"column\", {c} AS level, count(*) AS n, avg(defaulted) AS rate FROM book GROUP BY 2") + ") SELECT \"column\", level, n, round(rate, 6) AS rate FROM g"))
def level_rates(spark, d):
    return profile.level_lifts(book(spark, d), ["segment", "status"], "defaulted").select("column", "level", "n", "rate")
