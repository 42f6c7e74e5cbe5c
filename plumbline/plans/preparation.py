"""Queries over cleaning, validation and derivation."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline import loan
from plumbline.functions import columns as C
from plumbline.operators import clean, derive, profile, publish, validate
from plumbline.plans.book import book, raw_loans, table, with_book, with_loans
from plumbline.plans.registry import query
from plumbline.session import ensure_checkpoint_dir
from plumbline.sources import paths
from plumbline.spec import entity_frame, features, uncovered_columns, view

RATE_SQL = """{rate} AS rate,
  round(({rate_raw} + 3.8416 / (2 * n)) / (1 + 3.8416 / n) - 1.96 / (1 + 3.8416 / n) * sqrt({rate_raw} * (1 - {rate_raw}) / n + 3.8416 / (4.0 * n * n)), 6) AS lo,
  round(({rate_raw} + 3.8416 / (2 * n)) / (1 + 3.8416 / n) + 1.96 / (1 + 3.8416 / n) * sqrt({rate_raw} * (1 - {rate_raw}) / n + 3.8416 / (4.0 * n * n)), 6) AS hi"""
WILSON = RATE_SQL.format(rate="round(cases / n, 6)", rate_raw="(cases / n)")


@query("group_rate_by_segment", with_book(f"""
  WITH g AS (SELECT segment, missing_balance, count(*) AS n, CAST(sum(defaulted) AS BIGINT) AS cases FROM book GROUP BY ALL)
  SELECT segment, missing_balance, n, cases, {WILSON} FROM g"""))
def group_rate_by_segment(spark, d):
    return profile.group_rate(book(spark, d), ["segment", "missing_balance"], "defaulted")


@query("affordability_ratios", """
  SELECT o_orderkey, round(o_totalprice / CASE WHEN c_acctbal > 0 THEN c_acctbal END, 6) AS total_over_balance,
    round(c_acctbal / NULLIF(o_totalprice, 0), 6) AS balance_over_total
  FROM orders JOIN customer ON o_custkey = c_custkey""")
def affordability_ratios(spark, d):
    j = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    j = j.withColumn("income", C.null_where("c_acctbal", F.col("c_acctbal") <= 0))
    out = derive.affordability(j, {"total_over_balance": "o_totalprice"}, "income")
    return out.select("o_orderkey", "total_over_balance", C.ratio("c_acctbal", "o_totalprice").alias("balance_over_total"))


@query("quantity_bands", """
  SELECT CASE WHEN l_quantity <= 0 THEN NULL WHEN l_quantity <= 10 THEN '01-10' WHEN l_quantity <= 20 THEN '11-20'
      WHEN l_quantity <= 30 THEN '21-30' WHEN l_quantity <= 40 THEN '31-40' END AS band, count(*) AS n,
    min(l_quantity) AS lo, max(l_quantity) AS hi
  FROM lineitem GROUP BY 1""")
def quantity_bands(spark, d):
    b = C.band("l_quantity", (0, 10, 20, 30, 40), ("01-10", "11-20", "21-30", "31-40"))
    return table(spark, d, "lineitem").groupBy(b.alias("band")).agg(
        F.count("*").alias("n"), F.min("l_quantity").alias("lo"), F.max("l_quantity").alias("hi"))


@query("vintage_counts", "SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1")
def vintage_counts(spark, d):
    return profile.volume(table(spark, d, "orders").select(C.vintage("o_orderdate").alias("month")), "month")


@query("volume_summary", """
  WITH v AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1)
  SELECT (SELECT month FROM v ORDER BY n DESC, month DESC LIMIT 1) AS peak, max(n) AS peak_n, CAST(sum(n) AS BIGINT) AS n,
    (SELECT CAST(sum(n) AS BIGINT) FROM (SELECT n FROM v ORDER BY month DESC LIMIT 4)) AS tail_n FROM v""")
def volume_summary(spark, d):
    return profile.volume_summary(table(spark, d, "orders").select(C.vintage("o_orderdate").alias("month")), "month")


@query("null_sentinels", """
  SELECT count(*) AS n, count(*) FILTER (WHERE NOT c_acctbal BETWEEN 0 AND 9000) AS outside,
    count(*) FILTER (WHERE c_acctbal <= 0 OR c_acctbal > 9500) AS nulled,
    count(*) FILTER (WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')) AS unlisted FROM customer""")
def null_sentinels(spark, d):
    a = F.col("c_acctbal")
    c = table(spark, d, "customer").select(
        C.null_outside(a, 0, 9000).alias("o"), C.null_where(a, (a <= 0) | (a > 9500)).alias("w"),
        C.null_unless_in("c_mktsegment", ["BUILDING", "MACHINERY"]).alias("u"))
    return c.agg(F.count("*").alias("n"), *[F.count_if(F.col(x).isNull()).alias(y) for x, y in (("o", "outside"), ("w", "nulled"), ("u", "unlisted"))])


@query("sentinel_report", """
  SELECT 'c_acctbal' AS column, CAST(0 AS BIGINT) AS before, count(*) FILTER (WHERE c_acctbal <= 0) AS after, count(*) FILTER (WHERE c_acctbal <= 0) AS converted FROM customer
  UNION ALL SELECT 'c_mktsegment', 0, count(*) FILTER (WHERE c_mktsegment = 'FURNITURE'), count(*) FILTER (WHERE c_mktsegment = 'FURNITURE') FROM customer""")
def sentinel_report(spark, d):
    before = table(spark, d, "customer").select("c_acctbal", "c_mktsegment")
    after = before.withColumns({
        "c_acctbal": C.null_where("c_acctbal", F.col("c_acctbal") <= 0),
        "c_mktsegment": C.null_unless_in("c_mktsegment", ["AUTOMOBILE", "BUILDING", "HOUSEHOLD", "MACHINERY"])})
    return clean.sentinel_report(before, after, before.columns)


@query("drop_zero_variance", "SELECT c_custkey, c_mktsegment FROM customer")
def drop_zero_variance(spark, d):
    c = table(spark, d, "customer").withColumn("constant", F.lit(0.0))
    return clean.drop_columns(c, ["constant", "absent", "c_name", "c_nationkey", "c_acctbal"])


@query("rare_type_grouping", """
  SELECT CASE WHEN p_type IN ('MEDIUM', 'STANDARD', 'LARGE') THEN p_type ELSE 'OTHER' END AS type, count(*) AS n,
    round(avg(p_retailprice), 6) AS mean_price FROM part GROUP BY 1""")
def rare_type_grouping(spark, d):
    t = clean.group_rare("p_type", ["MEDIUM", "STANDARD", "LARGE"], "OTHER")
    return table(spark, d, "part").groupBy(t.alias("type")).agg(F.count("*").alias("n"), F.avg("p_retailprice").alias("mean_price"))


@query("canonical_codes", """
  SELECT CAST(p_size AS VARCHAR) AS code, 3 * count(*) AS n FROM part GROUP BY 1 UNION ALL SELECT '', count(*) FROM part""")
def canonical_codes(spark, d):
    """One code however it was stored: 4, 4.0, ' 4 ' and a missing one as the empty text."""
    s = F.col("p_size")
    forms = F.array(s.cast("string"), s.cast("double").cast("string"), F.concat(F.lit(" "), s.cast("string"), F.lit(" ")), F.lit(None).cast("string"))
    return table(spark, d, "part").select(F.explode(forms).alias("f")).groupBy(C.canon_code("f").alias("code")).agg(F.count("*").alias("n"))


@query("target_normalised", """
  SELECT o_orderstatus = 'F' AS target, 4 * count(*) AS n FROM orders GROUP BY 1""")
def target_normalised(spark, d):
    hit = F.col("o_orderstatus") == "F"
    forms = F.array(F.when(hit, "1").otherwise("0"), F.when(hit, " TRUE ").otherwise("False"), F.when(hit, "1.0").otherwise("0.0"), hit.cast("string"))
    return (table(spark, d, "orders").select(F.explode(forms).alias("f"))
            .groupBy(clean.parse_bool_strict("f", "target").alias("target")).agg(F.count("*").alias("n")))


@query("unreadable_targets", "SELECT o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 1")
def unreadable_targets(spark, d):
    return clean.unreadable_bools(table(spark, d, "orders"), "o_orderstatus")


@query("decimal_comma", "SELECT l_returnflag, round(sum(l_discount), 4) AS discount, count(*) AS n FROM lineitem GROUP BY 1", digits=4)
def decimal_comma(spark, d):
    text = F.concat(F.lit("0,"), F.lpad(F.bround(F.col("l_discount") * 100).cast("int").cast("string"), 2, "0"))
    return table(spark, d, "lineitem").select("l_returnflag", C.parse_decimal_comma(text).alias("x")).groupBy("l_returnflag").agg(
        F.sum("x").alias("discount"), F.count("x").alias("n"))


@query("dayfirst_dates", """
  SELECT CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS at, count(*) AS n FROM orders GROUP BY 1""")
def dayfirst_dates(spark, d):
    text = F.date_format("o_orderdate", "d/MM/yyyy HH:mm")
    return table(spark, d, "orders").select(C.parse_dayfirst(text).cast("timestamp_ntz").alias("at")).groupBy("at").agg(F.count("*").alias("n"))


@query("round_half_even", """
  SELECT CAST(round_even(l_quantity / 2, 0) AS BIGINT) AS half, count(*) AS n FROM lineitem GROUP BY 1""")
def round_half_even(spark, d):
    return table(spark, d, "lineitem").groupBy(C.to_long(F.col("l_quantity") / 2).alias("half")).agg(F.count("*").alias("n"))


@query("ordered_categories", """
  SELECT o_orderpriority, CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '3-MEDIUM' THEN 1 WHEN '2-HIGH' THEN 2 END AS o_orderpriority_rank, count(*) AS n
  FROM (SELECT CASE WHEN o_orderpriority IN ('5-LOW', '3-MEDIUM', '2-HIGH') THEN o_orderpriority END AS o_orderpriority FROM orders) GROUP BY ALL""")
def ordered_categories(spark, d):
    o = clean.categorise(table(spark, d, "orders"), "o_orderpriority", ["5-LOW", "3-MEDIUM", "2-HIGH"], ordered=True)
    return o.groupBy("o_orderpriority", "o_orderpriority_rank").agg(F.count("*").alias("n"))


@query("scaled_units", "SELECT c_custkey, round(c_acctbal * 1000, 4) AS c_acctbal FROM customer", digits=4)
def scaled_units(spark, d):
    return clean.scale_columns(table(spark, d, "customer"), ["c_acctbal", "absent"], 1000).select("c_custkey", "c_acctbal")


@query("inconsistency_flag", """
  SELECT o_totalprice > CASE WHEN c_acctbal > 0 THEN c_acctbal * 40 END AS flag, count(*) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def inconsistency_flag(spark, d):
    j = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    limit = C.null_where("c_acctbal", F.col("c_acctbal") <= 0) * 40
    return j.groupBy((F.col("o_totalprice") > limit).alias("flag")).agg(F.count("*").alias("n"))


@query("inconsistency_counts", with_book("""
  SELECT 'price > total' AS condition, count(*) FILTER (WHERE price > total) AS rows FROM book
  UNION ALL SELECT 'total > 40 balances', count(*) FILTER (WHERE total > 40 * balance) FROM book
  UNION ALL SELECT 'no discount', count(*) FILTER (WHERE discount = 0) FROM book"""))
def inconsistency_counts(spark, d):
    return clean.count_conditions(book(spark, d), {
        "price > total": F.col("price") > F.col("total"), "total > 40 balances": F.col("total") > 40 * F.col("balance"),
        "no discount": F.col("discount") == 0})


@query("marker_census", """
  SELECT CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'NULL' WHEN 2 THEN '-' END AS marker, count(*) AS occurrences
  FROM orders WHERE o_orderkey % 4 < 3 GROUP BY 1""")
def marker_census(spark, d):
    k = F.col("o_orderkey") % 4
    marked = table(spark, d, "orders").select(
        "o_orderstatus", F.when(k == 0, "").when(k == 1, "NULL").when(k == 2, "-").otherwise(F.col("o_orderpriority")).alias("m"))
    return clean.marker_counts(marked)


@query("bools_to_double", """
  SELECT CASE WHEN o_totalprice < 100000 THEN NULL WHEN o_totalprice > 250000 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS big, count(*) AS n FROM orders GROUP BY 1""")
def bools_to_double(spark, d):
    o = table(spark, d, "orders").select(F.when(F.col("o_totalprice") >= 100000, F.col("o_totalprice") > 250000).alias("big"))
    text = o.select(F.col("big").cast("string").alias("big"))  # what a CSV round trip leaves
    return clean.bool_text_to_double(text, ["big"]).groupBy("big").agg(F.count("*").alias("n"))


@query("contract_violations", r"""
  SELECT * FROM (VALUES
    ('o_orderkey', 'not_null', (SELECT count(*) FROM orders WHERE o_orderkey IS NULL)),
    ('o_orderkey', 'ge', (SELECT count(*) FROM orders WHERE o_orderkey < 1)),
    ('o_totalprice', 'not_null', (SELECT count(*) FROM orders WHERE o_totalprice IS NULL)),
    ('o_totalprice', 'gt', (SELECT count(*) FROM orders WHERE o_totalprice <= 1000)),
    ('o_totalprice', 'le', (SELECT count(*) FROM orders WHERE o_totalprice > 450000)),
    ('o_orderstatus', 'not_null', (SELECT count(*) FROM orders WHERE o_orderstatus IS NULL)),
    ('o_orderstatus', 'isin', (SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O'))),
    ('o_orderpriority', 'not_null', (SELECT count(*) FROM orders WHERE o_orderpriority IS NULL)),
    ('o_orderpriority', 'pattern', (SELECT count(*) FROM orders WHERE NOT regexp_matches(o_orderpriority, '^[1-4]-'))),
    ('*', 'future', (SELECT count(*) FROM orders WHERE CAST(o_orderdate AS DATE) > current_date)),
    ('*', 'low priority below 300k', (SELECT count(*) FROM orders WHERE o_orderpriority = '5-LOW' AND o_totalprice > 300000))
  ) AS t("column", "rule", n_bad)""")
def contract_violations(spark, d):
    return validate.validate(table(spark, d, "orders"), _orders_contract())


ORDER_COLUMNS = (
    validate.ColumnRule("o_orderkey", T.LongType(), ge=1),
    validate.ColumnRule("o_totalprice", T.DoubleType(), gt=1000, le=450_000),
    validate.ColumnRule("o_orderstatus", T.StringType(), isin=("F", "O")),
    validate.ColumnRule("o_orderpriority", T.StringType(), pattern=r"^[1-4]-"),
)


def _orders_contract() -> validate.Contract:
    return validate.Contract(
        columns=ORDER_COLUMNS,
        row_rules={
            "future": F.to_date("o_orderdate") <= F.current_date(),
            "low priority below 300k": (F.col("o_orderpriority") != "5-LOW") | (F.col("o_totalprice") <= 300_000),
        },
        key=("o_orderkey",),
    )


@query("quarantine", """
  SELECT (CASE WHEN o_orderkey < 1 THEN 1 ELSE 0 END) + (CASE WHEN o_totalprice <= 1000 THEN 1 ELSE 0 END)
    + (CASE WHEN o_totalprice > 450000 THEN 1 ELSE 0 END) + (CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 1 ELSE 0 END)
    + (CASE WHEN NOT regexp_matches(o_orderpriority, '^[1-4]-') THEN 1 ELSE 0 END)
    + (CASE WHEN o_orderpriority = '5-LOW' AND o_totalprice > 300000 THEN 1 ELSE 0 END) AS broken, count(*) AS n
  FROM orders GROUP BY 1""")
def quarantine(spark, d):
    marked = validate.split_valid(table(spark, d, "orders"), _orders_contract())
    return marked.groupBy(F.size("broken_rules").cast("int").alias("broken")).agg(F.count("*").alias("n"))


@query("lineitem_key_duplicates", """
  WITH g AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)
  SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_keys, count(*) FILTER (WHERE n > 1) AS repeated_keys, CAST(sum(n - 1) AS BIGINT) AS excess_rows FROM g""")
def lineitem_key_duplicates(spark, d):
    return validate.unique_check(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("duplicate_key_list", """
  SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def duplicate_key_list(spark, d):
    return validate.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("duplicate_rows", """
  SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n - 1) AS BIGINT) AS duplicates FROM
    (SELECT count(*) AS n FROM (SELECT o_orderstatus, o_orderpriority, o_orderdate FROM orders) GROUP BY o_orderstatus, o_orderpriority, o_orderdate)""")
def duplicate_rows(spark, d):
    return validate.count_duplicates(table(spark, d, "orders").select("o_orderstatus", "o_orderpriority", "o_orderdate"))


@query("strict_schema", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer")
def strict_schema(spark, d):
    schema = T.StructType([T.StructField("c_custkey", T.StringType()), T.StructField("c_nationkey", T.LongType())])
    return validate.strict_schema(table(spark, d, "customer").select("c_nationkey", "c_custkey"), schema)


@query("prepared_loans", with_loans("""
  SELECT cliente_id, tipo_credito, capital_prestado, plazo_meses, edad_cliente, tipo_laboral, salario_cliente,
    round(puntaje, 6) AS puntaje, CAST(puntaje_datacredito AS BIGINT) AS puntaje_datacredito, saldo_mora, saldo_total, saldo_principal,
    promedio_ingresos_datacredito, tendencia_ingresos, "Pago_atiempo", cuota_supera_salario, round(dti, 6) AS dti, round(pti, 6) AS pti,
    round(monto_sobre_ingreso, 6) AS monto_sobre_ingreso, round(ratio_ingreso_declarado_bureau, 6) AS ratio_ingreso_declarado_bureau,
    round(creditos_por_anio_adulto, 6) AS creditos_por_anio_adulto, tiene_mora_bureau, rango_edad, mes_prestamo,
    falta_edad_cliente, falta_salario_cliente, falta_tendencia_ingresos, falta_saldo_total FROM loans"""))
def prepared_loans(spark, d):
    """The whole clean + derive chain over raw text-typed loans."""
    out = loan.prepare_labelled(raw_loans(spark, d))
    return out.select(
        "cliente_id", "tipo_credito", "capital_prestado", "plazo_meses", "edad_cliente", "tipo_laboral", "salario_cliente", "puntaje",
        "puntaje_datacredito", "saldo_mora", "saldo_total", "saldo_principal", "promedio_ingresos_datacredito", "tendencia_ingresos",
        "Pago_atiempo", "cuota_supera_salario", "dti", "pti", "monto_sobre_ingreso", "ratio_ingreso_declarado_bureau",
        "creditos_por_anio_adulto", "tiene_mora_bureau", "rango_edad", "mes_prestamo", "falta_edad_cliente", "falta_salario_cliente",
        "falta_tendencia_ingresos", "falta_saldo_total")


def rule_counts_sql(columns, key: str, source: str, row_rules: dict[str, str]) -> str:
    """(column, rule, n_bad) of every rule of a contract; row_rules gives the condition of each row rule in SQL."""
    bad = {}
    for r in columns:
        c = f'"{r.name}"'
        said = {
            "not_null": None if r.nullable else f"{c} IS NULL", "ge": r.ge is not None and f"{c} < {r.ge}", "gt": r.gt is not None and f"{c} <= {r.gt}",
            "le": r.le is not None and f"{c} > {r.le}", "isin": r.isin and f"{c} NOT IN ({', '.join(repr(v) for v in r.isin)})",
            "pattern": r.pattern and f"NOT regexp_matches({c}, '{r.pattern}')",
        }
        bad |= {(r.name, k): v for k, v in said.items() if v}
    bad |= {("*", k): f"NOT ({v})" for k, v in row_rules.items()}
    counts = ", ".join(f"count(*) FILTER (WHERE {v}) AS c{i}" for i, v in enumerate(bad.values()))
    rows = ", ".join(f"{{'column': '{c}', 'rule': '{r}', 'n_bad': c{i}}}" for i, (c, r) in enumerate(bad))
    return (f"WITH rules AS (SELECT unnest([{rows}]) AS r FROM (SELECT {counts} FROM {source})) SELECT r.\"column\" AS \"column\", r.rule AS rule, CAST(r.n_bad AS BIGINT) AS n_bad FROM rules "
            f"UNION ALL SELECT '*', 'key', (SELECT count(*) FROM (SELECT 1 FROM {source} GROUP BY {key} HAVING count(*) > 1))")


LOAN_ROW_RULES = {"saldo_principal_no_supera_total": "saldo_principal <= saldo_total", "fecha_prestamo_no_es_futura": "CAST(fecha_prestamo AS DATE) <= current_date"}


@query("loan_contract_report", with_loans(rule_counts_sql(loan.loan_columns(labelled=True), "cliente_id", "loans", LOAN_ROW_RULES)))
def loan_contract_report(spark, d):
    """Every rule of the contract, counted by the write that publishes the table."""
    prepared = loan.prepare_labelled(raw_loans(spark, d), check=False)
    return publish.publish(prepared, loan.loan_contract(labelled=True), _shared(spark, "loans")).to_frame(spark)


def _shared(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/plumbline-{name}-{uuid.uuid4().hex}"


ORDER_ROW_RULES = {"future": "CAST(o_orderdate AS DATE) <= current_date", "low priority below 300k": "o_orderpriority <> '5-LOW' OR o_totalprice <= 300000"}
SOUND_ORDER = "o_orderkey >= 1 AND o_totalprice > 1000 AND o_totalprice <= 450000 AND o_orderstatus IN ('F', 'O') AND regexp_matches(o_orderpriority, '^[1-4]-') AND (o_orderpriority <> '5-LOW' OR o_totalprice <= 300000)"


@query("published_orders", f"""
  SELECT o_orderstatus, '{{}}' AS rules, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE {SOUND_ORDER} GROUP BY 1
  UNION ALL SELECT o_orderstatus, '*', count(*), round(sum(o_totalprice), 2) FROM orders WHERE NOT ({SOUND_ORDER}) GROUP BY 1""", digits=2)
def published_orders(spark, d):
    """One write puts sound orders in the published table and the others, with their broken rules, in quarantine."""
    o = table(spark, d, "orders")
    path, aside = _shared(spark, "orders"), _shared(spark, "orders-quarantine")
    publish.publish(o, _loose_orders(o), path, quarantine=aside)
    good = spark.read.schema(o.schema).parquet(path).withColumn("broken_rules", F.lit("{}"))
    bad = publish.quarantined(spark, o, aside).withColumn("broken_rules", F.when(F.size("broken_rules") > 0, "*"))
    return good.unionByName(bad).groupBy("o_orderstatus", F.col("broken_rules").alias("rules")).agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total"))


def _loose_orders(o) -> validate.Contract:
    """The contract of orders, open to the columns it does not name."""
    c = _orders_contract()
    return validate.Contract(c.columns, c.row_rules, c.key, strict=False)


@query("refused_publication", rule_counts_sql(ORDER_COLUMNS, "o_orderkey", "(SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 100 = 0)", ORDER_ROW_RULES))
def refused_publication(spark, d):
    """Orders with planted copies: the write counts every rule and finds the repeated keys, and nothing is published."""
    o = table(spark, d, "orders")
    path = _shared(spark, "refused")
    try:
        publish.publish(o.unionByName(o.where(F.col("o_orderkey") % 100 == 0)), _loose_orders(o), path)
    except publish.ContractBroken as broken:
        if paths.exists(spark, path):
            raise ValueError("a refused table was published") from broken
        return broken.verdict.to_frame(spark)
    raise ValueError("a broken table was published")


@query("feature_table", with_loans("""
  SELECT cliente_id, fecha_prestamo, tipo_credito, capital_prestado, edad_cliente, rango_edad, round(dti, 6) AS dti, falta_saldo_mora FROM loans"""))
def feature_table(spark, d):
    """The stored feature table: key, event time and features, never the label or withheld columns."""
    t = loan.build_feature_table(loan.prepare_features(raw_loans(spark, d), requests=False))
    if uncovered_columns(t, loan.LOAN_SPEC):
        raise ValueError(f"views do not cover the table: {uncovered_columns(t, loan.LOAN_SPEC)}")
    return t.select("cliente_id", F.col("fecha_prestamo").cast("timestamp_ntz").alias("fecha_prestamo"), "tipo_credito", "capital_prestado",
                    "edad_cliente", "rango_edad", "dti", "falta_saldo_mora")


@query("feature_view_projection", with_loans("""
  SELECT cliente_id, fecha_prestamo, cuota_supera_salario, round(dti, 6) AS dti, round(pti, 6) AS pti, round(monto_sobre_ingreso, 6) AS monto_sobre_ingreso,
    round(ratio_ingreso_declarado_bureau, 6) AS ratio_ingreso_declarado_bureau, round(creditos_por_anio_adulto, 6) AS creditos_por_anio_adulto,
    tiene_mora_bureau, rango_edad FROM loans"""))
def feature_view_projection(spark, d):
    t = view(loan.prepare_features(raw_loans(spark, d), requests=False), "credito_derivadas", loan.LOAN_SPEC)
    return t.withColumn("fecha_prestamo", F.col("fecha_prestamo").cast("timestamp_ntz"))


@query("entity_frame", with_loans("SELECT cliente_id, fecha_prestamo FROM loans"))
def entity_frame_query(spark, d):
    t = entity_frame(loan.prepare_features(raw_loans(spark, d), requests=False), loan.LOAN_SPEC)
    return t.withColumn("fecha_prestamo", F.col("fecha_prestamo").cast("timestamp_ntz"))


@query("leakage_safe_view", with_loans("""
  SELECT falta_edad_cliente, falta_salario_cliente, tipo_laboral, count(*) AS n FROM loans GROUP BY ALL"""))
def leakage_safe_view(spark, d):
    t = features(loan.prepare_labelled(raw_loans(spark, d)), loan.LOAN_SPEC)
    return t.groupBy("falta_edad_cliente", "falta_salario_cliente", "tipo_laboral").agg(F.count("*").alias("n"))


@query("missing_flags", with_book("""
  SELECT balance IS NULL AS missing_balance, total_to_balance IS NULL AS missing_total_to_balance, count(*) AS n FROM book GROUP BY ALL"""))
def missing_flags(spark, d):
    b = derive.missing_flags(book(spark, d).select("balance", "total_to_balance"), ["balance", "total_to_balance"])
    return b.groupBy("missing_balance", "missing_total_to_balance").agg(F.count("*").alias("n"))


@query("per_year_ratio", """
  SELECT p_partkey, round(p_retailprice / NULLIF(p_size - 18, 0), 6) AS per_year, p_size - 18 > 0 AS above FROM part""")
def per_year_ratio(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", derive.per_year("p_retailprice", "p_size", 18).alias("per_year"), derive.positive_flag(F.col("p_size") - 18).alias("above"))


@query("interaction_products", with_book("""
  SELECT segment, round(sum(quantity * discount), 4) AS "quantity*discount", round(sum(discount * tax), 4) AS "discount*tax" FROM book GROUP BY 1"""), digits=4)
def interaction_products(spark, d):
    pairs = [("quantity", "discount"), ("discount", "tax")]
    out = derive.interactions(book(spark, d).select("segment", "quantity", "discount", "tax"), pairs)
    return out.groupBy("segment").agg(*[F.sum(f"`{a}*{b}`").alias(f"{a}*{b}") for a, b in pairs])


@query("ablated_columns", "SELECT o_orderkey, o_orderstatus FROM orders")
def ablated_columns(spark, d):
    return derive.ablate(table(spark, d, "orders"), ["o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority", "absent"])


@query("term_elapsed", """
  WITH t AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, (2001 - year(o_orderdate)) * 12 + 8 - month(o_orderdate) AS age, o_orderkey % 36 + 1 AS term FROM orders)
  SELECT month, CAST(max(age) AS INT) AS age, round(avg(CASE WHEN age >= term THEN 1.0 ELSE 0.0 END), 6) AS share_term_elapsed FROM t GROUP BY 1""")
def term_elapsed(spark, d):
    o = table(spark, d, "orders").select(C.vintage("o_orderdate").alias("month"), (F.col("o_orderkey") % 36 + 1).alias("term"))
    return derive.term_elapsed(o, "month", "term", "2001-08")


@query("complete_case_sample", with_book("""
  SELECT segment, count(*) AS n, round(avg(total_to_balance), 6) AS mean_ratio FROM book WHERE balance IS NOT NULL AND total_to_balance < 60 GROUP BY 1"""))
def complete_case_sample(spark, d):
    kept = derive.complete_cases(book(spark, d).select("segment", "balance", "total_to_balance"), ["balance", "total_to_balance"], F.col("total_to_balance") < 60)
    return kept.groupBy("segment").agg(F.count("*").alias("n"), F.avg("total_to_balance").alias("mean_ratio"))
