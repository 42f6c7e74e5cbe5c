"""The portfolios the registered queries run on, derived from the given tables with declarative plans.

`book` has one row per line item with its order and customer; `raw_loans` has one row per order in the
raw loan format, with the defects cleaning has to deal with. Each comes with the SQL of the same table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.columns import band, null_where, ratio, vintage
from plumbline.session import written

BOOK_KEY = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
QUANTITY_EDGES = (0, 10, 20, 30, 40, 50)
QUANTITY_LABELS = ("01-10", "11-20", "21-30", "31-40", "41-50")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with order, customer and the derived columns; defaulted is 0/1.

    Only the columns a caller selects reach the scans. Orders meet their customer first, so the lines are
    shuffled once. The customer's missing balance stands for an unknown income: non-positive balances are
    sentinels.
    """
    li, o, c = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer"))
    placed = o.join(c, o.o_custkey == c.c_custkey).withColumn("month", vintage("o_orderdate"))  # once for each order
    joined = li.join(placed, li.l_orderkey == o.o_orderkey)
    balance = null_where("c_acctbal", F.col("c_acctbal") <= 0)
    return joined.select(
        *BOOK_KEY, "o_custkey",
        F.col("o_orderdate").alias("ordered_at"),
        "month",
        (F.col("l_returnflag") == "R").cast("int").alias("defaulted"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        F.col("o_totalprice").alias("total"),
        balance.alias("balance"),
        F.col("c_mktsegment").alias("segment"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
        band("l_quantity", QUANTITY_EDGES, QUANTITY_LABELS).alias("quantity_band"),
        ratio("l_extendedprice", "o_totalprice").alias("price_to_total"),
        ratio("o_totalprice", balance).alias("total_to_balance"),
        balance.isNull().alias("missing_balance"),
    )


def stored_book(spark: SparkSession, sf_dir: str, *columns: str | Column) -> DataFrame:
    """Columns of the book in the shared folder, for a query that reads them many times: the tables are joined once."""
    return written(book(spark, sf_dir).select(*columns), "book")


BOOK_SQL = """book AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, o_custkey, o_orderdate AS ordered_at,
    strftime(o_orderdate, '%Y-%m') AS month,
    CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS defaulted,
    l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount, l_tax AS tax,
    o_totalprice AS total, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS balance,
    c_mktsegment AS segment, o_orderpriority AS priority, o_orderstatus AS status,
    CASE WHEN l_quantity <= 0 THEN NULL WHEN l_quantity <= 10 THEN '01-10' WHEN l_quantity <= 20 THEN '11-20'
      WHEN l_quantity <= 30 THEN '21-30' WHEN l_quantity <= 40 THEN '31-40' WHEN l_quantity <= 50 THEN '41-50' END AS quantity_band,
    l_extendedprice / NULLIF(o_totalprice, 0) AS price_to_total,
    o_totalprice / CASE WHEN c_acctbal > 0 THEN c_acctbal END AS total_to_balance,
    NOT coalesce(c_acctbal > 0, false) AS missing_balance
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""


def raw_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in the raw loan layout: decimal commas, day-first text dates, sentinels, rare codes, gaps."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    k, u = F.col("o_orderkey"), F.col("o_custkey")
    cents = F.bround(F.col("c_acctbal") * 100).cast("long")

    def pick(values, key):
        return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (key % len(values) + 1).cast("int"))

    return o.join(c, u == F.col("c_custkey")).select(
        F.concat(F.lit("CLI-"), F.lpad(k.cast("string"), F.greatest(F.lit(7), F.length(k.cast("string"))), F.lit("0"))).alias("cliente_id"),
        pick(["4", "9", "10", "6", "68"], u).alias("tipo_credito"),
        F.date_format("o_orderdate", "d/MM/yyyy HH:mm").alias("fecha_prestamo"),
        (F.bround(F.col("o_totalprice") * 100).cast("long") % 5_000_000 + 360_000).alias("capital_prestado"),
        (k % 36 + 1).alias("plazo_meses"),
        (u % 110 + 15).alias("edad_cliente"),
        F.when(u % 3 == 0, "Independiente").otherwise("Empleado").alias("tipo_laboral"),
        (cents * 3).alias("salario_cliente"),
        (k * 7919 % 3_000_000).alias("total_otros_prestamos"),
        (k * 613 % 900_000 + 1).alias("cuota_pactada"),
        F.concat((k % 96).cast("string"), F.lit(","), F.lpad((u % 100).cast("string"), 2, "0")).alias("puntaje"),
        (k * 31 % 1000 - 7).cast("double").alias("puntaje_datacredito"),
        (k % 12).alias("cant_creditosvigentes"),
        (u % 15).alias("huella_consulta"),
        F.when(k % 5 != 0, (k % 7 * 150).cast("double")).alias("saldo_mora"),
        F.when(k % 9 != 0, (k % 5000 + 5000).cast("double")).alias("saldo_total"),
        F.when(k % 4 != 0, (k % 5000).cast("double")).alias("saldo_principal"),
        F.lit(0.0).alias("saldo_mora_codeudor"),
        (k % 6).alias("creditos_sectorFinanciero"),
        (k % 3).alias("creditos_sectorCooperativo"),
        (k % 4).alias("creditos_sectorReal"),
        F.when(k % 10 != 0, (cents * 2 + k % 1000 - 500).cast("double")).alias("promedio_ingresos_datacredito"),
        F.element_at(
            F.array(F.lit("Decreciente"), F.lit("Estable"), F.lit("Creciente"), F.lit("0,15"), F.lit(None).cast("string")),
            (k % 5 + 1).cast("int"),
        ).alias("tendencia_ingresos"),
        F.when(F.col("o_orderstatus") == "F", "0").otherwise("1").alias("Pago_atiempo"),
    )


RAW_LOANS_SQL = """raw_loans AS (
  SELECT 'CLI-' || lpad(CAST(o_orderkey AS VARCHAR), CAST(greatest(7, length(CAST(o_orderkey AS VARCHAR))) AS INTEGER), '0') AS cliente_id,
    list_extract(['4','9','10','6','68'], CAST(o_custkey % 5 + 1 AS INT)) AS tipo_credito,
    o_orderdate AS fecha_prestamo,
    CAST(round(o_totalprice * 100) AS BIGINT) % 5000000 + 360000 AS capital_prestado,
    o_orderkey % 36 + 1 AS plazo_meses, o_custkey % 110 + 15 AS edad_cliente,
    CASE WHEN o_custkey % 3 = 0 THEN 'Independiente' ELSE 'Empleado' END AS tipo_laboral,
    CAST(round(c_acctbal * 100) AS BIGINT) * 3 AS salario_cliente,
    o_orderkey * 7919 % 3000000 AS total_otros_prestamos,
    o_orderkey * 613 % 900000 + 1 AS cuota_pactada,
    CAST(o_orderkey % 96 AS DOUBLE) + CAST(o_custkey % 100 AS DOUBLE) / 100 AS puntaje,
    o_orderkey * 31 % 1000 - 7 AS puntaje_datacredito,
    o_orderkey % 12 AS cant_creditosvigentes, o_custkey % 15 AS huella_consulta,
    CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 7 * 150 END AS saldo_mora,
    CASE WHEN o_orderkey % 9 <> 0 THEN o_orderkey % 5000 + 5000 END AS saldo_total,
    CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 5000 END AS saldo_principal,
    o_orderkey % 6 AS "creditos_sectorFinanciero", o_orderkey % 3 AS "creditos_sectorCooperativo",
    o_orderkey % 4 AS "creditos_sectorReal",
    CASE WHEN o_orderkey % 10 <> 0 THEN CAST(round(c_acctbal * 100) AS BIGINT) * 2 + o_orderkey % 1000 - 500 END AS promedio_ingresos_datacredito,
    list_extract(['Decreciente','Estable','Creciente','0,15',NULL], CAST(o_orderkey % 5 + 1 AS INT)) AS tendencia_ingresos,
    o_orderstatus <> 'F' AS "Pago_atiempo"
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

# The prepared loan table (clean + derive) over raw_loans.
LOANS_SQL = RAW_LOANS_SQL + """, cleaned AS (
  SELECT * REPLACE (
    CASE WHEN tipo_credito IN ('4','9','10') THEN tipo_credito ELSE 'Otro' END AS tipo_credito,
    CASE WHEN edad_cliente BETWEEN 18 AND 100 THEN edad_cliente END AS edad_cliente,
    CASE WHEN puntaje_datacredito BETWEEN 150 AND 950 THEN puntaje_datacredito END AS puntaje_datacredito,
    CASE WHEN salario_cliente > 0 AND salario_cliente <= 1000000000 THEN salario_cliente END AS salario_cliente,
    CASE WHEN promedio_ingresos_datacredito > 0 THEN promedio_ingresos_datacredito END AS promedio_ingresos_datacredito,
    CASE WHEN tendencia_ingresos IN ('Decreciente','Estable','Creciente') THEN tendencia_ingresos END AS tendencia_ingresos,
    saldo_mora * 1000 AS saldo_mora, saldo_total * 1000 AS saldo_total, saldo_principal * 1000 AS saldo_principal)
  FROM raw_loans), loans AS (
  SELECT *, cuota_pactada > salario_cliente AS cuota_supera_salario,
    total_otros_prestamos / salario_cliente AS dti, cuota_pactada / salario_cliente AS pti,
    capital_prestado / salario_cliente AS monto_sobre_ingreso,
    salario_cliente / promedio_ingresos_datacredito AS ratio_ingreso_declarado_bureau,
    cant_creditosvigentes / NULLIF(edad_cliente - 18, 0) AS creditos_por_anio_adulto,
    saldo_mora > 0 AS tiene_mora_bureau,
    CASE WHEN edad_cliente <= 17 THEN NULL WHEN edad_cliente <= 25 THEN '18-25' WHEN edad_cliente <= 35 THEN '26-35'
      WHEN edad_cliente <= 45 THEN '36-45' WHEN edad_cliente <= 55 THEN '46-55' WHEN edad_cliente <= 65 THEN '56-65'
      WHEN edad_cliente <= 100 THEN '66+' END AS rango_edad,
    strftime(fecha_prestamo, '%Y-%m') AS mes_prestamo,
    edad_cliente IS NULL AS falta_edad_cliente, salario_cliente IS NULL AS falta_salario_cliente,
    puntaje_datacredito IS NULL AS falta_puntaje_datacredito,
    promedio_ingresos_datacredito IS NULL AS falta_promedio_ingresos_datacredito,
    tendencia_ingresos IS NULL AS falta_tendencia_ingresos, saldo_total IS NULL AS falta_saldo_total,
    saldo_principal IS NULL AS falta_saldo_principal, saldo_mora IS NULL AS falta_saldo_mora
  FROM cleaned)"""


def with_book(sql: str) -> str:
    return f"WITH {BOOK_SQL}, {sql.strip()[5:]}" if sql.strip().upper().startswith("WITH ") else f"WITH {BOOK_SQL} {sql}"


def with_loans(sql: str) -> str:
    return f"WITH {LOANS_SQL}, {sql.strip()[5:]}" if sql.strip().upper().startswith("WITH ") else f"WITH {LOANS_SQL} {sql}"
