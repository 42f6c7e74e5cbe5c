import datetime as dt

import pytest
from pyspark.sql import functions as F

from plumbline import loan
from plumbline.operators import clean as cl
from plumbline.operators import scorecard, validate
from plumbline.sources import readers
from plumbline.spec import PortfolioSpec, features, uncovered_columns

BASE = dict(
    cliente_id="CLI-0000001", tipo_credito="4", fecha_prestamo="7/01/2025 14:40", capital_prestado=2_000_000, plazo_meses=10, edad_cliente=40,
    tipo_laboral="Empleado", salario_cliente=3_000_000, total_otros_prestamos=900_000, cuota_pactada=200_000, puntaje="95,227787",
    puntaje_datacredito=790.0, cant_creditosvigentes=4, huella_consulta=2, saldo_mora=0.0, saldo_total=16_178.0, saldo_principal=12_000.4,
    saldo_mora_codeudor=0.0, creditos_sectorFinanciero=1, creditos_sectorCooperativo=0, creditos_sectorReal=2,
    promedio_ingresos_datacredito=1_500_000.0, tendencia_ingresos="Estable", Pago_atiempo="1",
)
DEFECTS = [
    {}, {"edad_cliente": 122}, {"puntaje_datacredito": 0.0}, {"puntaje_datacredito": -7.0}, {"puntaje_datacredito": 999.0}, {"salario_cliente": 0},
    {"salario_cliente": 22_000_000_000}, {"promedio_ingresos_datacredito": 0.0}, {"tendencia_ingresos": "0,15"}, {"tipo_credito": "6"}, {"tipo_credito": "68.0"},
    {"cuota_pactada": 570_000, "salario_cliente": 500_000}, {"saldo_mora": 450.0},
    {"edad_cliente": 18, "saldo_principal": None, "promedio_ingresos_datacredito": None, "tendencia_ingresos": None},
]


@pytest.fixture(scope="module")
def raw(spark):
    rows = [{**BASE, **d, "cliente_id": f"CLI-{i + 1:07d}"} for i, d in enumerate(DEFECTS)]
    names = [f.name for f in loan.RAW_SCHEMA]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], loan.RAW_SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def prepared(raw):
    return {r.cliente_id: r for r in loan.prepare_labelled(raw).collect()}


def row(prepared, i):
    return prepared[f"CLI-{i + 1:07d}"]


def test_clean_row(prepared):
    r = row(prepared, 0)
    assert r.fecha_prestamo == dt.datetime(2025, 1, 7, 14, 40) and r.mes_prestamo == "2025-01"
    assert r.puntaje == pytest.approx(95.227787) and r.Pago_atiempo is True
    assert (r.saldo_total, r.saldo_principal) == (16_178_000, 12_000_000)
    assert r.dti == pytest.approx(0.3) and r.ratio_ingreso_declarado_bureau == 2.0 and r.creditos_por_anio_adulto == pytest.approx(4 / 22)
    assert r.rango_edad == "36-45" and r.tiene_mora_bureau is False and r.cuota_supera_salario is False
    assert "saldo_mora_codeudor" not in r.asDict()


@pytest.mark.parametrize("i,column", [(1, "edad_cliente"), (2, "puntaje_datacredito"), (3, "puntaje_datacredito"), (4, "puntaje_datacredito"),
                                      (5, "salario_cliente"), (6, "salario_cliente"), (7, "promedio_ingresos_datacredito"), (8, "tendencia_ingresos")])
def test_sentinels_become_null_and_are_flagged(prepared, i, column):
    assert row(prepared, i)[column] is None and row(prepared, i)[f"falta_{column}"] is True


def test_planted_defects(prepared):
    assert row(prepared, 5).dti is None and row(prepared, 5).cuota_supera_salario is None
    assert row(prepared, 9).tipo_credito == row(prepared, 10).tipo_credito == "Otro"
    assert row(prepared, 11).cuota_supera_salario is True and row(prepared, 12).tiene_mora_bureau is True
    last = row(prepared, 13)
    assert last.creditos_por_anio_adulto is None and last.rango_edad == "18-25"
    assert last.falta_saldo_principal and last.falta_promedio_ingresos_datacredito and last.falta_tendencia_ingresos and not last.falta_saldo_total


@pytest.mark.parametrize("value,expected", [("1", True), ("0", False), ("TRUE", True), (" false ", False), ("1.0", True)])
def test_target_forms(spark, value, expected):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(cl.parse_bool_strict("v").alias("b")).first().b is expected


@pytest.mark.parametrize("value", ["2", "yes", "", None])
def test_unreadable_target_fails(spark, value):
    with pytest.raises(Exception, match="not a boolean"):
        spark.createDataFrame([(value,)], "v string").select(cl.parse_bool_strict("v", "v")).collect()


def test_contract_reports_and_refuses(raw):
    bad = raw.withColumn("plazo_meses", F.when(F.col("cliente_id") == "CLI-0000003", 0).otherwise(F.col("plazo_meses")))
    bad = bad.withColumn("saldo_principal", F.when(F.col("cliente_id") == "CLI-0000004", 99_999.0).otherwise(F.col("saldo_principal")))
    out = loan.prepare_labelled(bad, check=False)
    report = {(r.column, r.rule): r.n_bad for r in validate.validate(out, loan.loan_contract(True)).collect() if r.n_bad}
    assert report == {("plazo_meses", "ge"): 1, ("*", "saldo_principal_no_supera_total"): 1}
    broken = {r.cliente_id: r.broken_rules for r in validate.split_valid(out, loan.loan_contract(True)).collect() if r.broken_rules}
    assert broken == {"CLI-0000003": ["plazo_meses:ge"], "CLI-0000004": ["*:saldo_principal_no_supera_total"]}
    with pytest.raises(Exception, match="contract broken"):
        loan.prepare_labelled(bad).collect()


def test_feature_table_never_holds_the_outcome(raw):
    t = loan.build_feature_table(loan.prepare_features(raw))
    assert not {"Pago_atiempo", "puntaje", "mes_prestamo"} & set(t.columns) and len(t.columns) == 2 + 35
    assert uncovered_columns(t, loan.LOAN_SPEC) == []
    assert features(t, loan.LOAN_SPEC).columns == [c for c in t.columns if c not in ("cliente_id", "fecha_prestamo")]
    with pytest.raises(ValueError, match="Pago_atiempo"):
        loan.prepare_labelled(raw.drop("Pago_atiempo"))


RECORD = dict(puntaje_datacredito=790, huella_consulta=5, rango_edad="56-65", edad_cliente=60, tipo_laboral="Empleado", ratio_ingreso_declarado_bureau=2.5,
              tendencia_ingresos="Estable", capital_prestado=1_000_000, plazo_meses=6, promedio_ingresos_datacredito=2_000_000)
SCHEMA = "puntaje_datacredito long, huella_consulta long, rango_edad string, edad_cliente long, tipo_laboral string, ratio_ingreso_declarado_bureau double, tendencia_ingresos string, capital_prestado long, plazo_meses long, promedio_ingresos_datacredito long"
CASES = [
    ({}, -1), ({"puntaje_datacredito": 769}, 2), ({"puntaje_datacredito": 770}, -1), ({"puntaje_datacredito": 813}, -2), ({"puntaje_datacredito": None}, 2),
    ({"huella_consulta": 3}, -2), ({"huella_consulta": 6}, -1), ({"huella_consulta": 7}, 1), ({"huella_consulta": None}, -1), ({"rango_edad": "18-25"}, 2), ({"rango_edad": None}, 1),
    ({"edad_cliente": 35, "tipo_laboral": "Independiente"}, 2), ({"edad_cliente": 36, "tipo_laboral": "Independiente"}, -1), ({"edad_cliente": 35}, -1),
    ({"ratio_ingreso_declarado_bureau": 1.081}, -2), ({"ratio_ingreso_declarado_bureau": 1.807}, -1), ({"ratio_ingreso_declarado_bureau": 3.594}, 0),
    ({"ratio_ingreso_declarado_bureau": None}, -1), ({"tendencia_ingresos": "Decreciente"}, 0), ({"tendencia_ingresos": "Creciente"}, -2),
    ({"capital_prestado": 3_084_840, "plazo_meses": 13}, 4), ({"capital_prestado": 3_084_840}, -1), ({"promedio_ingresos_datacredito": None}, 0),
]


def test_scorecard_points(spark):
    rows = [(i, *{**RECORD, **c}.values()) for i, (c, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, f"i int, {SCHEMA}")
    got = {r.i: r for r in scorecard.explain(scorecard.score_card(df, loan.LOAN_CARD), loan.LOAN_CARD).collect()}
    assert {i: r.points for i, r in got.items()} == {i: p for i, (_, p) in enumerate(CASES)}
    assert all(sum(r[n] for n in loan.LOAN_CARD.rules) == r.points for r in got.values())


def test_scorecard_refuses_unknown_bands_and_missing_columns(spark):
    df = spark.createDataFrame([tuple({**RECORD, "rango_edad": "99+"}.values())], SCHEMA)
    with pytest.raises(Exception, match="no points for band 99"):
        scorecard.score_card(df, loan.LOAN_CARD).collect()
    with pytest.raises(KeyError, match="huella_consulta"):
        scorecard.score_card(df.drop("huella_consulta"), loan.LOAN_CARD)
    with pytest.raises(ValueError):
        scorecard.Banded("x", (3, 1), (0, 1, 2))


def test_csv_scan_drops_the_mark_and_keeps_comma_text(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿cliente_id;puntaje;n\nCLI-1;95,2;3\nCLI-2;;\n".encode())
    got = readers.read_source(spark, {"type": "csv", "path": str(tmp_path / "a.csv"), "schema": "cliente_id string, puntaje string, n long"}).collect()
    assert [tuple(r) for r in got] == [("CLI-1", "95,2", 3), ("CLI-2", None, None)]
    with pytest.raises(ValueError, match="known: csv"):
        readers.read_source(spark, {"type": "ftp"})
    with pytest.raises(ValueError):
        readers.check_object_uri("bucket/object.csv")
    assert readers.check_object_uri("gs://bucket/a/b.csv")


def test_serving_defaults(spark):
    req = spark.createDataFrame([("a1", "4", 2_000_000, 10, "Empleado", 150_000)], "application_id string, tipo_credito string, capital_prestado long, plazo_meses long, tipo_laboral string, cuota_pactada long")
    r = loan.prepare_features(loan.serving_frame(req)).withColumn("id", F.lit(1)).first()
    assert r.total_otros_prestamos == 0 and r.salario_cliente is None and r.falta_salario_cliente and r.cuota_supera_salario is None and r.fecha_prestamo is not None


@pytest.mark.parametrize("change", [
    {"withheld": ("t",)}, {"log_scale": ("x",)}, {"views": {"a": ("c",), "b": ("c",)}}, {"views": {"a": ("y",)}}, {"winsor_quantile": 1.0},
    {"band_edges": (1, 2), "band_labels": ("a", "b")}, {"band_edges": (20, 30), "band_labels": ("a",), "band_range": (18, 30)}, {"timezone": "Mars/Base"},
])
def test_inconsistent_specs_are_refused(change):
    with pytest.raises(Exception):
        PortfolioSpec(**{"entity_key": "k", "event_timestamp": "t", "target": "y", **change})


def test_strict_schema_and_staleness(spark):
    from pyspark.sql import types as T

    df = spark.createDataFrame([(1, "2")], "a int, b string")
    want = T.StructType([T.StructField("b", T.LongType()), T.StructField("a", T.LongType())])
    assert validate.strict_schema(df, want).first() == (2, 1)
    with pytest.raises(ValueError, match="unexpected"):
        validate.strict_schema(df.withColumn("c", F.lit(1)), want)
    assert validate.stale_fields(want, df) == ["a", "b"] and validate.stale_fields(df.schema, df.drop("a")) == ["a"]
    with pytest.raises(TypeError):
        validate.check_storable(df.withColumn("d", F.array("a")))


def test_contract_refuses_other_columns_types_and_repeated_keys(raw):
    out = loan.prepare_labelled(raw)
    contract = loan.loan_contract(labelled=True)
    cases = [(out.union(out), "key repeats"), (out.withColumn("extra", F.lit(1)), "extra: unexpected"),
             (out.withColumn("plazo_meses", F.col("plazo_meses").cast("string")), "plazo_meses: string instead of bigint"), (out.drop("dti"), "dti: missing")]
    for bad, said in cases:
        with pytest.raises(ValueError, match=said):
            validate.assert_valid(bad, contract)
    assert validate.assert_valid(out.union(out), loan.loan_contract(labelled=True, requests=True)).count() == 2 * out.count()
