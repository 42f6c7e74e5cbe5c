"""The loan portfolio: its spec, contract, scorecard and prepared tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import columns as C
from plumbline.operators import clean as cl
from plumbline.operators import derive as dv
from plumbline.operators.publish import checked
from plumbline.operators.scorecard import Banded, Condition, Lookup, Scorecard
from plumbline.operators.validate import ColumnRule, Contract, assert_valid, check_storable
from plumbline.spec import PortfolioSpec

# --- Fixed values: names, limits and lists the data format and its published rules prescribe. ---
AGE_RANGE = (18, 100)
BUREAU_SCORE_RANGE = (150, 950)
MAX_SALARY = 1_000_000_000
MIN_CAPITAL = 360_000
MAX_TERM_MONTHS = 90
TRENDS = ("Decreciente", "Estable", "Creciente")
PRODUCT_CODES = ("4", "9", "10")
OTHER_PRODUCT = "Otro"
EMPLOYMENT = ("Empleado", "Independiente")
AGE_EDGES = (17, 25, 35, 45, 55, 65, 100)
AGE_LABELS = ("18-25", "26-35", "36-45", "46-55", "56-65", "66+")
KEY_PATTERN = r"^CLI-\d{7}$"
MONTH_PATTERN = r"^\d{4}-\d{2}$"

LOAN_SPEC = PortfolioSpec(
    entity_key="cliente_id",
    event_timestamp="fecha_prestamo",
    target="Pago_atiempo",
    withheld=("puntaje", "mes_prestamo"),
    categoricals={
        "tipo_credito": (*PRODUCT_CODES, OTHER_PRODUCT),
        "tipo_laboral": EMPLOYMENT,
        "tendencia_ingresos": TRENDS,
        "rango_edad": AGE_LABELS,
    },
    integers=(
        "edad_cliente", "salario_cliente", "puntaje_datacredito", "promedio_ingresos_datacredito",
        "saldo_mora", "saldo_total", "saldo_principal",
    ),
    dropped=("saldo_mora_codeudor",),
    watched=(
        "edad_cliente", "salario_cliente", "puntaje_datacredito", "promedio_ingresos_datacredito",
        "tendencia_ingresos", "saldo_total", "saldo_principal", "saldo_mora",
    ),
    missing_prefix="falta_",
    scaled=("saldo_mora", "saldo_total", "saldo_principal"),
    scale_factor=1000,
    heavy_tailed=(
        "capital_prestado", "cuota_pactada", "total_otros_prestamos", "salario_cliente",
        "promedio_ingresos_datacredito", "saldo_total", "saldo_principal", "saldo_mora", "dti", "pti",
        "monto_sobre_ingreso", "ratio_ingreso_declarado_bureau", "creditos_por_anio_adulto",
        "cant_creditosvigentes", "huella_consulta", "creditos_sectorFinanciero",
        "creditos_sectorCooperativo", "creditos_sectorReal",
    ),
    log_scale=(
        "capital_prestado", "cuota_pactada", "total_otros_prestamos", "salario_cliente",
        "promedio_ingresos_datacredito", "saldo_total", "saldo_principal", "saldo_mora", "dti", "pti",
        "monto_sobre_ingreso", "ratio_ingreso_declarado_bureau", "creditos_por_anio_adulto",
    ),
    winsor_quantile=0.99,
    band_edges=AGE_EDGES,
    band_labels=AGE_LABELS,
    band_range=AGE_RANGE,
    views={
        "credito_solicitud": (
            "tipo_credito", "capital_prestado", "plazo_meses", "edad_cliente", "tipo_laboral",
            "salario_cliente", "total_otros_prestamos", "cuota_pactada",
        ),
        "credito_bureau": (
            "puntaje_datacredito", "cant_creditosvigentes", "huella_consulta", "saldo_mora", "saldo_total",
            "saldo_principal", "creditos_sectorFinanciero", "creditos_sectorCooperativo",
            "creditos_sectorReal", "promedio_ingresos_datacredito", "tendencia_ingresos",
        ),
        "credito_derivadas": (
            "cuota_supera_salario", "dti", "pti", "monto_sobre_ingreso", "ratio_ingreso_declarado_bureau",
            "creditos_por_anio_adulto", "tiene_mora_bureau", "rango_edad",
        ),
        "credito_faltantes": (
            "falta_edad_cliente", "falta_salario_cliente", "falta_puntaje_datacredito",
            "falta_promedio_ingresos_datacredito", "falta_tendencia_ingresos", "falta_saldo_total",
            "falta_saldo_principal", "falta_saldo_mora",
        ),
    },
)

LOAN_CARD = Scorecard(
    rules={
        "bureau_score_band": Banded("puntaje_datacredito", (770, 813), (2, -1, -2), missing=2, closed="left"),
        "inquiry_band": Banded("huella_consulta", (3, 6), (-1, 0, 2)),
        "age_band": Lookup(
            "rango_edad", {"18-25": 3, "26-35": 1, "36-45": -1, "46-55": -1, "56-65": 0, "66+": -1}, missing=2
        ),
        "young_independent": Condition(
            ("edad_cliente", "tipo_laboral"),
            lambda: (F.col("tipo_laboral") == "Independiente") & (F.col("edad_cliente") < 36), 3,
        ),
        "income_gap_quartile": Banded(
            "ratio_ingreso_declarado_bureau", (1.081, 1.807, 3.594), (-1, -1, 0, 1), closed="left"
        ),
        "decreasing_income_trend": Lookup("tendencia_ingresos", {"Decreciente": 1, "Estable": 0, "Creciente": -1}),
        "high_amount_long_term": Condition(
            ("capital_prestado", "plazo_meses"),
            lambda: (F.col("capital_prestado") >= 3_084_840) & (F.col("plazo_meses") >= 13), 5,
        ),
        "missing_bureau_income": Condition(
            ("promedio_ingresos_datacredito",), lambda: F.col("promedio_ingresos_datacredito").isNull(), 1
        ),
    },
    threshold=4, bands=10, band_minimum=200, base_rate=0.0475, lift_multiplier=4,
)

RAW_SCHEMA = T.StructType([
    T.StructField(name, kind) for name, kind in (
        ("cliente_id", T.StringType()), ("tipo_credito", T.StringType()), ("fecha_prestamo", T.StringType()),
        ("capital_prestado", T.LongType()), ("plazo_meses", T.LongType()), ("edad_cliente", T.LongType()),
        ("tipo_laboral", T.StringType()), ("salario_cliente", T.LongType()),
        ("total_otros_prestamos", T.LongType()), ("cuota_pactada", T.LongType()), ("puntaje", T.StringType()),
        ("puntaje_datacredito", T.DoubleType()), ("cant_creditosvigentes", T.LongType()),
        ("huella_consulta", T.LongType()), ("saldo_mora", T.DoubleType()), ("saldo_total", T.DoubleType()),
        ("saldo_principal", T.DoubleType()), ("saldo_mora_codeudor", T.DoubleType()),
        ("creditos_sectorFinanciero", T.LongType()), ("creditos_sectorCooperativo", T.LongType()),
        ("creditos_sectorReal", T.LongType()), ("promedio_ingresos_datacredito", T.DoubleType()),
        ("tendencia_ingresos", T.StringType()), ("Pago_atiempo", T.StringType()),
    )
])
# Defaults a scoring request may leave out; everything else absent becomes NULL of its type.
SERVING_DEFAULTS = {
    "total_otros_prestamos": 0, "cant_creditosvigentes": 0, "huella_consulta": 0,
    "creditos_sectorFinanciero": 0, "creditos_sectorCooperativo": 0, "creditos_sectorReal": 0,
}
# --- End of fixed values. ---


def nullify_sentinels(df: DataFrame) -> DataFrame:
    """Values the source writes to mean "unknown" become NULL; no row is dropped."""
    salary, observed = F.col("salario_cliente"), F.col("promedio_ingresos_datacredito")
    return df.withColumns({
        "edad_cliente": C.null_outside("edad_cliente", *AGE_RANGE),
        "puntaje_datacredito": C.null_outside("puntaje_datacredito", *BUREAU_SCORE_RANGE),
        "salario_cliente": C.null_where(salary, (salary <= 0) | (salary > MAX_SALARY)),
        "promedio_ingresos_datacredito": C.null_where(observed, observed <= 0),
        "tendencia_ingresos": C.null_unless_in("tendencia_ingresos", TRENDS),
    })


def coerce_types(df: DataFrame, spec: PortfolioSpec = LOAN_SPEC) -> DataFrame:
    when = df.schema[spec.event_timestamp].dataType
    casts = {c: C.to_long(c) for c in spec.integers}
    if isinstance(when, T.StringType):
        casts[spec.event_timestamp] = C.parse_dayfirst(spec.event_timestamp)
    if "puntaje" in df.columns:
        casts["puntaje"] = C.parse_decimal_comma("puntaje")
    if spec.target in df.columns:
        casts[spec.target] = cl.parse_bool_strict(spec.target, spec.target)
    casts["tipo_laboral"] = C.null_unless_in("tipo_laboral", EMPLOYMENT)
    casts["tendencia_ingresos"] = C.null_unless_in("tendencia_ingresos", TRENDS)
    return df.withColumns(casts)


def clean(df: DataFrame, spec: PortfolioSpec = LOAN_SPEC) -> DataFrame:
    """Sentinels to NULL, unusable columns out, types, units, residual product codes, inconsistency flag."""
    out = cl.drop_columns(nullify_sentinels(df), spec.dropped)
    out = cl.scale_columns(coerce_types(out, spec), spec.scaled, spec.scale_factor)
    return out.withColumns({
        "tipo_credito": cl.group_rare("tipo_credito", PRODUCT_CODES, OTHER_PRODUCT),
        # NULL when the salary is unknown: an unverifiable instalment is not an affordable one.
        "cuota_supera_salario": F.col("cuota_pactada") > F.col("salario_cliente"),
    })


def derive(df: DataFrame, spec: PortfolioSpec = LOAN_SPEC) -> DataFrame:
    out = dv.affordability(
        df,
        {"dti": "total_otros_prestamos", "pti": "cuota_pactada", "monto_sobre_ingreso": "capital_prestado"},
        "salario_cliente",
    )
    out = out.withColumns({
        "ratio_ingreso_declarado_bureau": C.ratio("salario_cliente", "promedio_ingresos_datacredito"),
        "creditos_por_anio_adulto": dv.per_year("cant_creditosvigentes", "edad_cliente", AGE_RANGE[0]),
        "tiene_mora_bureau": dv.positive_flag("saldo_mora"),
        "rango_edad": C.band("edad_cliente", AGE_EDGES, AGE_LABELS),
        "mes_prestamo": C.vintage(spec.event_timestamp),
    })
    return dv.missing_flags(out, spec.watched, spec.missing_prefix)


def loan_columns(labelled: bool = False) -> tuple[ColumnRule, ...]:
    """What each column of a prepared table promises."""
    counts = (
        "total_otros_prestamos", "cant_creditosvigentes", "huella_consulta",
        "creditos_sectorFinanciero", "creditos_sectorCooperativo", "creditos_sectorReal",
    )
    rules = [
        ColumnRule("cliente_id", T.StringType(), pattern=KEY_PATTERN),
        ColumnRule("tipo_credito", T.StringType(), isin=LOAN_SPEC.categoricals["tipo_credito"]),
        ColumnRule("fecha_prestamo", T.TimestampType()),
        ColumnRule("capital_prestado", T.LongType(), ge=MIN_CAPITAL),
        ColumnRule("plazo_meses", T.LongType(), ge=1, le=MAX_TERM_MONTHS),
        ColumnRule("edad_cliente", T.LongType(), nullable=True, ge=AGE_RANGE[0], le=AGE_RANGE[1]),
        ColumnRule("tipo_laboral", T.StringType(), isin=EMPLOYMENT),
        ColumnRule("salario_cliente", T.LongType(), nullable=True, gt=0, le=MAX_SALARY),
        ColumnRule("cuota_pactada", T.LongType(), gt=0),
        ColumnRule("puntaje", T.DoubleType(), nullable=True),
        ColumnRule("puntaje_datacredito", T.LongType(), nullable=True, ge=BUREAU_SCORE_RANGE[0], le=BUREAU_SCORE_RANGE[1]),
        *[ColumnRule(c, T.LongType(), ge=0) for c in counts],
        *[ColumnRule(c, T.LongType(), nullable=True, ge=0) for c in ("saldo_mora", "saldo_total", "saldo_principal")],
        ColumnRule("promedio_ingresos_datacredito", T.LongType(), nullable=True, gt=0),
        ColumnRule("tendencia_ingresos", T.StringType(), nullable=True, isin=TRENDS),
        ColumnRule("cuota_supera_salario", T.BooleanType(), nullable=True),
        *[
            ColumnRule(c, T.DoubleType(), nullable=True, ge=0)
            for c in ("dti", "pti", "monto_sobre_ingreso", "ratio_ingreso_declarado_bureau", "creditos_por_anio_adulto")
        ],
        ColumnRule("tiene_mora_bureau", T.BooleanType(), nullable=True),
        ColumnRule("rango_edad", T.StringType(), nullable=True, isin=AGE_LABELS),
        ColumnRule("mes_prestamo", T.StringType(), pattern=MONTH_PATTERN),
        *[ColumnRule(f"falta_{c}", T.BooleanType()) for c in LOAN_SPEC.watched],
    ]
    if labelled:
        rules.append(ColumnRule("Pago_atiempo", T.BooleanType()))
    return tuple(rules)


def loan_contract(labelled: bool = False, requests: bool = False) -> Contract:
    """The promises of a prepared table; scoring uses the unlabelled one and never needs the outcome. Requests may share one id and
    carry columns of their own."""
    return Contract(
        columns=loan_columns(labelled),
        row_rules={
            "saldo_principal_no_supera_total": F.col("saldo_principal") <= F.col("saldo_total"),
            # today counts as past at every hour
            "fecha_prestamo_no_es_futura": F.to_date("fecha_prestamo") <= F.current_date(),
        },
        key=() if requests else ("cliente_id",),
        strict=not requests,
    )


def prepare_features(raw: DataFrame, check: bool = True, requests: bool = True) -> DataFrame:
    """Clean, derive and validate; the outcome is dropped if present. Requests are checked row by row as they pass. requests=False holds a
    table to its key and its columns too: it is written, checked by that write and read back."""
    out = derive(clean(raw.drop(LOAN_SPEC.target)))
    if not check:
        return out
    return assert_valid(out, loan_contract(requests=True)) if requests else checked(out, loan_contract(), "features")


def prepare_labelled(raw: DataFrame, check: bool = True) -> DataFrame:
    if LOAN_SPEC.target not in raw.columns:
        raise ValueError(f"the labelled table needs {LOAN_SPEC.target}")
    out = derive(clean(raw))
    return checked(out, loan_contract(labelled=True), "labelled") if check else out


def build_feature_table(prepared: DataFrame, spec: PortfolioSpec = LOAN_SPEC) -> DataFrame:
    """Entity key, UTC event timestamp, then every row-independent feature; the label never enters."""
    ts = F.col(spec.event_timestamp)
    kind = prepared.schema[spec.event_timestamp].dataType
    at = F.to_utc_timestamp(ts.cast("timestamp"), spec.timezone) if spec.timezone != "UTC" else ts.cast("timestamp")
    if isinstance(kind, T.TimestampType) and spec.timezone == "UTC":
        at = ts
    names = spec.feature_names(prepared.columns)
    return check_storable(prepared.select(spec.entity_key, at.alias(spec.event_timestamp), *names))


def serving_frame(requests: DataFrame, default_id: str = "CLI-0000000") -> DataFrame:
    """What clean() expects from a scoring request: absent columns as typed NULLs or their defaults."""
    have = set(requests.columns)
    out = {}
    for f in RAW_SCHEMA:
        if f.name in (LOAN_SPEC.target, "saldo_mora_codeudor"):
            continue
        if f.name == LOAN_SPEC.event_timestamp:
            given = F.col(f.name) if f.name in have else F.lit(None)
            text = f.name in have and isinstance(requests.schema[f.name].dataType, T.StringType)
            given = C.parse_dayfirst(given) if text else given.cast("timestamp")
            out[f.name] = F.coalesce(given, F.current_timestamp())
        elif f.name == LOAN_SPEC.entity_key:
            out[f.name] = F.lit(default_id)
        elif f.name not in have:
            out[f.name] = F.lit(SERVING_DEFAULTS.get(f.name)).cast(f.dataType)
        elif f.name in SERVING_DEFAULTS:
            out[f.name] = F.coalesce(F.col(f.name), F.lit(SERVING_DEFAULTS[f.name])).cast(f.dataType)
    return requests.withColumns(out)
