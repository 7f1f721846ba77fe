"""Registered queries: pipelines (survey N1-N4) and the training-table rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as X
from ..roles import ColumnRoles
from ..sources import analogues as an
from . import catalog_mart as CM
from .catalog_tables import newest_sql, rank_sql
from .increment import PROVIDER_COLS, build_training_table, run_increment
from .registry import query
from .scoring import score_and_publish, train_and_audit

N1_FROM, N1_TO, N1_ASOF = "1999-07-01", "2001-08-01", "2001-08-02"
# The increment's claims: as everywhere, and with doctor, local provider and employer.
N1_CLAIMS = [*an.CLAIMS_FROM_ORDERS, "CAST(o_orderkey % 97 AS STRING) AS LCC_MEDRUT",
             "CAST(o_orderkey % 13 AS STRING) AS LCC_LOCAL", "CAST(o_custkey % 50 AS STRING) AS LCC_EMPRUT"]
# entity column -> suffix of its monthly columns
N1_ENTITIES = {"AFILIADO_RUT": "MES", "LCC_MEDRUT": "MEDICO", "LCC_LOCAL": "LOCAL", "LCC_EMPRUT": "EMPLEADOR"}
N1_PROVIDERS = [
    "LCC_MEDRUT AS PRESTADOR_RUT", "FECHA_RECEPCION", "CAST(LCC_COMCOD AS STRING) AS PRESTADOR_ESPECIALIDAD_PSC",
    "RESOLUCION_COMPIN AS PREST_TOP_CIE_F", "CASE WHEN DIASSOLICITADO > 20 THEN 'LARGAS' END AS PREST_TOP_GRUPOCIE",
    "CASE WHEN LCC_COMCOD = 1 THEN 'MEDICO' ELSE 'OTRO' END AS PRESTADOR_TIPO",
    "CAST(FECHA_RECEPCION - 900 AS DATE) AS PREST_FECHA_INGRESO",
]
N1_METRICS = ["CANT_LIC_U15D", "COMPIN_RATIFICA_U15D", "TOTAL_DIAS_SOLICITADOS_U15D", "RATIO_APROBACION_U15D",
              "HV_N_PRESTACIONES_U15D", "PERITAJES_TOTAL_U15D", "PERITAJES_DESACUERDO_U15D", "DIAS_DESDE_ULTIMO_PERITAJE_U15D"]
N1_MONTHLY = [f"{c}_{x}" for x in N1_ENTITIES.values() for c in ("LM", "MONTO")]
N1_COLS = ["AFILIADO_RUT", "LCC_COMCOR", "LCC_COMCOD", "FECHA_RECEPCION", "RN_AFILIADO_HIST", *PROVIDER_COLS,
           *[f"PERIODO_{e}" for e in N1_ENTITIES], *N1_MONTHLY, "MONTO_POR_LM", *N1_METRICS]
# The metrics table before the run: claims received in these days, one of the months inside the increment.
N1_OLD_FROM, N1_OLD_TO = "1999-06-01", "1999-07-31"
N1_OLD = ["AFILIADO_RUT", "LCC_COMCOR", "LCC_COMCOD", "CAST(-1 AS BIGINT) AS CANT_LIC_U15D",
          "CAST(0.5 AS DOUBLE) AS RATIO_APROBACION_U15D", "CAST(NULL AS INT) AS DIAS_DESDE_ULTIMO_PERITAJE_U15D"]


def _n1_parts() -> str:
    keys = "AFILIADO_RUT, LCC_COMCOR, LCC_COMCOD"
    return f"""
WITH claims AS (SELECT {', '.join(N1_CLAIMS)} FROM orders),
fresh AS (SELECT * FROM claims WHERE FECHA_RECEPCION BETWEEN DATE '{N1_FROM}' AND DATE '{N1_TO}'),
measured AS (
  SELECT {keys}, {', '.join(N1_METRICS)}
  FROM fresh JOIN ({CM.D1_SQL}) USING ({keys}) JOIN ({CM.D2_SQL}) USING ({keys}) JOIN ({CM.D3_ORDERS_SQL}) USING ({keys})
)"""


def _n1_sql() -> str:
    monthly, newest, joins, shown = [], [], [], []
    for e, x in N1_ENTITIES.items():
        monthly.append(f"m_{x} AS (SELECT {e}, strftime(FECHA_RECEPCION, '%m%Y') AS PERIODO, count(*) AS LM_{x}, "
                       f"sum(DIASSOLICITADO)::DOUBLE AS MONTO_{x} FROM claims GROUP BY ALL)")
        newest.append(f"n_{x} AS ({newest_sql(f'm_{x}', e, N1_ASOF, [f'LM_{x}', f'MONTO_{x}'])})")
        joins.append(f"LEFT JOIN n_{x} USING ({e})")
        shown.append(f"n_{x}.newest.PERIODO AS PERIODO_{e}, ifnull(n_{x}.newest.LM_{x}, 0) AS LM_{x}, "
                     f"ifnull(n_{x}.newest.MONTO_{x}, 0) AS MONTO_{x}")
    return f"""{_n1_parts()},
{', '.join(monthly)}, {', '.join(newest)},
provider AS (
  SELECT DISTINCT ON (PRESTADOR_RUT) * FROM (SELECT {', '.join(N1_PROVIDERS)} FROM claims)
  WHERE FECHA_RECEPCION < DATE '{N1_ASOF}' - 1
  ORDER BY PRESTADOR_RUT, FECHA_RECEPCION DESC, {', '.join(c + ' DESC NULLS LAST' for c in PROVIDER_COLS)}
),
ranks AS ({rank_sql(f"FECHA_RECEPCION < DATE '{N1_FROM}'", f"FECHA_RECEPCION BETWEEN DATE '{N1_FROM}' AND DATE '{N1_TO}'")})
SELECT AFILIADO_RUT, LCC_COMCOR, LCC_COMCOD, fresh.FECHA_RECEPCION, RN_AFILIADO_HIST, {', '.join(PROVIDER_COLS)},
  {', '.join(shown)},
  round(CASE n_MES.newest.LM_MES WHEN 0 THEN 0 ELSE n_MES.newest.MONTO_MES / n_MES.newest.LM_MES END, 6) AS MONTO_POR_LM,
  {', '.join(N1_METRICS)}
FROM fresh JOIN measured USING (AFILIADO_RUT, LCC_COMCOR, LCC_COMCOD) JOIN ranks USING (AFILIADO_RUT, LCC_COMCOR, LCC_COMCOD)
LEFT JOIN provider ON PRESTADOR_RUT = LCC_MEDRUT {' '.join(joins)}
"""


def _n1_monthly(claims, entity, suffix):
    return (claims.groupBy(entity, F.date_format("FECHA_RECEPCION", "MMyyyy").alias("PERIODO"))
                  .agg(F.count(F.lit(1)).alias(f"LM_{suffix}"),
                       F.sum("DIASSOLICITADO").cast("double").alias(f"MONTO_{suffix}")))


def _n1(spark, sf_dir):
    claims = an.table(spark, sf_dir, "orders").selectExpr(*N1_CLAIMS)
    base = claims.where(F.col("FECHA_RECEPCION") < F.lit(N1_FROM).cast("date"))
    wide = base.select("AFILIADO_RUT", "FECHA_RECEPCION", "LCC_COMCOR", "LCC_COMCOD")
    old = claims.where(F.col("FECHA_RECEPCION").between(F.lit(N1_OLD_FROM).cast("date"), F.lit(N1_OLD_TO).cast("date")))
    return run_increment(claims, base, old.selectExpr(*N1_OLD), wide, an.services_from_lineitem(spark, sf_dir),
                         an.exams_from_lineitem(spark, sf_dir), N1_FROM, N1_TO, N1_ASOF,
                         provider_history=claims.selectExpr(*N1_PROVIDERS),
                         monthly={e: _n1_monthly(claims, e, x) for e, x in N1_ENTITIES.items()},
                         monthly_defaults={c: 0 for c in N1_MONTHLY},
                         ratios={"MONTO_POR_LM": ("MONTO_MES", "LM_MES")})


@query("n1_run_increment", ("N1", "A6", "B9", "B14", "C1", "C2", "C6", "C7", "C8", "D1", "D2", "D3", "E2"), _n1_sql())
def n1_run_increment(spark, sf_dir):
    r = _n1(spark, sf_dir)
    out = r.new_wide.select(*N1_COLS)
    return out.withColumn("RATIO_APROBACION_U15D", F.round("RATIO_APROBACION_U15D", 6)) \
              .withColumn("MONTO_POR_LM", F.round("MONTO_POR_LM", 6))


@query("n1_metrics_upsert", ("N1", "A8", "D1", "D3"), f"""{_n1_parts()},
written AS (
  SELECT AFILIADO_RUT, LCC_COMCOR, LCC_COMCOD, CANT_LIC_U15D, RATIO_APROBACION_U15D, DIAS_DESDE_ULTIMO_PERITAJE_U15D FROM measured
)
FROM written UNION ALL
SELECT {', '.join(N1_OLD)} FROM claims
WHERE FECHA_RECEPCION BETWEEN DATE '{N1_OLD_FROM}' AND DATE '{N1_FROM}' - 1""")
def n1_metrics_upsert(spark, sf_dir):
    """The metrics table after the increment: kept, replaced and added rows."""
    return _n1(spark, sf_dir).metrics_table.withColumn("RATIO_APROBACION_U15D", F.round("RATIO_APROBACION_U15D", 6))


# ---------------------------------------------------------------- N2
WIDE_FROM_CLAIMS = [
    "AFILIADO_RUT", "LCC_COMCOR", "LCC_COMCOD", "FECHA_RECEPCION", "RESOLUCION_COMPIN", "FECHA_RESOLUCION_COMPIN",
    "DIASSOLICITADO",
    "CAST(FECHA_RECEPCION - CAST(LCC_COMCOD AS INTEGER) AS DATE) AS FECHA_EMISION_DT",
    "CAST(FECHA_RECEPCION - 3 AS TIMESTAMP) AS FECHA_INICIO",
    "CAST(FECHA_RECEPCION + CAST(DIASSOLICITADO AS INTEGER) AS TIMESTAMP) AS FECHA_TERMINO",
    "CASE LCC_COMCOD WHEN 1 THEN DATE '1900-01-01' WHEN 2 THEN NULL "
    "ELSE CAST(FECHA_RECEPCION + CAST(40 - LCC_COMCOD * 15 AS INTEGER) AS DATE) END AS FECHA_EMP_RECEPCION",
    "CASE WHEN LCC_COMCOD = 3 THEN CAST(FECHA_RECEPCION + 2 AS DATE) "
    "WHEN LCC_COMCOD >= 4 THEN CAST(FECHA_RECEPCION + 10 AS DATE) END AS FECHA_EMP_ENVIO",
    "CASE WHEN RESOLUCION_COMPIN = 'RATIFICA' THEN ' femenino ' WHEN RESOLUCION_COMPIN IS NULL THEN 'x' "
    "WHEN LCC_COMCOD = 2 THEN 'Masc' ELSE 'M' END AS COT_GENERO",
    "CASE WHEN LCC_COMCOD <= 2 THEN '' ELSE 'ETIQUETA' END AS TIPO_F_LM",
    "CAST(CASE WHEN LCC_COMCOD <= 2 THEN 0 ELSE 9 END AS BIGINT) AS TIPO_F_LM_COD",
    "CAST(LCC_COMCOD + 3 AS BIGINT) AS lic_codigo_tipo_licencia",
    "CASE LCC_COMCOD WHEN 1 THEN '48123456-K' WHEN 2 THEN 'abc-1' WHEN 3 THEN NULL "
    "ELSE AFILIADO_RUT || '-5' END AS PRESTADOR_RUT",
    "CASE WHEN RESOLUCION_COMPIN = 'RATIFICA' THEN 'medico' ELSE 'otro' END AS PRESTADOR_TIPO",
    "CAST(FECHA_RECEPCION - 400 AS DATE) AS FECHA_SUSCR_CONTRATO",
    "DATE '1990-01-15' AS FECHA_INGRESO_PREST",
    "CASE WHEN RESOLUCION_COMPIN IS NULL THEN 'S' ELSE 'N' END AS CONTINUA_CALC",
    "CASE WHEN LCC_COMCOD > 3 THEN CAST(FECHA_RECEPCION - 30 AS DATE) END AS EPISODIO_FEC_INI",
    "CASE WHEN RESOLUCION_COMPIN IS NULL THEN 'EN VISACION' ELSE 'RESUELTA' END AS ESTADO_LM",
    "CASE WHEN LCC_COMCOD = 5 THEN CAST(floor(DIASSOLICITADO / 2) AS BIGINT) ELSE F_DIASAUTORIZADOS END AS I_DIASAUTORIZADOS",
    "CASE WHEN LCC_COMCOD = 4 THEN 'SIN OBSERVACIONES' END AS REC_GLS_CAUMOD",
    "CASE WHEN LCC_COMCOD = 4 AND RESOLUCION_COMPIN = 'deniega' THEN 'X' END AS PERITAJE_FALLO_1",
    "CASE LCC_COMCOD WHEN 1 THEN 'PARTO' WHEN 2 THEN 'PSIQUIATRICAS' WHEN 3 THEN NULL ELSE 'OTRAS' END AS CIE_GRUPO",
    "CASE WHEN DIASSOLICITADO < 3 THEN 1 ELSE 0 END AS PASO_FASTTRACK",
]
N2_COLS = ["AFILIADO_RUT", "LCC_COMCOR", "LCC_COMCOD", "FECHA_EMP_RECEPCION", "DIAS_RECEPCION_A_EMPLEADOR",
           "DIAS_RECEPCION_A_ENVIO", "DIAS_INICIO_A_RECEPCION", "DIAS_INICIO_A_EMISION", "DIAS_EMISION_A_RECEPCION",
           "ENVIO_TARDIO_EMPLEADOR", "COT_GENERO", "TIPO_F_LM", "TIPO_F_LM_COD", "MEDICO_EXTRANJERO", "IS_MEDICO",
           "MESES_DESDE_CONTRATO", "MESES_ANTIGUEDAD_PRESTADOR", "EPISODIO_FEC_INI", "EPISODIO_ACUM_DIAS",
           "LEAK_DIASAUTORIZADOS", "LEAK_FT", "TARGET_PERITAJE", "TARGET_PERITAJE2", "TARGET_RECHAZA",
           "TARGET_MODIFICA", "TARGET_APRUEBA", "TARGET_RATIFICA", "TARGET_REQUIERE_REVISION", "TARGET_FT2",
           "TARGET_FT3"]
N2_ASOF = "2001-06-01"


# Fixed values of the training table, once more for the oracle: leave types, gender words, birth groups.
N2_LABELS = {1: "ENFERMEDAD COMUN", 2: "PRORROGA MEDICINA PREVENTIVA", 3: "MATERNAL", 4: "ENFERM. HIJO < 1 AÑO",
             5: "ACCIDENTE DEL TRABAJO", 6: "ENFERMEDAD PROFESIONAL", 7: "PATOLOGIA DEL EMBARAZO"}
N2_GENDERS = {"F": "Fem", "FEM": "Fem", "FEMENINO": "Fem", "M": "Masc", "MASC": "Masc", "MASCULINO": "Masc"}
N2_BIRTH = ("PARTO", "PUERPERIO")
N2_VERDICTS = {"RATIFICA": 1, "DENIEGA": 0}


def _values(name: str, columns: str, rows: dict) -> str:
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else str(v)
    return f"{name}({columns}) AS (VALUES {', '.join(f'({lit(k)}, {lit(v)})' for k, v in rows.items())})"


def _n2_sql() -> str:
    """Rule tables joined, then facts of a claim, then columns from facts."""
    gaps = {"DIAS_RECEPCION_A_EMPLEADOR": "at_employer - received", "DIAS_RECEPCION_A_ENVIO": "sent - received",
            "DIAS_INICIO_A_RECEPCION": "received - began", "DIAS_INICIO_A_EMISION": "issued - began",
            "DIAS_EMISION_A_RECEPCION": "received - issued"}
    months = {"MESES_DESDE_CONTRATO": "FECHA_SUSCR_CONTRATO", "MESES_ANTIGUEDAD_PRESTADOR": "FECHA_INGRESO_PREST"}
    return f"""
WITH {CM._claims_cte()}, {_values("leave_types", "code, label", N2_LABELS)}, {_values("genders", "word, gender", N2_GENDERS)},
{_values("verdicts", "verdict, upheld", N2_VERDICTS)},
facts AS (
  SELECT m.*, label, gender, upheld,
    nullif(FECHA_EMP_RECEPCION, DATE '1900-01-01') AS at_employer, nullif(FECHA_EMP_ENVIO, DATE '1900-01-01') AS sent,
    FECHA_RECEPCION AS received, FECHA_INICIO::DATE AS began, FECHA_EMISION_DT AS issued, FECHA_TERMINO::DATE AS ended,
    ifnull(EPISODIO_FEC_INI, FECHA_INICIO::DATE) AS episode,
    upper(ESTADO_LM) <> 'EN VISACION' AS settled,
    I_DIASAUTORIZADOS AS granted, DIASSOLICITADO AS asked, granted < asked AS short, granted = asked AND granted > 0 AS whole,
    ifnull(CIE_GRUPO IN {N2_BIRTH}, false) AS birth, ifnull(REC_GLS_CAUMOD = 'SIN OBSERVACIONES', false) AS clear
  FROM (SELECT {', '.join(WIDE_FROM_CLAIMS)} FROM claims) m
  LEFT JOIN leave_types ON code = lic_codigo_tipo_licencia
  LEFT JOIN genders ON word = upper(trim(COT_GENERO))
  LEFT JOIN verdicts ON verdict = upper(RESOLUCION_COMPIN)
)
SELECT AFILIADO_RUT, LCC_COMCOR, LCC_COMCOD, at_employer AS FECHA_EMP_RECEPCION,
  {', '.join(f"if({g} IS NULL, NULL, greatest(-30, least(30, {g})))::INT AS {n}" for n, g in gaps.items())},
  {', '.join(f"(date_diff('month', {c}, received))::INT AS {n}" for n, c in months.items())},
  (sent - at_employer > 3)::INT AS ENVIO_TARDIO_EMPLEADOR,
  gender AS COT_GENERO,
  if(TIPO_F_LM = '' OR TIPO_F_LM IS NULL, ifnull(label, 'OTRO'), TIPO_F_LM) AS TIPO_F_LM,
  if(ifnull(TIPO_F_LM_COD, 0) = 0, ifnull(lic_codigo_tipo_licencia, 0), TIPO_F_LM_COD) AS TIPO_F_LM_COD,
  ifnull(regexp_matches(PRESTADOR_RUT, '^4[89][0-9]{{6}}(-|$)'), false)::INT AS MEDICO_EXTRANJERO,
  (ifnull(lower(PRESTADOR_TIPO), '') = 'medico')::INT AS IS_MEDICO,
  episode AS EPISODIO_FEC_INI,
  (ended - if(CONTINUA_CALC = 'S', episode, began) + 1)::INT AS EPISODIO_ACUM_DIAS,
  if(settled, granted, NULL) AS LEAK_DIASAUTORIZADOS, PASO_FASTTRACK AS LEAK_FT,
  if(settled, 0, NULL) AS TARGET_PERITAJE, if(settled, 0, NULL) AS TARGET_PERITAJE2,
  if(settled, ifnull(granted = 0, false)::INT, NULL) AS TARGET_RECHAZA,
  if(settled, ifnull(short AND asked > 0, false)::INT, NULL) AS TARGET_MODIFICA,
  if(settled AND (whole OR short), whole::INT, NULL) AS TARGET_APRUEBA,
  upheld AS TARGET_RATIFICA,
  (issued IS NOT NULL)::INT AS TARGET_REQUIERE_REVISION,
  if(settled AND granted IS NOT NULL AND NOT birth, (whole OR (clear AND PERITAJE_FALLO_1 IS NULL))::INT, NULL) AS TARGET_FT2,
  if(settled AND PASO_FASTTRACK <> 1 AND NOT birth, (clear OR ifnull(whole, false))::INT, NULL) AS TARGET_FT3
FROM facts WHERE issued < DATE '{N2_ASOF}'
"""


def _wide(spark, sf_dir):
    return an.claims_from_orders(spark, sf_dir).selectExpr(*WIDE_FROM_CLAIMS)


@query("n2_build_training_table", ("N2", "B1", "B2", "B3", "B4", "B5", "B6", "B7", "B8", "B9", "B11", "B12"),
       _n2_sql())
def n2_build_training_table(spark, sf_dir):
    return build_training_table(_wide(spark, sf_dir), N2_ASOF).select(*N2_COLS)


# ---------------------------------------------------------------- N3, N4 (rows only)
def _train_table(spark, sf_dir):
    t = build_training_table(_wide(spark, sf_dir), "2001-09-01", spec=["RESOLUCION_COMPIN"])
    return t.withColumn("CIE_GRUPO", F.coalesce("CIE_GRUPO", F.lit("OTRAS")))


N34_FEATURES = ["DIASSOLICITADO", "DIAS_INICIO_A_EMISION", "MESES_DESDE_CONTRATO", "EPISODIO_ACUM_DIAS",
                "TIPO_F_LM_COD", "IS_MEDICO"]
N34_KEYS = ["AFILIADO_RUT", "LCC_COMCOR", "LCC_COMCOD"]
N34_ROLES = ColumnRoles(keys=N34_KEYS, dates=["FECHA_RECEPCION"], categorical=["COT_GENERO", "TIPO_F_LM"],
                        numeric=N34_FEATURES, binary=[], text=[])


def _feature_model() -> X.FeatureModel:
    return X.FeatureModel(dates=["FECHA_RECEPCION"], categorical=["COT_GENERO", "TIPO_F_LM"], numeric=N34_FEATURES)


@query("n4_train_and_audit", ("N4", "A2", "I8", "J3", "K1", "K2", "K4", "K5", "L9"))
def n4_train_and_audit(spark, sf_dir):
    """The documented training run but for the number of rounds (see README); tuning is left to K3's query."""
    r = train_and_audit(_train_table(spark, sf_dir), "TARGET_FT3", _feature_model(), N34_KEYS, roles=N34_ROLES,
                        params={"maxIter": 10})
    return r["summary"]


@query("n3_score_and_publish", ("N3", "A4", "A9", "A10", "A12", "B18", "B19", "G1", "I8", "K4", "M2", "M5", "M6", "D10"))
def n3_score_and_publish(spark, sf_dir):
    """Two publishing runs with a fitted feature model: the second (overlapping period) merges into the
    first run's published predictions with first-write-wins on the decision columns."""
    import uuid

    from ..functions.contract import predictions_contract
    from ..operators import model as K
    from ..session import ensure_checkpoint_dir
    t = _train_table(spark, sf_dir)
    fm = _feature_model()
    lab = K.bounded_labelled(t.select(*N34_KEYS, "FECHA_RECEPCION", "COT_GENERO", "TIPO_F_LM", *N34_FEATURES, "TARGET_FT3"), "TARGET_FT3", N34_KEYS)
    x = fm.fit_transform(lab, exclude=["TARGET_FT3", *N34_KEYS])
    feats = [c for c in fm.numeric_names(x) if c not in N34_KEYS and c != "TARGET_FT3"]
    val = K.stratified_split(x, "TARGET_FT3", N34_KEYS, 0.1, 43, split_col="__part", bounded=True)
    model = K.train_classifier(val.withColumn("__is_val", F.col("__part") == "test").drop("__part"), feats, "TARGET_FT3",
                               validation_col="__is_val", params={"maxIter": 10})
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/predictions-{uuid.uuid4().hex}"
    runs = [("2000-01-01", "1995-01-01", "1999-12-31"), ("2001-09-01", "1999-01-01", "2001-08-01")]
    for as_of, date_from, date_to in runs:
        r = score_and_publish(t, model, fm, feats, as_of=as_of, date_from=date_from, date_to=date_to, label="TARGET_FT3",
                              prior="LEAK_FT", contract=predictions_contract(), publish_path=path)
    return r["merged"].select("AFILIADO_RUT", "LCC_COMCOR", "PROBABILIDAD_APROBACION", "SEMAFORO",
                              "UMBRAL_VERDE", "UMBRAL_AMARILLO", "GLOSA_GENERADA", "ES_PENDIENTE",
                              "FECHA_PROCESAMIENTO", "FECHA_DESDE", "FECHA_HASTA")
