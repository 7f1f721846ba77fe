"""Registered queries: the wide table and the training table with their whole column sets (survey N1, N2, B9, B10, B14).

Inputs are claims of the test tables with a value for every column of the mart, derived from the order by a rule that
differs from column to column, so that a column taken for another one, or without its default, shows.  The lists below are
the oracle's own; none is taken from ``mart_spec``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import analogues as an
from . import catalog_mart as CM
from .catalog_pipelines import N1_ASOF, N1_FROM, N1_TO, N2_ASOF, WIDE_FROM_CLAIMS, _n2_sql
from .catalog_tables import newest_sql, rank_sql
from .increment import build_training_table, run_increment
from .mart_spec import wide_spec
from .registry import query

# The claim's columns in the wide table, by type.
CLAIM_TEXTS = """LCC_OPERADOR lic_id_licencia CONTINUA_CALC TIPO_F_LM CIE_F CIE_F_COD LM_DIAGNOSTICO LM_ANTECEDENTES_CLINICOS
MED_CLASIFICACION MED_ESPECIALIDAD_LME EMPLEADOR_MULTIEMPLEADO COMUNA_REPOSO COMUNA_EMISION CALIDAD_TRABAJADOR LM_FORMATO
LM_REPOSO_TIPO N_LICENCIA lic_rut_trabajador lic_dv_trabajador lic_rut_profesional lic_pro_especialidad lic_pro_tipo
lic_pro_dir_comuna lic_diag_principal lic_cie10_principal lic_antecedentes_clinicos lic_rut_empleador lic_codigo_calidad_trab
lic_codigo_tipo_reposo COT_GENERO lic_reposo_dir_comuna1 PRESTADOR_LOCAL_TIPO_COD PRESTADOR_LOCAL_TIPO COMPIN_CNT
PERITAJE_FALLO_1 REC_LCC_VISJUS REC_GLS_CAUMOD PRESTADOR_ESPECIALIDAD_PSC PREST_TOP_CIE_F PREST_TOP_GRUPOCIE PRESTADOR_TIPO
ESTADO_LM"""
CLAIM_DATES = """EPISODIO_FEC_INI FECHA_EMISION_DT lic_fecha_inicio_reposo lic_fecha_recep_isapre FECHA_EMP_RECEPCION FECHA_EMP_ENVIO
FECHA_INICIO_BENEFICIOS FECHA_SUSCR_CONTRATO FECHA_ENVIO_A_COMPIN FECHA_INGRESO_PREST FECHA_VISACION FECHA_RECONSIDERACION"""
CLAIM_TIMES = "FECHA_INICIO FECHA_TERMINO"
CLAIM_NUMBERS = """EPISODIO_ACUM_DIAS TIPO_F_LM_COD lic_dias_licencia lic_codigo_tipo_licencia COT_EDAD CTD_ENVIA_PERITAJE
CTD_ENVIA_INFORME_MEDICO TIEMPO_RESOLUCION_COMPIN_CURRENT I_DIASAUTORIZADOS M_DIASAUTORIZADOS I_RESOLUCION LCC_PAGDIA
DIAS_REDUCIDOS_ISAPRE_CURRENT DIFF_DIAS_PERDIDOS_RESOL_CURRENT"""
CLAIM_FLAGS = """PERITAJE_LM_PERITADA IS_REPOSO_INJUSTIFICADO_ISAPRE_FLAG EXISTE_RESOL_COMPIN IS_SIN_SUBSIDIO_FLAG
IS_RECHAZADA_ISAPRE_CURRENT_FLAG IS_MODIFICADA_REAL_ISAPRE_FLAG IS_MODIFICADA_ISAPRE_FLAG"""
CLAIM_AMOUNTS = "DEUDA_SIN_I DEUDA_SIN_I_ULT12M RENTA_ESTIMADA"
# The claim's other columns, which the claims of the test tables have anyhow or which are made below.
CLAIM_GIVEN = """AFILIADO_RUT LCC_COMCOD LCC_COMCOR PRESTADOR_RUT EMPLEADOR_RUT PRESTADOR_LOCAL_RUT FECHA_RECEPCION DIASSOLICITADO
CIE_GRUPO RESOLUCION_COMPIN FECHA_RESOLUCION_COMPIN F_DIASAUTORIZADOS"""
# Monthly measures of each entity, windows in brackets; a missing count, sum or flag is 0.
PERSON = """COMPIN_RATIFICA_[01,06,12,24] F_DIAS_PROMEDIO_U[1,6,12,24,36]M F_DIAS_MINIMO_U[6,12,24]M F_DIAS_MAXIMO_U6M
DIFF_DIAS_PERDIDOS_RESOL_MINIMO_U6M DIFF_DIAS_PERDIDOS_RESOL_PROMEDIO_U[6,12,24,36]M DIFF_DIAS_PERDIDOS_RESOL_MAXIMO_U6M
TIEMPO_PROMEDIO_RESOLUCION_COMPIN_[01,06,12,24,36] LM_DENEGADAS_COMPIN_[01,06,12,36] SIN_SUBSIDIO_[01,12,24,36]
CAUSA_RECHAZO_ISAPRE_REPOSO_INJ_[06,12] CANT_LIC_U[1,6,12,24,36]M_CALC DIASSOLICITADO_TOTAL_U[1,6,12,24,36]M
DIASSOLICITADO_PROMEDIO_U[1,6,12,24]M DIASSOLICITADO_MAXIMO_U[1,6,12]M M_DIASAUTORIZADOS_PROMEDIO_U[1,6,12,24,36]M
M_DIASAUTORIZADOS_MINIMO_U[1,6]M M_DIASAUTORIZADOS_MAXIMO_U[1,6,12,24]M M_DIASAUTORIZADOS_TOTAL_U[1,6,12]M
I_DIASAUTORIZADOS_PROMEDIO_U[1,6,12,24,36]M I_DIASAUTORIZADOS_MINIMO_U[1,6]M I_DIASAUTORIZADOS_MAXIMO_U[1,6,12,24]M
I_DIASAUTORIZADOS_TOTAL_U[1,6,12]M CIE_GRUPO_PSIQUIATRICAS_[01,06,12,24,36] PORCENTAJE_LM_MODIFICADA_[01,06,12,24,36]
LM_MODIFICADA_[01,06,12,24,36] LM_TIPO_ENF_COMUN_[12,24,36] LM_CON_PERITAJE_12 CTD_ENVIA_PERITAJE_PROMEDIO_U12M
CTD_ENVIA_INFORME_MEDICO_PROMEDIO_U12M CTD_ENVIA_PERITAJE_U12M HIST_HV_N_PRESTACIONES_U[6,12]M HIST_HV_N_MEDICOS_U6M
HIST_HV_SUM_CANTIDAD_PREST_U6M HIST_HV_N_HOSP_U6M HIST_HV_N_CONSULTAS_AMB_U6M HIST_HV_DIAS_CAMA_U[6,12]M HIST_HV_FLAG_GES_U[6,12]M
HIST_HV_FLAG_CAEC_U6M HIST_HV_BONIFICADO_U6M HIST_PERITAJES_NO_ASISTE_U[3,6]M HIST_PERITAJES_DESACUERDO_ISAPRE_U12M
HIST_TOTAL_PERITAJES_U12M HIST_PERITAJES_ISAPRE_GANO_U6M HIST_DIAS_DESDE_ULTIMO_PERITAJE"""
DOCTOR = """MEDICO_LM_RECHAZADAS_ISAPRE_U[1,6,12,24,36]M MEDICO_LM_RECIBIDAS_TOTAL_U[1,6,12,24,36]M
MEDICO_DIAS_MODIFICADOS_SUM_ISAPRE_U[1,6,12,24,36]M HIST_PERITAJES_DESACUERDO_ISAPRE_MEDICO_U12M
HIST_PERITAJE_FAVORABLE_ISAPRE_MISMO_CIE_U3M HIST_HV_CONSULTAS_MISMO_MEDICO_U[1,3,6]M HIST_HV_TUVO_CONSULTA_MISMO_MEDICO_U12M
HIST_HV_EXAMENES_LAB_MISMO_MEDICO_U[7,14,30]D HIST_HV_TUVO_EXAMENES_LAB_MISMO_MEDICO"""
LOCAL = """PRESTADOR_LOCAL_LM_RECHAZADAS_ISAPRE_U[1,6,12,24,36]M PRESTADOR_LOCAL_LM_RECIBIDAS_TOTAL_U[1,6,12,24,36]M
PRESTADOR_LOCAL_DIAS_SOLICITADOS_U[1,6,12,24,36]M"""
EMPLOYER = "EMPLEADOR_DIAS_SOLICITADOS_LM_U[1,6,12,36]M EMPLEADOR_RUT_DISTINTOS_LM_U36M"
# What only ratios read, and the ratios (numerator, denominators) by window.
DOCTOR_PARTS = "MEDICO_DIAS_SOLICITADOS_U[1,6,12,24,36]M MEDICO_LM_RATIFICADAS_COMPIN_U[6,12,24,36]M MEDICO_LM_DENEGADAS_COMPIN_U[6,12,24,36]M"
EMPLOYER_PARTS = "EMPLEADOR_LM_TOTAL_U[1,6,12,36]M EMPLEADOR_LM_RECHAZADAS_U[1,6,12,36]M EMPLEADOR_DIAS_REDUCIDOS_U[1,6,12,36]M"
RATIOS = {
    "MEDICO_DIAS_MODIFICADOS_PCT_ISAPRE": ((1, 6, 12, 24, 36), "MEDICO_DIAS_MODIFICADOS_SUM_ISAPRE", ["MEDICO_DIAS_SOLICITADOS"]),
    "MEDICO_TASA_RATIFICACION_COMPIN": ((6, 12, 24, 36), "MEDICO_LM_RATIFICADAS_COMPIN", ["MEDICO_LM_RATIFICADAS_COMPIN", "MEDICO_LM_DENEGADAS_COMPIN"]),
    "EMPLEADOR_TASA_RECHAZO_ISAPRE": ((1, 6, 12, 36), "EMPLEADOR_LM_RECHAZADAS", ["EMPLEADOR_LM_TOTAL"]),
    "EMPLEADOR_TASA_MODIFICACION_DIAS_ISAPRE": ((1, 6, 12, 36), "EMPLEADOR_DIAS_REDUCIDOS", ["EMPLEADOR_DIAS_SOLICITADOS_LM"]),
}


def names(text: str) -> list[str]:
    """Names of a list, brackets written out."""
    out = []
    for item in text.split():
        head, _, rest = item.partition("[")
        windows, _, tail = rest.partition("]")
        out += [f"{head}{w}{tail}" for w in windows.split(",")] if rest else [item]
    return out


def _number(name: str, k: int, base: str) -> str:
    """A value of a measure: quarters for means and shares, small whole numbers (zeros among them) for the rest."""
    if re.search("PROMEDIO|PORCENTAJE|TASA|PCT|VELOCIDAD|BONIFICADO|SUM_CANTIDAD", name):
        return f"CAST(({base} + {k}) % 9 AS DOUBLE) / 4"
    return f"CAST(({base} + {k}) % 7 AS BIGINT)"


def _monthly_list(columns: list[str]) -> list[str]:
    """Select list over (n, s): rows and requested days of an entity's month."""
    return [f"CASE WHEN (n + {k}) % 5 = 0 THEN NULL ELSE {_number(c, k, f's + {k} * n')} END AS {c}" for k, c in enumerate(columns, 1)]


MONTHLY = {"AFILIADO_RUT": names(PERSON), "PRESTADOR_RUT": names(DOCTOR) + names(DOCTOR_PARTS), "PRESTADOR_LOCAL_RUT": names(LOCAL),
           "EMPLEADOR_RUT": names(EMPLOYER) + names(EMPLOYER_PARTS)}
SHOWN = {"AFILIADO_RUT": names(PERSON), "PRESTADOR_RUT": names(DOCTOR), "PRESTADOR_LOCAL_RUT": names(LOCAL), "EMPLEADOR_RUT": names(EMPLOYER)}


def _claim_list() -> list[str]:
    """The claim with every column; each has a rule of its own (k), and NULLs."""
    made = {"PRESTADOR_RUT": "CAST(o_orderkey % 97 AS STRING)", "PRESTADOR_LOCAL_RUT": "CAST(o_orderkey % 13 AS STRING)",
            "EMPLEADOR_RUT": "CAST(o_custkey % 50 AS STRING)",
            "CIE_GRUPO": "CASE WHEN o_orderkey % 4 = 0 THEN 'Psiquiatricas' WHEN o_orderkey % 4 = 1 THEN 'OTRAS' END",
            "FT_ORIGEN": "CASE WHEN o_orderkey % 3 = 0 THEN 'autvis' WHEN o_orderkey % 3 = 1 THEN 'otro' END"}
    day, key = "CAST(o_orderdate AS DATE)", "o_orderkey"
    rules = [(CLAIM_TEXTS, lambda c, k: f"'v' || CAST(({key} + {k}) % 11 AS STRING)"), (CLAIM_DATES, lambda c, k: f"CAST({day} - {k} AS DATE)"),
             (CLAIM_TIMES, lambda c, k: f"CAST({day} + {k} AS TIMESTAMP)"), (CLAIM_NUMBERS, lambda c, k: f"CAST(({key} + {k}) % 13 AS BIGINT)"),
             (CLAIM_FLAGS, lambda c, k: f"CAST(({key} + {k}) % 2 AS INT)"), (CLAIM_AMOUNTS, lambda c, k: f"CAST(({key} + {k}) % 17 AS DOUBLE) / 4")]
    k = 0
    for text, rule in rules:
        for c in names(text):
            k += 1
            made[c] = f"CASE WHEN ({key} + {k}) % 6 = 0 THEN NULL ELSE {rule(c, k)} END"
    return [*an.CLAIMS_FROM_ORDERS, *[f"{e} AS {c}" for c, e in made.items()]]


WIDE_CLAIMS = _claim_list()
PRIOR_SOURCE = "FT_ORIGEN"
FLAGS = f"""
  CASE WHEN I_DIASAUTORIZADOS = 0 THEN 1 WHEN I_DIASAUTORIZADOS BETWEEN 1 AND DIASSOLICITADO - 1 THEN 0 END AS ISAP_RECHAZA,
  ifnull(I_DIASAUTORIZADOS = DIASSOLICITADO, false)::INT AS ISAP_APRUEBA,
  round(CASE WHEN I_DIASAUTORIZADOS BETWEEN 1 AND DIASSOLICITADO - 1 THEN 1 - I_DIASAUTORIZADOS / DIASSOLICITADO END::FLOAT::DOUBLE, 5) AS ISAP_MODIFICA_PCT,
  NULL::INT AS ISAP_PIDE_PE,
  CASE lower(RESOLUCION_COMPIN) WHEN 'ratifica' THEN 1 WHEN 'deniega' THEN 0 END AS ISAP_GANA_COMPIN,
  (ifnull(upper(CIE_GRUPO), '') = 'PSIQUIATRICAS')::INT AS IS_PSIQUIATRICA_CURRENT_FLAG,
  (ifnull({PRIOR_SOURCE}, '') = 'autvis')::INT AS PASO_FASTTRACK"""


def _shown_sql(entity: str) -> list[str]:
    out = []
    for c in SHOWN[entity]:
        out.append(f"ifnull(n_{entity}.newest.{c}, {9999 if c == 'HIST_DIAS_DESDE_ULTIMO_PERITAJE' else 0}) AS {c}")
    for name, (windows, num, den) in RATIOS.items():
        if f"{num}_U{windows[0]}M" in MONTHLY[entity]:
            for w in windows:
                at = lambda c: f"n_{entity}.newest.{c}_U{w}M"  # noqa: B023, E731
                total = " + ".join(map(at, den))
                out.append(f"round(CASE {total} WHEN 0 THEN 0 ELSE {at(num)} / ({total}) END, 6) AS {name}_U{w}M")
    return out


def _wide_sql() -> str:
    keys = "AFILIADO_RUT, LCC_COMCOR, LCC_COMCOD"
    monthly, newest, joins, shown = [], [], [], []
    for e in MONTHLY:
        monthly.append(f"m_{e} AS (SELECT {e}, PERIODO, {', '.join(_monthly_list(MONTHLY[e]))} FROM (SELECT {e}, strftime(FECHA_RECEPCION, '%m%Y') AS PERIODO, "
                       f"count(*) AS n, sum(DIASSOLICITADO)::BIGINT AS s FROM claims GROUP BY ALL))")
        newest.append(f"n_{e} AS ({newest_sql(f'm_{e}', e, N1_ASOF, MONTHLY[e])})")
        joins.append(f"LEFT JOIN n_{e} ON n_{e}.{e} = fresh.{e}")
        shown += _shown_sql(e)
    claim = names(CLAIM_GIVEN) + [c for t in (CLAIM_TEXTS, CLAIM_DATES, CLAIM_TIMES, CLAIM_NUMBERS, CLAIM_FLAGS, CLAIM_AMOUNTS) for c in names(t)]
    return f"""
WITH claims AS (SELECT {', '.join(WIDE_CLAIMS)} FROM orders),
fresh AS (SELECT * FROM claims WHERE FECHA_RECEPCION BETWEEN DATE '{N1_FROM}' AND DATE '{N1_TO}'),
measured AS (FROM ({CM.D1_SQL}) JOIN ({CM.D2_SQL}) USING ({keys}) JOIN ({CM.D3_ORDERS_SQL}) USING ({keys})),
{', '.join(monthly)}, {', '.join(newest)},
ranks AS ({rank_sql(f"FECHA_RECEPCION < DATE '{N1_FROM}'", f"FECHA_RECEPCION BETWEEN DATE '{N1_FROM}' AND DATE '{N1_TO}'")})
SELECT {', '.join(f'fresh.{c}' for c in [*claim, PRIOR_SOURCE])}, RN_AFILIADO_HIST, measured.* EXCLUDE ({keys}),
  {', '.join(shown)}, {FLAGS}
FROM fresh JOIN measured USING ({keys}) JOIN ranks ON ranks.LCC_COMCOR = fresh.LCC_COMCOR {' '.join(joins)}
"""


def _wide_monthly(claims: DataFrame, entity: str) -> DataFrame:
    base = claims.groupBy(entity, F.date_format("FECHA_RECEPCION", "MMyyyy").alias("PERIODO")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("DIASSOLICITADO").alias("s"))
    return base.selectExpr(entity, "PERIODO", *_monthly_list(MONTHLY[entity]))


@query("n1_wide_table", ("N1", "B9", "B10", "B13", "B14", "C7", "C8", "D1", "D2", "D3", "E2"), _wide_sql())
def n1_wide_table(spark, sf_dir):
    """The increment's wide rows with the mart's whole column set."""
    claims = an.table(spark, sf_dir, "orders").selectExpr(*WIDE_CLAIMS)
    base = claims.where(F.col("FECHA_RECEPCION") < F.lit(N1_FROM).cast("date"))
    wide = base.select("AFILIADO_RUT", "FECHA_RECEPCION", "LCC_COMCOR", "LCC_COMCOD")
    r = run_increment(claims, base, None, wide, an.services_from_lineitem(spark, sf_dir), an.exams_from_lineitem(spark, sf_dir),
                      N1_FROM, N1_TO, N1_ASOF, monthly={e: _wide_monthly(claims, e) for e in MONTHLY},
                      prior_source=PRIOR_SOURCE, mart=wide_spec(PRIOR_SOURCE))
    out = r.new_wide.withColumn("ISAP_MODIFICA_PCT", F.round(F.col("ISAP_MODIFICA_PCT").cast("double"), 5))
    shares = [f"{n}_U{w}M" for n, (windows, _, _) in RATIOS.items() for w in windows]
    six = ["F_DIAS_PROMEDIO_U15D", "RATIO_APROBACION_U15D", "HV_SUM_CANTIDAD_PREST_U15D", *shares]
    return out.withColumns({c: F.round(c, 6) for c in six})


# ---------------------------------------------------------------- N2
# What the training table takes over, by type, beside the columns of the rules.
TRAIN_TEXTS = """CIE_F CIE_F_COD LM_DIAGNOSTICO LM_ANTECEDENTES_CLINICOS LM_FORMATO LM_REPOSO_TIPO N_LICENCIA PRESTADOR_LOCAL_RUT
PRESTADOR_ESPECIALIDAD_PSC MED_ESPECIALIDAD_LME MED_CLASIFICACION PREST_TOP_CIE_F PREST_TOP_GRUPOCIE COMUNA_REPOSO COMUNA_EMISION
EMPLEADOR_RUT EMPLEADOR_MULTIEMPLEADO CALIDAD_TRABAJADOR COMPIN_CNT"""
TRAIN_NUMBERS = """DEUDA_SIN_I DEUDA_SIN_I_ULT12M RENTA_ESTIMADA
COMPIN_RATIFICA_[01,06,12,24] CANT_LIC_U[1,6,12,24,36]M_CALC M_DIASAUTORIZADOS_TOTAL_U[1,6,12]M M_DIASAUTORIZADOS_PROMEDIO_U[1,12,24]M
M_DIASAUTORIZADOS_MAXIMO_U[1,12,24]M F_DIAS_PROMEDIO_U[1,6,12,24,36]M F_DIAS_MINIMO_U[6,12,24]M F_DIAS_MAXIMO_U6M
DIFF_DIAS_PERDIDOS_RESOL_MINIMO_U6M DIFF_DIAS_PERDIDOS_RESOL_PROMEDIO_U[6,12,24,36]M DIFF_DIAS_PERDIDOS_RESOL_MAXIMO_U6M
CIE_GRUPO_PSIQUIATRICAS_[01,06,12,24,36] DIASSOLICITADO_TOTAL_U[1,6,12,24,36]M DIASSOLICITADO_PROMEDIO_U[1,6,12,24]M
DIASSOLICITADO_MAXIMO_U[1,6,12]M TIEMPO_PROMEDIO_RESOLUCION_COMPIN_[01,06,12,24,36] PORCENTAJE_LM_MODIFICADA_[01,06,12,24,36]
LM_MODIFICADA_[01,06,12,24,36] LM_DENEGADAS_COMPIN_[01,06,12,36] LM_TIPO_ENF_COMUN_[12,24,36] LM_CON_PERITAJE_12
CTD_ENVIA_PERITAJE_PROMEDIO_U12M CTD_ENVIA_INFORME_MEDICO_PROMEDIO_U12M CTD_ENVIA_PERITAJE_U12M SIN_SUBSIDIO_[01,12,24]
MEDICO_LM_RECHAZADAS_ISAPRE_U[1,6,12,24,36]M MEDICO_LM_RECIBIDAS_TOTAL_U[1,6,12,24,36]M MEDICO_DIAS_MODIFICADOS_SUM_ISAPRE_U[1,6,12,24,36]M
MEDICO_DIAS_MODIFICADOS_PCT_ISAPRE_U[1,6,12,24,36]M MEDICO_TASA_RATIFICACION_COMPIN_U[6,12,24,36]M
EMPLEADOR_TASA_RECHAZO_ISAPRE_U[1,6,12,36]M EMPLEADOR_DIAS_SOLICITADOS_LM_U[1,6,12,36]M EMPLEADOR_TASA_MODIFICACION_DIAS_ISAPRE_U[1,6,12,36]M
HIST_HV_N_PRESTACIONES_U[6,12]M HIST_HV_N_MEDICOS_U6M HIST_HV_SUM_CANTIDAD_PREST_U6M HIST_HV_N_HOSP_U6M HIST_HV_N_CONSULTAS_AMB_U6M
HIST_HV_DIAS_CAMA_U[6,12]M HIST_HV_FLAG_GES_U[6,12]M HIST_HV_FLAG_CAEC_U6M HIST_HV_BONIFICADO_U6M HIST_HV_CONSULTAS_MISMO_MEDICO_U[1,3,6]M
HIST_HV_TUVO_CONSULTA_MISMO_MEDICO_U12M HIST_HV_EXAMENES_LAB_MISMO_MEDICO_U[7,14,30]D HIST_HV_TUVO_EXAMENES_LAB_MISMO_MEDICO
HIST_PERITAJES_NO_ASISTE_U6M HIST_PERITAJES_DESACUERDO_ISAPRE_U12M HIST_TOTAL_PERITAJES_U12M HIST_PERITAJES_ISAPRE_GANO_U6M
HIST_DIAS_DESDE_ULTIMO_PERITAJE HIST_PERITAJES_DESACUERDO_ISAPRE_MEDICO_U12M HIST_PERITAJE_FAVORABLE_ISAPRE_MISMO_CIE_U3M
DIAS_DESDE_ULTIMO_PERITAJE TASA_EXITO_RECURSOS_U90D RATIO_APROBACION_U15D"""
# Measures that are 0 if missing.
TRAIN_ZERO = """FADE_AFILIADO_[90,365]D FADE_EMPRESA_[90,365]D FADE_PRESTADOR_[90,365]D FADE_LICENCIA_7D ALERTA_AMARILLA_[90,365]D
ALERTA_ROJA_[90,365]D CTD_SOLICITUDES_INFO_U[30,90,365]D CTD_SOLICITUDES_INFO_MEDICA_U30D CTD_PERITAJES_TOTAL_U[30,90]D
CTD_PERITAJES_PSIQ_U30D FLAG_PERITAJE_PSIQ_U30D CTD_RECURSOS_TOTAL_U90D CTD_FADE_TOTAL_U30D FLAG_TIENE_FADE_U30D
FLAG_SOSPECHA_FRAUDE_U90D FLAG_INFORME_MEDICO_RECEP_U30D CTD_ACCIONES_TOTAL_U[30,90,365]D VELOCIDAD_ACCIONES_U30D
CANT_LIC_U15D CANT_LIC_CON_RESOLUCION_U15D COMPIN_RATIFICA_U15D COMPIN_DENIEGA_U15D F_DIAS_PROMEDIO_U15D TOTAL_DIAS_SOLICITADOS_U15D
MAX_DIAS_SOLICITADOS_U15D FLAG_MULTIPLES_LIC_U15D HV_N_PRESTACIONES_U15D HV_SUM_CANTIDAD_PREST_U15D HV_N_MEDICOS_U15D
HV_FLAG_[HOSPITALARIO,BONO,REEMBOLSO,GES,CAEC]_U15D PERITAJES_[TOTAL,NO_ASISTE,DESACUERDO,ACUERDO]_U15D FLAG_PERITAJE_RECIENTE_U15D"""
TRAIN_LONG_AGO = "DIAS_DESDE_ULTIMO_PERITAJE_U15D"
# Columns with another name in the training table.
TRAIN_RENAMED = {"RN_AFILIADO_HIST": "RN", "EMPLEADOR_RUT_DISTINTOS_LM_U36M": "EMPLEADOS_CON_LM"} | {
    f"PRESTADOR_LOCAL_LM_{m}_U{w}M": f"PL_LM_{m}_U{w}M" for m in ("RECHAZADAS_ISAPRE", "RECIBIDAS_TOTAL") for w in (1, 6, 12, 24, 36)}


def _train_list() -> list[str]:
    out = []
    texts = names(TRAIN_TEXTS)
    for k, c in enumerate([*texts, *names(TRAIN_NUMBERS), *names(TRAIN_ZERO), TRAIN_LONG_AGO, *TRAIN_RENAMED], 1):
        value = f"'v' || CAST((LCC_COMCOR + {k}) % 11 AS STRING)" if c in texts else _number(c, k, f"LCC_COMCOR * {k % 5 + 1}")
        out.append(f"CASE WHEN (LCC_COMCOR + {k}) % 6 = 0 THEN NULL ELSE {value} END AS {c}")
    return [*WIDE_FROM_CLAIMS, *out]


WIDE_TO_TRAIN = _train_list()


def _train_sql() -> str:
    taken = [*names(TRAIN_TEXTS), *names(TRAIN_NUMBERS), "FECHA_EMISION_DT", "FECHA_RECEPCION", "FECHA_INICIO", "FECHA_TERMINO", "DIASSOLICITADO",
             "CIE_GRUPO", "PRESTADOR_RUT", "PRESTADOR_TIPO", "CONTINUA_CALC"]
    return f"""
WITH {CM._claims_cte()}, m AS (SELECT {', '.join(WIDE_TO_TRAIN)} FROM claims), n2 AS ({_n2_sql()})
SELECT n2.*, {', '.join(f'm.{c}' for c in taken)},
  {', '.join(f'ifnull(m.{c}, 0) AS {c}' for c in names(TRAIN_ZERO))}, ifnull(m.{TRAIN_LONG_AGO}, 9999) AS {TRAIN_LONG_AGO},
  {', '.join(f'm.{c} AS {t}' for c, t in TRAIN_RENAMED.items())},
  m.lic_codigo_tipo_licencia AS I_TIPOLIC, nullif(m.FECHA_EMP_ENVIO, DATE '1900-01-01') AS FECHA_EMP_ENVIO, NULL::DATE AS FECHA_NAC_HIJO,
  NULL::BIGINT AS COT_EDAD, m.REC_GLS_CAUMOD AS LEAK_CAUSALES, NULL::VARCHAR AS LEAK_GLOSAS, m.ESTADO_LM AS LEAK_ESTADOLM,
  m.PERITAJE_FALLO_1 AS LEAK_FALLO_PE, m.FECHA_RESOLUCION_COMPIN AS LEAK_FECHA_COMPIN, m.RESOLUCION_COMPIN AS LEAK_RESOLUCION_COMPIN
FROM n2 JOIN m USING (LCC_COMCOR)
"""


@query("n2_training_table", ("N2", "B1", "B2", "B3", "B4", "B5", "B6", "B7", "B8", "B9", "B10", "B11", "B12"), _train_sql())
def n2_training_table(spark, sf_dir):
    """The training table with its whole column set."""
    return build_training_table(an.claims_from_orders(spark, sf_dir).selectExpr(*WIDE_TO_TRAIN), N2_ASOF)
