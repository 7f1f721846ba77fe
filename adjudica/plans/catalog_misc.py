"""Registered queries: loaders, contracts, frame-level rules, flow statistics
(survey A1-A4, A10, A12, B14, B15, B17-B19, C8, D4-D6)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from ..functions import expr as B
from ..functions.contract import conform_to_contract, map_output_columns
from ..operators import claim_metrics as CM
from ..operators import decision as D
from ..operators import joins as J
from ..roles import DEFAULT_ROLES
from ..sources import analogues as an
from ..sources import tables as T
from .catalog_mart import D1_SQL, D2_SQL, _claims_cte
from .catalog_pipelines import WIDE_FROM_CLAIMS, _n2_sql, _wide
from .increment import build_training_table
from .registry import query

WIDE_CTE = f"{_claims_cte()}, wide AS (SELECT {', '.join(WIDE_FROM_CLAIMS)} FROM claims)"
WIDE_TARGETS = ["CASE WHEN UPPER(RESOLUCION_COMPIN) = 'RATIFICA' THEN 1 WHEN UPPER(RESOLUCION_COMPIN) = 'DENIEGA' "
                "THEN 0 END AS TARGET_RATIFICA",
                "CASE WHEN ESTADO_LM = 'EN VISACION' THEN NULL WHEN I_DIASAUTORIZADOS = DIASSOLICITADO "
                "AND I_DIASAUTORIZADOS > 0 THEN 1 WHEN I_DIASAUTORIZADOS < DIASSOLICITADO THEN 0 END AS TARGET_APRUEBA"]


def _wide_t(spark, sf_dir):
    return _wide(spark, sf_dir).selectExpr("*", *WIDE_TARGETS)


# ---------------------------------------------------------------- A1
@query("a1_read_table", "A1", "SELECT * FROM orders")
def a1_read_table(spark, sf_dir):
    return T.read_table(spark, "orders", path=f"{sf_dir}/orders.parquet")


# ---------------------------------------------------------------- A2
def _a2_cols(spark, sf_dir):
    w = _wide_t(spark, sf_dir)
    roles = DEFAULT_ROLES.with_numeric_from(w.drop(*[c for c in w.columns if c.startswith("TARGET_")]))
    return w, roles


# What the loaders return of the analogue table, in role order, once more for the oracles.
LOADED = """AFILIADO_RUT LCC_COMCOR LCC_COMCOD PRESTADOR_RUT
FECHA_EMP_RECEPCION FECHA_EMP_ENVIO FECHA_EMISION_DT FECHA_RECEPCION FECHA_INICIO FECHA_TERMINO EPISODIO_FEC_INI
COT_GENERO CIE_GRUPO TIPO_F_LM TIPO_F_LM_COD PRESTADOR_TIPO CONTINUA_CALC DIASSOLICITADO lic_codigo_tipo_licencia""".split()
# Diagnosis groups that are left out, and claims of other groups (with a name, or with or without one).
BIRTHS = "births(g) AS (VALUES ('PARTO'), ('PUERPERIO'))"
OTHER_GROUP = "length(trim(CIE_GRUPO)) > 0 AND CIE_GRUPO NOT IN (SELECT g FROM births)"
NO_BIRTH = "(CIE_GRUPO IS NULL OR CIE_GRUPO NOT IN (SELECT g FROM births))"


@query("a2_load_training", ("A2", "B15", "B16"), f"""
WITH {WIDE_CTE}, {BIRTHS}, t AS (SELECT *, {', '.join(WIDE_TARGETS)} FROM wide)
SELECT {', '.join(LOADED)}, TARGET_RATIFICA FROM t
WHERE year(FECHA_RECEPCION) BETWEEN 1996 AND 2000 AND TARGET_RATIFICA IS NOT NULL AND {OTHER_GROUP}""")
def a2_load_training(spark, sf_dir):
    w, roles = _a2_cols(spark, sf_dir)
    return T.load_training(w, "TARGET_RATIFICA", roles, date_from="1996-01-01", date_to="2000-12-31")


# ---------------------------------------------------------------- A3
@query("a3_load_by_ids", "A3", f"""
WITH {WIDE_CTE}
SELECT {', '.join(LOADED)} FROM wide SEMI JOIN (FROM orders WHERE o_orderstatus = 'P') ON LCC_COMCOR = o_orderkey""")
def a3_load_by_ids(spark, sf_dir):
    w, roles = _a2_cols(spark, sf_dir)
    ids = an.table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("LCC_COMCOR"))
    return T.load_by_ids(w, "LCC_COMCOR", ids, roles)


# ---------------------------------------------------------------- A4
A4_COLS = ["LCC_COMCOR", "LCC_COMCOD", "FECHA_RECEPCION", "CIE_GRUPO", "TARGET_APRUEBA"]


@query("a4_load_for_scoring_pending", ("A4", "B15"), f"""
WITH {WIDE_CTE}, {BIRTHS}, t AS (SELECT *, {', '.join(WIDE_TARGETS)} FROM wide)
SELECT {', '.join(A4_COLS)} FROM t WHERE TARGET_APRUEBA IS NULL AND {OTHER_GROUP}""")
def a4_load_for_scoring_pending(spark, sf_dir):
    return T.load_for_scoring(_wide_t(spark, sf_dir), as_of="2001-08-02").select(*A4_COLS)


@query("a4_load_for_scoring_period", ("A4", "B15"), f"""
WITH {WIDE_CTE}, {BIRTHS}, t AS (SELECT *, {', '.join(WIDE_TARGETS)} FROM wide)
SELECT {', '.join(A4_COLS)} FROM t WHERE FECHA_RECEPCION BETWEEN DATE '2001-02-02' AND DATE '2001-08-01' AND {OTHER_GROUP}""")
def a4_load_for_scoring_period(spark, sf_dir):
    return T.load_for_scoring(_wide_t(spark, sf_dir), as_of="2001-08-02", last_days=181).select(*A4_COLS)


@query("a4_load_for_scoring_relaxed", ("A4", "B15"), f"""
WITH {WIDE_CTE}, {BIRTHS}, t AS (
  SELECT * REPLACE (CASE WHEN LCC_COMCOD = 1 THEN 'PARTO' WHEN LCC_COMCOD = 2 THEN ' ' END AS CIE_GRUPO), {', '.join(WIDE_TARGETS)} FROM wide)
SELECT {', '.join(A4_COLS)} FROM t WHERE TARGET_APRUEBA IS NULL AND {NO_BIRTH}""")
def a4_load_for_scoring_relaxed(spark, sf_dir):
    """No claim has a usable diagnosis group, so the loader falls back on the relaxed filter."""
    group = F.when(F.col("LCC_COMCOD") == 1, "PARTO").when(F.col("LCC_COMCOD") == 2, " ")
    w = _wide_t(spark, sf_dir).withColumn("CIE_GRUPO", group)
    return T.load_for_scoring(w, as_of="2001-08-02").select(*A4_COLS)


@query("a1_read_table_by_name", "A1", "SELECT o_orderkey, o_custkey FROM orders")
def a1_read_table_by_name(spark, sf_dir):
    """A table of the catalog, by its name."""
    an.table(spark, sf_dir, "orders").createOrReplaceTempView("adjudica_orders")
    return T.read_table(spark, "adjudica_orders").select("o_orderkey", "o_custkey")


@query("b4_standardise_category_keep", "B4", """
SELECT o_orderkey, CASE WHEN regexp_matches(o_orderpriority, '(?i)^\\s*[12]-') THEN 'ALTA' WHEN o_orderpriority LIKE '5-%' THEN 'BAJA'
  ELSE o_orderpriority END AS PRIORIDAD FROM orders""")
def b4_standardise_category_keep(spark, sf_dir):
    """Unknown values are kept as they are; case and blanks around a synonym don't matter."""
    o = an.table(spark, sf_dir, "orders")
    mixed = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit(" "), F.lower("o_orderpriority"))).otherwise(F.col("o_orderpriority"))
    known = F.when(F.substring("o_orderpriority", 1, 1).isin("1", "2", "5"), mixed).otherwise(F.col("o_orderpriority"))
    words = {"ALTA": ["1-URGENT", "2-HIGH"], "BAJA": ["5-LOW"]}
    return o.select("o_orderkey", B.standardise_category(known, words, "keep").alias("PRIORIDAD"))


# ---------------------------------------------------------------- A10, A12
CONTRACT = StructType([StructField("LCC_COMCOR", LongType()), StructField("AFILIADO_RUT", StringType()),
                       StructField("CIE_GRUPO", StringType()), StructField("DIASSOLICITADO", IntegerType()),
                       StructField("PROBABILIDAD_APROBACION", DoubleType()), StructField("FECHA_RECEPCION", DateType()),
                       StructField("GLOSA_GENERADA", StringType())])


@query("a10_conform_to_contract", "A10", f"""
WITH {WIDE_CTE}
SELECT LCC_COMCOR, AFILIADO_RUT, substr(CIE_GRUPO, 1, 5) AS CIE_GRUPO, TRY_CAST(DIASSOLICITADO AS INTEGER) AS DIASSOLICITADO,
       CAST(NULL AS DOUBLE) AS PROBABILIDAD_APROBACION, FECHA_RECEPCION, substr(TIPO_F_LM, 1, 4) AS GLOSA_GENERADA
FROM wide""")
def a10_conform_to_contract(spark, sf_dir):
    w = _wide(spark, sf_dir)
    w = w.select(F.col("LCC_COMCOR").alias(" lcc_comcor "), "AFILIADO_RUT", F.col("CIE_GRUPO").alias("cie_grupo"),
                 "DIASSOLICITADO", "FECHA_RECEPCION", F.col("TIPO_F_LM").alias("GLOSA_GENERADA"), "ESTADO_LM")
    return conform_to_contract(w, CONTRACT, {"CIE_GRUPO": 5, "GLOSA_GENERADA": 4})


@query("a12_map_output_columns", "A12", f"""
WITH {WIDE_CTE}
SELECT LCC_COMCOR, PRESTADOR_RUT AS LCC_MEDRUT, CAST(NULL AS VARCHAR) AS LCC_EMPRUT, CAST(LCC_COMCOR AS VARCHAR) AS LCC_IDN,
       CAST(NULL AS VARCHAR) AS LCC_OPERADOR FROM wide""")
def a12_map_output_columns(spark, sf_dir):
    w = _wide(spark, sf_dir).select("LCC_COMCOR", "PRESTADOR_RUT", F.col("LCC_COMCOR").alias("N_LICENCIA"))
    return map_output_columns(w).select("LCC_COMCOR", "LCC_MEDRUT", "LCC_EMPRUT", "LCC_IDN", "LCC_OPERADOR")


# ---------------------------------------------------------------- B14, B15, B17, B18, B19
@query("b14_safe_ratio", "B14", """
WITH m AS (SELECT o_custkey, COUNT(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS f,
                  COUNT(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS p FROM orders GROUP BY o_custkey),
x AS (SELECT c.c_custkey, m.f, m.p FROM customer c LEFT JOIN m ON c.c_custkey = m.o_custkey)
SELECT c_custkey, ROUND(CASE WHEN p = 0 THEN 0 ELSE CAST(f AS DOUBLE) / p END, 6) AS TASA FROM x""")
def b14_safe_ratio(spark, sf_dir):
    o = an.table(spark, sf_dir, "orders")
    m = o.groupBy("o_custkey").agg(F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("f"),
                                   F.count(F.when(F.col("o_orderstatus") == "P", 1)).alias("p"))
    c = an.table(spark, sf_dir, "customer").select("c_custkey")
    x = c.join(m, c.c_custkey == m.o_custkey, "left")
    return x.select("c_custkey", F.round(B.safe_ratio("f", "p"), 6).alias("TASA"))


@query("b15_group_filter_modes", "B15", f"""
WITH {WIDE_CTE}, {BIRTHS}
SELECT unnest(['strict', 'relaxed']) AS MODO, unnest([count(*) FILTER ({OTHER_GROUP}), count(*) FILTER ({NO_BIRTH})]) AS N FROM wide""")
def b15_group_filter_modes(spark, sf_dir):
    w = _wide(spark, sf_dir)
    s = w.where(B.group_filter("CIE_GRUPO", "strict")).agg(F.count(F.lit(1)).alias("N")).select(F.lit("strict").alias("MODO"), "N")
    r = w.where(B.group_filter("CIE_GRUPO", "relaxed")).agg(F.count(F.lit(1)).alias("N")).select(F.lit("relaxed").alias("MODO"), "N")
    return s.unionByName(r)


def _b17_sql() -> str:
    from ..roles import KEYS, TARGETS
    from .catalog_pipelines import N2_COLS
    keep = [c for c in N2_COLS if "LEAK" not in c.upper() and c not in KEYS and (c not in TARGETS or c == "TARGET_FT3")]
    return f"WITH n2 AS ({_n2_sql()}) SELECT {', '.join(keep)} FROM n2"


@query("b17_drop_by_role", ("B17", "B12"), _b17_sql())
def b17_drop_by_role(spark, sf_dir):
    from .catalog_pipelines import N2_ASOF, N2_COLS
    t = build_training_table(_wide(spark, sf_dir), N2_ASOF).select(*N2_COLS)
    return B.drop_by_role(t, keep_target="TARGET_FT3")


@query("b18_split_decided_pending", ("B18", "D5"), f"""
WITH n2 AS ({_n2_sql()})
SELECT CASE WHEN TARGET_FT3 IS NULL THEN 'PENDIENTE' ELSE 'CON_DICTAMEN' END AS GRUPO, COUNT(*) AS N FROM n2 GROUP BY 1""")
def b18_split_decided_pending(spark, sf_dir):
    from .catalog_pipelines import N2_ASOF
    t = build_training_table(_wide(spark, sf_dir), N2_ASOF)
    dec, pen = B.split_decided_pending(t, "TARGET_FT3")
    return dec.agg(F.count(F.lit(1)).alias("N")).select(F.lit("CON_DICTAMEN").alias("GRUPO"), "N") \
              .unionByName(pen.agg(F.count(F.lit(1)).alias("N")).select(F.lit("PENDIENTE").alias("GRUPO"), "N"))


@query("b19_neutralise_all_null_dates", "B19", f"""
WITH {_claims_cte()},
c AS (SELECT *, CASE WHEN RESOLUCION_COMPIN IS NULL THEN FECHA_RECEPCION END AS FECHA_PEND FROM claims),
seen AS (SELECT MAX(CASE WHEN FECHA_PEND IS NOT NULL THEN 1 ELSE 0 END) AS s1,
                MAX(CASE WHEN FECHA_RESOLUCION_COMPIN IS NOT NULL THEN 1 ELSE 0 END) AS s2
         FROM c WHERE RESOLUCION_COMPIN IS NOT NULL)
SELECT LCC_COMCOR, CASE WHEN s1 = 1 THEN FECHA_PEND END AS FECHA_PEND,
       CASE WHEN s2 = 1 THEN FECHA_RESOLUCION_COMPIN END AS FECHA_RESOLUCION_COMPIN
FROM c, seen WHERE RESOLUCION_COMPIN IS NULL""")
def b19_neutralise_all_null_dates(spark, sf_dir):
    c = an.claims_from_orders(spark, sf_dir).withColumn(
        "FECHA_PEND", F.when(F.col("RESOLUCION_COMPIN").isNull(), F.col("FECHA_RECEPCION")))
    dec = c.where(F.col("RESOLUCION_COMPIN").isNotNull())
    pen = c.where(F.col("RESOLUCION_COMPIN").isNull())
    out = B.neutralise_all_null_dates(pen, dec, ["FECHA_PEND", "FECHA_RESOLUCION_COMPIN"])
    return out.select("LCC_COMCOR", "FECHA_PEND", "FECHA_RESOLUCION_COMPIN")


# ---------------------------------------------------------------- C8
@query("c8_attach_metrics", ("C8", "D1", "D2", "B9"), f"""
WITH d1 AS ({D1_SQL}), d2 AS ({D2_SQL}), {_claims_cte()}
SELECT c.LCC_COMCOR, c.FECHA_RECEPCION, d1.CANT_LIC_U15D, d1.TOTAL_DIAS_SOLICITADOS_U15D, d2.HV_N_PRESTACIONES_U15D,
       d2.HV_FLAG_BONO_U15D
FROM claims c
LEFT JOIN d1 ON c.AFILIADO_RUT = d1.AFILIADO_RUT AND c.LCC_COMCOR = d1.LCC_COMCOR AND c.LCC_COMCOD = d1.LCC_COMCOD
LEFT JOIN d2 ON c.AFILIADO_RUT = d2.AFILIADO_RUT AND c.LCC_COMCOR = d2.LCC_COMCOR AND c.LCC_COMCOD = d2.LCC_COMCOD""")
def c8_attach_metrics(spark, sf_dir):
    claims = an.claims_from_orders(spark, sf_dir)
    probes = CM.distinct_probes(claims)
    d1 = CM.claim_metrics_15d(probes, claims).select(*CM.CLAIM_KEYS, "CANT_LIC_U15D", "TOTAL_DIAS_SOLICITADOS_U15D")
    d2 = CM.service_metrics_15d(probes, an.services_from_lineitem(spark, sf_dir)) \
        .select(*CM.CLAIM_KEYS, "HV_N_PRESTACIONES_U15D", "HV_FLAG_BONO_U15D")
    out = J.attach_metrics(claims.select(*CM.CLAIM_KEYS, "FECHA_RECEPCION"), [d1, d2], CM.CLAIM_KEYS,
                           defaults={**CM.CLAIM_DEFAULTS, **CM.SERVICE_DEFAULTS})
    return out.select("LCC_COMCOR", "FECHA_RECEPCION", "CANT_LIC_U15D", "TOTAL_DIAS_SOLICITADOS_U15D",
                      "HV_N_PRESTACIONES_U15D", "HV_FLAG_BONO_U15D")


# ---------------------------------------------------------------- D4, D5, D6
@query("d4_flow_statistics", "D4", f"""
WITH n2 AS ({_n2_sql()}),
a AS (SELECT COUNT(*) AS total_licenses, CAST(SUM(CASE WHEN TARGET_MODIFICA = 1 THEN 1 ELSE 0 END) AS BIGINT) AS modified_licenses,
  CAST(SUM(CASE WHEN TARGET_MODIFICA = 1 AND TARGET_RATIFICA IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS compin_licenses,
  CAST(SUM(CASE WHEN TARGET_MODIFICA = 1 AND TARGET_RATIFICA = 1 THEN 1 ELSE 0 END) AS BIGINT) AS compin_ratified,
  CAST(SUM(CASE WHEN TARGET_MODIFICA = 1 AND TARGET_RATIFICA = 0 THEN 1 ELSE 0 END) AS BIGINT) AS compin_denied FROM n2)
SELECT *, ROUND(CASE WHEN total_licenses > 0 THEN modified_licenses * 100.0 / total_licenses END, 6) AS pct_modified,
  ROUND(CASE WHEN modified_licenses > 0 THEN compin_licenses * 100.0 / modified_licenses END, 6) AS pct_to_compin,
  ROUND(CASE WHEN compin_licenses > 0 THEN compin_ratified * 100.0 / compin_licenses END, 6) AS pct_ratified,
  ROUND(CASE WHEN compin_licenses > 0 THEN compin_denied * 100.0 / compin_licenses END, 6) AS pct_denied FROM a""")
def d4_flow_statistics(spark, sf_dir):
    from .catalog_pipelines import N2_ASOF
    t = build_training_table(_wide(spark, sf_dir), N2_ASOF)
    return D.flow_statistics(t)


@query("d5_target_distribution", "D5", f"""
WITH n2 AS ({_n2_sql()}) SELECT TARGET_FT3, COUNT(*) AS N FROM n2 WHERE TARGET_FT3 IS NOT NULL GROUP BY 1""")
def d5_target_distribution(spark, sf_dir):
    from .catalog_pipelines import N2_ASOF
    return D.target_distribution(build_training_table(_wide(spark, sf_dir), N2_ASOF), "TARGET_FT3")


@query("d6_load_verification", "D6", f"""
WITH {an.sql_cte('scored', an.SCORED_FROM_LINEITEM, 'lineitem')},
p AS (SELECT l.l_shipdate AS FECHA_PROCESAMIENTO, CASE WHEN s.TARGET_FT3 IS NULL THEN 1 ELSE 0 END AS ES_PENDIENTE,
             CASE WHEN s.PROBABILIDAD_APROBACION >= 0.8 THEN 'VERDE' WHEN s.PROBABILIDAD_APROBACION >= 0.3 THEN 'AMARILLO'
                  ELSE 'ROJO' END AS SEMAFORO
      FROM scored s JOIN lineitem l ON s.LCC_COMCOR = l.l_orderkey AND s.LCC_COMCOD = l.l_linenumber
                    AND s.PART_KEY = l.l_partkey)
SELECT COUNT(*) AS total, CAST(COALESCE(SUM(ES_PENDIENTE), 0) AS BIGINT) AS pendientes, COUNT(DISTINCT SEMAFORO) AS semaforos
FROM p WHERE CAST(FECHA_PROCESAMIENTO AS DATE) = DATE '1998-03-15'""")
def d6_load_verification(spark, sf_dir):
    li = an.table(spark, sf_dir, "lineitem")
    p = li.select(F.col("l_shipdate").alias("FECHA_PROCESAMIENTO"),
                  F.when(F.col("l_returnflag") == "A", 1).otherwise(0).alias("ES_PENDIENTE"),
                  F.round(F.col("l_discount") * 10, 3).alias("s"))
    p = p.withColumn("SEMAFORO", F.when(F.col("s") >= 0.8, "VERDE").when(F.col("s") >= 0.3, "AMARILLO").otherwise("ROJO"))
    return D.load_verification(p, "1998-03-15")


# ---------------------------------------------------------------- A7, B13
@query("a7_append_predictions_normalised", "A7", """
WITH p AS (SELECT l_orderkey, l_linenumber,
                  CASE WHEN l_returnflag = 'A' THEN 'nan' WHEN l_returnflag = 'R' THEN 'None' ELSE l_linestatus END AS TXT,
                  CASE WHEN l_discount = 0 THEN CAST('NaN' AS DOUBLE) ELSE l_discount END AS VAL FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN TXT IN ('nan', 'None', '<NA>', 'NaT') THEN NULL ELSE TXT END AS TXT,
       CASE WHEN isnan(VAL) THEN NULL ELSE VAL END AS VAL FROM p""")
def a7_append_predictions_normalised(spark, sf_dir):
    from ..sources.sinks import normalise_nulls
    li = an.table(spark, sf_dir, "lineitem")
    p = li.select("l_orderkey", "l_linenumber",
                  F.when(F.col("l_returnflag") == "A", "nan").when(F.col("l_returnflag") == "R", "None")
                   .otherwise(F.col("l_linestatus")).alias("TXT"),
                  F.when(F.col("l_discount") == 0, F.lit(float("nan"))).otherwise(F.col("l_discount")).alias("VAL"))
    return normalise_nulls(p)


@query("b13_outcome_flags", "B13", f"""
WITH {WIDE_CTE}
SELECT LCC_COMCOR, LCC_COMCOD,
  CASE WHEN I_DIASAUTORIZADOS = 0 THEN 1 WHEN DIASSOLICITADO > I_DIASAUTORIZADOS AND I_DIASAUTORIZADOS > 0 THEN 0 END
    AS ISAP_RECHAZA,
  CAST(CASE WHEN I_DIASAUTORIZADOS = DIASSOLICITADO THEN 1 ELSE 0 END AS INTEGER) AS ISAP_APRUEBA,
  ROUND(CAST(CAST(CASE WHEN DIASSOLICITADO > I_DIASAUTORIZADOS AND I_DIASAUTORIZADOS > 0
    THEN (DIASSOLICITADO - I_DIASAUTORIZADOS) / NULLIF(DIASSOLICITADO, 0) END AS FLOAT) AS DOUBLE), 5) AS ISAP_MODIFICA_PCT,
  CASE WHEN UPPER(RESOLUCION_COMPIN) = 'RATIFICA' THEN 1 WHEN UPPER(RESOLUCION_COMPIN) = 'DENIEGA' THEN 0 END
    AS ISAP_GANA_COMPIN,
  CASE WHEN UPPER(CIE_GRUPO) = 'PSIQUIATRICAS' THEN 1 ELSE 0 END AS IS_PSIQUIATRICA_CURRENT_FLAG,
  CAST(CASE WHEN PRESTADOR_TIPO = 'medico' THEN 1 ELSE 0 END AS INTEGER) AS PASO_FASTTRACK
FROM wide""")
def b13_outcome_flags(spark, sf_dir):
    w = _wide(spark, sf_dir).select("LCC_COMCOR", "LCC_COMCOD", "I_DIASAUTORIZADOS", "DIASSOLICITADO",
                                     "RESOLUCION_COMPIN", "CIE_GRUPO", "PRESTADOR_TIPO")
    out = B.outcome_flags(w, prior_col="PRESTADOR_TIPO", prior_value="medico")
    return out.select("LCC_COMCOR", "LCC_COMCOD", "ISAP_RECHAZA", "ISAP_APRUEBA",
                      F.round(F.col("ISAP_MODIFICA_PCT").cast("double"), 5).alias("ISAP_MODIFICA_PCT"),
                      "ISAP_GANA_COMPIN", "IS_PSIQUIATRICA_CURRENT_FLAG", "PASO_FASTTRACK")


# ---------------------------------------------------------------- B9, B10
B10_SPEC = ["AFILIADO_RUT", ("LCC_COMCOR", "FOLIO_LM"), ("DIASSOLICITADO", "DIAS"), ("RESOLUCION_COMPIN", "VEREDICTO"),
            ("CTD_ENVIA_PERITAJE", "N_PERITAJES", "bigint"), "CIE_GRUPO"]


@query("b10_project_rename", ("B9", "B10"), f"""
WITH {_claims_cte()}
SELECT AFILIADO_RUT, LCC_COMCOR AS FOLIO_LM, DIASSOLICITADO AS DIAS, ifnull(RESOLUCION_COMPIN, 'SIN VEREDICTO') AS VEREDICTO,
  0::BIGINT AS N_PERITAJES, NULL::VARCHAR AS CIE_GRUPO
FROM claims""")
def b10_project_rename(spark, sf_dir):
    """Renamed pass-through; two columns that the table lacks, one of them with a default."""
    out = B.project_rename(an.claims_from_orders(spark, sf_dir), B10_SPEC)
    return B.fill_defaults(out, {"VEREDICTO": "SIN VEREDICTO", "N_PERITAJES": 0})
