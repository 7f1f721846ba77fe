"""Registered queries: decisioning and classification metrics
(survey M1-M8, K5, D7-D10, F2-F4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import decision as M
from ..operators.classification import classification_metrics
from ..sources import analogues as an
from ..session import cut_lineage
from .registry import query

SCORED = an.sql_cte("scored", an.SCORED_FROM_LINEITEM, "lineitem")
G, Y = 0.8, 0.3  # thresholds used by the light-based queries


def _scored(spark, sf_dir):
    return an.scored_from_lineitem(spark, sf_dir)


def _fp_sql(rate: float, review: float) -> str:
    gross = "CAST(DIASSOLICITADO AS DOUBLE) * 59000"
    if rate > 0:
        return (f"GREATEST({gross} * (CAST(1 AS DOUBLE) - CAST({rate} AS DOUBLE)) - CAST({review} AS DOUBLE), "
                f"CAST(0 AS DOUBLE))")
    return gross


def _light_sql(g=G, y=Y, prior=True) -> str:
    first = "WHEN LEAK_FT = 1 THEN 'FT1_APROBADO' " if prior else ""
    return (f"CASE {first}"
            f"WHEN PROBABILIDAD_APROBACION >= {g} AND (DIASSOLICITADO > 20 OR EPISODIO_ACUM_DIAS >= 30) "
            f"THEN 'AMARILLO' WHEN PROBABILIDAD_APROBACION >= {g} THEN 'VERDE' "
            f"WHEN PROBABILIDAD_APROBACION >= {y} THEN 'AMARILLO' ELSE 'ROJO' END")


# ---------------------------------------------------------------- M1
M1_SQL = f"""
WITH {SCORED}
SELECT LCC_COMCOR, LCC_COMCOD, ROUND({_fp_sql(0.0, 5000)}, 2) AS COSTO_FP,
       ROUND({_fp_sql(0.79, 5000)}, 2) AS COSTO_FP_NETO
FROM scored
"""


@query("m1_net_false_positive_cost", "M1", M1_SQL)
def m1_net_false_positive_cost(spark, sf_dir):
    s = _scored(spark, sf_dir)
    d = F.col("DIASSOLICITADO")
    return s.select("LCC_COMCOR", "LCC_COMCOD",
                    F.round(M.net_false_positive_cost(d, 0.0, 5000), 2).alias("COSTO_FP"),
                    F.round(M.net_false_positive_cost(d, 0.79, 5000), 2).alias("COSTO_FP_NETO"))


# ---------------------------------------------------------------- M2
def _m2_sql(pop: str, rate: float, review: float, grid) -> str:
    (g0, g1), (y0, y1) = grid
    fp = _fp_sql(rate, review)
    return f"""
WITH {SCORED},
pop AS (SELECT * FROM scored WHERE {pop}),
ga AS (SELECT i FROM range({g0}, {g1 + 1}) t(i)),
ya AS (SELECT i FROM range({y0}, {y1 + 1}) t(i)),
a AS (SELECT ga.i AS gk,
        SUM(CASE WHEN p.PROBABILIDAD_APROBACION >= CAST(ga.i AS DOUBLE) / 1000 AND p.TARGET_FT3 = 0
                 THEN {fp.replace('DIASSOLICITADO', 'p.DIASSOLICITADO')} ELSE 0 END) AS fpc,
        COUNT(CASE WHEN p.PROBABILIDAD_APROBACION >= CAST(ga.i AS DOUBLE) / 1000 THEN 1 END) AS verde,
        COUNT(CASE WHEN p.PROBABILIDAD_APROBACION >= CAST(ga.i AS DOUBLE) / 1000 AND p.TARGET_FT3 = 0 THEN 1 END) AS fp,
        COUNT(CASE WHEN p.PROBABILIDAD_APROBACION < CAST(ga.i AS DOUBLE) / 1000 THEN 1 END) AS lt_g
      FROM ga, pop p GROUP BY ga.i),
b AS (SELECT ya.i AS yk,
        COUNT(CASE WHEN p.PROBABILIDAD_APROBACION < CAST(ya.i AS DOUBLE) / 1000 THEN 1 END) AS lt_y,
        COUNT(CASE WHEN p.PROBABILIDAD_APROBACION < CAST(ya.i AS DOUBLE) / 1000 AND p.TARGET_FT3 = 1 THEN 1 END) AS fn
      FROM ya, pop p GROUP BY ya.i),
c AS (SELECT *, ROUND(fpc + {review} * (lt_g - lt_y) + 20000 * fn, 2) AS cost FROM a JOIN b ON b.yk < a.gk)
SELECT CAST(gk AS DOUBLE) / 1000 AS UMBRAL_VERDE, CAST(yk AS DOUBLE) / 1000 AS UMBRAL_AMARILLO,
       cost AS COSTO_TOTAL, verde AS CASOS_VERDE, lt_g - lt_y AS CASOS_AMARILLO, lt_y AS CASOS_ROJO,
       fp AS FP_VERDE, ROUND(fpc, 2) AS COSTO_FP_VERDE, fn AS FN_ROJO, CAST(20000 * fn AS DOUBLE) AS COSTO_FN_ROJO,
       CAST({review} * (lt_g - lt_y) AS DOUBLE) AS COSTO_AMARILLO
FROM c ORDER BY cost, gk, yk LIMIT 1
"""


def _m2(spark, sf_dir, population, rate, review, grid):
    out = M.optimise_two_thresholds(_scored(spark, sf_dir), label="TARGET_FT3", review=review,
                                    reversal_rate=rate, grid=grid, population=population)
    return out.withColumn("COSTO_TOTAL", F.round("COSTO_TOTAL", 2)) \
              .withColumn("COSTO_FP_VERDE", F.round("COSTO_FP_VERDE", 2))


# The daily axes, in thousandths (green 0.500 to 0.998, yellow 0.100 to 0.400).
DAILY_AXES = ((500, 998), (100, 400))


@query("m2_optimise_thresholds_daily", ("M2", "M1"), _m2_sql("LEAK_FT = 0", 0.0, 5000, DAILY_AXES))
def m2_optimise_thresholds_daily(spark, sf_dir):
    return _m2(spark, sf_dir, F.col("LEAK_FT") == 0, 0.0, 5000, M.GRID_DAILY)


@query("m2_optimise_thresholds_period", ("M2", "M1"), _m2_sql("TRUE", 0.5, 500, M.GRID_PERIOD))
def m2_optimise_thresholds_period(spark, sf_dir):
    return _m2(spark, sf_dir, None, 0.5, 500, M.GRID_PERIOD)


# ---------------------------------------------------------------- M3, M4
def _m3_sql(lo: int, hi: int, rate: float, rates=None) -> str:
    rate_src = (f"(VALUES {', '.join(f'({r})' for r in rates)}) rr(rate)" if rates
                else f"(VALUES ({rate})) rr(rate)")
    fp = ("CASE WHEN rr.rate > 0 THEN GREATEST(CAST(p.DIASSOLICITADO AS DOUBLE) * 59000 * "
          "(CAST(1 AS DOUBLE) - CAST(rr.rate AS DOUBLE)) - CAST(5000 AS DOUBLE), CAST(0 AS DOUBLE)) "
          "ELSE CAST(p.DIASSOLICITADO AS DOUBLE) * 59000 END")
    return f"""
WITH {SCORED},
ga AS (SELECT i FROM range({lo}, {hi + 1}) t(i)),
curve AS (
  SELECT CAST(rr.rate AS DOUBLE) AS rate, ga.i AS k, CAST(ga.i AS DOUBLE) / 1000 AS UMBRAL_VERDE,
    ROUND(SUM(CASE WHEN p.PROBABILIDAD_APROBACION >= CAST(ga.i AS DOUBLE) / 1000 AND p.TARGET_APRUEBA = 0
                   THEN {fp} ELSE 0 END)
          + 5000 * COUNT(CASE WHEN p.PROBABILIDAD_APROBACION >= 0.5
                               AND p.PROBABILIDAD_APROBACION < CAST(ga.i AS DOUBLE) / 1000 THEN 1 END)
          + 20000 * COUNT(CASE WHEN p.PROBABILIDAD_APROBACION < 0.5 AND p.TARGET_APRUEBA = 1 THEN 1 END), 2)
      AS COSTO_TOTAL,
    COUNT(CASE WHEN p.PROBABILIDAD_APROBACION >= CAST(ga.i AS DOUBLE) / 1000 AND p.TARGET_APRUEBA = 0 THEN 1 END)
      AS FP_VERDE,
    COUNT(CASE WHEN p.PROBABILIDAD_APROBACION >= CAST(ga.i AS DOUBLE) / 1000 THEN 1 END) AS CASOS_VERDE,
    ROUND(SUM(CASE WHEN p.PROBABILIDAD_APROBACION >= CAST(ga.i AS DOUBLE) / 1000 AND p.TARGET_APRUEBA = 0
                   THEN {fp} ELSE 0 END), 2) AS COSTO_FP_VERDE
  FROM ga, {rate_src}, (SELECT *, TARGET_FT3 AS TARGET_APRUEBA FROM scored) p
  GROUP BY rr.rate, ga.i)
"""


def _curve(spark, sf_dir, lo, hi, rate, rates=None):
    s = _scored(spark, sf_dir).withColumnRenamed("TARGET_FT3", "TARGET_APRUEBA")
    c = M.sweep_green_threshold(s, green=(lo, hi), reversal_rate=rate, rates=rates)
    return c.withColumn("COSTO_TOTAL", F.round("COSTO_TOTAL", 2)) \
            .withColumn("COSTO_FP_VERDE", F.round("COSTO_FP_VERDE", 2))


@query("m3_sweep_green_net", ("M3", "M1"),
       _m3_sql(500, 998, 0.79) + "SELECT rate, UMBRAL_VERDE, COSTO_TOTAL, FP_VERDE, CASOS_VERDE, COSTO_FP_VERDE FROM curve")
def m3_sweep_green_net(spark, sf_dir):
    return _curve(spark, sf_dir, 500, 998, 0.79).drop("__k")


@query("m3_sweep_green_nominal", "M3",
       _m3_sql(900, 998, 0.0) + "SELECT rate, UMBRAL_VERDE, COSTO_TOTAL, FP_VERDE, CASOS_VERDE, COSTO_FP_VERDE FROM curve")
def m3_sweep_green_nominal(spark, sf_dir):
    return _curve(spark, sf_dir, 900, 998, 0.0).drop("__k")


RATES = (0.5, 0.6, 0.7, 0.79, 0.85, 0.9)


@query("m4_reversal_sensitivity", "M4", _m3_sql(500, 998, 0.0, RATES) + """
SELECT rate AS TASA_REVERSION, arg_min(UMBRAL_VERDE, (COSTO_TOTAL, k)) AS UMBRAL_OPTIMO,
       MIN(COSTO_TOTAL) AS COSTO_MINIMO
FROM curve GROUP BY rate""")
def m4_reversal_sensitivity(spark, sf_dir):
    return M.best_of_sweep(_curve(spark, sf_dir, 500, 998, 0.0, RATES))


# ---------------------------------------------------------------- M5, M6
M5_SQL = f"""
WITH {SCORED}, l AS (SELECT LCC_COMCOR, LCC_COMCOD, {_light_sql()} AS SEMAFORO,
                            {_light_sql(prior=False)} AS SEMAFORO_SIN_FT1 FROM scored)
SELECT *, CASE SEMAFORO WHEN 'VERDE' THEN '{M.DECISION_TEXT[M.GREEN]}'
                        WHEN 'AMARILLO' THEN '{M.DECISION_TEXT[M.YELLOW]}'
                        WHEN 'ROJO' THEN '{M.DECISION_TEXT[M.RED]}' ELSE '' END AS GLOSA_GENERADA
FROM l
"""


@query("m5_assign_light", ("M5", "M6"), M5_SQL)
def m5_assign_light(spark, sf_dir):
    s = M.assign_light(_scored(spark, sf_dir), G, Y)
    s = M.assign_light(s, G, Y, use_prior_class=False, out="SEMAFORO_SIN_FT1")
    return s.select("LCC_COMCOR", "LCC_COMCOD", "SEMAFORO", "SEMAFORO_SIN_FT1",
                    M.decision_text(F.col("SEMAFORO")).alias("GLOSA_GENERADA"))


# ---------------------------------------------------------------- M7, M8
M7_SQL = _m2_sql("LEAK_FT = 0", 0.0, 5000, DAILY_AXES).replace(
    "FROM c ORDER BY cost, gk, yk LIMIT 1", "FROM c").replace("SELECT CAST(gk AS DOUBLE) / 1000 AS UMBRAL_VERDE", "SELECT gk, yk, CAST(gk AS DOUBLE) / 1000 AS UMBRAL_VERDE")
M7_SQL = f"""
WITH allc AS ({M7_SQL}),
fx AS (SELECT COSTO_TOTAL AS fix FROM allc WHERE gk = 940 AND yk = 160),
op AS (SELECT MIN(COSTO_TOTAL) AS opt FROM allc)
SELECT CAST(0.94 AS DOUBLE) AS UMBRAL_VERDE_FIJO, CAST(0.16 AS DOUBLE) AS UMBRAL_AMARILLO_FIJO, fix AS COSTO_FIJO, opt AS COSTO_OPTIMO,
       ROUND(fix - opt, 2) AS AHORRO,
       ROUND(CASE WHEN fix > 0 THEN (fix - opt) / fix * 100 END, 4) AS AHORRO_PCT
FROM fx, op
"""


@query("m7_compare_fixed_vs_optimised", ("M7", "M2"), M7_SQL)
def m7_compare_fixed_vs_optimised(spark, sf_dir):
    out = M.compare_fixed_vs_optimised(_scored(spark, sf_dir), population=F.col("LEAK_FT") == 0)
    return out.select("UMBRAL_VERDE_FIJO", "UMBRAL_AMARILLO_FIJO", F.round("COSTO_FIJO", 2).alias("COSTO_FIJO"),
                      F.round("COSTO_OPTIMO", 2).alias("COSTO_OPTIMO"), F.round("AHORRO", 2).alias("AHORRO"),
                      F.round("AHORRO_PCT", 4).alias("AHORRO_PCT"))


M8_SQL = f"""
WITH {SCORED}
SELECT ROUND(CASE WHEN COUNT(CASE WHEN PROBABILIDAD_APROBACION >= {G} THEN 1 END) > 0
  THEN COUNT(CASE WHEN PROBABILIDAD_APROBACION >= {G} AND TARGET_FT3 = 1 THEN 1 END)
       / COUNT(CASE WHEN PROBABILIDAD_APROBACION >= {G} THEN 1 END) ELSE 0 END, 6) AS PRECISION_VERDE,
  ROUND(CASE WHEN COUNT(CASE WHEN PROBABILIDAD_APROBACION < {Y} THEN 1 END) > 0
  THEN COUNT(CASE WHEN PROBABILIDAD_APROBACION < {Y} AND TARGET_FT3 = 0 THEN 1 END)
       / COUNT(CASE WHEN PROBABILIDAD_APROBACION < {Y} THEN 1 END) ELSE 0 END, 6) AS PRECISION_ROJO,
  COUNT(CASE WHEN PROBABILIDAD_APROBACION >= {G} THEN 1 END) AS CASOS_VERDE,
  COUNT(CASE WHEN PROBABILIDAD_APROBACION < {Y} THEN 1 END) AS CASOS_ROJO
FROM scored
"""


@query("m8_zone_precision", "M8", M8_SQL)
def m8_zone_precision(spark, sf_dir):
    return M.zone_precision(_scored(spark, sf_dir), G, Y)


# ---------------------------------------------------------------- K5
K5_SQL = f"""
WITH {SCORED},
d AS (SELECT PROBABILIDAD_APROBACION AS s, TARGET_FT3 AS y FROM scored WHERE TARGET_FT3 IS NOT NULL),
g AS (SELECT s, SUM(y) AS pos, SUM(1 - y) AS neg FROM d GROUP BY s),
c AS (SELECT *, COALESCE(SUM(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g),
auc AS (SELECT SUM(pos * (below + 0.5 * neg)) / (CAST(SUM(pos) AS DOUBLE) * SUM(neg)) AS AUC FROM c),
cm AS (SELECT COUNT(CASE WHEN s > 0.5 AND y = 1 THEN 1 END) AS TP, COUNT(CASE WHEN s > 0.5 AND y = 0 THEN 1 END) AS FP,
              COUNT(CASE WHEN s <= 0.5 AND y = 1 THEN 1 END) AS FN, COUNT(CASE WHEN s <= 0.5 AND y = 0 THEN 1 END) AS TN,
              COUNT(*) AS N FROM d),
m AS (SELECT *, CASE WHEN TP + FP > 0 THEN TP / (TP + FP) ELSE 0 END AS P,
                CASE WHEN TP + FN > 0 THEN TP / (TP + FN) ELSE 0 END AS R FROM cm)
SELECT ROUND(AUC, 6) AS AUC, ROUND(P, 6) AS PRECISION, ROUND(R, 6) AS RECALL,
       ROUND(CASE WHEN P + R > 0 THEN 2 * P * R / (P + R) ELSE 0 END, 6) AS F1, TP, FP, FN, TN, N
FROM m, auc
"""


@query("k5_classification_metrics", "K5", K5_SQL)
def k5_classification_metrics(spark, sf_dir):
    return classification_metrics(_scored(spark, sf_dir), "PROBABILIDAD_APROBACION", "TARGET_FT3")


# ---------------------------------------------------------------- D7-D10, F2-F4
LIGHTED = f"{SCORED}, lit AS (SELECT *, {_light_sql()} AS SEMAFORO, " \
          "CASE WHEN TARGET_FT3 IS NULL THEN 'PENDIENTE' ELSE 'CON_DICTAMEN' END AS GRUPO FROM scored)"


def _lit(spark, sf_dir):
    s = M.assign_light(_scored(spark, sf_dir), G, Y)
    return s.withColumn("GRUPO", F.when(F.col("TARGET_FT3").isNull(), "PENDIENTE").otherwise("CON_DICTAMEN"))


@query("d7_light_distribution", "D7", f"""
WITH {LIGHTED}, c AS (SELECT GRUPO, SEMAFORO, COUNT(*) AS N FROM lit GROUP BY 1, 2)
SELECT *, ROUND(N * 100.0 / SUM(N) OVER (PARTITION BY GRUPO), 6) AS PCT FROM c""")
def d7_light_distribution(spark, sf_dir):
    return M.light_distribution(_lit(spark, sf_dir))


@query("d8_green_zone_validation", "D8", f"""
WITH {LIGHTED}, a AS (SELECT COUNT(*) AS TOTAL_VERDE, COUNT(CASE WHEN TARGET_FT3 = 1 THEN 1 END) AS TP,
  COUNT(CASE WHEN TARGET_FT3 = 0 THEN 1 END) AS FP FROM lit WHERE SEMAFORO = 'VERDE' AND GRUPO = 'CON_DICTAMEN')
SELECT *, ROUND(CASE WHEN TP + FP > 0 THEN TP / (TP + FP) ELSE 0 END, 6) AS PRECISION FROM a""")
def d8_green_zone_validation(spark, sf_dir):
    return M.green_zone_validation(_lit(spark, sf_dir).where(F.col("GRUPO") == "CON_DICTAMEN"))


def _d9_sql() -> str:
    n = ", ".join(f"COUNT(CASE WHEN SEMAFORO = '{x}' THEN 1 END) AS N_{x}" for x in M.LIGHTS)
    tot = " + ".join(f"N_{x}" for x in M.LIGHTS)
    p = ", ".join(f"ROUND(CASE WHEN {tot} > 0 THEN N_{x} * 100.0 / ({tot}) END, 6) AS PCT_{x}" for x in M.LIGHTS)
    return f"WITH {LIGHTED.replace(_light_sql(), _light_sql(prior=False))}, " \
           f"c AS (SELECT LEAK_FT, {n} FROM lit GROUP BY LEAK_FT) SELECT *, {p} FROM c"


@query("d9_prior_system_crosstab", "D9", _d9_sql())
def d9_prior_system_crosstab(spark, sf_dir):
    s = M.assign_light(_scored(spark, sf_dir), G, Y, use_prior_class=False)
    return M.prior_system_crosstab(s)


D10_NAMES = (["TOTAL_LICENCIAS", "CON_DICTAMEN", "PENDIENTES"] + [f"PENDIENTES_{x}" for x in M.LIGHTS]
             + ["DIAS_SOLICITADOS_VERDE", "PRECISION_VERDE", "FALSOS_POSITIVOS", "UMBRAL_VERDE", "UMBRAL_AMARILLO"])


def _d10_sql() -> str:
    vals = ["COUNT(*)", "COUNT(CASE WHEN GRUPO = 'CON_DICTAMEN' THEN 1 END)",
            "COUNT(CASE WHEN GRUPO = 'PENDIENTE' THEN 1 END)"] + \
           [f"COUNT(CASE WHEN GRUPO = 'PENDIENTE' AND SEMAFORO = '{x}' THEN 1 END)" for x in M.LIGHTS] + \
           ["COALESCE(SUM(CASE WHEN GRUPO = 'PENDIENTE' AND SEMAFORO = 'VERDE' THEN DIASSOLICITADO END), 0)",
            "CASE WHEN COUNT(CASE WHEN SEMAFORO = 'VERDE' AND TARGET_FT3 IS NOT NULL THEN 1 END) > 0 THEN "
            "COUNT(CASE WHEN SEMAFORO = 'VERDE' AND TARGET_FT3 = 1 THEN 1 END) / "
            "COUNT(CASE WHEN SEMAFORO = 'VERDE' AND TARGET_FT3 IS NOT NULL THEN 1 END) END",
            "COUNT(CASE WHEN SEMAFORO = 'VERDE' AND TARGET_FT3 = 0 THEN 1 END)", str(G), str(Y)]
    cols = ", ".join(f"CAST({v} AS DOUBLE) AS v{i}" for i, v in enumerate(vals))
    unp = " UNION ALL ".join(f"SELECT {i} AS ORDEN, '{n}' AS METRICA, ROUND(v{i}, 6) AS VALOR FROM a"
                             for i, n in enumerate(D10_NAMES))
    return f"WITH {LIGHTED}, a AS (SELECT {cols} FROM lit) {unp}"


@query("d10_report_summary", "D10", _d10_sql())
def d10_report_summary(spark, sf_dir):
    lt = _lit(spark, sf_dir)
    return M.report_summary(lt.where(F.col("GRUPO") == "CON_DICTAMEN"), lt.where(F.col("GRUPO") == "PENDIENTE"), G, Y)


@query("f2_review_queue", "F2", f"""
WITH {LIGHTED} SELECT LCC_COMCOR, LCC_COMCOD, SEMAFORO, PROBABILIDAD_APROBACION FROM lit
WHERE GRUPO = 'PENDIENTE' ORDER BY SEMAFORO, PROBABILIDAD_APROBACION DESC, LCC_COMCOR, LCC_COMCOD""")
def f2_review_queue(spark, sf_dir):
    p = _lit(spark, sf_dir).where(F.col("GRUPO") == "PENDIENTE")
    return M.review_queue(p, keys=["LCC_COMCOR", "LCC_COMCOD"]).select(
        "LCC_COMCOR", "LCC_COMCOD", "SEMAFORO", "PROBABILIDAD_APROBACION")


@query("f3_top_groups_in_green", "F3", f"""
WITH {LIGHTED}, g AS (SELECT p.p_type AS CIE_GRUPO FROM lit JOIN part p ON lit.PART_KEY = p.p_partkey
                     WHERE SEMAFORO = 'VERDE'),
c AS (SELECT CIE_GRUPO, COUNT(*) AS N FROM g GROUP BY 1)
SELECT CIE_GRUPO, N, ROUND(N * 100.0 / (SELECT COUNT(*) FROM g), 6) AS PCT FROM c
ORDER BY N DESC, CIE_GRUPO LIMIT 10""")
def f3_top_groups_in_green(spark, sf_dir):
    part = an.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("PART_KEY"),
                                                  F.col("p_type").alias("CIE_GRUPO"))
    lt = _lit(spark, sf_dir).join(part, "PART_KEY")
    return M.top_groups_in_green(lt, 10)


@query("f4_false_positive_list", "F4", f"""
WITH {LIGHTED} SELECT LCC_COMCOR, LCC_COMCOD, PROBABILIDAD_APROBACION FROM lit
WHERE SEMAFORO = 'VERDE' AND TARGET_FT3 = 0 ORDER BY PROBABILIDAD_APROBACION DESC""")
def f4_false_positive_list(spark, sf_dir):
    return M.false_positive_list(_lit(spark, sf_dir)).select("LCC_COMCOR", "LCC_COMCOD", "PROBABILIDAD_APROBACION")


@query("f4_green_list", "F4", f"""
WITH {LIGHTED} SELECT LCC_COMCOR, LCC_COMCOD, PROBABILIDAD_APROBACION, DIASSOLICITADO FROM lit
WHERE SEMAFORO = 'VERDE' AND GRUPO = 'PENDIENTE' ORDER BY PROBABILIDAD_APROBACION DESC""")
def f4_green_list(spark, sf_dir):
    p = _lit(spark, sf_dir).where(F.col("GRUPO") == "PENDIENTE")
    return M.green_list(p).select("LCC_COMCOR", "LCC_COMCOD", "PROBABILIDAD_APROBACION", "DIASSOLICITADO")


# ---------------------------------------------------------------- A11
@query("a11_report_set", ("A11", "D7", "D8", "D10", "F2", "F4"), f"""
WITH {LIGHTED}
SELECT 'resumen' AS INFORME, {len(D10_NAMES)} AS FILAS, 0 AS DIAS
UNION ALL SELECT 'distribucion', count(*), sum(N) FROM (SELECT GRUPO, SEMAFORO, count(*) AS N FROM lit GROUP BY ALL)
UNION ALL SELECT 'validacion_verde', 1, count(*) FROM lit WHERE SEMAFORO = 'VERDE' AND GRUPO = 'CON_DICTAMEN'
UNION ALL SELECT 'cola_revision', count(*), sum(DIASSOLICITADO) FROM lit WHERE GRUPO = 'PENDIENTE'
UNION ALL SELECT 'lista_verde', count(*), sum(DIASSOLICITADO) FROM lit WHERE GRUPO = 'PENDIENTE' AND SEMAFORO = 'VERDE'
UNION ALL SELECT 'falsos_positivos', count(*), sum(DIASSOLICITADO) FROM lit WHERE SEMAFORO = 'VERDE' AND TARGET_FT3 = 0""")
def a11_report_set(spark, sf_dir):
    """A run's report written by one call, and what its CSV files hold when they are read back."""
    import uuid

    from ..session import ensure_checkpoint_dir
    from .scoring import report_set
    lt = cut_lineage(_lit(spark, sf_dir))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/report-{uuid.uuid4().hex}"
    frames = report_set(lt.where(F.col("GRUPO") == "CON_DICTAMEN").drop("GRUPO"), lt.where(F.col("GRUPO") == "PENDIENTE").drop("GRUPO"),
                        G, Y, path, keys=["LCC_COMCOR", "LCC_COMCOD"])
    sums = {"resumen": F.lit(0), "distribucion": F.sum("N"), "validacion_verde": F.sum("TOTAL_VERDE")}
    out = None
    for name in frames:
        back = spark.read.option("header", True).csv(f"{path}/{name}")
        row = back.agg(F.count(F.lit(1)).cast("bigint").alias("FILAS"), sums.get(name, F.sum("DIASSOLICITADO")).cast("bigint").alias("DIAS"))
        row = row.select(F.lit(name).alias("INFORME"), "FILAS", "DIAS")
        out = row if out is None else out.unionByName(row)
    return out
