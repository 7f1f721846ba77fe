"""Registered queries: monthly metrics, latest joins, merges, ranks, set ops
(survey A6, A8, A9, C1, C2, C7, C9, C10, D11, E1, E2, F1, G1, G2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins as J
from ..operators import merge as M
from ..operators.monthly import Measure, monthly_metrics
from ..sources import analogues as an
from .catalog_mart import R6, _claims_cte, _round
from .registry import query

CLAIM_COLS = ["AFILIADO_RUT", "LCC_COMCOR", "LCC_COMCOD", "FECHA_RECEPCION", "RESOLUCION_COMPIN",
              "FECHA_RESOLUCION_COMPIN", "DIASSOLICITADO", "F_DIASAUTORIZADOS"]

# ---------------------------------------------------------------- D11
D11_WINDOWS = (1, 6, 12, 24, 36)


def _d11_measures():
    return [
        Measure("LM_TOTAL", "count", F.col("LCC_COMCOR")),
        Measure("COMPIN_RATIFICA", "count", F.when(F.upper("RESOLUCION_COMPIN") == "RATIFICA", 1)),
        Measure("DIAS_SOLICITADOS", "sum", F.col("DIASSOLICITADO")),
        Measure("F_DIAS_PROMEDIO", "mean", F.when(F.col("F_DIASAUTORIZADOS") > 0, F.col("F_DIASAUTORIZADOS"))),
        Measure("F_DIAS_MINIMO", "min", F.col("F_DIASAUTORIZADOS")),
        Measure("F_DIAS_MAXIMO", "max", F.col("F_DIASAUTORIZADOS")),
        Measure("CODIGOS_DISTINTOS", "distinct", F.col("LCC_COMCOD")),
    ]


def _d11_sql() -> str:
    sel = []
    for w in D11_WINDOWS:
        c = f"mon.m > s.t - {w}"
        sel += [
            f"COUNT(CASE WHEN {c} THEN mon.LCC_COMCOR END) AS LM_TOTAL_U{w}M",
            f"COUNT(CASE WHEN {c} AND UPPER(mon.RESOLUCION_COMPIN) = 'RATIFICA' THEN 1 END) AS COMPIN_RATIFICA_U{w}M",
            f"CAST(SUM(CASE WHEN {c} THEN mon.DIASSOLICITADO END) AS BIGINT) AS DIAS_SOLICITADOS_U{w}M",
            f"ROUND(AVG(CASE WHEN {c} AND mon.F_DIASAUTORIZADOS > 0 THEN mon.F_DIASAUTORIZADOS END), {R6}) "
            f"AS F_DIAS_PROMEDIO_U{w}M",
            f"MIN(CASE WHEN {c} THEN mon.F_DIASAUTORIZADOS END) AS F_DIAS_MINIMO_U{w}M",
            f"MAX(CASE WHEN {c} THEN mon.F_DIASAUTORIZADOS END) AS F_DIAS_MAXIMO_U{w}M",
            f"COUNT(DISTINCT CASE WHEN {c} THEN mon.LCC_COMCOD END) AS CODIGOS_DISTINTOS_U{w}M",
        ]
    return f"""
WITH {_claims_cte()},
mon AS (SELECT *, year(FECHA_RECEPCION) * 12 + month(FECHA_RECEPCION) - 1 AS m FROM claims),
s AS (SELECT DISTINCT AFILIADO_RUT, m + k AS t FROM mon, range(0, 36) r(k))
SELECT s.AFILIADO_RUT,
  strftime(make_date(CAST(s.t // 12 AS INTEGER), CAST(s.t % 12 + 1 AS INTEGER), 1), '%m%Y') AS PERIODO,
  {', '.join(sel)}
FROM s JOIN mon ON s.AFILIADO_RUT = mon.AFILIADO_RUT AND mon.m BETWEEN s.t - 35 AND s.t
GROUP BY s.AFILIADO_RUT, s.t
"""


@query("d11_monthly_metrics", "D11", _d11_sql())
def d11_monthly_metrics(spark, sf_dir):
    claims = an.claims_from_orders(spark, sf_dir)
    out = monthly_metrics(claims, "AFILIADO_RUT", "FECHA_RECEPCION", _d11_measures(), D11_WINDOWS)
    return _round(out, {f"F_DIAS_PROMEDIO_U{w}M" for w in D11_WINDOWS})


# ---------------------------------------------------------------- C7
MONTHLY_SQL = """monthly AS (
  SELECT CAST(o_custkey AS STRING) AS AFILIADO_RUT, strftime(o_orderdate, '%m%Y') AS PERIODO,
         COUNT(*) AS LM_MES, ROUND(SUM(o_totalprice), 2) AS MONTO_MES
  FROM orders GROUP BY 1, 2)"""


def _monthly(spark, sf_dir):
    o = an.table(spark, sf_dir, "orders")
    return (o.groupBy(F.col("o_custkey").cast("string").alias("AFILIADO_RUT"),
                      F.date_format("o_orderdate", "MMyyyy").alias("PERIODO"))
             .agg(F.count(F.lit(1)).alias("LM_MES"), F.round(F.sum("o_totalprice"), 2).alias("MONTO_MES")))


def newest_sql(source: str, entity: str, as_of: str, columns: list[str], lexicographic: bool = False) -> str:
    """One row per entity: the packed columns of its newest period before the month of ``as_of``."""
    last = f"date_trunc('month', DATE '{as_of}') - INTERVAL 1 MONTH"
    period, bound = ("PERIODO", f"strftime({last}, '%m%Y')") if lexicographic else ("strptime(PERIODO, '%m%Y')", last)
    packed = ", ".join(f"'{c}': {c}" for c in ["PERIODO", *columns])
    return f"SELECT {entity}, arg_max({{{packed}}}, {period}) AS newest FROM {source} WHERE {period} <= {bound} GROUP BY ALL"


def _c7_sql(lexicographic: bool, as_of: str) -> str:
    return f"""
WITH {MONTHLY_SQL}
SELECT c_custkey, c_name, newest.PERIODO AS PERIODO_AFILIADO_RUT, newest.LM_MES AS LM_MES, newest.MONTO_MES AS MONTO_MES
FROM customer LEFT JOIN ({newest_sql("monthly", "AFILIADO_RUT", as_of, ["LM_MES", "MONTO_MES"], lexicographic)})
  ON AFILIADO_RUT = c_custkey::VARCHAR
"""


def _c7(spark, sf_dir, lexicographic, as_of):
    cust = an.table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.col("c_custkey").cast("string").alias("AFILIADO_RUT"))
    out = J.join_latest_period(cust, {"AFILIADO_RUT": _monthly(spark, sf_dir)}, as_of,
                               lexicographic=lexicographic)
    return out.drop("AFILIADO_RUT")


@query("c7_join_latest_period", "C7", _c7_sql(False, "2000-01-15"))
def c7_join_latest_period(spark, sf_dir):
    return _c7(spark, sf_dir, False, "2000-01-15")


@query("c7_join_latest_period_text_order", "C7", _c7_sql(True, "2000-01-15"))
def c7_join_latest_period_text_order(spark, sf_dir):
    return _c7(spark, sf_dir, True, "2000-01-15")


# ---------------------------------------------------------------- C1 / E1
LI_ORDER = ["l_shipdate", "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus"]

C1_SQL = f"""
WITH hist AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY
     {', '.join(c + ' DESC NULLS LAST' for c in LI_ORDER)}) AS rn
  FROM lineitem WHERE CAST(l_shipdate AS DATE) < DATE '1998-06-01' AND l_suppkey IS NOT NULL)
SELECT s.s_suppkey, s.s_name, {', '.join('h.' + c for c in LI_ORDER)}
FROM supplier s LEFT JOIN hist h ON s.s_suppkey = h.l_suppkey AND h.rn = 1
"""


@query("c1_join_latest_row", ("C1", "E1"), C1_SQL)
def c1_join_latest_row(spark, sf_dir):
    sup = an.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    li = an.table(spark, sf_dir, "lineitem")
    return J.join_latest_row(sup, li, ["s_suppkey"], ["l_suppkey"], ["l_shipdate"],
                             cutoff_col="l_shipdate", cutoff="1998-06-01", payload=LI_ORDER[1:])


E1_SQL = f"""
WITH {_claims_cte()}
SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY AFILIADO_RUT ORDER BY FECHA_RECEPCION DESC NULLS LAST,
    LCC_COMCOR DESC) AS rn FROM claims) WHERE rn <= 2
"""


@query("e1_newest_per_person", "E1", E1_SQL)
def e1_newest_per_person(spark, sf_dir):
    c = an.claims_from_orders(spark, sf_dir)
    return J.newest_per_partition(c, ["AFILIADO_RUT"], [F.col("FECHA_RECEPCION").desc_nulls_last(),
                                                       F.col("LCC_COMCOR").desc()], n=2)


# ---------------------------------------------------------------- C2 / A6
def _split(spark, sf_dir):
    c = an.claims_from_orders(spark, sf_dir)
    target = c.where(F.col("FECHA_RECEPCION") < F.lit("1999-01-01").cast("date"))
    source = c.where(F.col("FECHA_RECEPCION") >= F.lit("1998-07-01").cast("date"))
    return target, source


C2_SQL = f"""
WITH {_claims_cte()}
SELECT * FROM claims s WHERE s.FECHA_RECEPCION >= DATE '1998-07-01'
  AND NOT EXISTS (SELECT 1 FROM claims t WHERE t.FECHA_RECEPCION < DATE '1999-01-01'
                  AND t.AFILIADO_RUT = s.AFILIADO_RUT AND t.LCC_COMCOR = s.LCC_COMCOR)
"""


@query("c2_anti_join_existing", "C2", C2_SQL)
def c2_anti_join_existing(spark, sf_dir):
    target, source = _split(spark, sf_dir)
    return M.anti_join_existing(source, target, ["AFILIADO_RUT", "LCC_COMCOR"])


A6_SQL = f"""
WITH {_claims_cte()},
t AS (SELECT * FROM claims WHERE FECHA_RECEPCION < DATE '1999-01-01'),
s AS (SELECT * FROM claims WHERE FECHA_RECEPCION >= DATE '1998-07-01')
SELECT * FROM t
UNION ALL
SELECT * FROM s WHERE FECHA_RECEPCION BETWEEN DATE '1998-10-01' AND DATE '1999-03-31'
  AND NOT EXISTS (SELECT 1 FROM t WHERE t.AFILIADO_RUT = s.AFILIADO_RUT AND t.LCC_COMCOR = s.LCC_COMCOR)
"""


@query("a6_append_new", ("A6", "C2", "B16"), A6_SQL)
def a6_append_new(spark, sf_dir):
    target, source = _split(spark, sf_dir)
    new = M.append_new(source, target, ["AFILIADO_RUT", "LCC_COMCOR"], "FECHA_RECEPCION",
                       "1998-10-01", "1999-03-31")
    return target.unionByName(new)


# ---------------------------------------------------------------- A8 / A9
def _changed(source):
    return source.withColumn("DIASSOLICITADO", F.col("DIASSOLICITADO") + 1) \
                 .withColumn("RESOLUCION_COMPIN", F.lit("RATIFICA"))


A8_SQL = f"""
WITH {_claims_cte()},
t AS (SELECT * FROM claims WHERE FECHA_RECEPCION < DATE '1999-01-01'),
s AS (SELECT * REPLACE (DIASSOLICITADO + 1 AS DIASSOLICITADO, 'RATIFICA' AS RESOLUCION_COMPIN)
      FROM claims WHERE FECHA_RECEPCION >= DATE '1998-07-01')
SELECT COALESCE(s.AFILIADO_RUT, t.AFILIADO_RUT) AS AFILIADO_RUT,
       COALESCE(s.LCC_COMCOR, t.LCC_COMCOR) AS LCC_COMCOR,
       {', '.join(f"CASE WHEN s.AFILIADO_RUT IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}"
                  for c in CLAIM_COLS[2:])}
FROM t FULL OUTER JOIN s ON t.AFILIADO_RUT = s.AFILIADO_RUT AND t.LCC_COMCOR = s.LCC_COMCOR
"""


@query("a8_merge_upsert", "A8", A8_SQL)
def a8_merge_upsert(spark, sf_dir):
    target, source = _split(spark, sf_dir)
    return M.merge_upsert(target, _changed(source), ["AFILIADO_RUT", "LCC_COMCOR"])


A8P_SQL = f"""
WITH {_claims_cte()},
t AS (SELECT * FROM claims WHERE FECHA_RECEPCION < DATE '1999-01-01'),
s AS (SELECT * REPLACE (DIASSOLICITADO + 1 AS DIASSOLICITADO, 'RATIFICA' AS RESOLUCION_COMPIN)
      FROM claims WHERE FECHA_RECEPCION >= DATE '1998-07-01')
SELECT COALESCE(s.AFILIADO_RUT, t.AFILIADO_RUT) AS AFILIADO_RUT,
       COALESCE(s.LCC_COMCOR, t.LCC_COMCOR) AS LCC_COMCOR,
       {', '.join(f"CASE WHEN s.AFILIADO_RUT IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}"
                  for c in ["DIASSOLICITADO"])},
       {', '.join(f"CASE WHEN t.AFILIADO_RUT IS NOT NULL THEN t.{c} END AS {c}"
                  for c in CLAIM_COLS[2:] if c != "DIASSOLICITADO")}
FROM t FULL OUTER JOIN s ON t.AFILIADO_RUT = s.AFILIADO_RUT AND t.LCC_COMCOR = s.LCC_COMCOR
"""


@query("a8_merge_upsert_listed_columns", "A8", A8P_SQL)
def a8_merge_upsert_listed_columns(spark, sf_dir):
    target, source = _split(spark, sf_dir)
    return M.merge_upsert(target, _changed(source).select("AFILIADO_RUT", "LCC_COMCOR", "DIASSOLICITADO"),
                          ["AFILIADO_RUT", "LCC_COMCOR"], update_cols=["DIASSOLICITADO"])


PRED_COLS = ["SEMAFORO", "PROBABILIDAD_APROBACION"]
A9_PRED = ["CASE WHEN RESOLUCION_COMPIN = 'RATIFICA' THEN 'VERDE' END AS SEMAFORO",
            "CAST(CASE WHEN DIASSOLICITADO % 3 <> 0 THEN ROUND(DIASSOLICITADO / 50.0, 3) END AS DOUBLE) "
            "AS PROBABILIDAD_APROBACION"]
A9_PRED_SQL = ", ".join(A9_PRED)


A9_SQL = f"""
WITH {_claims_cte()},
t AS (SELECT *, {A9_PRED_SQL} FROM claims WHERE FECHA_RECEPCION < DATE '1999-01-01'),
s AS (SELECT * REPLACE (DIASSOLICITADO + 1 AS DIASSOLICITADO, 'AMARILLO' AS SEMAFORO,
                        0.5 AS PROBABILIDAD_APROBACION)
      FROM (SELECT *, {A9_PRED_SQL} FROM claims WHERE FECHA_RECEPCION >= DATE '1998-07-01'))
SELECT COALESCE(t.AFILIADO_RUT, s.AFILIADO_RUT) AS AFILIADO_RUT,
       COALESCE(t.LCC_COMCOR, s.LCC_COMCOR) AS LCC_COMCOR,
       CASE WHEN t.AFILIADO_RUT IS NOT NULL THEN COALESCE(t.SEMAFORO, s.SEMAFORO) ELSE s.SEMAFORO END AS SEMAFORO,
       CAST(CASE WHEN t.AFILIADO_RUT IS NOT NULL THEN COALESCE(t.PROBABILIDAD_APROBACION, s.PROBABILIDAD_APROBACION)
            ELSE s.PROBABILIDAD_APROBACION END AS DOUBLE) AS PROBABILIDAD_APROBACION,
       CASE WHEN t.AFILIADO_RUT IS NOT NULL AND s.AFILIADO_RUT IS NOT NULL THEN s.DIASSOLICITADO
            WHEN t.AFILIADO_RUT IS NOT NULL THEN t.DIASSOLICITADO ELSE s.DIASSOLICITADO END AS DIASSOLICITADO,
       CASE WHEN s.AFILIADO_RUT IS NULL OR t.AFILIADO_RUT IS NOT NULL THEN t.RESOLUCION_COMPIN END AS RESOLUCION_COMPIN,
       COALESCE(t.FECHA_RECEPCION, s.FECHA_RECEPCION) AS FECHA_RECEPCION
FROM t FULL OUTER JOIN s ON t.AFILIADO_RUT = s.AFILIADO_RUT AND t.LCC_COMCOR = s.LCC_COMCOR
"""


@query("a9_merge_first_write_wins", "A9", A9_SQL)
def a9_merge_first_write_wins(spark, sf_dir):
    target, source = _split(spark, sf_dir)
    cols = ["AFILIADO_RUT", "LCC_COMCOR", "SEMAFORO", "PROBABILIDAD_APROBACION", "DIASSOLICITADO",
            "RESOLUCION_COMPIN", "FECHA_RECEPCION"]
    t = target.selectExpr("*", *A9_PRED).select(*cols) \
              .withColumn("PROBABILIDAD_APROBACION", F.col("PROBABILIDAD_APROBACION").cast("double"))
    s = (source.selectExpr("*", *A9_PRED)
               .withColumn("DIASSOLICITADO", F.col("DIASSOLICITADO") + 1)
               .withColumn("SEMAFORO", F.lit("AMARILLO"))
               .withColumn("PROBABILIDAD_APROBACION", F.lit(0.5)).select(*cols))
    return M.merge_first_write_wins(t, s, ["AFILIADO_RUT", "LCC_COMCOR"],
                                    sticky_cols=["SEMAFORO", "PROBABILIDAD_APROBACION"],
                                    update_cols=["DIASSOLICITADO"],
                                    insert_cols=[c for c in cols if c != "RESOLUCION_COMPIN"])


# ---------------------------------------------------------------- E2
def rank_sql(old: str, new: str, claims: str = "claims") -> str:
    """1 + the old rows in the peer groups before each new row, by a frame over both."""
    return f"""
SELECT * EXCLUDE (is_old) FROM (
  SELECT AFILIADO_RUT, LCC_COMCOR, LCC_COMCOD, FECHA_RECEPCION, is_old, 1 + count(*) FILTER (is_old) OVER (
      PARTITION BY AFILIADO_RUT ORDER BY FECHA_RECEPCION, LCC_COMCOR, LCC_COMCOD
      GROUPS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS RN_AFILIADO_HIST
  FROM (SELECT *, true AS is_old FROM {claims} WHERE {old} UNION ALL SELECT *, false FROM {claims} WHERE {new}))
WHERE NOT is_old"""


E2_SQL = f"WITH {_claims_cte()} {rank_sql("FECHA_RECEPCION < DATE '2000-06-01'", "FECHA_RECEPCION >= DATE '2000-01-01'")}"


@query("e2_history_rank", "E2", E2_SQL)
def e2_history_rank(spark, sf_dir):
    c = an.claims_from_orders(spark, sf_dir).select("AFILIADO_RUT", "LCC_COMCOR", "LCC_COMCOD", "FECHA_RECEPCION")
    h = c.where(F.col("FECHA_RECEPCION") < F.lit("2000-06-01").cast("date"))
    m = c.where(F.col("FECHA_RECEPCION") >= F.lit("2000-01-01").cast("date"))
    return J.history_rank(m, h, "AFILIADO_RUT", ["FECHA_RECEPCION", "LCC_COMCOR", "LCC_COMCOD"])


# ---------------------------------------------------------------- C9, C10, G1, G2, F1
C9_SQL = f"""
WITH {_claims_cte()}
SELECT AFILIADO_RUT, LCC_COMCOR, FECHA_RECEPCION,
  COALESCE(RESOLUCION_COMPIN, MIN(RESOLUCION_COMPIN) OVER (PARTITION BY AFILIADO_RUT)) AS RESOLUCION_COMPIN,
  COALESCE(F_DIASAUTORIZADOS, MIN(F_DIASAUTORIZADOS) OVER (PARTITION BY AFILIADO_RUT)) AS F_DIASAUTORIZADOS
FROM claims
"""


@query("c9_lookup_fill", "C9", C9_SQL)
def c9_lookup_fill(spark, sf_dir):
    c = an.claims_from_orders(spark, sf_dir).select("AFILIADO_RUT", "LCC_COMCOR", "FECHA_RECEPCION",
                                                    "RESOLUCION_COMPIN", "F_DIASAUTORIZADOS")
    return J.lookup_fill(c, "AFILIADO_RUT", ["RESOLUCION_COMPIN", "F_DIASAUTORIZADOS"])


C10_SQL = f"""
WITH {_claims_cte()}
SELECT c.*, CASE WHEN EXISTS (SELECT 1 FROM claims p WHERE p.RESOLUCION_COMPIN IS NULL
  AND p.AFILIADO_RUT = c.AFILIADO_RUT AND p.LCC_COMCOD = c.LCC_COMCOD) THEN 1 ELSE 0 END AS ES_PENDIENTE
FROM claims c
"""


@query("c10_mark_membership", "C10", C10_SQL)
def c10_mark_membership(spark, sf_dir):
    c = an.claims_from_orders(spark, sf_dir)
    pending = c.where(F.col("RESOLUCION_COMPIN").isNull())
    return J.mark_membership(c, pending, ["AFILIADO_RUT", "LCC_COMCOD"], "ES_PENDIENTE")


G1_SQL = f"""
WITH {_claims_cte()}
SELECT AFILIADO_RUT, LCC_COMCOR, RESOLUCION_COMPIN, CAST(NULL AS BIGINT) AS DIASSOLICITADO, 0 AS ES_PENDIENTE
FROM claims WHERE RESOLUCION_COMPIN IS NOT NULL
UNION ALL
SELECT AFILIADO_RUT, LCC_COMCOR, NULL AS RESOLUCION_COMPIN, DIASSOLICITADO, 1 AS ES_PENDIENTE
FROM claims WHERE RESOLUCION_COMPIN IS NULL
"""


@query("g1_combine_predictions", "G1", G1_SQL)
def g1_combine_predictions(spark, sf_dir):
    c = an.claims_from_orders(spark, sf_dir)
    decided = c.where(F.col("RESOLUCION_COMPIN").isNotNull()) \
               .select("AFILIADO_RUT", "LCC_COMCOR", "RESOLUCION_COMPIN", F.lit(0).alias("ES_PENDIENTE"))
    pending = c.where(F.col("RESOLUCION_COMPIN").isNull()) \
               .select("AFILIADO_RUT", "LCC_COMCOR", "DIASSOLICITADO", F.lit(1).alias("ES_PENDIENTE"))
    return J.combine_predictions([decided, pending])


G2_SQL = f"""
WITH {_claims_cte()}
SELECT DISTINCT AFILIADO_RUT, FECHA_RECEPCION, RESOLUCION_COMPIN FROM claims
"""


@query("g2_distinct_rows", "G2", G2_SQL)
def g2_distinct_rows(spark, sf_dir):
    c = an.claims_from_orders(spark, sf_dir)
    return J.distinct_rows(c.select("AFILIADO_RUT", "FECHA_RECEPCION", "RESOLUCION_COMPIN"))


G2K_SQL = f"""
WITH {_claims_cte()}
SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY AFILIADO_RUT, LCC_COMCOD
  ORDER BY LCC_COMCOR) AS rn FROM claims) WHERE rn = 1
"""


@query("g2_dedupe_by_key", ("G2", "E1"), G2K_SQL)
def g2_dedupe_by_key(spark, sf_dir):
    c = an.claims_from_orders(spark, sf_dir)
    return J.dedupe_by_key(c, ["AFILIADO_RUT", "LCC_COMCOD"], [F.col("LCC_COMCOR").asc()])


F1_SQL = f"""
WITH {_claims_cte()}
SELECT * FROM claims ORDER BY FECHA_RECEPCION DESC, LCC_COMCOR LIMIT 100
"""


@query("f1_limit_ordered", "F1", F1_SQL)
def f1_limit_ordered(spark, sf_dir):
    from ..sources.tables import limit_ordered
    return limit_ordered(an.claims_from_orders(spark, sf_dir), 100,
                         [F.col("FECHA_RECEPCION").desc(), F.col("LCC_COMCOR")])


# ---------------------------------------------------------------- A8, write side
@query("a8_versioned_upsert", ("A8",), """
SELECT o_orderkey, o_orderdate, o_totalprice AS PRECIO, CASE WHEN o_orderkey % 3 = 0 AND o_orderdate >= DATE '2001-01-01' THEN 'NUEVO' ELSE 'VIEJO' END AS ESTADO
FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0 AND o_orderdate >= DATE '2001-01-01'""")
def a8_versioned_upsert(spark, sf_dir):
    """Two published versions of a table partitioned by year; the second one touches one year."""
    import uuid

    from ..session import ensure_checkpoint_dir
    from ..sources import versioned as V
    o = an.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", F.col("o_totalprice").alias("PRECIO"))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/orders-{uuid.uuid4().hex}"
    old = o.where("o_orderkey % 2 = 0").withColumn("ESTADO", F.lit("VIEJO"))
    new = o.where("o_orderkey % 3 = 0 AND o_orderdate >= DATE '2001-01-01'").withColumn("ESTADO", F.lit("NUEVO"))
    for rows in (old, new):
        V.upsert(spark, path, rows.withColumn("ANIO", F.year("o_orderdate")), ["o_orderkey"], "ANIO")
    return V.read(spark, path).drop("ANIO")
