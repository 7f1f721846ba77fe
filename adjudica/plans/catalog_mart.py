"""Registered queries for the feature mart (survey A, B, C, D1-D3, E, G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import claim_metrics as cm
from ..sources import analogues as an
from .registry import query

R6 = 6  # decimals kept for floating outputs on both sides


def _claims_cte() -> str:
    return an.sql_cte("claims", an.CLAIMS_FROM_ORDERS, "orders")


# number, then one scalar subquery for each metric.
D1_SQL = f"""
WITH {_claims_cte()},
asked AS (SELECT DISTINCT AFILIADO_RUT AS p, LCC_COMCOR AS c, LCC_COMCOD AS d, FECHA_RECEPCION AS f FROM claims),
pair AS (
  SELECT p, c, d, e.LCC_COMCOR AS number, e.FECHA_RESOLUCION_COMPIN IS NOT NULL AS dated, upper(e.RESOLUCION_COMPIN) AS verdict,
    e.F_DIASAUTORIZADOS AS allowed, e.DIASSOLICITADO AS days
  FROM asked, claims e
  WHERE e.AFILIADO_RUT = p AND date_diff('day', e.FECHA_RECEPCION, f) BETWEEN 1 AND 15
),
numbers AS (
  SELECT p, c, d, number, bool_or(dated) AS dated, bool_or(verdict IS NOT NULL) AS judged,
    bool_or(verdict = 'RATIFICA') AS upheld, bool_or(verdict = 'DENIEGA') AS refused
  FROM pair WHERE number IS NOT NULL GROUP BY ALL
),
tally AS (
  SELECT p, c, d, count(*) AS n, count(*) FILTER (dated) AS n_dated, count(*) FILTER (judged) AS n_judged,
    count(*) FILTER (upheld) AS n_upheld, count(*) FILTER (refused) AS n_refused
  FROM numbers GROUP BY ALL
),
amounts AS (
  SELECT p, c, d, avg(allowed) FILTER (allowed > 0) AS mean_allowed, sum(days) AS sum_days, max(days) AS max_days
  FROM pair GROUP BY ALL
)
SELECT p AS AFILIADO_RUT, c AS LCC_COMCOR, d AS LCC_COMCOD,
  ifnull(n, 0) AS CANT_LIC_U15D,
  ifnull(n_dated, 0) AS CANT_LIC_CON_RESOLUCION_U15D,
  ifnull(n_upheld, 0) AS COMPIN_RATIFICA_U15D,
  ifnull(n_refused, 0) AS COMPIN_DENIEGA_U15D,
  round(ifnull(mean_allowed, 0), {R6}) AS F_DIAS_PROMEDIO_U15D,
  ifnull(sum_days::BIGINT, 0) AS TOTAL_DIAS_SOLICITADOS_U15D,
  ifnull(max_days, 0) AS MAX_DIAS_SOLICITADOS_U15D,
  (ifnull(n, 0) > 1)::INT AS FLAG_MULTIPLES_LIC_U15D,
  round(n_upheld / nullif(n_judged, 0), {R6}) AS RATIO_APROBACION_U15D
FROM asked LEFT JOIN tally USING (p, c, d) LEFT JOIN amounts USING (p, c, d)
"""

D1_COLS = ["AFILIADO_RUT", "LCC_COMCOR", "LCC_COMCOD", "CANT_LIC_U15D",
           "CANT_LIC_CON_RESOLUCION_U15D", "COMPIN_RATIFICA_U15D", "COMPIN_DENIEGA_U15D",
           "F_DIAS_PROMEDIO_U15D", "TOTAL_DIAS_SOLICITADOS_U15D", "MAX_DIAS_SOLICITADOS_U15D",
           "FLAG_MULTIPLES_LIC_U15D", "RATIO_APROBACION_U15D"]


def _round(df, cols, n=R6):
    return df.select(*[F.round(c, n).alias(c) if c in cols else F.col(c) for c in df.columns])


@query("d1_claim_metrics_15d", ("C3", "D1", "B9"), D1_SQL)
def d1_claim_metrics_15d(spark, sf_dir):
    claims = an.claims_from_orders(spark, sf_dir)
    probes = cm.distinct_probes(claims)
    out = cm.claim_metrics_15d(probes, claims).select(*D1_COLS)
    return _round(out, {"F_DIAS_PROMEDIO_U15D", "RATIO_APROBACION_U15D"})


# ---------------------------------------------------------------- D2, D3, C6
def _services_cte() -> str:
    return an.sql_cte("services", an.SERVICES_FROM_LINEITEM, an.SERVICES_SOURCE)


# As D1: what each claim sees, then one small table for each kind of answer.
D2_SQL = f"""
WITH {_claims_cte()}, {_services_cte()},
asked AS (SELECT DISTINCT AFILIADO_RUT AS p, LCC_COMCOR AS c, LCC_COMCOD AS d, FECHA_RECEPCION AS f FROM claims),
seen AS (
  SELECT p, c, d, FOLIO AS folio, MEDTRATANTE_RUT AS doctor, PRESTACION_CANTIDAD AS amount, lower(TIPO) AS kind,
    concat_ws(' ', PATOLOGIA_GES, PATOLOGIA_CAEC) AS marks
  FROM asked, services
  WHERE COTIZANTE_RUT = p AND date_diff('day', FECHA, f) BETWEEN 1 AND 15 AND lower(TIPO) IN ('bono', 'hospitalario', 'reembolso')
),
folios AS (SELECT p, c, d, count(*) AS n FROM (SELECT DISTINCT p, c, d, folio FROM seen WHERE folio IS NOT NULL) GROUP BY ALL),
doctors AS (SELECT p, c, d, count(*) AS n FROM (SELECT DISTINCT p, c, d, doctor FROM seen WHERE doctor IS NOT NULL) GROUP BY ALL),
sums AS (
  SELECT p, c, d, sum(amount) AS amount, list(DISTINCT kind) AS kinds, string_agg(DISTINCT marks, ' ') AS marks
  FROM seen GROUP BY ALL
)
SELECT p AS AFILIADO_RUT, c AS LCC_COMCOR, d AS LCC_COMCOD,
  ifnull(folios.n, 0) AS HV_N_PRESTACIONES_U15D, ifnull(doctors.n, 0) AS HV_N_MEDICOS_U15D,
  round(ifnull(amount, 0), {R6}) AS HV_SUM_CANTIDAD_PREST_U15D,
  {', '.join(f"ifnull(list_contains(kinds, '{k}'), false)::INT AS HV_FLAG_{k.upper()}_U15D"
             for k in ('bono', 'hospitalario', 'reembolso'))},
  {', '.join(f"ifnull(contains(marks, '{k}'), false)::INT AS HV_FLAG_{k}_U15D" for k in ('CAEC', 'GES'))}
FROM asked LEFT JOIN sums USING (p, c, d) LEFT JOIN folios USING (p, c, d) LEFT JOIN doctors USING (p, c, d)
"""


@query("d2_service_metrics_15d", ("C4", "D2", "B9"), D2_SQL)
def d2_service_metrics_15d(spark, sf_dir):
    probes = cm.distinct_probes(an.claims_from_orders(spark, sf_dir))
    out = cm.service_metrics_15d(probes, an.services_from_lineitem(spark, sf_dir))
    out = out.drop("FECHA_RECEPCION")
    return _round(out, {"HV_SUM_CANTIDAD_PREST_U15D"})


def _d3_sql(claims_cte: str, exams_cte: str) -> str:
    """The exam days that each claim sees, by outcome; an answer is the number of different days."""
    return f"""
WITH {claims_cte}, {exams_cte},
asked AS (SELECT DISTINCT AFILIADO_RUT AS p, LCC_COMCOR AS c, LCC_COMCOD AS d, FECHA_RECEPCION AS f FROM claims),
seen AS (
  SELECT DISTINCT p, c, d, date_diff('day', PERITAJE_PERITAJE_FECHA_CITACION, f) AS ago,
    CASE ASISTENCIA WHEN 'NO ASISTE' THEN 'absent' WHEN 'ASISTE' THEN lower(ACUERDO_DESACUERDO) END AS outcome
  FROM asked JOIN exams ON exams.AFILIADO_RUT = p
  WHERE date_diff('day', PERITAJE_PERITAJE_FECHA_CITACION, f) BETWEEN 1 AND 15
),
sums AS (
  SELECT p, c, d, len(list(DISTINCT ago)) AS days, min(ago) AS nearest, count(*) FILTER (outcome = 'absent') AS absent,
    count(*) FILTER (outcome = 'acuerdo') AS agreed, count(*) FILTER (outcome = 'desacuerdo') AS disputed
  FROM seen GROUP BY ALL
)
SELECT p AS AFILIADO_RUT, c AS LCC_COMCOR, d AS LCC_COMCOD, ifnull(days, 0) AS PERITAJES_TOTAL_U15D,
  ifnull(absent, 0) AS PERITAJES_NO_ASISTE_U15D, ifnull(disputed, 0) AS PERITAJES_DESACUERDO_U15D,
  ifnull(agreed, 0) AS PERITAJES_ACUERDO_U15D, ifnull(nearest, 9999)::INT AS DIAS_DESDE_ULTIMO_PERITAJE_U15D,
  (days IS NOT NULL)::INT AS FLAG_PERITAJE_RECIENTE_U15D
FROM asked LEFT JOIN sums USING (p, c, d)
"""


D3_SQL = _d3_sql(an.sql_cte("claims", an.CLAIMS_FROM_EVENTS, "events"), an.sql_cte("exams", an.EXAMS_FROM_EVENTS, "events"))
D3_ORDERS_SQL = _d3_sql(_claims_cte(), an.sql_cte("exams", an.EXAMS_FROM_LINEITEM, an.SERVICES_SOURCE))


@query("d3_exam_metrics_15d", ("C5", "D3", "B9"), D3_SQL)
def d3_exam_metrics_15d(spark, sf_dir):
    probes = cm.distinct_probes(an.claims_from_events(spark, sf_dir))
    return cm.exam_metrics_15d(probes, an.exams_from_events(spark, sf_dir)).drop("FECHA_RECEPCION")


C6_SQL = f"""
SELECT *, DATE '2001-08-02' AS FECHA_CALCULO
FROM ({D1_SQL}) FULL JOIN ({D2_SQL}) USING (AFILIADO_RUT, LCC_COMCOR, LCC_COMCOD)
FULL JOIN ({D3_ORDERS_SQL}) USING (AFILIADO_RUT, LCC_COMCOR, LCC_COMCOD)
"""


@query("c6_metrics_15d_table", ("C6", "D1", "D2", "D3", "B9"), C6_SQL)
def c6_metrics_15d_table(spark, sf_dir):
    claims = an.claims_from_orders(spark, sf_dir)
    probes = cm.distinct_probes(claims)
    out = cm.metrics_15d(probes, claims, an.services_from_lineitem(spark, sf_dir),
                         an.exams_from_lineitem(spark, sf_dir), as_of="2001-08-02")
    return _round(out, {"F_DIAS_PROMEDIO_U15D", "RATIO_APROBACION_U15D", "HV_SUM_CANTIDAD_PREST_U15D"})


C6_OUTER_SQL = f"""
SELECT coalesce(a.person, b.person, c.person) AS person, coalesce(a.day, b.day, c.day) AS day, n_claims, n_services, n_exams
FROM (SELECT AFILIADO_RUT AS person, FECHA_RECEPCION AS day, count(*) AS n_claims FROM claims GROUP BY ALL) a
FULL JOIN (SELECT COTIZANTE_RUT AS person, FECHA AS day, count(*) AS n_services FROM services GROUP BY ALL) b
  ON a.person = b.person AND a.day = b.day
FULL JOIN (SELECT AFILIADO_RUT AS person, PERITAJE_PERITAJE_FECHA_CITACION AS day, count(*) AS n_exams FROM exams GROUP BY ALL) c
  ON coalesce(a.person, b.person) = c.person AND coalesce(a.day, b.day) = c.day
"""
C6_OUTER_SQL = f"""WITH {_claims_cte()}, {_services_cte()}, {an.sql_cte("exams", an.EXAMS_FROM_EVENTS, "events")}
{C6_OUTER_SQL}"""


@query("c6_full_outer_combine", "C6", C6_OUTER_SQL)
def c6_full_outer_combine(spark, sf_dir):
    """Sets with different keys: claims, services and examinations of a person's day."""
    def per_day(df, person, day, name):
        return df.groupBy(F.col(person).alias("person"), F.col(day).alias("day")).agg(F.count(F.lit(1)).alias(name))
    return cm.full_outer_combine(
        [per_day(an.claims_from_orders(spark, sf_dir), "AFILIADO_RUT", "FECHA_RECEPCION", "n_claims"),
         per_day(an.services_from_lineitem(spark, sf_dir), "COTIZANTE_RUT", "FECHA", "n_services"),
         per_day(an.exams_from_events(spark, sf_dir), "AFILIADO_RUT", "PERITAJE_PERITAJE_FECHA_CITACION", "n_exams")],
        ["person", "day"])


# ---------------------------------------------------------------- C3
C3_SQL = f"""
WITH {_claims_cte()}
SELECT b.AFILIADO_RUT, b.LCC_COMCOR, b.FECHA_RECEPCION, COUNT(h.LCC_COMCOR) AS N_PREVIAS_U15D,
       MIN(h.FECHA_RECEPCION) AS PRIMERA_PREVIA, MAX(h.FECHA_RECEPCION) AS ULTIMA_PREVIA
FROM claims b LEFT JOIN claims h
  ON b.AFILIADO_RUT = h.AFILIADO_RUT
 AND h.FECHA_RECEPCION >= b.FECHA_RECEPCION - 15 AND h.FECHA_RECEPCION < b.FECHA_RECEPCION
GROUP BY b.AFILIADO_RUT, b.LCC_COMCOR, b.FECHA_RECEPCION
"""


@query("c3_lookback_join", "C3", C3_SQL)
def c3_lookback_join(spark, sf_dir):
    """The look-back join as the reference uses it (aggregated per claim),
    through the pair-free path: no (claim, event) pairs are materialised."""
    from ..operators.lookback import lookback_aggregate
    c = an.claims_from_orders(spark, sf_dir)
    probe = c.select("AFILIADO_RUT", "LCC_COMCOR", "FECHA_RECEPCION")
    hist = c.select("AFILIADO_RUT", F.col("LCC_COMCOR").alias("H"), F.col("FECHA_RECEPCION").alias("HD"))
    aggs = [F.count("H").alias("N_PREVIAS_U15D"), F.min("HD").alias("PRIMERA_PREVIA"),
            F.max("HD").alias("ULTIMA_PREVIA")]
    out = lookback_aggregate(probe, hist, "AFILIADO_RUT", "FECHA_RECEPCION", "HD", aggs, 15)
    return out.fillna(0, subset=["N_PREVIAS_U15D"])
