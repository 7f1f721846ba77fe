"""Registered queries: audits and information value (survey L1-L10, J1-J4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit as A
from ..operators import iv as V
from ..sources import analogues as an
from .catalog_mart import _claims_cte
from .registry import query

CLAIM_COLS = ["AFILIADO_RUT", "LCC_COMCOR", "LCC_COMCOD", "FECHA_RECEPCION", "RESOLUCION_COMPIN",
              "FECHA_RESOLUCION_COMPIN", "DIASSOLICITADO", "F_DIASAUTORIZADOS"]
NUM_COLS = ["LCC_COMCOR", "LCC_COMCOD", "DIASSOLICITADO", "F_DIASAUTORIZADOS"]
SCORED = an.sql_cte("scored", an.SCORED_FROM_LINEITEM, "lineitem")


def _claims(spark, sf_dir):
    return an.claims_from_orders(spark, sf_dir)


def _l1_sql(only_missing=True) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS COLUMNA, COUNT(*) - COUNT({c}) AS N_FALTANTES, "
        f"ROUND((COUNT(*) - COUNT({c})) * 100.0 / COUNT(*), 6) AS PCT_FALTANTES FROM claims" for c in CLAIM_COLS)
    return f"WITH {_claims_cte()}, p AS ({parts}) SELECT * FROM p" + (" WHERE N_FALTANTES > 0" if only_missing else "")


@query("l1_missing_profile", "L1", _l1_sql())
def l1_missing_profile(spark, sf_dir):
    return A.missing_profile(_claims(spark, sf_dir))


@query("l4_quality_issues", ("L4", "L1"), _l1_sql() + " AND PCT_FALTANTES > 20")
def l4_quality_issues(spark, sf_dir):
    return A.quality_issues(A.missing_profile(_claims(spark, sf_dir)))


def _l2_sql() -> str:
    grp = ("CASE WHEN ANY_VALUE(typeof({c})) IN ('BIGINT', 'INTEGER', 'DOUBLE') THEN 'numeric' "
           "WHEN ANY_VALUE(typeof({c})) IN ('DATE', 'TIMESTAMP') THEN 'date' ELSE 'text' END")
    parts = " UNION ALL ".join(f"SELECT '{c}' AS COLUMNA, {grp.format(c=c)} AS TIPO_GRUPO, "
                               f"COUNT(DISTINCT {c}) AS DISTINTOS FROM claims" for c in CLAIM_COLS)
    return f"WITH {_claims_cte()} {parts}"


@query("l2_type_and_distinct_profile", "L2", _l2_sql())
def l2_type_and_distinct_profile(spark, sf_dir):
    return A.type_and_distinct_profile(_claims(spark, sf_dir)).select("COLUMNA", "TIPO_GRUPO", "DISTINTOS")


def _l3_sql() -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS COLUMNA, COUNT({c}) AS N, ROUND(AVG({c}), 6) AS MEDIA, ROUND(STDDEV_SAMP({c}), 6) AS DESV, "
        f"CAST(MIN({c}) AS DOUBLE) AS MIN, ROUND(quantile_cont({c}, 0.25), 6) AS P25, "
        f"ROUND(quantile_cont({c}, 0.5), 6) AS P50, ROUND(quantile_cont({c}, 0.75), 6) AS P75, "
        f"CAST(MAX({c}) AS DOUBLE) AS MAX FROM claims" for c in NUM_COLS)
    return f"WITH {_claims_cte()} {parts}"


@query("l3_numeric_profile", "L3", _l3_sql())
def l3_numeric_profile(spark, sf_dir):
    p = A.numeric_profile(_claims(spark, sf_dir), NUM_COLS)
    return p.select("COLUMNA", "N", *[F.round(c, 6).alias(c) for c in ("MEDIA", "DESV")], "MIN",
                    *[F.round(c, 6).alias(c) for c in ("P25", "P50", "P75")], "MAX")


def _scored(spark, sf_dir):
    return an.scored_from_lineitem(spark, sf_dir)


PERF_SQL = f"""
WITH {SCORED},
d AS (SELECT PROBABILIDAD_APROBACION AS s, TARGET_FT3 AS y FROM scored WHERE TARGET_FT3 IS NOT NULL),
g AS (SELECT s, SUM(y) AS pos, SUM(1 - y) AS neg FROM d GROUP BY s),
c AS (SELECT *, COALESCE(SUM(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g),
auc AS (SELECT SUM(pos * (below + 0.5 * neg)) / (CAST(SUM(pos) AS DOUBLE) * SUM(neg)) AS AUC FROM c),
cm AS (SELECT COUNT(CASE WHEN s > 0.5 AND y = 1 THEN 1 END) AS TP, COUNT(CASE WHEN s > 0.5 AND y = 0 THEN 1 END) AS FP,
              COUNT(CASE WHEN s <= 0.5 AND y = 1 THEN 1 END) AS FN FROM d),
m AS (SELECT ROUND(AUC, 6) AS AUC, ROUND(CASE WHEN TP + FP > 0 THEN TP / (TP + FP) ELSE 0 END, 6) AS P,
             ROUND(CASE WHEN TP + FN > 0 THEN TP / (TP + FN) ELSE 0 END, 6) AS R FROM cm, auc),
m2 AS (SELECT AUC, P, R, ROUND(CASE WHEN P + R > 0 THEN 2 * P * R / (P + R) ELSE 0 END, 6) AS F1 FROM m),
perf AS (
  SELECT 'AUC' AS METRICA, CAST(AUC AS DOUBLE) AS VALOR, CAST(0.7 AS DOUBLE) AS MINIMO FROM m2 UNION ALL
  SELECT 'PRECISION', P, 0.6 FROM m2 UNION ALL SELECT 'RECALL', R, 0.6 FROM m2 UNION ALL
  SELECT 'F1', F1, 0.6 FROM m2)
"""


@query("l5_performance_audit", ("L5", "K5"), PERF_SQL + "SELECT *, VALOR >= MINIMO AS CUMPLE FROM perf")
def l5_performance_audit(spark, sf_dir):
    return A.performance_audit(_scored(spark, sf_dir), "PROBABILIDAD_APROBACION", "TARGET_FT3")


@query("l5_per_class_report", "L5", f"""
WITH {SCORED}, d AS (SELECT TARGET_FT3 AS y, CASE WHEN PROBABILIDAD_APROBACION > 0.5 THEN 1 ELSE 0 END AS p
                     FROM scored WHERE TARGET_FT3 IS NOT NULL),
k AS (SELECT c AS CLASE, COUNT(CASE WHEN p = c AND y = c THEN 1 END) AS tp, COUNT(CASE WHEN p = c THEN 1 END) AS pp,
             COUNT(CASE WHEN y = c THEN 1 END) AS ap FROM d, (VALUES (0), (1)) v(c) GROUP BY c),
r AS (SELECT CLASE, CASE WHEN pp > 0 THEN tp / pp ELSE 0 END AS P, CASE WHEN ap > 0 THEN tp / ap ELSE 0 END AS R, ap FROM k)
SELECT CLASE, ROUND(P, 6) AS PRECISION, ROUND(R, 6) AS RECALL,
       ROUND(CASE WHEN P + R > 0 THEN 2 * P * R / (P + R) ELSE 0 END, 6) AS F1, ap AS SOPORTE FROM r""")
def l5_per_class_report(spark, sf_dir):
    s = _scored(spark, sf_dir).withColumn("PRED", (F.col("PROBABILIDAD_APROBACION") > 0.5).cast("int"))
    return A.per_class_report(s, "TARGET_FT3", "PRED")


@query("l10_recalibration_gate", ("L10", "K5"), PERF_SQL + """
SELECT AUC, P AS PRECISION, AUC < 0.7 OR P < 0.6 AS RECALIBRAR FROM m2""")
def l10_recalibration_gate(spark, sf_dir):
    from ..operators.classification import classification_metrics
    return A.recalibration_gate(classification_metrics(_scored(spark, sf_dir), "PROBABILIDAD_APROBACION", "TARGET_FT3"))


FAIR_SQL = f"""
WITH {SCORED},
fd AS (SELECT c.c_mktsegment AS seg, s.TARGET_FT3 AS y, CASE WHEN s.PROBABILIDAD_APROBACION > 0.5 THEN 1 ELSE 0 END AS p
      FROM scored s JOIN orders o ON s.LCC_COMCOR = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
      WHERE s.TARGET_FT3 IS NOT NULL),
fg AS (SELECT seg, COUNT(*) AS N, AVG(p) AS pr, AVG(y) AS ar, COUNT(CASE WHEN p = 1 AND y = 1 THEN 1 END) AS tp,
             COUNT(CASE WHEN p = 1 THEN 1 END) AS pp, COUNT(CASE WHEN y = 1 THEN 1 END) AS ap FROM fd GROUP BY seg),
fr AS (SELECT MAX(pr) AS mx, MIN(pr) AS mn, COUNT(*) AS k FROM fg),
fair AS (SELECT seg AS GRUPO, N, ROUND(pr, 6) AS TASA_POSITIVOS_PRED, ROUND(ar, 6) AS TASA_POSITIVOS_REAL,
       ROUND(CASE WHEN pp > 0 THEN tp / pp ELSE 0 END, 6) AS PRECISION,
       ROUND(CASE WHEN ap > 0 THEN tp / ap ELSE 0 END, 6) AS RECALL,
       ROUND(CASE WHEN k > 1 THEN mx / (mn + 1e-10) END, 6) AS DISPARIDAD,
       COALESCE(CASE WHEN k > 1 THEN mx / (mn + 1e-10) END > 1.2, FALSE) AS VIOLACION
FROM fg, fr)
"""


def _fair_input(spark, sf_dir):
    s = _scored(spark, sf_dir).where(F.col("TARGET_FT3").isNotNull())
    o = an.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("LCC_COMCOR"), "o_custkey")
    c = an.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return s.join(o, "LCC_COMCOR").join(c, "o_custkey") \
            .withColumn("PRED", (F.col("PROBABILIDAD_APROBACION") > 0.5).cast("int"))


@query("l6_fairness_audit", "L6", FAIR_SQL + "SELECT * FROM fair")
def l6_fairness_audit(spark, sf_dir):
    return A.fairness_audit(_fair_input(spark, sf_dir), "c_mktsegment", "TARGET_FT3", "PRED")


DRIFT_COLS = ["l_quantity", "l_extendedprice", "l_discount"]
DRIFT_SQL = f"""
WITH long AS (
  SELECT CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS s, f.feature, f.value
  FROM lineitem, LATERAL (VALUES {', '.join(f"('{c}', CAST({c} AS DOUBLE))" for c in DRIFT_COLS)}) f(feature, value)),
vc AS (SELECT feature, value, SUM(s) AS c1, SUM(1 - s) AS c2 FROM long GROUP BY 1, 2),
cum AS (SELECT feature, SUM(c1) OVER w AS k1, SUM(c2) OVER w AS k2, SUM(c1) OVER (PARTITION BY feature) AS n1,
               SUM(c2) OVER (PARTITION BY feature) AS n2
        FROM vc WINDOW w AS (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ks AS (SELECT feature, MAX(ABS(k1 / n1 - k2 / n2)) AS d, ANY_VALUE(n1) AS n1, ANY_VALUE(n2) AS n2 FROM cum GROUP BY feature),
z AS (SELECT *, d * SQRT(n1 * n2 / CAST(n1 + n2 AS DOUBLE)) AS z FROM ks),
p AS (SELECT feature, d, CASE WHEN z < 0.27 THEN 1.0 ELSE LEAST(GREATEST(
        (SELECT SUM(2 * POWER(-1.0, k - 1) * EXP(-2 * k * k * z * z)) FROM range(1, 101) t(k)), 0.0), 1.0) END AS pv FROM z),
drift AS (SELECT feature AS FEATURE, ROUND(d, 6) AS ESTADISTICO, ROUND(pv, 6) AS P_VALOR, COALESCE(pv < 0.05, FALSE) AS DRIFT FROM p)
"""


def _drift(spark, sf_dir):
    li = an.table(spark, sf_dir, "lineitem")
    return A.drift_ks(li.where(F.col("l_linestatus") == "O"), li.where(F.col("l_linestatus") != "O"), DRIFT_COLS)


@query("l7_drift_ks", "L7", DRIFT_SQL + "SELECT * FROM drift")
def l7_drift_ks(spark, sf_dir):
    return _drift(spark, sf_dir)


DSUM_SQL = """dsum AS (SELECT COUNT(*) AS REVISADAS, COUNT(CASE WHEN DRIFT THEN 1 END) AS CON_DRIFT,
  ROUND(CASE WHEN COUNT(*) > 0 THEN COUNT(CASE WHEN DRIFT THEN 1 END) * 100.0 / COUNT(*) ELSE 0 END, 6) AS PCT_DRIFT
  FROM drift)"""


@query("l8_drift_summary", ("L8", "L7"), DRIFT_SQL + ", " + DSUM_SQL + " SELECT * FROM dsum")
def l8_drift_summary(spark, sf_dir):
    return A.drift_summary(_drift(spark, sf_dir))


def _l9_sql() -> str:
    issues = _l1_sql().replace(f"WITH {_claims_cte()}, p AS (", "").rsplit(") SELECT * FROM p", 1)[0]
    perf = PERF_SQL.replace("WITH ", "", 1)
    fair = FAIR_SQL.replace(f"WITH {SCORED},", "", 1)
    drift = DRIFT_SQL.replace("WITH ", "", 1)
    return f"""
WITH {_claims_cte()}, iss AS (SELECT * FROM ({issues}) WHERE N_FALTANTES > 0 AND PCT_FALTANTES > 20),
{perf.rstrip()}, {fair.strip()}, {drift.strip()}, {DSUM_SQL}
SELECT 'CALIDAD_DATOS' AS CHEQUEO, CASE WHEN COUNT(*) > 0 THEN 'ADVERTENCIA' ELSE 'APROBADO' END AS ESTADO,
       CAST(COUNT(*) AS DOUBLE) AS DETALLE FROM iss
UNION ALL SELECT 'DESEMPENO_MODELO', CASE WHEN COUNT(CASE WHEN NOT (VALOR >= MINIMO) THEN 1 END) > 0 THEN 'FALLIDO'
       ELSE 'APROBADO' END, CAST(COUNT(CASE WHEN NOT (VALOR >= MINIMO) THEN 1 END) AS DOUBLE) FROM perf
UNION ALL SELECT 'EQUIDAD', CASE WHEN MAX(CAST(VIOLACION AS INTEGER)) > 0 THEN 'FALLIDO' ELSE 'APROBADO' END,
       CAST(COALESCE(MAX(CAST(VIOLACION AS INTEGER)), 0) AS DOUBLE) FROM fair
UNION ALL SELECT 'DRIFT_DATOS', CASE WHEN PCT_DRIFT > 20 THEN 'ADVERTENCIA' ELSE 'APROBADO' END,
       CAST(PCT_DRIFT AS DOUBLE) FROM dsum
"""


@query("l9_audit_summary", ("L9", "L1", "L4", "L5", "L6", "L7", "L8"), _l9_sql())
def l9_audit_summary(spark, sf_dir):
    issues = A.quality_issues(A.missing_profile(_claims(spark, sf_dir)))
    perf = A.performance_audit(_scored(spark, sf_dir), "PROBABILIDAD_APROBACION", "TARGET_FT3")
    fair = A.fairness_audit(_fair_input(spark, sf_dir), "c_mktsegment", "TARGET_FT3", "PRED")
    return A.audit_summary(issues, perf, fair, A.drift_summary(_drift(spark, sf_dir)))


# ---------------------------------------------------------------- J1-J4
DOCS_SQL = """docs AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, CAST(l.toxic AS BIGINT) AS toxic, l.quality
                FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""
CAT, NUMF = ["lang", "source"], ["n_chars", "toxic"]


def _docs(spark, sf_dir):
    d = an.table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = an.table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").cast("long").alias("toxic"), "quality")
    return d.join(lab, "doc_id")


WOE_COLS = """feature, bin, n0, n1, total, ROUND(bad_rate, 6) AS bad_rate, ROUND(good_dist, 6) AS good_dist,
  ROUND(bad_dist, 6) AS bad_dist, ROUND(woe, 6) AS woe, ROUND(iv_contribution, 6) AS iv_contribution"""


def _woe_calc(counts_cte: str) -> str:
    return f"""tot AS (SELECT COUNT(CASE WHEN quality = 1 THEN 1 END) AS g, COUNT(CASE WHEN quality = 0 THEN 1 END) AS b FROM docs),
{counts_cte},
sh AS (SELECT feature, bin, n0, n1, n0 + n1 AS total, n0 / (n0 + n1) AS bad_rate,
         CASE WHEN n1 / g = 0 THEN 0.0001 ELSE n1 / g END AS good_dist,
         CASE WHEN n0 / b = 0 THEN 0.0001 ELSE n0 / b END AS bad_dist FROM cnt, tot),
w AS (SELECT *, LN(good_dist / bad_dist) AS woe, (good_dist - bad_dist) * LN(good_dist / bad_dist) AS iv_contribution FROM sh)"""


def _j1_sql() -> str:
    cnt = "cnt AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS bin, COUNT(CASE WHEN quality = 0 THEN 1 END) AS n0, "
        f"COUNT(CASE WHEN quality = 1 THEN 1 END) AS n1 FROM docs WHERE {c} IS NOT NULL GROUP BY {c}" for c in CAT) + ")"
    return f"WITH {DOCS_SQL}, {_woe_calc(cnt)}"


def _j2_sql() -> str:
    probs = ", ".join(str(i / 10) for i in range(11))
    edges = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, list_sort(list_distinct(quantile_cont(CAST({c} AS DOUBLE), [{probs}]))) AS edges "
        f"FROM docs" for c in NUMF)
    long = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, quality FROM docs "
                              f"WHERE {c} IS NOT NULL" for c in NUMF)
    cnt = f"""e AS ({edges}), lg AS ({long}),
b AS (SELECT lg.feature, lg.quality, 1 + len(list_filter(list_slice(e.edges, 2, len(e.edges) - 1), lambda x: x < lg.value)) AS bin
      FROM lg JOIN e ON lg.feature = e.feature),
cnt AS (SELECT feature, CAST(bin AS VARCHAR) AS bin, COUNT(CASE WHEN quality = 0 THEN 1 END) AS n0,
        COUNT(CASE WHEN quality = 1 THEN 1 END) AS n1 FROM b GROUP BY 1, 2)"""
    return f"WITH {DOCS_SQL}, {_woe_calc(cnt)}"


def _round_woe(df):
    return df.select("feature", "bin", "n0", "n1", "total",
                     *[F.round(c, 6).alias(c) for c in ("bad_rate", "good_dist", "bad_dist", "woe", "iv_contribution")])


@query("j1_woe_categorical", "J1", _j1_sql() + f" SELECT {WOE_COLS} FROM w")
def j1_woe_categorical(spark, sf_dir):
    return _round_woe(V.woe_categorical(_docs(spark, sf_dir), CAT, "quality"))


@query("j2_woe_numeric", "J2", _j2_sql() + f" SELECT {WOE_COLS} FROM w")
def j2_woe_numeric(spark, sf_dir):
    return _round_woe(V.woe_numeric(_docs(spark, sf_dir), NUMF, "quality"))


def _all_woe(spark, sf_dir):
    d = _docs(spark, sf_dir)
    return V.woe_categorical(d, CAT, "quality").unionByName(V.woe_numeric(d, NUMF, "quality"))


def _woe_union_sql() -> str:
    j1 = _j1_sql().replace("WITH ", "", 1).replace(DOCS_SQL + ", ", "", 1)
    j2 = _j2_sql().replace("WITH ", "", 1).replace(DOCS_SQL + ", ", "", 1)
    j1 = j1.replace("tot AS", "tot1 AS").replace("FROM cnt, tot)", "FROM cnt1, tot1)").replace("cnt AS (", "cnt1 AS (") \
           .replace("sh AS", "sh1 AS").replace("w AS (SELECT *, LN", "w1 AS (SELECT *, LN").replace("FROM sh)", "FROM sh1)")
    return f"WITH {DOCS_SQL}, {j1}, {j2}, allw AS (SELECT * FROM w1 UNION ALL SELECT * FROM w)"


POWER_SQL = ("CASE WHEN iv < 0.02 THEN 'Not useful' WHEN iv < 0.1 THEN 'Weak' WHEN iv < 0.3 THEN 'Medium' "
             "WHEN iv < 0.5 THEN 'Strong' ELSE 'Very strong' END")


@query("j3_iv_table", ("J3", "J1", "J2"), _woe_union_sql() + f"""
, iv AS (SELECT feature, SUM(iv_contribution) AS iv FROM allw GROUP BY feature)
SELECT feature, ROUND(iv, 6) AS iv, {POWER_SQL} AS predictive_power FROM iv ORDER BY iv DESC""")
def j3_iv_table(spark, sf_dir):
    t = V.iv_table(_all_woe(spark, sf_dir))
    return t.select("feature", F.round("iv", 6).alias("iv"), "predictive_power")


@query("j4_iv_feature_summary", ("J4",), _woe_union_sql() + f"""
, s AS (SELECT feature, COUNT(*) AS n_categories, SUM(iv_contribution) AS iv, MAX(woe) - MIN(woe) AS woe_range,
               MAX(bad_rate) AS max_bad_rate, MIN(bad_rate) AS min_bad_rate FROM allw GROUP BY feature)
SELECT feature, n_categories, ROUND(iv, 6) AS iv, ROUND(woe_range, 6) AS woe_range, ROUND(max_bad_rate, 6) AS max_bad_rate,
       ROUND(min_bad_rate, 6) AS min_bad_rate, {POWER_SQL} AS predictive_power FROM s""")
def j4_iv_feature_summary(spark, sf_dir):
    s = V.iv_feature_summary(_all_woe(spark, sf_dir))
    return s.select("feature", "n_categories", *[F.round(c, 6).alias(c) for c in
                                                 ("iv", "woe_range", "max_bad_rate", "min_bad_rate")],
                    "predictive_power")


@query("j4_iv_power_counts", ("J4", "J3"), _woe_union_sql() + f"""
, iv AS (SELECT feature, SUM(iv_contribution) AS iv FROM allw GROUP BY feature)
SELECT {POWER_SQL} AS predictive_power, COUNT(*) AS n_features FROM iv GROUP BY 1""")
def j4_iv_power_counts(spark, sf_dir):
    return V.iv_power_counts(V.iv_table(_all_woe(spark, sf_dir)))
