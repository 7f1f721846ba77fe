"""Model and data audits (survey L1-L10).

Wide profiles are computed in one pass over an unpivoted (``stack``) form,
so the number of columns does not multiply the number of jobs; order
statistics use the distributed exact quantiles of ``operators.stats``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from .classification import classification_metrics
from .stats import exact_quantiles, ks_pvalue, ks_statistic, unpivot

# Audit thresholds.
PERFORMANCE_MIN = {"AUC": 0.70, "PRECISION": 0.60, "RECALL": 0.60, "F1": 0.60}
MISSING_ISSUE_PCT = 20.0
DISPARITY_LIMIT = 1.2
DRIFT_P = 0.05
DRIFT_WARN_PCT = 20.0


def _missing(c: str, t: str):
    col = F.col(f"`{c}`")
    m = col.isNull()
    if t in ("double", "float"):
        m = m | F.isnan(col)
    return m


def missing_profile(df: DataFrame, cols: Sequence[str] | None = None, only_missing: bool = True) -> DataFrame:
    """L1: missing count and % per column (columns with any missing by default)."""
    types = dict(df.dtypes)
    cols = list(cols or df.columns)
    a = df.agg(F.count(F.lit(1)).alias("__n"),
               *[F.sum(_missing(c, types[c]).cast("long")).alias(f"m{i}") for i, c in enumerate(cols)])
    items = ", ".join(f"'{c}', m{i}" for i, c in enumerate(cols))
    out = a.selectExpr("__n", f"stack({len(cols)}, {items}) AS (COLUMNA, N_FALTANTES)")
    out = out.select("COLUMNA", F.coalesce("N_FALTANTES", F.lit(0)).alias("N_FALTANTES"),
                     F.round(F.when(F.col("__n") > 0, F.col("N_FALTANTES") * 100.0 / F.col("__n")), 6)
                      .alias("PCT_FALTANTES"))
    return out.where(F.col("N_FALTANTES") > 0) if only_missing else out


def quality_issues(profile: DataFrame, limit_pct: float = MISSING_ISSUE_PCT) -> DataFrame:
    """L4: columns whose missing % is above the limit."""
    return profile.where(F.col("PCT_FALTANTES") > limit_pct)


def type_group(t: str) -> str:
    if t in ("tinyint", "smallint", "int", "bigint", "float", "double") or t.startswith("decimal"):
        return "numeric"
    if t in ("date", "timestamp", "timestamp_ntz"):
        return "date"
    if t == "boolean":
        return "boolean"
    return "text"


def type_and_distinct_profile(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False,
                              rsd: float = 0.01) -> DataFrame:
    """L2: type and number of distinct non-missing values per column.

    Exact mode unpivots to (column, value) and de-duplicates with a partial
    aggregate before counting, instead of one count-distinct per column
    (which Spark would expand into one copy of the data per column)."""
    cols = list(cols or df.columns)
    types = dict(df.dtypes)
    tdf = df.sparkSession.createDataFrame([(c, types[c], type_group(types[c])) for c in cols],
                                          "COLUMNA string, TIPO string, TIPO_GRUPO string")
    # NaN in floating columns is missing, as in pandas, and -0.0 equals 0.0; text stays as it is
    floating = [c for c in cols if types[c] in ("double", "float")]
    clean = df.select(*[F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`") + F.lit(0.0)).alias(c) if c in floating
                        else F.col(f"`{c}`") for c in cols])
    long = unpivot(clean, cols, name="COLUMNA", value="v", cast="string").where(F.col("v").isNotNull())
    if approx:
        d = long.groupBy("COLUMNA").agg(F.approx_count_distinct("v", rsd).alias("DISTINTOS"))
    else:
        d = long.distinct().groupBy("COLUMNA").agg(F.count(F.lit(1)).alias("DISTINTOS"))
    return tdf.join(d, "COLUMNA", "left").fillna(0, subset=["DISTINTOS"])


def numeric_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """L3: count, mean, sample sd, min, 25/50/75 % (exact, interpolated), max."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    long = unpivot(df, cols, name="COLUMNA", value="v").where(F.col("v").isNotNull() & ~F.isnan("v"))
    basic = long.groupBy("COLUMNA").agg(F.count("v").alias("N"), F.avg("v").alias("MEDIA"),
                                        F.stddev_samp("v").alias("DESV"), F.min("v").alias("MIN"),
                                        F.max("v").alias("MAX"))
    q = exact_quantiles(long, ["COLUMNA"], "v", [0.25, 0.5, 0.75]).select(
        "COLUMNA", F.col("q0").alias("P25"), F.col("q1").alias("P50"), F.col("q2").alias("P75"))
    return basic.join(q, "COLUMNA", "left")


def per_class_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """L5 detail: precision / recall / F1 / support for each class."""
    y, p = F.col(label), F.col(pred)
    d = df.where(y.isNotNull())
    rows = []
    for cls in (0, 1):
        tp = F.sum(((p == cls) & (y == cls)).cast("long"))
        pp = F.sum((p == cls).cast("long"))
        ap = F.sum((y == cls).cast("long"))
        prec = F.when(pp > 0, tp / pp).otherwise(0.0)
        rec = F.when(ap > 0, tp / ap).otherwise(0.0)
        f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0)
        rows.append(d.agg(F.lit(cls).alias("CLASE"), F.round(prec, 6).alias("PRECISION"),
                          F.round(rec, 6).alias("RECALL"), F.round(f1, 6).alias("F1"),
                          F.coalesce(ap, F.lit(0)).alias("SOPORTE")))
    return rows[0].unionByName(rows[1])


def performance_audit(df: DataFrame, score: str, label: str, threshold: float = 0.5,
                      minimums: dict | None = None) -> DataFrame:
    """Metric rows with their minimum and a pass flag."""
    mins = minimums or PERFORMANCE_MIN
    m = classification_metrics(df, score, label, threshold)
    items = ", ".join(f"'{k}', CAST({k} AS DOUBLE), CAST({v} AS DOUBLE)" for k, v in mins.items())
    out = m.selectExpr(f"stack({len(mins)}, {items}) AS (METRICA, VALOR, MINIMO)")
    return out.withColumn("CUMPLE", F.col("VALOR") >= F.col("MINIMO"))


def recalibration_gate(metrics: DataFrame, auc_min: float = 0.7, precision_min: float = 0.6) -> DataFrame:
    """Recalibrate when AUC < ``auc_min`` or precision < ``precision_min``."""
    return metrics.select("AUC", "PRECISION",
                          ((F.col("AUC") < auc_min) | (F.col("PRECISION") < precision_min)).alias("RECALIBRAR"))


def fairness_audit(df: DataFrame, attr: str, label: str, pred: str, limit: float = DISPARITY_LIMIT) -> DataFrame:
    """Per group count, predicted positive rate, actual positive rate,
    precision and recall (0 when undefined); disparity max/min(+1e-10) of the
    predicted rates over the groups and its flag.  NULL groups are skipped."""
    y, p = F.col(label), F.col(pred)
    g = df.where(F.col(attr).isNotNull()).groupBy(attr).agg(
        F.count(F.lit(1)).alias("N"),
        F.avg(p.cast("double")).alias("TASA_POSITIVOS_PRED"),
        F.avg(y.cast("double")).alias("TASA_POSITIVOS_REAL"),
        F.sum(((p == 1) & (y == 1)).cast("long")).alias("__tp"),
        F.sum((p == 1).cast("long")).alias("__pp"),
        F.sum((y == 1).cast("long")).alias("__ap"))
    rates = g.agg(F.struct(F.max("TASA_POSITIVOS_PRED").alias("mx"), F.min("TASA_POSITIVOS_PRED").alias("mn"),
                           F.count(F.lit(1)).alias("k")).alias("r")).scalar()
    disp = F.when(rates.getField("k") > 1, rates.getField("mx") / (rates.getField("mn") + F.lit(1e-10)))
    return g.select(
        F.col(attr).alias("GRUPO"), "N",
        F.round("TASA_POSITIVOS_PRED", 6).alias("TASA_POSITIVOS_PRED"),
        F.round("TASA_POSITIVOS_REAL", 6).alias("TASA_POSITIVOS_REAL"),
        F.round(F.when(F.col("__pp") > 0, F.col("__tp") / F.col("__pp")).otherwise(0.0), 6).alias("PRECISION"),
        F.round(F.when(F.col("__ap") > 0, F.col("__tp") / F.col("__ap")).otherwise(0.0), 6).alias("RECALL"),
        F.round(disp, 6).alias("DISPARIDAD"),
        F.coalesce(disp > limit, F.lit(False)).alias("VIOLACION"))


def drift_ks(train: DataFrame, test: DataFrame, cols: Sequence[str], p_limit: float = DRIFT_P,
             nan_policy: str = "propagate") -> DataFrame:
    """Two-sample KS per numeric feature: statistic, p (exact up to
    ``stats.KS_EXACT_N`` values a sample, asymptotic beyond), flag.

    ``nan_policy="propagate"`` gives NULL statistic/p for a feature with any
    missing value (never flagged); ``"omit"`` drops missing values."""
    a = unpivot(train, cols).withColumn("s", F.lit(1))
    b = unpivot(test, cols).withColumn("s", F.lit(0))
    long = a.unionByName(b)
    miss = long.groupBy("feature").agg(F.sum((F.col("value").isNull() | F.isnan("value")).cast("int"))
                                       .alias("__miss"))
    clean = long.where(F.col("value").isNotNull() & ~F.isnan("value"))
    ks = ks_statistic(clean, ["feature"], "value", "s")
    out = miss.join(ks, "feature", "left")
    bad = (F.col("__miss") > 0) if nan_policy == "propagate" else F.lit(False)
    d = F.when(bad, None).otherwise(F.col("statistic"))
    pv = F.when(bad, None).otherwise(ks_pvalue(F.col("statistic"), F.col("n1"), F.col("n2")))
    return out.select(F.col("feature").alias("FEATURE"), F.round(d, 6).alias("ESTADISTICO"),
                      F.round(pv, 6).alias("P_VALOR"),
                      F.coalesce(pv < p_limit, F.lit(False)).alias("DRIFT"))


def drift_summary(drift: DataFrame) -> DataFrame:
    """Features checked, with drift, and %."""
    a = drift.agg(F.count(F.lit(1)).alias("REVISADAS"), F.sum(F.col("DRIFT").cast("int")).alias("CON_DRIFT"))
    return a.select("REVISADAS", F.coalesce("CON_DRIFT", F.lit(0)).alias("CON_DRIFT"),
                    F.round(F.when(F.col("REVISADAS") > 0, F.coalesce("CON_DRIFT", F.lit(0)) * 100.0
                                   / F.col("REVISADAS")).otherwise(0.0), 6).alias("PCT_DRIFT"))


def audit_summary(issues: DataFrame | None = None, performance: DataFrame | None = None,
                  fairness: DataFrame | None = None, drift_sum: DataFrame | None = None) -> DataFrame:
    """One row per check: passed / failed / warning with a detail count."""
    parts = []
    if issues is not None:
        n = issues.agg(F.count(F.lit(1)).alias("n"))
        parts.append(n.select(F.lit("CALIDAD_DATOS").alias("CHEQUEO"),
                              F.when(F.col("n") > 0, "ADVERTENCIA").otherwise("APROBADO").alias("ESTADO"),
                              F.col("n").cast("double").alias("DETALLE")))
    if performance is not None:
        n = performance.agg(F.sum((~F.col("CUMPLE")).cast("int")).alias("n"))
        parts.append(n.select(F.lit("DESEMPENO_MODELO").alias("CHEQUEO"),
                              F.when(F.col("n") > 0, "FALLIDO").otherwise("APROBADO").alias("ESTADO"),
                              F.coalesce(F.col("n"), F.lit(0)).cast("double").alias("DETALLE")))
    if fairness is not None:
        n = fairness.agg(F.max(F.col("VIOLACION").cast("int")).alias("n"))
        parts.append(n.select(F.lit("EQUIDAD").alias("CHEQUEO"),
                              F.when(F.col("n") > 0, "FALLIDO").otherwise("APROBADO").alias("ESTADO"),
                              F.coalesce(F.col("n"), F.lit(0)).cast("double").alias("DETALLE")))
    if drift_sum is not None:
        parts.append(drift_sum.select(F.lit("DRIFT_DATOS").alias("CHEQUEO"),
                                      F.when(F.col("PCT_DRIFT") > DRIFT_WARN_PCT, "ADVERTENCIA")
                                       .otherwise("APROBADO").alias("ESTADO"),
                                      F.col("PCT_DRIFT").cast("double").alias("DETALLE")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
