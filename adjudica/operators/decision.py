"""Cost-based thresholds, decision classes and decision reports
(survey M1-M8, D7-D10, F2-F4).

Threshold search (M2-M4, M7) never rescans the rows per candidate.  The cost
of a (green g, yellow y) pair separates into

    A(g) = FPcost(p >= g) + review * n(p < g)
    B(y) = fn_cost * n1(p < y) - review * n(p < y)

so one pass bins the scores by thousandths (exact: the bin of p is the
largest i with i/1000 <= p), a grouped aggregate reduces the rows to at most
``scale + 3`` bins, and prefix sums over the bins plus the grid points (a
table of a few thousand rows, independent of the data size) give A and B
for every grid point.  The best pair is the first strict minimum in the
reference's loop order (g ascending, then y ascending).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Cost model and default grids (thousandths).
COST_PER_DAY = 59000
COST_FN = 20000
FIXED_DAILY = (940, 160)
FIXED_PERIOD = (940, 200)
GRID_DAILY = ((500, 998), (100, 400))
GRID_PERIOD = ((500, 969), (100, 799))

# Light names and decision texts.
FT1, GREEN, YELLOW, RED = "FT1_APROBADO", "VERDE", "AMARILLO", "ROJO"
LIGHTS = (FT1, GREEN, YELLOW, RED)
DECISION_TEXT = {
    GREEN: "Licencia aprobada automáticamente por modelo predictivo",
    YELLOW: "Licencia requiere revisión manual",
    RED: "Licencia rechazada automáticamente por modelo predictivo",
}


# ------------------------------------------------------------------ M1
def net_false_positive_cost(days: Column, reversal_rate, review_cost,
                            cost_per_day: float = COST_PER_DAY) -> Column:
    """M1: max(days * cost * (1 - r) - review, 0); with r = 0 plain days * cost."""
    r = reversal_rate if isinstance(reversal_rate, Column) else F.lit(float(reversal_rate))
    gross = days.cast("double") * cost_per_day
    net = F.greatest(gross * (F.lit(1.0) - r) - F.lit(float(review_cost)), F.lit(0.0))
    return F.when(r > 0, net).otherwise(gross)


# ------------------------------------------------------------------ binning
def score_bin(score: Column, scale: int = 1000) -> Column:
    """Largest integer i with i/scale <= score, clipped to [-1, scale + 1]."""
    k = F.floor(score * scale)
    k = F.when(k / F.lit(float(scale)) > score, k - 1) \
         .when((k + 1) / F.lit(float(scale)) <= score, k + 1).otherwise(k)
    return F.least(F.greatest(k, F.lit(-1)), F.lit(scale + 1)).cast("long")


def _bins(df: DataFrame, score: str, label: str, days: str, rate, review, rates=None,
          scale: int = 1000) -> DataFrame:
    """Per (rate, bin): n, n1 (label 1), n0 (label 0), FP cost of label-0 rows."""
    s = F.col(score)
    base = df.where(s.isNotNull() & ~F.isnan(s)).select(
        score_bin(s, scale).alias("k"), F.col(label).alias("y"), F.col(days).alias("d"))
    # pre-aggregate per (bin, label, days) so the rate fan-out touches few rows
    pre = base.groupBy("k", "y", "d").agg(F.count(F.lit(1)).alias("c"))
    if rates is None:
        pre = pre.withColumn("rate", F.lit(float(rate)))
    else:
        pre = pre.withColumn("rate", F.explode(F.array(*[F.lit(float(r)) for r in rates])))
    fp_row = net_false_positive_cost(F.col("d"), F.col("rate"), review)
    return pre.groupBy("rate", "k").agg(
        F.sum("c").alias("n"),
        F.sum(F.when(F.col("y") == 1, F.col("c")).otherwise(0)).alias("n1"),
        F.sum(F.when(F.col("y") == 0, F.col("c")).otherwise(0)).alias("n0"),
        F.sum(F.when(F.col("y") == 0, F.col("c") * fp_row).otherwise(0.0)).alias("fpc"),
    )


def _grid_points(spark, ranges: Sequence[tuple[int, int]], extra: Sequence[int] = ()) -> DataFrame:
    g = None
    for lo, hi in ranges:
        r = spark.range(lo, hi + 1).select(F.col("id").alias("k"))
        g = r if g is None else g.unionByName(r)
    for e in extra:
        g = g.unionByName(spark.range(1).select(F.lit(e).cast("long").alias("k")))
    return g.distinct()


def threshold_axis(df: DataFrame, score: str, label: str, days: str, ranges, rate=0.0,
                   review=5000, rates=None, extra_points: Sequence[int] = (),
                   scale: int = 1000) -> DataFrame:
    """Per (rate, grid point k): counts and costs of rows below / at-or-above k/scale."""
    bins = _bins(df, score, label, days, rate, review, rates, scale)
    pts = _grid_points(df.sparkSession, ranges, extra_points) \
        .withColumn("rate", F.explode(F.array(*[F.lit(float(r)) for r in (rates or [rate])])))
    zero = F.lit(0).cast("long")
    rows = bins.withColumn("g", F.lit(0)).unionByName(
        pts.select("rate", "k", zero.alias("n"), zero.alias("n1"), zero.alias("n0"),
                   F.lit(0.0).alias("fpc"), F.lit(1).alias("g")))
    # grid rows sort before bins of the same k: prefix sums cover bins with k < point
    w = Window.partitionBy("rate").orderBy("k", F.col("g").desc()) \
              .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wt = Window.partitionBy("rate")
    out = rows
    for c in ("n", "n1", "n0", "fpc"):
        out = out.withColumn("lt_" + c, F.sum(c).over(w)).withColumn("tot_" + c, F.sum(c).over(wt))
    out = out.where(F.col("g") == 1)
    return out.select(
        "rate", "k",
        F.col("lt_n").alias("n_lt"), F.col("lt_n1").alias("n1_lt"),
        (F.col("tot_n") - F.col("lt_n")).alias("n_ge"),
        (F.col("tot_n0") - F.col("lt_n0")).alias("fp_ge"),
        (F.col("tot_fpc") - F.col("lt_fpc")).alias("fpc_ge"),
    )


def _pair_cost(axis: DataFrame, green: tuple[int, int], yellow: tuple[int, int], review, fn_cost):
    """Best (g, y) per rate, first strict minimum in (g, y) order."""
    a = axis.where(F.col("k").between(*green)).select(
        "rate", F.col("k").alias("gk"), F.col("n_ge").alias("verde"), F.col("n_lt").alias("lt_g"),
        F.col("fp_ge").alias("fp"), F.col("fpc_ge").alias("fpc"),
        (F.col("fpc_ge") + F.lit(float(review)) * F.col("n_lt")).alias("A"))
    b = axis.where(F.col("k").between(*yellow)).select(
        "rate", F.col("k").alias("yk"), F.col("n_lt").alias("lt_y"), F.col("n1_lt").alias("fn"),
        (F.lit(float(fn_cost)) * F.col("n1_lt") - F.lit(float(review)) * F.col("n_lt")).alias("B"))
    # one ordered pass: for each g the smallest (B, y) among y < g
    u = a.select("rate", F.col("gk").alias("k"), F.lit(0).alias("is_y"), "A", "verde", "lt_g", "fp", "fpc",
                 F.lit(None).cast("struct<B:double,yk:long,lt_y:long,fn:long>").alias("bs")) \
         .unionByName(b.select("rate", F.col("yk").alias("k"), F.lit(1).alias("is_y"),
                               F.lit(None).cast("double").alias("A"), F.lit(None).cast("long").alias("verde"),
                               F.lit(None).cast("long").alias("lt_g"), F.lit(None).cast("long").alias("fp"),
                               F.lit(None).cast("double").alias("fpc"),
                               F.struct(F.round("B", 6).alias("B"), "yk", "lt_y", "fn").alias("bs")))
    w = Window.partitionBy("rate").orderBy("k", "is_y").rowsBetween(Window.unboundedPreceding, -1)
    best_b = u.withColumn("bb", F.min("bs").over(w)).where((F.col("is_y") == 0) & F.col("bb").isNotNull())
    pairs = best_b.select("rate", F.col("k").alias("gk"), F.col("bb.yk").alias("yk"), "verde", "lt_g", "fp", "fpc",
                          F.col("bb.lt_y").alias("lt_y"), F.col("bb.fn").alias("fn"),
                          F.round(F.col("A") + F.col("bb.B"), 6).alias("cost"))
    best = pairs.groupBy("rate").agg(F.min(F.struct("cost", "gk", "yk", "verde", "lt_g", "lt_y", "fp",
                                                     "fpc", "fn")).alias("m"))
    return best.select("rate", "m.*")


def optimise_two_thresholds(df: DataFrame, score: str = "PROBABILIDAD_APROBACION", label: str = "TARGET_FT3",
                            days: str = "DIASSOLICITADO", review=5000, reversal_rate=0.0,
                            fn_cost=COST_FN, grid=GRID_DAILY, population: Column | None = None,
                            scale: int = 1000) -> DataFrame:
    """M2: one row with the optimal thresholds and the cost breakdown.

    ``population`` restricts the rows (daily: prior flag = 0).  Rows with a
    NULL label count only in the review term.
    """
    d = df if population is None else df.where(population)
    axis = threshold_axis(d, score, label, days, list(grid), reversal_rate, review, scale=scale)
    m = _pair_cost(axis, grid[0], grid[1], review, fn_cost)
    return m.select(
        (F.col("gk") / F.lit(float(scale))).alias("UMBRAL_VERDE"),
        (F.col("yk") / F.lit(float(scale))).alias("UMBRAL_AMARILLO"),
        F.col("cost").alias("COSTO_TOTAL"),
        F.col("verde").alias("CASOS_VERDE"),
        (F.col("lt_g") - F.col("lt_y")).alias("CASOS_AMARILLO"),
        F.col("lt_y").alias("CASOS_ROJO"),
        F.col("fp").alias("FP_VERDE"),
        F.round("fpc", 6).alias("COSTO_FP_VERDE"),
        F.col("fn").alias("FN_ROJO"),
        (F.col("fn") * F.lit(float(fn_cost))).alias("COSTO_FN_ROJO"),
        ((F.col("lt_g") - F.col("lt_y")) * F.lit(float(review))).alias("COSTO_AMARILLO"),
    )


def sweep_green_threshold(df: DataFrame, score: str = "PROBABILIDAD_APROBACION", label: str = "TARGET_APRUEBA",
                          days: str = "DIASSOLICITADO", red: int = 500, green=(500, 998), review=5000,
                          reversal_rate=0.79, fn_cost=COST_FN, rates: Sequence[float] | None = None,
                          scale: int = 1000) -> DataFrame:
    """M3: cost curve over green thresholds with red fixed (default 0.50).

    ``reversal_rate=0`` gives the nominal curve (plain FP cost), > 0 the net
    curve; ``rates`` evaluates several rates at once (M4).
    """
    axis = threshold_axis(df, score, label, days, [green], reversal_rate, review, rates=rates,
                          extra_points=[red], scale=scale)
    ref = axis.where(F.col("k") == red).select("rate", F.col("n_lt").alias("r_lt"), F.col("n1_lt").alias("r_fn"))
    a = axis.where(F.col("k").between(*green)).join(ref, "rate")
    return a.select(
        "rate",
        (F.col("k") / F.lit(float(scale))).alias("UMBRAL_VERDE"),
        F.round(F.col("fpc_ge") + F.lit(float(review)) * (F.col("n_lt") - F.col("r_lt"))
                + F.lit(float(fn_cost)) * F.col("r_fn"), 6).alias("COSTO_TOTAL"),
        F.col("fp_ge").alias("FP_VERDE"),
        F.col("n_ge").alias("CASOS_VERDE"),
        F.round("fpc_ge", 6).alias("COSTO_FP_VERDE"),
        F.col("k").alias("__k"),
    )


def best_of_sweep(curve: DataFrame) -> DataFrame:
    """First strict minimum of a sweep curve per rate."""
    m = curve.groupBy("rate").agg(F.min(F.struct("COSTO_TOTAL", "__k", "UMBRAL_VERDE")).alias("m"))
    return m.select(F.col("rate").alias("TASA_REVERSION"), F.col("m.UMBRAL_VERDE").alias("UMBRAL_OPTIMO"),
                    F.col("m.COSTO_TOTAL").alias("COSTO_MINIMO"))


def reversal_sensitivity(df: DataFrame, rates=(0.5, 0.6, 0.7, 0.79, 0.85, 0.9), **kw) -> DataFrame:
    """M4: best green threshold per reversal rate (red fixed), one plan for all rates."""
    return best_of_sweep(sweep_green_threshold(df, rates=list(rates), **kw))


# ------------------------------------------------------------------ M5, M6
def assign_light(df: DataFrame, green: float, yellow: float, score: str = "PROBABILIDAD_APROBACION",
                 prior_col: str | None = "LEAK_FT", use_prior_class: bool = True,
                 days: str = "DIASSOLICITADO", acc_days: str = "EPISODIO_ACUM_DIAS",
                 max_days: int = 20, max_acc_days: int = 30, out: str = "SEMAFORO") -> DataFrame:
    """M5: FT1 (prior approval) first when used, else green / yellow / red by
    score; green with more than ``max_days`` requested or at least
    ``max_acc_days`` accumulated days becomes yellow (NULL days never trigger).
    A NULL or NaN score is red."""
    s = F.col(score)
    green = green if isinstance(green, Column) else F.lit(green)
    yellow = yellow if isinstance(yellow, Column) else F.lit(yellow)
    valid = s.isNotNull() & ~F.isnan(s)
    d = F.col(days) if days in df.columns else F.lit(None).cast("double")
    a = F.col(acc_days) if acc_days in df.columns else F.lit(None).cast("double")
    is_green = valid & (s >= green)
    rule = (d > max_days) | (a >= max_acc_days)
    light = (F.when(is_green & F.coalesce(rule, F.lit(False)), F.lit(YELLOW))
              .when(is_green, F.lit(GREEN))
              .when(valid & (s >= yellow), F.lit(YELLOW))
              .otherwise(F.lit(RED)))
    if use_prior_class and prior_col and prior_col in df.columns:
        light = F.when(F.col(prior_col) == 1, F.lit(FT1)).otherwise(light)
    return df.withColumn(out, light)


def decision_text(light: Column) -> Column:
    """M6: decision text for the light ('' for other classes)."""
    out = F.when(light == GREEN, DECISION_TEXT[GREEN])
    for k in (YELLOW, RED):
        out = out.when(light == k, DECISION_TEXT[k])
    return out.otherwise("")


# ------------------------------------------------------------------ M7, M8
def compare_fixed_vs_optimised(df: DataFrame, fixed=FIXED_DAILY, score: str = "PROBABILIDAD_APROBACION",
                               label: str = "TARGET_FT3", days: str = "DIASSOLICITADO", review=5000,
                               reversal_rate=0.0, fn_cost=COST_FN, grid=GRID_DAILY,
                               population: Column | None = None, scale: int = 1000) -> DataFrame:
    """M7: cost at the fixed thresholds vs the optimum, saving and saving %."""
    d = df if population is None else df.where(population)
    axis = threshold_axis(d, score, label, days, list(grid), reversal_rate, review,
                          extra_points=list(fixed), scale=scale)
    best = _pair_cost(axis, grid[0], grid[1], review, fn_cost).select("rate", F.col("cost").alias("opt"))
    g = axis.where(F.col("k") == fixed[0]).select("rate", "fpc_ge", F.col("n_lt").alias("lt_g"))
    y = axis.where(F.col("k") == fixed[1]).select("rate", F.col("n_lt").alias("lt_y"), "n1_lt")
    fixed_cost = g.join(y, "rate").select(
        "rate", F.round(F.col("fpc_ge") + F.lit(float(review)) * (F.col("lt_g") - F.col("lt_y"))
                        + F.lit(float(fn_cost)) * F.col("n1_lt"), 6).alias("fix"))
    j = fixed_cost.join(best, "rate")
    return j.select(
        F.lit(fixed[0] / scale).alias("UMBRAL_VERDE_FIJO"), F.lit(fixed[1] / scale).alias("UMBRAL_AMARILLO_FIJO"),
        F.col("fix").alias("COSTO_FIJO"), F.col("opt").alias("COSTO_OPTIMO"),
        F.round(F.col("fix") - F.col("opt"), 6).alias("AHORRO"),
        F.round(F.when(F.col("fix") > 0, (F.col("fix") - F.col("opt")) / F.col("fix") * 100), 6).alias("AHORRO_PCT"),
    )


def zone_precision(df: DataFrame, green: float, yellow: float, score: str = "PROBABILIDAD_APROBACION",
                   label: str = "TARGET_FT3") -> DataFrame:
    """M8: share of label 1 among green rows, of label 0 among red rows
    (0 when the zone is empty; unlabelled rows count in the zone size)."""
    s = F.col(score)
    valid = s.isNotNull() & ~F.isnan(s)
    g = valid & (s >= green)
    r = ~(valid & (s >= yellow))
    y = F.col(label)
    agg = df.agg(F.sum(g.cast("int")).alias("ng"), F.sum((g & (y == 1)).cast("int")).alias("g1"),
                 F.sum(r.cast("int")).alias("nr"), F.sum((r & (y == 0)).cast("int")).alias("r0"))
    return agg.select(
        F.round(F.when(F.col("ng") > 0, F.col("g1") / F.col("ng")).otherwise(0.0), 6).alias("PRECISION_VERDE"),
        F.round(F.when(F.col("nr") > 0, F.col("r0") / F.col("nr")).otherwise(0.0), 6).alias("PRECISION_ROJO"),
        F.coalesce(F.col("ng"), F.lit(0)).alias("CASOS_VERDE"), F.coalesce(F.col("nr"), F.lit(0)).alias("CASOS_ROJO"))


# ------------------------------------------------------------------ D7-D10
def light_distribution(df: DataFrame, light: str = "SEMAFORO", group: str = "GRUPO") -> DataFrame:
    """Count and % per light within each group (e.g. decided / pending)."""
    c = df.groupBy(group, light).agg(F.count(F.lit(1)).alias("N"))
    w = Window.partitionBy(group)
    return c.withColumn("PCT", F.round(F.col("N") * 100.0 / F.sum("N").over(w), 6))


def green_zone_validation(df: DataFrame, light: str = "SEMAFORO", label: str = "TARGET_FT3") -> DataFrame:
    """TP, FP and precision among green rows (NULL labels ignored)."""
    g = df.where(F.col(light) == GREEN)
    a = g.agg(F.count(F.lit(1)).alias("TOTAL_VERDE"),
              F.coalesce(F.sum((F.col(label) == 1).cast("int")), F.lit(0)).alias("TP"),
              F.coalesce(F.sum((F.col(label) == 0).cast("int")), F.lit(0)).alias("FP"))
    return a.withColumn("PRECISION", F.round(F.when(F.col("TP") + F.col("FP") > 0,
                                                    F.col("TP") / (F.col("TP") + F.col("FP"))).otherwise(0.0), 6))


def prior_system_crosstab(df: DataFrame, prior: str = "LEAK_FT", light: str = "SEMAFORO",
                          lights: Sequence[str] = LIGHTS) -> DataFrame:
    """Earlier approval flag vs new light: counts and row %."""
    p = df.groupBy(prior).pivot(light, list(lights)).count().fillna(0, subset=list(lights))
    total = sum((F.col(x) for x in lights), F.lit(0))
    return p.select(prior, *[F.col(x).alias(f"N_{x}") for x in lights],
                    *[F.round(F.when(total > 0, F.col(x) * 100.0 / total), 6).alias(f"PCT_{x}") for x in lights])


def report_summary(decided: DataFrame, pending: DataFrame, green: float, yellow: float,
                   light: str = "SEMAFORO", label: str = "TARGET_FT3", days: str = "DIASSOLICITADO") -> DataFrame:
    """metric/value rows of the daily report (one aggregate per side, then
    ``stack`` to long form)."""
    side = "__side"
    u = decided.select(F.col(light), F.col(label), F.lit(None).cast("double").alias(days), F.lit(0).alias(side)) \
        .unionByName(pending.select(F.col(light), F.lit(None).cast(dict(decided.dtypes).get(label, "int")).alias(label),
                                    F.col(days).cast("double").alias(days), F.lit(1).alias(side)))
    dec, pen = F.col(side) == 0, F.col(side) == 1
    lt = F.col(light)
    tp = F.sum((dec & (lt == GREEN) & (F.col(label) == 1)).cast("int"))
    fp = F.sum((dec & (lt == GREEN) & (F.col(label) == 0)).cast("int"))
    j = u.agg(
        F.count(F.lit(1)).cast("double").alias("TOTAL"),
        F.sum(dec.cast("int")).cast("double").alias("DEC"),
        F.sum(pen.cast("int")).cast("double").alias("PEN"),
        *[F.sum((pen & (lt == x)).cast("int")).cast("double").alias(f"P_{x}") for x in LIGHTS],
        F.sum(F.when(pen & (lt == GREEN), F.col(days))).cast("double").alias("PDAYS"),
        F.when(tp + fp > 0, tp / (tp + fp)).cast("double").alias("PREC"),
        fp.cast("double").alias("FP"))
    j = j.fillna(0.0, subset=["DEC", "PEN", "PDAYS", "FP"] + [f"P_{x}" for x in LIGHTS])
    gcol = green if isinstance(green, Column) else F.lit(float(green))
    ycol = yellow if isinstance(yellow, Column) else F.lit(float(yellow))
    j = j.withColumn("G", gcol.cast("double")).withColumn("Y", ycol.cast("double"))
    names = [("TOTAL_LICENCIAS", "TOTAL"), ("CON_DICTAMEN", "DEC"), ("PENDIENTES", "PEN")] + \
            [(f"PENDIENTES_{x}", f"P_{x}") for x in LIGHTS] + \
            [("DIAS_SOLICITADOS_VERDE", "PDAYS"), ("PRECISION_VERDE", "PREC"), ("FALSOS_POSITIVOS", "FP"),
             ("UMBRAL_VERDE", "G"), ("UMBRAL_AMARILLO", "Y")]
    items = ", ".join(f"{i}, '{n}', `{c}`" for i, (n, c) in enumerate(names))
    long = j.selectExpr(f"stack({len(names)}, {items}) AS (ORDEN, METRICA, VALOR)")
    return long.withColumn("VALOR", F.round("VALOR", 6))


# ------------------------------------------------------------------ F2-F4
def review_queue(df: DataFrame, light: str = "SEMAFORO", score: str = "PROBABILIDAD_APROBACION",
                 keys: Sequence[str] = ()) -> DataFrame:
    """F2: light ascending, score descending (keys as final tie-break)."""
    return df.orderBy(F.col(light).asc(), F.col(score).desc(), *[F.col(k) for k in keys])


def top_groups_in_green(df: DataFrame, n: int = 10, light: str = "SEMAFORO", group: str = "CIE_GRUPO") -> DataFrame:
    """the ``n`` most frequent groups among green rows with their %."""
    g = df.where(F.col(light) == GREEN)
    c = g.groupBy(group).agg(F.count(F.lit(1)).alias("N"))
    top = c.orderBy(F.col("N").desc(), F.col(group).asc_nulls_last()).limit(n)
    total = g.agg(F.count(F.lit(1))).scalar()  # one-value subquery
    return top.select(group, "N", F.round(F.col("N") * 100.0 / total, 6).alias("PCT"))


# The columns that order rows of equal score.
LIST_KEYS = ("AFILIADO_RUT", "LCC_COMCOR", "LCC_COMCOD")


def _by_score(df: DataFrame, score: str) -> DataFrame:
    """Score descending, then the keys, so that equal scores have an order and can be split over tasks."""
    return df.orderBy(F.col(score).desc(), *[F.col(k) for k in LIST_KEYS if k in df.columns])


def false_positive_list(df: DataFrame, light: str = "SEMAFORO", label: str = "TARGET_FT3",
                        score: str = "PROBABILIDAD_APROBACION") -> DataFrame:
    """green rows whose label is 0, by score descending."""
    return _by_score(df.where((F.col(light) == GREEN) & (F.col(label) == 0)), score)


def green_list(df: DataFrame, light: str = "SEMAFORO", score: str = "PROBABILIDAD_APROBACION") -> DataFrame:
    """green rows by score descending."""
    return _by_score(df.where(F.col(light) == GREEN), score)


# ------------------------------------------------------------------ D4-D6
def flow_statistics(df: DataFrame, date_from=None, date_to=None, date_col: str = "FECHA_RECEPCION") -> DataFrame:
    """Claims, modified, sent to the appeals body, ratified, denied, and the
    stage percentages (NULL when the stage denominator is 0)."""
    d = df
    if date_from is not None:
        d = d.where(F.col(date_col) >= F.lit(date_from).cast("date"))
    if date_to is not None:
        d = d.where(F.col(date_col) <= F.lit(date_to).cast("date"))
    mod = F.col("TARGET_MODIFICA") == 1
    rat = F.col("TARGET_RATIFICA")
    a = d.agg(F.count(F.lit(1)).alias("total_licenses"),
              F.sum(F.when(mod, 1).otherwise(0)).alias("modified_licenses"),
              F.sum(F.when(mod & rat.isNotNull(), 1).otherwise(0)).alias("compin_licenses"),
              F.sum(F.when(mod & (rat == 1), 1).otherwise(0)).alias("compin_ratified"),
              F.sum(F.when(mod & (rat == 0), 1).otherwise(0)).alias("compin_denied"))
    a = a.fillna(0)

    def pct(n, d_):
        return F.round(F.when(F.col(d_) > 0, F.col(n) * 100.0 / F.col(d_)), 6)

    return a.select("*", pct("modified_licenses", "total_licenses").alias("pct_modified"),
                    pct("compin_licenses", "modified_licenses").alias("pct_to_compin"),
                    pct("compin_ratified", "compin_licenses").alias("pct_ratified"),
                    pct("compin_denied", "compin_licenses").alias("pct_denied"))


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    """Rows per target value (NULL excluded)."""
    return df.where(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("N"))


def load_verification(df: DataFrame, day, ts_col: str = "FECHA_PROCESAMIENTO", light: str = "SEMAFORO",
                      pending: str = "ES_PENDIENTE") -> DataFrame:
    """Total rows, pending rows and distinct lights processed on ``day``."""
    d = df.where(F.to_date(F.col(ts_col)) == F.lit(day).cast("date"))
    return d.agg(F.count(F.lit(1)).alias("total"), F.coalesce(F.sum(pending), F.lit(0)).cast("long").alias("pendientes"),
                 F.count_distinct(light).alias("semaforos"))
