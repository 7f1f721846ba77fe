"""Weight of evidence and information value (survey J1-J4).

All features are handled in one plan: categorical features are unpivoted to
(feature, value) and counted per class with one grouped aggregate; numeric
features get exact deciles (``operators.stats.exact_quantiles``), duplicate
edges removed, then each value's bin is the number of inner edges below it
(right-closed bins, lowest value included), and the same counting applies.
Class totals are global (over all labelled rows, as in the reference).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stats import exact_quantiles, unpivot

ZERO_SHARE = 0.0001

# Predictive power bands (upper bounds, exclusive).
POWER_BANDS = [(0.02, "Not useful"), (0.1, "Weak"), (0.3, "Medium"), (0.5, "Strong")]
TOP_BAND = "Very strong"


def predictive_power(iv: Column) -> Column:
    out = None
    for hi, name in POWER_BANDS:
        out = F.when(iv < hi, name) if out is None else out.when(iv < hi, name)
    return out.otherwise(TOP_BAND)


def _woe_from_counts(counts: DataFrame, n_goods, n_bads) -> DataFrame:
    good = F.col("n1") / n_goods
    bad = F.col("n0") / n_bads
    good = F.when(good == 0, ZERO_SHARE).otherwise(good)
    bad = F.when(bad == 0, ZERO_SHARE).otherwise(bad)
    woe = F.log(good / bad)
    return counts.select("feature", "bin", "n0", "n1", (F.col("n0") + F.col("n1")).alias("total"),
                         (F.col("n0") / (F.col("n0") + F.col("n1"))).alias("bad_rate"),
                         good.alias("good_dist"), bad.alias("bad_dist"), woe.alias("woe"),
                         ((good - bad) * woe).alias("iv_contribution"))


def _class_totals(df: DataFrame, label: str):
    t = df.where(F.col(label).isNotNull()).agg(
        F.struct(F.sum((F.col(label) == 1).cast("long")).alias("g"),
                 F.sum((F.col(label) == 0).cast("long")).alias("b")).alias("t")).scalar()
    return t.getField("g"), t.getField("b")


def woe_categorical(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """Per (feature, category) class counts, shares over global class
    totals (zero share -> 0.0001), WoE, IV contribution and bad rate.
    NULL categories are left out (as a crosstab does)."""
    n_goods, n_bads = _class_totals(df, label)
    long = unpivot(df.where(F.col(label).isNotNull()), cols, keep=[label], cast="string") \
        .where(F.col("value").isNotNull())
    counts = long.groupBy("feature", F.col("value").alias("bin")).agg(
        F.sum((F.col(label) == 0).cast("long")).alias("n0"),
        F.sum((F.col(label) == 1).cast("long")).alias("n1"))
    return _woe_from_counts(counts, n_goods, n_bads)


def numeric_edges(df: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """Per numeric feature: sorted distinct quantile edges (0, 1/bins, ..., 1)."""
    long = unpivot(df, cols)
    probs = [i / bins for i in range(bins + 1)]
    q = exact_quantiles(long, ["feature"], "value", probs)
    return q.select("feature", F.array_sort(F.array_distinct(F.array(*[F.col(f"q{i}") for i in range(bins + 1)])))
                    .alias("edges"))


def bin_index(value: Column, edges: Column) -> Column:
    """Right-closed bin number (1-based), lowest edge included: 1 + number of
    inner edges strictly below the value.  A single edge gives one bin."""
    inner = F.slice(edges, 2, F.greatest(F.size(edges) - 2, F.lit(0)))
    return F.size(F.filter(inner, lambda e: e < value)) + 1


def woe_numeric(df: DataFrame, cols: Sequence[str], label: str, bins: int = 10) -> DataFrame:
    """WoE over quantile bins of the non-NULL values of each feature."""
    n_goods, n_bads = _class_totals(df, label)
    labelled = df.where(F.col(label).isNotNull())
    edges = F.broadcast(numeric_edges(labelled, cols, bins))  # bins + 1 values per column
    long = unpivot(labelled, cols, keep=[label]).where(F.col("value").isNotNull() & ~F.isnan("value"))
    binned = long.join(edges, "feature").withColumn("bin", bin_index(F.col("value"), F.col("edges")))
    counts = binned.groupBy("feature", F.col("bin").cast("string").alias("bin")).agg(
        F.sum((F.col(label) == 0).cast("long")).alias("n0"),
        F.sum((F.col(label) == 1).cast("long")).alias("n1"))
    return _woe_from_counts(counts, n_goods, n_bads)


def iv_table(woe: DataFrame, types: DataFrame | None = None, all_features: Sequence[str] | None = None) -> DataFrame:
    """IV per feature (sum of contributions) with its power band, sorted
    by IV descending.  Features listed in ``all_features`` without any bin
    (e.g. all NULL) get IV 0."""
    iv = woe.groupBy("feature").agg(F.sum("iv_contribution").alias("iv"))
    if all_features:
        allf = woe.sparkSession.createDataFrame([(f,) for f in all_features], "feature string")
        iv = allf.join(iv, "feature", "left").fillna(0.0, subset=["iv"])
    if types is not None:
        iv = iv.join(types, "feature", "left")
    return iv.withColumn("predictive_power", predictive_power(F.col("iv"))).orderBy(F.col("iv").desc(), "feature")


def iv_feature_summary(woe: DataFrame) -> DataFrame:
    """Per feature: bins, IV, power, WoE range, max and min bad rate."""
    s = woe.groupBy("feature").agg(F.count(F.lit(1)).alias("n_categories"), F.sum("iv_contribution").alias("iv"),
                                   (F.max("woe") - F.min("woe")).alias("woe_range"),
                                   F.max("bad_rate").alias("max_bad_rate"), F.min("bad_rate").alias("min_bad_rate"))
    return s.withColumn("predictive_power", predictive_power(F.col("iv")))


def iv_power_counts(iv: DataFrame) -> DataFrame:
    """Number of features per power band."""
    return iv.groupBy("predictive_power").agg(F.count(F.lit(1)).alias("n_features"))
