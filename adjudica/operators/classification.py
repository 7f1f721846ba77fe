"""Classification metrics (survey K5, L10).

AUC is the Mann-Whitney statistic with mid-ranks for ties, computed from
per-score positive/negative counts.  The prefix sum of negatives below each
score is split in two levels so no single task sees all distinct scores:
per-bucket totals (at most ``buckets + 2`` rows) are prefix-summed, and the
exact order is finished inside each bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def classification_metrics(df: DataFrame, score: str, label: str, threshold: float = 0.5,
                           buckets: int = 1 << 16) -> DataFrame:
    """One row: AUC, precision, recall, F1 (class = score > threshold), the
    confusion matrix and N.  Rows with a NULL label, or a NULL or NaN score,
    are ignored; empty denominators give 0.  Buckets follow s / (1 + |s|),
    which is monotone and bounded, so raw margins spread over them too."""
    s, y = F.col(score), F.col(label)
    d = df.where(y.isNotNull() & s.isNotNull() & ~F.isnan(s.cast("double"))).select(s.cast("double").alias("s"), y.cast("int").alias("y"))
    per = d.groupBy("s").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    b = F.floor(F.col("s") / (1 + F.abs("s")) * (2 * buckets)).cast("long")
    per = per.withColumn("b", b)
    tot = per.groupBy("b").agg(F.sum("neg").alias("bneg"))
    wb = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.withColumn("before_b", F.coalesce(F.sum("bneg").over(wb), F.lit(0))).drop("bneg")
    wi = Window.partitionBy("b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("before_s", F.coalesce(F.sum("neg").over(wi), F.lit(0))).join(tot, "b")
    auc = per.agg((F.sum(F.col("pos") * (F.col("before_b") + F.col("before_s") + 0.5 * F.col("neg")))
                   / (F.sum("pos").cast("double") * F.sum("neg"))).alias("AUC")).scalar()
    pred = F.col("s") > threshold
    cm = d.agg(
        F.sum((pred & (F.col("y") == 1)).cast("long")).alias("TP"),
        F.sum((pred & (F.col("y") == 0)).cast("long")).alias("FP"),
        F.sum((~pred & (F.col("y") == 1)).cast("long")).alias("FN"),
        F.sum((~pred & (F.col("y") == 0)).cast("long")).alias("TN"),
        F.count(F.lit(1)).alias("N"))
    cm = cm.fillna(0, subset=["TP", "FP", "FN", "TN"])
    tp, fp, fn = F.col("TP"), F.col("FP"), F.col("FN")
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0)
    rec = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0)
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0)
    return cm.select(F.round(auc, 6).alias("AUC"), F.round(prec, 6).alias("PRECISION"),
                     F.round(rec, 6).alias("RECALL"), F.round(f1, 6).alias("F1"), "TP", "FP", "FN", "TN", "N")


def grouped_auc(df: DataFrame, by: Sequence[str], score: str, label: str, buckets: int = 1 << 12) -> DataFrame:
    """``by``..., AUC, POS, NEG: the exact AUC of every group in one pass (mid-ranks for ties).

    As in ``classification_metrics``, prefix sums are split in two levels, here per group: each group's bucket totals
    (at most ``2 * buckets + 1`` rows) and the order inside a (group, bucket).  A group with one class only has no AUC.
    """
    by = list(by)
    s, y = F.col(score).cast("double"), F.col(label).cast("int")
    d = df.where(y.isNotNull() & s.isNotNull() & ~F.isnan(s)).select(*by, s.alias("s"), y.alias("y"))
    per = d.groupBy(*by, "s").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    per = per.withColumn("b", F.floor(F.col("s") / (1 + F.abs("s")) * buckets).cast("int"))
    inside = Window.partitionBy(*by, "b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("below", F.coalesce(F.sum("neg").over(inside), F.lit(0)))
    sums = per.groupBy(*by, "b").agg(
        F.sum("neg").alias("neg"), F.sum("pos").alias("pos"), F.sum(F.col("pos") * (F.col("below") + 0.5 * F.col("neg"))).alias("won"))
    before = Window.partitionBy(*by).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("earlier", F.coalesce(F.sum("neg").over(before), F.lit(0)))
    won = F.sum(F.col("won") + F.col("pos") * F.col("earlier"))
    pos, neg = F.sum("pos"), F.sum("neg")
    return sums.groupBy(*by).agg(F.when((pos > 0) & (neg > 0), won / (pos.cast("double") * neg)).alias("AUC"), pos.alias("POS"), neg.alias("NEG"))
