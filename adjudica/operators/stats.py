"""Distributed order statistics shared by the audit and IV operators
(exact quantiles, cumulative distributions, two-sample KS).

Everything starts from value counts per (group, value), so repeated values
collapse map-side.  Prefix sums over the ordered values are split in two
levels so no task has to hold a whole group: per-group buckets (``buckets``
of them, by a monotone map of the value that is linear around the median and
logarithmic in the tails, so outliers don't empty the others) get their
totals prefix-summed in a window over at most ``buckets`` rows per group, and
the exact order is finished inside each (group, bucket) window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKETS = 4096


def unpivot(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (),
            name: str = "feature", value: str = "value", cast: str = "double") -> DataFrame:
    """Long form (keep..., feature, value) of ``cols`` via ``stack``."""
    items = ", ".join(f"'{c}', CAST(`{c}` AS {cast})" for c in cols)
    return df.selectExpr(*[f"`{k}`" for k in keep], f"stack({len(cols)}, {items}) AS ({name}, {value})")


def cumulative(vc: DataFrame, part: Sequence[str], value: str, sums: Sequence[str],
               buckets: int = DEFAULT_BUCKETS, ties: Sequence[str] = ()) -> DataFrame:
    """Adds ``cum_<c>`` (inclusive running sum in ``value`` order within
    ``part``) and ``tot_<c>`` for each column in ``sums``.  ``vc`` must have
    one row per (part, value), or ``ties`` that order rows of equal value."""
    part = list(part)
    rng = vc.groupBy(*part).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"),
                                F.percentile_approx(value, [0.25, 0.5, 0.75], 1000).alias("__q"),
                                *[F.sum(c).alias("tot_" + c) for c in sums])
    rng = F.broadcast(rng)  # one row per part: a feature, or a class

    def place(x):
        """Monotone in the value: linear around the median, logarithmic in the tails."""
        spread = (F.col("__q")[2].cast("double") - F.col("__q")[0].cast("double"))
        return F.asinh((x.cast("double") - F.col("__q")[1].cast("double")) / F.when(spread > 0, spread).otherwise(1.0))

    lo, hi = place(F.col("__lo")), place(F.col("__hi"))
    b = F.when(hi > lo, F.floor((place(F.col(value)) - lo) / (hi - lo) * buckets)).otherwise(F.lit(0))
    v = vc.join(rng, part).withColumn("__b", F.least(b, F.lit(buckets - 1)).cast("int"))
    bt = v.groupBy(*part, "__b").agg(*[F.sum(c).alias("__bt_" + c) for c in sums])
    wb = Window.partitionBy(*part).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    for c in sums:
        bt = bt.withColumn("__bo_" + c, F.coalesce(F.sum("__bt_" + c).over(wb), F.lit(0)))
    bt = bt.select(*part, "__b", *["__bo_" + c for c in sums])
    wi = Window.partitionBy(*part, "__b").orderBy(value, *ties).rowsBetween(Window.unboundedPreceding, 0)
    out = v.join(bt, [*part, "__b"])
    for c in sums:
        out = out.withColumn("cum_" + c, F.col("__bo_" + c) + F.sum(c).over(wi))
    return out.drop("__lo", "__hi", "__q", "__b", *["__bo_" + c for c in sums])


def exact_quantiles(long: DataFrame, part: Sequence[str], value: str, probs: Sequence[float],
                    buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Per ``part``: ``n`` and ``q_i`` = linear-interpolated quantile (the
    numpy/pandas default) of non-NULL, non-NaN ``value`` for each prob."""
    part = list(part)
    clean = long.where(F.col(value).isNotNull() & ~F.isnan(F.col(value)))
    vc = clean.groupBy(*part, value).agg(F.count(F.lit(1)).alias("c"))
    cum = cumulative(vc, part, value, ["c"], buckets)
    excl = F.col("cum_c") - F.col("c")
    n = F.col("tot_c")
    aggs = [F.first(n).alias("n")]
    for i, q in enumerate(probs):
        h = (n - 1) * F.lit(float(q))
        lo, hi = F.floor(h), F.ceil(h)
        aggs += [F.max(F.when((excl <= lo) & (lo < F.col("cum_c")), F.col(value))).alias(f"__lo{i}"),
                 F.max(F.when((excl <= hi) & (hi < F.col("cum_c")), F.col(value))).alias(f"__hi{i}"),
                 F.first(h - lo).alias(f"__f{i}")]
    r = cum.groupBy(*part).agg(*aggs)
    cols = [F.col(f"__lo{i}") + F.col(f"__f{i}") * (F.col(f"__hi{i}") - F.col(f"__lo{i}"))
            for i in range(len(probs))]
    return r.select(*part, "n", *[c.alias(f"q{i}") for i, c in enumerate(cols)])


def ks_statistic(long: DataFrame, part: Sequence[str], value: str, sample: str,
                 buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Two-sample KS per ``part``: ``sample`` is 1 for the first sample, 0 for
    the second.  Returns part, n1, n2, statistic D = max |F1 - F2|."""
    part = list(part)
    vc = long.groupBy(*part, value).agg(F.sum(F.col(sample).cast("long")).alias("c1"),
                                        F.sum((1 - F.col(sample)).cast("long")).alias("c2"))
    cum = cumulative(vc, part, value, ["c1", "c2"], buckets)
    diff = F.abs(F.col("cum_c1") / F.col("tot_c1") - F.col("cum_c2") / F.col("tot_c2"))
    return cum.groupBy(*part).agg(F.first("tot_c1").alias("n1"), F.first("tot_c2").alias("n2"),
                                  F.max(diff).alias("statistic"))


def kolmogorov_pvalue(d, n1, n2, terms: int = 100):
    """Asymptotic two-sided p: Q(z) = 2 sum_{k>=1} (-1)^(k-1) exp(-2 k^2 z^2),
    z = D sqrt(n1 n2 / (n1 + n2)); 1 when z < 0.27 (Q(0.27) rounds to 1)."""
    z = d * F.sqrt(n1 * n2 / (n1 + n2).cast("double"))
    series = F.aggregate(F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
                         lambda acc, k: acc + 2 * F.pow(F.lit(-1.0), k - 1) * F.exp(-2 * k * k * z * z))
    return F.when(z < 0.27, F.lit(1.0)).otherwise(F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))


# Two-sample KS p-values are exact if neither sample has more values than this, else asymptotic.
KS_EXACT_N = 200


def ks_exact_pvalue(d, n1, n2):
    """Exact two-sided p of the two-sample statistic: the share of all orders of the pooled values whose statistic is at
    least ``d``.

    An order is a lattice path from (0, 0) to (n1, n2); those that keep |i/n1 - j/n2| below ``d`` are counted row by
    row.  Counts are kept as shares of all paths to a point, P(i, j) = i/(i+j) P(i-1, j) + j/(i+j) P(i, j-1), so nothing
    grows; the bound is compared in whole numbers, |i n2 - j n1| < d n1 n2.
    """
    reach = F.round(d * n1 * n2).cast("long")

    def point(i, j, above, left):
        whole = F.greatest(i + j, F.lit(1).cast("long")).cast("double")
        inside = F.when(i + j == 0, F.lit(1.0)).otherwise((i * above + j * left) / whole)
        return F.when(F.abs(i * n2 - j * n1) >= reach, F.lit(0.0)).otherwise(inside)

    def row(before, i):
        def step(done, j):
            above = F.when(i > 0, F.element_at(before, (j + 1).cast("int"))).otherwise(F.lit(0.0))
            left = F.when(j > 0, F.element_at(done, F.greatest(j, F.lit(1).cast("long")).cast("int"))).otherwise(F.lit(0.0))
            return F.concat(done, F.array(point(i, j, above, left)))
        return F.aggregate(F.sequence(F.lit(0).cast("long"), n2.cast("long")), F.array().cast("array<double>"), step)

    start = F.array_repeat(F.lit(0.0), (n2 + 1).cast("int"))
    last = F.aggregate(F.sequence(F.lit(0).cast("long"), n1.cast("long")), start, row)
    return F.least(F.greatest(1 - F.element_at(last, -1), F.lit(0.0)), F.lit(1.0))


def ks_pvalue(d, n1, n2, exact_n: int = KS_EXACT_N):
    """Exact for samples of at most ``exact_n`` values each, asymptotic beyond."""
    small = (n1 <= exact_n) & (n2 <= exact_n)
    return F.when(small, ks_exact_pvalue(d, F.when(small, n1), F.when(small, n2))).otherwise(kolmogorov_pvalue(d, n1, n2))
