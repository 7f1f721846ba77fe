"""Monthly entity metrics over trailing windows (survey D11, inferred).

The reference consumes per-entity monthly tables (insured, doctor, local
provider, employer) keyed by ``PERIODO`` text ``MMyyyy`` whose columns are
count / sum / mean / min / max / distinct measures over the trailing 1, 6,
12, 24 and 36 months ending at ``PERIODO``; their producer is not part of
the reference, so this builder is inferred from those column families.

Plan: pre-aggregate each measure per (entity, month) (map-side combined),
so even an entity holding a third of all rows shrinks to one row per month.
A window's value changes only where an active month enters or leaves it, so
each active month yields one event for its own period and one for the period
in which it leaves each window.  Whole-number counts and sums are running sums
of those events, +x where the month enters a window and -x where it leaves.
Minima, maxima and fractional sums are taken over the active months themselves,
in disjoint rings between consecutive windows, joined outwards (fractional sums
are never subtracted, so nothing cancels).  Distinct measures: a value enters
a window with an occurrence that has none within the window before it, and
leaves after one that has none within the window behind it.  One window pass
works on the periods with an event; the periods up to the next event, which
have the same values, are filled in last.  No raw row pairs are formed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KINDS = ("count", "sum", "mean", "min", "max", "distinct")


@dataclass(frozen=True)
class Measure:
    name: str
    kind: str
    expr: Column


def month_index(c: Column) -> Column:
    return F.year(c) * 12 + F.month(c) - 1


def period_of_index(i: Column) -> Column:
    return F.date_format(F.make_date(F.floor(i / 12).cast("int"), (i % 12 + 1).cast("int"), F.lit(1)),
                         "MMyyyy")


def monthly_metrics(df: DataFrame, entity: str, date_col: str, measures: Sequence[Measure],
                    windows: Sequence[int] = (1, 6, 12, 24, 36), until=None) -> DataFrame:
    """One row per (entity, PERIODO) with ``{name}_U{w}M`` per measure and window.

    Periods are every month within ``max(windows)`` months after any activity
    of the entity (the period spine), optionally bounded by ``until``.
    """
    for m in measures:
        if m.kind not in KINDS:
            raise ValueError(m.kind)
    maxw = max(windows)
    base = df.where(F.col(entity).isNotNull() & F.col(date_col).isNotNull()) \
             .withColumn("__m", month_index(F.to_date(date_col)))
    plain = [m for m in measures if m.kind != "distinct"]
    dist = [m for m in measures if m.kind == "distinct"]
    limit = None if until is None else month_index(F.lit(until).cast("date"))

    active = base.groupBy(entity, "__m").agg(F.count(F.lit(1)).alias("__rows"), *_month_parts(plain))
    for i, m in enumerate(dist):
        active = active.unionByName(_distinct_months(base, entity, m, windows, f"__d{i}"), allowMissingColumns=True)
    out = _measured(_events(active, entity, windows), entity, plain, dist, windows)
    last = F.col("__next") - 1 if limit is None else F.least(F.col("__next") - 1, limit)
    out = out.where((F.col("__live") > 0) & (F.col("__t") <= last)).withColumn("__t", F.explode(F.sequence("__t", last)))
    return out.select(entity, *[f"{m.name}_U{w}M" for w in windows for m in plain],
                      *[f"{m.name}_U{w}M" for m in dist for w in windows], period_of_index(F.col("__t")).alias("PERIODO"))


def _month_parts(plain: Sequence[Measure]) -> list[Column]:
    """What an active month contributes: count, sum, minimum or maximum of each measure."""
    out = []
    for i, m in enumerate(plain):
        if m.kind in ("count", "sum", "mean"):
            out.append(F.count(m.expr).alias(f"__c{i}"))
        if m.kind in ("sum", "mean"):
            out.append(F.sum(m.expr).alias(f"__s{i}"))
        if m.kind == "min":
            out.append(F.min(m.expr).alias(f"__n{i}"))
        if m.kind == "max":
            out.append(F.max(m.expr).alias(f"__x{i}"))
    return out


def _distinct_months(base: DataFrame, entity: str, m: Measure, windows: Sequence[int], name: str) -> DataFrame:
    """For each active month and window, how many values enter the window with it (``_in``) and leave after it (``_out``)."""
    v = base.select(entity, "__m", m.expr.alias("__v")).where(F.col("__v").isNotNull()).distinct()
    own = Window.partitionBy(entity, "__v").orderBy("__m")
    v = v.withColumns({"__before": F.col("__m") - F.lag("__m").over(own), "__behind": F.lead("__m").over(own) - F.col("__m")})
    far = lambda c, w: F.count_if(F.coalesce(F.col(c) >= w, F.lit(True)))
    return v.groupBy(entity, "__m").agg(*[far("__before", w).alias(f"{name}_{w}_in") for w in windows],
                                        *[far("__behind", w).alias(f"{name}_{w}_out") for w in windows])


def _events(active: DataFrame, entity: str, windows: Sequence[int]) -> DataFrame:
    """The active months at their own period (``__k`` 0) and at those in which they leave a window of ``__k`` months.

    Rows grow by the number of windows behind this shuffle, and by the periods filled in, so its parts aren't coalesced.
    """
    parts = int(active.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    e = active.repartition(parts, entity).withColumn("__k", F.explode(F.array(F.lit(0), *[F.lit(w) for w in sorted(set(windows))])))
    return e.withColumn("__t", F.col("__m") + F.col("__k"))


def _blocks(w: int) -> list[tuple[int, int]]:
    """(length, months back) of disjoint blocks of 1, 2, 4, ... months that make up a window of ``w`` months."""
    out, back = [], 0
    for k in reversed(range(w.bit_length())):
        if w >> k & 1:
            out.append((1 << k, back))
            back += 1 << k
    return out


def _measured(events: DataFrame, entity: str, plain: Sequence[Measure], dist: Sequence[Measure], windows: Sequence[int]) -> DataFrame:
    """One row per (entity, ``__t`` with an event) with the measures of every window, the rows inside the longest one
    (``__live``) and the period of the entity's next event (``__next``)."""
    def change(c: str, w: int, leaving: str | None = None) -> Column:
        return F.sum(F.when(F.col("__k") == 0, F.col(c)).when(F.col("__k") == w, -F.col(leaving or c)))

    def whole(c: str) -> bool:
        return events.schema[c].dataType.typeName() == "long"

    changes = {f"__rows_{max(windows)}": change("__rows", max(windows))}
    months: dict[str, Column] = {}
    rings: dict[str, tuple] = {}
    for i, m in enumerate(plain):
        if m.kind in ("count", "sum", "mean"):
            changes |= {f"__c{i}_{w}": change(f"__c{i}", w) for w in windows}
        if m.kind in ("sum", "mean") and whole(f"__s{i}"):
            changes |= {f"__s{i}_{w}": change(f"__s{i}", w) for w in windows}
        elif m.kind in ("sum", "mean"):
            rings[f"__s{i}"] = F.sum, lambda a, b: F.coalesce(a + b, a, b)
        elif m.kind == "min":
            rings[f"__n{i}"] = F.min, F.least
        elif m.kind == "max":
            rings[f"__x{i}"] = F.max, F.greatest
    for i, _ in enumerate(dist):
        changes |= {f"__d{i}_{w}": change(f"__d{i}_{w}_in", w, f"__d{i}_{w}_out") for w in windows}
    for c in rings:
        months[c] = F.max(F.when(F.col("__k") == 0, F.col(c)))
    points = events.groupBy(entity, "__t").agg(*[x.alias(c) for c, x in (changes | months).items()])

    own = Window.partitionBy(entity).orderBy("__t")
    run = own.rowsBetween(Window.unboundedPreceding, 0)
    seen = {c: F.sum(c).over(run) for c in changes}
    steps = sorted(set(windows))
    for near, w in zip([0, *steps], steps):
        seen |= {f"{c}_r{w}": over(c).over(own.rangeBetween(1 - w, -near)) for c, (over, _) in rings.items()}
    d = points.select(entity, "__t", F.lead("__t").over(own).alias("__next"), *[x.alias(c) for c, x in seen.items()])

    def count(c: str, w: int) -> Column:
        return F.coalesce(F.col(f"{c}_{w}"), F.lit(0))

    def joined(c: str, w: int) -> Column:
        total = None
        for x in steps[: steps.index(w) + 1]:
            total = F.col(f"{c}_r{x}") if total is None else rings[c][1](total, F.col(f"{c}_r{x}"))
        return total

    made: dict[str, Column] = {}
    for w in windows:
        for i, m in enumerate(plain):
            out, n, s = f"{m.name}_U{w}M", f"__c{i}", f"__s{i}"
            if m.kind == "count":
                made[out] = count(n, w)
            elif m.kind == "min":
                made[out] = joined(f"__n{i}", w)
            elif m.kind == "max":
                made[out] = joined(f"__x{i}", w)
            else:
                total = F.when(count(n, w) > 0, joined(s, w) if s in rings else F.col(f"{s}_{w}"))
                made[out] = total if m.kind == "sum" else total / F.when(count(n, w) > 0, count(n, w))
        for i, m in enumerate(dist):
            made[f"{m.name}_U{w}M"] = count(f"__d{i}", w)
    return d.select(entity, "__t", "__next", F.col(f"__rows_{max(windows)}").alias("__live"), *[x.alias(c) for c, x in made.items()])
