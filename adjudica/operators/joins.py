"""Latest-row, latest-period and membership joins, history rank, set ops
(survey C1, C7-C10, E1, E2, G1, G2).

"Newest row per key" is computed with an aggregate ``max(struct(order...,
payload...))`` instead of a ``row_number`` window where possible: the
aggregate is partially combined map-side, so a hot key never lands whole in
one task, and the result is unique per key so the following left join cannot
fan out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import period_key
from ..session import cut_lineage


def newest_per_partition(df: DataFrame, partition: Sequence[str], order: Sequence[Column],
                         n: int = 1, rank_col: str | None = None, salt_buckets: int = 64) -> DataFrame:
    """``row_number() OVER (PARTITION BY .. ORDER BY ..) <= n``.

    Two stages so a hot key is never sorted in one task: rows are first
    ranked inside (key, salt) groups, where the salt is a hash of the whole
    row, and only the ``n`` best of each group (at most ``salt_buckets * n``
    rows per key) take part in the final ranking.  The global top ``n`` of a
    key is always among its per-salt top ``n``, so the result is exact.
    ``order`` should end with a unique tie-break for deterministic output.
    """
    rn = rank_col or "__rn"
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(salt_buckets))
    w1 = Window.partitionBy(*partition, "__salt").orderBy(*order)
    cand = df.withColumn("__salt", salt).withColumn("__r1", F.row_number().over(w1)) \
             .where(F.col("__r1") <= n).drop("__r1", "__salt")
    w = Window.partitionBy(*partition).orderBy(*order)
    out = cand.withColumn(rn, F.row_number().over(w)).where(F.col(rn) <= n)
    return out if rank_col else out.drop(rn)


def latest_row(history: DataFrame, key: Sequence[str], order: Sequence[str],
               cutoff_col: str | None = None, cutoff=None,
               payload: Sequence[str] | None = None) -> DataFrame:
    """Newest history row per ``key`` (by ``order`` desc, NULLs last, then the
    payload columns desc as tie-break) with ``cutoff_col < cutoff``; key not NULL."""
    key = list(key)
    h = history
    for k in key:
        h = h.where(F.col(k).isNotNull())
    if cutoff_col is not None and cutoff is not None:
        h = h.where(F.to_date(F.col(cutoff_col)) < F.lit(cutoff).cast("date"))
    payload = [c for c in (payload or h.columns) if c not in key and c not in order]
    # NULL order values sort first in a struct, i.e. last for "newest": as NULLS LAST
    ordered = [F.struct(F.col(o).isNotNull().alias("nn"), F.col(o).alias("v")).alias(f"__o{i}")
               for i, o in enumerate(order)]
    best = h.groupBy(*key).agg(F.max(F.struct(*ordered, *[F.col(c) for c in order + payload]))
                               .alias("__best"))
    return best.select(*key, *[F.col("__best." + c).alias(c) for c in order + payload])


def join_latest_row(left: DataFrame, history: DataFrame, left_key: Sequence[str],
                    hist_key: Sequence[str], order: Sequence[str], cutoff_col: str | None = None,
                    cutoff=None, payload: Sequence[str] | None = None) -> DataFrame:
    """Left join to the newest history row per key before a cut-off."""
    latest = latest_row(history, hist_key, order, cutoff_col, cutoff, payload)
    cond = [left[a] == latest[b] for a, b in zip(left_key, hist_key)]
    out = left.join(latest, cond, "left")
    for a, b in zip(left_key, hist_key):
        if a != b:
            out = out.drop(latest[b])
    return out


def latest_period(metrics: DataFrame, entity: str, as_of, period_col: str = "PERIODO",
                  lexicographic: bool = False) -> DataFrame:
    """C7 (one entity): the metrics row with the newest period up to the month
    before ``as_of``.

    Chronological by default (``MMyyyy`` read as a date); ``lexicographic=True``
    compares and maximises the text as the reference does.
    """
    cutoff_text = F.date_format(F.add_months(F.trunc(F.lit(as_of).cast("date"), "MM"), -1), "MMyyyy")
    p = F.col(period_col)
    if lexicographic:
        ok, rank = p <= cutoff_text, p
    else:
        ok, rank = period_key(p) <= period_key(cutoff_text), period_key(p)
    m = metrics.where(F.col(entity).isNotNull() & ok)
    others = [c for c in m.columns if c != entity]
    # equal periods: the greatest row by its other columns
    best = m.groupBy(entity).agg(F.max(F.struct(rank.alias("__rank"), F.struct(*[F.col(c) for c in others]).alias("row"))).alias("__b"))
    return best.select(entity, *[F.col("__b.row." + c).alias(c) for c in others])


def join_latest_period(claims: DataFrame, metrics: dict, as_of, lexicographic: bool = False,
                       period_col: str = "PERIODO", prefix_period: bool = True) -> DataFrame:
    """Attach for each entity (claim column -> metrics frame keyed by the
    same column name) its newest metrics row up to the previous month."""
    out = claims
    for entity, mdf in metrics.items():
        lp = latest_period(mdf, entity, as_of, period_col, lexicographic)
        if prefix_period:
            lp = lp.withColumnRenamed(period_col, f"{period_col}_{entity}")
        out = out.join(lp, entity, "left")
    return out


def attach_metrics(base: DataFrame, metric_sets: Sequence[DataFrame], keys: Sequence[str],
                   defaults: dict | None = None) -> DataFrame:
    """Left joins of pre-aggregated metric sets on the same keys."""
    out = base
    for m in metric_sets:
        out = out.join(m, list(keys), "left")
    present = {k: v for k, v in (defaults or {}).items() if k in out.columns}
    return out.fillna(present) if present else out


def lookup_fill(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Per key, the first non-NULL value of each column (smallest value,
    a deterministic choice) fills that column's NULLs."""
    look = df.groupBy(key).agg(*[F.min(c).alias("__f_" + c) for c in cols])
    out = df.join(look, key, "left")
    return out.select(*[F.coalesce(F.col(c), F.col("__f_" + c)).alias(c) if c in cols else F.col(c)
                        for c in df.columns])


def mark_membership(df: DataFrame, members: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """``flag`` = 1 when the row's key is in ``members`` else 0 (no fan-out)."""
    m = members.select(*keys).distinct().withColumn("__in", F.lit(1))
    return df.join(m, list(keys), "left").withColumn(flag, F.coalesce(F.col("__in"), F.lit(0))).drop("__in")


def history_rank(new: DataFrame, history: DataFrame, person: str, order: Sequence[str],
                 rank_col: str = "RN_AFILIADO_HIST", count_peers: bool = False) -> DataFrame:
    """1 + number of the person's rows ordered strictly before each new row.

    ``count_peers=False`` counts history rows only (the reference: rows of the
    same batch are not yet inserted); ``True`` counts new rows as well.

    Skew: rows are dealt to range partitions of (person, order), whose bounds
    Spark draws from a sample, so a person, month or day that holds a large
    part of all rows is split into several of even size.  The split table is
    materialised once.  A row's rank is the person's count in its earlier
    parts (prefix sums over a few rows) plus its place inside its own part.
    History rows of equal keys are counted before they are moved.

    A row without person or order value is before and after no other row: a
    new one has rank 1, a history one counts for none.
    """
    order = list(order)
    whole = F.col(person).isNotNull()
    for c in order:
        whole = whole & F.col(c).isNotNull()
    n = new.withColumn("__h", F.lit(0)).withColumn("__c", F.lit(1 if count_peers else 0).cast("long"))
    h = history.select(person, *order).where(whole).groupBy(person, *order).agg(F.count(F.lit(1)).alias("__c")).withColumn("__h", F.lit(1))
    ranked = n.where(whole).unionByName(h, allowMissingColumns=True)
    # new rows before equal-key history rows so exact duplicates are not counted
    keys = [person, *order, "__h"]
    placed = cut_lineage(ranked.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__part", F.spark_partition_id()))
    counts = placed.groupBy(person, "__part").agg(F.sum("__c").alias("__n"))
    before = Window.partitionBy(person).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    inside = Window.partitionBy(person, "__part").orderBy(*order, "__h").rowsBetween(Window.unboundedPreceding, -1)
    inner = placed.withColumn("__in", F.coalesce(F.sum("__c").over(inside), F.lit(0))).where("__h = 0")
    out = inner.join(offsets, [person, "__part"]).select(*new.columns, (F.lit(1) + F.col("__off") + F.col("__in")).cast("long").alias(rank_col))
    return out.unionByName(new.where(~whole).withColumn(rank_col, F.lit(1).cast("long")))


def combine_predictions(frames: Sequence[DataFrame]) -> DataFrame:
    """G1: stack frames with differing columns (missing columns NULL)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def distinct_rows(df: DataFrame) -> DataFrame:
    """SELECT DISTINCT."""
    return df.distinct()


def dedupe_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """One row per key; with ``order`` the first row in that order, else any."""
    if order is None:
        return df.dropDuplicates(list(keys))
    return newest_per_partition(df, keys, order, 1)
