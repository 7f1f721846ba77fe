"""Look-back joins and look-back aggregates (survey C3-C5, D1-D3).

A claim at day ``t`` looks at the same person's events with day in
``[t - days, t)``.  Two physical forms are offered:

* ``lookback_aggregate`` (used by the metric builders) never materialises
  (claim, event) pairs.  ``lookback_days`` yields one row per (key, probe
  day), which ``attach_days`` joins to the probes.  Events are paired with the *distinct probe days* of
  the same person (``method="join"``: an equi-join on (person, day bucket),
  each probe day copied to the at most two ``days``-wide buckets its window
  touches), or fanned out to every day they can influence
  (``method="fanout"``: ``t`` in ``[d + 1, d + days]``).  Either way an event
  meets at most ``days`` probe days, so the work is bounded by ``days`` times
  the events even for a person holding a third of all rows, and the join
  form only does the work where probes exist.  The pairs are aggregated per
  (person, probe day) with partial/final hash aggregation and joined back to
  the probes on (person, day): the aggregated side is unique per key, so the
  final join cannot fan out.  With a probe range the event scan is pruned to
  ``[from - days, to)``.
* ``lookback_join`` returns the pairs themselves (left outer), by an equi-join
  on ``(key, day bucket)`` with the probe copied to the at most two buckets
  its window touches, so a hot key is divided into ``days``-wide slices
  instead of a single sort-merge group.  Its output is every (probe, event)
  pair inside the window, so it is meant for callers that need the pairs;
  the pipelines and registered queries use ``lookback_aggregate``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import day_literal, day_number

PROBE_DAY = "__lb_day"
_B = "__lb_bucket"


def _as_list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def lookback_days(
    probe: DataFrame,
    history: DataFrame,
    key: str | Sequence[str],
    probe_date: str,
    hist_date: str,
    aggs: Sequence[Column],
    days: int = 15,
    hist_key: str | Sequence[str] | None = None,
    hist_filter: Column | None = None,
    date_from=None,
    date_to=None,
    reduce: tuple[Sequence[str], Sequence[Column]] | None = None,
    pre_group: Sequence[str] | None = None,
    pre_aggs: Sequence[Column] | None = None,
    method: str = "join",
    distinct: Mapping[str, str] | None = None,
    merge: Mapping[str, str] | None = None,
) -> DataFrame:
    """Aggregates of ``history`` rows in ``[probe day - days, probe day)``: one row per (key, probe day) with any.

    ``key``/``hist_key`` are the equi-join columns (same order; history keys
    take the types of the probe's).  ``aggs`` are
    aggregate expressions over history columns, each with an alias.  Optional
    ``date_from``/``date_to`` (inclusive days) bound the probe range so the
    history scan is pruned to ``[date_from - days, date_to)``.
    ``reduce`` (group columns, aggregates) shrinks the history to one row per
    (key, event date, group) *before* it meets the up to ``days`` probe days;
    later aggregates read the reduced columns.
    With ``pre_group``, pairs are first reduced per (key, day, *pre_group) by
    ``pre_aggs`` and ``aggs`` then run over those rows: distinct counts of a
    ``pre_group`` column become plain counts, so Spark needs no ``Expand``
    (one copy of the data per distinct aggregate).  ``distinct`` ({output:
    column}) counts different values of several columns in one pass, instead
    of ``aggs``: each pair becomes a tag (kind, value) for each column, tags
    are de-duplicated once per (key, day) and counted by kind.  The columns of
    ``merge`` ({column: "sum" or "max"}) travel on the first tag.
    The probe day's column is ``PROBE_DAY``.
    """
    pk = _as_list(key)
    hk = _as_list(hist_key) if hist_key is not None else pk
    h = history
    if hist_filter is not None:
        h = h.where(hist_filter)
    hday = F.to_date(F.col(hist_date))
    # range predicates on the raw column with DATE literals: pushed to the scan
    if date_from is not None:
        h = h.where(F.col(hist_date) >= day_literal(date_from, -days))
    if date_to is not None:
        h = h.where(F.col(hist_date) < day_literal(date_to))
    # rename history keys to probe names so the join is a plain equi-join
    for a, b in zip(hk, pk):
        if a != b:
            h = h.withColumnRenamed(a, b)
    h = h.withColumns({c: F.col(c).cast(probe.schema[c].dataType) for c in pk})
    if method == "join":
        h = h.where(hday.isNotNull()).withColumn(_B, F.floor(F.unix_date(hday) / days))
    if reduce:
        group, reduced = reduce
        if method == "join":
            # dealt out once, for the reduction and for the pairing
            h = h.repartition(*pk, _B)
            group = [_B, *group]
        h = h.groupBy(*dict.fromkeys([*pk, hist_date, *group])).agg(*reduced)
    pday = F.to_date(F.col(probe_date))
    if method == "fanout":
        first = F.date_add(hday, 1)
        last = F.date_add(hday, days)
        if date_from is not None:
            first = F.greatest(first, F.lit(date_from).cast("date"))
        if date_to is not None:
            last = F.least(last, F.lit(date_to).cast("date"))
        fanned = (h.where(hday.isNotNull() & (first <= last))
                   .withColumn(PROBE_DAY, F.explode(F.sequence(first, last))))
    elif method == "join":
        pdays = probe.select(*pk, pday.alias(PROBE_DAY)).where(F.col(PROBE_DAY).isNotNull()).distinct()
        pn = F.unix_date(F.col(PROBE_DAY))
        pdays = pdays.withColumn(_B, F.explode(F.array_distinct(
            F.array(F.floor((pn - days) / days), F.floor((pn - 1) / days)))))
        hb = h.withColumn("__hn", F.unix_date(hday))
        # history streams, the few distinct probe days per (person, bucket) are buffered
        fanned = hb.join(pdays, [*pk, _B]).where(
            (F.col("__hn") >= F.unix_date(F.col(PROBE_DAY)) - days) & (F.col("__hn") < F.unix_date(F.col(PROBE_DAY)))) \
            .drop("__hn", _B)
    else:
        raise ValueError(method)
    if distinct:
        return _tagged(fanned, pk, distinct, merge or {})
    if pre_group:
        fanned = fanned.groupBy(*pk, PROBE_DAY, *pre_group).agg(*pre_aggs)
    return fanned.groupBy(*pk, PROBE_DAY).agg(*aggs)


def _tagged(pairs: DataFrame, pk: list[str], distinct: Mapping[str, str], merge: Mapping[str, str]) -> DataFrame:
    """Distinct counts of several columns, and merged measures, per (key, probe day)."""
    tags = F.explode(F.array(*[F.struct(F.lit(i).alias("kind"), F.col(c).cast("string").alias("value"))
                               for i, c in enumerate(distinct.values())]))
    by = {"sum": F.sum, "max": F.max}
    tagged = pairs.select(*pk, PROBE_DAY, *merge, tags.alias("__tag"))
    first = F.col("__tag.kind") == 0
    once = tagged.groupBy(*pk, PROBE_DAY, "__tag").agg(
        *[by[how](F.when(first, F.col(c))).alias(c) for c, how in merge.items()], F.max(F.lit(1)).alias("__one"))
    counts = [F.count(F.when(F.col("__tag.kind") == i, F.col("__tag.value"))).alias(n) for i, n in enumerate(distinct)]
    return once.groupBy(*pk, PROBE_DAY).agg(*counts, *[by[how](c).alias(c) for c, how in merge.items()])


def attach_days(probe: DataFrame, per_day: DataFrame, key: str | Sequence[str], probe_date: str) -> DataFrame:
    """Left join of ``lookback_days`` rows to the probes of their key and day.

    The join key is one struct of key and day.  The aggregated side is
    partitioned on the single columns, so Spark shuffles both sides for the
    join, right below its sorts; there AQE splits the partition of a (key,
    day) that holds very many probes.  Without that shuffle of the (small)
    aggregated side, the probes of a hot (key, day) would stay in one task.
    """
    pk = _as_list(key)
    on = "__lb_key"
    p = probe.withColumn(on, F.struct(*[F.col(c) for c in pk], F.to_date(F.col(probe_date)).alias(PROBE_DAY)))
    d = per_day.withColumn(on, F.struct(*pk, PROBE_DAY)).drop(*pk, PROBE_DAY)
    return p.join(d, on, "left").drop(on)


def lookback_aggregate(probe: DataFrame, history: DataFrame, key: str | Sequence[str], probe_date: str, hist_date: str,
                       aggs: Sequence[Column], days: int = 15, defaults: dict | None = None, **options) -> DataFrame:
    """``probe`` with the aggregates of ``lookback_days`` (same arguments) appended, left semantics.

    ``defaults`` fills aggregates for probes without any history row.
    """
    out = attach_days(probe, lookback_days(probe, history, key, probe_date, hist_date, aggs, days, **options), key, probe_date)
    return out.fillna(defaults) if defaults else out


def lookback_join(
    probe: DataFrame,
    history: DataFrame,
    key: str | Sequence[str],
    probe_date: str,
    hist_date: str,
    days: int = 15,
    hist_key: str | Sequence[str] | None = None,
    hist_filter: Column | None = None,
    probe_id: Sequence[str] | None = None,
) -> DataFrame:
    """Left outer join of probes to history rows with day in ``[t - days, t)``.

    History columns must not clash with probe columns (rename first).  A probe
    without matches appears once with NULL history columns.  ``probe_id``
    (default: all probe columns) identifies a probe row.
    """
    pk = _as_list(key)
    hk = _as_list(hist_key) if hist_key is not None else pk
    h = history if hist_filter is None else history.where(hist_filter)
    hday = day_number(F.col(hist_date))
    h = h.withColumn(_B, F.floor(hday / days)).withColumn(PROBE_DAY, hday)
    pday = day_number(F.col(probe_date))
    buckets = F.array_distinct(F.array(F.floor((pday - days) / days),
                                       F.floor((pday - 1) / days)))
    p = probe.withColumn("__lb_pday", pday)
    pb = p.withColumn(_B, F.explode(buckets))
    cond = [pb[a] == h[b] for a, b in zip(pk, hk)]
    cond += [pb[_B] == h[_B], h[PROBE_DAY] >= pb["__lb_pday"] - days, h[PROBE_DAY] < pb["__lb_pday"]]
    pairs = pb.join(h, cond, "inner").drop(h[_B]).drop(pb[_B]).drop(PROBE_DAY)
    # probes with no pair at all: exactly one row each
    ids = list(probe_id) if probe_id else list(probe.columns)
    hit = pairs.select(*[F.col(c).alias("__m_" + c) for c in ids]).distinct()
    unmatched = p.join(hit, [p[c].eqNullSafe(hit["__m_" + c]) for c in ids], "left_anti")
    pairs = pairs.drop("__lb_pday")
    unmatched = unmatched.drop("__lb_pday")
    return pairs.unionByName(unmatched, allowMissingColumns=True)
