"""Insert-if-new and upserts on parquet tables (survey A6, A8, A9, C2).

Parquet tables have no MERGE, so each merge is a relational rewrite that
produces the new table contents:

* rows of the target whose key is absent from the source pass through an
  anti join with the source keys;
* matched and new rows come from the source, joined to the *matched* target
  rows only (a semi join restricted target) when old values are needed.

Source keys must be unique (a SQL MERGE errors on multiple matches; a join
would silently multiply rows): ``on_duplicate="error"`` checks it, ``"first"``
keeps one row per key by a deterministic order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.sizing import assert_unique


def anti_join_existing(new: DataFrame, existing: DataFrame, keys: Sequence[str],
                       key_source: DataFrame | None = None) -> DataFrame:
    """Rows of ``new`` whose key does not exist in ``existing`` (NOT EXISTS).

    ``existing`` is the large table.  Its key columns are first reduced to the
    keys the new rows carry (a semi join; Spark broadcasts the new keys when
    their measured size allows), and the anti join then runs between two
    small sides.  NULL keys never match, as in SQL.  ``key_source`` (a cheap
    frame carrying at least the keys of ``new``) serves the semi join when
    ``new`` itself is expensive to compute.
    """
    keys = list(keys)
    src = key_source if key_source is not None else new
    nk = src.select(*keys).distinct()
    seen = existing.select(*keys).join(nk, keys, "left_semi")
    return new.join(seen, keys, "left_anti")


def append_new(source: DataFrame, target: DataFrame, keys: Sequence[str],
               date_col: str | None = None, date_from=None, date_to=None) -> DataFrame:
    """Rows of ``source`` in the date range that are absent from ``target``.

    Returns the rows to append; ``sources.sinks.append`` writes them.
    """
    s = source
    if date_col is not None and (date_from is not None or date_to is not None):
        from ..functions.dates import date_window
        s = s.where(date_window(F.col(date_col), date_from, date_to))
    return anti_join_existing(s, target, keys)


def _dedupe(source: DataFrame, keys: Sequence[str], on_duplicate: str) -> DataFrame:
    if on_duplicate == "error":
        assert_unique(source, list(keys))
        return source
    if on_duplicate == "first":
        # the least row by its other columns: an aggregate, combined before rows move, so a key that repeats very
        # often is no burden; each column is ordered with its NULLs last
        rest = [c for c in source.columns if c not in keys]
        if not rest:
            return source.distinct()
        order = F.struct(*[F.struct(F.col(c).isNull().alias("n"), F.col(c).alias("v")).alias(c) for c in rest])
        least = source.groupBy(*keys).agg(F.min(order).alias("__row"))
        return least.select(*[F.col(c) if c in keys else F.col(f"__row.{c}.v").alias(c) for c in source.columns])
    if on_duplicate == "trust":
        return source
    raise ValueError(on_duplicate)


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 update_cols: Sequence[str] | None = None, on_duplicate: str = "error") -> DataFrame:
    """MERGE ... WHEN MATCHED UPDATE SET <update_cols> WHEN NOT MATCHED INSERT *.

    With ``update_cols=None`` every non-key column is overwritten, so the new
    table is ``(target anti source) UNION source``.  Otherwise matched rows keep
    the target's other columns.
    """
    keys = list(keys)
    s = _dedupe(source, keys, on_duplicate)
    skeys = s.select(*keys)
    untouched = target.join(skeys, keys, "left_anti")
    cols = target.columns
    if update_cols is None:
        return untouched.unionByName(s.select(*cols))
    keep = [c for c in cols if c not in keys and c not in update_cols]
    matched_old = target.join(skeys, keys, "left_semi").select(*keys, *keep)
    merged = s.join(matched_old, keys, "left")  # new keys get NULL for kept columns
    return untouched.unionByName(merged.select(*cols))


def merge_first_write_wins(target: DataFrame, source: DataFrame, keys: Sequence[str],
                           sticky_cols: Sequence[str], update_cols: Sequence[str],
                           insert_cols: Sequence[str] | None = None, on_duplicate: str = "error") -> DataFrame:
    """Matched rows keep the old non-NULL value of ``sticky_cols`` and take
    the new value of ``update_cols``; other target columns are unchanged.
    Unmatched source rows insert ``insert_cols`` (default: all target columns
    present in the source); the remaining columns are NULL.
    """
    keys = list(keys)
    s = _dedupe(source, keys, on_duplicate)
    skeys = s.select(*keys)
    untouched = target.join(skeys, keys, "left_anti")
    cols = target.columns
    old = target.join(skeys, keys, "left_semi").select(*keys, *[F.col(c).alias("__o_" + c)
                                                             for c in cols if c not in keys])
    old = old.withColumn("__matched", F.lit(True))
    j = s.join(old, keys, "left")
    ins = set(insert_cols) if insert_cols is not None else set(c for c in cols if c in s.columns)
    out = []
    for c, t in target.dtypes:
        if c in keys:
            out.append(F.col(c))
            continue
        o = F.col("__o_" + c)
        n = F.col(c) if c in s.columns else F.lit(None).cast(t)
        if c in sticky_cols:
            m = F.coalesce(o, n)
        elif c in update_cols:
            m = n
        else:
            m = o
        i = n if c in ins else F.lit(None).cast(t)
        out.append(F.when(F.col("__matched"), m).otherwise(i).cast(t).alias(c))
    return untouched.unionByName(j.select(*out))
