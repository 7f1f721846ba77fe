"""Table reads and the training / scoring loaders (survey A1-A4, F1).

Loaders only compose ``select`` / ``where`` / semi joins, so Catalyst pushes
the projections and the date and label predicates into the parquet scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import group_filter
from ..roles import DEFAULT_ROLES, ColumnRoles, reveals_label


def read_table(spark: SparkSession, name: str, database: str | None = None,
               schema: str | None = None, path: str | None = None, fmt: str = "parquet") -> DataFrame:
    """A1: a catalog table by qualified name, or files at ``path``."""
    if path is not None:
        return spark.read.format(fmt).load(path)
    qualified = ".".join(p for p in (database, schema, name) if p)
    return spark.table(qualified)


def limit_ordered(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """first ``n`` rows in a stated order (deterministic limit; Spark plans
    a TakeOrderedAndProject, i.e. a per-partition top-n then a merge)."""
    return df.orderBy(*order).limit(n)


def load_training(df: DataFrame, target: str, roles: ColumnRoles = DEFAULT_ROLES,
                  date_from=None, date_to=None, limit: int | None = None,
                  include_prior_flag: bool = False, group_mode: str | None = "strict",
                  date_col: str = "FECHA_RECEPCION", prior_flag: str = "LEAK_FT",
                  order: Sequence[Column] | None = None) -> DataFrame:
    """A2: role columns in role order (de-duplicated, leak columns removed) plus
    the target, rows with a label, outside the excluded diagnosis groups.

    Roles without numeric columns get them by rule (``with_numeric_from``).
    ``group_mode=None`` drops the group filter (the loader variant without it).
    ``limit`` keeps the first rows in ``order`` (default: the key columns).
    """
    roles = roles if roles.numeric else roles.with_numeric_from(df)
    feats = [c for c in roles.keys + roles.dates + roles.categorical + roles.numeric + roles.binary
             + roles.text if not reveals_label(c) and c in df.columns]
    cols = []
    for c in feats + [target] + ([prior_flag] if include_prior_flag else []):
        if c not in cols and c in df.columns:
            cols.append(c)
    out = df
    if date_from is not None:
        out = out.where(F.col(date_col) >= F.lit(date_from).cast("date"))
    if date_to is not None:
        out = out.where(F.col(date_col) <= F.lit(date_to).cast("date"))
    out = out.where(F.col(target).isNotNull())
    if group_mode is not None:
        out = out.where(group_filter("CIE_GRUPO", group_mode))
    out = out.select(*cols)
    if limit:
        keys = [F.col(k) for k in roles.keys if k in cols] or [F.col(cols[0])]
        out = limit_ordered(out, limit, list(order) if order else keys)
    return out


def load_by_ids(df: DataFrame, id_col: str, ids: DataFrame | Sequence, roles: ColumnRoles = DEFAULT_ROLES) -> DataFrame:
    """A3: rows whose ``id_col`` is in ``ids`` (a DataFrame or a list), without
    leak and target columns.  A semi join with the id set replaces the giant
    ``IN ('..', ..)`` text; Spark broadcasts the set if its size allows."""
    if not isinstance(ids, DataFrame):
        ids = df.sparkSession.createDataFrame([(i,) for i in ids], [id_col])
    ids = ids.select(id_col).distinct()
    roles = roles if roles.numeric else roles.with_numeric_from(df)
    feats = [c for c in roles.feature_columns(df) if c not in roles.targets and not reveals_label(c)]
    return df.join(ids, id_col, "left_semi").select(*feats)


def load_for_scoring(df: DataFrame, as_of, date_from=None, date_to=None, last_days: int | None = None,
                     label: str = "TARGET_APRUEBA", date_col: str = "FECHA_RECEPCION") -> DataFrame:
    """A4: rows to score.

    * default mode (no dates, or both dates equal to the day before ``as_of``,
      or ``last_days`` of 1): rows with no verdict (``label`` NULL), any date;
    * period mode: ``date_col`` BETWEEN the dates, or the ``last_days`` days
      ending the day before ``as_of``.

    The strict diagnosis-group filter applies; if it leaves no row while
    candidates exist, the relaxed filter is used.  Both checks are
    ``isEmpty()`` probes (a limit-1 job), never a full count.
    """
    yesterday = F.date_sub(F.lit(as_of).cast("date"), 1)
    if last_days is not None and last_days > 1:
        date_to = "__y"
        cond = F.col(date_col).between(F.date_sub(yesterday, last_days - 1), yesterday)
    elif date_from is not None and date_to is not None and not _is_yesterday(date_from, date_to, as_of):
        cond = F.col(date_col).between(F.lit(date_from).cast("date"), F.lit(date_to).cast("date"))
    else:
        cond = F.col(label).isNull()
    base = df.where(cond)
    strict = base.where(group_filter("CIE_GRUPO", "strict"))
    if strict.isEmpty() and not base.isEmpty():
        return base.where(group_filter("CIE_GRUPO", "relaxed"))
    return strict


def _is_yesterday(date_from, date_to, as_of) -> bool:
    import datetime as dt
    y = (dt.date.fromisoformat(str(as_of)[:10]) - dt.timedelta(days=1)).isoformat()
    return str(date_from)[:10] == y and str(date_to)[:10] == y
