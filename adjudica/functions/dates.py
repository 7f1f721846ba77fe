"""Date helpers shared by operators (survey H, B7, B16)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_number(c: Column) -> Column:
    """Days since 1970-01-01 of a date/timestamp column (integer ordering key)."""
    return F.unix_date(F.to_date(c))


def month_diff(a: Column, b: Column) -> Column:
    """Calendar month difference a - b as year*12+month (not months_between)."""
    return (F.year(a) * 12 + F.month(a)) - (F.year(b) * 12 + F.month(b))


def day_literal(x, shift: int = 0):
    import datetime as _dt
    d = _dt.date.fromisoformat(str(x)[:10]) + _dt.timedelta(days=shift)
    return F.lit(d)  # a DATE literal: compared with a DATE column as is, cast only on the literal side otherwise


def date_window(c: Column, date_from=None, date_to=None) -> Column:
    """Inclusive day range written as a half-open range on the raw column.

    ``c >= from AND c < to + 1 day`` with DATE literals keeps the predicate on
    the stored column (no function or cast around it), so parquet min/max
    pushdown and partition pruning apply to DATE and TIMESTAMP columns alike.
    """
    cond = F.lit(True)
    if date_from is not None:
        cond = cond & (c >= day_literal(date_from))
    if date_to is not None:
        cond = cond & (c < day_literal(date_to, 1))
    return cond


def period_text(c: Column, fmt: str = "MMyyyy") -> Column:
    """PERIODO text (``MMyyyy``) of a date."""
    return F.date_format(c, fmt)


def period_key(period: Column) -> Column:
    """Chronological integer yyyymm from ``MMyyyy`` text (order-preserving)."""
    return F.substring(period, 3, 4).cast("int") * 100 + F.substring(period, 1, 2).cast("int")
