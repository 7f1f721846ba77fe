"""Checks on the keys of a merge source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assert_unique(df: DataFrame, keys: list[str], what: str = "source") -> None:
    """Fail when ``keys`` repeat in ``df`` (a MERGE would error on multiple matches)."""
    dup = df.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"{what} has duplicate keys {keys}: {dup[0].asDict()}")
