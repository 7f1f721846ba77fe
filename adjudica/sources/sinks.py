"""Table writes (survey A5, A6, A7, A11).

All writes are plain DataFrame writers: a failed task is retried by Spark
and the job commit protocol publishes a table only when every task has
finished, so lost executors do not leave partial output.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def refresh_table(df: DataFrame, name: str | None = None, path: str | None = None,
                  partition_by: list[str] | None = None, fmt: str = "parquet") -> None:
    """A5: full rebuild (CREATE OR REPLACE TABLE AS SELECT)."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path is not None:
        w.save(path)
    else:
        w.saveAsTable(name)


def append(df: DataFrame, name: str | None = None, path: str | None = None,
           partition_by: list[str] | None = None, fmt: str = "parquet") -> None:
    """A6 write side: append rows (computed by ``operators.merge.append_new``).

    Columns go to the table's columns of the same name, whatever their order; a column that the table lacks, or that
    the rows lack, is an error.  An existing catalog table keeps its own partitioning.
    """
    if path is None and df.sparkSession.catalog.tableExists(name):
        columns = df.sparkSession.table(name).columns
        if {c.lower() for c in columns} != {c.lower() for c in df.columns}:
            raise ValueError(f"{name} has columns {columns}, the rows have {df.columns}")
        df.select(*[F.col(f"`{c}`") for c in columns]).write.mode("append").insertInto(name)
        return
    w = df.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path) if path is not None else w.saveAsTable(name)


def normalise_nulls(df: DataFrame) -> DataFrame:
    """NaN in floating columns and the text placeholders 'nan', 'None',
    '<NA>', 'NaT' become real NULLs before saving."""
    cols = []
    for c, t in df.dtypes:
        col = F.col(c)
        if t in ("double", "float"):
            cols.append(F.when(F.isnan(col), None).otherwise(col).alias(c))
        elif t == "string":
            cols.append(F.when(col.isin("nan", "None", "<NA>", "NaT"), None).otherwise(col).alias(c))
        else:
            cols.append(col)
    return df.select(*cols)


def append_predictions(df: DataFrame, name: str | None = None, path: str | None = None) -> None:
    """Append predictions with NULLs normalised (replaces row-batched INSERTs)."""
    append(normalise_nulls(df), name=name, path=path)


def export_report(frames: Mapping[str, DataFrame], path: str, single_file: Sequence[str] = ()) -> dict[str, str]:
    """Each report frame as a CSV folder with a header under ``path``.

    The frames named in ``single_file`` become one part file each; that is
    for summaries of a few rows, as one task writes it.  Lists of claims keep
    as many part files as their plan has tasks.
    """
    out = {}
    for name, df in frames.items():
        target = f"{path.rstrip('/')}/{name}"
        (df.coalesce(1) if name in single_file else df).write.mode("overwrite").option("header", True).csv(target)
        out[name] = target
    return out


def upsert_partitions(spark, path: str, source: DataFrame, keys: list[str], partition_col: str,
                      merge=None, **merge_kw) -> int:
    """A8/A9 write side for partitioned tables: merge ``source`` into the
    parquet table at ``path`` rewriting only the partitions it touches.

    A key's partition value must not change between runs (for claims: the
    reception date).  The target is restricted to the source's distinct
    partition values by a semi join (Spark prunes the partitions at run
    time), rows with a NULL partition value are restricted on their own, and
    only what was touched is merged (``merge`` defaults to ``merge_upsert``)
    and written back with dynamic partition overwrite.  The partition
    column is read with the source's type, which file names can't tell.
    Returns the number of partitions rewritten.  A new table is created from
    the source when ``path`` does not exist yet.  A writer that stops while
    partitions are replaced leaves some of them replaced; ``versioned.upsert``
    publishes all or nothing.
    """
    import os
    import uuid
    from ..operators.merge import merge_upsert
    merge = merge or merge_upsert
    touched = source.select(partition_col).distinct()
    n = touched.count()
    if not path_exists(spark, path):
        source.write.mode("overwrite").partitionBy(partition_col).parquet(path)
        return n
    kind = source.schema[partition_col]
    found = spark.read.parquet(path).schema
    target = spark.read.schema(StructType([kind if f.name == partition_col else f for f in found.fields])).parquet(path)
    same = target.join(touched, partition_col, "left_semi")
    if not touched.where(F.col(partition_col).isNull()).isEmpty():
        same = same.unionByName(target.where(F.col(partition_col).isNull()))
    merged = merge(same.select(*target.columns), source.select(*target.columns), keys, **merge_kw)
    # read-then-overwrite of the same partitions: stage the merged rows first, in a folder of this run's own
    staged = f"{path.rstrip('/')}/../_staging_{os.path.basename(path.rstrip('/'))}_{uuid.uuid4().hex}"
    merged.write.partitionBy(partition_col).parquet(staged)
    spark.read.schema(target.schema).parquet(staged).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(path)
    return n


def path_exists(spark, path: str) -> bool:
    """Existence check through the Hadoop file system of ``path`` (local,
    HDFS or object store alike)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
