"""Parquet tables that are published whole or not at all (survey A8, A9 write side).

A table is a folder of data folders, never changed once written, and of small version files ``_versions/<n>.json`` that
say which folder holds which partition (a table without a partition column is one partition).  An upsert writes the
touched partitions into a new data folder and then creates the next version file; untouched partitions stay where they are.
A reader takes the newest complete version, so it sees the table before or after an upsert, wherever a writer stops.
Creating a version file fails if it is there already: of two upserts at once the second one is told, and changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.merge import merge_upsert

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


class PublishConflict(RuntimeError):
    """Another writer published a version in the meantime."""


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _load(spark: SparkSession, path: str, version: int) -> dict | None:
    p, fs = _fs(spark, f"{path}/_versions/{version:012d}.json")
    stream = fs.open(p)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        return json.loads(text)
    except ValueError:
        return None  # its writer stopped before the file was whole


def _numbers(spark: SparkSession, path: str) -> list[int]:
    p, fs = _fs(spark, f"{path}/_versions")
    if not fs.exists(p):
        return []
    return sorted(int(s.getPath().getName().split(".")[0]) for s in fs.listStatus(p) if s.getPath().getName().endswith(".json"))


def current(spark: SparkSession, path: str) -> tuple[int, dict] | None:
    """(number, content) of the newest complete version; None before the first one."""
    for n in reversed(_numbers(spark, path)):
        if (found := _load(spark, path, n)) is not None:
            return n, found
    return None


def _publish(spark: SparkSession, path: str, version: int, content: dict) -> None:
    p, fs = _fs(spark, f"{path}/_versions/{version:012d}.json")
    try:
        out = fs.create(p, False)
    except Exception as e:
        raise PublishConflict(f"version {version} of {path} is there already") from e
    try:
        out.write(bytearray(json.dumps(content), "utf-8"))
    finally:
        out.close()


def _frame(spark: SparkSession, path: str, content: dict, parts: Sequence[str] | None = None) -> DataFrame | None:
    folders = sorted({f for k, f in content["parts"].items() if parts is None or k in parts})
    if not folders:
        return None
    schema = StructType.fromJson(content["schema"])
    column = content["partition"]
    if column is None:
        return spark.read.schema(schema).parquet(*[f"{path}/{f}" for f in folders])
    frames = {}
    for key, folder in content["parts"].items():
        if parts is None or key in parts:
            frames.setdefault(folder.split("/")[0], []).append(f"{path}/{folder}")
    out = None
    for data, paths in sorted(frames.items()):  # partitions written together are read together
        df = spark.read.schema(schema).option("basePath", f"{path}/{data}").parquet(*paths).select(*schema.names)
        out = df if out is None else out.unionByName(df)
    return out


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest version, or the one named."""
    found = current(spark, path) if version is None else (version, _load(spark, path, version))
    if found is None or found[1] is None:
        raise FileNotFoundError(path)
    df = _frame(spark, path, found[1])
    return df if df is not None else spark.createDataFrame([], StructType.fromJson(found[1]["schema"]))


def upsert(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], partition_col: str | None = None,
           merge: Callable[..., DataFrame] = merge_upsert, **merge_kw) -> int:
    """Merges ``source`` into the table (``merge``: ``merge_upsert`` or ``merge_first_write_wins``) and publishes the next
    version; returns its number.  The first upsert creates the table.  With ``partition_col`` only the partitions that
    ``source`` touches are read and written; a key's partition value must not change between runs."""
    path = path.rstrip("/")
    found = current(spark, path)
    taken = _numbers(spark, path)
    version, content = (taken[-1] + 1 if taken else 1), (found[1] if found else None)
    if content is not None and content["partition"] != partition_col:
        raise ValueError(f"{path} is partitioned by {content['partition']}")
    label = F.coalesce(F.col(partition_col).cast("string"), F.lit(NULL_PARTITION)) if partition_col else F.lit("")
    # the names of the touched partitions: as many as an increment has days
    touched = [r[0] for r in source.select(label.alias("k")).distinct().collect()]
    target = _frame(spark, path, content, touched) if content else None
    if target is None:
        merged = source
        if content:
            merged = source.select(*StructType.fromJson(content["schema"]).names)
    else:
        merged = merge(target, source.select(*[c for c in target.columns if c in source.columns]), list(keys), **merge_kw).select(*target.columns)
    data = f"data-{uuid.uuid4().hex}"
    writer = merged.write.partitionBy(partition_col) if partition_col else merged.write
    writer.parquet(f"{path}/{data}")
    parts = dict(content["parts"]) if content else {}
    if partition_col:
        root, fs = _fs(spark, f"{path}/{data}")
        unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        for s in fs.listStatus(root):
            name = s.getPath().getName()
            if name.startswith(f"{partition_col}="):
                parts[unescape(name.split("=", 1)[1])] = f"{data}/{name}"
    else:
        parts[""] = data
    _publish(spark, path, version, {"partition": partition_col, "schema": merged.schema.jsonValue(), "parts": parts})
    return version
