"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed value: the characters that separate words, as a Java / Python character class body.
SPACE_CLASS = r"\x20\x09-\x0D"
# Fixed value: the same characters, literally (for trimming).
SPACE_CHARS = " \t\n\x0b\x0c\r"
# Rows of labels whose crc32(doc_id as text) falls in remainder 0 of this many are never used for learning.
FOLDS = 5


def importable(spark: SparkSession) -> None:
    """Python workers get this repository's folder on their path, as the driver has it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), root]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the ids kept for evaluation: crc32(id as text) mod 5 is 0 (a null id counts as held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``, the folder that driver and executors share.

    Only a local master may go without that setting: driver and executors are then one machine, and
    ``spark-checkpoints`` in the working folder serves.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "spark-checkpoints"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: computed once, kept in the shared folder, readable after the loss of an executor."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_folder(df.sparkSession, "lineage"))
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str = "step") -> DataFrame:
    """The rows written as Parquet into the shared folder and read again: like ``cut``, but the planner knows their true
    size, whatever it had estimated for the plan behind them, so a loop of such steps keeps plans (and estimates) small."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_partitions(df: DataFrame, *keys: str) -> DataFrame:
    """The rows dealt to range partitions of the keys and sorted there, plus ``part`` (long, the partition's number, which
    follows the keys' order) and ``local`` (long, the row's number in it). Rows of equal keys may be split up."""
    placed = df.withColumn("_tie", F.monotonically_increasing_id())
    ordered = placed.repartitionByRange(*keys, "_tie").sortWithinPartitions(*keys, "_tie").drop("_tie")
    numbered = ordered.withColumn("_row", F.monotonically_increasing_id())
    return numbered.select(*df.columns, F.shiftright("_row", 33).alias("part"), F.col("_row").bitwiseAND((1 << 33) - 1).alias("local"))


def bases(sizes: DataFrame, order: str, *counts: str) -> DataFrame:
    """``sizes`` (a row for each partition, so one window task holds no more rows than there are partitions) with
    ``first_<count>``: the prefix sum of each count before the row, in the order of ``order``."""
    before = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("*", *[F.coalesce(F.sum(c).over(before), F.lit(0)).cast("long").alias(f"first_{c}") for c in counts])


def bounded_sample(labels: DataFrame, label: str, limit: int) -> DataFrame:
    """At most ``limit`` labelled training ids (doc_id, label), the same for the same rows.

    Held-out ids and null labels never enter. An id that carries both labels is left out. Order is that of a
    hash of the id, so the sample is independent of file order.
    """
    ids = (
        labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("high"))
        .where(F.col("label") == F.col("high")).drop("high")
    )
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def sample_texts(documents: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """(doc_id, label, text) of the bounded sample; the ids (at most ``limit`` rows) are the broadcast side.

    Of several rows with one id the least text is taken, so there are never more than ``limit`` rows.
    """
    ids = bounded_sample(labels, label, limit)
    docs = documents.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return docs.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
