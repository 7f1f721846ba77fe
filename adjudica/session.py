"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The static broadcast threshold stays at Spark's default; AQE re-plans
    # joins from real shuffle sizes.  Explicit broadcasts are left to sides
    # whose size is bounded by structure (one row per feature or class).
}


def get_session(master: str | None = None, app: str = "adjudica",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings this library expects.

    On a cluster ``master`` is left to spark-submit; tests pass ``local[*]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # noqa: BLE001  (Spark Connect)
        pass
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder for checkpoints.

    A folder that the application has set on its context stays; else
    ``spark.checkpoint.dir`` names it.  Only a local master, where driver
    and executors are one machine, may go without: ``fallback`` or
    ``spark-checkpoints`` in the working folder serves then.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        d = fallback or os.path.join(os.getcwd(), "spark-checkpoints")
    sc.setCheckpointDir(d)
    return d


def cut_lineage(df):
    """Reliable checkpoint (survives executor loss; never localCheckpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df, name="rows"):
    """The rows as Parquet in the shared folder, read again: for tables that grow with the input, as a checkpoint keeps
    several times their bytes.  A column without a type, which Parquet doesn't have, makes it a checkpoint."""
    if "void" in dict(df.dtypes).values():
        return cut_lineage(df)
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
