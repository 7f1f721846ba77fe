"""Daily increments driven by Structured Streaming (survey N1 trigger).

The reference runs its increment as a scheduled batch over "yesterday's"
claims.  When new claims land as files, the same ``run_increment`` can be
driven by a file stream: every micro-batch is one increment, processed with
``foreachBatch`` (exactly-once through the checkpoint in the shared folder
named by ``spark.checkpoint.dir``), and ``trigger(availableNow=True)`` turns
it into a catch-up batch job.  No stateful streaming operator is needed:
all state lives in the base / metrics / wide tables.
"""

from __future__ import annotations

import datetime
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..plans.increment import run_increment
from ..session import ensure_checkpoint_dir
from ..sources import sinks


def start_increment_stream(spark: SparkSession, input_path: str, schema: StructType, tables: dict[str, str],
                           services: Callable[[], DataFrame], exams: Callable[[], DataFrame],
                           monthly: Callable[[], dict] | None = None, name: str = "claims_increment",
                           available_now: bool = True):
    """Start a stream that applies ``run_increment`` to each batch of new claim files.

    ``tables`` maps ``base``, ``metrics`` and ``wide`` to parquet paths,
    partitioned by reception date (``base`` must exist; the others are
    created on the first batch).  Each batch's date range is its own
    min/max reception date; ``as_of`` is the day after the batch's last date.
    """
    ckpt = os.path.join(ensure_checkpoint_dir(spark), f"stream-{name}")

    def apply(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        rng = batch.agg(F.min("FECHA_RECEPCION").alias("lo"), F.max("FECHA_RECEPCION").alias("hi")).first()
        base = spark.read.parquet(tables["base"])
        wide = spark.read.parquet(tables["wide"]) if sinks.path_exists(spark, tables["wide"]) else None
        as_of = (rng["hi"] + datetime.timedelta(days=1)).isoformat()
        r = run_increment(batch, base, None, wide, services(), exams(), rng["lo"].isoformat(),
                          rng["hi"].isoformat(), as_of, monthly=monthly() if monthly else None,
                          keep_reception_date=True)
        # all three tables are partitioned by reception date: appends add
        # files to the increment's partitions, and the metrics upsert rewrites
        # only the partitions of this increment's claims
        sinks.append(r.new_base, path=tables["base"], partition_by=["FECHA_RECEPCION"])
        sinks.append(r.new_wide, path=tables["wide"], partition_by=["FECHA_RECEPCION"])
        sinks.upsert_partitions(spark, tables["metrics"], r.new_metrics, ["AFILIADO_RUT", "LCC_COMCOR", "LCC_COMCOD"],
                                "FECHA_RECEPCION")

    stream = spark.readStream.schema(schema).parquet(input_path)
    w = stream.writeStream.foreachBatch(apply).option("checkpointLocation", ckpt).queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 hour")
    return w.start()
