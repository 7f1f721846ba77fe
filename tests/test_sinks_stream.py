"""Sinks (A5, A7, A11) and the streaming increment driver."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from adjudica.sources import sinks


def _tmp():
    return tempfile.mkdtemp(prefix="adjudica-test-", dir="/tmp")


def test_refresh_append_and_nulls(spark):
    d = _tmp()
    df = spark.createDataFrame([(1, "nan", float("nan")), (2, "x", 1.0)], "k long, s string, v double")
    sinks.refresh_table(df, path=f"{d}/t")
    sinks.append_predictions(df, path=f"{d}/t")
    back = spark.read.parquet(f"{d}/t")
    assert back.count() == 4
    assert back.where(F.col("s").isNull()).count() == 1 and back.where(F.col("v").isNull()).count() == 1
    sinks.refresh_table(df.limit(1), path=f"{d}/t")
    assert spark.read.parquet(f"{d}/t").count() == 1


def test_export_report_csv(spark):
    d = _tmp()
    out = sinks.export_report({"resumen": spark.createDataFrame([("a", 1.0)], "m string, v double")}, d)
    back = spark.read.option("header", True).csv(out["resumen"])
    assert back.columns == ["m", "v"] and back.count() == 1


def test_increment_stream_available_now(spark):
    from adjudica.sources import analogues as an
    from adjudica.streaming.increments import start_increment_stream
    sf = "/root/testdata/sf0.001"
    d = _tmp()
    claims = an.claims_from_orders(spark, sf)
    base = claims.where(F.col("FECHA_RECEPCION") < F.lit("2001-01-01").cast("date"))
    base.write.partitionBy("FECHA_RECEPCION").parquet(f"{d}/base")
    new = claims.where(F.col("FECHA_RECEPCION") >= F.lit("2001-01-01").cast("date"))
    new.write.parquet(f"{d}/in")
    q = start_increment_stream(spark, f"{d}/in", claims.schema,
                               {"base": f"{d}/base", "metrics": f"{d}/metrics", "wide": f"{d}/wide"},
                               services=lambda: an.services_from_lineitem(spark, sf),
                               exams=lambda: an.exams_from_events(spark, sf), name="t" + os.path.basename(d))
    q.awaitTermination(300)
    assert spark.read.parquet(f"{d}/base").count() == claims.count()
    assert spark.read.parquet(f"{d}/wide").count() == new.count()
    assert spark.read.parquet(f"{d}/metrics").count() == new.count()


def test_upsert_partitions_touches_only_source_partitions(spark):
    import datetime as dt
    d = _tmp()
    t = spark.createDataFrame([(1, dt.date(2024, 1, 1), "a"), (2, dt.date(2024, 1, 2), "b"),
                               (3, dt.date(2024, 1, 3), "c")], "k long, day date, v string")
    sinks.upsert_partitions(spark, f"{d}/t", t, ["k"], "day")
    before = {f for f in os.listdir(f"{d}/t") if f.startswith("day=")}
    mtime = os.path.getmtime(f"{d}/t/day=2024-01-01")
    s = spark.createDataFrame([(2, dt.date(2024, 1, 2), "B"), (4, dt.date(2024, 1, 2), "d")], "k long, day date, v string")
    n = sinks.upsert_partitions(spark, f"{d}/t", s, ["k"], "day")
    assert n == 1
    got = sorted((r["k"], r["v"]) for r in spark.read.parquet(f"{d}/t").collect())
    assert got == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]
    assert {f for f in os.listdir(f"{d}/t") if f.startswith("day=")} == before
    assert os.path.getmtime(f"{d}/t/day=2024-01-01") == mtime   # untouched partition
