"""Writes that must not lose, swap or leak anything."""

import datetime as dt

from pyspark.sql import functions as F

from adjudica.functions.contract import map_output_columns
from adjudica.operators.claim_metrics import claim_metrics_15d
from adjudica.operators.joins import history_rank
from adjudica.operators.stats import cumulative
from adjudica.roles import DEFAULT_ROLES
from adjudica.sources import sinks


def test_upsert_keeps_rows_of_a_null_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    day = dt.date(2025, 1, 1)
    schema = "k string, v int, d date"
    sinks.upsert_partitions(spark, path, spark.createDataFrame([("k1", 1, None), ("k2", 2, None), ("k3", 3, day)], schema), ["k"], "d")
    sinks.upsert_partitions(spark, path, spark.createDataFrame([("k9", 9, None), ("k4", 4, day)], schema), ["k"], "d")
    assert {r["k"] for r in spark.read.schema(schema).parquet(path).collect()} == {"k1", "k2", "k3", "k4", "k9"}


def test_upsert_of_null_partitions_only(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k string, v int, d date"
    for k in ("a", "b"):
        sinks.upsert_partitions(spark, path, spark.createDataFrame([(k, 1, None)], schema), ["k"], "d")
    assert {r["k"] for r in spark.read.schema(schema).parquet(path).collect()} == {"a", "b"}


def test_outcome_columns_are_no_features(spark):
    d = spark.createDataFrame([(1, 2, 3, 4, 5)], "COT_EDAD int, TARGET_APRUEBA int, I_DIASAUTORIZADOS int, PASO_FASTTRACK int, X int")
    assert DEFAULT_ROLES.with_numeric_from(d).numeric == ["COT_EDAD", "X"]


def test_existing_output_columns_keep_their_values(spark):
    d = spark.createDataFrame([("p", "own"), ("q", None)], "PRESTADOR_RUT string, LCC_MEDRUT string")
    assert [r["LCC_MEDRUT"] for r in map_output_columns(d).orderBy("PRESTADOR_RUT").collect()] == ["own", "q"]


def test_ratio_counts_claims_with_a_verdict(spark):
    t = dt.date(2025, 1, 10)
    probes = spark.createDataFrame([("p", 1, 1, t)], "AFILIADO_RUT string, LCC_COMCOR long, LCC_COMCOD long, FECHA_RECEPCION date")
    e = dt.date(2025, 1, 5)
    history = spark.createDataFrame(
        [("p", 7, e, None, "RATIFICA", 0, 1), ("p", 8, e, e, "DENIEGA", 0, 1)],
        "AFILIADO_RUT string, LCC_COMCOR long, FECHA_RECEPCION date, FECHA_RESOLUCION_COMPIN date, RESOLUCION_COMPIN string, F_DIASAUTORIZADOS int, DIASSOLICITADO int")
    assert claim_metrics_15d(probes, history).first()["RATIO_APROBACION_U15D"] == 0.5


def test_history_rank_of_null_keys(spark):
    schema = "p string, d date, n long"
    new = spark.createDataFrame([(None, dt.date(2025, 1, 2), 1), ("a", None, 2), ("a", dt.date(2025, 1, 2), 3)], schema)
    history = spark.createDataFrame([("a", dt.date(2025, 1, 1), 9), ("a", dt.date(2025, 1, 1), None)], schema)
    assert sorted(r["RN_AFILIADO_HIST"] for r in history_rank(new, history, "p", ["d", "n"]).collect()) == [1, 1, 2]


def test_one_outlier_leaves_the_other_buckets_filled(spark):
    d = spark.range(20_000).select(F.lit("f").alias("g"), F.when(F.col("id") == 0, 1e12).otherwise(F.col("id").cast("double")).alias("x"), F.lit(1).alias("c"))
    got = cumulative(d, ["g"], "x", ["c"], 1024)
    assert got.agg(F.max("cum_c")).first()[0] == 20_000 and got.where("x = 5000").first()["cum_c"] == 5000
