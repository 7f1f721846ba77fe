"""Column rules (B1-B15) on hand-made rows with the FIXTURES edge cases."""

import datetime as dt

from pyspark.sql import functions as F

from adjudica.functions import expr as B

D = dt.date


def test_sentinel_clamp_and_late_flag(spark):
    df = spark.createDataFrame([
        (D(2024, 1, 10), D(1900, 1, 1), D(2024, 1, 20)),
        (D(2024, 1, 10), D(2024, 3, 1), None),
        (D(2024, 1, 10), D(2023, 11, 1), D(2023, 11, 3)),
        (D(2024, 1, 10), None, D(2024, 1, 15)),
    ], "rec date, emp date, env date")
    out = df.select(B.clean_sentinel_date("emp").alias("c"),
                    B.clamped_days(B.clean_sentinel_date("emp"), F.col("rec")).alias("d"),
                    B.late_flag("env", "emp").alias("late")).collect()
    assert [r["c"] for r in out] == [None, D(2024, 3, 1), D(2023, 11, 1), None]
    assert [r["d"] for r in out] == [None, 30, -30, None]
    assert [r["late"] for r in out] == [None, None, 0, None]


def test_gender_and_code_fallbacks(spark):
    df = spark.createDataFrame([(" femenino ", "", 0, 3), ("M", "X", 9, None), ("x", None, None, 8),
                                (None, "", 0, None), ("Fem", "", 5, 1)],
                               "g string, lab string, code long, lic long")
    out = df.select(B.standardise_category("g", B.GENDER_SYNONYMS).alias("g"),
                    B.standardise_category("g", B.GENDER_SYNONYMS, "keep").alias("gk"),
                    B.code_label_fallback("lab", "lic").alias("lab"),
                    B.code_fallback("code", "lic").alias("code")).collect()
    assert [r["g"] for r in out] == ["Fem", "Masc", None, None, "Fem"]
    assert [r["gk"] for r in out] == ["Fem", "Masc", "x", None, "Fem"]
    assert [r["lab"] for r in out] == ["MATERNAL", "X", "OTRO", "OTRO", "ENFERMEDAD COMUN"]
    assert [r["code"] for r in out] == [3, 9, 8, 0, 5]


def test_id_range_flag_malformed_and_null(spark):
    df = spark.createDataFrame([("48123456-K",), ("49999999-1",), ("50000000-1",), ("abc-1",), (None,),
                                ("",), ("48000000",)], "rut string")
    assert [r[0] for r in df.select(B.id_range_flag("rut")).collect()] == [1, 1, 0, 0, 0, 0, 1]


def test_month_diff_and_episode_days(spark):
    df = spark.createDataFrame([
        (D(2024, 1, 31), D(2023, 12, 1), "S", None, dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 19)),
        (D(2024, 3, 1), D(2024, 2, 29), "S", D(2023, 12, 1), dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 19)),
        (D(2024, 3, 1), D(2024, 2, 29), "N", D(2023, 12, 1), dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 19)),
    ], "a date, b date, cont string, ep date, ini timestamp, fin timestamp")
    out = df.select(B.month_diff("a", "b").alias("m"), B.episode_days("cont", "ep", "ini", "fin").alias("e"),
                    B.episode_start("ep", "ini").alias("s")).collect()
    assert [r["m"] for r in out] == [1, 1, 1]
    assert [r["e"] for r in out] == [10, 50, 10]
    assert out[0]["s"] == D(2024, 1, 10)


def test_safe_ratio_and_group_filter(spark):
    df = spark.createDataFrame([(5, 0, "PARTO"), (5, 2, ""), (5, None, " "), (None, 4, None), (1, 4, "OTRA")],
                               "n long, d long, g string")
    out = df.select(B.safe_ratio("n", "d").alias("r"), B.group_filter("g", "strict").alias("s"),
                    B.group_filter("g", "relaxed").alias("x")).collect()
    assert [r["r"] for r in out] == [0.0, 2.5, None, None, 0.25]
    assert [bool(r["s"]) for r in out] == [False, False, False, False, True]
    assert [bool(r["x"]) for r in out] == [False, True, True, True, True]


def test_targets_rule_order(spark):
    rows = [("EN VISACION", 5, 5, None, None, None, None, "OTRA", 0, None),
            ("RESUELTA", 5, 5, None, None, None, None, "PARTO", 0, None),
            ("RESUELTA", 0, 5, "SIN OBSERVACIONES", None, "RATIFICA", D(2024, 1, 1), "OTRA", 1, None),
            ("RESUELTA", 3, 5, None, "X", "deniega", D(2024, 1, 1), "OTRA", 0, None),
            ("RESUELTA", None, 5, None, None, None, None, "OTRA", 0, None)]
    df = spark.createDataFrame(rows, "ESTADO_LM string, I_DIASAUTORIZADOS long, DIASSOLICITADO long, "
                                     "REC_GLS_CAUMOD string, PERITAJE_FALLO_1 string, RESOLUCION_COMPIN string, "
                                     "FECHA_EMISION_DT date, CIE_GRUPO string, PASO_FASTTRACK int, "
                                     "PERITAJE_LM_PERITADA int")
    df = df.withColumn("CTD_ENVIA_PERITAJE", F.lit(None).cast("long")) \
           .withColumn("CTD_ENVIA_INFORME_MEDICO", F.lit(None).cast("long"))
    t = B.derive_targets(df).collect()
    assert [r["TARGET_FT3"] for r in t] == [None, None, None, 0, 0]
    assert [r["TARGET_FT2"] for r in t] == [None, None, 1, 0, None]
    assert [r["TARGET_APRUEBA"] for r in t] == [None, 1, 0, 0, None]
    assert [r["TARGET_RATIFICA"] for r in t] == [None, None, 1, 0, None]
    assert [r["TARGET_RECHAZA"] for r in t] == [None, 0, 1, 0, 0]
