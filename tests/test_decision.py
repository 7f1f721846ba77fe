"""Thresholds, lights and metrics against brute force on small frames."""

import itertools
import random

from pyspark.sql import functions as F

from adjudica.operators import decision as D
from adjudica.operators.classification import classification_metrics


def _rows(n=400, seed=3):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        p = round(rnd.random(), 3)
        y = rnd.choice([0, 1, 1, None])
        out.append((i, p, y, rnd.randint(0, 40), rnd.choice([0, 0, 0, 1])))
    return out


def _brute(rows, green, yellow, review, rate, fn=20000):
    best = None
    for g, y in itertools.product(green, yellow):
        if y >= g:
            continue
        cost = 0.0
        for _, p, lab, d, _ in rows:
            if p >= g / 1000 and lab == 0:
                gross = d * 59000.0
                cost += max(gross * (1 - rate) - review, 0.0) if rate > 0 else gross
            elif p < y / 1000 and lab == 1:
                cost += fn
            if y / 1000 <= p < g / 1000:
                cost += review
        cost = round(cost, 6)
        if best is None or cost < best[0]:
            best = (cost, g, y)
    return best


def test_two_thresholds_equal_brute_force(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "id long, PROBABILIDAD_APROBACION double, TARGET_FT3 int, DIASSOLICITADO long, LEAK_FT int")
    grid = ((500, 560), (100, 140))
    for rate, review in ((0.0, 5000), (0.79, 500)):
        r = D.optimise_two_thresholds(df, review=review, reversal_rate=rate, grid=grid).first()
        cost, g, y = _brute(rows, range(500, 561), range(100, 141), review, rate)
        assert (round(r["UMBRAL_VERDE"] * 1000), round(r["UMBRAL_AMARILLO"] * 1000)) == (g, y)
        assert abs(r["COSTO_TOTAL"] - cost) < 1e-3


def test_score_exactly_on_threshold_is_green(spark):
    df = spark.createDataFrame([(1, 0.94, 5, 10, 0), (2, 0.9399, 5, 10, 0), (3, 0.16, 5, 10, 0),
                                (4, 0.97, 21, 10, 0), (5, 0.97, 5, 30, 0), (6, 0.97, None, None, 0),
                                (7, 0.2, 5, 10, 1), (8, float("nan"), 1, 1, 0), (9, None, 1, 1, 0)],
                               "id long, PROBABILIDAD_APROBACION double, DIASSOLICITADO long, "
                               "EPISODIO_ACUM_DIAS long, LEAK_FT int")
    got = {r["id"]: r["SEMAFORO"] for r in D.assign_light(df, 0.94, 0.16).collect()}
    assert got == {1: "VERDE", 2: "AMARILLO", 3: "AMARILLO", 4: "AMARILLO", 5: "AMARILLO", 6: "VERDE",
                   7: "FT1_APROBADO", 8: "ROJO", 9: "ROJO"}
    no_prior = {r["id"]: r["SEMAFORO"] for r in D.assign_light(df, 0.94, 0.16, use_prior_class=False).collect()}
    assert no_prior[7] == "AMARILLO"


def test_auc_with_ties_matches_mann_whitney(spark):
    rows = [(0.1, 0), (0.4, 1), (0.4, 0), (0.8, 1), (0.8, 1), (0.35, 0), (0.9, 0)]
    df = spark.createDataFrame(rows, "s double, y int")
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    mw = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg) / (len(pos) * len(neg))
    r = classification_metrics(df, "s", "y").first()
    assert abs(r["AUC"] - round(mw, 6)) < 1e-9
    assert (r["TP"], r["FP"], r["FN"], r["TN"]) == (2, 1, 1, 3)


def test_empty_zone_precision_is_zero(spark):
    df = spark.createDataFrame([(0.5, 1)], "PROBABILIDAD_APROBACION double, TARGET_FT3 int")
    r = D.zone_precision(df, 0.9, 0.1).first()
    assert r["PRECISION_VERDE"] == 0.0 and r["CASOS_VERDE"] == 0
