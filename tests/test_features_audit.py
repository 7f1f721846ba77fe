"""Feature transforms, IV and audits on small frames."""

import datetime as dt

from pyspark.sql import functions as F

from adjudica.operators import audit as A
from adjudica.operators import features as X
from adjudica.operators import iv as V
from adjudica.operators.stats import exact_quantiles, unpivot


def test_exact_quantiles_match_numpy_linear(spark):
    import numpy as np
    vals = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0, 5.0, 3.0, 5.0]
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "x double")
    q = exact_quantiles(unpivot(df, ["x"]), ["feature"], "value", [0.1, 0.25, 0.5, 0.9]).first()
    for i, p in enumerate([0.1, 0.25, 0.5, 0.9]):
        assert abs(q[f"q{i}"] - float(np.quantile(vals, p))) < 1e-12
    assert q["n"] == len(vals)


def test_constant_and_low_cardinality_numeric_bins(spark):
    rows = [(1.0, float(i % 3), i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "const double, few double, y int")
    w = V.woe_numeric(df, ["const", "few"], "y")
    bins = {r["feature"]: r["n"] for r in w.groupBy("feature").agg(F.count("*").alias("n")).collect()}
    assert bins["const"] == 1           # single edge: one bin
    assert bins["few"] == 2             # edges [0, 1, 2] after de-duplication: [0, 1] and (1, 2]


def test_date_features_weekday_and_proxy(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), None), (dt.date(2022, 1, 2), None)],
                               "FECHA_RECEPCION date, VACIA date")
    out = X.date_features(df, ["VACIA", "FECHA_RECEPCION", "AUSENTE"]).collect()
    r = out[0]
    assert r["FECHA_RECEPCION_dayofweek"] == 0 and r["FECHA_RECEPCION_days_since_ref"] == 730
    assert r["VACIA_year"] == 2024                 # wholly NULL before the proxy: proxy parts
    assert r["AUSENTE_days_since_ref"] == 730      # absent after the proxy: constants


def test_label_encode_unseen_goes_to_missing(spark):
    fit = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    d = X.label_encode_fit(fit, ["c"])
    new = spark.createDataFrame([("a",), ("zzz",), (None,)], "c string")
    got = [r["c_encoded"] for r in X.label_encode_transform(new, d, ["c"]).orderBy("c_encoded").collect()]
    # classes sorted: MISSING=0, a=1, b=2 ; unseen -> MISSING
    assert sorted(got) == [0, 0, 1]


def test_fairness_disparity(spark):
    df = spark.createDataFrame([("A", 1, 1), ("A", 0, 1), ("B", 1, 0), ("B", 1, 0), (None, 1, 1)],
                               "g string, y int, p int")
    rows = {r["GRUPO"]: r for r in A.fairness_audit(df, "g", "y", "p").collect()}
    assert set(rows) == {"A", "B"}
    assert rows["A"]["TASA_POSITIVOS_PRED"] == 1.0 and rows["B"]["TASA_POSITIVOS_PRED"] == 0.0
    assert rows["A"]["VIOLACION"] is True and rows["B"]["PRECISION"] == 0.0


def test_ks_identical_samples_no_drift(spark):
    a = spark.createDataFrame([(float(i),) for i in range(50)], "x double")
    r = A.drift_ks(a, a, ["x"]).first()
    assert r["ESTADISTICO"] == 0.0 and r["P_VALOR"] == 1.0 and r["DRIFT"] is False


def test_missing_profile_counts_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "c")], "x double, s string")
    got = {r["COLUMNA"]: r["N_FALTANTES"] for r in A.missing_profile(df).collect()}
    assert got == {"x": 2, "s": 1}


def test_predictions_contract(spark):
    from adjudica.functions.contract import conform_to_contract, predictions_contract
    schema, limits = predictions_contract()
    assert len(schema.fields) == 43
    df = spark.createDataFrame([(" afiliado_rut ", "x" * 40, "12", None)],
                               "AFILIADO_RUT string, CIE_GRUPO string, DIASSOLICITADO string, SEMAFORO string") \
        .toDF(" afiliado_rut ", "cie_grupo", "DIASSOLICITADO", "SEMAFORO")
    out = conform_to_contract(df, schema, limits)
    r = out.first()
    assert out.columns == [f.name for f in schema.fields]
    assert len(r["CIE_GRUPO"]) == 30 and r["DIASSOLICITADO"] == 12 and r["SEMAFORO"] is None
    assert r["AFILIADO_RUT"] == " afiliado_r"   # values are not trimmed, only cut to the 11-char limit


def test_feature_model_save_load_roundtrip(spark):
    import tempfile
    from tests.conftest import SF
    d = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    lab = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic", "quality")
    docs = d.join(lab, "doc_id", "left")
    fm = X.FeatureModel(text=["text"], categorical=["lang", "source"], numeric=["n_chars"], binary=["toxic"],
                        doc_id="doc_id", min_df=2)
    fm.fit_transform(docs.where(F.col("quality").isNotNull()), exclude=["quality"])
    a = fm.transform(docs.drop("quality"))
    path = tempfile.mkdtemp(prefix="fm-", dir="/tmp") + "/model"
    fm.save(path)
    fm2 = X.FeatureModel.load(spark, path)
    b = fm2.transform(docs.drop("quality")).select(*a.columns)

    def rows(df):
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())
    assert rows(a) == rows(b)
    assert fm2.feature_names == fm.feature_names and fm2.sizes == fm.sizes


def test_model_save_load_and_feature_list(spark):
    import tempfile
    from adjudica.operators import model as K
    rows = [(i, float(i % 7), float((i * 3) % 5), 1 if i % 7 > 3 else 0) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y int")
    m = K.train_classifier(df, ["a", "b"], "y", params={"maxIter": 3, "maxDepth": 2})
    d = tempfile.mkdtemp(prefix="m-", dir="/tmp")
    K.save_model(m, d + "/model")
    s1 = sorted(map(tuple, K.score(m, df, ["id"]).collect()))
    s2 = sorted(map(tuple, K.score(K.load_model(d + "/model"), df, ["id"]).collect()))
    assert s1 == s2
    with open(d + "/features.txt", "w") as f:
        f.write("b\n\na\n")
    names = X.read_feature_list(spark, d + "/features.txt")
    assert names == ["b", "a"]
    assert X.select_features(df, names, keep=["id"]).columns == ["id", "b", "a"]


def test_tfidf_matches_python_brute_force(spark):
    import math
    import re
    from collections import Counter
    texts = ["Él comió 2 manzanas_rojas, él comió", "Der Hund läuft; der Hund bellt!", "a b c él comió",
             "Über über alles 123 456", "él comió manzanas", "der hund", "comió él", "x"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    vocab = X.tfidf_fit(df, "doc_id", "text", max_features=5, min_df=2, max_df=0.8)
    got = {r["doc_id"]: [round(r[f"text_tfidf_{i}"], 9) for i in range(5)]
           for r in X.tfidf_transform(df, vocab, "doc_id", "text", "text", 5).collect()}
    # brute force with Python's Unicode word tokens of >= 2 characters
    docs = []
    for t in texts:
        toks = re.findall(r"(?u)\b\w\w+\b", t.lower())
        docs.append(Counter(toks + [f"{a} {b}" for a, b in zip(toks, toks[1:])]))
    n = len(texts)
    dfc = Counter(term for d in docs for term in d)
    tot = Counter()
    for d in docs:
        tot.update(d)
    keep = [t for t in dfc if 2 <= dfc[t] <= 0.8 * n]
    top = sorted(sorted(keep), key=lambda t: -tot[t])[:5]
    terms = sorted(top)
    idf = {t: math.log((1 + n) / (1 + dfc[t])) + 1 for t in terms}
    for i, d in enumerate(docs):
        v = [d.get(t, 0) * idf[t] for t in terms]
        nr = math.sqrt(sum(x * x for x in v))
        want = [round(x / nr, 9) if nr else 0.0 for x in v]
        assert got[i] == want, (i, got[i], want)


def test_woe_numeric_matches_pandas_bins(spark):
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.integers(0, 6, 120), rng.normal(10, 3, 80).round(2)])
    y = (rng.random(200) < 0.6).astype(int)
    pdf = pd.DataFrame({"x": x.astype(float), "y": y})
    df = spark.createDataFrame(pdf)
    got = {r["bin"]: (r["n0"], r["n1"], round(r["woe"], 9))
           for r in V.woe_numeric(df, ["x"], "y").collect()}
    _, edges = pd.qcut(pdf["x"], q=10, retbins=True, duplicates="drop")
    binned = pd.cut(pdf["x"], bins=edges, include_lowest=True)
    ct = pd.crosstab(binned, pdf["y"])
    goods, bads = (pdf["y"] == 1).sum(), (pdf["y"] == 0).sum()
    want = {}
    for i, (_, row) in enumerate(ct.iterrows(), start=1):
        g = row.get(1, 0) / goods or 0.0001
        b = row.get(0, 0) / bads or 0.0001
        want[str(i)] = (int(row.get(0, 0)), int(row.get(1, 0)), round(float(np.log(g / b)), 9))
    assert got == want


def test_ks_statistic_matches_numpy(spark):
    import numpy as np
    rng = np.random.default_rng(5)
    a = rng.integers(0, 30, 300).astype(float)
    b = (rng.integers(0, 30, 170) + 2).astype(float)
    da = spark.createDataFrame([(float(v),) for v in a], "x double")
    db = spark.createDataFrame([(float(v),) for v in b], "x double")
    r = A.drift_ks(da, db, ["x"]).first()
    grid = np.union1d(a, b)
    fa = np.searchsorted(np.sort(a), grid, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), grid, side="right") / len(b)
    assert r["ESTADISTICO"] == round(float(np.max(np.abs(fa - fb))), 6)
