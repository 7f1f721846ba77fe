"""Versioned publishing, resumable tuning, exact KS p-values, encodings and term counts without moving text."""

import datetime as dt
import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from adjudica.operators import audit as A
from adjudica.operators import features as X
from adjudica.operators import merge as M
from adjudica.operators import model as K
from adjudica.operators.stats import ks_exact_pvalue
from adjudica.sources import versioned as V

D = dt.date


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_versioned_upsert_is_seen_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    schema = "k long, day date, v string"
    V.upsert(spark, path, spark.createDataFrame([(1, D(2024, 1, 1), "a"), (2, D(2024, 1, 2), "b"), (3, None, "c")], schema), ["k"], "day")
    before = rows(V.read(spark, path))
    new = spark.createDataFrame([(2, D(2024, 1, 2), "B"), (4, D(2024, 1, 2), "d"), (5, None, "e")], schema)

    def stop(*args):
        raise RuntimeError("the writer stops here")

    with monkeypatch.context() as m:
        m.setattr(V, "_publish", stop)  # data written, version not
        with pytest.raises(RuntimeError):
            V.upsert(spark, path, new, ["k"], "day")
    assert rows(V.read(spark, path)) == before
    (tmp_path / "t" / "_versions" / "000000000002.json").write_text('{"parts": {"2024-')  # a writer stopped inside the version file
    assert rows(V.read(spark, path)) == before
    assert V.upsert(spark, path, new, ["k"], "day") == 3
    want = [(1, D(2024, 1, 1), "a"), (2, D(2024, 1, 2), "B"), (3, None, "c"), (4, D(2024, 1, 2), "d"), (5, None, "e")]
    assert rows(V.read(spark, path)) == sorted(want, key=repr) and rows(V.read(spark, path, 1)) == before
    parts = V.current(spark, path)[1]["parts"]
    assert parts["2024-01-01"].split("/")[0] != parts["2024-01-02"].split("/")[0]  # untouched partitions stay


def test_of_two_upserts_at_once_one_is_told(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(1, "a")], "k long, v string")
    V.upsert(spark, path, one, ["k"])
    real = V._publish

    def late(s, p, version, content):
        real(s, p, version, {**content, "parts": dict(V.current(spark, path)[1]["parts"])})  # the other writer came first
        real(s, p, version, content)

    monkeypatch.setattr(V, "_publish", late)
    with pytest.raises(V.PublishConflict):
        V.upsert(spark, path, spark.createDataFrame([(1, "z")], "k long, v string"), ["k"])
    assert rows(V.read(spark, path)) == [(1, "a")]


def test_versioned_first_write_wins(spark, tmp_path):
    path = str(tmp_path / "p")
    schema = "k long, light string, note string"
    V.upsert(spark, path, spark.createDataFrame([(1, "green", "x"), (2, None, "y")], schema), ["k"])
    V.upsert(spark, path, spark.createDataFrame([(1, "red", "X"), (2, "red", "Y"), (3, "red", "Z")], schema), ["k"],
             merge=M.merge_first_write_wins, sticky_cols=["light"], update_cols=["note"])
    assert rows(V.read(spark, path)) == [(1, "green", "X"), (2, "red", "Y"), (3, "red", "Z")]


def test_first_of_repeated_keys(spark):
    s = spark.createDataFrame([(1, None, 5), (1, "b", 1), (1, "a", 9), (2, None, None)] + [(3, "z", i) for i in range(50)], "k long, v string, n int")
    assert rows(M._dedupe(s, ["k"], "first")) == [(1, "a", 9), (2, None, None), (3, "z", 0)]
    assert rows(M._dedupe(s.select("k"), ["k"], "first")) == [(1,), (2,), (3,)]


def test_tuning_resumes_and_repeats_only_what_failed(spark, tmp_path, monkeypatch):
    rng = random.Random(2)
    data = [(i, rng.random(), rng.random(), int(rng.random() > 0.5)) for i in range(200)]
    df = spark.createDataFrame([(i, a, b, int(a > 0.5) if i % 5 else y) for i, a, b, y in data], "id long, a double, b double, y int").coalesce(1)
    space = {"maxDepth": [1, 2], "maxIter": [1, 2]}
    options = dict(folds=2, n_trials=4, params={"stepSize": 0.3}, space=space, study=str(tmp_path / "study"), parallelism=2)
    fits = []
    real = K.GBTClassifier.fit

    def counted(self, *args, **kw):
        fits.append(self.getMaxDepth() * 10 + self.getMaxIter())
        if fits[-1] == 22 and fits.count(22) == 1:
            raise RuntimeError("an executor was lost")
        return real(self, *args, **kw)

    monkeypatch.setattr(K.GBTClassifier, "fit", counted)
    best, trials = K.tune(df, ["a", "b"], "y", ["id"], **options)
    assert trials.count() == 4 and set(best) == {"maxDepth", "maxIter"}
    assert sorted(fits) == [11, 11, 12, 12, 21, 21, 22, 22, 22]
    assert all(len(r["fold_aucs"]) == 2 and abs(sum(r["fold_aucs"]) / 2 - r["auc"]) < 1e-12 for r in trials.collect())
    fits.clear()
    assert K.tune(df, ["a", "b"], "y", ["id"], **options)[0] == best and not fits


def plain_ks(a, b):
    grid = sorted(set(a) | set(b))
    return max(abs(sum(x <= g for x in a) / len(a) - sum(x <= g for x in b) / len(b)) for g in grid)


@pytest.mark.parametrize("n1, n2", [(1, 1), (2, 3), (4, 4), (5, 3), (6, 2)])
def test_exact_p_counts_all_orders(spark, n1, n2):
    pool = list(range(n1 + n2))
    orders = [plain_ks([pool[i] for i in c], [pool[i] for i in pool if i not in c]) for c in combinations(pool, n1)]
    cases = sorted({round(d, 12) for d in orders})
    df = spark.createDataFrame([(d, n1, n2) for d in cases], "d double, n1 long, n2 long")
    for r in df.select("d", ks_exact_pvalue(F.col("d"), F.col("n1"), F.col("n2")).alias("p")).collect():
        assert r["p"] == pytest.approx(sum(d >= r["d"] - 1e-9 for d in orders) / len(orders))


def test_drift_of_small_samples_is_exact(spark):
    # four values all below four others: 2 of the 70 orders are as extreme
    a, b = (spark.createDataFrame([(float(x),) for x in xs], "x double") for xs in ((1, 2, 3, 4), (5, 6, 7, 8)))
    r = A.drift_ks(a, b, ["x"]).first()
    assert r["ESTADISTICO"] == 1.0 and r["P_VALOR"] == round(2 / 70, 6) and r["DRIFT"]
    big = spark.range(500).select(F.col("id").cast("double").alias("x"))
    assert 0 < A.drift_ks(big, big.select((F.col("x") + 30).alias("x")), ["x"]).first()["P_VALOR"] <= 1


def test_label_codes_are_ranks_and_building_starts_no_job(spark):
    rng = random.Random(8)
    values = sorted({"".join(rng.choices("abcñ", k=rng.randint(0, 6))) for _ in range(300)})
    train = spark.createDataFrame([(i, v, None if i % 3 else "nan") for i, v in enumerate(values)], "id long, a string, b string")
    d = X.label_encode_fit(train, ["a", "b"])
    codes = {(r["column"], r["category"]): r["code"] for r in d.collect()}
    assert [codes["a", v] for v in values] == list(range(len(values))) and codes["b", "MISSING"] == 0
    test = spark.createDataFrame([(1, values[7], "x", "q"), (2, "not seen", None, None), (3, None, "x", "q")], "id long, a string, b string, c string")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("encode", "encode")
    try:
        out = X.label_encode_transform(test, d, ["a", "b", "c", "absent"])
        assert not tracker.getJobIdsForGroup("encode")
    finally:
        spark.sparkContext._jsc.sc().clearJobGroup()
    assert rows(out) == [(1, 7, 0, 0), (2, 0, 0, 0), (3, 0, 0, 0)]


def test_terms_are_counted_without_moving_text(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"alpha beta gamma{i % 7} alpha") for i in range(60)], "doc_id long, text string").repartition(6)
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    vocab = X.tfidf_fit(docs, "doc_id", "text", max_features=6, min_df=2, max_df=1.0)
    out = X.tfidf_transform(docs, vocab, "doc_id", "text", "t", 6)
    for df in (vocab, out):
        plan = df._jdf.queryExecution().executedPlan().toString()
        tree = plan.split("== Initial Plan ==")[-1]
        below = [line for line in tree.split("\n") if "Exchange" in line]
        assert below
    wide = out._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in wide
    assert [r["term"] for r in vocab.orderBy("idx").collect()] == sorted(r["term"] for r in vocab.collect())
    assert {"alpha", "beta", "alpha beta"} <= {r["term"] for r in vocab.collect()}
