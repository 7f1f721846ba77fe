"""What operators move between tasks: rows and bytes written by the exchanges of the plans that ran."""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import functions as F

from adjudica.operators import features as X
from adjudica.operators import model as K
from adjudica.operators.lookback import lookback_days


def exchanges(df) -> list:
    """The exchanges of the frame's plan (after it ran)."""
    def walk(p):
        name = p.nodeName()
        if "AdaptiveSparkPlan" in name:
            return walk(p.executedPlan())
        if "QueryStage" in name:
            return walk(p.plan())
        own = [p] if name == "Exchange" else []
        children = p.children()
        return own + [x for i in range(children.size()) for x in walk(children.apply(i))]
    return walk(df._jdf.queryExecution().executedPlan())


def written(df, metric: str = "shuffleRecordsWritten") -> int:
    return sum(x.metrics().apply(metric).value() for x in exchanges(df))


def run(df):
    df._jdf.queryExecution().executedPlan().executeCollect()
    return df


# ------------------------------------------------------------------ I2
def _vocabulary(docs, max_features, min_df, max_df):
    """Plain version: (term, idx, idf)."""
    tf = {i: Counter([*(w := t.split()), *map(" ".join, zip(w, w[1:]))]) for i, t in docs}
    df, tot = Counter(), Counter()
    for c in tf.values():
        df.update(c.keys())
        tot.update(c)
    kept = [t for t in tot if min_df <= df[t] <= max_df * len(docs)]
    top = sorted(sorted(kept, key=lambda t: (-tot[t], t))[:max_features])
    return [(t, i, round(math.log((1 + len(docs)) / (1 + df[t])) + 1, 9)) for i, t in enumerate(top)]


def test_tfidf_fit_moves_group_totals_and_large_groups_only(spark, monkeypatch):
    monkeypatch.setattr(X, "TERM_GROUPS", 1 << 12, raising=False)
    docs = [(d, " ".join([f"rare{d}x{k}" for k in range(80)] + ["alpha", "beta"] * (d % 3) + ["gamma"] * (d % 2))) for d in range(300)]
    seen, cut = [], X.cut_lineage
    monkeypatch.setattr(X, "cut_lineage", lambda df: (seen.append(df), cut(df))[1])
    vocab = X.tfidf_fit(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), "doc_id", "text", 2)
    assert [(r["term"], r["idx"], round(r["idf"], 9)) for r in vocab.orderBy("idx").collect()] == _vocabulary(docs, 2, 5, 0.8)
    pairs = 300 * 160  # (document, term) rows, nearly all of terms that occur once
    assert sum(map(written, seen)) < pairs / 2


def test_tfidf_fit_takes_smaller_groups_until_the_vocabulary_is_complete(spark, monkeypatch):
    monkeypatch.setattr(X, "TERM_GROUPS", 1 << 12, raising=False)
    everywhere = " ".join(f"all{k}" for k in range(30))  # the largest groups hold terms of too many documents
    docs = [(d, f"{everywhere} " + " ".join(f"w{(d * 7 + k * k) % 45}" for k in range(6))) for d in range(120)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for size in (1, 3, 50, 500):
        vocab = X.tfidf_fit(frame, "doc_id", "text", size)
        assert [(r["term"], r["idx"], round(r["idf"], 9)) for r in vocab.orderBy("idx").collect()] == _vocabulary(docs, size, 5, 0.8)


def test_tfidf_without_vocabulary(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string")
    vocab = X.tfidf_fit(docs, "doc_id", "text", 5)
    assert vocab.count() == 0
    out = X.tfidf_transform(docs, vocab, "doc_id", "text", "t", 2)
    assert sorted(map(tuple, out.collect())) == [(1, 0.0, 0.0), (2, 0.0, 0.0)]


# ------------------------------------------------------------------ C3-C6
def test_lookback_moves_the_history_once(spark):
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 60).cast("int"))
    history = spark.range(0, 4000, numPartitions=3).select((F.col("id") % 7).alias("p"), day.alias("d"), F.col("id").alias("n"))
    probes = history.where("n < 200").select("p", F.col("d").alias("t"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = run(lookback_days(probes, history, "p", "t", "d", [F.sum("c").alias("n")], reduce=(["n"], [F.count(F.lit(1)).alias("c")])))
        biggest = sorted((x.metrics().apply("shuffleRecordsWritten").value() for x in exchanges(out)), reverse=True)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(n >= 4000 for n in biggest) == 1, biggest


# ------------------------------------------------------------------ K1
def test_split_leaves_rows_where_they_are_read(spark):
    rows = spark.range(0, 3000, numPartitions=4).select("id", (F.col("id") % 3 == 0).cast("int").alias("y"), F.repeat(F.lit("x"), 500).alias("wide"))
    out = run(K.stratified_split(rows, "y", ["id"], 0.2, 42))
    assert written(out, "dataSize") < 3000 * 500 / 4


def test_split_is_that_of_the_ranked_rows(spark):
    """Also with equal keys, whose places in the ranking are any, a NULL label and shares at both ends."""
    rows = spark.range(0, 900).select((F.col("id") % 700).alias("id"), F.when(F.col("id") % 7 > 0, (F.col("id") % 3).cast("int")).alias("y"))
    rows = rows.unionByName(rows.where("id = 4"))
    for test in (0.0, 0.2, 0.37, 1.0):
        mine, ranked = (K.stratified_split(rows, "y", ["id"], test, 5, bounded=b).collect() for b in (False, True))
        assert Counter(map(tuple, mine)) == Counter(map(tuple, ranked))


# ------------------------------------------------------------------ N1
def test_increment_ranks_and_joins_without_the_claims_columns(spark, monkeypatch):
    """Claims that repeat and claims without a person or entity keep their rows; what is ranked has the keys only."""
    from adjudica.operators import joins as J
    from adjudica.plans.increment import run_increment
    day = lambda n: F.date_add(F.lit("2024-03-01").cast("date"), n)
    claims = spark.range(0, 12).select(
        F.when(F.col("id") % 5 > 0, (F.col("id") % 5).cast("string")).alias("AFILIADO_RUT"), F.col("id").alias("LCC_COMCOR"), F.lit(1).cast("long").alias("LCC_COMCOD"),
        day((F.col("id") % 3).cast("int")).alias("FECHA_RECEPCION"), F.lit(None).cast("date").alias("FECHA_RESOLUCION_COMPIN"),
        F.lit(None).cast("string").alias("RESOLUCION_COMPIN"), F.lit(5).cast("long").alias("DIASSOLICITADO"), F.lit(2).cast("long").alias("F_DIASAUTORIZADOS"),
        F.when(F.col("id") % 4 > 0, F.col("id") % 2).cast("string").alias("EMPLEADOR_RUT"), F.concat(F.lit("w"), "id").alias("WIDE_TEXT"))
    claims = claims.unionByName(claims.where("LCC_COMCOR in (3, 5)"))
    base = claims.limit(0)
    wide = claims.where("LCC_COMCOR = 7").select("AFILIADO_RUT", "FECHA_RECEPCION", "LCC_COMCOR", "LCC_COMCOD")
    services = spark.createDataFrame([], "COTIZANTE_RUT string, FECHA date, FOLIO string, PRESTACION_CANTIDAD double, MEDTRATANTE_RUT string, TIPO string, PATOLOGIA_GES string, PATOLOGIA_CAEC string")
    exams = spark.createDataFrame([], "AFILIADO_RUT string, PERITAJE_PERITAJE_FECHA_CITACION date, ASISTENCIA string, ACUERDO_DESACUERDO string")
    monthly = {"EMPLEADOR_RUT": spark.createDataFrame([("1", "022024", 9), ("1", "012024", 8), ("0", "032024", 7)], "EMPLEADOR_RUT string, PERIODO string, N long")}
    given, rank = [], J.history_rank
    monkeypatch.setattr(J, "history_rank", lambda new, *a, **b: (given.append(new.columns), rank(new, *a, **b))[1])
    out = run_increment(claims, base, None, wide, services, exams, "2024-03-01", "2024-03-03", "2024-03-10", monthly=monthly).new_wide
    rows = Counter((r["LCC_COMCOR"], r["AFILIADO_RUT"], r["EMPLEADOR_RUT"], r["WIDE_TEXT"], r["N"]) for r in out.collect())
    expected = Counter()
    for r in claims.where("LCC_COMCOR <> 7").collect():
        expected[r["LCC_COMCOR"], r["AFILIADO_RUT"], r["EMPLEADOR_RUT"], r["WIDE_TEXT"], 9 if r["EMPLEADOR_RUT"] == "1" else None] += 1
    assert rows == expected
    assert "WIDE_TEXT" not in given[0]
