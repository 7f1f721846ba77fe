"""Registered queries: feature transforms (survey I1-I9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as X
from ..sources import analogues as an
from .catalog_mart import _claims_cte
from .registry import query

# ---------------------------------------------------------------- I1
I1_COLS = ["FECHA_AUSENTE0", "FECHA_RESOLUCION_COMPIN", "FECHA_NULA", "FECHA_RECEPCION", "FECHA_NULA2",
           "FECHA_AUSENTE"]


def _i1_input(spark, sf_dir):
    c = an.claims_from_orders(spark, sf_dir)
    return c.select("LCC_COMCOR", "FECHA_RECEPCION", "FECHA_RESOLUCION_COMPIN",
                    F.lit(None).cast("date").alias("FECHA_NULA"), F.lit(None).cast("date").alias("FECHA_NULA2"))


def _i1_sql() -> str:
    def parts(d):
        return {"year": f"CAST(year({d}) AS INTEGER)", "month": f"CAST(month({d}) AS INTEGER)",
                "day": f"CAST(day({d}) AS INTEGER)", "dayofweek": f"CAST(isodow({d}) - 1 AS INTEGER)",
                "quarter": f"CAST(quarter({d}) AS INTEGER)",
                "days_since_ref": f"CAST({d} - DATE '2022-01-01' AS INTEGER)"}
    const = {"year": "2024", "month": "1", "day": "1", "dayofweek": "0", "quarter": "1", "days_since_ref": "730"}
    pr = parts("FECHA_RECEPCION")
    sel = []
    for p in X.DATE_PARTS:   # FECHA_AUSENTE0: absent, before the proxy -> proxy parts as double
        sel.append(f"CAST({pr[p]} AS DOUBLE) AS FECHA_AUSENTE0_{p}")
    own = parts("FECHA_RESOLUCION_COMPIN")
    for p in X.DATE_PARTS:   # present with values -> own parts (NULL stays NULL)
        sel.append(f"{own[p]} AS FECHA_RESOLUCION_COMPIN_{p}")
    for p in X.DATE_PARTS:   # present, wholly NULL, before the proxy -> proxy parts
        sel.append(f"{pr[p]} AS FECHA_NULA_{p}")
    for p in X.DATE_PARTS:
        sel.append(f"{pr[p]} AS FECHA_RECEPCION_{p}")
    for p in X.DATE_PARTS:   # wholly NULL after the proxy -> constants
        sel.append(f"{const[p]} AS FECHA_NULA2_{p}")
    for p in X.DATE_PARTS:   # absent after the proxy -> constants
        sel.append(f"{const[p]} AS FECHA_AUSENTE_{p}")
    return f"WITH {_claims_cte()} SELECT LCC_COMCOR, {', '.join(sel)} FROM claims"


@query("i1_date_features", "I1", _i1_sql())
def i1_date_features(spark, sf_dir):
    return X.date_features(_i1_input(spark, sf_dir), I1_COLS)


# ---------------------------------------------------------------- I2
def _i2_sql(size: int = 50) -> str:
    cols = ", ".join(f"ROUND(COALESCE(MAX(CASE WHEN w.idx = {i} THEN w.v / nrm.nr END), 0), 6) AS text_tfidf_{i}"
                     for i in range(size))
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(COALESCE(text, '')), '[\\pL\\pN_]{{2,}}') AS t FROM documents),
terms AS (SELECT doc_id, unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])))
          AS term FROM d),
tf AS (SELECT doc_id, term, COUNT(*) AS tf FROM terms GROUP BY 1, 2),
dfs AS (SELECT term, COUNT(*) AS df, SUM(tf) AS tot FROM tf GROUP BY term),
n AS (SELECT COUNT(*) AS n FROM documents),
voc AS (SELECT term, df FROM dfs, n WHERE df >= 5 AND df <= 0.8 * n ORDER BY tot DESC, term LIMIT 50),
vi AS (SELECT term, ROW_NUMBER() OVER (ORDER BY term) - 1 AS idx, LN((1.0 + n) / (1.0 + df)) + 1 AS idf FROM voc, n),
w AS (SELECT tf.doc_id, vi.idx, tf.tf * vi.idf AS v FROM tf JOIN vi USING (term)),
nrm AS (SELECT doc_id, SQRT(SUM(v * v)) AS nr FROM w GROUP BY doc_id)
SELECT d.doc_id, {cols}
FROM documents d LEFT JOIN w ON d.doc_id = w.doc_id LEFT JOIN nrm ON d.doc_id = nrm.doc_id
GROUP BY d.doc_id
"""


@query("i2_tfidf_features", "I2", _i2_sql())
def i2_tfidf_features(spark, sf_dir):
    docs = an.table(spark, sf_dir, "documents").select("doc_id", "text")
    vocab = X.tfidf_fit(docs, "doc_id", "text")
    out = X.tfidf_transform(docs, vocab, "doc_id", "text", "text", 50)
    return out.select("doc_id", *[F.round(f"text_tfidf_{i}", 6).alias(f"text_tfidf_{i}") for i in range(50)])


# ---------------------------------------------------------------- I3
I3_SQL = """
WITH fitdocs AS (SELECT d.* FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality = 1),
dict AS (SELECT 'lang' AS col, cat, ROW_NUMBER() OVER (ORDER BY cat) - 1 AS code
         FROM (SELECT DISTINCT COALESCE(lang, 'MISSING') AS cat FROM fitdocs)
         UNION ALL
         SELECT 'source', cat, ROW_NUMBER() OVER (ORDER BY cat) - 1 FROM (SELECT DISTINCT COALESCE(source, 'MISSING') AS cat FROM fitdocs)),
dflt AS (SELECT col, COALESCE(MAX(CASE WHEN cat = 'MISSING' THEN code END), MIN(code)) AS code FROM dict GROUP BY col)
SELECT d.doc_id,
  CAST(COALESCE(l.code, (SELECT code FROM dflt WHERE col = 'lang')) AS INTEGER) AS lang_encoded,
  CAST(COALESCE(s.code, (SELECT code FROM dflt WHERE col = 'source')) AS INTEGER) AS source_encoded
FROM documents d
LEFT JOIN dict l ON l.col = 'lang' AND l.cat = COALESCE(d.lang, 'MISSING')
LEFT JOIN dict s ON s.col = 'source' AND s.cat = COALESCE(d.source, 'MISSING')
"""


@query("i3_label_encode", "I3", I3_SQL)
def i3_label_encode(spark, sf_dir):
    docs = an.table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    lab = an.table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    dic = X.label_encode_fit(docs.join(lab, "doc_id"), ["lang", "source"])
    return X.label_encode_transform(docs, dic, ["lang", "source"]).select("doc_id", "lang_encoded", "source_encoded")


# ---------------------------------------------------------------- I4
I4_SQL = f"""
WITH {_claims_cte()},
x AS (SELECT LCC_COMCOR, FECHA_RECEPCION, F_DIASAUTORIZADOS,
             CASE WHEN RESOLUCION_COMPIN = 'RATIFICA' THEN 1 END AS FLAG_RATIFICA FROM claims),
m AS (SELECT quantile_cont(F_DIASAUTORIZADOS, 0.5) AS med FROM x WHERE FECHA_RECEPCION < DATE '1999-01-01')
SELECT LCC_COMCOR, CAST(COALESCE(F_DIASAUTORIZADOS, med) AS DOUBLE) AS F_DIASAUTORIZADOS,
       COALESCE(FLAG_RATIFICA, 0) AS FLAG_RATIFICA
FROM x, m
"""


@query("i4_impute", "I4", I4_SQL)
def i4_impute(spark, sf_dir):
    c = an.claims_from_orders(spark, sf_dir).select(
        "LCC_COMCOR", "FECHA_RECEPCION", "F_DIASAUTORIZADOS",
        F.when(F.col("RESOLUCION_COMPIN") == "RATIFICA", 1).alias("FLAG_RATIFICA"))
    train = c.where(F.col("FECHA_RECEPCION") < F.lit("1999-01-01").cast("date"))
    meds = {r["column"]: r["median"] for r in X.impute_fit(train, ["F_DIASAUTORIZADOS"]).collect()}
    return X.impute_transform(c, meds, ["FLAG_RATIFICA"]).drop("FECHA_RECEPCION")


# ---------------------------------------------------------------- I5
I5_PAIRS = [("DIASSOLICITADO", "LCC_COMCOD"), ("PROBABILIDAD_APROBACION", "LEAK_FT"), ("DIASSOLICITADO", "NEG")]


@query("i5_interactions", "I5", f"""
WITH {an.sql_cte('scored', an.SCORED_FROM_LINEITEM, 'lineitem')}, s AS (SELECT *, LCC_COMCOD - 2 AS NEG FROM scored)
SELECT LCC_COMCOR, LCC_COMCOD,
  DIASSOLICITADO * LCC_COMCOD AS DIASSOLICITADO_X_LCC_COMCOD,
  ROUND(CAST(DIASSOLICITADO AS DOUBLE) / (LCC_COMCOD + 1), 6) AS DIASSOLICITADO_div_LCC_COMCOD,
  ROUND(PROBABILIDAD_APROBACION * LEAK_FT, 6) AS PROBABILIDAD_APROBACION_X_LEAK_FT,
  ROUND(PROBABILIDAD_APROBACION / (LEAK_FT + 1), 6) AS PROBABILIDAD_APROBACION_div_LEAK_FT,
  DIASSOLICITADO * NEG AS DIASSOLICITADO_X_NEG,
  ROUND(CASE WHEN NEG + 1 <> 0 THEN CAST(DIASSOLICITADO AS DOUBLE) / (NEG + 1) END, 6) AS DIASSOLICITADO_div_NEG
FROM s""")
def i5_interactions(spark, sf_dir):
    s = an.scored_from_lineitem(spark, sf_dir).withColumn("NEG", F.col("LCC_COMCOD") - 2)
    out = X.interactions(s.select("LCC_COMCOR", "LCC_COMCOD", "DIASSOLICITADO", "PROBABILIDAD_APROBACION",
                                  "LEAK_FT", "NEG"), I5_PAIRS)
    new = [c for c in out.columns if "_X_" in c or "_div_" in c]
    return out.select("LCC_COMCOR", "LCC_COMCOD", *[F.round(c, 6).alias(c) if c != "DIASSOLICITADO_X_LCC_COMCOD"
                                                     and c != "DIASSOLICITADO_X_NEG" else F.col(c) for c in new])


# ---------------------------------------------------------------- I6
I6_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


@query("i6_standardise", "I6", f"""
WITH p AS (SELECT {', '.join(f'AVG({c}) AS m_{c}, STDDEV_POP({c}) AS s_{c}' for c in I6_COLS)}
           FROM lineitem WHERE l_linestatus = 'O')
SELECT l_orderkey, l_linenumber, {', '.join(
    f'ROUND(({c} - m_{c}) / CASE WHEN s_{c} IS NULL OR s_{c} = 0 THEN 1 ELSE s_{c} END, 6) AS {c}'
    for c in I6_COLS)}
FROM lineitem, p""")
def i6_standardise(spark, sf_dir):
    li = an.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus", *I6_COLS)
    params = {r["column"]: (r["mean"], r["sd"])
              for r in X.standardise_fit(li.where(F.col("l_linestatus") == "O"), I6_COLS).collect()}
    out = X.standardise_transform(li.drop("l_linestatus"), params)
    return out.select("l_orderkey", "l_linenumber", *[F.round(c, 6).alias(c) for c in I6_COLS])


# ---------------------------------------------------------------- I7, I9
MODEL_FEATURES = ["l_quantity", "l_tax", "MISSING_FEATURE", "l_discount"]


@query("i7_align_features", "I7", """
SELECT l_orderkey, l_linenumber, l_quantity, l_tax, CAST(0.0 AS DOUBLE) AS MISSING_FEATURE, l_discount FROM lineitem""")
def i7_align_features(spark, sf_dir):
    li = an.table(spark, sf_dir, "lineitem")
    return X.align_features(li, MODEL_FEATURES, keep=["l_orderkey", "l_linenumber"])


@query("i9_select_features", "I9", "SELECT l_orderkey, l_discount, l_quantity FROM lineitem")
def i9_select_features(spark, sf_dir):
    li = an.table(spark, sf_dir, "lineitem")
    return X.select_features(li, ["l_discount", "l_quantity", "not_a_column"], keep=["l_orderkey"])


# ---------------------------------------------------------------- I8 (rows only)
@query("i8_feature_model", ("I8", "I1", "I2", "I3", "I4", "I5", "I6"))
def i8_feature_model(spark, sf_dir):
    d = an.table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    lab = an.table(spark, sf_dir, "labels").select("doc_id", "toxic", "quality")
    docs = d.join(lab, "doc_id", "left")
    fm = X.FeatureModel(text=["text"], categorical=["lang", "source"], numeric=["n_chars"], binary=["toxic"],
                        doc_id="doc_id")
    fm.fit_transform(docs.where(F.col("quality").isNotNull()), exclude=["quality"])
    return fm.transform(docs.drop("quality"))
