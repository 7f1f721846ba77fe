"""Feature transforms fitted on training data and applied at scale (survey I1-I9).

Fitted parameters are small DataFrames (one row per column, per category or
per vocabulary term), saved as parquet by ``FeatureModel.save``.  Applying
them is a projection plus joins with those bounded tables; nothing is
collected except per-column scalars (medians, means, deviations), whose
number is the number of columns, not of rows.
"""

from __future__ import annotations

import json
import os
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..session import cut_lineage
from .stats import exact_quantiles, unpivot

# Date reference and defaults.
DATE_REF = "2022-01-01"
DEFAULT_DATE = "2024-01-01"
DATE_PARTS = ("year", "month", "day", "dayofweek", "quarter", "days_since_ref")
MISSING = "MISSING"

# Interaction pairs of the reference.
INTERACTIONS = [
    ("COT_EDAD", "CIE_GRUPO_encoded"),
    ("DIASSOLICITADO", "CANT_LIC_U12M_CALC"),
    ("MEDICO_EXTRANJERO", "CIE_GRUPO_PSIQUIATRICAS_12"),
    ("EMPLEADOR_TASA_RECHAZO_ISAPRE_U12M", "MEDICO_TASA_RATIFICACION_COMPIN_U12M"),
]

# Word tokens of two or more letters/digits/underscore (maximal runs: the
# same tokens as a \b\w\w+\b pattern with Unicode word characters).
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


# ------------------------------------------------------------------ I1
def _parts(d: Column) -> dict[str, Column]:
    return {
        "year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d),
        "dayofweek": F.weekday(d),  # Monday = 0
        "quarter": F.quarter(d),
        "days_since_ref": F.datediff(d, F.lit(DATE_REF).cast("date")),
    }


def date_features(df: DataFrame, date_cols: Sequence[str], proxy: str = "FECHA_RECEPCION") -> DataFrame:
    """Year, month, day, weekday (Monday 0), quarter and days since
    2022-01-01 per date column; the source column is dropped.

    * column present with a value somewhere: its own parts;
    * column present but wholly NULL: the proxy column's parts when the proxy
      has a value somewhere, else the constants of 2024-01-01;
    * column absent: the proxy's parts (NULLs filled with the batch median of
      each part), or the constants when there is no proxy.
    "Has a value somewhere" is a scalar subquery, so the choice is made inside
    the plan.
    """
    out = df
    has_proxy = proxy in df.columns
    order = list(date_cols)

    def proxy_usable(c: str) -> bool:
        # dates are processed in list order and each source is dropped after
        # use, so the proxy only serves the columns listed before it
        return has_proxy and (proxy not in order or order.index(c) < order.index(proxy))

    present = [c for c in date_cols if c in df.columns]
    checks = {c: F.to_date(F.col(c)) for c in present + ([proxy] if has_proxy else [])}
    seen = None
    if checks:
        seen = df.agg(F.struct(*[F.max(e.isNotNull().cast("int")).alias(c) for c, e in checks.items()])).scalar()
    const = _parts(F.lit(DEFAULT_DATE).cast("date"))
    pparts = _parts(F.to_date(F.col(proxy))) if has_proxy else None
    new_cols = {}
    for c in date_cols:
        if c in df.columns:
            own = _parts(F.to_date(F.col(c)))
            own_ok = F.coalesce(seen.getField(c), F.lit(0)) == 1
            proxy_ok = F.coalesce(seen.getField(proxy), F.lit(0)) == 1 if proxy_usable(c) else F.lit(False)
            for p in DATE_PARTS:
                alt = F.when(proxy_ok, pparts[p]).otherwise(const[p]) if proxy_usable(c) else const[p]
                new_cols[f"{c}_{p}"] = F.when(own_ok, own[p]).otherwise(alt)
        elif proxy_usable(c):
            for p in DATE_PARTS:
                med = df.agg(F.percentile(pparts[p], 0.5)).scalar()  # few distinct values per part
                new_cols[f"{c}_{p}"] = F.coalesce(pparts[p].cast("double"), med, F.lit(0.0))
        else:
            for p in DATE_PARTS:
                new_cols[f"{c}_{p}"] = const[p]
    out = out.select(*[F.col(f"`{x}`") for x in df.columns], *[v.alias(k) for k, v in new_cols.items()])
    return out.drop(*present)


# ------------------------------------------------------------------ I2
def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN_PATTERN), 0)


def _with_bigrams(toks: Column) -> Column:
    """Tokens followed by the space-joined pairs of consecutive tokens."""
    pairs = F.zip_with(toks, F.slice(toks, 2, F.greatest(F.size(toks) - 1, F.lit(1))),
                       lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(F.size(toks) > 1, F.concat(toks, F.filter(pairs, lambda x: x.isNotNull()))).otherwise(toks)


def _terms(df: DataFrame, doc_id: str, text: str, few_splits: bool = False) -> DataFrame:
    """(doc_id, term) for every occurrence, made where the text is read; ``few_splits`` deals the texts out first."""
    t = df.select(doc_id, text)
    t = (t.repartition(doc_id) if few_splits else t).select(doc_id, _tokens(F.col(text)).alias("__toks"))
    return t.select(doc_id, F.explode(_with_bigrams(F.col("__toks"))).alias("term"))


# Groups of terms whose totals are counted first, to tell which terms can be among the most frequent.
TERM_GROUPS = 1 << 16


def _term_group(term: str) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(TERM_GROUPS)).cast("int")


def tfidf_fit(df: DataFrame, doc_id: str, text: str, max_features: int = 50, min_df: int = 5,
              max_df: float = 0.8, few_splits: bool = False) -> DataFrame:
    """I2 fit: vocabulary (term, idx, idf).  Terms in at least ``min_df``
    documents and at most ``max_df`` of them, the ``max_features`` most
    frequent over the corpus (ties alphabetical), indexed alphabetically;
    smooth idf = ln((1 + n) / (1 + df)) + 1.

    The first pass counts occurrences in ``TERM_GROUPS`` groups of terms (by
    hash), so at most that many rows leave a task.  A term has no more
    occurrences than its group.  The second pass counts the terms of the
    largest groups exactly, by document.  It has found the vocabulary if no
    other group reaches the total of the last winner; else the groups that do
    are counted too.  While there are fewer than ``max_features`` winners, the
    next smaller groups join, up to all.  ``few_splits`` is for a table that
    comes in fewer splits than there are cores: its texts are dealt out first.
    """
    n = df.count()
    terms = _terms(df, doc_id, text, few_splits).withColumn("__g", _term_group("term"))
    groups = cut_lineage(terms.groupBy("__g").agg(F.count(F.lit(1)).alias("__all")))
    taken = 4 * max_features
    least = groups.orderBy(F.col("__all").desc()).limit(taken).agg(F.min("__all")).first()[0] or 0
    while True:
        large = F.broadcast(groups.where(F.col("__all") >= least).select("__g"))  # at most TERM_GROUPS rows
        tf = terms.join(large, "__g").groupBy(doc_id, "term").agg(F.count(F.lit(1)).alias("tf"))
        dfs = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("tot"))
        keep = cut_lineage(dfs.where((F.col("df") >= min_df) & (F.col("df") <= float(max_df) * n)))
        top = keep.orderBy(F.col("tot").desc(), F.col("term")).limit(max_features)
        winners, last = top.agg(F.count(F.lit(1)), F.min("tot")).first()
        reach = last if winners == max_features and last is not None else 0
        if groups.where((F.col("__all") < least) & (F.col("__all") >= reach)).isEmpty():
            break
        taken *= 16
        wider = groups.orderBy(F.col("__all").desc()).limit(taken).agg(F.min("__all")).first()[0]
        least = reach or (wider if taken < TERM_GROUPS else 0)
    # the vocabulary has at most max_features rows: a bounded single-task sort
    chosen = keep.join(F.broadcast(top.select("term")), "term", "left_semi")
    w = Window.orderBy("term")
    return chosen.select("term", (F.row_number().over(w) - 1).alias("idx"),
                      (F.log(F.lit(1.0 + n) / (F.lit(1.0) + F.col("df"))) + 1).alias("idf"))


def tfidf_transform(df: DataFrame, vocab: DataFrame, doc_id: str, text: str, prefix: str,
                    size: int, keep_text: bool = False, few_splits: bool = False) -> DataFrame:
    """I2 apply: ``{prefix}_tfidf_{i}`` columns, L2-normalised per document.

    Occurrences of vocabulary terms are kept where the text is; only their
    counts per document move."""
    hits = _terms(df, doc_id, text, few_splits).join(F.broadcast(vocab), "term")  # vocab <= max_features rows
    # one row per document leaves a task: a count for each of the <= size terms
    counts = hits.groupBy(doc_id).agg(F.count(F.lit(1)).alias("__hits"), *[F.count(F.when(F.col("idx") == i, F.lit(1))).alias(f"__{i}") for i in range(size)])
    idfs = vocab.agg(F.array_sort(F.collect_list(F.struct("idx", "idf"))).alias("v")).scalar()
    values = counts.select(doc_id, *[(F.col(f"__{i}") * F.get(idfs, F.lit(i)).getField("idf")).alias(f"__{i}") for i in range(size)])
    # L2 norm per document over its <= size vocabulary terms
    squares = F.lit(0.0)
    for i in range(size):
        squares = squares + F.coalesce(F.col(f"__{i}") * F.col(f"__{i}"), F.lit(0.0))
    wide = values.select("*", F.sqrt(squares).alias("__n")) \
        .select(doc_id, *[(F.col(f"__{i}") / F.col("__n")).alias(f"{prefix}_tfidf_{i}") for i in range(size)])
    out = df.join(wide, doc_id, "left").fillna(0.0, subset=[f"{prefix}_tfidf_{i}" for i in range(size)])
    return out if keep_text else out.drop(text)


# ------------------------------------------------------------------ I3
def _as_category(c: Column) -> Column:
    s = c.cast("string")
    return F.when(s.isNull() | s.isin("nan", "<NA>", "None"), F.lit(MISSING)).otherwise(s)


def label_encode_fit(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """I3 fit: (column, category, code) with codes in sorted category order;
    NULL becomes 'MISSING'.

    A code is the number of smaller categories: those of earlier beginnings
    (prefix sums over the column's beginnings) and those before it of its own
    beginning, so no task sorts a whole column."""
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, category string, code int")
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), _as_category(F.col(c)).alias("category"))
                                         for c in cols])).alias("x")).select("x.*").distinct()
    long = long.withColumn("__start", F.substring("category", 1, 3))
    inside = Window.partitionBy("column", "__start").orderBy("category")
    starts = long.groupBy("column", "__start").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("column").orderBy("__start").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("column", "__start", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    placed = long.withColumn("__in", F.row_number().over(inside) - 1).join(starts, ["column", "__start"])
    return placed.select("column", "category", (F.col("__before") + F.col("__in")).cast("int").alias("code"))


def label_encode_transform(df: DataFrame, dictionary: DataFrame, cols: Sequence[str]) -> DataFrame:
    """I3 apply: ``{col}_encoded``; unseen categories take 'MISSING' when it is
    known, else the alphabetically first category; a column without a fitted
    dictionary gets 0.  Source columns are dropped.

    Building starts no job: every column's default code comes from one scalar
    subquery (a map with an entry for each fitted column)."""
    present = [c for c in cols if c in df.columns]
    if not present:
        return df
    first = F.coalesce(F.max(F.when(F.col("category") == MISSING, F.col("code"))), F.min("code"))
    defaults = dictionary.groupBy("column").agg(first.alias("code")) \
        .agg(F.map_from_entries(F.collect_list(F.struct("column", "code"))).alias("m")).scalar()
    out = df.withColumn("__defaults", defaults)
    for c in present:
        d = dictionary.where(F.col("column") == c).select(F.col("category").alias("__cat"), F.col("code").alias("__code"))
        code = F.coalesce(F.col("__code"), F.element_at("__defaults", c), F.lit(0))
        out = out.withColumn("__cat", _as_category(F.col(c))).join(d, "__cat", "left") \
                 .withColumn(f"{c}_encoded", code.cast("int")).drop("__cat", "__code", c)
    return out.drop("__defaults")


# ------------------------------------------------------------------ I4
def impute_fit(df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """I4 fit: exact (interpolated) median of each numeric column."""
    long = unpivot(df, numeric, name="column")
    return exact_quantiles(long, ["column"], "value", [0.5]).select("column", F.col("q0").alias("median"))


def impute_transform(df: DataFrame, medians: dict, binary: Sequence[str] = ()) -> DataFrame:
    """I4 apply: NULL/NaN numeric -> fitted median, binary -> 0."""
    cols = []
    for c, t in df.dtypes:
        col = F.col(f"`{c}`")
        if c in medians and medians[c] is not None:
            miss = col.isNull() | (F.isnan(col) if t in ("double", "float") else F.lit(False))
            cols.append(F.when(miss, F.lit(float(medians[c]))).otherwise(col.cast("double")).alias(c))
        elif c in binary:
            cols.append(F.coalesce(col, F.lit(0)).alias(c))
        else:
            cols.append(col)
    return df.select(*cols)


# ------------------------------------------------------------------ I5
def interactions(df: DataFrame, pairs: Sequence[tuple[str, str]] = INTERACTIONS) -> DataFrame:
    """a*b and a/(b+1) for each present pair; b = -1 gives NULL (not an error)."""
    out = df
    for a, b in pairs:
        if a in df.columns and b in df.columns:
            out = out.withColumn(f"{a}_X_{b}", F.col(a) * F.col(b)) \
                     .withColumn(f"{a}_div_{b}", F.try_divide(F.col(a).cast("double"), F.col(b) + 1))
    return out


# ------------------------------------------------------------------ I6
def standardise_fit(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """I6 fit: mean and population sd per column (sd 0 -> 1; a column without
    values: mean 0, sd 1).  One global aggregate; its single row is then
    turned into one row per column."""
    cols = list(cols)
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, mean double, sd double")
    stats = df.agg(*[f(F.col(f"`{c}`").cast("double")).alias(f"{n}{i}") for i, c in enumerate(cols)
                     for n, f in (("m", F.avg), ("s", F.stddev_pop))])
    items = ", ".join(f"'{c}', m{i}, s{i}" for i, c in enumerate(cols))
    long = stats.selectExpr(f"stack({len(cols)}, {items}) AS (column, mean, sd)")
    return long.select("column", F.coalesce("mean", F.lit(0.0)).alias("mean"),
                       F.when(F.col("sd").isNull() | (F.col("sd") == 0), 1.0).otherwise(F.col("sd")).alias("sd"))


def standardise_transform(df: DataFrame, params: dict) -> DataFrame:
    """I6 apply: (x - mean) / sd with fitted values."""
    return df.select(*[((F.col(f"`{c}`") - float(params[c][0])) / float(params[c][1])).alias(c)
                       if c in params else F.col(f"`{c}`") for c in df.columns])


# ------------------------------------------------------------------ I7, I9
def align_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Missing features added as 0, extra columns dropped, model order."""
    have = set(df.columns)
    return df.select(*[F.col(k) for k in keep],
                     *[F.col(f"`{f}`") if f in have else F.lit(0.0).alias(f) for f in features])


def select_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The selected feature list (plus ``keep`` columns), in list order."""
    return df.select(*[F.col(f"`{c}`") for c in list(keep) + [f for f in features if f in df.columns]])


# ------------------------------------------------------------------ I8
@dataclass
class FeatureModel:
    """I8: dates -> text -> categories -> numeric imputation -> interactions -> scaling."""
    dates: list[str] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    categorical: list[str] = field(default_factory=list)
    numeric: list[str] = field(default_factory=list)
    binary: list[str] = field(default_factory=list)
    doc_id: str = "__row_id"
    max_features: int = 50
    min_df: int = 5
    max_df: float = 0.8
    impute_mode: str = "fit"  # "batch" recomputes medians on each scored batch
    vocab: dict = field(default_factory=dict)
    sizes: dict = field(default_factory=dict)
    dictionary: DataFrame | None = None
    medians: dict = field(default_factory=dict)
    scale: dict = field(default_factory=dict)
    feature_names: list[str] = field(default_factory=list)

    def _pre(self, df: DataFrame, fit: bool) -> DataFrame:
        x = date_features(df, self.dates)
        for t in self.text:
            if t not in x.columns:
                continue
            if fit:
                # a written table: read by every later transform, and nothing stays on executors
                self.vocab[t] = cut_lineage(tfidf_fit(x, self.doc_id, t, self.max_features, self.min_df, self.max_df))
                self.sizes[t] = self.vocab[t].count()
            x = tfidf_transform(x, self.vocab[t], self.doc_id, t, t, self.sizes[t])
        if fit:
            if self.text:
                # read by every later fit: the texts are not split again for each
                x = cut_lineage(x)
            self.dictionary = cut_lineage(label_encode_fit(x, [c for c in self.categorical if c in x.columns]))
        x = label_encode_transform(x, self.dictionary, self.categorical)
        num = [c for c in self.numeric if c in x.columns]
        if fit or self.impute_mode == "batch":
            meds = {r["column"]: r["median"] for r in impute_fit(x, num).collect()} if num else {}
            if fit:
                self.medians = meds
        else:
            meds = self.medians
        x = impute_transform(x, meds, [c for c in self.binary if c in x.columns])
        return interactions(x)

    def _numeric_cols(self, x: DataFrame, exclude: Sequence[str]) -> list[str]:
        return [f.name for f in x.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]

    def numeric_names(self, x: DataFrame) -> list[str]:
        """The columns that a model can take."""
        return self._numeric_cols(x, [self.doc_id])

    def fit_transform(self, df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
        x = self._pre(df, fit=True)
        cols = self._numeric_cols(x, list(exclude) + [self.doc_id])
        self.scale = {r["column"]: (r["mean"], r["sd"]) for r in standardise_fit(x, cols).collect()}
        self.feature_names = [c for c in x.columns if c not in exclude and c != self.doc_id]
        return standardise_transform(x, self.scale)

    def transform(self, df: DataFrame) -> DataFrame:
        x = self._pre(df, fit=False)
        return standardise_transform(x, self.scale)

    def save(self, path: str) -> None:
        for t, v in self.vocab.items():
            v.write.mode("overwrite").parquet(os.path.join(path, f"vocab_{t}"))
        if self.dictionary is not None:
            self.dictionary.write.mode("overwrite").parquet(os.path.join(path, "dictionary"))
        meta = {k: getattr(self, k) for k in ("dates", "text", "categorical", "numeric", "binary", "doc_id",
                                              "max_features", "min_df", "max_df", "impute_mode", "sizes",
                                              "medians", "feature_names")}
        meta["scale"] = {k: list(v) for k, v in self.scale.items()}
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").json(
            os.path.join(path, "meta"))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "FeatureModel":
        meta = json.loads(spark.read.json(os.path.join(path, "meta")).first()["meta"])
        scale = {k: tuple(v) for k, v in meta.pop("scale").items()}
        m = cls(**meta)
        m.scale = scale
        m.vocab = {t: spark.read.parquet(os.path.join(path, f"vocab_{t}")) for t in m.text if t in m.sizes}
        from ..sources.sinks import path_exists
        dpath = os.path.join(path, "dictionary")
        m.dictionary = spark.read.parquet(dpath) if path_exists(spark, dpath) else None
        return m


def read_feature_list(spark: SparkSession, path: str) -> list[str]:
    """The selected feature names from a text file, one per line (a list
    bounded by the number of model features)."""
    return [r[0].strip() for r in spark.read.text(path).collect() if r[0] and r[0].strip()]
