"""Rule-based quality filter: a threshold table compiled into Spark expressions.

Every measure is a built-in expression on the text (no user function, no shuffle), so a document costs one pass in
the scan task that reads it. Windows of eight words are compared by a chained 64-bit hash within one document.

Defined cases: a null text counts as an empty one; an empty text has zero words, fails the base rule and isn't kept;
repeated rows are judged one by one; other columns of the input are neither read nor returned.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE_CHARS, SPACE_CLASS, table

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to a in that is it for on with as are by this be or was an from have not you "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde sei "
    "le la les de des du et un une en que qui dans pour par sur pas au aux plus ce est ne se il elle avec son sa ou "
    "el los las y del al con por una su para como más lo pero sus si ya entre este"
).split()


@dataclass(frozen=True)
class Rule:
    """``measure`` (a SQL expression over the measured columns) must lie within [low, high]."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None

    def passed(self) -> Column:
        m = F.expr(self.measure)
        ok = F.lit(True)
        if self.low is not None:
            ok = ok & (m >= F.lit(self.low))
        if self.high is not None:
            ok = ok & (m <= F.lit(self.high))
        return F.coalesce(ok, F.lit(False))


RULES = (
    Rule("words", "n_words", 20, None),
    Rule("mean_word_length", "word_chars / greatest(n_words, 1)", 2.0, 14.0),
    Rule("symbols_per_word", "n_symbols / greatest(n_words, 1)", None, 0.25),
    Rule("exclamations_per_word", "n_marks / greatest(n_words, 1)", None, 0.5),
    Rule("stop_word_share", "n_stop / greatest(n_words, 1)", 0.005, None),
    Rule("same_as_previous_word", "n_same / greatest(n_words, 1)", None, 0.3),
    Rule("repeated_lines", "n_dup_lines / greatest(n_lines, 1)", None, 0.7),
)


def measured(documents: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key and the measures of each text: n_words, word_chars, n_symbols, n_marks, n_stop, n_same, n_lines,
    n_dup_lines, n_repeat_words.

    Arrays are bound to columns before an array function uses them more than once, and reach lambdas only as
    their arguments, so each is built once for a row.
    """
    d = documents.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    d = d.select("_key", "_text", F.btrim("_text", F.lit(SPACE_CHARS)).alias("_trim"))
    no_words = F.array().cast("array<string>")
    d = d.select(
        "_key", "_text",
        F.when(F.col("_trim") == "", no_words).otherwise(F.split("_trim", f"[{SPACE_CLASS}]+")).alias("_words"),
        F.filter(F.split("_text", "\n"), lambda x: x.rlike(f"[^{SPACE_CLASS}]")).alias("_lines"),
    )
    d = d.select(
        "_key",
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("_text", F.lit("!")).cast("long").alias("n_marks"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_h1"),
    )
    after = lambda c, k: F.slice(c, k + 1, F.size(c))
    chain = lambda c, k: F.zip_with(c, after(c, k), lambda a, b: F.xxhash64(a, b))
    keep = ["_key", "n_words", "word_chars", "n_symbols", "n_marks", "n_lines", "n_dup_lines"]
    same = F.zip_with("_h1", after("_h1", 1), lambda a, b: a == b)
    # Stop words are known by their hashes: the lambda compares longs instead of lower-casing every word.
    stops = [F.xxhash64(F.lit(w)) for w in sorted({x for w in STOP_WORDS for x in (w, w.capitalize(), w.upper())})]
    d = d.select(
        *keep,
        F.size(F.filter(same, lambda x: x)).cast("long").alias("n_same"),
        F.size(F.filter("_h1", lambda h: h.isin(*stops))).cast("long").alias("n_stop"),
        chain("_h1", 1).alias("_h2"),
    )
    keep += ["n_same", "n_stop"]
    d = d.select(*keep, chain("_h2", 2).alias("_h4"))
    d = d.select(*keep, F.slice(chain("_h4", 4), 1, F.greatest(F.col("n_words") - (WINDOW - 1), F.lit(0)).cast("int")).alias("_win"))
    # Only documents with an equal pair of windows go on to the sort.
    d = d.select(*keep, F.when(F.size(F.array_distinct("_win")) < F.size("_win"), F.col("_win")).alias("_win"))
    d = d.select(*keep, F.sort_array(F.transform("_win", lambda h, i: F.struct(h.alias("h"), i.alias("i")))).alias("_sorted"))
    next_equal = F.zip_with("_sorted", after("_sorted", 1), lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False)))
    d = d.select(*keep, "_sorted", next_equal.alias("_next"))
    either = F.zip_with("_next", F.concat(F.array(F.lit(False)), F.slice("_next", 1, F.size("_next") - 1)), lambda a, b: a | b)
    at = F.filter(F.zip_with("_sorted", either, lambda x, hit: F.when(hit, x["i"])), lambda x: x.isNotNull())
    d = d.select(*keep, F.when(F.col("_sorted").isNotNull(), F.sort_array(at)).alias("_at"))
    covered = F.zip_with("_at", after("_at", 1), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda s, x: s + x)
    return d.select(F.col("_key").alias(key), *keep[1:], F.coalesce(total, F.lit(0).cast("long")).alias("n_repeat_words"))


def quality_rules(documents: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, measures, base_failed, kept, and failed_rules (names of the rules that a text breaks, in table order)."""
    m = measured(documents, text, key)
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    broken = F.filter(F.array(*[F.when(~r.passed(), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull()) if rules else F.array().cast("array<string>")
    m = m.withColumn("base_failed", base).withColumn("failed_rules", broken)
    return m.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = quality_rules(table(spark, sf_dir, "documents"))
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                    F.array_join("failed_rules", ",").alias("failed_rules"))
