"""URL rules by a sorted sweep over reversed-host keys.

A host becomes the key of its reversed labels, each ended by a dot (``www.example.com`` -> ``com.example.www.``), so
a host and all its subdomains are the interval [key, key with the last dot replaced by ``/``), ``/`` being the
character after the dot. Rule hosts give the ends of nested intervals; urls and ends are sorted by key, and the last
end at or before a url carries the stack of the rules that are active there. Of that stack the longest rule wins whose
path starts the url's path.

The sweep runs in windows over (first label, salt): an interval never leaves its first label, and the salt splits a
label that holds many urls into as many sorted runs as are needed; the ends, which come from the rule table alone, are
repeated for each salt.

Defined cases: a null url, or one without ``://``, has an empty host and path and no rule; an empty table gives an
empty result; repeated rows are judged one by one; other columns of the input are neither read nor returned. Two rules
of one host and path: block goes before allow.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

# The rules (host, path, verdict) of the registered query.
PAGE_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
# Host words for which a url without a rule is blocked.
BLOCK_WORDS = ("adult", "bet", "bets", "betting", "casino", "gambling", "jackpot", "poker", "porn", "sex", "slots", "viagra", "warez", "xxx")
ROWS_PER_RUN = 20_000
RULE_SCHEMA = "array<struct<host:string,path:string,verdict:string>>"


def rule_table(spark: SparkSession, rules: tuple[tuple[str, str, str], ...]) -> DataFrame:
    """Rules given as constants, as a table (host, path, verdict)."""
    rows = json.dumps([{"host": h, "path": p, "verdict": v} for h, p, v in rules])
    return spark.range(1).select(F.inline(F.from_json(F.lit(rows), RULE_SCHEMA)))


def url_host(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def first_label(host: Column) -> Column:
    return F.element_at(F.split(host, r"\."), -1)


def interval_ends(rules: DataFrame) -> DataFrame:
    """(label, key, kind, stack): both ends of each rule host's interval, with the rules active from there on.

    The stack at a start holds the rules of the host and of the hosts above it; at an end, of those above it.
    """
    labels = F.split(F.col("host"), r"\.")
    per_host = rules.groupBy("host").agg(F.collect_list(F.struct("host", "path", "verdict")).alias("own"))
    # Each rule host and the hosts above it: the suffixes of its labels.
    above = per_host.select("host", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.array_join(F.slice(labels, -n, n), "."))).alias("upper"))
    active = (
        above.join(per_host.select(F.col("host").alias("upper"), "own"), "upper")
        .groupBy("host").agg(
            F.flatten(F.collect_list("own")).alias("inside"),
            F.flatten(F.collect_list(F.when(F.col("upper") != F.col("host"), F.col("own")))).alias("outside"),
        )
    )
    key = host_key(F.col("host"))
    start = active.select(first_label(F.col("host")).alias("label"), key.alias("key"), F.lit(1).alias("kind"), F.col("inside").alias("stack"))
    past = F.concat(F.substring(key, F.lit(1), F.char_length(key) - 1), F.lit("/"))
    end = active.select(first_label(F.col("host")).alias("label"), past.alias("key"), F.lit(0).alias("kind"), F.col("outside").alias("stack"))
    return start.unionByName(end)


def winner(stack: Column, path: Column) -> Column:
    """The longest rule of the stack that the path fits: (size, host size, blocks, rule, verdict); null if none."""
    fits = F.filter(stack, lambda r: path.startswith(r["path"]))
    return F.array_max(F.transform(fits, lambda r: F.struct(
        (F.char_length(r["host"]) + F.char_length(r["path"])).alias("size"),
        F.char_length(r["host"]).alias("host_size"),
        (r["verdict"] == "block").alias("blocks"),
        F.concat(r["host"], r["path"]).alias("rule"),
        r["verdict"].alias("verdict"),
    )))


def url_verdicts(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", rows_per_run: int = ROWS_PER_RUN) -> DataFrame:
    """key, host, path, rule (host and path of the winning rule, or null) and verdict of every url.

    Without a rule a url is blocked if a word of its host is in BLOCK_WORDS, else allowed.
    """
    spark = pages.sparkSession
    # One run holds at most about rows_per_run urls of one label, however many that label has.
    salts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-pages.count() // rows_per_run))
    d = pages.select(F.col(key).alias("_id"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    salt = F.pmod(F.xxhash64("_id", "host", "path"), F.lit(salts)).cast("int")
    points = d.select(first_label(F.col("host")).alias("label"), salt.alias("salt"), host_key(F.col("host")).alias("key"), F.lit(2).alias("kind"), "_id", "host", "path")
    ends = interval_ends(rules).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    sweep = Window.partitionBy("label", "salt").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = (
        points.unionByName(ends, allowMissingColumns=True)
        .withColumn("active", F.last("stack", ignorenulls=True).over(sweep))
        .where(F.col("kind") == 2)
    )
    best = swept.select("_id", "host", "path", winner(F.col("active"), F.col("path")).alias("best"))
    blocked = F.col("host").rlike(r"(^|[.\-])(" + "|".join(BLOCK_WORDS) + r")([.\-]|$)")
    default = F.when(blocked, F.lit("block")).otherwise(F.lit("allow"))
    return best.select(F.col("_id").alias(key), "host", "path", F.col("best.rule").alias("rule"), F.coalesce(F.col("best.verdict"), default).alias("verdict"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages"), rule_table(spark, PAGE_RULES))


# Each rule tested on its own against host and path; the CASE order is by falling rule length.
_RULE_CASES = [
    (f"{h}{p}", f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", v)
    for h, p, v in sorted(PAGE_RULES, key=lambda r: -len(r[0] + r[1]))
]
OP6_SQL = f"""
WITH split AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
)
SELECT page_id, host, path,
  CASE {' '.join(f"WHEN {test} THEN '{name}'" for name, test, _ in _RULE_CASES)} END AS rule,
  CASE {' '.join(f"WHEN {test} THEN '{verdict}'" for _, test, verdict in _RULE_CASES)}
    WHEN len(list_intersect(string_split_regex(host, '[.-]'), [{', '.join(f"'{w}'" for w in BLOCK_WORDS)}])) > 0 THEN 'block'
    ELSE 'allow' END AS verdict
FROM split
"""
