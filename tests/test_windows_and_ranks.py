"""Monthly windows, one-pass distinct counts and split history ranks against plain versions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from adjudica.operators.joins import history_rank
from adjudica.operators.lookback import lookback_days
from adjudica.operators.monthly import Measure, _blocks, monthly_metrics

D = dt.date


@pytest.mark.parametrize("windows", [(1, 6, 12, 24, 36), (2, 3), (5,)])
@pytest.mark.parametrize("until", [None, D(2021, 3, 15)])
def test_monthly_windows_equal_a_plain_scan(spark, windows, until):
    rng = random.Random(len(windows))
    rows = []
    for e in "abcd":
        month = 12 * 2015
        for _ in range(25):
            month += rng.choice([0, 0, 1, 1, 2, 5, 11, 36, 37, 40])  # gaps around the longest window
            rows.append((e, D(month // 12, month % 12 + 1, rng.randint(1, 28)), rng.choice([None, 1, 7, -3]),
                         rng.choice([None, 0.1, 0.2, 1e9, -1e9, 0.7]), rng.choice([None, "x", "y", "z"])))
    rows += [(None, D(2020, 1, 1), 1, 1.0, "x"), ("a", None, 1, 1.0, "x")]
    df = spark.createDataFrame(rows, "e string, d date, n int, x double, v string").repartition(3)
    kinds = [("N", "count", "n"), ("S", "sum", "n"), ("XS", "sum", "x"), ("M", "mean", "n"), ("XM", "mean", "x"), ("LO", "min", "x"),
             ("HI", "max", "n"), ("V", "distinct", "v"), ("W", "distinct", "n")]
    got = monthly_metrics(df, "e", "d", [Measure(n, k, F.col(c)) for n, k, c in kinds], windows, until=until).collect()
    idx = lambda d: d.year * 12 + d.month - 1
    spine = {(e, idx(d) + k) for e, d, *_ in rows if e and d for k in range(max(windows))}
    if until:
        spine = {(e, t) for e, t in spine if t <= idx(until)}
    seen = {}
    for r in got:
        seen[r["e"], int(r["PERIODO"][2:]) * 12 + int(r["PERIODO"][:2]) - 1] = r
    assert len(seen) == len(got) and set(seen) == spine
    at = {"n": 2, "x": 3, "v": 4}
    for (e, t), r in seen.items():
        for w in windows:
            inside = [q for q in rows if q[0] == e and q[1] and t - w < idx(q[1]) <= t]
            for name, kind, c in kinds:
                values = [q[at[c]] for q in inside if q[at[c]] is not None]
                want = {"count": len(values), "distinct": len(set(values))}.get(kind)
                if want is None and values:
                    want = {"sum": sum(values), "mean": sum(values) / len(values), "min": min(values), "max": max(values)}[kind]
                have = r[f"{name}_U{w}M"]
                assert have == want or have is not None and abs(have - want) <= 1e-6, (e, t, w, name, have, want)


def test_blocks_make_up_the_window():
    for w in range(1, 70):
        months = [back + k for size, back in _blocks(w) for k in range(size)]
        assert sorted(months) == list(range(w))


def test_distinct_counts_of_several_columns_in_one_join(spark):
    rng = random.Random(3)
    probes = [(p, D(2024, 1, 1) + dt.timedelta(days=rng.randint(0, 40))) for p in "ab" for _ in range(8)]
    events = [(rng.choice("abc"), D(2024, 1, 1) + dt.timedelta(days=rng.randint(-20, 40)), rng.choice([None, "f", "g", "h"]),
               rng.choice([None, 1, 2]), rng.randint(0, 5)) for _ in range(200)]
    p = spark.createDataFrame(probes, "k string, t date")
    h = spark.createDataFrame(events, "k string, d date, f string, m int, a int")
    out = lookback_days(p, h, "k", "t", "d", [], distinct={"NF": "f", "NM": "m"}, merge={"a": "sum", "x": "max"},
                        reduce=(["f", "m"], [F.sum("a").alias("a"), F.max("a").alias("x")]))
    want = set()
    for k, t in set(probes):
        near = [e for e in events if e[0] == k and 1 <= (t - e[1]).days <= 15]
        if near:
            want.add((k, t, len({e[2] for e in near} - {None}), len({e[3] for e in near} - {None}), sum(e[4] for e in near), max(e[4] for e in near)))
    assert {tuple(r) for r in out.select("k", "__lb_day", "NF", "NM", "a", "x").collect()} == want
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_history_rank_splits_a_hot_person_month(spark):
    """One person's month holds over a third of all rows; no part holds more than a few times the mean."""
    order = ["d", "n"]
    hist = spark.range(30_000).select(
        F.when(F.col("id") < 12_000, F.lit("hot")).otherwise(F.concat(F.lit("p"), F.col("id") % 500)).alias("p"),
        F.when(F.col("id") < 12_000, F.lit(D(2024, 5, 7))).otherwise(F.date_add(F.lit(D(2023, 1, 1)), (F.col("id") % 700).cast("int"))).alias("d"),
        (F.col("id") * 7 % 30_011).alias("n"))
    new = spark.range(3_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), F.col("id") % 500)).alias("p"),
                                    F.lit(D(2024, 5, 7)).alias("d"), (F.col("id") * 10).alias("n"), F.col("id").alias("payload"))
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = history_rank(new, hist, "p", order).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    by = {}
    for r in hist.collect():
        by.setdefault(r["p"], []).append((r["d"], r["n"]))
    assert len(got) == 3_000
    import bisect
    for rows in by.values():
        rows.sort()
    for r in got:
        assert r["RN_AFILIADO_HIST"] == 1 + bisect.bisect_left(by.get(r["p"], []), (r["d"], r["n"]))


def test_history_rank_of_repeated_history_rows(spark):
    schema = "p string, d date, n long"
    hist = spark.createDataFrame([("a", D(2025, 1, 1), 1)] * 50 + [("a", D(2025, 1, 3), 1)] * 5, schema)
    new = spark.createDataFrame([("a", D(2025, 1, 1), 1), ("a", D(2025, 1, 2), 1), ("a", D(2025, 1, 4), 1)], schema)
    got = {r["d"].day: r["RN_AFILIADO_HIST"] for r in history_rank(new, hist, "p", ["d", "n"]).collect()}
    assert got == {1: 1, 2: 51, 4: 56}


def test_monthly_windows_are_taken_where_a_month_enters_or_leaves_one(spark):
    rows = [("a", D(2020, 1, 5), 4, "x"), ("a", D(2020, 3, 5), 9, "x"), ("b", D(2020, 1, 5), None, None)]
    df = spark.createDataFrame(rows, "e string, d date, n long, v string")
    kinds = [("N", "count", "n"), ("S", "sum", "n"), ("LO", "min", "n"), ("HI", "max", "n"), ("V", "distinct", "v")]
    out = monthly_metrics(df, "e", "d", [Measure(n, k, F.col(c)) for n, k, c in kinds], (2, 36))
    plan = out._jdf.queryExecution().optimizedPlan()
    nodes, todo = [], [plan]
    while todo:
        p = todo.pop()
        nodes.append(p.nodeName())
        todo += [p.children().apply(i) for i in range(p.children().size())]
    # Periods without an event are filled in behind the window of the measures, and nothing is joined to them.
    assert "Join" not in nodes and nodes.count("Window") == 2 and nodes.index("Generate") < nodes.index("Window")
    got = {(r["e"], r["PERIODO"]): r for r in out.collect()}
    assert len(got) == 38 + 36
    want = {"012020": (1, 4, 4, 4, 1), "022020": (1, 4, 4, 4, 1), "032020": (1, 9, 9, 9, 1), "052020": (0, None, None, None, 0)}
    for p, values in want.items():
        assert tuple(got["a", p][f"{n}_U2M"] for n, _, _ in kinds) == values
    assert tuple(got["a", "022022"][f"{n}_U36M"] for n, _, _ in kinds) == (2, 13, 4, 9, 1)
    assert tuple(got["b", "122022"][f"{n}_U36M"] for n, _, _ in kinds) == (0, None, None, None, 0)
