"""Upserts and insert-if-new: idempotence, duplicate keys, first write wins."""

import pytest
from pyspark.sql import functions as F

from adjudica.operators import merge as M


def _t(spark, rows):
    return spark.createDataFrame(rows, "k long, a string, b long")


def test_upsert_overwrites_and_inserts(spark):
    t = _t(spark, [(1, "x", 1), (2, "y", 2)])
    s = _t(spark, [(2, "Y", 20), (3, "z", 3)])
    out = sorted(map(tuple, M.merge_upsert(t, s, ["k"]).collect()))
    assert out == [(1, "x", 1), (2, "Y", 20), (3, "z", 3)]


def test_upsert_idempotent(spark):
    t = _t(spark, [(1, "x", 1), (2, "y", 2)])
    s = _t(spark, [(2, "Y", 20), (3, "z", 3)])
    once = M.merge_upsert(t, s, ["k"])
    twice = M.merge_upsert(once, s, ["k"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_duplicate_source_key_fails(spark):
    t = _t(spark, [(1, "x", 1)])
    s = _t(spark, [(1, "a", 1), (1, "b", 2)])
    with pytest.raises(ValueError):
        M.merge_upsert(t, s, ["k"]).collect()


def test_listed_columns_keep_others(spark):
    t = _t(spark, [(1, "x", 1)])
    s = spark.createDataFrame([(1, 10), (2, 20)], "k long, b long")
    out = sorted(map(tuple, M.merge_upsert(t, s, ["k"], update_cols=["b"]).collect()))
    assert out == [(1, "x", 10), (2, None, 20)]


def test_first_write_wins_stable_on_rerun(spark):
    t = spark.createDataFrame([(1, "VERDE", None, 5)], "k long, light string, p double, d long")
    s = spark.createDataFrame([(1, "ROJO", 0.3, 7), (2, "AMARILLO", 0.5, 1)], "k long, light string, p double, d long")
    once = M.merge_first_write_wins(t, s, ["k"], sticky_cols=["light", "p"], update_cols=["d"])
    got = {r["k"]: tuple(r) for r in once.collect()}
    assert got[1] == (1, "VERDE", 0.3, 7)      # sticky keeps old non-null, fills null
    assert got[2] == (2, "AMARILLO", 0.5, 1)   # insert
    twice = M.merge_first_write_wins(once, s, ["k"], sticky_cols=["light", "p"], update_cols=["d"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_append_new_second_run_adds_nothing(spark):
    t = _t(spark, [(1, "x", 1)])
    s = _t(spark, [(1, "x", 1), (2, "y", 2)])
    new = M.append_new(s, t, ["k"])
    t2 = t.unionByName(new)
    assert M.append_new(s, t2, ["k"]).count() == 0
    assert t2.count() == 2


def test_anti_join_null_keys_not_matched(spark):
    t = _t(spark, [(None, "x", 1)])
    s = _t(spark, [(None, "y", 2)])
    assert M.anti_join_existing(s, t, ["k"]).count() == 1   # NOT EXISTS with NULL = never matches
