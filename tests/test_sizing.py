"""Key checks of a merge source, and joins that leave their form to Spark."""

import pytest

from adjudica.operators.merge import anti_join_existing
from adjudica.plans.sizing import assert_unique


def test_assert_unique(spark):
    d = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert_unique(d, ["k"])
    with pytest.raises(ValueError):
        assert_unique(d.unionAll(d.limit(1)), ["k"])


def test_anti_join_starts_no_job_while_built(spark):
    new, old = spark.range(10).toDF("k"), spark.range(5).toDF("k")
    out = anti_join_existing(new, old, ["k"])
    assert "ResolvedHint" not in out._jdf.queryExecution().analyzed().toString()
    assert out.count() == 5
