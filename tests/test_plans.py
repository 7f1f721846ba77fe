"""Plan lint: no registered query may contain a cartesian product or a
broadcast nested-loop join; Expand is allowed only where two different
columns are counted distinct over the already-paired look-back rows."""

from tests.conftest import SF
from tools.plan_lint import lint

EXPAND_OK: set[str] = set()


def test_no_non_scaling_operators(spark):
    found = lint(spark, SF)
    bad = {k: [h for h in v if not (h == "Expand" and k in EXPAND_OK)] for k, v in found.items()}
    assert {k: v for k, v in bad.items() if v} == {}


def test_daily_increment_prunes_history_scan(spark, tmp_path):
    from pyspark.sql import functions as F
    from adjudica.operators import claim_metrics as CM
    from adjudica.sources import analogues as an
    an.claims_from_orders(spark, SF).write.parquet(str(tmp_path / "claims"))
    c = spark.read.parquet(str(tmp_path / "claims"))
    out = CM.claim_metrics_15d(CM.distinct_probes(c, "2000-03-01", "2000-03-01"), c,
                               date_from="2000-03-01", date_to="2000-03-01")
    txt = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(FECHA_RECEPCION,2000-02-15)" in txt
    assert "LessThan(FECHA_RECEPCION,2000-03-01)" in txt
