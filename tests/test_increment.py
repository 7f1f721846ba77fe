"""N1 properties: a 3-day increment equals three 1-day increments (metrics),
and re-running an increment adds nothing."""

import datetime as dt

from pyspark.sql import functions as F

from adjudica.plans.increment import run_increment
from adjudica.session import cut_lineage
from adjudica.sources import analogues as an
from tests.conftest import SF

METRICS = ["CANT_LIC_U15D", "COMPIN_RATIFICA_U15D", "TOTAL_DIAS_SOLICITADOS_U15D", "HV_N_PRESTACIONES_U15D",
           "PERITAJES_TOTAL_U15D"]


def _inputs(spark):
    claims = an.claims_from_orders(spark, SF)
    return claims, an.services_from_lineitem(spark, SF), an.exams_from_events(spark, SF)


def test_three_days_equal_three_single_days(spark):
    claims, services, exams = _inputs(spark)
    d0 = dt.date(1998, 3, 1)
    base = claims.where(F.col("FECHA_RECEPCION") < F.lit(d0))
    wide = base.select("AFILIADO_RUT", "FECHA_RECEPCION", "LCC_COMCOR", "LCC_COMCOD")
    three = run_increment(claims, base, None, wide, services, exams, d0, d0 + dt.timedelta(2),
                          d0 + dt.timedelta(3))
    got3 = {tuple(r[:3]): tuple(r[3:]) for r in three.new_wide.select("AFILIADO_RUT", "LCC_COMCOR", "LCC_COMCOD",
                                                                       *METRICS).collect()}
    b, w, got1 = base, wide, {}
    for i in range(3):
        day = d0 + dt.timedelta(i)
        r = run_increment(claims, b, None, w, services, exams, day, day, day + dt.timedelta(1))
        rows = r.new_wide.select("AFILIADO_RUT", "LCC_COMCOR", "LCC_COMCOD", *METRICS).collect()
        got1.update({tuple(x[:3]): tuple(x[3:]) for x in rows})
        # a real run writes the tables between days: cut the lineage likewise
        b = cut_lineage(b.unionByName(r.new_base, allowMissingColumns=True))
        w = cut_lineage(w.unionByName(r.new_wide.select(*w.columns)))
    assert got3 == got1 and len(got3) > 0


def test_rerun_adds_nothing(spark):
    claims, services, exams = _inputs(spark)
    d0 = dt.date(1999, 6, 1)
    base = claims.where(F.col("FECHA_RECEPCION") < F.lit(d0))
    wide = base.select("AFILIADO_RUT", "FECHA_RECEPCION", "LCC_COMCOR", "LCC_COMCOD")
    r = run_increment(claims, base, None, wide, services, exams, d0, d0 + dt.timedelta(6), d0 + dt.timedelta(7))
    base2 = base.unionByName(r.new_base, allowMissingColumns=True)
    wide2 = wide.unionByName(r.new_wide.select(*wide.columns))
    r2 = run_increment(claims, base2, r.metrics_table, wide2, services, exams, d0, d0 + dt.timedelta(6),
                       d0 + dt.timedelta(7))
    assert r2.new_base.count() == 0 and r2.new_wide.count() == 0
    assert r2.metrics_table.count() == r.metrics_table.count()
