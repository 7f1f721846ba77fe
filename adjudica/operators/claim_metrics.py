"""Fifteen-day claim, service and exam metrics (survey D1-D3, C6).

Every metric set is one row per (person, probe day) with anything to tell
(``lookback_days``).  C6 combines the three sets by full outer joins on those
compact keys and attaches the result to the claims once.  Missing metrics take
the reference defaults (0 for counts, sums and flags, 9999 for "days since",
ratios stay NULL).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lookback import PROBE_DAY, attach_days, lookback_days

PERSON = "AFILIADO_RUT"
CLAIM_KEYS = [PERSON, "LCC_COMCOR", "LCC_COMCOD"]


def distinct_probes(claims: DataFrame, date_from=None, date_to=None,
                    date_col: str = "FECHA_RECEPCION") -> DataFrame:
    """Claims received in ``[date_from, date_to]`` (inclusive days), one row per claim."""
    from ..functions.dates import date_window
    c = claims.where(date_window(F.col(date_col), date_from, date_to))
    c = c.select(*CLAIM_KEYS, F.to_date(date_col).alias("FECHA_RECEPCION"))
    # de-duplicated on the whole claim key: a person's or a day's claims are never one group
    return c.dropDuplicates()


def _flag(c: Column) -> Column:
    return F.max(F.when(c, 1).otherwise(0))


CLAIM_DEFAULTS = {
    "CANT_LIC_U15D": 0, "CANT_LIC_CON_RESOLUCION_U15D": 0, "COMPIN_RATIFICA_U15D": 0,
    "COMPIN_DENIEGA_U15D": 0, "F_DIAS_PROMEDIO_U15D": 0.0, "TOTAL_DIAS_SOLICITADOS_U15D": 0,
    "MAX_DIAS_SOLICITADOS_U15D": 0, "FLAG_MULTIPLES_LIC_U15D": 0,
}
SERVICE_DEFAULTS = {
    "HV_N_PRESTACIONES_U15D": 0, "HV_SUM_CANTIDAD_PREST_U15D": 0.0, "HV_N_MEDICOS_U15D": 0,
    "HV_FLAG_HOSPITALARIO_U15D": 0, "HV_FLAG_BONO_U15D": 0, "HV_FLAG_REEMBOLSO_U15D": 0,
    "HV_FLAG_GES_U15D": 0, "HV_FLAG_CAEC_U15D": 0,
}
EXAM_DEFAULTS = {
    "PERITAJES_TOTAL_U15D": 0, "PERITAJES_NO_ASISTE_U15D": 0, "PERITAJES_DESACUERDO_U15D": 0,
    "PERITAJES_ACUERDO_U15D": 0, "DIAS_DESDE_ULTIMO_PERITAJE_U15D": 9999,
    "FLAG_PERITAJE_RECIENTE_U15D": 0,
}


def _attached(probes: DataFrame, per_day: DataFrame, defaults: dict, fill: bool) -> DataFrame:
    out = attach_days(probes, per_day, PERSON, "FECHA_RECEPCION")
    return out.fillna(defaults) if fill else out


def claim_days(probes: DataFrame, history: DataFrame, days: int = 15, date_from=None, date_to=None) -> DataFrame:
    """D1 per (person, probe day) with earlier claims."""
    verdict = F.upper(F.col("RESOLUCION_COMPIN"))
    allowed = F.when(F.col("F_DIASAUTORIZADOS") > 0, F.col("F_DIASAUTORIZADOS"))
    # one row per (person, day, claim number), before and again after the pairing -> distinct counts become counts
    first = {
        "__res": F.max(F.when(F.col("FECHA_RESOLUCION_COMPIN").isNotNull(), 1).otherwise(0)),
        "__ver": F.max(F.when(verdict.isNotNull(), 1).otherwise(0)),
        "__rat": F.max(F.when(verdict == "RATIFICA", 1).otherwise(0)),
        "__den": F.max(F.when(verdict == "DENIEGA", 1).otherwise(0)),
        "__dm": F.max("DIASSOLICITADO"),
        "__fs": F.sum(allowed), "__fc": F.count(allowed), "__ds": F.sum("DIASSOLICITADO"),
    }
    again = [(F.sum(c) if c in ("__fs", "__fc", "__ds") else F.max(c)).alias(c) for c in first]

    def numbers(c):
        return F.sum(F.when(F.col("LCC_COMCOR").isNotNull(), F.col(c)).otherwise(0))

    aggs = [
        F.count("LCC_COMCOR").alias("CANT_LIC_U15D"),
        numbers("__res").alias("CANT_LIC_CON_RESOLUCION_U15D"),
        numbers("__rat").alias("COMPIN_RATIFICA_U15D"),
        numbers("__den").alias("COMPIN_DENIEGA_U15D"),
        numbers("__ver").alias("__verdicts"),
        (F.sum("__fs") / F.sum("__fc")).alias("F_DIAS_PROMEDIO_U15D"),
        F.sum("__ds").alias("TOTAL_DIAS_SOLICITADOS_U15D"),
        F.max("__dm").alias("MAX_DIAS_SOLICITADOS_U15D"),
    ]
    h = history.select(PERSON, "LCC_COMCOR", "FECHA_RECEPCION", "FECHA_RESOLUCION_COMPIN",
                       "RESOLUCION_COMPIN", "F_DIASAUTORIZADOS", "DIASSOLICITADO")
    out = lookback_days(probes, h, PERSON, "FECHA_RECEPCION", "FECHA_RECEPCION", aggs, days=days,
                        date_from=date_from, date_to=date_to,
                        reduce=(["LCC_COMCOR"], [c.alias(n) for n, c in first.items()]),
                        pre_group=["LCC_COMCOR"], pre_aggs=again)
    n_ver = F.col("__verdicts")  # claims with a verdict, dated or not
    return (out.withColumn("FLAG_MULTIPLES_LIC_U15D", F.when(F.col("CANT_LIC_U15D") > 1, 1).otherwise(0))
               .withColumn("RATIO_APROBACION_U15D",
                           F.when(n_ver > 0, F.col("COMPIN_RATIFICA_U15D").cast("double") / n_ver))
               .drop("__verdicts"))


def claim_metrics_15d(probes: DataFrame, history: DataFrame, days: int = 15,
                      date_from=None, date_to=None, fill: bool = True) -> DataFrame:
    """The person's own claims received in the ``days`` days before each claim."""
    return _attached(probes, claim_days(probes, history, days, date_from, date_to), CLAIM_DEFAULTS, fill)


def service_days(probes: DataFrame, services: DataFrame, days: int = 15, date_from=None, date_to=None,
                 types=("HOSPITALARIO", "BONO", "REEMBOLSO")) -> DataFrame:
    """D2 per (person, probe day) with services of the given types."""
    tipo = F.upper(F.col("TIPO"))
    flags = {f"HV_FLAG_{t}_U15D": tipo == t for t in ("HOSPITALARIO", "BONO", "REEMBOLSO")}
    flags |= {f"HV_FLAG_{p}_U15D": F.col(f"PATOLOGIA_{p}") == p for p in ("GES", "CAEC")}
    amount = "HV_SUM_CANTIDAD_PREST_U15D"
    # distinct folios and distinct doctors are counted in one pass over the pairs
    return lookback_days(probes, services, PERSON, "FECHA_RECEPCION", "FECHA", [],
                         days=days, hist_key="COTIZANTE_RUT", hist_filter=tipo.isin(*types),
                         date_from=date_from, date_to=date_to,
                         reduce=(["FOLIO", "MEDTRATANTE_RUT"], [F.sum("PRESTACION_CANTIDAD").alias(amount),
                                                                *[_flag(c).alias(f) for f, c in flags.items()]]),
                         distinct={"HV_N_PRESTACIONES_U15D": "FOLIO", "HV_N_MEDICOS_U15D": "MEDTRATANTE_RUT"},
                         merge={amount: "sum", **{f: "max" for f in flags}})


def service_metrics_15d(probes: DataFrame, services: DataFrame, days: int = 15,
                        date_from=None, date_to=None, fill: bool = True,
                        types=("HOSPITALARIO", "BONO", "REEMBOLSO")) -> DataFrame:
    """Services of the person in the look-back window (type filter inside the join)."""
    return _attached(probes, service_days(probes, services, days, date_from, date_to, types), SERVICE_DEFAULTS, fill)


def exam_days(probes: DataFrame, exams: DataFrame, days: int = 15, date_from=None, date_to=None) -> DataFrame:
    """D3 per (person, probe day) with examinations."""
    date = "PERITAJE_PERITAJE_FECHA_CITACION"
    att, agr = F.col("ASISTENCIA"), F.col("ACUERDO_DESACUERDO")
    # the history is one row per (person, exam date) before the pairing -> distinct dates are counts
    outcomes = {"NO_ASISTE": att == "NO ASISTE", "DESACUERDO": (att == "ASISTE") & (agr == "DESACUERDO"),
                "ACUERDO": (att == "ASISTE") & (agr == "ACUERDO")}
    aggs = [F.count(date).alias("PERITAJES_TOTAL_U15D"),
            *[F.sum(f"__{o}").alias(f"PERITAJES_{o}_U15D") for o in outcomes], F.max(date).alias("__last_exam")]
    out = lookback_days(probes, exams, PERSON, "FECHA_RECEPCION", date, aggs, days=days,
                        date_from=date_from, date_to=date_to,
                        reduce=([], [_flag(c).alias(f"__{o}") for o, c in outcomes.items()]))
    return (out.withColumn("DIAS_DESDE_ULTIMO_PERITAJE_U15D", F.datediff(F.col(PROBE_DAY), F.col("__last_exam")))
               .withColumn("FLAG_PERITAJE_RECIENTE_U15D", F.lit(1)).drop("__last_exam"))


def exam_metrics_15d(probes: DataFrame, exams: DataFrame, days: int = 15,
                     date_from=None, date_to=None, fill: bool = True) -> DataFrame:
    """D3: expert examinations of the person in the look-back window."""
    return _attached(probes, exam_days(probes, exams, days, date_from, date_to), EXAM_DEFAULTS, fill)


def full_outer_combine(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Full outer join of metric sets on shared keys (keys coalesced)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f, keys, "full_outer")
    return out


def metrics_15d(probes: DataFrame, history: DataFrame, services: DataFrame, exams: DataFrame,
                as_of, days: int = 15, date_from=None, date_to=None, keep_reception_date: bool = False) -> DataFrame:
    """Table of the three 15-day metric sets per claim, defaults applied.

    The sets are combined by full outer joins on (person, probe day), where
    each holds only the keys it has something for, and attached to the claims
    by one join.  ``keep_reception_date`` keeps the claim's reception date
    (the partition column of a partitioned metrics table).
    """
    p = probes.select(*CLAIM_KEYS, "FECHA_RECEPCION")
    span = (days, date_from, date_to)
    sets = full_outer_combine([claim_days(p, history, *span), service_days(p, services, *span), exam_days(p, exams, *span)],
                              [PERSON, PROBE_DAY])
    out = _attached(p, sets, {**CLAIM_DEFAULTS, **SERVICE_DEFAULTS, **EXAM_DEFAULTS}, True)
    out = out.withColumn("FECHA_CALCULO", F.lit(as_of).cast("date"))
    # keep the reception date when the table is partitioned by it (partition-scoped upserts)
    return out if keep_reception_date else out.drop("FECHA_RECEPCION")
