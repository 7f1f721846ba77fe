"""Pipelines (survey N1-N4).

Each pipeline composes operators into DataFrame plans and returns them;
``write_*`` arguments (paths) persist results through the sinks.  One code
path serves one-day and multi-day increments (the date range is a
parameter); ``as_of`` replaces the wall clock so runs are reproducible.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expr as B
from ..operators import claim_metrics as CM
from ..operators import joins as J
from ..operators import merge as M
from ..roles import PRIOR_APPROVAL_COL
from ..session import cut_lineage
from . import mart_spec as MS

BASE_KEYS = ["AFILIADO_RUT", "LCC_COMCOR"]
WIDE_KEYS = ["LCC_COMCOR", "LCC_COMCOD"]
METRIC_KEYS = ["AFILIADO_RUT", "LCC_COMCOR", "LCC_COMCOD"]
PROVIDER_COLS = ["PRESTADOR_ESPECIALIDAD_PSC", "PREST_TOP_CIE_F", "PREST_TOP_GRUPOCIE", "PRESTADOR_TIPO",
                 "PREST_FECHA_INGRESO"]


@dataclass
class IncrementResult:
    new_base: DataFrame          # rows appended to the claim base (A6)
    metrics_table: DataFrame     # 15-day metrics table after the upsert (A8)
    new_wide: DataFrame          # rows appended to the wide feature table (A6)
    new_metrics: DataFrame | None = None  # this increment's metric rows (for partition-scoped upserts)


def run_increment(claims_input: DataFrame, base: DataFrame, metrics_table: DataFrame | None,
                  wide: DataFrame | None, services: DataFrame, exams: DataFrame, date_from, date_to, as_of,
                  provider_history: DataFrame | None = None, monthly: dict | None = None,
                  days: int = 15, lexicographic_periods: bool = False,
                  keep_reception_date: bool = False, monthly_defaults: dict | None = None,
                  ratios: dict | None = None, prior_source: str | None = None,
                  mart: "MS.MartSpec | None" = None) -> IncrementResult:
    """Append new claims -> 15-day metrics upsert -> append wide rows.

    * claims received in ``[date_from, date_to]`` that are not in the base are
      appended, enriched with the provider's newest history row before the
      day preceding ``as_of`` (C1);
    * the 15-day metrics of those claims are computed once (D1-D3), materialised,
      upserted into the metrics table (A8) and reused for the wide rows;
    * wide rows get the person's history rank (E2), the newest monthly
      metrics per entity (C7) with ``monthly_defaults`` filled in and
      ``ratios`` ({name: (numerator, denominator)}, denominator 0 -> 0, missing
      entity -> NULL; B14) derived from them, outcome flags (B13), and are
      appended when their (claim, code) is not yet in the wide table (C2).
      ``prior_source`` names the column that tells a prior approval.  With
      ``mart`` (``mart_spec.wide_spec``) they have exactly its columns, with
      its ratios and defaults.

    Provider, person and entity histories are cut to the increment's own keys
    (and days) by semi joins before they are aggregated or ranked, so a daily
    run moves what belongs to its claims, not the whole history.
    """
    inp = claims_input.where(B.date_window("FECHA_RECEPCION", date_from, date_to))
    if provider_history is not None and "LCC_MEDRUT" in inp.columns:
        cutoff = F.date_sub(F.lit(as_of).cast("date"), 1)
        prov = provider_history.where(F.to_date("FECHA_RECEPCION") < cutoff) \
            .join(inp.select(F.col("LCC_MEDRUT").alias("PRESTADOR_RUT")).distinct(), "PRESTADOR_RUT", "left_semi")
        inp = J.join_latest_row(inp, prov.select("PRESTADOR_RUT", "FECHA_RECEPCION", *PROVIDER_COLS)
                                .withColumnRenamed("FECHA_RECEPCION", "__prov_fecha"),
                                ["LCC_MEDRUT"], ["PRESTADOR_RUT"], ["__prov_fecha"]).drop("__prov_fecha")
    new_base = M.anti_join_existing(inp, base, BASE_KEYS)
    # the increment's new claims feed every later branch (probes, look-back
    # history, wide rows): materialise them once, as the base insert does
    new_base = cut_lineage(new_base)
    history = base.unionByName(new_base, allowMissingColumns=True)
    probes = CM.distinct_probes(history, date_from, date_to)
    m15 = CM.metrics_15d(probes, history, services, exams, as_of, days, date_from, date_to,
                         keep_reception_date=True)
    # read by the upsert's key check, the upsert and the wide rows
    m15 = cut_lineage(m15)
    m15_out = m15 if keep_reception_date else m15.drop("FECHA_RECEPCION")
    if metrics_table is None:
        metrics_out = m15_out
    else:
        metrics_out = M.merge_upsert(metrics_table, m15_out.select(*metrics_table.columns), METRIC_KEYS)
    recent = history.where(B.date_window("FECHA_RECEPCION", date_from, date_to))
    order = ["FECHA_RECEPCION", "LCC_COMCOR", "LCC_COMCOD"]
    older = (wide if wide is not None else recent.limit(0)).select("AFILIADO_RUT", *order)
    older = older.where(B.date_window("FECHA_RECEPCION", None, date_to)) \
                 .join(recent.select("AFILIADO_RUT").distinct(), "AFILIADO_RUT", "left_semi")
    # what a claim gets depends on its keys alone: it is put together for the different keys, without the claims' many
    # columns, which move once, to take it all
    entities = [e for e in (monthly or {}) if e != "AFILIADO_RUT"]
    marks = list(dict.fromkeys(["AFILIADO_RUT", *order, *entities]))
    ranked = J.history_rank(recent.select(*marks).distinct(), older, "AFILIADO_RUT", order)
    if wide is not None:
        ranked = M.anti_join_existing(ranked, wide, WIDE_KEYS, key_source=recent)
    ranked = ranked.join(m15.drop("FECHA_CALCULO", "FECHA_RECEPCION"), METRIC_KEYS, "left")
    if monthly:
        own = {e: m.join(recent.select(e).distinct(), e, "left_semi") for e, m in monthly.items()}
        ranked = J.join_latest_period(ranked, own, as_of, lexicographic=lexicographic_periods)
    ranked = _with_marks(recent, ranked, marks)
    if monthly:
        # ratios read the raw (possibly missing) metrics before defaults are filled
        for name, (num, den) in (ratios or {}).items():
            ranked = ranked.withColumn(name, B.safe_ratio(num, den))
        if monthly_defaults:
            ranked = B.fill_defaults(ranked, monthly_defaults)
    rows = ranked
    rows = B.fill_defaults(rows, {**CM.CLAIM_DEFAULTS, **CM.SERVICE_DEFAULTS, **CM.EXAM_DEFAULTS})
    if {"I_DIASAUTORIZADOS", "DIASSOLICITADO", "RESOLUCION_COMPIN", "CIE_GRUPO"} <= set(rows.columns):
        # the flags replace what the claims may carry under the same names
        flags = [c for c in ("ISAP_RECHAZA", "ISAP_APRUEBA", "ISAP_MODIFICA_PCT", "ISAP_GANA_COMPIN",
                             "IS_PSIQUIATRICA_CURRENT_FLAG", PRIOR_APPROVAL_COL) if c in rows.columns]
        rows = B.outcome_flags(rows.drop(*flags), prior_col=prior_source)
    if mart is not None:
        rows = mart.apply(rows)
    return IncrementResult(new_base, metrics_out, rows, m15_out)


def _with_marks(claims: DataFrame, known: DataFrame, marks: Sequence[str]) -> DataFrame:
    """The claims with what is known of their ``marks``; a claim without an entry there is left out.  NULLs are equal."""
    named = known.select(F.struct(*marks).alias("__marks"), *[c for c in known.columns if c not in marks])
    return claims.withColumn("__marks", F.struct(*marks)).join(named, "__marks").drop("__marks")


# What is known of a decided claim, which audit columns and targets are made from.
_DECISION = ("ESTADO_LM", "I_DIASAUTORIZADOS", "RESOLUCION_COMPIN", "REC_GLS_CAUMOD", "REC_LCC_VISJUS", "PERITAJE_FALLO_1",
             PRIOR_APPROVAL_COL, "FECHA_RESOLUCION_COMPIN", "PERITAJE_LM_PERITADA", "CTD_ENVIA_PERITAJE", "CTD_ENVIA_INFORME_MEDICO")
_TYPES = {"I_DIASAUTORIZADOS": "bigint", PRIOR_APPROVAL_COL: "int", "FECHA_RESOLUCION_COMPIN": "date",
          "PERITAJE_LM_PERITADA": "int", "CTD_ENVIA_PERITAJE": "bigint", "CTD_ENVIA_INFORME_MEDICO": "bigint"}


def build_training_table(wide: DataFrame, as_of, spec: Sequence | None = None,
                         mart: "MS.MartSpec | None" = None) -> DataFrame:
    """Full rebuild of the training table from the wide table.

    Sentinel dates -> NULL, capped day differences, late flag, standardised
    gender, leave-type fallbacks, foreign-doctor flag, month differences,
    episode start/length, the columns of ``mart`` (default:
    ``mart_spec.TRAINING``) with their defaults and new names, audit (leak)
    columns and targets.  Columns the wide table lacks are read as NULL (their
    defaults apply).  ``spec`` names further columns to pass through.
    """
    mart = MS.TRAINING if mart is None else mart
    w = wide.where(F.col("FECHA_EMISION_DT") < F.lit(as_of).cast("date")) \
        if "FECHA_EMISION_DT" in wide.columns else wide
    known = set(w.columns)

    def col(name, typ="string"):
        return F.col(name) if name in known else F.lit(None).cast(typ)

    def dcol(name):
        return col(name, "date")

    def days(a, b):
        return B.clamped_days(a, b, 30)

    own = {
        "AFILIADO_RUT": col("AFILIADO_RUT"), "LCC_COMCOR": col("LCC_COMCOR", "bigint"), "LCC_COMCOD": col("LCC_COMCOD", "bigint"),
        "FECHA_EMP_RECEPCION": B.clean_sentinel_date(dcol("FECHA_EMP_RECEPCION")),
        "FECHA_EMP_ENVIO": B.clean_sentinel_date(dcol("FECHA_EMP_ENVIO")),
        "FECHA_NAC_HIJO": B.clean_sentinel_date(dcol("FECHA_NAC_HIJO")),
        "DIAS_RECEPCION_A_EMPLEADOR": days(B.clean_sentinel_date(dcol("FECHA_EMP_RECEPCION")), dcol("FECHA_RECEPCION")),
        "DIAS_RECEPCION_A_ENVIO": days(B.clean_sentinel_date(dcol("FECHA_EMP_ENVIO")), dcol("FECHA_RECEPCION")),
        "DIAS_INICIO_A_RECEPCION": days(dcol("FECHA_RECEPCION"), col("FECHA_INICIO", "timestamp")),
        "DIAS_INICIO_A_EMISION": days(dcol("FECHA_EMISION_DT"), col("FECHA_INICIO", "timestamp")),
        "DIAS_EMISION_A_RECEPCION": days(dcol("FECHA_RECEPCION"), dcol("FECHA_EMISION_DT")),
        "ENVIO_TARDIO_EMPLEADOR": B.late_flag(dcol("FECHA_EMP_ENVIO"), dcol("FECHA_EMP_RECEPCION"), 3),
        "FECHA_EMISION_DT": dcol("FECHA_EMISION_DT"), "FECHA_RECEPCION": dcol("FECHA_RECEPCION"),
        "FECHA_INICIO": col("FECHA_INICIO", "timestamp"), "FECHA_TERMINO": col("FECHA_TERMINO", "timestamp"),
        "DIASSOLICITADO": col("DIASSOLICITADO", "bigint"), "COT_EDAD": col("COT_EDAD", "bigint"),
        "COT_GENERO": B.standardise_category(col("COT_GENERO"), B.GENDER_SYNONYMS, "null"), "CIE_GRUPO": col("CIE_GRUPO"),
        "TIPO_F_LM": B.code_label_fallback(col("TIPO_F_LM"), col("lic_codigo_tipo_licencia", "bigint")),
        "TIPO_F_LM_COD": B.code_fallback(col("TIPO_F_LM_COD", "bigint"), col("lic_codigo_tipo_licencia", "bigint")),
        "I_TIPOLIC": col("lic_codigo_tipo_licencia", "bigint"), "PRESTADOR_RUT": col("PRESTADOR_RUT"),
        "MEDICO_EXTRANJERO": B.id_range_flag("PRESTADOR_RUT") if "PRESTADOR_RUT" in known else F.lit(0),
        "IS_MEDICO": F.when(F.upper(col("PRESTADOR_TIPO")) == "MEDICO", 1).otherwise(0),
        "MESES_DESDE_CONTRATO": B.month_diff(dcol("FECHA_RECEPCION"), dcol("FECHA_SUSCR_CONTRATO")),
        "MESES_ANTIGUEDAD_PRESTADOR": B.month_diff(dcol("FECHA_RECEPCION"), dcol("FECHA_INGRESO_PREST")),
        "CONTINUA_CALC": col("CONTINUA_CALC"),
        "EPISODIO_FEC_INI": B.episode_start(dcol("EPISODIO_FEC_INI"), col("FECHA_INICIO", "timestamp")),
        "EPISODIO_ACUM_DIAS": B.episode_days(col("CONTINUA_CALC"), dcol("EPISODIO_FEC_INI"), col("FECHA_INICIO", "timestamp"),
                                             col("FECHA_TERMINO", "timestamp")),
    }
    # what targets and audit columns read goes along under names of its own, and leaves again
    passed = [c for c in (spec or []) if c in known and c not in own and c not in mart.columns()]
    decision = [c for c in _DECISION if c not in own and c not in passed and c not in mart.columns()]
    ruled = w.withColumns({f"__{n}": c for n, c in own.items()})
    out = mart.apply(ruled.withColumns({c: F.lit(None).cast(_TYPES.get(c, "string")) for c in decision if c not in known}),
                     keep=[*[f"__{n}" for n in own], *passed, *decision])
    out = out.withColumnsRenamed({f"__{n}": n for n in own})
    return B.derive_targets(B.derive_audit_columns(out)).drop(*decision)
