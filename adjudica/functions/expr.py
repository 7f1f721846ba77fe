"""Column-level rules of the claim mart and training table (survey B1-B19, H).

Every function returns a ``Column`` (or a DataFrame for the frame-level
rules) built from ``pyspark.sql.functions`` only, so the rules stay inside
whole-stage codegen and are pushed/pruned by Catalyst like any expression.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..roles import PRIOR_APPROVAL_COL, PRIOR_SOURCE_VALUE

SENTINEL_DATE = "1900-01-01"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean_sentinel_date(col, sentinel: str = SENTINEL_DATE) -> Column:
    """B1: the placeholder date becomes NULL."""
    c = _c(col)
    return F.when(c.isNull() | (F.to_date(c) == F.lit(sentinel).cast("date")), None).otherwise(c)


def clamped_days(a, b, limit: int = 30, sentinel: str | None = None) -> Column:
    """B2: ``datediff(a, b)`` capped to ``[-limit, limit]``; NULL stays NULL.

    With ``sentinel`` the placeholder date on ``a`` gives NULL too.
    """
    a_ = clean_sentinel_date(a, sentinel) if sentinel else _c(a)
    d = F.datediff(F.to_date(a_), F.to_date(_c(b)))
    return F.when(d > limit, limit).when(d < -limit, -limit).otherwise(d)


def late_flag(sent, received, max_days: int = 3, sentinel: str = SENTINEL_DATE) -> Column:
    """1 if sent more than ``max_days`` after received; NULL if either is missing."""
    s, r = clean_sentinel_date(sent, sentinel), clean_sentinel_date(received, sentinel)
    return (F.when(s.isNull() | r.isNull(), None)
             .when(F.datediff(F.to_date(s), F.to_date(r)) > max_days, 1).otherwise(0))


def standardise_category(col, synonyms: Mapping[str, Iterable[str]], on_unknown: str = "null") -> Column:
    """upper/trimmed synonyms map to a canonical label.

    Values already equal to a canonical label are kept; anything else becomes
    NULL (``on_unknown="null"``) or is kept as is (``"keep"``).
    """
    c = _c(col)
    key = F.upper(F.trim(c))
    out = None
    for label, words in synonyms.items():
        cond = key.isin(*[w.upper() for w in words])
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    out = out.when(c.isin(*synonyms.keys()), c)
    return out.otherwise(c if on_unknown == "keep" else F.lit(None).cast("string"))


# Gender synonyms of the training table.
GENDER_SYNONYMS = {"Fem": ["FEM", "F", "FEMENINO"], "Masc": ["MASC", "M", "MASCULINO"]}

# Leave-type code -> label, default 'OTRO'.
LEAVE_TYPE_LABELS = {
    1: "ENFERMEDAD COMUN",
    2: "PRORROGA MEDICINA PREVENTIVA",
    3: "MATERNAL",
    4: "ENFERM. HIJO < 1 AÑO",
    5: "ACCIDENTE DEL TRABAJO",
    6: "ENFERMEDAD PROFESIONAL",
    7: "PATOLOGIA DEL EMBARAZO",
}


def code_label_fallback(label, code, labels: Mapping[int, str] = LEAVE_TYPE_LABELS,
                        default: str = "OTRO") -> Column:
    """B5 (label): blank label -> label of the code, else ``default``."""
    c = _c(code)
    mapped = None
    for k, v in labels.items():
        mapped = F.when(c == k, v) if mapped is None else mapped.when(c == k, v)
    return F.coalesce(F.nullif(_c(label), F.lit("")), mapped.otherwise(default))


def code_fallback(code, fallback_code) -> Column:
    """B5 (code): code 0 -> fallback code -> 0."""
    return F.coalesce(F.nullif(_c(code), F.lit(0)), _c(fallback_code), F.lit(0))


def id_range_flag(id_col, low: int = 48_000_000, high: int = 49_999_999) -> Column:
    """Number before '-' in ``[low, high]``; malformed or NULL ids give 0."""
    n = F.expr("try_cast(split_part({}, '-', 1) AS INT)".format(_sql_name(id_col)))
    return F.when(n.between(low, high), 1).otherwise(0)


def _sql_name(col) -> str:
    if isinstance(col, str):
        return f"`{col}`"
    raise TypeError("id_range_flag takes a column name")


def month_diff(a, b) -> Column:
    """Calendar months a - b (year*12 + month), not months_between."""
    a_, b_ = _c(a), _c(b)
    return (F.year(a_) - F.year(b_)) * 12 + (F.month(a_) - F.month(b_))


def episode_start(episode_start_col, claim_start) -> Column:
    """Episode start falls back to the claim start date."""
    return F.coalesce(F.to_date(_c(episode_start_col)), F.to_date(_c(claim_start)))


def episode_days(continues, episode_start_col, claim_start, claim_end) -> Column:
    """Length in days of the episode (continued) or of the claim, inclusive."""
    start = F.when(_c(continues) == "S", episode_start(episode_start_col, claim_start)) \
             .otherwise(F.to_date(_c(claim_start)))
    return F.datediff(F.to_date(_c(claim_end)), start) + 1


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Typed NULL replacement for the listed columns that exist."""
    present = {k: v for k, v in defaults.items() if k in df.columns}
    if not present:
        return df
    return df.select(*[F.coalesce(F.col(c), F.lit(present[c]).cast(t)).alias(c) if c in present
                       else F.col(c) for c, t in df.dtypes])


def project_rename(df: DataFrame, spec: Iterable, missing: str = "null") -> DataFrame:
    """Wide pass-through in spec order.

    ``spec`` items are a column name or ``(source, target)``; missing sources
    become typed NULL (``missing="null"``, type taken from the tuple's third
    element or string) or raise (``"error"``).
    """
    cols = []
    have = set(df.columns)
    for item in spec:
        if isinstance(item, str):
            src, dst, typ = item, item, "string"
        else:
            src, dst = item[0], item[1]
            typ = item[2] if len(item) > 2 else "string"
        if src in have:
            cols.append(F.col(src).alias(dst))
        elif missing == "null":
            cols.append(F.lit(None).cast(typ).alias(dst))
        else:
            raise KeyError(src)
    return df.select(*cols)


def _undecided(status="ESTADO_LM", upper: bool = True) -> Column:
    s = _c(status)
    return (F.upper(s) if upper else s) == "EN VISACION"


def derive_targets(df: DataFrame) -> DataFrame:
    """Training labels.  Undecided claims get NULL; rule order matters."""
    und_u = _undecided(upper=True)
    und = _undecided(upper=False)
    i_days, req = F.col("I_DIASAUTORIZADOS"), F.col("DIASSOLICITADO")
    group = F.col("CIE_GRUPO")
    verdict = F.upper(F.col("RESOLUCION_COMPIN"))
    cause_ok = F.col("REC_GLS_CAUMOD") == "SIN OBSERVACIONES"
    full = (i_days == req) & (i_days > 0)
    birth = group.isin("PARTO", "PUERPERIO")
    return df.select(
        "*",
        F.when(und_u, None).when(F.col("PERITAJE_LM_PERITADA") == 1, 1).otherwise(0).alias("TARGET_PERITAJE"),
        F.when(und_u, None).when(F.col("CTD_ENVIA_PERITAJE") > 0, 1)
         .when(F.col("CTD_ENVIA_INFORME_MEDICO") > 0, 1).otherwise(0).alias("TARGET_PERITAJE2"),
        F.when(und, None).when(i_days == 0, 1).otherwise(0).alias("TARGET_RECHAZA"),
        F.when(und, None).when((i_days < req) & (req > 0), 1).otherwise(0).alias("TARGET_MODIFICA"),
        F.when(und, None).when(full, 1).when(i_days < req, 0).alias("TARGET_APRUEBA"),
        F.when(verdict == "RATIFICA", 1).when(verdict == "DENIEGA", 0).alias("TARGET_RATIFICA"),
        F.when(F.col("FECHA_EMISION_DT").isNotNull(), 1).otherwise(0).alias("TARGET_REQUIERE_REVISION"),
        F.when(und_u, None).when(i_days.isNull(), None).when(birth, None)
         .when(cause_ok & F.col("PERITAJE_FALLO_1").isNull(), 1).when(full, 1).otherwise(0)
         .alias("TARGET_FT2"),
        F.when(und_u, None).when(F.col(PRIOR_APPROVAL_COL) == 1, None).when(birth, None)
         .when(cause_ok, 1).when(full, 1).otherwise(0).alias("TARGET_FT3"),
    )


def derive_audit_columns(df: DataFrame) -> DataFrame:
    """Leak columns for audit; authorised days hidden while undecided."""
    return df.select(
        "*",
        F.col("REC_GLS_CAUMOD").alias("LEAK_CAUSALES"),
        F.col("REC_LCC_VISJUS").alias("LEAK_GLOSAS"),
        F.when(_undecided(), None).otherwise(F.col("I_DIASAUTORIZADOS")).alias("LEAK_DIASAUTORIZADOS"),
        F.col("ESTADO_LM").alias("LEAK_ESTADOLM"),
        F.col("PERITAJE_FALLO_1").alias("LEAK_FALLO_PE"),
        F.col(PRIOR_APPROVAL_COL).alias("LEAK_FT"),
        F.col("FECHA_RESOLUCION_COMPIN").alias("LEAK_FECHA_COMPIN"),
        F.col("RESOLUCION_COMPIN").alias("LEAK_RESOLUCION_COMPIN"),
    )


def outcome_flags(df: DataFrame, prior_col: str | None, prior_value: str = PRIOR_SOURCE_VALUE) -> DataFrame:
    """Insurer outcome flags, verdict flag, psychiatric and prior-approval flags.

    ``prior_col`` names the column whose ``prior_value`` tells a prior approval; None: no claim has one.
    """
    i_days, req = F.col("I_DIASAUTORIZADOS"), F.col("DIASSOLICITADO")
    verdict = F.upper(F.col("RESOLUCION_COMPIN"))
    partial = (req > i_days) & (i_days > 0)
    return df.select(
        "*",
        F.when(i_days == 0, 1).when(partial, 0).alias("ISAP_RECHAZA"),
        F.when(i_days == req, 1).otherwise(0).cast("int").alias("ISAP_APRUEBA"),
        F.when(partial, (req - i_days) / F.nullif(req, F.lit(0))).cast("float").alias("ISAP_MODIFICA_PCT"),
        F.when(verdict == "RATIFICA", 1).when(verdict == "DENIEGA", 0).alias("ISAP_GANA_COMPIN"),
        F.when(F.upper(F.col("CIE_GRUPO")) == "PSIQUIATRICAS", 1).otherwise(0).alias("IS_PSIQUIATRICA_CURRENT_FLAG"),
        (F.when(F.col(prior_col) == prior_value, 1).otherwise(0) if prior_col else F.lit(0)).cast("int")
         .alias(PRIOR_APPROVAL_COL),
    )


def safe_ratio(num, den) -> Column:
    """Denominator 0 -> 0; NULL denominator (missing entity) -> NULL."""
    n, d = _c(num), _c(den)
    return F.when(d == 0, F.lit(0.0)).otherwise(n.cast("double") / d)


# Diagnosis groups excluded from training/scoring.
EXCLUDED_GROUPS = ("PARTO", "PUERPERIO")


def group_filter(col: str = "CIE_GRUPO", mode: str = "strict", excluded=EXCLUDED_GROUPS) -> Column:
    """strict = NOT IN excluded AND not null AND trimmed non-empty;
    relaxed = NOT IN excluded OR null OR blank (only the excluded groups go).

    NOT IN on a NULL value is unknown (row dropped), as in SQL.
    """
    c = F.col(col)
    if mode == "relaxed":
        return (~c.isin(*excluded)) | c.isNull() | (F.trim(c) == "")
    if mode != "strict":
        raise ValueError(mode)
    return (~c.isin(*excluded)) & c.isNotNull() & (F.trim(c) != "")


def date_window(col, date_from=None, date_to=None) -> Column:
    """Inclusive day range as a half-open range on the raw column."""
    from .dates import date_window as _dw
    return _dw(_c(col), date_from, date_to)


def drop_by_role(df: DataFrame, roles=None, drop_keys: bool = True, keep_target: str | None = None) -> DataFrame:
    """Remove leak columns, keys, the targets other than ``keep_target`` and
    columns known only after the decision."""
    from ..roles import DEFAULT_ROLES, reveals_label
    r = roles or DEFAULT_ROLES
    drop = [c for c in df.columns if reveals_label(c) and c != keep_target]
    if drop_keys:
        drop += [c for c in r.keys if c in df.columns]
    drop += [c for c in r.targets if c in df.columns and c != keep_target]
    return df.drop(*sorted(set(drop)))


def split_decided_pending(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a label vs rows still waiting for one."""
    return df.where(F.col(target).isNotNull()), df.where(F.col(target).isNull())


def neutralise_all_null_dates(pending: DataFrame, decided: DataFrame, date_cols: Iterable[str]) -> DataFrame:
    """A date column wholly NULL among decided rows is set NULL in pending rows.

    One global aggregate (one value per column) enters the plan as a scalar
    subquery, so no join is needed.
    """
    cols = [c for c in date_cols if c in decided.columns and c in pending.columns]
    if not cols:
        return pending
    seen = decided.agg(F.struct(*[F.max(F.col(c).isNotNull().cast("int")).alias(c) for c in cols])).scalar()
    return pending.select(*[F.when(F.coalesce(seen.getField(c), F.lit(0)) == 1, F.col(c))
                            .otherwise(F.lit(None).cast(t)).alias(c) if c in cols else F.col(c)
                            for c, t in pending.dtypes])
