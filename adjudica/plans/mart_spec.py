"""The mart's columns as a typed specification, compiled into a few projections (survey N1, N2, B9, B10, B14).

A ``Family`` is one measure over several windows: its name pattern, the windows, its type, what stands for a missing
value, and either a source of the same name or a ratio of other measures of the same window.  A ``MartSpec`` is an ordered
list of families.  ``apply`` is three projections that Catalyst merges into one: ratios from the raw columns (an entity
without metrics has none, so its ratios stay NULL), defaults, then names, types and order.

Two specifications are given: ``WIDE`` (what the daily increment appends) and ``TRAINING`` (what the training table takes
from it, beside the columns that rules derive).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expr as B
from ..roles import PRIOR_APPROVAL_COL

# Parts of a name that tell a measured column's type; any other measure is a count.
_FRACTIONAL = ("PROMEDIO", "PORCENTAJE", "TASA", "PCT", "RATIO", "VELOCIDAD", "BONIFICADO", "SUM_CANTIDAD")


@dataclass(frozen=True)
class Family:
    """Columns ``pattern`` with ``{}`` replaced by each window; ``num``/``den`` patterns make them ratios.

    ``den`` may name several measures, which are added up.  ``target`` renames the columns.
    """
    pattern: str
    windows: tuple[str, ...] = ("",)
    type: str = "bigint"
    default: object = None
    num: str | None = None
    den: tuple[str, ...] = ()
    target: str | None = None

    def names(self) -> list[str]:
        return [self.pattern.format(w) for w in self.windows]

    def targets(self) -> list[str]:
        return [(self.target or self.pattern).format(w) for w in self.windows]

    def sources(self) -> list[str]:
        """What the family reads."""
        if self.num is None:
            return self.names()
        return [p.format(w) for w in self.windows for p in (self.num, *self.den)]


def measured(pattern: str, windows: str = "", default: object = 0, **more) -> Family:
    """A family whose type follows from its name."""
    typ = "double" if any(p in pattern for p in _FRACTIONAL) else "bigint"
    return Family(pattern, tuple(windows.split()) or ("",), typ, default, **more)


def ratio(pattern: str, windows: str, num: str, *den: str) -> Family:
    return Family(pattern, tuple(windows.split()), "double", None, num, den)


def plain(text: str, default: object = None) -> list[Family]:
    """Single columns, given as ``name`` (text) or ``name:type``."""
    out = []
    for item in text.split():
        name, _, typ = item.partition(":")
        out.append(Family(name, type=typ or "string", default=default))
    return out


@dataclass(frozen=True)
class MartSpec:
    families: tuple[Family, ...]

    def columns(self) -> list[str]:
        return [t for f in self.families for t in f.targets()]

    def sources(self) -> dict[str, str]:
        """Every column that is read, with its type."""
        return {s: f.type for f in self.families for s in f.sources()}

    def defaults(self) -> dict[str, object]:
        return {n: f.default for f in self.families if f.default is not None for n in f.names()}

    def renames(self) -> list[tuple[str, str, str]]:
        """(source, target, type) in order, as ``project_rename`` takes them."""
        return [(n, t, f.type) for f in self.families for n, t in zip(f.names(), f.targets())]

    def ratios(self) -> dict[str, tuple[str, tuple[str, ...]]]:
        return {n: (f.num.format(w), tuple(d.format(w) for d in f.den))
                for f in self.families if f.num is not None for n, w in zip(f.names(), f.windows)}

    def apply(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """The specified columns of ``df`` (and those of ``keep``, first); a column that ``df`` lacks is NULL or its default."""
        have = set(df.columns)
        typed = self.sources()

        def col(name: str) -> Column:
            return F.col(name) if name in have else F.lit(None).cast(typed.get(name, "bigint"))

        made = {n: B.safe_ratio(col(num), _sum([col(d) for d in den])) for n, (num, den) in self.ratios().items()}
        missing = {n: F.lit(None).cast(t) for n, _, t in self.renames() if n not in have and n not in made}
        full = df.withColumns({**made, **missing})
        return B.project_rename(B.fill_defaults(full, self.defaults()), [*[(k, k) for k in keep], *self.renames()])


def _sum(columns: Iterable[Column]) -> Column:
    total = None
    for c in columns:
        total = c if total is None else total + c
    return total


ALL = "1M 6M 12M 24M 36M"

# The columns of a claim in the wide table, in its order; text unless a type follows the name.
CLAIM = """
AFILIADO_RUT LCC_COMCOD:bigint LCC_COMCOR:bigint LCC_OPERADOR PRESTADOR_RUT EMPLEADOR_RUT lic_id_licencia
EPISODIO_ACUM_DIAS:bigint EPISODIO_FEC_INI:date CONTINUA_CALC TIPO_F_LM_COD:bigint TIPO_F_LM FECHA_RECEPCION:date
FECHA_INICIO:timestamp FECHA_TERMINO:timestamp DIASSOLICITADO:bigint CIE_F CIE_F_COD CIE_GRUPO LM_DIAGNOSTICO
LM_ANTECEDENTES_CLINICOS MED_CLASIFICACION MED_ESPECIALIDAD_LME EMPLEADOR_MULTIEMPLEADO COMUNA_REPOSO COMUNA_EMISION
CALIDAD_TRABAJADOR LM_FORMATO LM_REPOSO_TIPO N_LICENCIA lic_rut_trabajador lic_dv_trabajador FECHA_EMISION_DT:date
lic_fecha_inicio_reposo:date lic_fecha_recep_isapre:date lic_dias_licencia:bigint lic_codigo_tipo_licencia:bigint
FECHA_EMP_RECEPCION:date FECHA_EMP_ENVIO:date lic_rut_profesional lic_pro_especialidad lic_pro_tipo lic_pro_dir_comuna
lic_diag_principal lic_cie10_principal lic_antecedentes_clinicos lic_rut_empleador lic_codigo_calidad_trab
lic_codigo_tipo_reposo COT_GENERO COT_EDAD:bigint lic_reposo_dir_comuna1 PRESTADOR_LOCAL_RUT PRESTADOR_LOCAL_TIPO_COD
PRESTADOR_LOCAL_TIPO COMPIN_CNT FECHA_INICIO_BENEFICIOS:date FECHA_SUSCR_CONTRATO:date DEUDA_SIN_I:double
DEUDA_SIN_I_ULT12M:double RENTA_ESTIMADA:double CTD_ENVIA_PERITAJE:bigint PERITAJE_LM_PERITADA:int PERITAJE_FALLO_1
CTD_ENVIA_INFORME_MEDICO:bigint"""
# What becomes known of a claim later, in the wide table's order.
CLAIM_OUTCOME = """
REC_LCC_VISJUS REC_GLS_CAUMOD IS_REPOSO_INJUSTIFICADO_ISAPRE_FLAG:int RESOLUCION_COMPIN FECHA_ENVIO_A_COMPIN:date
FECHA_RESOLUCION_COMPIN:date EXISTE_RESOL_COMPIN:int TIEMPO_RESOLUCION_COMPIN_CURRENT:bigint PRESTADOR_ESPECIALIDAD_PSC
PREST_TOP_CIE_F PREST_TOP_GRUPOCIE PRESTADOR_TIPO FECHA_INGRESO_PREST:date FECHA_VISACION:date I_DIASAUTORIZADOS:bigint
FECHA_RECONSIDERACION:date M_DIASAUTORIZADOS:bigint F_DIASAUTORIZADOS:bigint I_RESOLUCION:bigint LCC_PAGDIA:bigint ESTADO_LM
IS_SIN_SUBSIDIO_FLAG:int IS_RECHAZADA_ISAPRE_CURRENT_FLAG:int IS_MODIFICADA_REAL_ISAPRE_FLAG:int
DIAS_REDUCIDOS_ISAPRE_CURRENT:bigint IS_MODIFICADA_ISAPRE_FLAG:int IS_PSIQUIATRICA_CURRENT_FLAG:int
DIFF_DIAS_PERDIDOS_RESOL_CURRENT:bigint"""

# Measures of the insured person's monthly table.
PERSON_MEASURES = (
    measured("COMPIN_RATIFICA_{}", "01 06 12 24"),
    measured("F_DIAS_PROMEDIO_U{}", "1M 6M 12M 24M 36M"),
    measured("F_DIAS_MINIMO_U{}", "6M 12M 24M"),
    measured("F_DIAS_MAXIMO_U{}", "6M"),
    measured("DIFF_DIAS_PERDIDOS_RESOL_MINIMO_U{}", "6M"),
    measured("DIFF_DIAS_PERDIDOS_RESOL_PROMEDIO_U{}", "6M 12M 24M 36M"),
    measured("DIFF_DIAS_PERDIDOS_RESOL_MAXIMO_U{}", "6M"),
    measured("TIEMPO_PROMEDIO_RESOLUCION_COMPIN_{}", "01 06 12 24 36"),
    measured("LM_DENEGADAS_COMPIN_{}", "01 06 12 36"),
    measured("SIN_SUBSIDIO_{}", "01 12 24 36"),
    measured("CAUSA_RECHAZO_ISAPRE_REPOSO_INJ_{}", "06 12"),
    measured("CANT_LIC_U{}_CALC", ALL),
    measured("DIASSOLICITADO_TOTAL_U{}", ALL),
    measured("DIASSOLICITADO_PROMEDIO_U{}", "1M 6M 12M 24M"),
    measured("DIASSOLICITADO_MAXIMO_U{}", "1M 6M 12M"),
    measured("M_DIASAUTORIZADOS_PROMEDIO_U{}", ALL),
    measured("M_DIASAUTORIZADOS_MINIMO_U{}", "1M 6M"),
    measured("M_DIASAUTORIZADOS_MAXIMO_U{}", "1M 6M 12M 24M"),
    measured("M_DIASAUTORIZADOS_TOTAL_U{}", "1M 6M 12M"),
    measured("I_DIASAUTORIZADOS_PROMEDIO_U{}", ALL),
    measured("I_DIASAUTORIZADOS_MINIMO_U{}", "1M 6M"),
    measured("I_DIASAUTORIZADOS_MAXIMO_U{}", "1M 6M 12M 24M"),
    measured("I_DIASAUTORIZADOS_TOTAL_U{}", "1M 6M 12M"),
    measured("CIE_GRUPO_PSIQUIATRICAS_{}", "01 06 12 24 36"),
    measured("PORCENTAJE_LM_MODIFICADA_{}", "01 06 12 24 36"),
    measured("LM_MODIFICADA_{}", "01 06 12 24 36"),
    measured("LM_TIPO_ENF_COMUN_{}", "12 24 36"),
    measured("LM_CON_PERITAJE_{}", "12"),
    measured("CTD_ENVIA_PERITAJE_PROMEDIO_U{}", "12M"),
    measured("CTD_ENVIA_INFORME_MEDICO_PROMEDIO_U{}", "12M"),
    measured("CTD_ENVIA_PERITAJE_U{}", "12M"),
    measured("HIST_HV_N_PRESTACIONES_U{}", "6M 12M"),
    measured("HIST_HV_N_MEDICOS_U{}", "6M"),
    measured("HIST_HV_SUM_CANTIDAD_PREST_U{}", "6M"),
    measured("HIST_HV_N_HOSP_U{}", "6M"),
    measured("HIST_HV_N_CONSULTAS_AMB_U{}", "6M"),
    measured("HIST_HV_DIAS_CAMA_U{}", "6M 12M"),
    measured("HIST_HV_FLAG_GES_U{}", "6M 12M"),
    measured("HIST_HV_FLAG_CAEC_U{}", "6M"),
    measured("HIST_HV_BONIFICADO_U{}", "6M"),
    measured("HIST_PERITAJES_NO_ASISTE_U{}", "3M 6M"),
    measured("HIST_PERITAJES_DESACUERDO_ISAPRE_U{}", "12M"),
    measured("HIST_TOTAL_PERITAJES_U{}", "12M"),
    measured("HIST_PERITAJES_ISAPRE_GANO_U{}", "6M"),
    measured("HIST_DIAS_DESDE_ULTIMO_PERITAJE", default=9999),
)
# Measures of the doctor's monthly table.
DOCTOR_MEASURES = (
    measured("MEDICO_LM_RECHAZADAS_ISAPRE_U{}", ALL),
    measured("MEDICO_LM_RECIBIDAS_TOTAL_U{}", ALL),
    measured("MEDICO_DIAS_MODIFICADOS_SUM_ISAPRE_U{}", ALL),
    ratio("MEDICO_DIAS_MODIFICADOS_PCT_ISAPRE_U{}", ALL, "MEDICO_DIAS_MODIFICADOS_SUM_ISAPRE_U{}", "MEDICO_DIAS_SOLICITADOS_U{}"),
    ratio("MEDICO_TASA_RATIFICACION_COMPIN_U{}", "6M 12M 24M 36M", "MEDICO_LM_RATIFICADAS_COMPIN_U{}",
          "MEDICO_LM_RATIFICADAS_COMPIN_U{}", "MEDICO_LM_DENEGADAS_COMPIN_U{}"),
    measured("HIST_PERITAJES_DESACUERDO_ISAPRE_MEDICO_U{}", "12M"),
    measured("HIST_PERITAJE_FAVORABLE_ISAPRE_MISMO_CIE_U{}", "3M"),
    measured("HIST_HV_CONSULTAS_MISMO_MEDICO_U{}", "1M 3M 6M"),
    measured("HIST_HV_TUVO_CONSULTA_MISMO_MEDICO_U{}", "12M"),
    measured("HIST_HV_EXAMENES_LAB_MISMO_MEDICO_U{}", "7D 14D 30D"),
    measured("HIST_HV_TUVO_EXAMENES_LAB_MISMO_MEDICO"),
)
# Measures of the local provider's monthly table.
LOCAL_MEASURES = (
    measured("PRESTADOR_LOCAL_LM_RECHAZADAS_ISAPRE_U{}", ALL),
    measured("PRESTADOR_LOCAL_LM_RECIBIDAS_TOTAL_U{}", ALL),
    measured("PRESTADOR_LOCAL_DIAS_SOLICITADOS_U{}", ALL),
)
# Measures of the employer's monthly table.
EMPLOYER_MEASURES = (
    ratio("EMPLEADOR_TASA_RECHAZO_ISAPRE_U{}", "1M 6M 12M 36M", "EMPLEADOR_LM_RECHAZADAS_U{}", "EMPLEADOR_LM_TOTAL_U{}"),
    measured("EMPLEADOR_DIAS_SOLICITADOS_LM_U{}", "1M 6M 12M 36M"),
    measured("EMPLEADOR_RUT_DISTINTOS_LM_U{}", "36M"),
    ratio("EMPLEADOR_TASA_MODIFICACION_DIAS_ISAPRE_U{}", "1M 6M 12M 36M", "EMPLEADOR_DIAS_REDUCIDOS_U{}", "EMPLEADOR_DIAS_SOLICITADOS_LM_U{}"),
)
# Which claim column each monthly table is joined by.
ENTITY_MEASURES = {"AFILIADO_RUT": PERSON_MEASURES, "PRESTADOR_RUT": DOCTOR_MEASURES, "PRESTADOR_LOCAL_RUT": LOCAL_MEASURES,
                   "EMPLEADOR_RUT": EMPLOYER_MEASURES}
# The flags that rules derive from a decided claim.
OUTCOME_FLAGS = "ISAP_RECHAZA:int ISAP_APRUEBA:int ISAP_MODIFICA_PCT:float ISAP_PIDE_PE:int ISAP_GANA_COMPIN:int"
# Measures of the fifteen days before a claim.
FIFTEEN_DAYS = (
    *[measured(f"{n}_U15D") for n in ("CANT_LIC", "CANT_LIC_CON_RESOLUCION", "COMPIN_RATIFICA", "COMPIN_DENIEGA", "F_DIAS_PROMEDIO",
                                      "TOTAL_DIAS_SOLICITADOS", "MAX_DIAS_SOLICITADOS", "FLAG_MULTIPLES_LIC")],
    measured("RATIO_APROBACION_U15D", default=None),
    *[measured(f"HV_{n}_U15D") for n in ("N_PRESTACIONES", "SUM_CANTIDAD_PREST", "N_MEDICOS", "FLAG_HOSPITALARIO", "FLAG_BONO",
                                         "FLAG_REEMBOLSO", "FLAG_GES", "FLAG_CAEC")],
    *[measured(f"PERITAJES_{n}_U15D") for n in ("TOTAL", "NO_ASISTE", "DESACUERDO", "ACUERDO")],
    measured("DIAS_DESDE_ULTIMO_PERITAJE_U15D", default=9999),
    measured("FLAG_PERITAJE_RECIENTE_U15D"),
)


def wide_spec(prior_source: str | None = None) -> MartSpec:
    """Columns of the wide table; ``prior_source`` names the claim column from which the prior approval is known."""
    return MartSpec((
        *plain(CLAIM), *plain(prior_source or ""), *plain(CLAIM_OUTCOME), Family("RN_AFILIADO_HIST"),
        *[f for families in ENTITY_MEASURES.values() for f in families],
        *plain(OUTCOME_FLAGS), *FIFTEEN_DAYS, Family(PRIOR_APPROVAL_COL, type="int"),
    ))


def _as_is(families: Iterable[Family], **windows: str | None) -> list[Family]:
    """Families as they stand in the wide table (no default, no ratio any more); ``windows`` narrows some, None leaves them out."""
    out = []
    for f in families:
        key = f.pattern.replace("{}", "").rstrip("_")
        key = key[:-2] if key.endswith("_U") else key
        if key in windows and windows[key] is None:
            continue
        out.append(Family(f.pattern, tuple(windows[key].split()) if key in windows else f.windows, f.type))
    return out


# Columns that the training table takes over from the wide table without a change.
TRAINING_CLAIM = """
DEUDA_SIN_I:double DEUDA_SIN_I_ULT12M:double CIE_F CIE_F_COD LM_DIAGNOSTICO LM_ANTECEDENTES_CLINICOS LM_FORMATO
LM_REPOSO_TIPO N_LICENCIA PRESTADOR_LOCAL_RUT PRESTADOR_ESPECIALIDAD_PSC PRESTADOR_TIPO MED_ESPECIALIDAD_LME MED_CLASIFICACION
PREST_TOP_CIE_F PREST_TOP_GRUPOCIE COMUNA_REPOSO COMUNA_EMISION EMPLEADOR_RUT EMPLEADOR_MULTIEMPLEADO"""
# Counts of warnings and of actions on a claim, which the training table reads with a default of 0.
TRAINING_COUNTS = (
    measured("FADE_AFILIADO_{}", "90D 365D"), measured("FADE_EMPRESA_{}", "90D 365D"), measured("FADE_PRESTADOR_{}", "90D 365D"),
    measured("FADE_LICENCIA_{}", "7D"), measured("ALERTA_AMARILLA_{}", "90D 365D"), measured("ALERTA_ROJA_{}", "90D 365D"),
    measured("CTD_SOLICITUDES_INFO_U{}", "30D 90D 365D"), measured("CTD_SOLICITUDES_INFO_MEDICA_U{}", "30D"),
    measured("CTD_PERITAJES_TOTAL_U{}", "30D 90D"), measured("CTD_PERITAJES_PSIQ_U{}", "30D"),
    measured("FLAG_PERITAJE_PSIQ_U{}", "30D"), measured("DIAS_DESDE_ULTIMO_PERITAJE", default=None),
    measured("CTD_RECURSOS_TOTAL_U{}", "90D"), measured("TASA_EXITO_RECURSOS_U{}", "90D", default=None),
    measured("CTD_FADE_TOTAL_U{}", "30D"), measured("FLAG_TIENE_FADE_U{}", "30D"), measured("FLAG_SOSPECHA_FRAUDE_U{}", "90D"),
    measured("FLAG_INFORME_MEDICO_RECEP_U{}", "30D"), measured("CTD_ACCIONES_TOTAL_U{}", "30D 90D 365D"),
    measured("VELOCIDAD_ACCIONES_U{}", "30D"),
)

TRAINING = MartSpec((
    *plain(TRAINING_CLAIM),
    Family("EMPLEADOR_RUT_DISTINTOS_LM_U36M", target="EMPLEADOS_CON_LM"), *plain("RENTA_ESTIMADA:double CALIDAD_TRABAJADOR COMPIN_CNT"),
    Family("RN_AFILIADO_HIST", target="RN"), *TRAINING_COUNTS,
    # Windows of the person's measures that the training table leaves out.
    *_as_is([f for f in PERSON_MEASURES if not f.pattern.startswith("I_DIASAUTORIZADOS")], M_DIASAUTORIZADOS_PROMEDIO="1M 12M 24M",
            M_DIASAUTORIZADOS_MINIMO=None, M_DIASAUTORIZADOS_MAXIMO="1M 12M 24M", M_DIASAUTORIZADOS_TOTAL="1M 6M 12M",
            SIN_SUBSIDIO="01 12 24", CAUSA_RECHAZO_ISAPRE_REPOSO_INJ=None, HIST_PERITAJES_NO_ASISTE="6M"),
    *_as_is(DOCTOR_MEASURES),
    Family("PRESTADOR_LOCAL_LM_RECHAZADAS_ISAPRE_U{}", tuple(ALL.split()), target="PL_LM_RECHAZADAS_ISAPRE_U{}"),
    Family("PRESTADOR_LOCAL_LM_RECIBIDAS_TOTAL_U{}", tuple(ALL.split()), target="PL_LM_RECIBIDAS_TOTAL_U{}"),
    *_as_is(EMPLOYER_MEASURES, EMPLEADOR_RUT_DISTINTOS_LM=None),
    *FIFTEEN_DAYS,
))
