"""Column roles of the claim tables (survey 1.3).

Small role lists are fixed values; the numeric role (about two hundred
columns in the claims mart) is derived by rule from the schema: every
numeric column that has no other role and is not a leak column.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.types import NumericType

# Role lists of the claims mart.
KEYS = ["AFILIADO_RUT", "LCC_COMCOR", "LCC_COMCOD", "N_LICENCIA", "PRESTADOR_RUT",
        "PRESTADOR_LOCAL_RUT", "EMPLEADOR_RUT"]
DATES = ["FECHA_EMP_RECEPCION", "FECHA_EMP_ENVIO", "FECHA_NAC_HIJO", "FECHA_EMISION_DT",
         "FECHA_RECEPCION", "FECHA_INICIO", "FECHA_TERMINO", "EPISODIO_FEC_INI"]
CATEGORICAL = ["COT_GENERO", "CIE_F", "CIE_F_COD", "CIE_GRUPO", "LM_FORMATO", "LM_REPOSO_TIPO",
               "TIPO_F_LM", "TIPO_F_LM_COD", "I_TIPOLIC", "PRESTADOR_ESPECIALIDAD_PSC",
               "PRESTADOR_TIPO", "MED_ESPECIALIDAD_LME", "MED_CLASIFICACION", "PREST_TOP_CIE_F",
               "PREST_TOP_GRUPOCIE", "COMUNA_REPOSO", "COMUNA_EMISION", "EMPLEADOR_MULTIEMPLEADO",
               "CALIDAD_TRABAJADOR", "CONTINUA_CALC", "COMPIN_CNT"]
BINARY = ["MEDICO_EXTRANJERO", "IS_MEDICO", "FADE_AFILIADO_90D", "FADE_AFILIADO_365D",
          "FADE_EMPRESA_90D", "FADE_EMPRESA_365D", "FADE_PRESTADOR_90D", "FADE_PRESTADOR_365D",
          "FADE_LICENCIA_7D", "ALERTA_AMARILLA_90D", "ALERTA_AMARILLA_365D", "ALERTA_ROJA_90D",
          "ALERTA_ROJA_365D", "CIE_GRUPO_PSIQUIATRICAS_01", "CIE_GRUPO_PSIQUIATRICAS_06",
          "CIE_GRUPO_PSIQUIATRICAS_12", "CIE_GRUPO_PSIQUIATRICAS_24", "CIE_GRUPO_PSIQUIATRICAS_36",
          "FLAG_PERITAJE_PSIQ_U30D", "FLAG_TIENE_FADE_U30D", "FLAG_SOSPECHA_FRAUDE_U90D",
          "FLAG_INFORME_MEDICO_RECEP_U30D"]
TEXT = ["LM_DIAGNOSTICO", "LM_ANTECEDENTES_CLINICOS"]
# The prior automatic approval flag, and the value that sets it
# in the source column, which callers name.
PRIOR_APPROVAL_COL = "PASO_FASTTRACK"
PRIOR_SOURCE_VALUE = "autvis"
TARGETS = ["TARGET_PERITAJE", "TARGET_PERITAJE2", "TARGET_RECHAZA", "TARGET_MODIFICA", "TARGET_FT3",
           "TARGET_RATIFICA", "TARGET_REQUIERE_REVISION", "TARGET_FT2", "TARGET_APRUEBA"]
# Columns that are known only once a claim has been decided.
OUTCOMES = ["I_DIASAUTORIZADOS", "F_DIASAUTORIZADOS", "PASO_FASTTRACK", "FECHA_RESOLUCION_COMPIN",
            "RESOLUCION_COMPIN"]


def reveals_label(name: str) -> bool:
    """Whether a column is a label, a leak or known only after the decision."""
    n = name.upper()
    return n.startswith("TARGET_") or "LEAK" in n or n in OUTCOMES


@dataclass(frozen=True)
class ColumnRoles:
    keys: list[str] = field(default_factory=lambda: list(KEYS))
    dates: list[str] = field(default_factory=lambda: list(DATES))
    categorical: list[str] = field(default_factory=lambda: list(CATEGORICAL))
    numeric: list[str] = field(default_factory=list)
    binary: list[str] = field(default_factory=lambda: list(BINARY))
    text: list[str] = field(default_factory=lambda: list(TEXT))
    targets: list[str] = field(default_factory=lambda: list(TARGETS))

    def assigned(self) -> set[str]:
        return set(self.keys + self.dates + self.categorical + self.numeric + self.binary
                   + self.text + self.targets)

    def with_numeric_from(self, df: DataFrame) -> "ColumnRoles":
        """Numeric role by rule: numeric columns with no other role that don't reveal the label."""
        taken = self.assigned()
        num = [f.name for f in df.schema.fields
               if isinstance(f.dataType, NumericType) and f.name not in taken
               and not reveals_label(f.name)]
        return ColumnRoles(self.keys, self.dates, self.categorical, list(self.numeric) + num,
                           self.binary, self.text, self.targets)

    def feature_columns(self, df: DataFrame) -> list[str]:
        """Role columns present in ``df`` in role order, de-duplicated, leaks removed."""
        out, seen = [], set()
        for c in (self.keys + self.dates + self.categorical + self.numeric + self.binary
                  + self.text + self.targets):
            if c in df.columns and c not in seen and "LEAK" not in c.upper():
                seen.add(c)
                out.append(c)
        return out


DEFAULT_ROLES = ColumnRoles()
