"""Output contracts (survey A10, A12)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType


def conform_to_contract(df: DataFrame, contract: StructType,
                        text_limits: Mapping[str, int] | None = None) -> DataFrame:
    """A10: make ``df`` match ``contract``.

    Column names are upper-cased and trimmed; missing columns are added as
    typed NULL; values are cast with ``try_cast`` (bad values become NULL
    instead of failing the job); text columns are truncated to their limit;
    columns are put in contract order and extra columns dropped.  NULL stays
    NULL (no 'None' / 'nan' text).
    """
    limits = {k.upper(): v for k, v in (text_limits or {}).items()}
    renamed = df.toDF(*[c.strip().upper() for c in df.columns])
    have = set(renamed.columns)
    cols = []
    for f in contract.fields:
        name = f.name.upper()
        if name in have:
            c = F.col(name)
            if isinstance(f.dataType, StringType):
                c = c.cast("string")
            else:
                c = F.expr(f"try_cast(`{name}` AS {f.dataType.simpleString()})")
        else:
            c = F.lit(None).cast(f.dataType)
        if name in limits:
            c = F.substring(c.cast("string"), 1, limits[name])
        cols.append(c.alias(f.name))
    return renamed.select(*cols)


def map_output_columns(df: DataFrame) -> DataFrame:
    """Output column mapping of the predictions table.

    Doctor = provider, else local provider; employer and claim number copied;
    absent sources give NULL columns.  An output column that the input already
    has keeps its non-NULL values.
    """
    def col(name):
        return F.col(name) if name in df.columns else F.lit(None).cast("string")

    mapped = {
        "LCC_MEDRUT": F.coalesce(col("PRESTADOR_RUT"), col("PRESTADOR_LOCAL_RUT")),
        "LCC_EMPRUT": col("EMPLEADOR_RUT"),
        "LCC_IDN": col("N_LICENCIA").cast("string"),
        "LCC_OPERADOR": F.lit(None).cast("string"),
    }
    kept = [F.col(f"`{c}`") for c in df.columns if c not in mapped]
    return df.select(*kept, *[F.coalesce(F.col(c), m).alias(c) if c in df.columns else m.alias(c)
                              for c, m in mapped.items()])


# The predictions table contract (column, type, text limit).
PREDICTIONS_COLUMNS = [
    ("AFILIADO_RUT", "string", 11), ("LCC_COMCOD", "bigint", None), ("LCC_COMCOR", "bigint", None),
    ("LCC_OPERADOR", "bigint", None), ("LCC_MEDRUT", "string", 11), ("LCC_EMPRUT", "string", 11),
    ("LCC_IDN", "string", 20), ("EPISODIO_ACUM_DIAS", "bigint", None), ("EPISODIO_FEC_INI", "date", None),
    ("CONTINUA_CALC", "string", 1), ("TIPO_F_LM_COD", "bigint", None), ("TIPO_F_LM", "string", 35),
    ("FECHA_RECEPCION", "timestamp_ntz", None), ("FECHA_INICIO", "timestamp_ntz", None),
    ("FECHA_TERMINO", "timestamp_ntz", None), ("DIASSOLICITADO", "bigint", None), ("CIE_F", "string", 120),
    ("CIE_F_COD", "string", 12), ("CIE_GRUPO", "string", 30), ("LM_DIAGNOSTICO", "string", 100),
    ("LM_ANTECEDENTES_CLINICOS", "string", 100), ("COT_EDAD", "bigint", None), ("COT_GENERO", "string", 4),
    ("RENTA_ESTIMADA", "double", None), ("SEMAFORO", "string", 20), ("PROBABILIDAD_APROBACION", "double", None),
    ("UMBRAL_VERDE", "double", None), ("UMBRAL_AMARILLO", "double", None),
    ("FECHA_PROCESAMIENTO", "timestamp_ntz", None), ("FECHA_DESDE", "date", None), ("FECHA_HASTA", "date", None),
    ("MODELO_VERSION", "string", 10), ("ES_PENDIENTE", "int", None), ("TARGET_FT3", "int", None),
    ("TARGET_APRUEBA", "int", None), ("GLOSA_GENERADA", "string", 500), ("CAUSAL_GENERADA", "string", 100),
    ("LEAK_FT", "string", 100), ("LEAK_CAUSALES", "string", 500), ("LEAK_DIASAUTORIZADOS", "bigint", None),
    ("LEAK_GLOSAS", "string", 500), ("LEAK_ESTADOLM", "string", 35), ("LEAK_FALLO_PE", "string", 255),
]


def predictions_contract() -> tuple[StructType, dict[str, int]]:
    """(schema, text limits) of the predictions table."""
    from pyspark.sql.types import _parse_datatype_string
    schema = _parse_datatype_string(", ".join(f"{c} {t}" for c, t, _ in PREDICTIONS_COLUMNS))
    return schema, {c: n for c, _, n in PREDICTIONS_COLUMNS if n}
