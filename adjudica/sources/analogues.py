"""Claim-shaped views of the driver's test tables.

The library works on the claim schema (column names of the claims mart).  The
test tables are TPC-H-like, so each analogue below is a pure projection,
written once as SQL select-list text and used by both the Spark query
(``selectExpr``) and the DuckDB oracle (a CTE), so inputs are identical and
only the operator logic differs between the two sides.

Mapping (see FIXTURES.md section 2): claim = order, person = customer,
reception date = order date, verdict = order status (F ratified, P denied,
O undecided); services = line items of the person's orders; exams = events;
scores = rounded discount, label = return flag (N -> 1, R -> 0, A -> NULL).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CLAIMS_FROM_ORDERS = [
    "CAST(o_custkey AS STRING) AS AFILIADO_RUT",
    "o_orderkey AS LCC_COMCOR",
    "CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS LCC_COMCOD",
    "CAST(o_orderdate AS DATE) AS FECHA_RECEPCION",
    "CASE o_orderstatus WHEN 'F' THEN 'RATIFICA' WHEN 'P' THEN 'deniega' END AS RESOLUCION_COMPIN",
    "CASE WHEN o_orderstatus <> 'O' AND o_orderkey % 3 <> 0 OR o_orderkey % 11 = 0 THEN CAST(o_orderdate AS DATE) END AS FECHA_RESOLUCION_COMPIN",
    "CAST(floor(o_totalprice / 10000) AS BIGINT) AS DIASSOLICITADO",
    "CASE o_orderstatus WHEN 'F' THEN CAST(floor(o_totalprice / 10000) AS BIGINT) "
    "WHEN 'P' THEN CAST(0 AS BIGINT) END AS F_DIASAUTORIZADOS",
]

# services: line items of the person's orders, dated by ship date
SERVICES_FROM_LINEITEM = [
    "CAST(o_custkey AS STRING) AS COTIZANTE_RUT",
    "CAST(l_shipdate AS DATE) AS FECHA",
    "CAST(l_orderkey AS STRING) AS FOLIO",
    "l_quantity AS PRESTACION_CANTIDAD",
    "CAST(l_suppkey AS STRING) AS MEDTRATANTE_RUT",
    "CASE WHEN l_returnflag = 'R' THEN 'Hospitalario' WHEN l_returnflag = 'A' THEN 'BONO' "
    "WHEN l_linestatus = 'O' THEN 'reembolso' ELSE 'FARMACIA' END AS TIPO",
    "CASE WHEN l_linestatus = 'F' THEN 'GES' END AS PATOLOGIA_GES",
    "CASE WHEN l_discount >= 0.05 THEN 'CAEC' END AS PATOLOGIA_CAEC",
]

# events as both claims (probes) and expert examinations (history)
CLAIMS_FROM_EVENTS = [
    "CAST(user_id AS STRING) AS AFILIADO_RUT",
    "event_id AS LCC_COMCOR",
    "CAST(1 AS BIGINT) AS LCC_COMCOD",
    "CAST(ts AS DATE) AS FECHA_RECEPCION",
]
EXAMS_FROM_EVENTS = [
    "CAST(user_id AS STRING) AS AFILIADO_RUT",
    "CAST(ts AS DATE) AS PERITAJE_PERITAJE_FECHA_CITACION",
    "CASE WHEN event_type = 'error' THEN 'NO ASISTE' WHEN event_type = 'signup' THEN NULL "
    "ELSE 'ASISTE' END AS ASISTENCIA",
    "CASE WHEN event_type = 'purchase' THEN 'ACUERDO' WHEN event_type = 'click' THEN 'DESACUERDO' "
    "END AS ACUERDO_DESACUERDO",
]

# examinations on the days of the person's shipments: their dates overlap the claims of the orders
EXAMS_FROM_LINEITEM = [
    "CAST(o_custkey AS STRING) AS AFILIADO_RUT",
    "CAST(l_shipdate AS DATE) AS PERITAJE_PERITAJE_FECHA_CITACION",
    "CASE l_returnflag WHEN 'R' THEN 'NO ASISTE' WHEN 'N' THEN 'ASISTE' "
    "ELSE CASE WHEN l_linenumber <> 2 THEN 'ASISTE' END END AS ASISTENCIA",
    "CASE WHEN l_linenumber = 1 THEN 'ACUERDO' WHEN l_linenumber < 4 THEN 'DESACUERDO' END AS ACUERDO_DESACUERDO",
]

# scored rows: score = round(discount * 10, 3), label N -> 1, R -> 0, A -> NULL,
# prior approval (FT1) = zero tax, accumulated days = quantity + 4 * line number
SCORED_FROM_LINEITEM = [
    "l_orderkey AS LCC_COMCOR",
    "CAST(l_linenumber AS BIGINT) AS LCC_COMCOD",
    "l_partkey AS PART_KEY",
    "round(l_discount * 10, 3) AS PROBABILIDAD_APROBACION",
    "CASE l_returnflag WHEN 'N' THEN 1 WHEN 'R' THEN 0 END AS TARGET_FT3",
    "CAST(l_quantity AS BIGINT) AS DIASSOLICITADO",
    "CAST(l_quantity + l_linenumber * 4 AS BIGINT) AS EPISODIO_ACUM_DIAS",
    "CASE WHEN l_tax = 0 THEN 1 ELSE 0 END AS LEAK_FT",
    "l_linestatus AS LINE_STATUS",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def claims_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*CLAIMS_FROM_ORDERS)


def services_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey).selectExpr(*SERVICES_FROM_LINEITEM)


def claims_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*CLAIMS_FROM_EVENTS)


def exams_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*EXAMS_FROM_EVENTS)


def exams_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey).selectExpr(*EXAMS_FROM_LINEITEM)


def scored_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*SCORED_FROM_LINEITEM)


def sql_cte(name: str, select_list: list[str], source: str) -> str:
    """``name AS (SELECT ... FROM source)`` for oracle SQL."""
    return f"{name} AS (SELECT {', '.join(select_list)} FROM {source})"


SERVICES_SOURCE = "lineitem JOIN orders ON l_orderkey = o_orderkey"
