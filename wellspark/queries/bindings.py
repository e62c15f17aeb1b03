"""The given tables read as well, sensor, log and field tables.

Each binding is a select list over one given table (or over another binding), written in the
SQL that Spark and the check engine share, so both start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MONTH = "make_date(CAST(year({0}) AS INT), CAST(month({0}) AS INT), 1)"
_K = "regexp_extract(props, '\"k\": ([0-9]+)', 1)"
_CLASS = ("CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 "
          "WHEN 'signup' THEN 3 ELSE 4 END")

# name -> (source, select list, condition)
_BINDINGS: dict[str, tuple[str, list[str], str | None]] = {
    # Raw monthly production rows: a part is a well, a line item is a report about it.
    "production": ("lineitem", [
        "l_partkey AS idpozo",
        "CAST(year(l_shipdate) AS INT) AS anio",
        "CAST(month(l_shipdate) AS INT) AS mes",
        "l_extendedprice AS prod_pet",
        "CASE WHEN l_quantity > 45 THEN NULL ELSE l_quantity END AS prod_gas",
        "l_discount AS prod_agua",
        "l_tax AS iny_agua",
        "CASE WHEN l_returnflag = 'R' THEN l_tax END AS iny_gas",
        "CAST(NULL AS DOUBLE) AS iny_co2",
        "CASE WHEN l_linestatus = 'F' THEN l_discount END AS iny_otro",
        "CAST(l_linenumber AS DOUBLE) AS tef",
        "l_quantity * 2 AS vida_util",
        "'Z' || lpad(CAST(l_suppkey AS STRING), 3, '0') AS idempresa",
        "'Operator ' || CAST(l_linenumber AS STRING) AS empresa",
        "l_returnflag AS tipoestado",
        "CASE WHEN l_tax > 0.05 THEN NULL ELSE l_linestatus END AS tipoextraccion",
        "CASE WHEN l_discount > 0.05 THEN 'B' ELSE 'A' END AS tipopozo",
        "'S-' || CAST(l_linenumber AS STRING) AS sigla",
        "l_returnflag AS formprod",
        "l_returnflag AS formacion",
        "CASE WHEN l_linestatus = 'F' THEN 'NORTH' ELSE 'SOUTH' END AS cuenca",
        "CASE WHEN l_quantity < 10 THEN NULL ELSE l_linestatus END AS provincia",
        "l_quantity AS profundidad",
        "l_returnflag || l_linestatus AS tipo_de_recurso",
        "CAST(l_linenumber AS STRING) AS sub_tipo_recurso",
        "CAST(NULL AS STRING) AS clasificacion",
        "l_linestatus AS subclasificacion",
        "CASE WHEN l_linenumber = 7 THEN 'P7' END AS proyecto",
        "'A' || CAST(l_linenumber AS STRING) AS areapermisoconcesion",
        "'C' || CAST(l_linenumber AS STRING) AS idareapermisoconcesion",
        "l_linestatus AS areayacimiento",
        "l_returnflag AS idareayacimiento",
    ], None),
    # Registry: parts, those of one brand under keys of their own, and suppliers as wells that
    # never produce.
    "registry_parts": ("part", [
        "CASE WHEN p_brand = 'Brand#13' THEN -1000000000 - p_partkey ELSE p_partkey END AS idpozo",
        "CASE WHEN p_size > 40 THEN NULL ELSE p_name END AS sigla",
        "p_brand AS area", "p_type AS cod_area", "p_brand AS empresa",
        "CAST(NULL AS STRING) AS yacimiento", "p_type AS cod_yacimiento",
        "CASE WHEN p_size < 10 THEN NULL ELSE p_type END AS formacion",
        "p_brand AS cuenca",
        "CASE WHEN p_size < 25 THEN NULL ELSE p_type END AS provincia",
        "CAST(p_size AS DOUBLE) AS cota",
        "CASE WHEN p_size > 30 THEN NULL ELSE p_retailprice END AS profundidad",
        "p_type AS clasificacion", "p_brand AS subclasificacion",
        "CASE WHEN p_type = 'ECONOMY' THEN 'NO CONVENCIONAL' ELSE 'CONVENCIONAL' END "
        "AS tipo_recurso",
        "p_type AS sub_tipo_recurso", "'no' AS gasplus",
        "DATE '1995-01-01' AS adjiv_fecha_inicio_perf",
        "DATE '1995-02-01' AS adjiv_fecha_fin_perf",
        "CAST(NULL AS DATE) AS adjiv_fecha_inicio_term",
        "CAST(NULL AS DATE) AS adjiv_fecha_fin_term",
        "'0101000000' || lpad(CAST(p_size AS STRING), 2, '0') || repeat('0', 30) AS geom",
    ], None),
    "registry_idle": ("supplier", [
        "-1 - s_suppkey AS idpozo", "s_name AS sigla", "'IDLE' AS area", "'I' AS cod_area",
        "s_name AS empresa", "CAST(NULL AS STRING) AS yacimiento", "'I' AS cod_yacimiento",
        "CAST(NULL AS STRING) AS formacion", "'IDLE' AS cuenca",
        "CAST(NULL AS STRING) AS provincia", "s_acctbal AS cota",
        "CAST(NULL AS DOUBLE) AS profundidad", "'I' AS clasificacion",
        "'I' AS subclasificacion", "'CONVENCIONAL' AS tipo_recurso", "'I' AS sub_tipo_recurso",
        "'no' AS gasplus", "CAST(NULL AS DATE) AS adjiv_fecha_inicio_perf",
        "CAST(NULL AS DATE) AS adjiv_fecha_fin_perf",
        "CAST(NULL AS DATE) AS adjiv_fecha_inicio_term",
        "CAST(NULL AS DATE) AS adjiv_fecha_fin_term", "CAST(NULL AS STRING) AS geom",
    ], None),
    # The smallest parts are listed under keys that nothing else has.
    "listing": ("part", [
        "CASE WHEN p_size < 5 THEN -2000000000 - p_partkey ELSE p_partkey END AS idpozo",
        "CASE WHEN p_size > 20 THEN p_name ELSE upper(p_name) END AS sigla",
        "p_type AS formprod", "CAST(p_size AS STRING) AS codigopropio",
        "p_name AS nombrepropio", "p_brand AS areapermisoconcesion",
        "p_type AS idareapermisoconcesion",
        "CASE WHEN p_size > 15 THEN p_brand END AS areayacimiento",
        "p_type AS idareayacimiento",
        "CASE WHEN p_size > 10 THEN p_brand END AS cuenca",
        "CASE WHEN p_size > 12 THEN p_type END AS provincia",
        "p_brand AS idcuenca", "p_type AS idprovincia",
        "p_retailprice / 10 AS coordenadax",
        "CASE WHEN p_size > 45 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS coordenaday",
        "CAST(p_size AS DOUBLE) AS cota",
        "CASE WHEN p_size > 35 THEN NULL ELSE p_retailprice END AS profundidad",
        "DATE '1994-05-01' AS adjiv_fecha_inicio", "DATE '1994-06-01' AS adjiv_fecha_fin",
        "CAST(NULL AS DATE) AS adjiv_fecha_abandono", "p_type AS adjiv_equipo_utilizar",
        "CAST(p_size AS DOUBLE) AS adjiv_capacidad_perf",
        "p_retailprice AS pet_inicial", "p_retailprice AS gas_inicial",
        "p_retailprice AS agua_inicial", "CAST(0 AS DOUBLE) AS iny_agua_inicial",
        "CAST(0 AS DOUBLE) AS iny_gas_inicial", "CAST(0 AS DOUBLE) AS iny_otros_inicial",
        "CAST(0 AS DOUBLE) AS iny_co2_inicial", "CAST(p_size AS DOUBLE) AS vida_util_inicial",
        "p_type AS clasificacion",
    ], None),
    # Published production tables: sums are taken over exact two-decimal values.
    "monthly": ("lineitem", [
        "l_partkey AS idpozo", MONTH.format("l_shipdate") + " AS fecha",
        "CAST(l_extendedprice AS DECIMAL(18,2)) AS prod_pet",
        "CAST(CASE WHEN l_quantity > 45 THEN NULL ELSE l_quantity END AS DECIMAL(18,2)) "
        "AS prod_gas",
        "CAST(l_discount AS DECIMAL(18,2)) AS prod_agua",
    ], None),
    "wells": ("part", [
        "p_partkey AS idpozo", "p_name AS sigla",
        "CASE WHEN p_size = 50 THEN NULL ELSE p_brand END AS cuenca", "p_type AS provincia",
        "CASE WHEN p_type = 'ECONOMY' THEN 'NO CONVENCIONAL' WHEN p_size < 10 THEN NULL "
        "ELSE 'CONVENCIONAL' END AS tipo_recurso",
        "p_brand AS clasificacion", "p_retailprice / 10 AS coordenadax",
        "CASE WHEN p_size > 45 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS coordenaday",
    ], None),
    # Months an account ordered in: the series that calendar filling and gap audits work on.
    "order_months": ("orders", [
        "o_custkey AS idpozo", MONTH.format("o_orderdate") + " AS fecha",
        "o_totalprice AS prod_pet", "o_orderstatus AS status"], None),
    # Sensor rows: a user is a well (or a simulated or drawn series), an event a reading.
    "sensor_rows": ("events", [
        "ts AS timestamp", "value AS \"P-PDG\"",
        f"CAST({_K} AS DOUBLE) AS \"T-PDG\"",
        "CASE WHEN value > 100 THEN NULL ELSE value * 2 END AS \"P-TPT\"",
        f"CASE WHEN {_CLASS} IN (0, 3, 4) THEN {_CLASS} WHEN value < 5 THEN NULL "
        f"WHEN value < 20 THEN 0 WHEN value < 50 THEN {_CLASS} + 100 ELSE {_CLASS} END AS class",
        f"CASE WHEN CAST({_K} AS INT) >= 90 THEN NULL "
        f"ELSE CAST(floor(CAST({_K} AS INT) / 10) AS INT) END AS state",
        f"'/staging/dataset/' || CAST({_CLASS} AS STRING) || '/' || "
        "CASE user_id % 10 WHEN 8 THEN 'SIMULATED_' WHEN 9 THEN 'DRAWN_' ELSE 'WELL-' END || "
        "lpad(CAST(user_id AS STRING), 5, '0') || '_20240101000000.parquet' AS file_path",
    ], None),
    # The same rows after an edit that parity has to find.
    "edited_sensor_rows": ("sensor_rows", [
        "timestamp",
        "CASE WHEN \"P-PDG\" > 300 THEN \"P-PDG\" + 1 ELSE \"P-PDG\" END AS \"P-PDG\"",
        "\"T-PDG\"", "\"P-TPT\"",
        "CASE WHEN class = 101 AND \"T-PDG\" = 7 THEN 1 ELSE class END AS class",
        "state", "file_path",
    ], "NOT (\"T-PDG\" = 13 AND class IS NULL)"),
    "sensor_specs": ("events", [
        f"{_CLASS} AS event_class", "upper(event_type) AS name",
        "'Event ' || event_type AS description",
        f"{_CLASS} NOT IN (0, 3, 4) AS has_transient"], "DISTINCT"),
    # Well logs: a supplier is a well, a line item a sample.
    "logs": ("lineitem", [
        "'W-' || CAST(l_suppkey AS STRING) AS WELL",
        "CAST(l_orderkey * 10 + l_linenumber AS DOUBLE) AS DEPTH_MD",
        "CASE WHEN l_linestatus = 'F' THEN 'Group ' || l_returnflag END AS FORMATION",
        "CASE WHEN l_quantity = 13 THEN -999.25 WHEN l_quantity = 14 THEN -999 "
        "ELSE l_quantity * 3.25 - 10 END AS GR",
        "CASE WHEN l_tax = 0 THEN -999.9 ELSE 1.9 + l_discount * 10 END AS RHOB",
        "CASE WHEN l_quantity > 48 THEN NULL ELSE 0.5 - l_tax * 8 END AS NPHI",
        "CASE WHEN l_discount = 0 THEN NULL ELSE l_extendedprice END AS RDEP",
        "CASE l_returnflag WHEN 'A' THEN 30000 WHEN 'N' THEN 65000 ELSE 70000 END AS lithology",
        "CASE WHEN l_linestatus = 'F' THEN 'train' ELSE 'test' END AS dataset",
    ], None),
    # Field tables: a customer is a well, an order a day's report.
    "field_wells": ("customer", [
        "c_custkey AS npd_wellbore_code", "c_name AS wellbore_name"], None),
    "field_daily": ("orders", [
        "CAST(o_orderdate AS DATE) AS date", "o_custkey AS npd_wellbore_code",
        "CAST(CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_totalprice END "
        "AS DECIMAL(18,2)) AS oil_volume",
        "CAST(o_orderkey * 3 AS DECIMAL(18,2)) AS gas_volume",
        "CAST(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey END AS DECIMAL(18,2)) "
        "AS water_volume",
        "CASE WHEN o_orderstatus = 'F' THEN 'WI' ELSE 'OP' END AS well_type",
    ], None),
    # Urgent orders are reported for wells that do not exist.
    "field_reported": ("orders", [
        MONTH.format("o_orderdate") + " AS date",
        "CASE WHEN o_orderpriority = '1-URGENT' THEN -o_custkey ELSE o_custkey END AS npd_wellbore_code",
        "CAST(CASE WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderstatus = 'P' "
        "THEN o_totalprice + 1 ELSE o_totalprice END AS DECIMAL(18,2)) AS oil_volume_sm3",
        "CAST(o_orderkey * 3 AS DECIMAL(18,2)) AS gas_volume_sm3",
        "CAST(o_orderkey AS DECIMAL(18,2)) AS water_volume_sm3",
    ], None),
}


def _spark_text(text: str) -> str:
    """The same expression with Spark's quoting of column names and of patterns."""
    # Double quotes occur as column quotes, and once inside the pattern of _K.
    marked = text.replace(_K, "\0")
    return marked.replace('"', "`").replace("\0", _K)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bound(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A binding as a DataFrame."""
    if name == "registry":
        return bound(spark, folder, "registry_parts").unionByName(
            bound(spark, folder, "registry_idle"))
    source, columns, condition = _BINDINGS[name]
    df = bound(spark, folder, source) if source in _BINDINGS else table(spark, folder, source)
    if condition == "DISTINCT":
        return df.selectExpr(*map(_spark_text, columns)).distinct()
    if condition:
        df = df.where(_spark_text(condition))
    return df.selectExpr(*map(_spark_text, columns))


def _ctes(names: tuple[str, ...]) -> dict[str, str]:
    out: dict[str, str] = {}
    for name in names:
        if name == "registry":
            out.update(_ctes(("registry_parts", "registry_idle")))
            out[name] = "SELECT * FROM registry_parts UNION ALL SELECT * FROM registry_idle"
            continue
        source, columns, condition = _BINDINGS[name]
        if source in _BINDINGS:
            out.update(_ctes((source,)))
        distinct = "DISTINCT " if condition == "DISTINCT" else ""
        where = f" WHERE {condition}" if condition and not distinct else ""
        out[name] = f"SELECT {distinct}{', '.join(columns)} FROM {source}{where}"
    return out


def with_bindings(sql: str, names: tuple[str, ...]) -> str:
    """Put the bindings in front of a query (which may begin with more of its own CTEs)."""
    ctes = ", ".join(f"{n} AS ({body})" for n, body in _ctes(names).items())
    sql = sql.strip()
    if not ctes:
        return sql
    if sql[:5].upper() == "WITH ":
        return f"WITH {ctes}, {sql[5:]}"
    return f"WITH {ctes} {sql}"
