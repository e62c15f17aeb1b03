"""Declared schemas, keys and column mappings of the published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _struct(columns: list[tuple[str, T.DataType]], required: tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(n, t, n not in required) for n, t in columns])


def _typed(names: str, dtype: T.DataType) -> list[tuple[str, T.DataType]]:
    return [(n, dtype) for n in names.split()]


STRING, DOUBLE, LONG, INT = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()
DATE, BINARY, BOOL, TS = T.DateType(), T.BinaryType(), T.BooleanType(), T.TimestampNTZType()

# Column names of the published tables, in file order.
MEASURES = "prod_pet prod_gas prod_agua iny_agua iny_gas iny_co2 iny_otro tef vida_util".split()
STATE_COLUMNS = "tipoestado tipoextraccion tipopozo".split()
SENSORS = (
    "ABER-CKGL ABER-CKP ESTADO-DHSV ESTADO-M1 ESTADO-M2 ESTADO-PXO ESTADO-SDV-GL ESTADO-SDV-P "
    "ESTADO-W1 ESTADO-W2 ESTADO-XO P-ANULAR P-JUS-BS P-JUS-CKGL P-JUS-CKP P-MON-CKGL P-MON-CKP "
    "P-MON-SDV-P P-PDG PT-P P-TPT QBS QGL T-JUS-CKP T-MON-CKP T-PDG T-TPT"
).split()
CURVES = (
    "CALI RSHA RMED RDEP RHOB GR SGR NPHI PEF DTC SP BS ROP DTS DCAL DRHO MUDWEIGHT RMIC ROPA RXO"
).split()

WELL_MASTER = _struct(
    [("idpozo", LONG)]
    + _typed("sigla formprod codigopropio nombrepropio area cod_area yacimiento cod_yacimiento "
             "cuenca provincia idcuenca idprovincia formacion", STRING)
    + _typed("cota profundidad", DOUBLE)
    + _typed("clasificacion subclasificacion tipo_recurso sub_tipo_recurso gasplus proyecto "
             "empresa", STRING)
    + _typed("coordenadax coordenaday", DOUBLE)
    + [("geom", BINARY)]
    + _typed("adjiv_fecha_inicio_perf adjiv_fecha_fin_perf adjiv_fecha_inicio_term "
             "adjiv_fecha_fin_term adjiv_fecha_inicio adjiv_fecha_fin adjiv_fecha_abandono", DATE)
    + [("adjiv_equipo_utilizar", STRING)]
    + _typed("adjiv_capacidad_perf pet_inicial gas_inicial agua_inicial iny_agua_inicial "
             "iny_gas_inicial iny_otros_inicial iny_co2_inicial vida_util_inicial", DOUBLE)
    + [("has_production", BOOL)],
    ("idpozo",),
)
OPERATOR_HISTORY = _struct(
    [("idpozo", LONG), ("idempresa", STRING), ("empresa", STRING),
     ("valid_from", DATE), ("valid_to", DATE)],
    ("idpozo", "valid_from"),
)
STATE_EVENTS = _struct(
    [("idpozo", LONG), ("event_date", DATE)] + [(c, STRING) for c in STATE_COLUMNS],
    ("idpozo", "event_date"),
)
MONTHLY_SERIES = _struct(
    [("idpozo", LONG), ("fecha", DATE)] + [(c, DOUBLE) for c in MEASURES], ("idpozo", "fecha")
)
EVENT_TYPES = _struct(
    [("event_class", INT), ("name", STRING), ("description", STRING), ("has_transient", BOOL),
     ("transient_code", INT), ("has_normal_prefix", BOOL)],
    ("event_class", "name", "description", "has_transient", "has_normal_prefix"),
)
INSTANCES = _struct(
    [("instance_id", STRING), ("well_kind", STRING), ("well_id", INT), ("event_class", INT),
     ("start_ts", TS), ("end_ts", TS)]
    + _typed("duration_s n_rows n_rows_warmup_null n_rows_normal n_rows_transient n_rows_steady",
             LONG)
    + [("source_file", STRING), ("source_url", STRING)],
    ("instance_id", "event_class"),
)
SENSOR_WELLS = _struct(
    [("well_id", INT), ("n_instances", LONG), ("first_ts", TS), ("last_ts", TS),
     ("n_observations", LONG)],
    ("well_id",),
)
OBSERVATIONS = _struct(
    [("timestamp", TS)] + [(c, DOUBLE) for c in SENSORS] + [("class", INT), ("state", INT)]
    + [("instance_id", STRING), ("well_id", INT), ("well_kind", STRING), ("event_class", INT)],
    ("timestamp", "instance_id", "event_class"),
)
LITHOLOGY = "FORCE_2020_LITHOFACIES_LITHOLOGY"  # fixed value: stored column name
WELL_LOGS = _struct(
    [("WELL", STRING), ("DEPTH_MD", DOUBLE)] + _typed("X_LOC Y_LOC Z_LOC", DOUBLE)
    + _typed("GROUP FORMATION", STRING) + [(c, DOUBLE) for c in CURVES]
    + [(LITHOLOGY, LONG), ("dataset", STRING)],
    ("WELL", "DEPTH_MD"),
)
FIELD_WELLS = _struct(
    [("npd_wellbore_code", INT), ("wellbore_code", STRING), ("wellbore_name", STRING),
     ("npd_field_code", INT), ("npd_field_name", STRING), ("npd_facility_code", INT),
     ("npd_facility_name", STRING)],
    ("npd_wellbore_code", "wellbore_code", "wellbore_name", "npd_field_code", "npd_field_name",
     "npd_facility_code", "npd_facility_name"),
)
FIELD_DAILY = _struct(
    [("date", DATE), ("npd_wellbore_code", INT)]
    + _typed("on_stream_hours avg_downhole_pressure avg_dp_tubing avg_annulus_pressure "
             "avg_wellhead_pressure avg_downhole_temperature avg_wellhead_temperature "
             "avg_choke_size_percent", DOUBLE)
    + [("avg_choke_unit", STRING)]
    + _typed("dp_choke_size oil_volume gas_volume water_volume water_injection_volume", DOUBLE)
    + [("flow_kind", STRING), ("well_type", STRING)],
    ("date", "npd_wellbore_code"),
)
FIELD_MONTHLY = _struct(
    [("date", DATE), ("npd_wellbore_code", INT)]
    + _typed("on_stream_hours oil_volume_sm3 gas_volume_sm3 water_volume_sm3 gas_injection_sm3 "
             "water_injection_sm3", DOUBLE),
    ("date", "npd_wellbore_code"),
)

KEYS = {
    "well_master": ["idpozo"],
    "operator_history": ["idpozo", "valid_from"],
    "state_events": ["idpozo", "event_date"],
    "monthly_series": ["idpozo", "fecha"],
    "event_types": ["event_class"],
    "instances": ["instance_id", "event_class"],
    "sensor_wells": ["well_id"],
    "observations": ["instance_id", "event_class", "timestamp"],
    "well_logs": ["WELL", "DEPTH_MD"],
    "field_wells": ["npd_wellbore_code"],
    "field_daily": ["date", "npd_wellbore_code"],
    "field_monthly": ["date", "npd_wellbore_code"],
}

# Source column of the raw field sheets -> published column.
FIELD_WELLS_MAPPING = {
    "NPD_WELL_BORE_CODE": "npd_wellbore_code",
    "WELL_BORE_CODE": "wellbore_code",
    "NPD_WELL_BORE_NAME": "wellbore_name",
    "NPD_FIELD_CODE": "npd_field_code",
    "NPD_FIELD_NAME": "npd_field_name",
    "NPD_FACILITY_CODE": "npd_facility_code",
    "NPD_FACILITY_NAME": "npd_facility_name",
}
FIELD_DAILY_MAPPING = {
    "DATEPRD": "date",
    "NPD_WELL_BORE_CODE": "npd_wellbore_code",
    "ON_STREAM_HRS": "on_stream_hours",
    "AVG_DOWNHOLE_PRESSURE": "avg_downhole_pressure",
    "AVG_DP_TUBING": "avg_dp_tubing",
    "AVG_ANNULUS_PRESS": "avg_annulus_pressure",
    "AVG_WHP_P": "avg_wellhead_pressure",
    "AVG_DOWNHOLE_TEMPERATURE": "avg_downhole_temperature",
    "AVG_WHT_P": "avg_wellhead_temperature",
    "AVG_CHOKE_SIZE_P": "avg_choke_size_percent",
    "AVG_CHOKE_UOM": "avg_choke_unit",
    "DP_CHOKE_SIZE": "dp_choke_size",
    "BORE_OIL_VOL": "oil_volume",
    "BORE_GAS_VOL": "gas_volume",
    "BORE_WAT_VOL": "water_volume",
    "BORE_WI_VOL": "water_injection_volume",
    "FLOW_KIND": "flow_kind",
    "WELL_TYPE": "well_type",
}
FIELD_MONTHLY_MAPPING = {
    "NPDCode": "npd_wellbore_code",
    "On Stream": "on_stream_hours",
    "Oil": "oil_volume_sm3",
    "Gas": "gas_volume_sm3",
    "Water": "water_volume_sm3",
    "GI": "gas_injection_sm3",
    "WI": "water_injection_sm3",
}

# Lithology code -> label.
LITHOLOGY_LABELS = {
    30000: "Sandstone", 65000: "Shale", 65030: "Sandstone/Shale", 70000: "Limestone",
    70032: "Chalk", 74000: "Dolomite", 80000: "Marl", 86000: "Anhydrite", 88000: "Halite",
    90000: "Coal", 93000: "Basement", 99000: "Tuff",
}

# Columns whose change over time the volatility scan reports, with the bucket
# each is expected to fall in.
EXPECTED_BUCKETS = {
    **dict.fromkeys(
        "sigla formprod profundidad formacion cuenca provincia idareapermisoconcesion "
        "areapermisoconcesion idareayacimiento areayacimiento tipo_de_recurso sub_tipo_recurso "
        "clasificacion subclasificacion proyecto".split(), "static"),
    **dict.fromkeys("idempresa empresa".split(), "scd"),
    **dict.fromkeys(STATE_COLUMNS, "event"),
    **dict.fromkeys(MEASURES, "time-series"),
}


def schema_differences(df: DataFrame, contract: T.StructType) -> list[str]:
    """Where the columns of ``df`` differ from the contract in name, order or type."""
    have = [(f.name, f.dataType.simpleString()) for f in df.schema]
    want = [(f.name, f.dataType.simpleString()) for f in contract]
    problems = [f"missing {n} {t}" for n, t in want if (n, t) not in have]
    problems += [f"unexpected {n} {t}" for n, t in have if (n, t) not in want]
    if not problems and have != want:
        problems.append("column order differs")
    return problems


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Project ``df`` onto the contract: its columns, in its order, cast to its types."""
    from pyspark.sql import functions as F

    return df.select([F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in contract])


def schema_table(df: DataFrame, key: list[str], partitions: tuple[str, ...] = ()) -> DataFrame:
    """One row per column: position, name, type, nullability, key and partition flags."""
    rows = [
        (i, f.name, f.dataType.simpleString(), f.nullable and f.name not in key,
         f.name in key, f.name in partitions)
        for i, f in enumerate(df.schema)
    ]
    return df.sparkSession.createDataFrame(
        rows, "position int, column_name string, data_type string, nullable boolean, "
              "is_key boolean, is_partition boolean")
