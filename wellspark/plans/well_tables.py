"""Published tables of the well-production dataset, built from its raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspark.contracts import MEASURES, STATE_COLUMNS, WELL_MASTER, conform
from wellspark.functions.columns import month_of, quoted
from wellspark.operators.master import merge_master, modal_attributes
from wellspark.operators.temporal import (
    collapse_intervals,
    dedupe_key,
    dedupe_rows,
    detect_transitions,
    fill_calendar,
)

# Modal column of the monthly rows -> their source column.
PRODUCTION_MODES = {
    "sigla": "sigla",
    "formacion": "formacion",
    "cuenca": "cuenca",
    "provincia": "provincia",
    "profundidad": "profundidad",
    "tipo_recurso": "tipo_de_recurso",
    "sub_tipo_recurso": "sub_tipo_recurso",
    "clasificacion": "clasificacion",
    "subclasificacion": "subclasificacion",
    "proyecto": "proyecto",
    "area": "areapermisoconcesion",
    "cod_area": "idareapermisoconcesion",
    "yacimiento": "areayacimiento",
    "cod_yacimiento": "idareayacimiento",
}

# Columns by the sources that may give them, in order of precedence.
_EVERYWHERE = {  # registry, then listing under this name, then production
    "sigla": "sigla", "area": "areapermisoconcesion", "cod_area": "idareapermisoconcesion",
    "yacimiento": "areayacimiento", "cod_yacimiento": "idareayacimiento", "cuenca": "cuenca",
    "provincia": "provincia", "profundidad": "profundidad",
}
_REGISTRY_PRODUCTION = (
    "formacion clasificacion subclasificacion tipo_recurso sub_tipo_recurso").split()
_REGISTRY = (
    "gasplus empresa geom adjiv_fecha_inicio_perf adjiv_fecha_fin_perf adjiv_fecha_inicio_term "
    "adjiv_fecha_fin_term").split()
_LISTING = (
    "formprod codigopropio nombrepropio idcuenca idprovincia coordenadax coordenaday "
    "adjiv_fecha_inicio adjiv_fecha_fin adjiv_fecha_abandono adjiv_equipo_utilizar "
    "adjiv_capacidad_perf pet_inicial gas_inicial agua_inicial iny_agua_inicial iny_gas_inicial "
    "iny_otros_inicial iny_co2_inicial vida_util_inicial").split()

MASTER_RULES: dict[str, list[str]] = {
    **{c: [f"registry.{c}", f"listing.{name}", f"production.{c}"]
       for c, name in _EVERYWHERE.items()},
    **{c: [f"registry.{c}", f"production.{c}"] for c in _REGISTRY_PRODUCTION},
    "cota": ["registry.cota", "listing.cota"],
    **{c: [f"registry.{c}"] for c in _REGISTRY},
    **{c: [f"listing.{c}"] for c in _LISTING},
    "proyecto": ["production.proyecto"],
}


def _dated(production: DataFrame, columns: list[str]) -> DataFrame:
    return production.select(
        "idpozo", month_of(F.col("anio"), F.col("mes")).alias("fecha"),
        *[quoted(c) for c in columns]).where(F.col("fecha").isNotNull())


def by_month(production: DataFrame, columns: list[str]) -> DataFrame:
    """One row per well and month; the smallest non-NULL value of each column."""
    return dedupe_key(_dated(production, columns), ["idpozo", "fecha"], columns)


def one_row_by_month(production: DataFrame, columns: list[str]) -> DataFrame:
    """One of the rows of each well and month: the smallest by the columns, NULL last."""
    return dedupe_rows(_dated(production, columns), ["idpozo", "fecha"], columns)


def monthly_series(production: DataFrame) -> DataFrame:
    """Every month from a well's first to its last, measures NULL where none were reported."""
    return fill_calendar(by_month(production, MEASURES), ["idpozo"], "fecha", MEASURES)


def operator_history(production: DataFrame) -> DataFrame:
    """Intervals of one operator per well, with the name it had in the first month.

    Code and name of a month are from one row, the one with the smallest code.
    """
    return collapse_intervals(
        one_row_by_month(production, ["idempresa", "empresa"]), ["idpozo"], "fecha", "idempresa",
        carry=("empresa",))


def state_events(production: DataFrame) -> DataFrame:
    """Months in which the operational state of a well changed; a month's state is that of one row."""
    return detect_transitions(
        one_row_by_month(production, STATE_COLUMNS), ["idpozo"], "fecha", STATE_COLUMNS
    ).withColumnRenamed("fecha", "event_date")


def well_master(registry: DataFrame, listing: DataFrame, production: DataFrame) -> DataFrame:
    """Static attributes of every well in the registry or in production."""
    decoded = registry.withColumn("geom", F.unhex("geom"))
    merged = merge_master(
        "idpozo",
        {"registry": decoded, "listing": listing,
         "production": modal_attributes(production, "idpozo", PRODUCTION_MODES)},
        spine=["registry", "production"], rules=MASTER_RULES,
        presence={"has_production": "production"})
    return conform(merged, WELL_MASTER)
