"""End to end over a small set of raw CSV files: build, check, publish, read back."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspark import contracts
from wellspark.operators.checks import (
    CompletenessError,
    ForeignKeyError,
    Gate,
    GeometryError,
    IntegrityError,
    UniqueKeyError,
    production_gate,
)
from wellspark.plans import publishing, well_tables
from wellspark.sources import files, readers, versions

POINT = "0101000020E610000000000000004051C000000000000043C0"


def _schema(names, **types):
    return T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in names])


REGISTRY = ("sigla idpozo area cod_area empresa yacimiento cod_yacimiento formacion cuenca "
            "provincia cota profundidad clasificacion subclasificacion tipo_recurso "
            "sub_tipo_recurso gasplus tipopozo tipoextraccion tipoestado "
            "adjiv_fecha_inicio_perf adjiv_fecha_fin_perf adjiv_fecha_inicio_term "
            "adjiv_fecha_fin_term geojson geom").split()
LISTING = ("idpozo sigla formprod idareapermisoconcesion idareayacimiento idcuenca idprovincia "
           "codigopropio nombrepropio coordenadax coordenaday cota profundidad pet_inicial "
           "gas_inicial agua_inicial iny_agua_inicial iny_gas_inicial iny_otros_inicial "
           "iny_co2_inicial vida_util_inicial adjiv_fecha_inicio adjiv_equipo_utilizar "
           "adjiv_capacidad_perf adjiv_fecha_fin adjiv_fecha_abandono areapermisoconcesion "
           "areayacimiento cuenca provincia").split()
PRODUCTION = (["idempresa", "anio", "mes", "idpozo", *contracts.MEASURES]
              + ("tipoextraccion tipoestado tipopozo empresa sigla formprod profundidad formacion "
                 "idareapermisoconcesion areapermisoconcesion idareayacimiento areayacimiento "
                 "cuenca provincia tipo_de_recurso proyecto clasificacion subclasificacion "
                 "sub_tipo_recurso").split())
TYPES = dict.fromkeys([*contracts.MEASURES, "profundidad", "cota", "coordenadax", "coordenaday"],
                      T.DoubleType()) | dict.fromkeys(["idpozo"], T.LongType()) \
    | dict.fromkeys(["anio", "mes"], T.IntegerType())


def _write(path, columns, rows):
    lines = [",".join(columns)]
    lines += [",".join(str(r.get(c, "")) for c in columns) for r in rows]
    path.write_text("\n".join(lines) + "\n")


def _report(year, month, well, operator, state="on", **more):
    name = "TEST S.A." if operator == "Z001" else "APEA OPERATOR"
    return {"idempresa": operator, "anio": year, "mes": month, "idpozo": well, "empresa": name,
            "prod_pet": 10.5 * month, "prod_gas": 7, "tipoestado": state, "tipoextraccion": "pump",
            "tipopozo": "oil", "sigla": f"P{well}", "cuenca": "PROD", "profundidad": 2000 + well,
            "tipo_de_recurso": "CONVENCIONAL", "proyecto": "none", **more}


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    _write(folder / "registry.csv", REGISTRY, [
        {"idpozo": w, "sigla": f"R{w}", "cuenca": "NEUQUINA", "empresa": "TEST S.A.", "cota": 500,
         "geom": POINT, "adjiv_fecha_inicio_perf": "2006-01-01"}
        for w in (1001, 1002, 1003, 1004)])
    _write(folder / "listing.csv", LISTING, [
        {"idpozo": w, "sigla": f"L{w}", "formprod": "TFM", "cuenca": "LIST",
         "coordenadax": -69.0, "coordenaday": -38.0} for w in (1001, 1002, 1003, 1005)])
    first = [_report(2006, m, w, "Z001") for w in (1001, 1002, 1003) for m in (1, 2)]
    first += [_report(2006, 1, w, "APEA") for w in (1005, 1006)]
    second = [_report(2007, m, 1001, "Z001") for m in (1, 2)]
    second += [_report(2007, m, 1002, "APEA") for m in (1, 2)]
    second += [_report(2007, 1, 1003, "Z001", "off"), _report(2007, 2, 1003, "Z001", "on")]
    second += [_report(2007, 1, w, "APEA") for w in (1005, 1006)]
    _write(folder / "p-2006.csv", PRODUCTION, first)
    # The second year has its columns in another order, one fewer, and one more.
    _write(folder / "p-2007.csv", ["extra", *[c for c in PRODUCTION[::-1] if c != "proyecto"]],
           second)
    return {
        "registry": readers.read_csv(spark, str(folder / "registry.csv"),
                                     _schema(REGISTRY, **TYPES)),
        "listing": readers.read_csv(spark, str(folder / "listing.csv"),
                                    _schema(LISTING, **TYPES)),
        "production": readers.read_csv_by_name(
            spark, [str(folder / "p-2006.csv"), str(folder / "p-2007.csv")],
            _schema(PRODUCTION, **TYPES)),
    }


def test_columns_are_matched_by_name(raw, rows):
    production = raw["production"]
    assert production.columns == PRODUCTION
    assert rows(production.groupBy("anio", "proyecto").count()) == [
        (2006, "none", 8), (2007, None, 8)]
    assert production.where("idempresa = 'Z001' and prod_pet = 10.5 * mes").count() == 10


def test_master(raw, rows):
    wells = well_tables.well_master(raw["registry"], raw["listing"], raw["production"])
    assert contracts.schema_differences(wells, contracts.WELL_MASTER) == []
    assert rows(wells, "idpozo", "sigla", "cuenca", "has_production") == [
        (1001, "R1001", "NEUQUINA", True), (1002, "R1002", "NEUQUINA", True),
        (1003, "R1003", "NEUQUINA", True), (1004, "R1004", "NEUQUINA", False),
        (1005, "L1005", "LIST", True), (1006, "P1006", "PROD", True)]
    assert rows(wells.where("formprod is not null"), "idpozo") == [
        (1001,), (1002,), (1003,), (1005,)]
    (geom,) = wells.where("idpozo = 1001").select("geom").first()
    assert bytes(geom) == bytes.fromhex(POINT)
    assert not {"geojson", "tipopozo", "tipoextraccion", "tipoestado"} & set(wells.columns)


def test_operator_history(raw, rows):
    history = well_tables.operator_history(raw["production"])
    assert contracts.schema_differences(history, contracts.OPERATOR_HISTORY) == []
    assert rows(history.groupBy("idpozo").count()) == [
        (1001, 1), (1002, 2), (1003, 1), (1005, 1), (1006, 1)]
    assert rows(history.where("idpozo = 1002")) == [
        (1002, "APEA", "APEA OPERATOR", dt.date(2007, 1, 1), dt.date(2007, 2, 1)),
        (1002, "Z001", "TEST S.A.", dt.date(2006, 1, 1), dt.date(2006, 2, 1))]


def test_state_events(raw, rows):
    events = well_tables.state_events(raw["production"])
    assert contracts.schema_differences(events, contracts.STATE_EVENTS) == []
    assert rows(events.groupBy("idpozo").count()) == [
        (1001, 1), (1002, 1), (1003, 3), (1005, 1), (1006, 1)]


def test_monthly_series(raw, rows):
    monthly = well_tables.monthly_series(raw["production"])
    assert contracts.schema_differences(monthly, contracts.MONTHLY_SERIES) == []
    assert rows(monthly.groupBy("idpozo").count()) == [
        (1001, 14), (1002, 14), (1003, 14), (1005, 13), (1006, 13)]
    assert rows(monthly.groupBy(F.year("fecha")).count()) == [(2006, 60), (2007, 8)]
    assert monthly.where("prod_pet is null").count() == 68 - 16


def test_publish_and_read_back(spark, raw, rows, tmp_path):
    out = str(tmp_path / "out")
    counts = publishing.publish_production(**raw, out=out)
    assert counts == {"wells": 6, "well_operator_history": 6, "well_events": 7,
                      "monthly_production": 68}
    root = versions.published_path(spark, out, "monthly_production")
    listed = files.read_manifest(spark, root)
    assert sorted({p.split("/")[0] for p in listed}) == ["year=2006", "year=2007"]
    assert files.manifest_differences(spark, root) == []
    assert readers.scan_manifest(spark, root).count() == 68
    assert readers.scan_manifest(spark, root, readers.in_years(2007, 2030)).count() == 8
    assert readers.scan_manifest(spark, root, readers.with_prefix("year=2006/")).count() == 60
    assert readers.scan_manifest(spark, root, readers.without(*listed[1:])).count() > 0
    with pytest.raises(FileNotFoundError):
        readers.scan_manifest(spark, root, readers.in_years(1900, 1901))
    leaf = readers.read_leaf(spark, root, "year=2007")
    assert leaf.columns == [f.name for f in contracts.MONTHLY_SERIES]
    for path in listed:
        at = spark.read.parquet(f"{root}/{path}").select(
            "idpozo", "fecha", F.col("_metadata.row_index").alias("i")).orderBy("i").collect()
        assert [tuple(r)[:2] for r in at] == sorted(tuple(r)[:2] for r in at)
    pruned = readers.read_partitioned(spark, root).where("year = 2007")
    assert "year=2007" in pruned._jdf.queryExecution().toString() or pruned.count() == 8
    again = publishing.publish_production(**raw, out=out)
    assert again == counts and versions.read_published(spark, out, "monthly_production").count() == 68
    assert versions.published_path(spark, out, "monthly_production") != root
    assert [p.name for p in tmp_path.iterdir()] == ["out"]


def test_nothing_is_published_when_a_rule_fails(spark, raw, tmp_path):
    out = tmp_path / "out"
    broken = raw["registry"].withColumn("geom", F.when(F.col("idpozo") == 1003, "0101").otherwise(
        F.col("geom")))
    with pytest.raises(GeometryError):
        publishing.publish_production(broken, raw["listing"], raw["production"], str(out))
    assert list(tmp_path.iterdir()) == []


@pytest.fixture(scope="module")
def built(raw):
    return {
        "wells": well_tables.well_master(
            raw["registry"], raw["listing"], raw["production"]).cache(),
        "history": well_tables.operator_history(raw["production"]).cache(),
        "events": well_tables.state_events(raw["production"]).cache(),
        "monthly": well_tables.monthly_series(raw["production"]).cache(),
    }


def test_gate_passes(built):
    assert set(production_gate(**built).enforce().values()) == {0}


@pytest.mark.parametrize("rule, table, change, error", [
    ("operator history has wells", "history", lambda df: df.withColumn("idpozo", F.col("idpozo") + 1000), ForeignKeyError),
    ("state events have wells", "events", lambda df: df.withColumn("idpozo", F.lit(9).cast("long")), ForeignKeyError),
    ("monthly series has wells", "monthly",
     lambda df: df.withColumn("idpozo", F.col("idpozo") + 1000), ForeignKeyError),
    ("monthly series key is unique", "monthly", lambda df: df.unionByName(df.limit(1)), UniqueKeyError),
    ("monthly series is complete", "monthly",
     lambda df: df.where("not (idpozo = 1001 and fecha = '2006-05-01')"),
     CompletenessError),
    ("geometry parses", "wells", lambda df: df.withColumn("geom", F.lit(b"\x01\x01")), GeometryError),
])
def test_rule_fails(built, rule, table, change, error):
    gate = production_gate(**(built | {table: change(built[table])}))
    with pytest.raises(error) as caught:
        Gate([r for r in gate.rules if r.name == rule]).enforce()
    assert isinstance(caught.value, IntegrityError)
