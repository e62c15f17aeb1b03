"""Labelled sensor windows: files on disk, catalog, rules, publishing and parity."""

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from wellspark import contracts
from wellspark.operators import catalog as cat
from wellspark.operators import parity
from wellspark.operators.checks import (
    CadenceError,
    CountError,
    DomainError,
    ForeignKeyError,
    Gate,
    UniqueKeyError,
    sensor_gate,
)
from wellspark.plans import publishing, sensors
from wellspark.sources import files, readers, versions

FILES = {
    (0, "WELL-00001_20120101000000"): [0] * 10,
    (1, "WELL-00002_20120102000000"): [None] * 3 + [0] * 4 + [101] * 2 + [1] * 3,
    (3, "WELL-00003_20120103000000"): [3] * 8,
    (8, "SIMULATED_00001"): [0, 0, 108, 108, 8],
    (9, "DRAWN_00001"): [109] * 3 + [9] * 3,
    (4, "DRAWN_00001"): [4] * 6,
    (0, "WELL-00042_20120104000000"): [0],
}
BASE = "https://example.org/x"


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("staging") / "dataset"
    for (cls, name), labels in FILES.items():
        (root / str(cls)).mkdir(parents=True, exist_ok=True)
        n = len(labels)
        columns = {"timestamp": pa.array(
            [dt.datetime(2012, 1, 1) + dt.timedelta(seconds=i) for i in range(n)],
            pa.timestamp("us"))}
        # One file lacks most sensors: they are NULL in the view.
        present = contracts.SENSORS if cls != 9 else ["P-PDG"]
        columns |= {s: pa.array([1e7 + i if s == "P-PDG" else 1.0 for i in range(n)], pa.float64())
                    for s in present}
        columns |= {"class": pa.array(labels, pa.int32()), "state": pa.array([0] * n, pa.int32())}
        pq.write_table(pa.table(columns), root / str(cls) / f"{name}.parquet")
    return readers.read_parquet_with_path(spark, f"{root}/*/*.parquet", by_name=True)


@pytest.fixture(scope="module")
def specs(spark):
    return spark.createDataFrame(
        [(i, f"N{i}", f"Event {i}", i not in (0, 3, 4)) for i in range(10)],
        "event_class int, name string, description string, has_transient boolean")


@pytest.fixture(scope="module")
def built(raw, specs):
    lookup = cat.event_lookup(specs).cache()
    catalog = cat.instance_catalog(raw, lookup, BASE).cache()
    return {"lookup": lookup, "catalog": catalog, "wells": cat.real_wells(catalog).cache(),
            "observations": cat.observations(raw).cache()}


def test_lookup(built, rows):
    assert rows(built["lookup"].where("event_class in (3, 8)"), "event_class", "transient_code",
                "has_normal_prefix") == [(3, None, False), (8, 108, True)]


def test_catalog(built, rows):
    assert contracts.schema_differences(built["catalog"], contracts.INSTANCES) == []
    got = {(r["event_class"], r["instance_id"]): r for r in built["catalog"].collect()}
    assert len(got) == len(FILES)
    buckets = {k: (r["n_rows_warmup_null"], r["n_rows_normal"], r["n_rows_transient"],
                   r["n_rows_steady"]) for k, r in got.items()}
    assert buckets[(0, "WELL-00001_20120101000000")] == (0, 0, None, 10)
    assert buckets[(1, "WELL-00002_20120102000000")] == (3, 4, 2, 3)
    assert buckets[(3, "WELL-00003_20120103000000")] == (0, 0, None, 8)
    assert buckets[(8, "SIMULATED_00001")] == (0, 2, 2, 1)
    assert buckets[(9, "DRAWN_00001")] == (0, 0, 3, 3)
    first = got[(1, "WELL-00002_20120102000000")]
    assert (first["well_kind"], first["well_id"], first["duration_s"]) == ("real", 2, 11)
    assert first["source_file"] == "WELL-00002_20120102000000.parquet"
    assert first["source_url"] == \
        f"{BASE}/observations/event_class=1/instance=WELL-00002_20120102000000"
    assert got[(8, "SIMULATED_00001")]["well_id"] is None


def test_unknown_prefix_and_place(spark, rows):
    df = spark.createDataFrame([("/a/dataset/7/OTHER_1.parquet",), ("/a/x/7/WELL-0x_1.parquet",)],
                               "file_path string")
    assert rows(cat.with_provenance(df)) == sorted([
        ("OTHER_1", "OTHER_1.parquet", 7, None, None),
        ("WELL-0x_1", "WELL-0x_1.parquet", None, "real", None)], key=repr)


def test_wells_and_view(built, rows):
    assert rows(built["wells"], "well_id", "n_instances", "n_observations") == [
        (1, 1, 10), (2, 1, 12), (3, 1, 8), (42, 1, 1)]
    view = built["observations"]
    assert set(cat.sensor_columns(view)) == set(contracts.SENSORS)
    assert view.where("event_class = 9 and `T-TPT` is null").count() == 6


def test_empty_input_raises(raw):
    with pytest.raises(cat.NoInstances):
        cat.require_instances(raw.where("1 = 0"))


def test_queries(built, rows):
    catalog = built["catalog"]
    assert rows(sensors.corpus_balance(catalog, built["lookup"]), "event_class", "n_instances",
                "n_observations", "n_observations_steady")[0] == (0, 2, 11, 11)
    assert rows(sensors.real_instances(catalog, 0), "well_id") == [(1,), (42,)]
    assert rows(sensors.well_footprint(built["wells"], catalog), "well_id",
                "distinct_event_classes") == [(1, 1), (2, 1), (3, 1), (42, 1)]
    folds = {r["instance_id"]: (r["fold"], r["role"])
             for r in sensors.instance_folds(catalog, 2).collect()}
    assert folds["WELL-00042_20120104000000"] == (0, "test")
    assert folds["SIMULATED_00001"] == (None, "train")


def gate(built, **changes):
    frames = built | changes
    return sensor_gate(frames["lookup"], frames["catalog"], frames["wells"],
                       frames["observations"], 10, 4)


def test_gate_passes(built):
    assert set(gate(built).enforce().values()) == {0}


# rule -> (table, change that breaks it, error)
CHANGES = {
    "event classes are all there": (
        "lookup", lambda df: df.where("event_class < 9"), CountError),
    "event class is unique": (
        "lookup", lambda df: df.unionByName(df.where("event_class = 2")), UniqueKeyError),
    "classes without transient phase": (
        "lookup", lambda df: df.withColumn("has_transient", F.lit(True)), DomainError),
    "transient codes are consistent": (
        "lookup", lambda df: df.withColumn("transient_code", F.lit(7)), DomainError),
    "instance key is unique": (
        "catalog", lambda df: df.unionByName(df.limit(1)), UniqueKeyError),
    "instances have event classes": (
        "catalog", lambda df: df.withColumn("event_class", F.lit(77)), ForeignKeyError),
    "well kind and id agree": (
        "catalog", lambda df: df.withColumn("well_kind", F.lit(None).cast("string")),
        DomainError),
    "transient counts are NULL by design only": (
        "catalog", lambda df: df.withColumn("n_rows_transient", F.lit(0)), DomainError),
    "label buckets sum to rows": (
        "catalog", lambda df: df.withColumn("n_rows", F.col("n_rows") + 1), DomainError),
    "instances have wells": ("wells", lambda df: df.where("well_id <> 1"), ForeignKeyError),
    "wells come from real instances": (
        "wells", lambda df: df.withColumn("well_id", F.col("well_id") + 100), ForeignKeyError),
    "real wells are all there": ("wells", lambda df: df.where("well_id <> 1"), CountError),
    "observations have instances": (
        "observations", lambda df: df.withColumn("instance_id", F.lit("gone")), ForeignKeyError),
    "observations per instance match the catalog": (
        "observations", lambda df: df.where("event_class <> 3"), CountError),
    "observations are one second apart": (
        "observations", lambda df: df.where("not (event_class = 3 and `P-PDG` = 1e7 + 5)"),
        CadenceError),
    "labels are in their domain": (
        "observations", lambda df: df.withColumn("class", F.when(
            F.col("event_class") == 1, 55).otherwise(F.col("class"))), DomainError),
    "steady-only classes hold no other label": (
        "observations", lambda df: df.withColumn("class", F.when(
            F.col("event_class") == 3, 0).otherwise(F.col("class"))), DomainError),
}


def test_every_rule_has_a_case(built):
    assert {r.name for r in gate(built).rules} == set(CHANGES)


@pytest.mark.parametrize("rule", CHANGES)
def test_rule_fails(built, rule):
    table, change, error = CHANGES[rule]
    rules = gate(built, **{table: change(built[table])}).rules
    with pytest.raises(error):
        Gate([r for r in rules if r.name == rule]).enforce()


def test_publish(spark, raw, specs, rows, tmp_path):
    out = str(tmp_path / "out")
    counts = publishing.publish_sensors(raw, specs, out, None, 10, 4)
    catalog = versions.read_published(spark, out, "instances")
    for instance in catalog.groupBy("instance_id").agg(F.sum("n_rows").alias("n_rows")).collect():
        one = readers.instance_rows(catalog, instance["instance_id"])
        assert one.select("instance_id").distinct().count() == 1 and one.count() == instance["n_rows"]
    with pytest.raises(FileNotFoundError):
        readers.instance_rows(catalog, "none such")
    assert counts == {"event_types": 10, "instances": 7, "wells": 4, "observations": 48}
    root = versions.published_path(spark, out, "observations")
    assert files.manifest_differences(spark, root) == []
    assert {p.split("/")[0] for p in files.read_manifest(spark, root)} == {
        f"event_class={c}" for c in (0, 1, 3, 4, 8, 9)}
    one = readers.scan_manifest(spark, root, readers.with_prefix("event_class=1/"))
    assert rows(one.select("instance_id", "well_id", "well_kind").distinct()) == [
        ("WELL-00002_20120102000000", 2, "real")]
    summary = files.export_summary(spark, {"wells": versions.published_path(spark, out, "wells")}).first()
    assert summary["rows"] == 4 and summary["files"] >= 1 and summary["megabytes"] >= 0


def test_own_folder_per_instance(spark, built, tmp_path):
    from wellspark.sources.writers import write_observations

    root = str(tmp_path / "observations")
    listed = write_observations(built["observations"], root, own_folder=True)
    assert len({p.rsplit("/", 1)[0] for p in listed}) == len(FILES)
    assert spark.read.parquet(root).count() == 48


def test_publish_aborts(spark, raw, specs, tmp_path):
    with pytest.raises(CountError):
        publishing.publish_sensors(raw, specs, str(tmp_path / "out"), BASE, 10, 99)
    assert list(tmp_path.iterdir()) == []


MUTATIONS = {
    "nothing": (lambda df: df, set()),
    "one cell": (lambda df: df.withColumn("P-PDG", F.when(
        (F.col("event_class") == 1) & (F.col("`P-PDG`") == 1e7 + 4), F.col("`P-PDG`") + 1)
        .otherwise(F.col("`P-PDG`"))),
        {"sensor content", "sensor content per class", "whole rows per class"}),
    "one row gone": (lambda df: df.where("not (event_class = 3 and `P-PDG` = 1e7 + 7)"),
                     {"rows per class", "rows per instance", "label distribution",
                      "state distribution", "sensor content", "sensor content per class",
                      "time spans", "whole rows per class"}),
    "row moved": (lambda df: df.withColumn("instance_id", F.when(
        (F.col("instance_id") == "WELL-00042_20120104000000"), "WELL-00001_20120101000000")
        .otherwise(F.col("instance_id"))),
        {"rows per instance", "time spans", "whole rows per class"}),
    "label flipped": (lambda df: df.withColumn("class", F.when(
        F.col("class") == 108, 8).otherwise(F.col("class"))),
        {"label distribution", "whole rows per class"}),
    "equal edits in pairs": (lambda df: df.withColumn("P-TPT", F.when(
        (F.col("event_class") == 3) & (F.col("`P-PDG`") < 1e7 + 2), 2.0)
        .otherwise(F.col("`P-TPT`"))),
        {"sensor content", "sensor content per class", "whole rows per class"}),
    "cells swapped": (lambda df: df.withColumn("P-PDG", F.when(
        F.col("event_class") == 3, 2e7 + 7 - F.col("`P-PDG`")).otherwise(F.col("`P-PDG`"))),
        {"whole rows per class"}),
}


@pytest.mark.parametrize("name", MUTATIONS)
def test_parity_finds(built, name):
    change, expected = MUTATIONS[name]
    source = built["observations"]
    few = [c for c in source.columns if c not in contracts.SENSORS or c in (
        "P-PDG", "P-TPT", "T-TPT")]
    source, published = (df.select(*[f"`{c}`" for c in few]) for df in (source, change(source)))
    report = parity.parity_report(source, built["catalog"], built["wells"], published,
                                  cat.sensor_columns(source), 4)
    found = {r["check"] for r in report.collect() if r["differences"]}
    assert found == expected
    if expected:
        with pytest.raises(parity.ParityError):
            parity.enforce_parity(report)


def test_parity_of_wells(built):
    for pin, ok in ((None, True), (4, True), (5, False)):
        report = parity.parity_report(built["observations"], built["catalog"], built["wells"],
                                      built["observations"], ["P-PDG"], pin)
        found = {r["check"] for r in report.collect() if r["differences"]}
        assert found == (set() if ok else {"real wells"})
