import datetime as dt

import pytest
from pyspark.sql import functions as F

from wellspark import contracts
from wellspark.functions.wkb import wkb_valid
from wellspark.operators import checks
from wellspark.plans import field, field_tables, publishing
from wellspark.sources import files, readers, versions, writers


@pytest.fixture
def field_data(spark):
    wells = spark.createDataFrame([(1, "F-1"), (2, "F-2"), (3, "F-3")],
                                  "npd_wellbore_code int, wellbore_name string")
    daily = spark.createDataFrame([
        (dt.date(2014, 4, 1), 1, 10.0, 1.0, 2.0, "OP"),
        (dt.date(2014, 4, 2), 1, 20.0, 2.0, 4.0, "OP"),
        (dt.date(2014, 4, 1), 2, 5.0, None, 1.0, "WI"),
        (dt.date(2014, 5, 1), 2, None, 1.0, 1.0, "WI"),
    ], "date date, npd_wellbore_code int, oil_volume double, gas_volume double, "
       "water_volume double, well_type string")
    monthly = spark.createDataFrame([
        (dt.date(2014, 4, 1), 1, 30.0, 3.0, 6.0), (dt.date(2014, 6, 1), 2, 7.0, 1.0, 1.0)],
        "date date, npd_wellbore_code int, oil_volume_sm3 double, gas_volume_sm3 double, "
        "water_volume_sm3 double")
    return wells, daily, monthly


def test_field_queries(field_data, rows):
    wells, daily, monthly = field_data
    assert rows(field.daily_totals(daily)) == [
        (dt.date(2014, 4, 1), 10.0, 1.0, 2.0), (dt.date(2014, 4, 2), 20.0, 2.0, 4.0)]
    assert rows(field.cumulative_totals(daily)) == [(30.0, 3.0, 6.0)]
    assert rows(field.cumulative_oil(daily, wells)) == [("F-1", 30.0), ("F-2", 5.0)]
    assert rows(field.production_summary(daily, wells)) == sorted([
        ("F-1", 2, 30.0, 3.0, 15.0), ("F-2", 2, 5.0, 1.0, 5.0), ("F-3", 0, None, None, None)],
        key=repr)
    assert [tuple(r) for r in field.top_days(daily, wells, 2).collect()] == [
        ("F-1", dt.date(2014, 4, 2), 20.0, 2.0), ("F-1", dt.date(2014, 4, 1), 10.0, 1.0)]
    assert rows(field.wells_of_type(daily, wells)) == [("F-2", "WI")]
    assert rows(field.yearly_production(daily)) == [("2014", 35.0, 4.0, 8.0)]
    assert rows(field.well_comparison(daily, wells, 2014)) == [
        ("F-1", 2, 30.0, 3.0), ("F-2", 1, 5.0, None)]
    assert rows(field.daily_against_monthly(daily, monthly), "npd_wellbore_code", "date",
                "oil_difference") == sorted([
        (1, dt.date(2014, 4, 1), 0.0), (2, dt.date(2014, 4, 1), None),
        (2, dt.date(2014, 5, 1), None), (2, dt.date(2014, 6, 1), None)], key=repr)
    assert rows(field.oil_statistics(daily, wells)) == [
        ("F-1", 30.0, 15.0, 15.0), ("F-2", 5.0, 5.0, 5.0)]


def test_large_dimension_takes_the_early_sum(spark, field_data, rows):
    wells, daily, _ = field_data
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(field.cumulative_oil(daily, wells)) == [("F-1", 30.0), ("F-2", 5.0)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_monthly_sheet(spark, rows):
    names = ["NPDCode", "Year", "Month", "On Stream", "Oil", "Gas", "Water", "GI", "WI"]
    raw = spark.createDataFrame([
        (None, None, None, "hrs", "Sm3", "Sm3", "Sm3", "Sm3", "Sm3"),
        ("7405", "2014", "4", "227.5", " 11142.47 ", "1597936.6", "0", None, "NULL"),
        (None, "2014", "5", "1", "1", "1", "1", "1", "1"),
    ], ", ".join(f"`{n}` string" for n in names))
    got = field_tables.field_monthly(raw)
    assert contracts.schema_differences(got, contracts.FIELD_MONTHLY) == []
    assert rows(got) == [(dt.date(2014, 4, 1), 7405, 227.5, 11142.47, 1597936.6, 0.0, None, None)]


def test_daily_sheet(spark, rows):
    columns = [*contracts.FIELD_DAILY_MAPPING, *contracts.FIELD_WELLS_MAPPING]
    one = {c: None for c in columns} | {"DATEPRD": "2014-04-07", "NPD_WELL_BORE_CODE": "7405",
                                        "BORE_OIL_VOL": "1.5", "WELL_BORE_CODE": "NO 1"}
    raw = spark.createDataFrame([one, one | {"DATEPRD": "2014-04-08"}], ", ".join(
        f"`{c}` string" for c in dict.fromkeys(columns)))
    daily, wells = field_tables.field_daily(raw), field_tables.field_wells(raw)
    assert contracts.schema_differences(daily, contracts.FIELD_DAILY) == []
    assert contracts.schema_differences(wells, contracts.FIELD_WELLS) == []
    assert rows(daily, "date", "oil_volume") == [(dt.date(2014, 4, 7), 1.5),
                                                 (dt.date(2014, 4, 8), 1.5)]
    assert wells.count() == 1


@pytest.mark.parametrize("breaks, error", [
    (lambda w, d, m: (w.where("1 = 0"), d, m), checks.CountError),
    (lambda w, d, m: (w.where("npd_wellbore_code > 1"), d, m), checks.ForeignKeyError),
    (lambda w, d, m: (w, d.withColumn("npd_wellbore_code", F.lit(None).cast("int")), m),
     checks.ForeignKeyError),
    (lambda w, d, m: (w, d.unionByName(d), m), checks.UniqueKeyError),
    (lambda w, d, m: (w, d, m.unionByName(m)), checks.UniqueKeyError),
])
def test_field_gate(field_data, breaks, error):
    assert sum(checks.field_gate(*field_data).enforce().values()) == 0
    with pytest.raises(error):
        checks.field_gate(*breaks(*field_data)).enforce()


def sheets(spark, dates=("2014-04-07", "2014-04-08 00:00:00")):
    columns = [*contracts.FIELD_DAILY_MAPPING, *contracts.FIELD_WELLS_MAPPING]
    one = {c: None for c in columns} | {"NPD_WELL_BORE_CODE": "7405", "BORE_OIL_VOL": "1.5", "WELL_BORE_CODE": "NO 1"}
    daily = spark.createDataFrame([one | {"DATEPRD": d} for d in dates], ", ".join(
        f"`{c}` string" for c in dict.fromkeys(columns)))
    names = ["NPDCode", "Year", "Month", "On Stream", "Oil", "Gas", "Water", "GI", "WI"]
    monthly = spark.createDataFrame([("7405", "2014", "4", *["1"] * 6)], ", ".join(f"`{n}` string" for n in names))
    return daily, monthly


def test_publish_field(spark, rows, tmp_path):
    out = str(tmp_path / "field")
    counts = publishing.publish_field(*sheets(spark), out)
    assert counts == {"wells": 1, "daily_production": 2, "monthly_production": 1}
    assert rows(versions.read_published(spark, out, "daily_production"), "date") == [(dt.date(2014, 4, 7),), (dt.date(2014, 4, 8),)]
    with pytest.raises(checks.UniqueKeyError):
        publishing.publish_field(*sheets(spark, ["2014-04-07"] * 2), out)
    assert versions.read_published(spark, out, "daily_production").count() == 2


def test_dates_that_are_none(spark, rows):
    daily, _ = sheets(spark, ["2014-04-07", "31-Foo", "", None, "2014-02-30"])
    assert rows(field_tables.field_daily(daily), "date") == sorted([(dt.date(2014, 4, 7),), *[(None,)] * 4], key=repr)


def test_publish_logs(spark, rows, tmp_path):
    codes = list(contracts.LITHOLOGY_LABELS)
    logs = spark.createDataFrame([("W", float(i), codes[i % len(codes)], "train" if i % 2 else "test") for i in range(60)],
                                 f"WELL string, DEPTH_MD double, {contracts.LITHOLOGY} long, dataset string")
    logs = logs.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in contracts.WELL_LOGS if f.name not in logs.columns])
    out = str(tmp_path / "logs")
    assert publishing.publish_logs(logs, out) == {"logs": 60}
    assert files.manifest_differences(spark, versions.published_path(spark, out, "logs")) == []
    for broken in (logs.unionByName(logs), logs.withColumn(contracts.LITHOLOGY, F.lit(1).cast("long"))):
        with pytest.raises((checks.UniqueKeyError, checks.ContractError)):
            publishing.publish_logs(broken, out)


def test_contract_version_and_labels(spark, field_data):
    wells, _, _ = field_data
    with pytest.raises(checks.ContractError):
        checks.check_contract(wells, contracts.FIELD_WELLS)
    version = spark.createDataFrame([("2.0.0",)], "v string")
    checks.Gate([checks.check_version("v", version, "v", "2.0.0")]).enforce()
    with pytest.raises(checks.VersionError):
        checks.Gate([checks.check_version("v", version, "v", "2.0.1")]).enforce()
    codes = spark.createDataFrame([(c,) for c in contracts.LITHOLOGY_LABELS], "c int")
    labels = contracts.LITHOLOGY_LABELS
    checks.Gate([checks.check_label_mapping("l", codes, "c", labels)]).enforce()
    for broken in (codes.where("c <> 65000"), codes.unionByName(codes.limit(1).withColumn(
            "c", F.lit(1)))):
        with pytest.raises(checks.ContractError):
            checks.Gate([checks.check_label_mapping("l", broken, "c", labels)]).enforce()


POINT = "0101000000" + "00" * 16


@pytest.mark.parametrize("text, valid", [
    (POINT, True), ("0101000020E6100000" + "00" * 16, True), ("0000000001" + "00" * 16, True),
    ("0101", False), (POINT[:-2], False), (POINT + "00", False), ("0201000000" + "00" * 16, False),
    ("0163000000" + "00" * 16, False), ("01E9030000" + "00" * 24, True),
    ("010200000002000000" + "00" * 32, True), ("010200000002000000" + "00" * 16, False),
    ("01030000000100000004000000" + "00" * 64, True), ("010300000001000000FFFFFFFF", False),
    ("010400000001000000" + POINT, True), ("010400000002000000" + POINT, False), ("", False),
])
def test_wkb(spark, text, valid):
    df = spark.createDataFrame([(bytearray.fromhex(text),), (None,)], "g binary")
    assert [r[0] for r in df.select(wkb_valid(F.col("g"))).collect()] == [valid, None]


def test_wkb_against_the_reader_of_all_types(spark):
    """Random geometries of every kind, order and dimension, whole, cut short, too long and with odd counts."""
    import random
    import struct

    from wellspark.functions import wkb

    rng, made = random.Random(4), []
    for _ in range(600):
        order = rng.choice("<>")
        code, dims, srid = rng.choice([1, 2, 3, 3, 4, 9]), 2, b""
        if rng.random() < 0.3:
            level = rng.choice([1, 2, 3, 4])
            code, dims = code + 1000 * level, 2 + (0, 1, 1, 2, 0)[level]
        elif rng.random() < 0.4:
            code, dims = code | wkb.Z_FLAG, 3
        if rng.random() < 0.3:
            code, srid = code | wkb.SRID_FLAG, b"\1\2\3\4"

        def n(x):
            return struct.pack(order + "I", x)

        body, kind = b"", code & 0xFFFF
        if kind % 1000 == 1:
            body = bytes(8 * dims)
        elif kind % 1000 == 2:
            k = rng.randint(0, 4)
            body = n(k) + bytes(8 * dims * k)
        elif kind % 1000 == 3:
            rings = [rng.randint(0, 5) for _ in range(rng.randint(0, 3))]
            body = n(len(rings) + rng.choice([0, 0, 0, 1, 2**31])) + b"".join(n(r) + bytes(8 * dims * r) for r in rings)
        data = bytes([order == "<"]) + n(code) + srid + body
        made.append(rng.choice([data, data, data, data[:-1], data + b"\0", data[:rng.randint(0, len(data))], b"\2" + data[1:]]))
    got = spark.createDataFrame([(i, bytearray(d)) for i, d in enumerate(made)], "i int, g binary").select("i", wkb_valid(F.col("g")).alias("ok")).collect()
    want = {i: wkb._is_valid(d) for i, d in enumerate(made)}
    assert {r["i"]: r["ok"] for r in got} == want and 100 < sum(want.values()) < 500


def test_publish_keeps_the_old_version_on_failure(spark, rows, tmp_path):
    target = str(tmp_path / "t")
    first = spark.range(5)
    assert writers.publish(first, target, lambda df, p: writers.write_table(df, p, ["id"])) == 5
    with pytest.raises(writers.RowCountError):
        writers.publish(spark.range(9), target,
                        lambda df, p: writers.write_table(df.limit(3), p, ["id"]))
    assert spark.read.parquet(target).count() == 5
    assert writers.publish(spark.range(9), target,
                           lambda df, p: writers.write_table(df, p, ["id"])) == 9
    assert spark.read.parquet(target).count() == 9


def test_hot_partition_is_spread_over_files(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.range(3000).selectExpr("1 as year", "1 as well", "id as at", "uuid() as x")
    writers.write_partitioned(df, root, ["year"], ["well", "at"], files=6)
    listed = files.list_files(spark, root)
    assert listed.count() == 6
    spans = spark.read.parquet(root).groupBy(F.col("_metadata.file_name").alias("f")).agg(
        F.min("at").alias("lo"), F.max("at").alias("hi")).orderBy("lo").collect()
    assert all(a["hi"] < b["lo"] for a, b in zip(spans, spans[1:]))
    assert files.oversized(listed, 1).count() == 6 and files.oversized(listed).count() == 0


def test_manifest_notices_strangers(spark, tmp_path):
    root = str(tmp_path / "t")
    spark.range(3).write.parquet(root)
    assert len(files.write_manifest(spark, root)) >= 1
    assert files.manifest_differences(spark, root) == []
    spark.range(1).coalesce(1).write.mode("append").parquet(root)
    assert len(files.manifest_differences(spark, root)) == 1
    assert readers.scan_manifest(spark, root).count() == 3


def test_year_filter_prunes_folders(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.range(100).selectExpr("cast(2000 + id % 4 as int) as year", "id")
    df.write.partitionBy("year").parquet(root)
    plan = readers.read_partitioned(spark, root).where("year = 2001").select(
        "id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_schema_table(spark, rows):
    table = contracts.schema_table(spark.range(1).selectExpr("id", "cast(id as string) as s"),
                                   ["id"], ("s",))
    assert rows(table) == [(0, "id", "bigint", False, True, False),
                           (1, "s", "string", False, False, True)]
