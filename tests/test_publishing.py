"""Versions of a set, row counts on the way, file plans, zone maps, and what a reader skips."""

import datetime as dt
import gzip

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspark.operators import checks
from wellspark.operators.checks import CountError
from wellspark.operators.contract_rows import contract_violations
from wellspark.plans.publishing import publish_together
from wellspark.sources import files, planning, readers, versions, writers, zones


def tables(spark, n):
    def write(df, path):
        writers.write_table(df, path, ["id"])

    return {name: (spark.range(n + i).withColumn("version", F.lit(n)), write) for i, name in enumerate("abc")}


def seen(spark, out):
    return {name: df.agg(F.max("version"), F.count(F.lit(1))).first()[:] for name, df in versions.read_set(spark, out).items()}


OLD = {"a": (5, 5), "b": (5, 6), "c": (5, 7)}


def test_a_failure_in_the_middle_leaves_the_old_set(spark, tmp_path):
    out = str(tmp_path / "set")
    assert publish_together(spark, tables(spark, 5), out, lambda written: None) == {"a": 5, "b": 6, "c": 7}
    assert seen(spark, out) == OLD

    def broken(df, path):
        writers.write_table(df, path, ["id"])
        raise OSError("the second of three")

    new = tables(spark, 9)
    with pytest.raises(OSError):
        publish_together(spark, new | {"b": (new["b"][0], broken)}, out, lambda written: None)
    assert seen(spark, out) == OLD and len(files.list_names(spark, f"{out}/{versions.VERSIONS}")) == 1

    def refuses(written):
        raise ValueError(sorted(written))

    with pytest.raises(ValueError):
        publish_together(spark, new, out, refuses)
    assert seen(spark, out) == OLD


def test_a_failure_of_the_commit_leaves_the_old_set(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "set")
    publish_together(spark, tables(spark, 5), out, lambda written: None)
    monkeypatch.setattr(versions, "write_text", lambda *a, **k: (_ for _ in ()).throw(OSError("no space")))
    with pytest.raises(OSError):
        publish_together(spark, tables(spark, 9), out, lambda written: None)
    assert seen(spark, out) == OLD


def test_of_two_publishings_one_is_refused(spark, tmp_path):
    out = str(tmp_path / "set")
    publish_together(spark, tables(spark, 5), out, lambda written: None)

    def meanwhile(written):
        publish_together(spark, tables(spark, 7), out, lambda written: None)

    with pytest.raises(versions.ConflictError):
        publish_together(spark, tables(spark, 9), out, meanwhile)
    assert seen(spark, out)["a"] == (7, 7)


def test_tables_that_are_not_written_stay_and_old_versions_can_be_read(spark, tmp_path):
    out = str(tmp_path / "set")
    publish_together(spark, tables(spark, 5), out, lambda written: None)
    publish_together(spark, {"b": tables(spark, 9)["b"]}, out, lambda written: None)
    assert seen(spark, out) == OLD | {"b": (9, 10)}
    assert versions.read_published(spark, out, "b", 1).count() == 6
    first = versions.read_commit(spark, out, 1)["b"]["path"]
    assert versions.expire(spark, out, 1) == [first] and versions.commit_numbers(spark, out) == [2]
    assert not files.exists(spark, f"{out}/{first}")
    assert seen(spark, out) == OLD | {"b": (9, 10)}
    with pytest.raises(FileNotFoundError):
        versions.published_path(spark, out, "none such")
    with pytest.raises(FileNotFoundError):
        versions.read_commit(spark, str(tmp_path / "nothing"))


def test_lost_rows_are_noticed(spark, tmp_path):
    def loses(df, path):
        writers.write_table(df.where("id > 0"), path, ["id"])

    with pytest.raises(CountError):
        publish_together(spark, {"a": (spark.range(9), loses)}, str(tmp_path / "set"), lambda written: None)


def counting(spark, df):
    """``df`` and a counter of its rows as they are computed."""
    n = spark.sparkContext.accumulator(0)

    def through(batches):
        for batch in batches:
            n.add(batch.num_rows)
            yield batch

    return df.mapInArrow(through, df.schema), n


@pytest.mark.parametrize("write", [
    lambda df, path: writers.write_table(df, path, ["well", "at"]),
    lambda df, path: writers.write_partitioned(df, path, ["year"], ["well", "at"], rows_per_file=500, cells=KNOWN[0])])
def test_publish_runs_the_input_once(spark, tmp_path, write):
    df = spark.range(4000).selectExpr("cast(id % 2 as int) as year", "cast(id % 10 as int) as well", "id as at")
    KNOWN[:] = [planning.count_cells(df, ["year"], "well", "at")]
    once, n = counting(spark, df)
    assert writers.publish(once, str(tmp_path / "t"), write) == 4000 and n.value == 4000


KNOWN = []


def spans(spark, root, *columns):
    order = F.struct(*columns)
    return spark.read.parquet(root).groupBy(F.col("_metadata.file_path").alias("f")).agg(
        F.min(order).alias("lo"), F.max(order).alias("hi"), F.count(F.lit(1)).alias("n")).orderBy("lo").collect()


def test_files_are_sorted_and_bounded(spark, tmp_path):
    """One entity holds a third; null entities, null times and a null year are rows like others."""
    day = dt.date(2001, 1, 1)
    rows = [(7, day + dt.timedelta(days=i % 4000), i) for i in range(3000)]
    rows += [(i % 900 * 5, day + dt.timedelta(days=i % 900), i) for i in range(6000)]
    rows += [(None, day, -1)] * 40 + [(3, None, -2)] * 40
    df = spark.createDataFrame(rows, "well int, at date, x int")
    root = str(tmp_path / "t")
    assert writers.write_by_year(df, root, "at", "well", rows_per_file=300) == files.read_manifest(spark, root)
    back = spark.read.parquet(root)
    assert sorted(map(repr, back.select("well", "at", "x").collect())) == sorted(map(repr, df.collect()))
    for year in [f"year={y}" for y in range(2001, 2013)] + ["year=__HIVE_DEFAULT_PARTITION__"]:
        if files.exists(spark, f"{root}/{year}"):
            found = spans(spark, f"{root}/{year}", F.coalesce("well", F.lit(-1)), F.coalesce("at", F.lit(day)))
            assert all(r["n"] < 600 for r in found)
            assert all(a["hi"] <= b["lo"] for a, b in zip(found, found[1:]))
    hot = back.where("well = 7").select("_metadata.file_path").distinct().count()
    assert hot >= 10


def test_a_hot_instance_is_divided_by_its_catalog(spark, tmp_path):
    start = dt.datetime(2020, 1, 1)
    sizes = {"WELL-1_a": 9000, "WELL-1_b": 50, "WELL-2_c": 70}
    df = spark.createDataFrame([(i, 1, start + dt.timedelta(seconds=s)) for i, n in sizes.items() for s in range(n)],
                               "instance_id string, event_class int, timestamp timestamp")
    catalog = df.groupBy("instance_id", "event_class").agg(
        F.min("timestamp").alias("start_ts"), F.max("timestamp").alias("end_ts"), F.count(F.lit(1)).alias("n_rows"))
    once, n = counting(spark, df)
    root = str(tmp_path / "t")
    listed = writers.write_observations(once, root, instances=catalog, rows_per_file=1000)
    assert n.value == 9120
    folders = [p.rsplit("/", 1)[0] for p in listed]
    assert {f: folders.count(f) for f in folders} == {
        "event_class=1/instance=WELL-1_a": 9, "event_class=1/instance=WELL-1_b": 1, "event_class=1/instance=WELL-2_c": 1}
    found = spans(spark, f"{root}/event_class=1/instance=WELL-1_a", "timestamp")
    assert max(r["n"] for r in found) <= 1001 and all(a["hi"] < b["lo"] for a, b in zip(found, found[1:]))


def test_rows_that_the_catalog_does_not_have_are_written_too(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, dt.datetime(2020, 1, 1)), ("b", 2, None)], "instance_id string, event_class int, timestamp timestamp")
    catalog = spark.createDataFrame([("a", 1, dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 1), 1)],
                                    "instance_id string, event_class int, start_ts timestamp, end_ts timestamp, n_rows long")
    root = str(tmp_path / "t")
    writers.write_observations(df, root, instances=catalog)
    assert spark.read.parquet(root).count() == 2
    writers.write_partitioned(df.limit(0), str(tmp_path / "none"), ["event_class"], ["instance_id", "timestamp"])


def test_zone_map_opens_only_what_covers(spark, rows, tmp_path):
    root = str(tmp_path / "t")
    df = spark.range(20_000).selectExpr("cast(id % 1000 as int) as well", "date_add(date'2000-01-01', cast(id / 10 as int)) as at", "id as x")
    writers.write_by_year(df, root, "at", "well", rows_per_file=300)
    every = spark.read.parquet(root).inputFiles()
    known = zones.read_zones(spark, root)
    assert known.count() == len(every) and known.agg(F.sum("rows")).first()[0] == 20_000
    assert set(files.read_manifest(spark, root)) == {r["path"] for r in known.collect()}
    one = zones.scan_zones(spark, root, "well", "at", (17, 17))
    assert rows(one, "x") == rows(df.where("well = 17"), "x")
    assert len(one.inputFiles()) < len(every) / 3
    span = (dt.date(2002, 2, 1), dt.date(2002, 2, 9))
    both = zones.scan_zones(spark, root, "well", "at", (17, 30), span)
    assert rows(both, "x") == rows(df.where(f"well between 17 and 30 and at between '{span[0]}' and '{span[1]}'"), "x")
    assert len(both.inputFiles()) <= 2
    assert zones.scan_zones(spark, root, "well", "at", (5000, None)).count() == 0
    assert zones.scan_zones(spark, root, "well", "at", (None, None)).count() == 20_000


def rows_read(df):
    """Rows that the scans of a query gave out, after row groups were left out."""
    query = df._jdf.queryExecution()
    query.toRdd().count()
    leaves = query.executedPlan().executedPlan().collectLeaves() if "AdaptiveSparkPlan" in query.executedPlan().nodeName() else query.executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_readers_skip_row_groups(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.range(60_000).selectExpr("cast(id / 100 as int) as well", "id as at", "hash(id) as x", "cast(hash(id, 7) % 5000 * 2 as int) as code", "1 as year")
    writers.write_partitioned(df, root, ["year"], ["well", "at"], row_group=60_000, lookup={"code": 10_000})
    (file,) = files.list_files(spark, root).collect()
    import pyarrow.parquet as pq

    meta = pq.ParquetFile(file["path"].removeprefix("file:")).metadata
    assert meta.num_row_groups >= 10
    table = spark.read.parquet(root)
    for well in (0, 250, 599):
        one = readers.one_entity(table, "well", well)
        assert one.count() == 100 and rows_read(one) < 6000
    # Odd codes are inside the range of every row group; only the Bloom filter can tell.
    assert rows_read(table.where("code = 4001")) == 0
    assert rows_read(table.where("x is not null")) == 60_000


def test_summary_has_the_rows_counted_on_the_way(spark, rows, tmp_path):
    out = str(tmp_path / "set")
    publish_together(spark, tables(spark, 5), out, lambda written: None)
    summary = versions.set_summary(spark, out)
    assert rows(summary, "table_name", "rows") == [("a", 5), ("b", 6), ("c", 7)]
    assert summary.where("files < 1 or megabytes < 0 or updated is null").count() == 0


CONTRACT = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("n", T.IntegerType()),
                         T.StructField("day", T.DateType()), T.StructField("gone", T.StringType())])


def test_contract_counts_cells_nulls_and_keys(spark, rows):
    data = [(1, 1.0, "2020-01-01", 1), (1, 2.5, "2020-13-01", 1), (None, 3e12, None, 1), (None, None, "x", 1), (2, float("nan"), "2020-02-29", 1)]
    df = spark.createDataFrame(data, "id long, n double, day string, extra int")
    want = [("id", "null", 2), ("n", "not int", 3), ("day", "not date", 2), ("gone", "missing", 5), ("extra", "unexpected", 5)]
    assert rows(contract_violations(df, CONTRACT)) == sorted(want, key=repr)
    assert rows(contract_violations(df, CONTRACT, ["id"])) == sorted([*want, ("id", "repeated key", 4)], key=repr)
    assert {r["violations"] for r in contract_violations(df.limit(0), CONTRACT, ["id"]).collect()} == {0}
    exact = df.select("id").where("id = 2")
    assert checks.Gate([checks.check_contract_rows("rows", exact, T.StructType(CONTRACT.fields[:1]), ["id"])]).enforce() == {"rows": 0}
    with pytest.raises(checks.ContractError):
        checks.Gate([checks.check_contract_rows("rows", df, CONTRACT, ["id"])]).enforce()


def test_contract_is_one_pass(spark):
    df = spark.range(10).selectExpr("id % 3 as id", "id as n")
    plan = contract_violations(df, CONTRACT, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and plan.count("Exchange hashpartitioning") == 1


def bytes_read(spark):
    return spark._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics().get("file").getLong("bytesRead") or 0


def test_headers_cost_a_block_per_file(spark, tmp_path):
    """Five files of a megabyte; and a header line longer than a block, a packed file, a byte order mark."""
    for i in range(5):
        (tmp_path / f"{i} x.csv").write_text("a,b\n" + f"{i},1\n" * 250_000)
    before = bytes_read(spark)
    lines = files.first_lines(spark, [r["path"] for r in spark.read.format("binaryFile").load(str(tmp_path)).select("path").collect()])
    assert set(lines.values()) == {"a,b"} and len(lines) == 5
    assert bytes_read(spark) - before <= 5 * 2 * files.FIRST_BLOCK
    long = ",".join(f"column{i}" for i in range(9000))
    (tmp_path / "long.csv").write_text(long + "\n1\n")
    (tmp_path / "packed.csv.gz").write_bytes(gzip.compress(b"b,a\r\n2,1\r\n"))
    (tmp_path / "marked.csv").write_bytes(b"\xef\xbb\xbfonly")
    paths = [f"file:{tmp_path}/{n}" for n in ("long.csv", "packed.csv.gz", "marked.csv")]
    assert files.first_lines(spark, paths) == dict(zip(paths, (long, "b,a", "only")))


def test_csv_by_name_of_odd_files(spark, rows, tmp_path):
    (tmp_path / "one file.csv").write_text('"b",a\n2,1\n')
    (tmp_path / "two.csv").write_text("a\n3\n")
    (tmp_path / "none.csv").write_text("")
    (tmp_path / "packed.csv.gz").write_bytes(gzip.compress(b"c,b,a\n9,8,7\n"))
    schema = T.StructType([T.StructField(n, T.IntegerType()) for n in "ab"])
    assert rows(readers.read_csv_by_name(spark, [str(tmp_path)], schema)) == [(1, 2), (3, None), (7, 8)]


def test_many_instances_share_files_and_are_found_by_the_zone_map(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "FOLDERS", 20)
    df = spark.range(900).selectExpr("concat('WELL-', id % 90) as instance_id", "cast(id % 3 as int) as event_class",
                                     "timestamp_seconds(id) as timestamp", "id as x")
    root = str(tmp_path / "observations")
    listed = writers.write_observations(df, root)
    assert {p.split("/")[0] for p in listed} == {f"event_class={c}" for c in range(3)} and len(listed) <= 6
    assert rows(spark.read.parquet(root), "x", "instance_id") == rows(df, "x", "instance_id")
    catalog = df.select("instance_id", "event_class", F.format_string(f"{root}/event_class=%d/instance=%s", "event_class", "instance_id").alias("source_url"))
    assert rows(readers.instance_rows(catalog, "WELL-7"), "x") == rows(df.where("instance_id = 'WELL-7'"), "x")
    few = str(tmp_path / "few")
    assert len({p.rsplit("/", 1)[0] for p in writers.write_observations(df.where("id % 90 < 20"), few)}) == 20


def test_small_files_are_written_many_to_a_task(spark, tmp_path):
    df = spark.range(2500).selectExpr("cast(id % 2 as int) as year", "cast(id % 1250 as int) as well", "id as at")
    cells = planning.count_cells(df, ["year"], "well", "at")
    with planning.planned(cells, ["year"], 10) as plan:
        assert plan.tasks <= planning.MOST_TASKS
    root = str(tmp_path / "t")
    writers.write_partitioned(df, root, ["year"], ["well", "at"], rows_per_file=10, cells=cells)
    for year in (0, 1):
        found = spans(spark, f"{root}/year={year}", "well", "at")
        assert sum(r["n"] for r in found) == 1250 and max(r["n"] for r in found) <= 10
        assert all(a["hi"] < b["lo"] for a, b in zip(found, found[1:]))


def test_a_large_partition_folder_is_divided_among_tasks(spark, tmp_path):
    df = spark.range(4000, numPartitions=8).selectExpr("cast(id % 4000 = 0 as int) as part", "id", "uuid() as x")
    few, many = str(tmp_path / "few"), str(tmp_path / "many")
    writers.write_folders(df, few, "part")
    assert len(files.write_manifest(spark, few)) == 2
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "20k")
    try:
        writers.write_folders(df, many, "part")
    finally:
        spark.conf.unset(size)
    listed = files.write_manifest(spark, many)
    assert len([p for p in listed if p.startswith("part=0/")]) > 3 and spark.read.parquet(many).count() == 4000


@pytest.mark.parametrize("name", ["oversized_files", "manifest_matches_files"])
def test_folders_of_several_files_count_once(spark, tmp_path, name):
    from wellspark.queries import QUERIES

    spark.range(20_000, numPartitions=8).selectExpr("id as l_orderkey", "uuid() as x", "uuid() as y", "make_date(cast(1997 + id % 3 as int), 5, 1) as l_shipdate").write.parquet(
        str(tmp_path / "lineitem.parquet"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "50k")
    try:
        got = QUERIES[name](spark, str(tmp_path)).first()
    finally:
        spark.conf.unset(size)
    assert (got["n_oversized"], got["n_rows"]) == (3, 20_000) if name == "oversized_files" else got["differences"] == 2


def test_copies_are_sorted_once(spark, tmp_path):
    once, n = counting(spark, spark.range(3000).selectExpr("(id * 7919) % 3000 as id", "1 as x"))
    paths = {codec: str(tmp_path / codec) for codec in ("gzip", "none", "snappy")}
    writers.write_copies(once, paths, ["id"], rows_per_file=1000)
    # Counted, sampled and sorted; not once more for each copy.
    assert n.value <= 3 * 3000
    for path in paths.values():
        found = spans(spark, path, "id")
        assert sum(r["n"] for r in found) == 3000 and all(a["hi"] < b["lo"] for a, b in zip(found, found[1:]))
