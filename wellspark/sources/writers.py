"""Writing published tables: sorted, partitioned, verified, then moved into place."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from wellspark.functions.columns import quoted
from wellspark.session import shared_folder
from wellspark.sources.files import discard, move_into_place, write_manifest
from wellspark.sources.planning import cells_of_instances, count_cells, dealt, planned
from wellspark.sources.zones import write_zones


class RowCountError(Exception):
    """What was written does not have the rows that were to be written."""


def parquet_options(compression: str = "snappy", row_group: int | None = None,
                    lookup: dict[str, int] | None = None) -> dict[str, str]:
    """Options of the Parquet writer: codec, bytes of a row group, columns with a Bloom filter.

    Statistics of small, sorted row groups let a reader skip to an entity; the filter, sized for
    the number of distinct values given, lets it skip where values of a column lie scattered.
    """
    options = {"compression": compression}
    if row_group:
        # The size is looked at every so many rows; a small group needs more looks.
        options |= {"parquet.block.size": str(row_group), "parquet.page.size": str(min(row_group, 1 << 20)),
                    "parquet.page.size.row.check.min": "100", "parquet.page.size.row.check.max": "10000"}
    for column, distinct in (lookup or {}).items():
        options |= {f"parquet.bloom.filter.enabled#{column}": "true",
                    f"parquet.bloom.filter.expected.ndv#{column}": str(distinct)}
    return options


def write_table(df: DataFrame, path: str, order: list[str], compression: str = "snappy") -> None:
    """One folder in total order. Small tables come out as one file, large ones as many.

    The rows are dealt out once before they are sorted, so the sample that the order needs is
    taken from there and the input runs once.
    """
    df.hint("rebalance").orderBy(*[quoted(c) for c in order]).write.option("compression", compression).parquet(path)


def write_copies(df: DataFrame, paths: dict[str, str], order: list[str], rows_per_file: int = 1_000_000) -> None:
    """The same folder in total order under several codecs, ``{codec: path}``.

    The rows are counted, dealt out and sorted once, and stay on the executors' disks until all
    copies are written.
    """
    columns = [quoted(c) for c in order]
    files = max(1, -(-df.count() // rows_per_file))
    rows = df.repartitionByRange(files, *columns).sortWithinPartitions(*columns).persist(StorageLevel.DISK_ONLY)
    try:
        for compression, path in paths.items():
            rows.write.option("compression", compression).parquet(path)
    finally:
        rows.unpersist()


def write_folders(df: DataFrame, path: str, partition: str) -> None:
    """Partition folders in no order inside. A small folder is one file; a large one is divided among tasks at run time."""
    df.hint("rebalance", quoted(partition)).write.partitionBy(partition).parquet(path)


ROWS_PER_FILE = 2_500_000  # a file has less than twice as many, see ``planned``


def write_partitioned(df: DataFrame, path: str, partition: list[str], order: list[str], compression: str = "snappy",
                      files: int | None = None, rows_per_file: int = ROWS_PER_FILE, cells: DataFrame | None = None,
                      row_group: int | None = None, lookup: dict[str, int] | None = None) -> None:
    """Partition folders whose files are sorted by ``order``: an entity, then its time.

    Files are planned from counts (see ``planning``): from ``cells`` if they are known, otherwise
    from a pass over the partition, entity and time columns. A partition or an entity that holds
    much of the table is spread over several tasks and files, each covering its own range;
    ``files`` asks for a number of tasks. Small files are cut one after the other from the sorted
    rows of a task. The partition columns lead the sort: without them the writer would sort again
    and lose the inner order.
    """
    if cells is None:
        cells = count_cells(df, partition, order[0], order[1] if len(order) > 1 else None)
    with planned(cells, partition, rows_per_file, files) as plan:
        options = parquet_options(compression, row_group, lookup)
        if not files and plan.rows_per_task > rows_per_file:
            options["maxRecordsPerFile"] = str(rows_per_file)
        dealt(df, plan, partition, order).write.options(**options).partitionBy(*partition).parquet(path)


def write_by_year(df: DataFrame, path: str, date: str, entity: str, partition: str = "year",
                  compression: str = "snappy", rows_per_file: int = ROWS_PER_FILE, row_group: int | None = None,
                  lookup: dict[str, int] | None = None) -> list[str]:
    """Year folders sorted by entity and date, plus the manifest and the zone map."""
    dated = df.withColumn(partition, F.year(quoted(date)))
    write_partitioned(dated, path, [partition], [entity, date], compression, rows_per_file=rows_per_file,
                      row_group=row_group, lookup=lookup)
    write_zones(df.sparkSession, path, entity, date)
    return write_manifest(df.sparkSession, path)


FOLDERS = 2_500  # instances with a folder of their own; the studied corpus has some 2,200


def write_observations(df: DataFrame, path: str, own_folder: bool | None = None, compression: str = "snappy",
                       instances: DataFrame | None = None, rows_per_file: int = ROWS_PER_FILE) -> list[str]:
    """Event-class folders of observations with their provenance columns, plus the manifest.

    One job for all instances. Up to ``FOLDERS`` of them get a folder each, the one that the
    catalog names as its address, so no file mixes two of them. More share the files of their
    class, sorted by instance, and a zone map tells which files an instance is in: the number of
    files then grows with the rows. ``readers.instance_rows`` reads both; ``own_folder`` asks for
    one of them. With the catalog (``instances``) its row counts plan the files, and the
    observations are read once.
    """
    spark, folder = df.sparkSession, shared_folder(df.sparkSession)
    if instances is None:
        cells = count_cells(df, ["event_class"], "instance_id", "timestamp")
    else:
        cells = cells_of_instances(instances, ["event_class"], "instance_id", "n_rows", "start_ts", "end_ts")
    try:
        cells.write.parquet(folder)
        cells = spark.read.schema(cells.schema).parquet(folder)
        if own_folder is None:
            own_folder = cells.select("event_class", "_entity").distinct().count() <= FOLDERS
        partition = ["event_class"]
        if own_folder:
            # The folder name carries the id, so the body keeps a copy of it.
            df, cells = df.withColumn("instance", F.col("instance_id")), cells.withColumn("instance", F.col("_entity"))
            partition = ["event_class", "instance"]
        write_partitioned(df, path, partition, ["instance_id", "timestamp"], compression, rows_per_file=rows_per_file, cells=cells)
    finally:
        discard(spark, folder)
    if not own_folder:
        write_zones(spark, path, "instance_id", "timestamp")
    return write_manifest(spark, path)


def counted(df: DataFrame) -> tuple[DataFrame, Callable[[int], int]]:
    """``df`` with its rows counted on their way, and a function that gives the count after the write.

    The function is told how many rows were written. When that is another number the rows are
    counted again: what a lost executor had done is observed twice.
    """
    seen = Observation()

    def rows(written: int) -> int:
        return written if seen.get["rows"] == written else df.count()

    return df.observe(seen, F.count(F.lit(1)).alias("rows")), rows


def publish(df: DataFrame, target: str, write: Callable[[DataFrame, str], object],
            expected: int | None = None) -> int:
    """Write beside the target, compare the row count, then move into place.

    Rows are counted while they are written; ``expected`` is for a caller that knows the number.
    On any failure the old version stays.
    """
    spark = df.sparkSession
    staged = f"{target}.staging-{uuid.uuid4().hex}"
    observed, rows = counted(df)
    write(observed, staged)
    written = spark.read.parquet(staged).count()
    expected = rows(written) if expected is None else expected
    if written != expected:
        raise RowCountError(f"{target}: {written} rows written, {expected} expected")
    move_into_place(spark, staged, target)
    return written
