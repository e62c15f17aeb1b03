"""Files of a table: listing, moving into place, and the manifest that names them."""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "_files.json"
SIZE_LIMIT = 50 * 1024 * 1024  # fixed value: soft limit per file


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _filesystem(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _filesystem(spark, path).exists(_path(spark, path))


def qualified_path(spark: SparkSession, path: str) -> str:
    """The path without scheme and host, as it stands in file listings."""
    return _filesystem(spark, path).getFileStatus(_path(spark, path)).getPath().toUri().getPath()


def discard(spark: SparkSession, path: str) -> None:
    """Remove a staging folder and what is left in it."""
    _filesystem(spark, path).delete(_path(spark, path), True)


def discard_empty(spark: SparkSession, *folders: str) -> None:
    """Remove folders in which nothing is left."""
    for folder in folders:
        if exists(spark, folder) and not list_names(spark, folder):
            _filesystem(spark, folder).delete(_path(spark, folder), False)


def move_into_place(spark: SparkSession, staged: str, target: str) -> None:
    """Rename a finished folder to its final name; an older version goes only after that."""
    fs = _filesystem(spark, target)
    old = None
    fs.mkdirs(_path(spark, target).getParent())
    if exists(spark, target):
        old = f"{target}.old-{uuid.uuid4().hex}"
        if not fs.rename(_path(spark, target), _path(spark, old)):
            raise OSError(f"cannot move {target} aside")
    if not fs.rename(_path(spark, staged), _path(spark, target)):
        if old:
            fs.rename(_path(spark, old), _path(spark, target))
        raise OSError(f"cannot move {staged} to {target}")
    if old:
        fs.delete(_path(spark, old), True)


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Parquet files under ``root`` as ``(path, length)``; the files are not opened."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet").load(root).select("path", "length")
    )


def oversized(files: DataFrame, limit: int = SIZE_LIMIT) -> DataFrame:
    return files.where(F.col("length") > limit)


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies directly in a folder."""
    return sorted(f.getPath().getName() for f in _filesystem(spark, folder).listStatus(_path(spark, folder)))


def write_text(spark: SparkSession, path: str, text: str, replace: bool = True) -> bool:
    """Write a small file whole or not at all; false if it is there and is not to be replaced.

    The text goes to a file of its own, which is then renamed: nobody reads half of it, and of
    several writers that may not replace it one succeeds.
    """
    fs, own = _filesystem(spark, path), f"{path}.{uuid.uuid4().hex}.tmp"
    out = fs.create(_path(spark, own), True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    kinds = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kinds, 1)
    options[0] = kinds.OVERWRITE if replace else kinds.NONE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.makeQualified(_path(spark, path)).toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(_path(spark, own), _path(spark, path), options)
    except Exception:
        fs.delete(_path(spark, own), False)
        if not replace and exists(spark, path):
            return False
        raise
    return True


def read_text(spark: SparkSession, path: str) -> str:
    stream = _filesystem(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


FIRST_BLOCK = 1 << 16  # bytes of a file that are read for its first line, unless the line is longer


def first_lines(spark: SparkSession, paths: list[str], at_once: int = 32) -> dict[str, str]:
    """The first line of each file, from a read of its first block; many files side by side.

    What is read grows with the number of files, not with their size. Compressed files are
    unpacked as far as needed.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first(path: str) -> str:
        block = FIRST_BLOCK
        while True:
            stream = _filesystem(spark, path).open(_path(spark, path))
            try:
                codec = codecs.getCodec(_path(spark, path))
                source = stream if codec is None else codec.createInputStream(stream)
                data = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(
                    jvm.org.apache.commons.io.input.BoundedInputStream(source, block)))
            finally:
                stream.close()
            line, end, _ = data.partition(b"\n")
            if end or len(data) < block:
                return line.decode("utf-8-sig", "replace").rstrip("\r")
            block *= 4

    with ThreadPoolExecutor(at_once) as threads:
        return dict(zip(paths, threads.map(first, paths)))


def write_manifest(spark: SparkSession, root: str) -> list[str]:
    """Write the sorted relative paths of the committed files; names only, no data."""
    relative = F.substring_index(F.col("path"), qualified_path(spark, root).rstrip("/") + "/", -1)
    paths = [r[0] for r in list_files(spark, root).select(relative).orderBy(relative).collect()]
    write_text(spark, f"{root}/{MANIFEST}", json.dumps(paths, indent=2) + "\n")
    return paths


def read_manifest(spark: SparkSession, root: str) -> list[str]:
    # Spark's readers pass over names that begin with an underscore.
    return json.loads(read_text(spark, f"{root}/{MANIFEST}"))


def manifest_differences(spark: SparkSession, root: str) -> list[str]:
    """Files listed but absent, and files present but not listed."""
    listed = set(read_manifest(spark, root))
    relative = F.substring_index(F.col("path"), qualified_path(spark, root).rstrip("/") + "/", -1)
    present = {r[0] for r in list_files(spark, root).select(relative).collect()}
    return sorted(listed ^ present)


def summary_of(spark: SparkSession, root: str, name: str, rows: Column) -> DataFrame:
    """Rows, files, megabytes and last write of one table; the files are not opened."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet").load(root)
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("updated"))
        .select(F.lit(name).alias("table_name"), rows.alias("rows"), "files",
                F.round(F.col("bytes") / F.lit(1024.0 * 1024.0), 2).alias("megabytes"), "updated"))


def export_summary(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """Per published table: rows, files, megabytes, and when it was last written."""
    return reduce(DataFrame.unionByName, [
        summary_of(spark, root, name, spark.read.parquet(root).agg(F.count(F.lit(1)).alias("n")).select("n").scalar())
        for name, root in tables.items()])
