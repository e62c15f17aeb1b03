"""Versions of a set of tables: new files beside the old ones, and a commit file that names what counts.

    <root>/versions/<version>/<table>   files of one publishing, written once and never moved
    <root>/_commits/00000007.json       the tables of the set, each with its folder and row count

Readers take the commit with the highest number and read the folders it names, so they see all
tables of one publishing or all of the one before, whatever failed in between.
"""

from __future__ import annotations

import json
import uuid

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspark.sources.files import discard, exists, list_names, read_text, summary_of, write_text

COMMITS = "_commits"
VERSIONS = "versions"


class ConflictError(Exception):
    """Somebody else has committed to the set since this publishing began."""


def new_version() -> str:
    return uuid.uuid4().hex


def version_folder(root: str, version: str) -> str:
    return f"{root.rstrip('/')}/{VERSIONS}/{version}"


def commit_numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the commits there are, rising."""
    folder = f"{root}/{COMMITS}"
    names = list_names(spark, folder) if exists(spark, folder) else []
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def read_commit(spark: SparkSession, root: str, number: int | None = None) -> dict[str, dict]:
    """The tables of a commit, the newest unless told: name to ``path`` (below the root) and ``rows``."""
    if number is None:
        numbers = commit_numbers(spark, root)
        if not numbers:
            raise FileNotFoundError(f"nothing has been published to {root}")
        number = numbers[-1]
    return json.loads(read_text(spark, f"{root}/{COMMITS}/{number:08d}.json"))


def commit(spark: SparkSession, root: str, version: str, rows: dict[str, int], after: int | None) -> int:
    """Make a version's tables those of the set; tables it does not have stay as they were.

    ``after`` is the newest commit when the publishing began (None: there was none). The commit
    file gets the next number, under which no file may exist yet: of two publishings that began
    alike, one is refused and nothing of it can be seen.
    """
    numbers = commit_numbers(spark, root)
    if (numbers[-1] if numbers else None) != after:
        raise ConflictError(f"{root} has commit {numbers[-1]}, this publishing began after {after}")
    tables = read_commit(spark, root, after) if after is not None else {}
    tables |= {name: {"path": f"{VERSIONS}/{version}/{name}", "rows": n} for name, n in rows.items()}
    number = 1 if after is None else after + 1
    text = json.dumps(tables, indent=2, sort_keys=True) + "\n"
    if not write_text(spark, f"{root}/{COMMITS}/{number:08d}.json", text, replace=False):
        raise ConflictError(f"{root} has got commit {number} meanwhile")
    return number


def published_path(spark: SparkSession, root: str, name: str, number: int | None = None) -> str:
    tables = read_commit(spark, root, number)
    if name not in tables:
        raise FileNotFoundError(f"no table {name} in {root}: {', '.join(sorted(tables))}")
    return f"{root.rstrip('/')}/{tables[name]['path']}"


def read_published(spark: SparkSession, root: str, name: str, number: int | None = None) -> DataFrame:
    """A table of a published set, as of the newest commit or of an earlier one."""
    return spark.read.parquet(published_path(spark, root, name, number))


def read_set(spark: SparkSession, root: str, number: int | None = None) -> dict[str, DataFrame]:
    """All tables of one commit, resolved together."""
    return {name: spark.read.parquet(f"{root.rstrip('/')}/{t['path']}")
            for name, t in read_commit(spark, root, number).items()}


def set_summary(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """Per table of a set: rows as they were counted when it was written, files, megabytes, time of the last file."""
    return reduce(DataFrame.unionByName, [
        summary_of(spark, f"{root.rstrip('/')}/{t['path']}", name, F.lit(t["rows"]).cast("long"))
        for name, t in read_commit(spark, root, number).items()])


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove the commits before the last ``keep``, and table folders that only they name.

    Folders no commit names are left alone: a publishing under way may be writing them.
    """
    if keep < 1:
        raise ValueError("one commit has to stay")
    numbers = commit_numbers(spark, root)
    old, kept = numbers[:-keep], numbers[-keep:]
    used = {t["path"] for n in kept for t in read_commit(spark, root, n).values()}
    gone = sorted({t["path"] for n in old for t in read_commit(spark, root, n).values()} - used)
    for n in old:
        discard(spark, f"{root}/{COMMITS}/{n:08d}.json")
    for path in gone:
        discard(spark, f"{root}/{path}")
    return gone
