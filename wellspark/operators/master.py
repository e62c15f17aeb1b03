"""Master records merged from several sources by precedence."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspark.functions.columns import quoted


HOT = 100_000  # rows of a key up to which its values are counted in a map per column


def modal_attributes(df: DataFrame, key: str, columns: dict[str, str], hot: int = HOT) -> DataFrame:
    """Per key, the most frequent non-NULL value of each column; smallest value on a tie.

    ``columns`` maps an output column to the one it is taken from. A key of at most ``hot`` rows
    has a map of counts per column, filled where the rows are and sent once. Keys of more rows are
    found by a count of the key column alone and counted by value (see ``_counted_modes``); where
    there are none, Spark sees it after that count and leaves that branch out.
    """
    df = df.where(quoted(key).isNotNull())
    kinds = dict(df.dtypes)
    many = df.groupBy(quoted(key)).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot).select(quoted(key))

    def value(source: str) -> Column:  # zeros of either sign are one value
        return quoted(source) + F.lit(0).cast(kinds[source]) if kinds[source] in ("double", "float") else quoted(source)

    few = df.join(many, key, "left_anti").groupBy(quoted(key)).agg(
        *[F.mode(value(source), True).alias(out) for out, source in columns.items()])
    return few.unionByName(_counted_modes(df.join(many, key, "left_semi"), key, columns))


def _counted_modes(df: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """The same for keys of any number of rows and values.

    All columns are counted in one exchange, by key, column and value: a frequent value is summed
    before it is sent, a key is dealt out by its values, and what meets per key is a row per
    distinct value. Values keep their type: a counted row has a place for each type that occurs.
    """
    kinds = dict(df.dtypes)
    sources = list(dict.fromkeys(columns.values()))
    place = {kind: f"_v{i}" for i, kind in enumerate(dict.fromkeys(kinds[c] for c in sources))}

    def cell(i: int, source: str) -> Column:
        return F.struct(F.lit(i).alias("_column"), *[
            (quoted(source) if kinds[source] == kind else F.lit(None).cast(kind)).alias(name) for kind, name in place.items()])

    rows = df.select(quoted(key), F.inline(F.array(*[cell(i, c) for i, c in enumerate(sources)])))
    counts = rows.groupBy(quoted(key), "_column", *place.values()).agg(F.count(F.lit(1)).alias("_n"))

    def best(source: str) -> Column:
        value = F.col(place[kinds[source]])
        own = (F.col("_column") == sources.index(source)) & value.isNotNull()
        return F.min_by(value, F.when(own, F.struct(-F.col("_n"), value)))

    return counts.groupBy(quoted(key)).agg(*[best(src).alias(out) for out, src in columns.items()])


def merge_master(key: str, sources: dict[str, DataFrame], spine: list[str],
                 rules: dict[str, list[str]], presence: dict[str, str] | None = None) -> DataFrame:
    """One row per key of the spine sources, each column from the first source that has it.

    ``rules`` maps an output column to ``source.column`` names in order of precedence;
    ``presence`` maps an output flag to the source whose presence it tells. Sources have one row
    per key and no NULL keys. The spine sources are joined in full, so each source is read once.
    """
    wanted: dict[str, list[str]] = {name: [] for name in sources}
    for references in rules.values():
        for reference in references:
            name, column = reference.split(".", 1)
            if column not in wanted[name]:
                wanted[name].append(column)

    def named(name: str) -> DataFrame:
        return sources[name].select(quoted(key), F.lit(True).alias(f"{name}."),
                                    *[quoted(c).alias(f"{name}.{c}") for c in wanted[name]])

    joined = reduce(lambda a, b: a.join(b, key, "full_outer"), [named(s) for s in spine])
    for name in sources:
        if name not in spine:
            joined = joined.join(named(name), key, "left")
    return joined.select(
        quoted(key),
        *[F.coalesce(*[quoted(r) for r in references]).alias(out)
          for out, references in rules.items()],
        *[quoted(f"{source}.").isNotNull().alias(out)
          for out, source in (presence or {}).items()],
    )
