"""Integrity rules and the gate that runs them before anything is written.

A rule is a lazy one-row frame ``(rule, violations)``. The gate counts all of its rules in one
job and raises before a write can start.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspark.contracts import schema_differences
from wellspark.functions.columns import months_between, quoted, seconds_between
from wellspark.functions.wkb import wkb_valid
from wellspark.operators.contract_rows import contract_violations
from wellspark.operators.temporal import previous


class IntegrityError(Exception):
    """A rule found violations; nothing may be published."""


class ForeignKeyError(IntegrityError):
    """A child key is missing from its parent table."""


class UniqueKeyError(IntegrityError):
    """A key occurs more than once."""


class CompletenessError(IntegrityError):
    """An entity does not have a row for every month of its span."""


class CountError(IntegrityError):
    """A row or partition count differs from what it must be."""


class DomainError(IntegrityError):
    """A value lies outside its domain or contradicts another column."""


class CadenceError(IntegrityError):
    """Consecutive observations are not one step apart."""


class GeometryError(IntegrityError):
    """A geometry is not well-known binary."""


class VersionError(IntegrityError):
    """The source is not the pinned version."""


class ContractError(IntegrityError):
    """A schema, label mapping or manifest differs from what is declared."""


@dataclass(frozen=True)
class Rule:
    name: str
    violations: DataFrame
    error: type[IntegrityError] = IntegrityError
    soft: bool = False

    def frame(self) -> DataFrame:
        (column,) = self.violations.columns
        return self.violations.select(
            F.lit(self.name).alias("rule"),
            F.coalesce(quoted(column), F.lit(0)).cast("long").alias("violations"))


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("violations"))


def check_fk(name: str, child: DataFrame, parent: DataFrame, columns: list[str],
             parent_columns: list[str] | None = None, null_is_violation: bool = False,
             rows: bool = False) -> Rule:
    """Distinct child keys (or child rows) whose key the parent does not have.

    Child rows are counted per key before the join, so a hot key is one row of it.
    """
    parent_columns = parent_columns or columns
    complete = reduce(lambda a, b: a & b, [quoted(c).isNotNull() for c in columns])
    keys = child.groupBy(*[quoted(c) for c in columns]).agg(F.count(F.lit(1)).alias("_n"))
    if not null_is_violation:
        keys = keys.where(complete)
    known = parent.select(*[quoted(p).alias(c) for c, p in zip(columns, parent_columns)]).distinct()
    orphans = keys.join(known, columns, "left_anti")
    total = F.sum("_n") if rows else F.count(F.lit(1))
    return Rule(name, orphans.agg(total.alias("violations")), ForeignKeyError)


def check_unique(name: str, df: DataFrame, columns: list[str]) -> Rule:
    """Keys that occur more than once."""
    groups = df.groupBy(*[quoted(c) for c in columns]).agg(F.count(F.lit(1)).alias("_n"))
    return Rule(name, _count(groups.where("_n > 1")), UniqueKeyError)


def check_row_count(name: str, df: DataFrame, expected: int) -> Rule:
    """The number of rows missing or in excess."""
    return Rule(name, df.agg(F.abs(F.count(F.lit(1)) - expected).alias("violations")), CountError)


def check_not_empty(name: str, df: DataFrame) -> Rule:
    return Rule(name, df.limit(1).agg((1 - F.count(F.lit(1))).alias("violations")), CountError)


def check_predicate(name: str, df: DataFrame, holds: Column,
                    error: type[IntegrityError] = DomainError) -> Rule:
    """Rows for which the predicate is not true; an unknown (NULL) outcome counts as one."""
    return Rule(name, _count(df.where(~F.coalesce(holds, F.lit(False)))), error)


def check_same_values(name: str, df: DataFrame, column: str, expected: list) -> Rule:
    """Values present but not expected, plus values expected but absent."""
    wanted = F.array(*[F.lit(v) for v in expected])
    found = F.collect_set(F.when(quoted(column).isin(*expected), quoted(column)))
    values = df.select(quoted(column)).distinct()
    strange = F.count_if(~quoted(column).isin(*expected) | quoted(column).isNull())
    return Rule(name, values.agg(
        (strange + F.size(F.array_except(wanted, found))).alias("violations")), DomainError)


def check_complete_months(name: str, df: DataFrame, key: str, date: str) -> Rule:
    """Entities whose number of rows is not the length of their month span."""
    spans = df.groupBy(quoted(key)).agg(
        F.count(F.lit(1)).alias("_n"), F.min(quoted(date)).alias("_first"),
        F.max(quoted(date)).alias("_last"))
    wrong = F.col("_n") != months_between(F.col("_first"), F.col("_last")) + 1
    return Rule(name, _count(spans.where(wrong)), CompletenessError)


def cadence_breaks(df: DataFrame, keys: list[str], time: str, seconds: int = 1,
                   every: int | None = None) -> DataFrame:
    """Per entity, the number of steps that are not ``seconds`` long.

    Copies of the same time are counted first: each extra copy is one zero-length step.
    """
    times = df.groupBy(*[quoted(k) for k in keys], quoted(time)).agg(
        F.count(F.lit(1)).alias("_copies"))
    stepped = previous(times, keys, time, "_previous", every)
    step = seconds_between(F.col("_previous"), quoted(time))
    broken = F.when(F.col("_previous").isNotNull() & (step != seconds), 1).otherwise(0)
    extra = F.lit(0) if seconds == 0 else F.col("_copies") - 1
    return stepped.groupBy(*[quoted(k) for k in keys]).agg(
        F.sum((broken + extra).cast("long")).alias("n_breaks")).where("n_breaks > 0")


def check_cadence(name: str, df: DataFrame, keys: list[str], time: str, seconds: int = 1,
                  every: int | None = None) -> Rule:
    breaks = cadence_breaks(df, keys, time, seconds, every)
    return Rule(name, breaks.agg(F.sum("n_breaks").alias("violations")), CadenceError)


def check_wkb(name: str, df: DataFrame, geometry: str, source: str | None = None) -> Rule:
    """Non-NULL geometries that do not parse, and sources whose hex text did not decode."""
    bad = quoted(geometry).isNotNull() & ~wkb_valid(quoted(geometry))
    if source:
        bad = bad | (quoted(geometry).isNull() & quoted(source).isNotNull())
    return Rule(name, _count(df.where(bad)), GeometryError)


def check_counts_match(name: str, a: DataFrame, b: DataFrame, keys: list[str],
                       count: str = "n") -> Rule:
    """Keys whose counts differ between two frames, or that only one of them has."""
    sides = a.select(*[quoted(k) for k in keys], quoted(count).alias("_a"),
                     F.lit(None).cast("long").alias("_b")).unionByName(
        b.select(*[quoted(k) for k in keys], F.lit(None).cast("long").alias("_a"),
                 quoted(count).alias("_b")))
    joined = sides.groupBy(*[quoted(k) for k in keys]).agg(
        F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    return Rule(name, _count(joined.where(~F.col("_a").eqNullSafe(F.col("_b")))), CountError)


def check_label_mapping(name: str, df: DataFrame, column: str, labels: dict[int, str]) -> Rule:
    """Codes without a label plus labels whose code never occurs."""
    rule = check_same_values(name, df.where(quoted(column).isNotNull()), column, sorted(labels))
    return Rule(name, rule.violations, ContractError)


def check_version(name: str, df: DataFrame, column: str, pinned: str) -> Rule:
    """Source versions other than the pinned one."""
    return Rule(name, _count(df.select(quoted(column)).distinct().where(
        ~quoted(column).eqNullSafe(F.lit(pinned)))), VersionError)


def check_partitions(name: str, table: DataFrame, published: DataFrame, year: Column,
                     partition: str = "year") -> list[Rule]:
    """Published rows per partition must be the table's rows per year, partition for partition."""
    have = table.groupBy(year.cast("int").alias(partition)).agg(F.count(F.lit(1)).alias("n"))
    wrote = published.groupBy(quoted(partition).cast("int").alias(partition)).agg(
        F.count(F.lit(1)).alias("n"))
    return [check_counts_match(name, have, wrote, [partition])]


def check_file_sizes(name: str, files: DataFrame, limit: int = 50 * 1024 * 1024) -> Rule:
    """Files over the soft limit; a listing has the columns ``path`` and ``length``."""
    return Rule(name, _count(files.where(F.col("length") > limit)), CountError, soft=True)


def check_contract(df: DataFrame, contract) -> None:
    problems = schema_differences(df, contract)
    if problems:
        raise ContractError("; ".join(problems))


def check_contract_rows(name: str, df: DataFrame, contract, key: list[str] | None = None) -> Rule:
    """Cells, NULLs, keys and columns that the contract does not allow (see ``contract_violations``)."""
    return Rule(name, contract_violations(df, contract, key).agg(
        F.coalesce(F.sum("violations"), F.lit(0)).alias("violations")), ContractError)


class Gate:
    """A set of rules that must all hold."""

    def __init__(self, rules: list[Rule]):
        self.rules = rules

    def report(self) -> DataFrame:
        """One row per rule with its violations; lazy."""
        return reduce(DataFrame.unionByName, [r.frame() for r in self.rules])

    def enforce(self) -> dict[str, int]:
        """Count everything in one job; raise on the first hard rule broken, warn on soft ones."""
        counts = {row["rule"]: row["violations"] for row in self.report().collect()}
        for rule in self.rules:
            n = counts[rule.name]
            if n and rule.soft:
                warnings.warn(f"{rule.name}: {n}", stacklevel=2)
            elif n:
                raise rule.error(f"{rule.name}: {n} violation(s)")
        return counts


def production_gate(wells: DataFrame, history: DataFrame, events: DataFrame,
                    monthly: DataFrame) -> Gate:
    """Rules of the well-production tables."""
    key = ["idpozo"]
    return Gate([
        check_wkb("geometry parses", wells, "geom"),
        check_fk("operator history has wells", history, wells, key),
        check_fk("state events have wells", events, wells, key),
        check_fk("monthly series has wells", monthly, wells, key),
        check_unique("monthly series key is unique", monthly, ["idpozo", "fecha"]),
        check_complete_months("monthly series is complete", monthly, "idpozo", "fecha"),
    ])


def sensor_gate(lookup: DataFrame, catalog: DataFrame, wells: DataFrame, observations: DataFrame,
                expected_classes: int | None = 10, expected_wells: int | None = 40,
                without_transient: tuple[int, ...] = (0, 3, 4),
                version: DataFrame | None = None, pinned_version: str | None = None) -> Gate:
    """Rules of the labelled sensor windows. Pins are parameters; None leaves one out."""
    identity = ["instance_id", "event_class"]
    phases = lookup.select("event_class", "has_transient", "transient_code")
    classed = catalog.join(phases, "event_class", "left")
    transient = F.col("has_transient")
    label, event = quoted("class"), F.col("event_class")

    # All rules on rows but the cadence follow from one count per instance and label.
    counted = observations.groupBy(*identity, label.alias("class")).agg(
        F.count(F.lit(1)).alias("_n"))
    labels = counted.join(phases, "event_class", "left")
    known = label.isNull() | (label == 0) | (label == event) | F.coalesce(
        label == F.col("transient_code"), F.lit(False))
    steady_only = [c for c in without_transient if c != 0]

    def label_rows(bad: Column) -> DataFrame:
        return labels.where(F.coalesce(bad, F.lit(True))).agg(F.sum("_n").alias("violations"))

    buckets = (F.col("n_rows_warmup_null") + F.col("n_rows_normal")
               + F.coalesce("n_rows_transient", F.lit(0)) + F.col("n_rows_steady"))
    real = catalog.where(F.col("well_kind") == "real")
    rules = []
    if version is not None:
        rules.append(check_version("source version is the pinned one", version,
                                   version.columns[0], pinned_version))
    if expected_classes is not None:
        rules.append(check_row_count("event classes are all there", lookup, expected_classes))
    rules += [
        check_unique("event class is unique", lookup, ["event_class"]),
        check_same_values("classes without transient phase",
                          lookup.where(~F.col("has_transient")), "event_class",
                          list(without_transient)),
        check_predicate("transient codes are consistent", lookup, F.col("transient_code").eqNullSafe(
            F.when(transient, event + 100))),
        check_unique("instance key is unique", catalog, identity),
        check_fk("instances have event classes", catalog, lookup, ["event_class"]),
        check_predicate("well kind and id agree", catalog,
                        F.col("well_kind").isin("real", "simulated", "drawn")
                        & (F.col("well_id").isNotNull() == (F.col("well_kind") == "real"))),
        check_predicate("transient counts are NULL by design only", classed,
                        F.col("n_rows_transient").isNotNull() == transient),
        check_predicate("label buckets sum to rows", catalog, buckets == F.col("n_rows")),
        check_fk("wells come from real instances", wells, real, ["well_id"],
                 null_is_violation=True),
        check_fk("instances have wells", catalog, wells, ["well_id"]),
        check_fk("observations have instances", counted, catalog, identity),
        check_counts_match(
            "observations per instance match the catalog",
            counted.groupBy(*identity).agg(F.sum("_n").alias("n")),
            catalog.select(*identity, F.col("n_rows").alias("n")), identity),
        check_cadence("observations are one second apart", observations, identity, "timestamp"),
        Rule("labels are in their domain", label_rows(~known), DomainError),
        Rule("steady-only classes hold no other label",
             label_rows(event.isin(*steady_only) & F.coalesce(
                 (label == 0) | (label >= 100), F.lit(False))), DomainError),
    ]
    if expected_wells is not None:
        rules.append(check_row_count("real wells are all there", wells, expected_wells))
    return Gate(rules)


def field_gate(wells: DataFrame, daily: DataFrame, monthly: DataFrame) -> Gate:
    """Rules of the field daily and monthly tables."""
    code, key = ["npd_wellbore_code"], ["date", "npd_wellbore_code"]
    return Gate([
        check_not_empty("wells are not empty", wells),
        check_not_empty("daily production is not empty", daily),
        check_not_empty("monthly production is not empty", monthly),
        check_fk("daily production has wells", daily, wells, code, null_is_violation=True,
                 rows=True),
        check_fk("monthly production has wells", monthly, wells, code, null_is_violation=True,
                 rows=True),
        check_unique("daily key is unique", daily, key),
        check_unique("monthly key is unique", monthly, key),
    ])
