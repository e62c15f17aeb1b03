"""From raw tables to published ones: build, write a new version, check, compare, commit."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspark.contracts import (
    EVENT_TYPES,
    FIELD_DAILY,
    FIELD_MONTHLY,
    FIELD_WELLS,
    INSTANCES,
    LITHOLOGY,
    LITHOLOGY_LABELS,
    MONTHLY_SERIES,
    OBSERVATIONS,
    OPERATOR_HISTORY,
    SENSOR_WELLS,
    STATE_EVENTS,
    WELL_LOGS,
    WELL_MASTER,
    conform,
)
from wellspark.operators import catalog as cat
from wellspark.operators.checks import (
    CountError,
    Gate,
    check_contract,
    check_file_sizes,
    check_label_mapping,
    check_unique,
    field_gate,
    check_partitions,
    production_gate,
    sensor_gate,
)
from wellspark.operators.parity import enforce_parity, parity_report
from wellspark.plans import field_tables, well_tables
from wellspark.session import keep
from wellspark.sources.files import discard, discard_empty, list_files, write_manifest
from wellspark.sources.versions import VERSIONS, commit, commit_numbers, new_version, version_folder
from wellspark.sources.writers import counted, write_by_year, write_observations, write_partitioned, write_table

Writer = Callable[[DataFrame, str], object]


def _sorted_by(*order: str) -> Writer:
    return lambda df, path: write_table(df, path, list(order))


def publish_together(spark: SparkSession, tables: dict[str, tuple[DataFrame, Writer]], out: str,
                     check: Callable[[dict[str, DataFrame]], None], version: str | None = None) -> dict[str, int]:
    """Write all tables to a folder of their own, check them there, then commit them together.

    Rows are counted while they are written and compared with what the files hold. The commit
    file is written last and names the folder of every table (see ``versions``), so a reader sees
    all new tables or all old ones, whatever failed; tables of the set that are not written stay.
    When a write, a count, a check or the commit fails, the new files go.
    """
    numbers = commit_numbers(spark, out)
    version = version or new_version()
    folder = version_folder(out, version)
    try:
        expected = {}
        for name, (df, write) in tables.items():
            observed, expected[name] = counted(df)
            write(observed, f"{folder}/{name}")
        written = {name: spark.read.parquet(f"{folder}/{name}") for name in tables}
        rows = {name: df.count() for name, df in written.items()}
        for name, n in rows.items():
            if expected[name](n) != n:
                raise CountError(f"{name}: {n} rows written, {expected[name](n)} expected")
        Gate([check_file_sizes("files over the soft size limit", list_files(spark, folder))]).enforce()
        check(written)
        commit(spark, out, version, rows, numbers[-1] if numbers else None)
        return rows
    except BaseException:
        discard(spark, folder)
        discard_empty(spark, f"{out}/{VERSIONS}", out)
        raise


def publish_production(registry: DataFrame, listing: DataFrame, production: DataFrame,
                       out: str) -> dict[str, int]:
    """Build the four well-production tables and publish them, or none if a rule fails."""
    monthly = well_tables.monthly_series(production)

    def check(written: dict[str, DataFrame]) -> None:
        wells, history = written["wells"], written["well_operator_history"]
        events, series = written["well_events"], written["monthly_production"]
        for df, contract in ((wells, WELL_MASTER), (history, OPERATOR_HISTORY),
                             (events, STATE_EVENTS), (series.drop("year"), MONTHLY_SERIES)):
            check_contract(df, contract)
        Gate([*production_gate(wells, history, events, series).rules,
              *check_partitions("years hold the table's rows", monthly, series,
                                F.year("fecha"))]).enforce()

    return publish_together(production.sparkSession, {
        "wells": (well_tables.well_master(registry, listing, production), _sorted_by("idpozo")),
        "well_operator_history": (well_tables.operator_history(production),
                                  _sorted_by("idpozo", "valid_from")),
        "well_events": (well_tables.state_events(production),
                        _sorted_by("idpozo", "event_date")),
        "monthly_production": (
            monthly, lambda df, path: write_by_year(df, path, "fecha", "idpozo")),
    }, out, check)


def publish_sensors(raw: DataFrame, specs: DataFrame, out: str, base_url: str | None = None,
                    expected_classes: int | None = 10,
                    expected_wells: int | None = 40) -> dict[str, int]:
    """Publish lookup, catalog, wells and observations of raw sensor rows with their file path.

    The published rows are compared with the raw ones before the commit. The catalog's addresses
    begin with ``base_url``, by default the folder of the new version.
    """
    version = new_version()
    base_url = base_url or version_folder(out, version)
    cat.require_instances(raw)
    lookup = cat.event_lookup(specs)
    # One row per instance; kept, because wells, rules and parity all start from it.
    instances = keep(cat.instance_catalog(raw, lookup, base_url))
    wells = cat.real_wells(instances)
    observed = cat.observations(raw)
    sensor_gate(lookup, instances, wells, observed, expected_classes, expected_wells).enforce()

    def check(written: dict[str, DataFrame]) -> None:
        for name, contract in (("event_types", EVENT_TYPES), ("instances", INSTANCES),
                               ("wells", SENSOR_WELLS)):
            check_contract(written[name], contract)
        published = written["observations"].drop("instance")
        check_contract(conform(published, OBSERVATIONS), OBSERVATIONS)
        enforce_parity(parity_report(observed, written["instances"], written["wells"], published,
                                     cat.sensor_columns(published), expected_wells))

    return publish_together(raw.sparkSession, {
        "event_types": (lookup, _sorted_by("event_class")),
        "instances": (instances, _sorted_by("event_class", "instance_id")),
        "wells": (wells, _sorted_by("well_id")),
        "observations": (observed, lambda df, path: write_observations(df, path, instances=instances)),
    }, out, check, version)


def publish_field(daily: DataFrame, monthly: DataFrame, out: str) -> dict[str, int]:
    """Build the three field tables from their raw sheets and publish them behind their rules."""
    wells, facts = field_tables.field_wells(daily), field_tables.field_daily(daily)
    reported = field_tables.field_monthly(monthly)

    def check(written: dict[str, DataFrame]) -> None:
        for name, contract in (("wells", FIELD_WELLS), ("daily_production", FIELD_DAILY),
                               ("monthly_production", FIELD_MONTHLY)):
            check_contract(written[name], contract)
        field_gate(written["wells"], written["daily_production"],
                   written["monthly_production"]).enforce()

    return publish_together(daily.sparkSession, {
        "wells": (wells, _sorted_by("npd_wellbore_code")),
        "daily_production": (facts, _sorted_by("npd_wellbore_code", "date")),
        "monthly_production": (reported, _sorted_by("npd_wellbore_code", "date")),
    }, out, check)


def publish_logs(logs: DataFrame, out: str) -> dict[str, int]:
    """Publish well logs by dataset, sorted by well and depth, behind their rules, with a manifest."""
    def write(df: DataFrame, path: str) -> None:
        write_partitioned(df, path, ["dataset"], ["WELL", "DEPTH_MD"])
        write_manifest(df.sparkSession, path)

    def check(written: dict[str, DataFrame]) -> None:
        samples = conform(written["logs"], WELL_LOGS)
        check_contract(samples, WELL_LOGS)
        Gate([check_unique("depth is unique in a well", samples, ["WELL", "DEPTH_MD"]),
              check_label_mapping("lithology labels", samples, LITHOLOGY, LITHOLOGY_LABELS)]).enforce()

    return publish_together(logs.sparkSession, {"logs": (conform(logs, WELL_LOGS), write)}, out, check)
