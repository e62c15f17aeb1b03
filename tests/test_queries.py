"""Registered queries against their SQL on the smallest test tables."""

import os

import pytest
from comparing import connect, difference

import __spark_entry__ as entry_points
from wellspark import queries as tables

FOLDER = "/root/testdata/sf0.001"
# WELLSPARK_ALL=1 compares every query; the rest are variations of these.
SOME = """
oil_by_bucket gas_rate_by_bucket top_basins stacked_oil_series yearly_totals
interval_collapse_fine_grained transition_detect calendar_fill monthly_series operator_history
state_events gap_audit cadence_breaks master_merge modal_attributes volatility_scan
source_coverage field_agreement_repeated_keys field_agreement_across_types numeric_profile
numeric_profile_of_any_double operator_history_of_shared_months distribution_of_gap_count
instance_catalog well_footprint group_folds foreign_keys unique_keys
parity_sensor_content_per_class parity_time_spans gamma_ray_bands log_window
production_summary_by_well oil_statistics_by_well daily_against_monthly field_monthly_load
manifest_scan_of_years csv_scan_by_name merged_schema_scan
""".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")
QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_of_tables_has_sql():
    assert set(tables.ORACLES) == set(tables.QUERIES) and set(SOME) <= set(tables.QUERIES)
    assert set(ORACLES) <= set(QUERIES) and set(tables.QUERIES) <= set(QUERIES)


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["fecha", "bucket", "prod_pet_m3"] and df.count() > 0


@pytest.mark.parametrize("name", list(ORACLES) if os.environ.get("WELLSPARK_ALL") else SOME)
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, FOLDER), con, ORACLES[name]) is None
