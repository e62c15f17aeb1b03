"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "oil_by_bucket", "oil_rate_by_bucket", "top_basins", "yearly_totals", "active_wells_per_year",
    "interval_collapse", "interval_collapse_fine_grained", "transition_detect", "calendar_fill",
    "monthly_series", "operator_history", "state_events", "gap_audit", "cadence_breaks",
    "master_merge", "modal_attributes", "volatility_scan", "source_coverage", "field_agreement",
    "numeric_profile", "histogram_of_prices", "instance_catalog", "corpus_balance",
    "foreign_keys", "unique_keys", "parity_of_line_items", "parity_sensor_content_per_class",
    "density_neutron_crossover", "gamma_ray_bands", "mean_curves_per_well",
    "field_daily_totals", "cumulative_oil_by_well", "daily_against_monthly",
    "oil_statistics_by_well", "top_producing_days", "year_partitioned_publish",
)


def main() -> None:
    from wellspark.queries import QUERIES
    from wellspark.session import build_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session("bench", f"local[{cpus}]", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE

    def run(name: str) -> float:
        started = time.perf_counter()
        # Every column is computed and nothing is brought to the driver.
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    run(names[0])  # start-up is not part of any query
    seconds = {name: round(min(run(name), run(name)), 3) for name in names}
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
