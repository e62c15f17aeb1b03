"""Field-production queries on the given orders and customers."""

from pyspark.sql import functions as F

from wellspark.plans import field as plans
from wellspark.plans import field_tables
from wellspark.queries.bindings import bound, table
from wellspark.queries.registry import query

_DAILY = ("field_daily",)
_BOTH = ("field_daily", "field_wells")
_ALL3 = "oil_volume IS NOT NULL AND gas_volume IS NOT NULL AND water_volume IS NOT NULL"
_TOTALS = """CAST(sum(oil_volume) AS DOUBLE) AS total_oil,
 CAST(sum(gas_volume) AS DOUBLE) AS total_gas, CAST(sum(water_volume) AS DOUBLE) AS total_water"""
_JOINED = "field_daily JOIN field_wells USING (npd_wellbore_code)"


def _daily(spark, sf):
    return bound(spark, sf, "field_daily")


def _pair(spark, sf):
    return bound(spark, sf, "field_daily"), bound(spark, sf, "field_wells")


def _plain(df, *columns):
    """Exact decimals as doubles, for comparison."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


@query("field_daily_totals", f"SELECT date, {_TOTALS} FROM field_daily WHERE {_ALL3} "
       "GROUP BY date", _DAILY)
def field_daily_totals(spark, sf):
    return plans.daily_totals(_daily(spark, sf))


@query("field_cumulative_totals", f"SELECT {_TOTALS} FROM field_daily WHERE {_ALL3}", _DAILY)
def field_cumulative_totals(spark, sf):
    return plans.cumulative_totals(_daily(spark, sf))


@query("field_liquid_shares", f"""
SELECT total_oil / (total_oil + total_water) AS oil_share,
       total_water / (total_oil + total_water) AS water_share
FROM (SELECT {_TOTALS} FROM field_daily WHERE {_ALL3})""", _DAILY)
def field_liquid_shares(spark, sf):
    return plans.liquid_shares(_daily(spark, sf))


_CUMULATIVE = f"""SELECT wellbore_name, CAST(sum(oil_volume) AS DOUBLE) AS cumulative_oil
FROM {_JOINED} WHERE oil_volume IS NOT NULL GROUP BY wellbore_name"""


@query("cumulative_oil_by_well", _CUMULATIVE, _BOTH)
def cumulative_oil_by_well(spark, sf):
    return plans.cumulative_oil(*_pair(spark, sf))


@query("leading_wells", _CUMULATIVE + " ORDER BY cumulative_oil DESC, wellbore_name LIMIT 15",
       _BOTH)
def leading_wells(spark, sf):
    return plans.leading_wells(*_pair(spark, sf))


@query("field_history", f"""
SELECT wellbore_name, date, CAST(oil_volume AS DOUBLE) AS oil_volume,
       CAST(gas_volume AS DOUBLE) AS gas_volume, CAST(water_volume AS DOUBLE) AS water_volume
FROM {_JOINED}""", _BOTH)
def field_history(spark, sf):
    return _plain(plans.joined_history(*_pair(spark, sf)), *plans.VOLUMES)


_LEADER = ("SELECT wellbore_name FROM (" + _CUMULATIVE
           + ") ORDER BY cumulative_oil DESC, wellbore_name LIMIT 1")


@query("first_days_of_leading_well", f"""
SELECT wellbore_name, date, CAST(oil_volume AS DOUBLE) AS oil_volume,
       CAST(gas_volume AS DOUBLE) AS gas_volume, CAST(water_volume AS DOUBLE) AS water_volume
FROM {_JOINED} WHERE wellbore_name = ({_LEADER})
ORDER BY date, wellbore_name, oil_volume NULLS FIRST, gas_volume NULLS FIRST,
         water_volume NULLS FIRST LIMIT 10""", _BOTH)
def first_days_of_leading_well(spark, sf):
    daily, wells = _pair(spark, sf)
    leader = plans.leading_wells(daily, wells, 1).select("wellbore_name").scalar()
    return _plain(plans.first_days(daily, wells, leader, 10), *plans.VOLUMES)


@query("monthly_rollup_of_daily", f"""
SELECT npd_wellbore_code, strftime(date, '%Y-%m') AS year_month, {_TOTALS}
FROM field_daily GROUP BY 1, 2""", _DAILY)
def monthly_rollup_of_daily(spark, sf):
    return plans.monthly_rollup(_daily(spark, sf))


@query("production_summary_by_well", """
SELECT wellbore_name, count(DISTINCT date) AS days_producing,
       CAST(sum(oil_volume) AS DOUBLE) AS total_oil,
       CAST(sum(gas_volume) AS DOUBLE) AS total_gas,
       CAST(sum(oil_volume) AS DOUBLE) / nullif(count(oil_volume), 0) AS avg_daily_oil
FROM field_wells LEFT JOIN field_daily USING (npd_wellbore_code) GROUP BY wellbore_name""", _BOTH)
def production_summary_by_well(spark, sf):
    return plans.production_summary(*_pair(spark, sf), decimals=None)


@query("top_producing_days", f"""
SELECT wellbore_name, date, CAST(oil_volume AS DOUBLE) AS oil_volume,
       CAST(gas_volume AS DOUBLE) AS gas_volume
FROM {_JOINED} WHERE oil_volume IS NOT NULL
ORDER BY field_daily.oil_volume DESC, date, wellbore_name, field_daily.gas_volume LIMIT 10""",
       _BOTH)
def top_producing_days(spark, sf):
    return plans.top_days(*_pair(spark, sf), 10)


@query("injection_wells", f"""
SELECT DISTINCT wellbore_name, well_type FROM {_JOINED} WHERE well_type = 'WI'""", _BOTH)
def injection_wells(spark, sf):
    return plans.wells_of_type(*_pair(spark, sf))


@query("production_by_year", """
SELECT strftime(date, '%Y') AS year, round(CAST(sum(oil_volume) AS DOUBLE), 2) AS total_oil,
       round(CAST(sum(gas_volume) AS DOUBLE), 2) AS total_gas,
       round(CAST(sum(water_volume) AS DOUBLE), 2) AS total_water
FROM field_daily GROUP BY 1""", _DAILY)
def production_by_year(spark, sf):
    return plans.yearly_production(_daily(spark, sf))


@query("well_comparison_of_a_year", f"""
SELECT wellbore_name, count(*) AS days_active, CAST(sum(oil_volume) AS DOUBLE) AS oil,
       CAST(sum(gas_volume) AS DOUBLE) AS gas
FROM {_JOINED} WHERE year(date) = 1998 AND oil_volume IS NOT NULL GROUP BY 1""", _BOTH)
def well_comparison_of_a_year(spark, sf):
    return plans.well_comparison(*_pair(spark, sf), 1998)


@query("monthly_trend", """
SELECT wellbore_name, date, CAST(oil_volume_sm3 AS DOUBLE) AS oil_volume_sm3,
       CAST(gas_volume_sm3 AS DOUBLE) AS gas_volume_sm3,
       CAST(water_volume_sm3 AS DOUBLE) AS water_volume_sm3
FROM field_reported JOIN field_wells USING (npd_wellbore_code)
WHERE oil_volume_sm3 IS NOT NULL""", ("field_reported", "field_wells"))
def monthly_trend(spark, sf):
    trend = plans.monthly_trend(bound(spark, sf, "field_reported"),
                                bound(spark, sf, "field_wells"))
    return _plain(trend, "oil_volume_sm3", "gas_volume_sm3", "water_volume_sm3")


@query("daily_against_monthly", """
SELECT npd_wellbore_code, date, CAST(d.oil AS DOUBLE) AS daily_oil,
       CAST(m.oil AS DOUBLE) AS monthly_oil, CAST(d.gas AS DOUBLE) AS daily_gas,
       CAST(m.gas AS DOUBLE) AS monthly_gas, CAST(d.oil - m.oil AS DOUBLE) AS oil_difference,
       CAST(d.gas - m.gas AS DOUBLE) AS gas_difference
FROM (SELECT npd_wellbore_code, CAST(date_trunc('month', date) AS DATE) AS date,
             sum(oil_volume) AS oil, sum(gas_volume) AS gas FROM field_daily GROUP BY 1, 2) d
FULL JOIN (SELECT npd_wellbore_code, date, sum(oil_volume_sm3) AS oil,
                  sum(gas_volume_sm3) AS gas FROM field_reported GROUP BY 1, 2) m
USING (npd_wellbore_code, date)""", ("field_daily", "field_reported"))
def daily_against_monthly(spark, sf):
    compared = plans.daily_against_monthly(_daily(spark, sf), bound(spark, sf, "field_reported"))
    return _plain(compared, "daily_oil", "monthly_oil", "daily_gas", "monthly_gas",
                  "oil_difference", "gas_difference")


@query("well_summary", """
SELECT npd_wellbore_code, CAST(sum(oil_volume) AS DOUBLE) AS total_oil,
       CAST(sum(gas_volume) AS DOUBLE) AS total_gas, count(date) AS days_producing
FROM field_daily WHERE oil_volume IS NOT NULL GROUP BY 1""", _DAILY)
def well_summary(spark, sf):
    return plans.well_summary(_daily(spark, sf))


@query("oil_statistics_by_well", f"""
SELECT wellbore_name, CAST(sum(oil_volume) AS DOUBLE) AS total_oil,
       CAST(sum(oil_volume) AS DOUBLE) / count(*) AS avg_oil,
       round(quantile_cont(CAST(oil_volume AS DOUBLE), 0.5), 6) AS median_oil
FROM {_JOINED} WHERE oil_volume IS NOT NULL GROUP BY 1""", _BOTH)
def oil_statistics_by_well(spark, sf):
    return plans.oil_statistics(*_pair(spark, sf)).withColumn("median_oil", F.round("median_oil", 6))


# Raw sheets, as text where the source has text.
_RAW_DAILY = """raw AS (
  SELECT CAST(o_orderdate AS DATE) AS "DATEPRD", CAST(o_custkey AS INT) AS "NPD_WELL_BORE_CODE",
    'NO ' || c_custkey AS "WELL_BORE_CODE", c_name AS "NPD_WELL_BORE_NAME",
    c_nationkey AS "NPD_FIELD_CODE", n_name AS "NPD_FIELD_NAME",
    n_regionkey AS "NPD_FACILITY_CODE", 'Facility ' || n_regionkey AS "NPD_FACILITY_NAME",
    o_totalprice AS "BORE_OIL_VOL", o_orderstatus AS "FLOW_KIND"
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey)"""
_ABSENT = ("ON_STREAM_HRS AVG_DOWNHOLE_PRESSURE AVG_DP_TUBING AVG_ANNULUS_PRESS AVG_WHP_P "
           "AVG_DOWNHOLE_TEMPERATURE AVG_WHT_P AVG_CHOKE_SIZE_P DP_CHOKE_SIZE BORE_GAS_VOL "
           "BORE_WAT_VOL BORE_WI_VOL").split()


def _raw_daily(spark, sf):
    joined = (
        table(spark, sf, "orders")
        .join(table(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey"))
        .join(table(spark, sf, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    )
    return joined.select(
        F.to_date("o_orderdate").alias("DATEPRD"), F.col("o_custkey").alias("NPD_WELL_BORE_CODE"),
        F.concat(F.lit("NO "), F.col("c_custkey")).alias("WELL_BORE_CODE"),
        F.col("c_name").alias("NPD_WELL_BORE_NAME"),
        F.col("c_nationkey").alias("NPD_FIELD_CODE"), F.col("n_name").alias("NPD_FIELD_NAME"),
        F.col("n_regionkey").alias("NPD_FACILITY_CODE"),
        F.concat(F.lit("Facility "), F.col("n_regionkey")).alias("NPD_FACILITY_NAME"),
        F.col("o_totalprice").alias("BORE_OIL_VOL"), F.col("o_orderstatus").alias("FLOW_KIND"),
        F.lit("%").alias("AVG_CHOKE_UOM"), F.lit("production").alias("WELL_TYPE"),
        *[F.lit(None).cast("double").alias(c) for c in _ABSENT])


@query("field_wells_extraction", "WITH " + _RAW_DAILY + """
SELECT DISTINCT "NPD_WELL_BORE_CODE" AS npd_wellbore_code, "WELL_BORE_CODE" AS wellbore_code,
  "NPD_WELL_BORE_NAME" AS wellbore_name, "NPD_FIELD_CODE" AS npd_field_code,
  "NPD_FIELD_NAME" AS npd_field_name, "NPD_FACILITY_CODE" AS npd_facility_code,
  "NPD_FACILITY_NAME" AS npd_facility_name FROM raw""")
def field_wells_extraction(spark, sf):
    return field_tables.field_wells(_raw_daily(spark, sf))


@query("field_daily_load", "WITH " + _RAW_DAILY + """
SELECT "DATEPRD" AS date, "NPD_WELL_BORE_CODE" AS npd_wellbore_code,
  "BORE_OIL_VOL" AS oil_volume, "FLOW_KIND" AS flow_kind, 'production' AS well_type FROM raw""")
def field_daily_load(spark, sf):
    return field_tables.field_daily(_raw_daily(spark, sf)).select(
        "date", "npd_wellbore_code", "oil_volume", "flow_kind", "well_type")


@query("field_daily_load_from_text", "WITH " + _RAW_DAILY + """
SELECT CASE WHEN "FLOW_KIND" = 'P' THEN NULL ELSE "DATEPRD" END AS date, "NPD_WELL_BORE_CODE" AS npd_wellbore_code,
  "BORE_OIL_VOL" AS oil_volume FROM raw""")
def field_daily_load_from_text(spark, sf):
    # Dates as days or times in text; those of kind P are no dates.
    kind, day = F.col("FLOW_KIND"), F.col("DATEPRD").cast("string")
    text = F.when(kind == "P", "31-Foo").when(kind == "F", F.concat(day, F.lit(" 00:00:00"))).otherwise(day)
    return field_tables.field_daily(_raw_daily(spark, sf).withColumn("DATEPRD", text)).select(
        "date", "npd_wellbore_code", "oil_volume")


@query("field_monthly_load", """
SELECT make_date(CAST(year(o_orderdate) AS INT), CAST(month(o_orderdate) AS INT), 1) AS date,
  CAST(o_custkey AS INT) AS npd_wellbore_code, CAST(NULL AS DOUBLE) AS on_stream_hours,
  CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_totalprice END AS oil_volume_sm3,
  CAST(o_orderkey AS DOUBLE) AS gas_volume_sm3, CAST(NULL AS DOUBLE) AS water_volume_sm3,
  CAST(NULL AS DOUBLE) AS gas_injection_sm3, CAST(NULL AS DOUBLE) AS water_injection_sm3
FROM orders WHERE o_orderpriority <> '5-LOW' AND o_orderstatus <> 'P'""")
def field_monthly_load(spark, sf):
    # Low-priority orders play the units row, orders of status P lack a well code.
    units = F.col("o_orderpriority") == "5-LOW"
    raw = table(spark, sf, "orders").select(
        F.when(units, "Sm3").otherwise(F.year("o_orderdate").cast("string")).alias("Year"),
        F.when(units, "Sm3").otherwise(F.month("o_orderdate").cast("string")).alias("Month"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey").cast("string"))
        .alias("NPDCode"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "n/a")
        .otherwise(F.col("o_totalprice").cast("string")).alias("Oil"),
        F.col("o_orderkey").cast("string").alias("Gas"),
        *[F.lit(None).cast("string").alias(c) for c in ("On Stream", "Water", "GI", "WI")])
    return field_tables.field_monthly(raw)
