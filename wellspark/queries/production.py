"""Production queries on the given tables."""

from pyspark.sql import functions as F

from wellspark.functions.columns import quoted
from wellspark.functions.units import IMPERIAL, SI
from wellspark.operators.profile import value_counts
from wellspark.plans import production as plans
from wellspark.queries.bindings import bound, table
from wellspark.queries.registry import query

_BOTH = ("monthly", "wells")
_BUCKET = "CASE WHEN tipo_recurso = 'NO CONVENCIONAL' THEN 'Unconv' ELSE 'Other' END"
_DAYS = "CAST(day(last_day(fecha)) AS DOUBLE)"


def _facts(spark, sf):
    return bound(spark, sf, "monthly"), bound(spark, sf, "wells")


def _bucket_sql(measure: str, expression: str, out: str) -> str:
    return f"""
SELECT fecha, bucket, {expression.format(f'CAST(sum({measure}) AS DOUBLE)')} AS {out}
FROM (SELECT *, {_BUCKET} AS bucket FROM monthly JOIN wells USING (idpozo))
GROUP BY fecha, bucket"""


@query("oil_by_bucket", _bucket_sql("prod_pet", "{}", "prod_pet_m3"), _BOTH)
def oil_by_bucket(spark, sf):
    return plans.oil_by_bucket(*_facts(spark, sf), SI)


@query("oil_rate_by_bucket", _bucket_sql(
    "prod_pet", "{} * 6.2898::DOUBLE / " + _DAYS, "oil_bbl_per_day"), _BOTH)
def oil_rate_by_bucket(spark, sf):
    return plans.oil_by_bucket(*_facts(spark, sf), IMPERIAL)


@query("gas_by_bucket", _bucket_sql("prod_gas", "{}", "prod_gas_mm3"), _BOTH)
def gas_by_bucket(spark, sf):
    return plans.gas_by_bucket(*_facts(spark, sf), SI)


@query("gas_rate_by_bucket", _bucket_sql(
    "prod_gas", "{} * 35314.7::DOUBLE / " + _DAYS, "gas_scf_per_day"), _BOTH)
def gas_rate_by_bucket(spark, sf):
    return plans.gas_by_bucket(*_facts(spark, sf), IMPERIAL)


@query("stacked_oil_series", f"""
WITH b AS (SELECT fecha, {_BUCKET} AS bucket, CAST(sum(prod_pet) AS DOUBLE) AS v
           FROM monthly JOIN wells USING (idpozo) GROUP BY ALL)
SELECT fecha, coalesce(sum(v) FILTER (bucket = 'Other') / 1e6, 0) AS Other,
       coalesce(sum(v) FILTER (bucket = 'Unconv') / 1e6, 0) AS Unconv
FROM b GROUP BY fecha""", _BOTH)
def stacked_oil_series(spark, sf):
    return plans.stacked_series(oil_by_bucket(spark, sf), SI.oil_column, SI.oil_scale)


@query("well_locations", f"""
SELECT coordenadax AS lon, coordenaday AS lat, {_BUCKET} AS bucket FROM wells
WHERE coordenadax BETWEEN 95 AND 160 AND coordenaday BETWEEN 5 AND 40""", ("wells",))
def well_locations(spark, sf):
    return plans.locations(bound(spark, sf, "wells"), (95, 160), (5, 40))


_BASINS = """
SELECT cuenca, CAST(sum(prod_pet) AS DOUBLE){oil} AS {a}, CAST(sum(prod_gas) AS DOUBLE){gas} AS {b}
FROM monthly JOIN wells USING (idpozo) WHERE cuenca IS NOT NULL
GROUP BY cuenca HAVING sum(prod_pet) > 1e6 ORDER BY sum(prod_pet) DESC, cuenca LIMIT 6"""


@query("top_basins", _BASINS.format(oil="", gas="", a="prod_pet_m3_total",
                                    b="prod_gas_mm3_total"), _BOTH)
def top_basins(spark, sf):
    return plans.top_basins(*_facts(spark, sf), SI)


@query("top_basins_imperial", _BASINS.format(
    oil=" * 6.2898::DOUBLE", gas=" * 35314.7::DOUBLE", a="oil_bbl_total", b="gas_scf_total"),
    _BOTH)
def top_basins_imperial(spark, sf):
    return plans.top_basins(*_facts(spark, sf), IMPERIAL)


@query("basins_relative_to_leader", "WITH t AS (" + _BASINS.format(
    oil="", gas="", a="prod_pet_m3_total", b="prod_gas_mm3_total") + """)
SELECT *, prod_pet_m3_total / max(prod_pet_m3_total) OVER () AS prod_pet_m3_total_share,
       prod_gas_mm3_total / max(prod_gas_mm3_total) OVER () AS prod_gas_mm3_total_share
FROM t""", _BOTH)
def basins_relative_to_leader(spark, sf):
    return plans.relative_to_leader(top_basins(spark, sf),
                                    ["prod_pet_m3_total", "prod_gas_mm3_total"])


_YEARLY = """
SELECT CAST(year(fecha) AS INT) AS anio, CAST(sum(prod_pet) AS DOUBLE) AS prod_pet,
       CAST(sum(prod_gas) AS DOUBLE) AS prod_gas, CAST(sum(prod_agua) AS DOUBLE) AS prod_agua
FROM monthly {} GROUP BY 1"""
_MEASURES = ["prod_pet", "prod_gas", "prod_agua"]


@query("yearly_totals", _YEARLY.format(""), ("monthly",))
def yearly_totals(spark, sf):
    return plans.yearly_totals(bound(spark, sf, "monthly"), _MEASURES)


@query("year_range_totals", _YEARLY.format("WHERE year(fecha) BETWEEN 1996 AND 1999"),
       ("monthly",))
def year_range_totals(spark, sf):
    return plans.yearly_totals(bound(spark, sf, "monthly"), _MEASURES, 1996, 1999)


@query("basin_totals_of_a_year", """
SELECT cuenca, CAST(sum(prod_pet) AS DOUBLE) AS prod_pet, CAST(sum(prod_gas) AS DOUBLE) AS prod_gas
FROM monthly JOIN wells USING (idpozo) WHERE year(fecha) = 1998 GROUP BY cuenca""", _BOTH)
def basin_totals_of_a_year(spark, sf):
    return plans.basin_totals(*_facts(spark, sf), 1998)


@query("active_wells_per_year", """
SELECT CAST(year(fecha) AS INT) AS anio, count(DISTINCT idpozo) AS n_wells
FROM monthly GROUP BY 1""", ("monthly",))
def active_wells_per_year(spark, sf):
    return plans.active_wells(bound(spark, sf, "monthly"))


def _register_wells_per(column: str, name: str) -> None:
    query(f"wells_per_{name}", f"""
SELECT {column}, count(*) AS n_wells FROM wells GROUP BY {column}
ORDER BY n_wells DESC, {column} NULLS FIRST LIMIT 20""", ("wells",))(
        lambda spark, sf: plans.wells_per(bound(spark, sf, "wells"), column))


_register_wells_per("cuenca", "basin")
_register_wells_per("provincia", "province")


@query("wells_per_resource_type", "SELECT tipo_recurso, count(*) AS n FROM wells GROUP BY ALL",
       ("wells",))
def wells_per_resource_type(spark, sf):
    return value_counts(bound(spark, sf, "wells"), "tipo_recurso")


@query("wells_per_classification", "SELECT clasificacion, count(*) AS n FROM wells GROUP BY ALL",
       ("wells",))
def wells_per_classification(spark, sf):
    return value_counts(bound(spark, sf, "wells"), "clasificacion")


@query("wells_with_coordinates", """
SELECT coordenadax, coordenaday FROM listing
WHERE coordenadax IS NOT NULL AND coordenaday IS NOT NULL""", ("listing",))
def wells_with_coordinates(spark, sf):
    return plans.located_wells(bound(spark, sf, "listing"))


@query("series_of_leading_well", """
SELECT idpozo, fecha, prod_pet::DOUBLE AS prod_pet FROM monthly WHERE idpozo = (
  SELECT idpozo FROM monthly GROUP BY idpozo ORDER BY sum(prod_pet) DESC, idpozo LIMIT 1)
""", ("monthly",))
def series_of_leading_well(spark, sf):
    monthly = bound(spark, sf, "monthly")
    return monthly.where(F.col("idpozo") == plans.leading_well(monthly)).select(
        "idpozo", "fecha", F.col("prod_pet").cast("double").alias("prod_pet")).orderBy("fecha")


@query("nation_totals", """
SELECT n_name, r_name, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
       count(*) AS n_orders
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
JOIN region ON r_regionkey = n_regionkey GROUP BY n_name, r_name""")
def nation_totals(spark, sf):
    per_customer = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"),
        F.count(F.lit(1)).alias("n_orders"))
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    per_nation = per_customer.join(customer, F.col("c_custkey") == F.col("o_custkey")).groupBy(
        "c_nationkey").agg(F.sum("total").alias("total"), F.sum("n_orders").alias("n_orders"))
    nation = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    return per_nation.join(nation, F.col("n_nationkey") == F.col("c_nationkey")).groupBy(
        "n_name", "r_name").agg(F.sum("total").cast("double").alias("total"),
                                F.sum("n_orders").alias("n_orders"))


@query("changed_against_registry", """
SELECT count(*) FILTER (a.cota IS DISTINCT FROM b.cota) AS cota_differs,
       count(*) FILTER (a.sigla IS NOT DISTINCT FROM b.sigla) AS sigla_same,
       count(*) AS wells
FROM registry a LEFT JOIN listing b USING (idpozo)""", ("registry", "listing"))
def changed_against_registry(spark, sf):
    columns = ["cota", "sigla"]
    listing = bound(spark, sf, "listing").select(
        "idpozo", *[F.col(c).alias(f"listed_{c}") for c in columns])
    joined = bound(spark, sf, "registry").select("idpozo", *columns).join(
        listing, "idpozo", "left")
    return joined.agg(
        F.count_if(~quoted("cota").eqNullSafe(F.col("listed_cota"))).alias("cota_differs"),
        F.count_if(quoted("sigla").eqNullSafe(F.col("listed_sigla"))).alias("sigla_same"),
        F.count(F.lit(1)).alias("wells"))
