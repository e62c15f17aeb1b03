"""Profiles and reconciliations of the given tables."""

from pyspark.sql import functions as F

from wellspark.contracts import EXPECTED_BUCKETS
from wellspark.functions.columns import file_slug
from wellspark.operators import profile as ops
from wellspark.operators.master import modal_attributes
from wellspark.operators.quantiles import exact_quantiles
from wellspark.plans import well_tables
from wellspark.queries.bindings import bound, table
from wellspark.queries.registry import query

_VOLATILITY = " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, '{b}' AS expected_bucket,
       count(*) FILTER (n_values > 1) AS entities_with_change,
       count(*) FILTER (n_rows > 0) AS entities_with_value, count(*) AS total_entities,
       round(CAST(count(*) FILTER (n_values > 1) AS DOUBLE) * 100.0
             / nullif(count(*) FILTER (n_rows > 0), 0), 3) AS pct_changed
FROM (SELECT idpozo, count(DISTINCT {c}) AS n_values, count({c}) AS n_rows
      FROM production GROUP BY idpozo)""" for c, b in EXPECTED_BUCKETS.items())


@query("volatility_scan", _VOLATILITY, ("production",))
def volatility_scan(spark, sf):
    return ops.volatility(bound(spark, sf, "production"), "idpozo", EXPECTED_BUCKETS)


@query("volatility_of_orders", " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, 'event' AS expected_bucket,
       count(*) FILTER (n > 1) AS entities_with_change,
       count(*) FILTER (n > 0) AS entities_with_value, count(*) AS total_entities,
       round(CAST(count(*) FILTER (n > 1) AS DOUBLE) * 100.0 / count(*) FILTER (n > 0), 3)
         AS pct_changed
FROM (SELECT o_custkey, count(DISTINCT {c}) AS n FROM orders GROUP BY o_custkey)"""
    for c in ("o_orderstatus", "o_orderpriority", "o_orderdate", "o_totalprice")))
def volatility_of_orders(spark, sf):
    return ops.volatility(
        table(spark, sf, "orders"), "o_custkey",
        dict.fromkeys(["o_orderstatus", "o_orderpriority", "o_orderdate", "o_totalprice",
                       "not_there"], "event"))


def _three(spark, sf):
    return {n: bound(spark, sf, n) for n in ("registry", "listing", "production")}


@query("source_coverage", """
WITH p AS (SELECT DISTINCT idpozo FROM production)
SELECT 'registry' AS source, count(*) AS row_count, count(DISTINCT idpozo) AS distinct_keys
FROM registry
UNION ALL SELECT 'listing', count(*), count(DISTINCT idpozo) FROM listing
UNION ALL SELECT 'production', count(*), count(DISTINCT idpozo) FROM production
UNION ALL SELECT 'registry_AND_listing', NULL, count(DISTINCT idpozo)
  FROM registry JOIN listing USING (idpozo)
UNION ALL SELECT 'registry_AND_production', NULL, count(DISTINCT idpozo)
  FROM registry JOIN p USING (idpozo)
UNION ALL SELECT 'listing_AND_production', NULL, count(DISTINCT idpozo)
  FROM listing JOIN p USING (idpozo)""", ("registry", "listing", "production"))
def source_coverage(spark, sf):
    return ops.coverage(_three(spark, sf), "idpozo")


_REGISTRY_LISTING = ["clasificacion", "cota", "cuenca", "profundidad", "provincia", "sigla"]


@query("field_agreement", " UNION ALL ".join(f"""
SELECT '{c}' AS column_name,
       count(*) FILTER (a.{c} IS NOT DISTINCT FROM b.{c}) AS agreement_count,
       count(*) FILTER (a.{c} IS DISTINCT FROM b.{c}) AS disagreement_count,
       count(*) AS overlap_count
FROM registry a JOIN listing b USING (idpozo)""" for c in _REGISTRY_LISTING),
       ("registry", "listing"))
def field_agreement(spark, sf):
    return ops.field_agreement(bound(spark, sf, "registry"), bound(spark, sf, "listing"),
                               "idpozo")


@query("field_agreement_repeated_keys", " UNION ALL ".join(f"""
SELECT '{c}' AS column_name,
       count(*) FILTER (a.{c} IS NOT DISTINCT FROM b.{c}) AS agreement_count,
       count(*) FILTER (a.{c} IS DISTINCT FROM b.{c}) AS disagreement_count,
       count(*) AS overlap_count
FROM (SELECT o_custkey AS key, o_orderstatus AS status, year(o_orderdate) AS y FROM orders) a
JOIN (SELECT user_id AS key, CASE WHEN value < 30 THEN 'F' ELSE 'O' END AS status,
             1990 + user_id % 10 AS y FROM events) b USING (key)""" for c in ("status", "y")))
def field_agreement_repeated_keys(spark, sf):
    a = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("key"), F.col("o_orderstatus").alias("status"),
        F.year("o_orderdate").cast("long").alias("y"))
    b = table(spark, sf, "events").select(
        F.col("user_id").alias("key"),
        F.when(F.col("value") < 30, "F").otherwise("O").alias("status"),
        (F.lit(1990) + F.col("user_id") % 10).cast("long").alias("y"))
    return ops.field_agreement(a, b, "key")


@query("field_agreement_across_types", " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, count(*) FILTER (a.{c} IS NOT DISTINCT FROM b.{c}) AS agreement_count,
       count(*) FILTER (a.{c} IS DISTINCT FROM b.{c}) AS disagreement_count, count(*) AS overlap_count
FROM (SELECT o_orderkey AS key, CAST(o_custkey % 3 AS DOUBLE) AS whole, CAST(o_orderdate AS TIMESTAMP) AS at,
        0.0::DOUBLE AS zero FROM orders) a
JOIN (SELECT o_orderkey AS key, CAST(o_custkey % 3 + o_orderkey % 2 AS DOUBLE) AS whole,
        CAST(o_orderdate AS DATE) + CAST(o_orderkey % 2 AS INT) AS at, 0.0::DOUBLE AS zero FROM orders) b
USING (key)""" for c in ("whole", "at", "zero")))
def field_agreement_across_types(spark, sf):
    orders, odd = table(spark, sf, "orders"), (F.col("o_orderkey") % 2).cast("int")
    day = F.col("o_orderdate").cast("date")
    a = orders.select(F.col("o_orderkey").alias("key"), (F.col("o_custkey") % 3).cast("double").alias("whole"),
                      day.cast("timestamp_ntz").alias("at"), F.lit(-0.0).alias("zero"))
    b = orders.select(F.col("o_orderkey").alias("key"), (F.col("o_custkey") % 3 + odd).cast("int").alias("whole"),
                      F.date_add(day, odd).alias("at"), F.lit(0).alias("zero"))
    return ops.field_agreement(a, b, "key")


@query("production_only_wells", """
SELECT DISTINCT idpozo FROM production
WHERE idpozo NOT IN (SELECT idpozo FROM registry)""", ("production", "registry"))
def production_only_wells(spark, sf):
    return ops.keys_only_in(bound(spark, sf, "production"), bound(spark, sf, "registry"),
                            "idpozo")


@query("registry_only_wells", """
SELECT idpozo, sigla FROM registry
WHERE idpozo NOT IN (SELECT idpozo FROM production)""", ("production", "registry"))
def registry_only_wells(spark, sf):
    return ops.rows_only_in(bound(spark, sf, "registry"), bound(spark, sf, "production"),
                            "idpozo", ["sigla"])


_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def _profile_sql(columns: list[str], source: str) -> str:
    # Ten digits of each figure, so that the order of additions does not matter.
    return " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, count(x) AS n, printf('%.9e', avg(x)) AS mean, printf('%.9e', stddev_samp(x)) AS std,
       min(x) AS min, printf('%.9e', quantile_cont(x, 0.25)) AS q25, printf('%.9e', quantile_cont(x, 0.5)) AS q50,
       printf('%.9e', quantile_cont(x, 0.75)) AS q75, max(x) AS max
FROM (SELECT CAST({c} AS DOUBLE) AS x FROM {source}) WHERE x IS NOT NULL AND NOT isnan(x)""" for c in columns)


def _digits(df, columns):
    return df.withColumns({c: F.format_string("%.9e", F.col(c)) for c in columns})


@query("numeric_profile", _profile_sql(_NUMBERS, "lineitem"))
def numeric_profile(spark, sf):
    profile = ops.numeric_profile(table(spark, sf, "lineitem").select(*_NUMBERS))
    return _digits(profile, ["mean", "std", "q25", "q50", "q75"])


# Many decimals, very large values as of a failed sensor, and values that are no numbers.
_ODD = ["fine", "large", "broken"]


@query("numeric_profile_of_any_double", _profile_sql(_ODD, """(
  SELECT l_extendedprice / 7e6 AS fine, CASE WHEN l_quantity = 50 THEN l_extendedprice * 1e37 ELSE l_discount / 3 END AS large,
         CASE WHEN l_quantity < 5 THEN 'NaN'::DOUBLE WHEN l_quantity > 45 THEN NULL ELSE -l_tax / 3 END AS broken FROM lineitem)"""))
def numeric_profile_of_any_double(spark, sf):
    q = F.col("l_quantity")
    odd = table(spark, sf, "lineitem").select(
        (F.col("l_extendedprice") / F.lit(7e6)).alias("fine"),
        F.when(q == 50, F.col("l_extendedprice") * F.lit(1e37)).otherwise(F.col("l_discount") / 3).alias("large"),
        F.when(q < 5, float("nan")).when(q <= 45, -F.col("l_tax") / 3).alias("broken"))
    return _digits(ops.numeric_profile(odd), ["mean", "std", "q25", "q50", "q75"])


_SPARSE = ["prod_gas", "iny_gas", "iny_co2", "iny_otro", "tipoextraccion", "provincia"]


@query("missing_cells", " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, count({c}) AS n_present, count(*) - count({c}) AS n_missing,
       round(CAST(count(*) - count({c}) AS DOUBLE) * 100.0 / count(*), 2) AS pct_missing
FROM production""" for c in _SPARSE), ("production",))
def missing_cells(spark, sf):
    return ops.missing(bound(spark, sf, "production"), _SPARSE)


@query("time_ranges", """
SELECT 'l_shipdate' AS column_name, CAST(min(l_shipdate) AS DATE) AS first_day,
       CAST(max(l_shipdate) AS DATE) AS last_day FROM lineitem""")
def time_ranges(spark, sf):
    return ops.time_ranges(table(spark, sf, "lineitem"))


@query("corpus_stats", """
SELECT 'rows' AS metric, CAST(NULL AS VARCHAR) AS item, count(*) AS n FROM logs
UNION ALL SELECT 'entities', NULL, count(DISTINCT WELL) FROM logs
UNION ALL SELECT 'label', CAST(lithology AS VARCHAR), count(*) FROM logs GROUP BY lithology
UNION ALL SELECT 'split', dataset, count(*) FROM logs GROUP BY dataset""", ("logs",))
def corpus_stats(spark, sf):
    return ops.corpus_stats(bound(spark, sf, "logs"), "WELL", "lithology", "dataset")


@query("corpus_stats_with_files", """
SELECT 'rows' AS metric, CAST(NULL AS VARCHAR) AS item, count(*) AS n FROM documents
UNION ALL SELECT 'entities', NULL, count(DISTINCT source) FROM documents
UNION ALL SELECT 'label', lang, count(*) FROM documents GROUP BY lang
UNION ALL SELECT 'split', CAST(quality AS VARCHAR), count(*)
  FROM documents LEFT JOIN labels USING (doc_id) GROUP BY quality
UNION ALL SELECT 'files', NULL, count(DISTINCT lang || '/' || source) FROM documents""")
def corpus_stats_with_files(spark, sf):
    documents = table(spark, sf, "documents").select(
        "doc_id", "source", "lang", F.concat("lang", F.lit("/"), "source").alias("file"))
    labelled = documents.join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id",
                              "left")
    return ops.corpus_stats(labelled, "source", "lang", "quality", "file")


@query("value_distribution", """
SELECT tipoextraccion, count(*) AS n FROM production GROUP BY tipoextraccion""", ("production",))
def value_distribution(spark, sf):
    return ops.value_counts(bound(spark, sf, "production"), "tipoextraccion")


@query("label_distribution", "SELECT quality, toxic, count(*) AS n FROM labels GROUP BY ALL")
def label_distribution(spark, sf):
    return table(spark, sf, "labels").groupBy("quality", "toxic").agg(
        F.count(F.lit(1)).alias("n"))


@query("exact_quantiles_per_group", """
SELECT o_orderpriority, printf('%.9e', quantile_cont(o_totalprice, 0.5)) AS median,
       printf('%.9e', quantile_cont(o_totalprice, 0.25)) AS lower
FROM orders GROUP BY o_orderpriority""")
def exact_quantiles_per_group(spark, sf):
    return _digits(exact_quantiles(table(spark, sf, "orders"), ["o_orderpriority"], "o_totalprice",
                                   {"median": 0.5, "lower": 0.25}), ["median", "lower"])


def _histogram_sql(values: str, bins: str) -> str:
    return f"""
WITH v AS ({values}),
shape AS (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
                 CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi,
                 CAST({bins} AS INT) AS bins FROM v),
filled AS (SELECT CAST(least(floor((x - lo) / (hi - lo) * bins), bins - 1) AS INT) AS bin,
                  count(*) AS n FROM v, shape GROUP BY 1),
spine AS (SELECT CAST(unnest(range(bins)) AS INT) AS bin, lo, (hi - lo) / bins AS width FROM shape)
SELECT bin, lo + bin * width AS bin_from, lo + (bin + 1) * width AS bin_to,
       coalesce(n, 0) AS n FROM spine LEFT JOIN filled USING (bin)"""


@query("histogram_of_prices",
       _histogram_sql("SELECT o_totalprice AS x FROM orders", "30"))
def histogram_of_prices(spark, sf):
    return ops.histogram(table(spark, sf, "orders"), "o_totalprice", 30)


def _distinct_sql(column: str) -> str:
    return (f"SELECT CAST(count(DISTINCT {column}) AS DOUBLE) AS x FROM production "
            f"WHERE {column} IS NOT NULL GROUP BY idpozo")


def _register_change_distribution(column: str) -> None:
    from wellspark.plans.production import change_distribution

    query(f"distribution_of_distinct_{column}",
          _histogram_sql(_distinct_sql(column), "least(greatest(floor(max(x)), 1), 20)"),
          ("production",))(
        lambda spark, sf: change_distribution(bound(spark, sf, "production"), column))


for _column in ("idempresa", "tipoestado", "tipoextraccion"):
    _register_change_distribution(_column)


def _register_gap_distribution(metric: str) -> None:
    from wellspark.plans.production import gap_distribution

    expression = {"gap_count": "date_diff('month', min(fecha), max(fecha)) + 1 - count(*)",
                  "longest_gap_months": "coalesce(max(step) - 1, 0)"}[metric]
    values = f"""
    SELECT CAST({expression} AS DOUBLE) AS x FROM (
      SELECT idpozo, fecha, date_diff('month', lag(fecha) OVER (PARTITION BY idpozo
             ORDER BY fecha), fecha) AS step
      FROM (SELECT DISTINCT idpozo, fecha FROM order_months)) GROUP BY idpozo"""
    query(f"distribution_of_{metric}", _histogram_sql(values, "30"), ("order_months",))(
        lambda spark, sf: gap_distribution(bound(spark, sf, "order_months"), metric))


for _metric in ("gap_count", "longest_gap_months"):
    _register_gap_distribution(_metric)


@query("modal_attributes", """
WITH counted AS (
  SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority)
           AS rn FROM counted),
statuses AS (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders
             WHERE o_orderstatus <> 'P' GROUP BY ALL),
status_rank AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC,
                o_orderstatus) AS rn FROM statuses),
years AS (SELECT o_custkey, year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY ALL),
year_rank AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, y) AS rn
              FROM years)
SELECT a.o_custkey, a.o_orderpriority AS priority, b.o_orderstatus AS status, c.y AS year
FROM (SELECT * FROM ranked WHERE rn = 1) a
LEFT JOIN (SELECT * FROM status_rank WHERE rn = 1) b USING (o_custkey)
LEFT JOIN (SELECT * FROM year_rank WHERE rn = 1) c USING (o_custkey)""")
def modal_attributes_of_orders(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_custkey", "o_orderpriority", F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.year("o_orderdate").cast("long").alias("y"))
    return modal_attributes(orders, "o_custkey", {
        "priority": "o_orderpriority", "status": "status", "year": "y"})


def _mode_sql(out: str, column: str) -> str:
    return f"""m_{out} AS (SELECT idpozo, {column} AS {out} FROM (
      SELECT idpozo, {column}, row_number() OVER (PARTITION BY idpozo
             ORDER BY count(*) DESC, {column}) AS rn
      FROM production WHERE {column} IS NOT NULL GROUP BY idpozo, {column}) WHERE rn = 1)"""


def _master_sql() -> str:
    prefix = {"registry": "c", "listing": "l"}
    columns = []
    for out, references in well_tables.MASTER_RULES.items():
        parts = []
        for reference in references:
            source, column = reference.split(".")
            parts.append(f"m_{out}.{out}" if source == "production"
                         else f"{prefix[source]}.{column}")
        columns.append(f"coalesce({', '.join(parts)}) AS {out}")
    modes = ", ".join(_mode_sql(o, c) for o, c in well_tables.PRODUCTION_MODES.items())
    joins = " ".join(f"LEFT JOIN m_{o} ON m_{o}.idpozo = a.idpozo"
                     for o in well_tables.PRODUCTION_MODES)
    return f"""
WITH {modes}, produced AS (SELECT DISTINCT idpozo FROM production),
a AS (SELECT idpozo FROM registry UNION SELECT idpozo FROM produced)
SELECT a.idpozo, {', '.join(columns)}, p.idpozo IS NOT NULL AS has_production
FROM a LEFT JOIN registry c ON c.idpozo = a.idpozo LEFT JOIN listing l ON l.idpozo = a.idpozo
LEFT JOIN produced p ON p.idpozo = a.idpozo {joins}"""


@query("master_merge", _master_sql(), ("registry", "listing", "production"))
def master_merge(spark, sf):
    merged = well_tables.well_master(bound(spark, sf, "registry"), bound(spark, sf, "listing"),
                                     bound(spark, sf, "production"))
    return merged.withColumn("geom", F.hex("geom"))


@query("wells_without_audit_columns", """
SELECT DISTINCT p_brand || '/' || p_type AS kind,
       translate(p_brand || '/' || p_type || ' x', '/ ', '-_') AS slug FROM part""")
def wells_without_audit_columns(spark, sf):
    kind = F.concat("p_brand", F.lit("/"), "p_type")
    return table(spark, sf, "part").drop("p_name", "p_size", "p_retailprice").select(
        kind.alias("kind"), file_slug(F.concat(kind, F.lit(" x"))).alias("slug")).distinct()
