"""Catalog queries on sensor rows made of the given events."""

from pyspark.sql import functions as F

from wellspark.operators import catalog as ops
from wellspark.operators.splits import leave_one_out
from wellspark.plans import sensors as plans
from wellspark.queries.bindings import bound
from wellspark.queries.registry import query

BASE_URL = "https://example.org/sensors"

# A path is cut at its slashes and its file name at the first sign that ends the prefix. {side}
# names the rows made of {source}.
PROVENANCE = """
{side} AS (
  SELECT cut.* EXCLUDE (file_path, parts, words), parts[-1] AS source_file,
    array_to_string(string_split(parts[-1], '.')[:-2], '.') AS instance_id,
    CASE WHEN parts[-3] = 'dataset' THEN TRY_CAST(parts[-2] AS INT) END AS event_class,
    known.label AS well_kind,
    CASE known.label WHEN 'real' THEN TRY_CAST(words[2] AS INT) END AS well_id
  FROM (SELECT *, string_split(file_path, '/') AS parts,
          string_split(translate(string_split(file_path, '/')[-1], '-', '_'), '_') AS words
        FROM {source}) cut
  LEFT JOIN (VALUES ('WELL', 'real'), ('SIMULATED', 'simulated'), ('DRAWN', 'drawn'))
    known(prefix, label) ON known.prefix = words[1])"""
LOOKUP = """
lookup AS (SELECT event_class, name, description, has_transient,
  CASE WHEN has_transient THEN event_class + 100 END AS transient_code,
  has_transient AS has_normal_prefix FROM sensor_specs)"""
# Rows are counted per file and label; the labels' phases then become columns.
CATALOG = f"""
per_label AS (
  SELECT instance_id, source_file, event_class, well_kind, well_id, class, count(*) AS n,
    min(timestamp) AS lo, max(timestamp) AS hi,
    CASE class WHEN event_class THEN 'steady' WHEN event_class + 100 THEN 'transient'
      WHEN 0 THEN 'normal' ELSE if(class IS NULL, 'warmup', 'other') END AS phase
  FROM observed GROUP BY ALL),
phases AS (
  PIVOT (SELECT instance_id, source_file, event_class, phase, n FROM per_label)
  ON phase IN ('steady', 'transient', 'normal', 'warmup') USING sum(n)
  GROUP BY instance_id, source_file, event_class),
files AS (
  SELECT instance_id, source_file, event_class, well_kind, well_id, min(lo) AS start_ts,
    max(hi) AS end_ts, CAST(sum(n) AS BIGINT) AS n_rows
  FROM per_label GROUP BY ALL),
catalog AS (
  SELECT files.*, date_diff('second', start_ts, end_ts) AS duration_s,
    CAST(coalesce(warmup, 0) AS BIGINT) AS n_rows_warmup_null,
    CAST(coalesce(normal, 0) AS BIGINT) AS n_rows_normal,
    CAST(CASE WHEN has_transient THEN coalesce(transient, 0) END AS BIGINT) AS n_rows_transient,
    CAST(coalesce(steady, 0) AS BIGINT) AS n_rows_steady,
    format('{BASE_URL}/observations/event_class={{}}/instance={{}}', event_class, instance_id)
      AS source_url
  FROM files JOIN phases USING (instance_id, source_file, event_class)
  LEFT JOIN lookup USING (event_class))"""
WELLS = """
sensor_wells AS (SELECT well_id, count(*) AS n_instances, min(start_ts) AS first_ts,
  max(end_ts) AS last_ts, CAST(sum(n_rows) AS BIGINT) AS n_observations
  FROM catalog WHERE well_kind = 'real' GROUP BY well_id)"""
USES = ("sensor_rows", "sensor_specs")
FULL = "WITH " + ",".join([PROVENANCE.format(source="sensor_rows", side="observed"), LOOKUP, CATALOG, WELLS])


def rows(spark, sf):
    return bound(spark, sf, "sensor_rows")


def lookup(spark, sf):
    return ops.event_lookup(bound(spark, sf, "sensor_specs"))


def catalog(spark, sf):
    return ops.instance_catalog(rows(spark, sf), lookup(spark, sf), BASE_URL)


def wells(spark, sf):
    return ops.real_wells(catalog(spark, sf))


def observed(spark, sf):
    return ops.observations(rows(spark, sf))


query("event_class_lookup", FULL + " SELECT * FROM lookup", USES)(lookup)
query("instance_catalog", FULL + " SELECT * FROM catalog", USES)(catalog)
query("real_well_master", FULL + " SELECT * FROM sensor_wells", USES)(wells)
query("observations_view", FULL + " SELECT * EXCLUDE (source_file) FROM observed", USES)(observed)


@query("path_provenance", FULL + """
SELECT instance_id, source_file, event_class, well_kind, well_id, count(*) AS n
FROM observed GROUP BY ALL""", USES)
def path_provenance(spark, sf):
    files = rows(spark, sf).groupBy("file_path").agg(F.count(F.lit(1)).alias("n"))
    return ops.with_provenance(files)


@query("sensor_columns", FULL + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS sensor, count(\"{c}\") AS n_readings FROM observed"
    for c in ("P-PDG", "T-PDG", "P-TPT")), USES)
def sensor_columns(spark, sf):
    view = observed(spark, sf)
    sensors = ops.sensor_columns(view)
    return view.select(*[F.col(f"`{c}`") for c in sensors]).unpivot(
        [], sensors, "sensor", "reading").groupBy("sensor").agg(
        F.count("reading").alias("n_readings"))


@query("event_classes", FULL + " SELECT event_class, name, description, has_transient, "
       "transient_code FROM lookup", USES)
def event_classes(spark, sf):
    return lookup(spark, sf).select("event_class", "name", "description", "has_transient",
                                    "transient_code").orderBy("event_class")


@query("anomaly_classes", FULL + " SELECT name, description, transient_code FROM lookup "
       "WHERE event_class > 0", USES)
def anomaly_classes(spark, sf):
    return plans.anomaly_classes(lookup(spark, sf))


@query("corpus_balance", FULL + """
SELECT event_class, description, count(*) AS n_instances,
       CAST(sum(n_rows) AS BIGINT) AS n_observations,
       CAST(sum(n_rows_steady) AS BIGINT) AS n_observations_steady
FROM catalog JOIN lookup USING (event_class) GROUP BY ALL""", USES)
def corpus_balance(spark, sf):
    return plans.corpus_balance(catalog(spark, sf), lookup(spark, sf))


@query("real_instances_of_a_class", FULL + """
SELECT instance_id, well_id, start_ts, n_rows, source_url FROM catalog
WHERE event_class = 2 AND well_kind = 'real'""", USES)
def real_instances_of_a_class(spark, sf):
    return plans.real_instances(catalog(spark, sf), 2)


@query("well_footprint", FULL + """
SELECT w.well_id, w.n_instances, w.n_observations, w.first_ts, w.last_ts,
       count(DISTINCT c.event_class) AS distinct_event_classes
FROM sensor_wells w JOIN catalog c USING (well_id) GROUP BY ALL""", USES)
def well_footprint(spark, sf):
    return plans.well_footprint(wells(spark, sf), catalog(spark, sf))


@query("group_folds", FULL + """
SELECT instance_id, event_class, n_rows, source_url, CAST(well_id % 5 AS INT) AS fold,
       CASE WHEN well_id % 5 = 0 THEN 'test' ELSE 'train' END AS role FROM catalog""", USES)
def group_folds(spark, sf):
    return plans.instance_folds(catalog(spark, sf)).select(
        "instance_id", "event_class", "n_rows", "source_url", "fold", "role")


@query("leave_one_well_out", FULL + """,
held AS (SELECT well_id FROM sensor_wells ORDER BY n_observations DESC, well_id LIMIT 1)
SELECT CASE WHEN well_id IS NOT DISTINCT FROM (SELECT well_id FROM held) THEN 'test'
       ELSE 'train' END AS role, event_class, count(*) AS n FROM observed GROUP BY ALL""", USES)
def leave_one_well_out(spark, sf):
    largest = wells(spark, sf).orderBy(F.desc("n_observations"), "well_id").limit(1)
    train, test = leave_one_out(observed(spark, sf), "well_id",
                                largest.select("well_id").scalar())
    sides = [side.groupBy("event_class").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(role).alias("role"), "event_class", "n")
        for role, side in (("train", train), ("test", test))]
    return sides[0].unionByName(sides[1])


@query("observations_of_a_class", FULL + """
SELECT instance_id, well_id, timestamp, "P-PDG", "T-PDG", class FROM observed
WHERE event_class = 1 AND well_kind = 'real'""", USES)
def observations_of_a_class(spark, sf):
    return plans.class_observations(observed(spark, sf), 1, ["P-PDG", "T-PDG"])


@query("rows_of_longest_instance", FULL + """
SELECT o.* EXCLUDE (source_file) FROM observed o JOIN (
  SELECT instance_id FROM catalog ORDER BY n_rows DESC, instance_id, event_class LIMIT 1)
  USING (instance_id)""", USES)
def rows_of_longest_instance(spark, sf):
    from wellspark.session import shared_folder
    from wellspark.sources.readers import instance_rows
    from wellspark.sources.writers import write_observations

    # The catalog names addresses below the folder that the observations are published in.
    root = shared_folder(spark)
    write_observations(observed(spark, sf), f"{root}/observations")
    instances = ops.instance_catalog(rows(spark, sf), lookup(spark, sf), root)
    longest = instances.orderBy(F.desc("n_rows"), "instance_id", "event_class").limit(1)
    return instance_rows(instances, longest.first()["instance_id"])


@query("provenance_of_file_paths", " UNION ALL ".join(f"""
SELECT '{n}' AS instance_id, '{n}.parquet' AS source_file, CAST(NULL AS INT) AS event_class,
       CAST(NULL AS VARCHAR) AS well_kind, CAST(NULL AS INT) AS well_id, count(*) AS n FROM {n}"""
    for n in ("customer", "orders", "supplier")))
def provenance_of_file_paths(spark, sf):
    from wellspark.sources.readers import read_parquet_with_path

    files = [read_parquet_with_path(spark, f"{sf}/{n}.parquet").groupBy("file_path").agg(F.count(F.lit(1)).alias("n"))
             for n in ("customer", "orders", "supplier")]
    return ops.with_provenance(files[0].unionByName(files[1]).unionByName(files[2]))
