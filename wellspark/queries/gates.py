"""Integrity and parity checks on the given tables: they report counts, and raise nothing."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspark.operators import catalog as cat
from wellspark.operators import checks as ops
from wellspark.operators import parity
from wellspark.operators.temporal import collapse_intervals, dedupe_key, detect_transitions
from wellspark.queries import sensors
from wellspark.queries.bindings import bound, table
from wellspark.queries.registry import query
from wellspark.session import keep


def _report(rules: list) -> DataFrame:
    return ops.Gate(rules).report()


def _rules(*pairs: tuple[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, CAST(({sql}) AS BIGINT) AS violations" for name, sql in pairs)


def _duplicates(source: str, key: str) -> str:
    return (f"SELECT count(*) FROM (SELECT 1 FROM {source} GROUP BY {key} "
            "HAVING count(*) > 1)")


@query("foreign_keys", _rules(
    ("orders have customers", "SELECT count(DISTINCT o_custkey) FROM orders "
     "WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)"),
    ("lines have orders", "SELECT count(DISTINCT l_orderkey) FROM lineitem "
     "WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)"),
    ("lines have parts", "SELECT count(DISTINCT l_partkey) FROM lineitem "
     "WHERE l_partkey NOT IN (SELECT p_partkey FROM part)"),
    ("production has registry wells", "SELECT count(DISTINCT idpozo) FROM production "
     "WHERE idpozo NOT IN (SELECT idpozo FROM registry)"),
    ("production rows have registry wells", "SELECT count(*) FROM production "
     "WHERE idpozo NOT IN (SELECT idpozo FROM registry)"),
    ("documents have labels", "SELECT count(*) FROM documents "
     "WHERE doc_id NOT IN (SELECT doc_id FROM labels)")), ("production", "registry"))
def foreign_keys(spark, sf):
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    production, registry = bound(spark, sf, "production"), bound(spark, sf, "registry")
    return _report([
        ops.check_fk("orders have customers", orders, table(spark, sf, "customer"),
                     ["o_custkey"], ["c_custkey"]),
        ops.check_fk("lines have orders", lines, orders, ["l_orderkey"], ["o_orderkey"]),
        ops.check_fk("lines have parts", lines, table(spark, sf, "part"), ["l_partkey"],
                     ["p_partkey"]),
        ops.check_fk("production has registry wells", production, registry, ["idpozo"]),
        ops.check_fk("production rows have registry wells", production, registry, ["idpozo"],
                     rows=True),
        ops.check_fk("documents have labels", table(spark, sf, "documents"),
                     table(spark, sf, "labels"), ["doc_id"], rows=True),
    ])


@query("unique_keys", _rules(
    ("orders", _duplicates("orders", "o_orderkey")),
    ("lines", _duplicates("lineitem", "l_orderkey, l_linenumber")),
    ("customer", _duplicates("customer", "c_custkey")),
    ("order months", _duplicates("order_months", "idpozo, fecha")),
    ("turns", _duplicates("conversations", "conv_id, turn"))), ("order_months",))
def unique_keys(spark, sf):
    return _report([
        ops.check_unique("orders", table(spark, sf, "orders"), ["o_orderkey"]),
        ops.check_unique("lines", table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]),
        ops.check_unique("customer", table(spark, sf, "customer"), ["c_custkey"]),
        ops.check_unique("order months", bound(spark, sf, "order_months"), ["idpozo", "fecha"]),
        ops.check_unique("turns", table(spark, sf, "conversations"), ["conv_id", "turn"]),
    ])


@query("domains_and_counts", _rules(
    ("regions", "SELECT abs(count(*) - 5) FROM region"),
    ("customers", "SELECT abs(count(*) - 1000) FROM customer"),
    ("events exist", "SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM events"),
    ("statuses", "SELECT count(DISTINCT o_orderstatus) FILTER (o_orderstatus NOT IN "
     "('F', 'O', 'X')) + 3 - count(DISTINCT o_orderstatus) FILTER (o_orderstatus IN "
     "('F', 'O', 'X')) FROM orders"),
    ("version", "SELECT count(DISTINCT o_orderstatus) FROM orders WHERE o_orderstatus <> 'F'"),
    ("prices", "SELECT count(*) FROM orders WHERE NOT coalesce(o_totalprice < 400000, false)"),
    ("sparse column", "SELECT count(*) FROM production WHERE iny_gas IS NULL OR iny_gas < 0.02"),
    ("lithology labels", "SELECT 12 - count(DISTINCT lithology) FROM logs")),
    ("production", "logs"))
def domains_and_counts(spark, sf):
    from wellspark.contracts import LITHOLOGY_LABELS

    orders = table(spark, sf, "orders")
    return _report([
        ops.check_row_count("regions", table(spark, sf, "region"), 5),
        ops.check_row_count("customers", table(spark, sf, "customer"), 1000),
        ops.check_not_empty("events exist", table(spark, sf, "events")),
        ops.check_same_values("statuses", orders, "o_orderstatus", ["F", "O", "X"]),
        ops.check_version("version", orders, "o_orderstatus", "F"),
        ops.check_predicate("prices", orders, F.col("o_totalprice") < 400000),
        ops.check_predicate("sparse column", bound(spark, sf, "production"),
                            F.col("iny_gas") >= 0.02),
        ops.check_label_mapping("lithology labels", bound(spark, sf, "logs"), "lithology",
                                LITHOLOGY_LABELS),
    ])


def _empty(source: str) -> str:
    return f"SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM {source}"


def _unknown_wells(source: str) -> str:
    return (f"SELECT count(*) FROM {source} WHERE npd_wellbore_code IS NULL OR "
            "npd_wellbore_code NOT IN (SELECT npd_wellbore_code FROM field_wells)")


@query("field_gate", _rules(
    ("wells are not empty", _empty("field_wells")),
    ("daily production is not empty", _empty("field_daily")),
    ("monthly production is not empty", _empty("field_reported")),
    ("daily production has wells", _unknown_wells("field_daily")),
    ("monthly production has wells", _unknown_wells("field_reported")),
    ("daily key is unique", _duplicates("field_daily", "date, npd_wellbore_code")),
    ("monthly key is unique", _duplicates("field_reported", "date, npd_wellbore_code"))),
    ("field_wells", "field_daily", "field_reported"))
def field_gate(spark, sf):
    return ops.field_gate(bound(spark, sf, "field_wells"), bound(spark, sf, "field_daily"),
                          bound(spark, sf, "field_reported")).report()


@query("production_gate", """
WITH months AS (SELECT DISTINCT idpozo, fecha FROM order_months),
spans AS (SELECT idpozo, min(fecha) AS lo, max(fecha) AS hi FROM months GROUP BY idpozo),
""" + "master AS (SELECT CASE WHEN c_acctbal > 0 THEN c_custkey ELSE -c_custkey END AS idpozo FROM customer) " + _rules(
    ("geometry parses", "SELECT count(*) - count(c_custkey) FROM customer"),
    ("operator history has wells",
     "SELECT count(*) FROM spans WHERE idpozo NOT IN (SELECT idpozo FROM master)"),
    ("state events have wells",
     "SELECT count(*) FROM spans WHERE idpozo NOT IN (SELECT idpozo FROM master)"),
    ("monthly series has wells",
     "SELECT count(*) FROM spans WHERE idpozo NOT IN (SELECT idpozo FROM master)"),
    ("monthly series key is unique", _duplicates("order_months", "idpozo, fecha")),
    ("monthly series is complete", "SELECT count(*) FROM (SELECT idpozo FROM order_months "
     "GROUP BY idpozo HAVING count(*) <> date_diff('month', min(fecha), max(fecha)) + 1)")),
    ("order_months",))
def production_gate(spark, sf):
    # Accounts with a debt have another key in the master, so their rows are orphans.
    months = bound(spark, sf, "order_months")
    master = table(spark, sf, "customer").select(
        F.when(F.col("c_acctbal") > 0, F.col("c_custkey")).otherwise(-F.col("c_custkey")).alias("idpozo"),
        F.unhex(F.lit("0101000000" + "00" * 16)).alias("geom"))
    states = dedupe_key(months, ["idpozo", "fecha"], ["status"])
    return ops.production_gate(
        master, collapse_intervals(states, ["idpozo"], "fecha", "status"),
        detect_transitions(states, ["idpozo"], "fecha", ["status"]), months).report()


@query("geometry_check", _rules(
    ("geometry parses", "SELECT count(*) FROM part WHERE p_size > 30")))
def geometry_check(spark, sf):
    # A point of 21 bytes; parts over size 30 get one byte too few.
    point = F.concat(F.lit("0101000000"), F.lpad(F.col("p_size").cast("string"), 2, "0"),
                     F.when(F.col("p_size") > 30, F.repeat(F.lit("0"), 28))
                     .otherwise(F.repeat(F.lit("0"), 30)))
    parts = table(spark, sf, "part").select(point.alias("hex")).withColumn(
        "geom", F.unhex("hex"))
    return _report([ops.check_wkb("geometry parses", parts, "geom", "hex")])


@query("counts_per_key_match", _rules(
    ("orders per customer", """
     SELECT count(*) FROM (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1) a
     FULL JOIN (SELECT user_id AS k, count(*) AS n FROM events GROUP BY 1) b USING (k)
     WHERE a.n IS DISTINCT FROM b.n""")))
def counts_per_key_match(spark, sf):
    a = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("k")).agg(
        F.count(F.lit(1)).alias("n"))
    b = table(spark, sf, "events").groupBy(F.col("user_id").alias("k")).agg(
        F.count(F.lit(1)).alias("n"))
    return _report([ops.check_counts_match("orders per customer", a, b, ["k"])])


@query("sensor_gate", sensors.FULL + " " + _rules(
    ("event classes are all there", "SELECT abs(count(*) - 10) FROM lookup"),
    ("event class is unique", _duplicates("lookup", "event_class")),
    ("classes without transient phase", "SELECT count(*) FILTER (event_class NOT IN (0, 3, 4)) "
     "+ 3 - count(*) FILTER (event_class IN (0, 3, 4)) FROM lookup WHERE NOT has_transient"),
    ("transient codes are consistent", "SELECT count(*) FROM lookup WHERE transient_code "
     "IS DISTINCT FROM CASE WHEN has_transient THEN event_class + 100 END"),
    ("instance key is unique", _duplicates("catalog", "instance_id, event_class")),
    ("instances have event classes", "SELECT count(DISTINCT event_class) FROM catalog "
     "WHERE event_class NOT IN (SELECT event_class FROM lookup)"),
    ("well kind and id agree", "SELECT count(*) FROM catalog WHERE (well_id IS NOT NULL) "
     "<> (well_kind = 'real')"),
    ("transient counts are NULL by design only", "SELECT count(*) FROM catalog JOIN lookup "
     "USING (event_class) WHERE (n_rows_transient IS NOT NULL) <> has_transient"),
    ("label buckets sum to rows", "SELECT count(*) FROM catalog WHERE n_rows <> n_rows_normal "
     "+ n_rows_warmup_null + coalesce(n_rows_transient, 0) + n_rows_steady"),
    ("wells come from real instances", "SELECT count(*) FROM sensor_wells WHERE well_id NOT IN "
     "(SELECT well_id FROM catalog WHERE well_kind = 'real')"),
    ("instances have wells", "SELECT count(DISTINCT well_id) FROM catalog WHERE well_id NOT IN "
     "(SELECT well_id FROM sensor_wells)"),
    ("observations have instances", "SELECT count(*) FROM (SELECT DISTINCT instance_id, "
     "event_class FROM observed) ANTI JOIN catalog USING (instance_id, event_class)"),
    ("observations per instance match the catalog", "SELECT count(*) FROM (SELECT instance_id, "
     "event_class, count(*) AS n FROM observed GROUP BY ALL) o FULL JOIN catalog c "
     "USING (instance_id, event_class) WHERE o.n IS DISTINCT FROM c.n_rows"),
    ("observations are one second apart", "SELECT count(*) FROM (SELECT date_diff('second', "
     "lag(timestamp) OVER (PARTITION BY instance_id, event_class ORDER BY timestamp), timestamp) "
     "AS step FROM observed) WHERE step IS NOT NULL AND step <> 1"),
    ("labels are in their domain", "SELECT count(*) FROM observed JOIN lookup USING (event_class) "
     "WHERE class IS NOT NULL AND class <> 0 AND class <> event_class "
     "AND class IS DISTINCT FROM transient_code"),
    ("steady-only classes hold no other label", "SELECT count(*) FROM observed "
     "WHERE event_class IN (3, 4) AND (class = 0 OR class >= 100)"),
    ("real wells are all there", "SELECT abs(count(*) - 100) FROM sensor_wells")), sensors.USES)
def sensor_gate(spark, sf):
    catalog = keep(sensors.catalog(spark, sf))
    return ops.sensor_gate(keep(sensors.lookup(spark, sf)), catalog, cat.real_wells(catalog),
                           sensors.observed(spark, sf), expected_classes=10,
                           expected_wells=100).report()


# Parity of the sensor rows with an edited copy of them. In SQL, the sides are put below each
# other with a name each, and a group differs if its sides do or one is missing.
_USES = ("sensor_rows", "sensor_specs", "edited_sensor_rows")
_SIDES = sensors.FULL + "," + sensors.PROVENANCE.format(source="edited_sensor_rows", side="published")
_SENSORS = ("P-PDG", "T-PDG", "P-TPT")
_ROWS = {"source": "observed", "published": "published"}


def _sides(spark, sf):
    return (sensors.observed(spark, sf), sensors.catalog(spark, sf),
            cat.observations(bound(spark, sf, "edited_sensor_rows")))


def _differing(keys: str, told: dict[str, str], sides: list[str]) -> str:
    """Keys whose sides tell different things. ``told``: name and type of what each side tells."""
    facts = ", ".join(told)
    wide = ", ".join(f"CAST(max({fact}) FILTER (side = '{side}') AS {kind}) AS {side}_{fact}"
                     for fact, kind in told.items() for side in dict.fromkeys(
                         x.split("'")[1] for x in sides))
    return (f" SELECT {keys}, {wide} FROM ({' UNION ALL '.join(sides)}) "
            f"GROUP BY {keys} HAVING count(DISTINCT row({facts})) > 1 OR count(*) < {len(sides)}")


def _counted(keys: str, with_catalog: bool) -> str:
    sides = [f"SELECT '{side}' AS side, {keys}, count(*) AS n FROM {rows} GROUP BY ALL"
             for side, rows in _ROWS.items()]
    if with_catalog:
        sides.insert(1, f"SELECT 'catalog' AS side, {keys}, sum(n_rows) AS n FROM catalog GROUP BY ALL")
    return _differing(keys, {"n": "BIGINT"}, sides)


def _content(by: str = "") -> str:
    """Columns whose cells, as sums of hashes and numbers of cells and rows, differ."""
    keys = f"{by}column_name"
    sides = [f"""SELECT '{side}' AS side, {by} '{c}' AS column_name, count("{c}") AS count, count(*) AS rows,
        coalesce(sum(hash("{c}")::HUGEINT) FILTER ("{c}" IS NOT NULL), 0) AS cells FROM {rows} GROUP BY ALL"""
             for c in _SENSORS for side, rows in _ROWS.items()]
    return (f" SELECT {keys}, max(count) FILTER (side = 'source') AS source_count, "
            f"max(count) FILTER (side = 'published') AS published_count FROM ({' UNION ALL '.join(sides)}) "
            f"GROUP BY {keys} HAVING count(DISTINCT row(count, rows, cells)) > 1 OR count(*) < 2")


_PAIR = "instance_id, event_class"
_SPANS = _differing(_PAIR, {"start_ts": "TIMESTAMP", "end_ts": "TIMESTAMP"}, [
    *[f"SELECT '{side}' AS side, {_PAIR}, min(timestamp) AS start_ts, max(timestamp) AS end_ts "
      f"FROM {rows} GROUP BY ALL" for side, rows in _ROWS.items()],
    f"SELECT 'catalog' AS side, {_PAIR}, start_ts, end_ts FROM catalog"])


def _instances(published: str) -> str:
    return _differing("event_class", {"n": "BIGINT"}, [
        f"SELECT '{side}' AS side, event_class, count(DISTINCT instance_id) AS n FROM {rows} GROUP BY ALL"
        for side, rows in (("source", "observed"), ("published", published))])


_WHOLE = " SELECT event_class FROM (" + " UNION ALL ".join(
    f"""SELECT event_class, count(*) AS n, sum(hash(row(timestamp, "P-PDG", "T-PDG", "P-TPT", class, state,
    instance_id))::HUGEINT) AS cells FROM {rows} GROUP BY ALL""" for rows in _ROWS.values()) + (
    ") GROUP BY event_class HAVING count(DISTINCT row(n, cells)) > 1 OR count(*) < 2")


@query("parity_rows_per_class", _SIDES + _counted("event_class", True), _USES)
def parity_rows_per_class(spark, sf):
    source, catalog, published = _sides(spark, sf)
    return parity.compare_counts({"source": source, "catalog": catalog, "published": published},
                                 ["event_class"], {"catalog": "n_rows"})


@query("parity_rows_per_instance", _SIDES + _counted(_PAIR, True), _USES)
def parity_rows_per_instance(spark, sf):
    source, catalog, published = _sides(spark, sf)
    return parity.compare_counts({"source": source, "catalog": catalog, "published": published},
                                 ["instance_id", "event_class"], {"catalog": "n_rows"})


def _register_distribution(column: str, name: str) -> None:
    @query(f"parity_{name}_distribution", _SIDES + _counted(column, False), _USES)
    def compare(spark, sf):
        source, _, published = _sides(spark, sf)
        return parity.compare_distribution(source, published, column)


_register_distribution("class", "label")
_register_distribution("state", "state")


@query("parity_sensor_content", _SIDES + _content(), _USES)
def parity_sensor_content(spark, sf):
    source, _, published = _sides(spark, sf)
    return parity.compare_fingerprints(source, published, cat.sensor_columns(source)).select(
        "column_name", "source_count", "published_count")


@query("parity_sensor_content_per_class", _SIDES + _content("event_class, "), _USES)
def parity_sensor_content_per_class(spark, sf):
    source, _, published = _sides(spark, sf)
    return parity.compare_fingerprints(
        source, published, cat.sensor_columns(source), ["event_class"]).select(
        "event_class", "column_name", "source_count", "published_count")


@query("parity_time_spans", _SIDES + _SPANS, _USES)
def parity_time_spans(spark, sf):
    source, catalog, published = _sides(spark, sf)
    return parity.compare_spans(source, catalog, published, ["instance_id", "event_class"])


@query("parity_real_wells", _SIDES + """
SELECT count(DISTINCT well_id) AS source_wells, (SELECT count(*) FROM sensor_wells) AS master_wells,
       CAST(40 AS BIGINT) AS pinned_wells FROM observed""", _USES)
def parity_real_wells(spark, sf):
    return parity.well_counts(sensors.observed(spark, sf), sensors.wells(spark, sf), 40)


_LOST = "(SELECT * FROM published WHERE instance_id NOT LIKE '%3_20240101000000')"


@query("parity_instances_per_class", _SIDES + _instances(_LOST), _USES)
def parity_instances_per_class(spark, sf):
    # Instances of wells whose number ends in 3 have not been published.
    source, _, published = _sides(spark, sf)
    published = published.where(~F.col("instance_id").endswith("3_20240101000000"))
    counts = {
        side: df.select("instance_id", "event_class").distinct().groupBy("event_class").agg(
            F.count(F.lit(1)).alias("n"))
        for side, df in (("source", source), ("published", published))}
    return parity.mismatches(counts, ["event_class"], ["n"])


_LINES = ("l_quantity", "l_extendedprice", "l_discount", "l_returnflag")


@query("parity_of_line_items", """
WITH edited AS (SELECT * REPLACE (
  CASE WHEN l_quantity = 7 THEN 8 ELSE l_quantity END AS l_quantity,
  CASE WHEN l_returnflag = 'A' AND l_tax = 0.08 THEN 'R' ELSE l_returnflag END AS l_returnflag)
  FROM lineitem) """ + " UNION ALL ".join(f"""
SELECT l_linestatus, '{c}' AS column_name FROM
  (SELECT l_linestatus, bit_xor(hash({c})) AS h, sum(hash({c})::HUGEINT) AS s
   FROM lineitem GROUP BY ALL) a
  JOIN (SELECT l_linestatus, bit_xor(hash({c})) AS h, sum(hash({c})::HUGEINT) AS s
        FROM edited GROUP BY ALL) b USING (l_linestatus)
WHERE a.h <> b.h OR a.s <> b.s""" for c in _LINES))
def parity_of_line_items(spark, sf):
    lines = table(spark, sf, "lineitem")
    edited = lines.withColumn(
        "l_quantity", F.when(F.col("l_quantity") == 7, 8.0).otherwise(F.col("l_quantity"))
    ).withColumn("l_returnflag", F.when(
        (F.col("l_returnflag") == "A") & (F.col("l_tax") == 0.08), "R")
        .otherwise(F.col("l_returnflag")))
    return parity.compare_fingerprints(lines, edited, list(_LINES), ["l_linestatus"]).select(
        "l_linestatus", "column_name")


@query("parity_whole_rows", _SIDES + _WHOLE, _USES)
def parity_whole_rows(spark, sf):
    source, _, published = _sides(spark, sf)
    return parity.compare_rows(source, published, ["event_class"]).select("event_class")


_REPORT = {
    "rows per class": _counted("event_class", True), "rows per instance": _counted(_PAIR, True),
    "label distribution": _counted("class", False), "state distribution": _counted("state", False),
    "sensor content": _content(), "sensor content per class": _content("event_class, "),
    "time spans": _SPANS, "whole rows per class": _WHOLE,
    "real wells": " SELECT 1 WHERE (SELECT count(DISTINCT well_id) FROM observed) <> "
                  "(SELECT count(*) FROM sensor_wells) OR (SELECT count(*) FROM sensor_wells) <> 40",
    "instances per class": " SELECT event_class FROM (SELECT DISTINCT instance_id, event_class FROM observed) a "
                           "ANTI JOIN catalog USING (instance_id, event_class)",
}


@query("parity_report_of_edited_sides", _SIDES + " UNION ALL ".join(
    f" SELECT '{name}' AS \"check\", count(*) AS differences FROM ({sql})" for name, sql in _REPORT.items()), _USES)
def parity_report_of_edited_sides(spark, sf):
    source, catalog, published = _sides(spark, sf)
    catalog = keep(catalog)
    return parity.parity_report(source, catalog, cat.real_wells(catalog), published,
                                cat.sensor_columns(source), 40)


@query("parity_report_of_equal_sides", sensors.FULL + " " + " UNION ALL ".join(
    f"SELECT '{name}' AS \"check\", CAST(0 AS BIGINT) AS differences "
    "FROM (SELECT count(*) FROM observed)" for name in _REPORT), sensors.USES)
def parity_report_of_equal_sides(spark, sf):
    source = sensors.observed(spark, sf)
    catalog = keep(sensors.catalog(spark, sf))
    return parity.parity_report(source, catalog, cat.real_wells(catalog), source,
                                cat.sensor_columns(source))
