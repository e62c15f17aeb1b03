"""Run collapsing, change detection, calendar filling and gap audits on the given tables."""

from pyspark.sql import functions as F

from wellspark.contracts import MEASURES
from wellspark.functions.columns import month_start
from wellspark.operators import temporal as ops
from wellspark.operators.checks import cadence_breaks, check_complete_months
from wellspark.plans import well_tables
from wellspark.queries.bindings import bound, table
from wellspark.queries.registry import query

_RUNS = """
flagged AS (
  SELECT *, CASE WHEN row_number() OVER w = 1
                   OR {value} IS DISTINCT FROM lag({value}) OVER w THEN 1 ELSE 0 END AS opens
  FROM {source} WINDOW w AS (PARTITION BY {key} ORDER BY {time})),
numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY {key} ORDER BY {time}
                             ROWS UNBOUNDED PRECEDING) AS run FROM flagged)
"""


def _daily_state(spark, sf):
    events = table(spark, sf, "events")
    dated = events.select("user_id", F.to_date("ts").alias("day"), "event_type", "value")
    return ops.dedupe_key(dated, ["user_id", "day"], ["event_type", "value"])


_DAILY_STATE = ("daily AS (SELECT user_id, CAST(ts AS DATE) AS day, min(event_type) AS event_type, "
                "min(value) AS value FROM events GROUP BY ALL)")


@query("interval_collapse", "WITH " + _DAILY_STATE + "," + _RUNS.format(
    source="daily", key="user_id", time="day", value="event_type") + """
SELECT user_id, min(event_type) AS event_type, min(day) AS valid_from, max(day) AS valid_to
FROM numbered GROUP BY user_id, run""")
def interval_collapse(spark, sf):
    return ops.collapse_intervals(_daily_state(spark, sf), ["user_id"], "day", "event_type")


@query("interval_collapse_fine_grained", "WITH readings AS (SELECT user_id, ts, "
       "min(event_type) AS event_type FROM events GROUP BY ALL)," + _RUNS.format(
           source="readings", key="user_id", time="ts", value="event_type") + """
SELECT user_id, min(event_type) AS event_type, min(ts) AS valid_from, max(ts) AS valid_to
FROM numbered GROUP BY user_id, run""")
def interval_collapse_fine_grained(spark, sf):
    readings = ops.dedupe_key(table(spark, sf, "events"), ["user_id", "ts"], ["event_type"])
    return ops.collapse_intervals(readings, ["user_id"], "ts", "event_type")


@query("interval_collapse_null_runs", "WITH states AS (SELECT idpozo, fecha, "
       "min(CASE WHEN status = 'P' THEN NULL ELSE status END) AS status "
       "FROM order_months GROUP BY ALL)," + _RUNS.format(
           source="states", key="idpozo", time="fecha", value="status") + """
SELECT idpozo, min(status) AS status, min(fecha) AS valid_from, max(fecha) AS valid_to
FROM numbered GROUP BY idpozo, run""", ("order_months",))
def interval_collapse_null_runs(spark, sf):
    months = bound(spark, sf, "order_months").withColumn("status", F.nullif("status", F.lit("P")))
    states = ops.dedupe_key(months, ["idpozo", "fecha"], ["status"])
    return ops.collapse_intervals(states, ["idpozo"], "fecha", "status")


@query("transition_detect", "WITH " + _DAILY_STATE + """
SELECT user_id, day, event_type, band FROM (
  SELECT user_id, day, event_type, band, row_number() OVER w AS rn,
         lag(event_type) OVER w AS previous_type, lag(band) OVER w AS previous_band
  FROM (SELECT *, CASE WHEN value < 10 THEN NULL WHEN value < 40 THEN 1 ELSE 2 END AS band
        FROM daily)
  WINDOW w AS (PARTITION BY user_id ORDER BY day))
WHERE rn = 1 OR event_type IS DISTINCT FROM previous_type OR band IS DISTINCT FROM previous_band
""")
def transition_detect(spark, sf):
    band = F.when(F.col("value") < 10, None).when(F.col("value") < 40, 1).otherwise(2)
    return ops.detect_transitions(_daily_state(spark, sf).withColumn("band", band), ["user_id"],
                                  "day", ["event_type", "band"])


@query("transition_detect_fine_grained", """
SELECT user_id, ts, event_type FROM (
  SELECT *, row_number() OVER w AS rn, lag(event_type) OVER w AS previous_type
  FROM (SELECT user_id, ts, min(event_type) AS event_type FROM events GROUP BY ALL)
  WINDOW w AS (PARTITION BY user_id ORDER BY ts))
WHERE rn = 1 OR event_type IS DISTINCT FROM previous_type""")
def transition_detect_fine_grained(spark, sf):
    readings = ops.dedupe_key(table(spark, sf, "events"), ["user_id", "ts"], ["event_type"])
    return ops.detect_transitions(readings, ["user_id"], "ts", ["event_type"])


_FILL = """
spans AS (SELECT idpozo, min(fecha) AS lo, max(fecha) AS hi FROM months GROUP BY idpozo),
grid AS (SELECT idpozo, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS fecha
         FROM spans)
"""


@query("calendar_fill", """
WITH months AS (SELECT idpozo, fecha, min(prod_pet) AS prod_pet, min(status) AS status
                FROM order_months GROUP BY ALL),""" + _FILL + """
SELECT grid.idpozo, grid.fecha, prod_pet, status FROM grid LEFT JOIN months USING (idpozo, fecha)
""", ("order_months",))
def calendar_fill(spark, sf):
    months = ops.dedupe_key(bound(spark, sf, "order_months"), ["idpozo", "fecha"],
                            ["prod_pet", "status"])
    return ops.fill_calendar(months, ["idpozo"], "fecha", ["prod_pet", "status"])


@query("month_deduplication", """
SELECT idpozo, fecha, min(prod_pet) AS prod_pet, min(status) AS status
FROM order_months GROUP BY ALL""", ("order_months",))
def month_deduplication(spark, sf):
    return ops.dedupe_key(bound(spark, sf, "order_months"), ["idpozo", "fecha"],
                          ["prod_pet", "status"])


_MONTHLY = ("months AS (SELECT idpozo, make_date(anio, mes, 1) AS fecha, "
            + ", ".join(f"min({m}) AS {m}" for m in MEASURES)
            + " FROM production GROUP BY ALL),")


@query("monthly_series", "WITH " + _MONTHLY + _FILL + """
SELECT grid.idpozo, grid.fecha, """ + ", ".join(MEASURES) + """
FROM grid LEFT JOIN months USING (idpozo, fecha)""", ("production",))
def monthly_series(spark, sf):
    return well_tables.monthly_series(bound(spark, sf, "production"))


@query("operator_history", """
WITH months AS (
  SELECT idpozo, make_date(anio, mes, 1) AS fecha, idempresa, empresa FROM production
  QUALIFY row_number() OVER (PARTITION BY idpozo, fecha
                             ORDER BY idempresa NULLS LAST, empresa NULLS LAST) = 1),""" + _RUNS.format(
    source="months", key="idpozo", time="fecha", value="idempresa") + """
SELECT idpozo, min(idempresa) AS idempresa, arg_min(empresa, fecha) AS empresa,
       min(fecha) AS valid_from, max(fecha) AS valid_to
FROM numbered GROUP BY idpozo, run""", ("production",))
def operator_history(spark, sf):
    return well_tables.operator_history(bound(spark, sf, "production"))


# Several orders of a customer in a month: the operator's name has to be that of the chosen code.
_SHARED_MONTHS = """shared AS (
  SELECT o_custkey AS idpozo, CAST(year(o_orderdate) AS INT) AS anio, 1 + month(o_orderdate) // 7 AS mes,
         o_orderstatus AS idempresa, o_orderpriority AS empresa FROM orders)"""


@query("operator_history_of_shared_months", "WITH " + _SHARED_MONTHS + """, months AS (
  SELECT idpozo, make_date(anio, mes, 1) AS fecha, idempresa, empresa FROM shared
  QUALIFY row_number() OVER (PARTITION BY idpozo, anio, mes
                             ORDER BY idempresa NULLS LAST, empresa NULLS LAST) = 1),""" + _RUNS.format(
    source="months", key="idpozo", time="fecha", value="idempresa") + """
SELECT idpozo, min(idempresa) AS idempresa, arg_min(empresa, fecha) AS empresa,
       min(fecha) AS valid_from, max(fecha) AS valid_to
FROM numbered GROUP BY idpozo, run""")
def operator_history_of_shared_months(spark, sf):
    half = (1 + F.floor(F.month("o_orderdate") / 7)).cast("int")
    return well_tables.operator_history(table(spark, sf, "orders").select(
        F.col("o_custkey").alias("idpozo"), F.year("o_orderdate").alias("anio"), half.alias("mes"),
        F.col("o_orderstatus").alias("idempresa"), F.col("o_orderpriority").alias("empresa")))


@query("state_events", """
SELECT idpozo, fecha AS event_date, tipoestado, tipoextraccion, tipopozo FROM (
  SELECT *, row_number() OVER w AS rn, lag(tipoestado) OVER w AS a,
         lag(tipoextraccion) OVER w AS b, lag(tipopozo) OVER w AS c
  FROM (SELECT idpozo, make_date(anio, mes, 1) AS fecha, tipoestado, tipoextraccion, tipopozo
        FROM production
        QUALIFY row_number() OVER (PARTITION BY idpozo, fecha ORDER BY tipoestado NULLS LAST,
                                   tipoextraccion NULLS LAST, tipopozo NULLS LAST) = 1)
  WINDOW w AS (PARTITION BY idpozo ORDER BY fecha))
WHERE rn = 1 OR tipoestado IS DISTINCT FROM a OR tipoextraccion IS DISTINCT FROM b
   OR tipopozo IS DISTINCT FROM c""", ("production",))
def state_events(spark, sf):
    return well_tables.state_events(bound(spark, sf, "production"))


_GAPS = """
observed AS (SELECT DISTINCT idpozo, fecha FROM order_months),
stepped AS (SELECT *, date_diff('month', lag(fecha) OVER (PARTITION BY idpozo ORDER BY fecha),
                                fecha) AS step FROM observed),
gaps AS (
  SELECT idpozo, min(fecha) AS first_month, max(fecha) AS last_month,
         date_diff('month', min(fecha), max(fecha)) + 1 AS expected_months,
         count(*) AS observed_months,
         date_diff('month', min(fecha), max(fecha)) + 1 - count(*) AS gap_count,
         coalesce(max(step) - 1, 0) AS longest_gap_months
  FROM stepped GROUP BY idpozo)
"""


@query("gap_audit", "WITH " + _GAPS + "SELECT * FROM gaps", ("order_months",))
def gap_audit(spark, sf):
    return ops.gap_audit(bound(spark, sf, "order_months"), "idpozo", "fecha")


@query("gap_headline", "WITH " + _GAPS + """
SELECT count(*) AS entities, count(*) FILTER (gap_count > 0) AS entities_with_gaps,
       max(gap_count) AS max_gap_count, max(longest_gap_months) AS max_longest_gap FROM gaps
""", ("order_months",))
def gap_headline(spark, sf):
    return ops.gap_headline(gap_audit(spark, sf))


@query("month_completeness", """
SELECT 'complete' AS rule, count(*) AS violations FROM (
  SELECT idpozo FROM (SELECT DISTINCT idpozo, fecha FROM order_months)
  GROUP BY idpozo HAVING count(*) <> date_diff('month', min(fecha), max(fecha)) + 1)
""", ("order_months",))
def month_completeness(spark, sf):
    months = bound(spark, sf, "order_months").select("idpozo", "fecha").distinct()
    return check_complete_months("complete", months, "idpozo", "fecha").frame()


@query("month_completeness_after_fill", """
WITH months AS (SELECT DISTINCT idpozo, fecha FROM order_months),""" + _FILL + """
SELECT 'complete' AS rule, count(*) AS violations FROM (
  SELECT idpozo FROM grid
  GROUP BY idpozo HAVING count(*) <> date_diff('month', min(fecha), max(fecha)) + 1)
""", ("order_months",))
def month_completeness_after_fill(spark, sf):
    return check_complete_months("complete", calendar_fill(spark, sf), "idpozo", "fecha").frame()


@query("cadence_breaks", """
WITH stepped AS (
  SELECT user_id, date_diff('second', lag(ts) OVER (PARTITION BY user_id ORDER BY ts), ts) AS step
  FROM events)
SELECT user_id, count(*) AS n_breaks FROM stepped
WHERE step IS NOT NULL AND step <> 1 GROUP BY user_id""")
def cadence_breaks_of_events(spark, sf):
    return cadence_breaks(table(spark, sf, "events"), ["user_id"], "ts")


@query("step_to_previous_row", """
SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS previous
FROM (SELECT DISTINCT user_id, ts FROM events)""")
def step_to_previous_row(spark, sf):
    times = table(spark, sf, "events").select("user_id", "ts").distinct()
    return ops.previous(times, ["user_id"], "ts")


@query("first_and_last_month", """
SELECT o_custkey, CAST(date_trunc('month', min(o_orderdate)) AS DATE) AS first_month,
       CAST(date_trunc('month', max(o_orderdate)) AS DATE) AS last_month
FROM orders GROUP BY o_custkey""")
def first_and_last_month(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(
        month_start(F.min("o_orderdate")).alias("first_month"),
        month_start(F.max("o_orderdate")).alias("last_month"))
