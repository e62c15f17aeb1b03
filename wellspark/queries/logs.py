"""Well-log queries on samples made of the given line items."""

from pyspark.sql import functions as F

from wellspark.functions.columns import clean_curves
from wellspark.operators.splits import leave_one_out
from wellspark.plans import logs as plans
from wellspark.queries.bindings import bound
from wellspark.queries.registry import query

_CURVES = ["GR", "RHOB", "NPHI", "RDEP"]
_CLEAN = ("clean AS (SELECT * REPLACE (" + ", ".join(
    f"CASE WHEN {c} IN (-999, -999.25, -999.9) THEN NULL ELSE {c} END AS {c}" for c in _CURVES)
    + ") FROM logs)")
_USES = ("logs",)


def _clean(spark, sf):
    return clean_curves(bound(spark, sf, "logs"), _CURVES)


@query("samples_and_labels_per_well", """
SELECT WELL, count(*) AS n_samples, count(DISTINCT lithology) AS n_labels
FROM logs GROUP BY WELL""", _USES)
def samples_and_labels_per_well(spark, sf):
    return plans.per_well(bound(spark, sf, "logs"), "lithology")


@query("label_balance_by_split", """
SELECT dataset, lithology, count(*) AS n_samples FROM logs GROUP BY ALL""", _USES)
def label_balance_by_split(spark, sf):
    return plans.label_balance(bound(spark, sf, "logs"), "lithology")


@query("mean_curves_per_well", "WITH " + _CLEAN + """
SELECT WELL, count(*) AS n_samples,
  CAST(sum(CAST(GR AS DECIMAL(18,2))) AS DOUBLE) / count(GR) AS mean_GR,
  CAST(sum(CAST(RDEP AS DECIMAL(18,2))) AS DOUBLE) / count(RDEP) AS mean_RDEP
FROM clean GROUP BY WELL""", _USES)
def mean_curves_per_well(spark, sf):
    exact = _clean(spark, sf).withColumns(
        {c: F.col(c).cast("decimal(18,2)") for c in ("GR", "RDEP")})
    return plans.mean_curves(exact, ["GR", "RDEP"], decimals=None)


@query("samples_per_formation", """
SELECT WELL, FORMATION, count(*) AS n_samples FROM logs WHERE FORMATION IS NOT NULL
GROUP BY ALL""", _USES)
def samples_per_formation(spark, sf):
    return plans.formation_samples(bound(spark, sf, "logs"))


@query("sentinels_as_null", "WITH " + _CLEAN + " SELECT WELL, " + ", ".join(
    f"count({c}) AS {c}" for c in _CURVES) + " FROM clean GROUP BY WELL", _USES)
def sentinels_as_null(spark, sf):
    return _clean(spark, sf).groupBy("WELL").agg(*[F.count(c).alias(c) for c in _CURVES])


@query("log_window", "WITH " + _CLEAN + """
SELECT WELL, DEPTH_MD, GR, RHOB, NPHI, RDEP FROM clean
WHERE DEPTH_MD >= 3000 AND (GR IS NOT NULL OR RHOB IS NOT NULL OR NPHI IS NOT NULL
                            OR RDEP IS NOT NULL)""", _USES)
def log_window(spark, sf):
    return plans.log_window(_clean(spark, sf), _CURVES, top=3000.0)


@query("log_window_of_largest_well", "WITH " + _CLEAN + """
SELECT WELL, DEPTH_MD, GR, RDEP FROM clean
WHERE WELL = (SELECT WELL FROM logs GROUP BY WELL ORDER BY count(*) DESC, WELL LIMIT 1)
  AND DEPTH_MD BETWEEN 1000 AND 100000 AND (GR IS NOT NULL OR RDEP IS NOT NULL)""", _USES)
def log_window_of_largest_well(spark, sf):
    largest = bound(spark, sf, "logs").groupBy("WELL").agg(
        F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "WELL").limit(1)
    return plans.log_window(_clean(spark, sf), ["GR", "RDEP"],
                            largest.select("WELL").scalar(), 1000.0, 100000.0)


_MAPPED = ("(0 + 1.95::DOUBLE) + (NPHI - 0.45::DOUBLE) / (-0.15::DOUBLE - 0.45::DOUBLE) "
           "* (2.95::DOUBLE - 1.95::DOUBLE)")


@query("density_neutron_crossover", "WITH " + _CLEAN + f"""
SELECT WELL, DEPTH_MD, {_MAPPED} AS nphi_mapped, RHOB >= {_MAPPED} AS is_shale,
       RHOB <= {_MAPPED} AS is_sand FROM clean""", _USES)
def density_neutron_crossover(spark, sf):
    return plans.density_neutron(_clean(spark, sf)).select(
        "WELL", "DEPTH_MD", "nphi_mapped", "is_shale", "is_sand")


@query("gamma_ray_bands", "WITH " + _CLEAN + """
SELECT WELL, DEPTH_MD, GR, CASE WHEN GR >= 0
  THEN CAST(list_max(list_filter(range(100), lambda k: k * 1.5 <= GR)) AS INT) END AS gr_band
FROM clean""", _USES)
def gamma_ray_bands(spark, sf):
    return plans.gamma_band(_clean(spark, sf)).select("WELL", "DEPTH_MD", "GR", "gr_band")


@query("leave_one_log_well_out", """
WITH held AS (SELECT WELL FROM logs GROUP BY WELL ORDER BY count(*) DESC, WELL LIMIT 1)
SELECT CASE WHEN WELL = (SELECT WELL FROM held) THEN 'test' ELSE 'train' END AS role,
       lithology, count(*) AS n FROM logs GROUP BY ALL""", _USES)
def leave_one_log_well_out(spark, sf):
    logs = bound(spark, sf, "logs")
    largest = logs.groupBy("WELL").agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), "WELL").limit(1).select("WELL").scalar()
    train, test = leave_one_out(logs, "WELL", largest)
    counted = [side.groupBy("lithology").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(role).alias("role"), "lithology", "n")
        for role, side in (("train", train), ("test", test))]
    return counted[0].unionByName(counted[1])
