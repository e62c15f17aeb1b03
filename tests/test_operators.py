import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from wellspark.functions import columns as fn
from wellspark.functions.units import IMPERIAL, SI, units
from wellspark.operators import profile
from wellspark.operators.master import merge_master, modal_attributes
from wellspark.operators.quantiles import exact_quantiles
from wellspark.operators.rollup import sums_by_dimension, top
from wellspark.operators.splits import assign_fold, leave_one_out
from wellspark.plans import field, logs, production


def one(spark, **values):
    names = ", ".join(f"{v} AS {k}" for k, v in values.items())
    return spark.sql(f"SELECT {names}")


def test_date_functions(spark, rows):
    df = one(spark, a="DATE '2024-01-31'", b="DATE '2024-02-01'")
    assert rows(df.select(fn.months_between(F.col("a"), F.col("b")),
                          fn.days_in_month(F.col("b")), fn.month_start(F.col("a")))) == [
        (1, 29, dt.date(2024, 1, 1))]
    t = one(spark, a="TIMESTAMP_NTZ '2024-01-01 23:59:59.9'",
            b="TIMESTAMP_NTZ '2024-01-02 00:00:00.1'")
    assert rows(t.select(fn.seconds_between(F.col("a"), F.col("b")))) == [(1,)]


def test_month_of_bad_parts_is_null(spark, rows):
    df = spark.createDataFrame([(2006, 1), (2006, 13), (None, 1)], "y int, m int")
    assert rows(df.select(fn.month_of(F.col("y"), F.col("m")))) == [
        (None,), (None,), (dt.date(2006, 1, 1),)]


def test_sentinels_slug_and_bucket(spark, rows):
    df = spark.createDataFrame([(-999.25, "15/9-F 1"), (5.0, "x"), (-999.0, None)],
                               "`A-B` double, n string")
    assert rows(fn.clean_curves(df, ["A-B"]).select("`A-B`")) == [(5.0,), (None,), (None,)]
    assert rows(df.select(fn.file_slug(F.col("n")))) == [("15-9-F_1",), ("x",), (None,)]
    assert rows(df.select(fn.two_way_bucket(F.col("n"), "x", "hit"))) == [
        ("Other",), ("Other",), ("hit",)]


def test_units(spark, rows):
    df = one(spark, v="CAST(31 AS DOUBLE)", d="DATE '2024-01-01'")
    assert units("si") is SI
    assert rows(df.select(IMPERIAL.oil(F.col("v"), F.col("d")), SI.gas(F.col("v"), F.col("d")),
                          IMPERIAL.gas_total(F.col("v")))) == [(31 * 6.2898 / 31, 31.0, 31 * 35314.7)]
    with pytest.raises(ValueError):
        units("metric")


def test_modal_attributes(spark, rows):
    data = [(1, "a", 1.0), (1, "b", None), (1, "b", None), (1, None, 2.0), (1, None, None),
            (1, None, None), (2, "z", 3.0), (2, "y", 10.0), (3, None, None)]
    df = spark.createDataFrame(data, "k int, s string, x double")
    got = modal_attributes(df, "k", {"name": "s", "depth": "x"})
    assert rows(got) == [(1, "b", 1.0), (2, "y", 3.0), (3, None, None)]


def test_merge_master_precedence(spark, rows):
    a = spark.createDataFrame([(1, "a1", None), (2, None, "x2")], "k int, name string, x string")
    b = spark.createDataFrame([(1, "b1"), (2, "b2"), (9, "b9")], "k int, label string")
    c = spark.createDataFrame([(2, "c2"), (3, "c3")], "k int, name string")
    got = merge_master("k", {"a": a, "b": b, "c": c}, ["a", "c"],
                       {"name": ["a.name", "b.label", "c.name"], "x": ["a.x"]}, {"seen": "c"})
    assert rows(got) == [(1, "a1", None, False), (2, "b2", "x2", True), (3, "c3", None, True)]


def test_quantiles_against_sorting(spark):
    rng = random.Random(1)
    data = [("hot", round(rng.choice([-1e9, 0, 1e-2, 7, 1e12]) + rng.random(), 2))
            for _ in range(400)]
    data += [(f"k{i % 7}", float(i % 11)) for i in range(100)] + [("hot", None)]
    df = spark.createDataFrame(data, "k string, v double")
    got = {r["k"]: r for r in exact_quantiles(df, ["k"], "v", {"q25": 0.25, "q50": 0.5}).collect()}
    for key in {k for k, _ in data}:
        mine = sorted(v for k, v in data if k == key and v is not None)
        assert got[key]["q50"] == pytest.approx(statistics.median(mine), rel=1e-12)
        want = statistics.quantiles(mine, n=4, method="inclusive")[0] if len(mine) > 1 else mine[0]
        assert got[key]["q25"] == pytest.approx(want, rel=1e-12)


@pytest.mark.parametrize("values", [
    [1e42, 1.0, 2.0, 3.0, 1e-300, 5e-324, -1e308, 1e308],
    [0.001, 0.002, 0.004], [7.0] * 9, [-0.0, 0.0], [float(x) ** 9 for x in range(-40, 60)],
    [1 + i * 2**-52 for i in range(300)]])
def test_quantiles_of_any_double(spark, values):
    rows = [("a", v) for v in values] + [("a", float("nan")), ("a", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    (r,) = exact_quantiles(df, ["k"], "v", {"lo": 0.0, "q25": 0.25, "q50": 0.5, "hi": 1.0}).collect()
    ordered = sorted(values)
    for name, p in (("lo", 0.0), ("q25", 0.25), ("q50", 0.5), ("hi", 1.0)):
        at = p * (len(values) - 1)
        below, above = ordered[math.floor(at)], ordered[math.ceil(at)]
        assert r[name] == pytest.approx(below + (above - below) * (at - math.floor(at)), rel=1e-12)


def test_quantiles_with_infinite_ends(spark):
    inf = float("inf")
    df = spark.createDataFrame([(v,) for v in [-inf, 1.0, 2.0, 3.0, inf]], "v double").selectExpr("1 AS k", "v")
    (r,) = exact_quantiles(df, ["k"], "v", {"lo": 0.0, "q25": 0.25, "q50": 0.5, "hi": 1.0}).collect()
    assert (r["lo"], r["q25"], r["q50"], r["hi"]) == (-inf, 1.0, 2.0, inf)


def test_agreement_across_types(spark, rows):
    a = spark.createDataFrame([(1, 1, -0.0, "x"), (2, 2, 1.0, None)], "k int, whole int, zero double, same string").selectExpr(
        "*", "date'2024-01-01' AS day")
    b = spark.createDataFrame([(1, 1.0, 0, "x"), (2, 2.5, 1, None)], "k int, whole double, zero int, same string").selectExpr(
        "*", "timestamp'2024-01-01 00:00:00' AS day")
    assert rows(profile.field_agreement(a, b, "k")) == [("day", 2, 0, 2), ("same", 2, 0, 2), ("whole", 1, 1, 2), ("zero", 2, 0, 2)]


def test_volatility_equals_distinct_counts(spark):
    rng = random.Random(2)
    data = [(rng.randrange(20), rng.choice("ab.") if i % 3 else None,
             rng.choice([1.0, 1.0, 2.0, None]), None) for i in range(300)]
    df = spark.createDataFrame(data, "k int, s string, x double, e string")
    got = {r["column_name"]: r for r in profile.volatility(
        df, "k", {"s": "static", "x": "event", "e": "scd", "gone": "scd"}).collect()}
    assert set(got) == {"s", "x", "e"}
    for i, c in ((1, "s"), (2, "x"), (3, "e")):
        values = {k: {r[i] for r in data if r[0] == k} - {None} for k in {r[0] for r in data}}
        assert got[c]["entities_with_change"] == sum(len(v) > 1 for v in values.values())
        assert got[c]["entities_with_value"] == sum(len(v) > 0 for v in values.values())
    assert got["e"]["pct_changed"] is None
    with pytest.raises(ValueError):
        profile.volatility(df, "k", {"gone": "scd"})


def test_coverage(spark, rows):
    def keys(*values):
        return spark.createDataFrame([(v,) for v in values], "k int")
    got = profile.coverage({"a": keys(1, 1, 2, None), "b": keys(2, 3), "c": keys(3, 3)}, "k")
    assert rows(got) == sorted([
        ("a", 4, 2), ("b", 2, 2), ("c", 2, 1), ("a_AND_b", None, 1), ("a_AND_c", None, 0),
        ("b_AND_c", None, 1)], key=repr)


def test_agreement_counts_pairs_of_repeated_keys(spark, rows):
    left = spark.createDataFrame([(1, "x", 1), (1, "y", 1), (2, None, 0), (8, "q", 1)],
                                 "k int, s string, n int")
    right = spark.createDataFrame([(1, "x", 1), (1, "x", 2), (2, None, 0), (9, "q", 1)],
                                  "k int, s string, n int")
    assert rows(profile.field_agreement(left, right, "k")) == [("n", 3, 2, 5), ("s", 3, 2, 5)]


def test_keys_and_rows_only_in(spark, rows):
    a = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, s string")
    b = spark.createDataFrame([(2,)], "k int")
    assert rows(profile.keys_only_in(a, b, "k")) == [(1,)]
    assert rows(profile.rows_only_in(a, b, "k", ["s"])) == [(1, "a"), (1, "b")]


def test_histogram(spark, rows):
    df = spark.createDataFrame([(v,) for v in (0, 0, 1, 5, 10)], "x int")
    got = dict(rows(profile.histogram(df, "x", 5), "bin", "n"))
    assert got == {0: 3, 1: 0, 2: 1, 3: 0, 4: 1}
    flat = spark.createDataFrame([(3,), (3,)], "x int")
    assert rows(profile.histogram(flat, "x")) == [
        (0, 2.5, 2.5 + 1 / 3, 0), (1, 2.5 + 1 / 3, 2.5 + 2 * (1 / 3), 2),
        (2, 2.5 + 2 * (1 / 3), 3.5, 0)]
    assert rows(profile.histogram(df.limit(0), "x")) == []


def test_profiles(spark, rows):
    df = spark.createDataFrame([(1.0, None, dt.date(2020, 1, 1)), (2.0, "a", None),
                                (4.0, "b", dt.date(2021, 1, 1))], "x double, s string, d date")
    assert rows(profile.missing(df)) == [("d", 2, 1, 33.33), ("s", 2, 1, 33.33), ("x", 3, 0, 0.0)]
    assert rows(profile.time_ranges(df)) == [("d", dt.date(2020, 1, 1), dt.date(2021, 1, 1))]
    (r,) = profile.numeric_profile(df).collect()
    assert (r["n"], r["min"], r["q25"], r["q50"], r["q75"], r["max"]) == (3, 1, 1.5, 2, 3, 4)
    assert r["mean"] == pytest.approx(7 / 3) and r["std"] == pytest.approx(
        statistics.stdev([1, 2, 4]))


def test_corpus_stats(spark, rows):
    df = spark.createDataFrame([("w1", 1, "train", "f1"), ("w1", None, "test", "f1"),
                                ("w2", 1, "train", "f2")], "w string, l int, s string, f string")
    assert rows(profile.corpus_stats(df, "w", "l", "s", "f")) == sorted([
        ("rows", None, 3), ("entities", None, 2), ("label", "1", 2), ("label", None, 1),
        ("split", "train", 2), ("split", "test", 1), ("files", None, 2)], key=repr)


def test_rollup_and_top(spark, rows):
    fact = spark.createDataFrame([(1, 1), (1, 2), (2, 5), (3, 9)], "k int, v int")
    dim = spark.createDataFrame([(1, "a"), (2, "a"), (4, "b")], "k int, g string")
    assert rows(sums_by_dimension(fact, dim, "k", ["v"], by_dimension=["g"])) == [("a", 8)]
    df = spark.createDataFrame([(1, 5), (2, 5), (3, None)], "k int, v int")
    assert rows(top(df, 2, F.col("v"), "k")) == [(1, 5), (2, 5)]


def test_splits(spark, rows):
    df = spark.createDataFrame([(5, "a"), (6, "b"), (None, "c")], "well_id int, n string")
    assert rows(assign_fold(df, "well_id", 5)) == sorted([
        (5, "a", 0, "test"), (6, "b", 1, "train"), (None, "c", None, "train")], key=repr)
    train, test = leave_one_out(df, "well_id", 5)
    assert rows(train, "n") == [("b",), ("c",)] and rows(test, "n") == [("a",)]


def test_density_neutron_and_gamma(spark):
    df = spark.createDataFrame(
        [(0.45, 1.95, 0.0), (-0.15, 2.0, 149.0), (None, 2.0, -1.0), (0.15, None, 1.5),
         (0.15, 2.0, 1.4999999), (0.15, 2.0, 200.0)], "NPHI double, RHOB double, GR double")
    got = logs.gamma_band(logs.density_neutron(df)).collect()
    assert (got[0]["nphi_mapped"], got[0]["is_shale"], got[0]["is_sand"]) == (1.95, True, True)
    assert (got[1]["is_shale"], got[1]["is_sand"]) == (False, True)
    assert got[2]["is_shale"] is None
    assert [r["gr_band"] for r in got] == [0, 99, None, 1, 0, 99]


def test_gamma_bands_against_floors(spark):
    values = [i * 0.0371 for i in range(5000)] + [k * 1.5 for k in range(110)]
    df = spark.createDataFrame([(v,) for v in values], "GR double")
    for r in logs.gamma_band(df).collect():
        assert r["gr_band"] == max(k for k in range(100) if k * 1.5 <= r["GR"])


def test_log_window(spark, rows):
    df = spark.createDataFrame([("w", 1.0, 1.0, None), ("w", 2.0, None, None),
                                ("w", 3.0, None, 2.0), ("v", 1.0, 1.0, 1.0)],
                               "WELL string, DEPTH_MD double, GR double, RHOB double")
    assert rows(logs.log_window(df, ["GR", "RHOB"], "w"), "DEPTH_MD") == [(1.0,), (3.0,)]
    assert rows(logs.log_window(df, ["GR", "RHOB"], "w", base=2.5), "DEPTH_MD") == [(1.0,)]


def test_stacked_series_fills_zero(spark, rows):
    df = spark.createDataFrame([(dt.date(2020, 1, 1), "Other", 2e6),
                                (dt.date(2020, 2, 1), "Unconv", 4e6)],
                               "fecha date, bucket string, v double")
    assert rows(production.stacked_series(df, "v", 1e6)) == [
        (dt.date(2020, 1, 1), 2.0, 0.0), (dt.date(2020, 2, 1), 0.0, 4.0)]


@pytest.mark.parametrize("hot", [0, 3, 10**6])
def test_modes_of_hot_and_other_keys(spark, rows, hot):
    """Whichever way a key is counted, the answer is one; ties, NULLs and zeros of either sign."""
    import random
    from collections import Counter

    rng = random.Random(3)
    data = [(rng.choice([1, 1, 1, 2, 3, None]), rng.choice(["a", "b", "é", None]), rng.choice([0.0, -0.0, 1.5, float("nan"), None]), None)
            for _ in range(200)] + [(9, None, None, None)]
    df = spark.createDataFrame(data, "k int, s string, x double, n date")

    def mode(values):
        counts = Counter("nan" if v != v else v + 0.0 if isinstance(v, float) else v for v in values if v is not None)
        best = max(counts.values(), default=0)
        return min((v for v, n in counts.items() if n == best), key=lambda v: (v == "nan", v), default=None)

    got = modal_attributes(df, "k", {"s2": "s", "x2": "x", "s3": "s", "n2": "n"}, hot).collect()
    assert {r["k"]: ("nan" if r["x2"] != r["x2"] else r["x2"], r["s2"], r["s3"], r["n2"]) for r in got} == {
        k: (mode(d[2] for d in data if d[0] == k), mode(d[1] for d in data if d[0] == k), mode(d[1] for d in data if d[0] == k), None)
        for k in (1, 2, 3, 9)}


@pytest.mark.parametrize("margin", [0.0026, -0.4])
def test_brackets_of_large_groups(spark, margin):
    """Groups below, at and above the size of a sketch; a bracket that misses its rank is widened."""
    import numpy as np

    from wellspark.operators.quantiles import SKETCH

    rng = np.random.default_rng(1)
    groups = {"few": rng.normal(size=7), "full": rng.normal(size=SKETCH), "many": rng.lognormal(0, 3, 30_000), "ties": rng.integers(0, 5, 20_000) * 1.0,
              "one": np.full(9000, 2.5), "split": np.r_[np.zeros(5000), np.ones(5000)], None: np.r_[rng.normal(size=8000), [np.inf, -np.inf, 1e308, -1e308]]}
    rows = [(k, float(v)) for k, vs in groups.items() for v in rng.permutation(vs)] + [("none", None), ("none", float("nan"))]
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    wanted = {"lo": 0.0, "q1": 0.01, "q50": 0.5, "q777": 0.777, "hi": 1.0}
    got = {r["k"]: r for r in exact_quantiles(df, ["k"], "v", wanted, margin=margin).collect()}
    assert got.keys() == groups.keys()
    for k, vs in groups.items():
        vs = np.sort(vs)
        for name, p in wanted.items():
            at = p * (len(vs) - 1)
            lo, hi = vs[int(np.floor(at))], vs[int(np.ceil(at))]
            assert got[k][name] == (lo if lo == hi else lo + (hi - lo) * (at - np.floor(at))), (k, name)


def test_only_values_near_the_quantiles_are_counted(spark):
    from pyspark.sql import functions as F

    from wellspark.operators.quantiles import MARGIN, _bracketed

    numbers = spark.range(200_000).select(F.lit(1).alias("k"), (F.xxhash64("id") / 1e3).alias("_v"), F.lit(1).cast("long").alias("_w"))
    counts, targets = _bracketed(numbers, ["k"], {"q25": 0.25, "q50": 0.5, "q75": 0.75}, MARGIN)
    assert counts.count() < 0.05 * 200_000 and targets.count() == 6


@pytest.mark.parametrize("build", [
    lambda a: profile.field_agreement(a, a.withColumn("x", F.col("x") + F.col("key") % 2), "key"),
    lambda a: field.daily_against_monthly(
        a.selectExpr("key as npd_wellbore_code", "date'2001-02-03' as date", "x as oil_volume", "x as gas_volume"),
        a.selectExpr("key as npd_wellbore_code", "date'2001-02-01' as date", "x as oil_volume_sm3", "x as gas_volume_sm3"))])
def test_tasks_hold_a_bounded_number_of_rows(spark, monkeypatch, build):
    """Rows are dealt out by key once, and what follows counts in the same tasks."""
    from wellspark.operators import slices

    monkeypatch.setattr(slices, "ROWS_PER_TASK", 100)
    plan = build(spark.range(1000).selectExpr("id as key", "cast(id % 5 as decimal(18,2)) as x"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(key") + text.count("Exchange hashpartitioning(npd_wellbore_code") == 1
    assert ", 20), REPARTITION_BY_NUM" in text
