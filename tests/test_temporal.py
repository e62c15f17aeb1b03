import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wellspark.operators import temporal as ops
from wellspark.operators.checks import cadence_breaks
from wellspark.operators.slices import slice_of


def month(n):
    return dt.date(2006 + (n - 1) // 12, (n - 1) % 12 + 1, 1)


def series(spark, text, well=1):
    """'A.B' -> months 1..3 with values A, NULL, B."""
    data = [(well, month(i + 1), None if c == "." else c) for i, c in enumerate(text)]
    return spark.createDataFrame(data, "idpozo int, fecha date, value string")


def expected_runs(data):
    """Brute force over (key, time, value) rows with unique times per key."""
    out = []
    for key in sorted({k for k, _, _ in data}):
        mine = sorted((t, v) for k, t, v in [(k, t, (v is not None, v or "")) for k, t, v in data]
                      if k == key)
        for t, v in mine:
            if out and out[-1][0] == key and out[-1][1] == v:
                out[-1][3] = t
            else:
                out.append([key, v, t, t])
    return [(k, v[1] if v[0] else None, a, b) for k, v, a, b in out]


@pytest.mark.parametrize("text, runs", [
    ("AAA", ["A1-3"]), ("AABB", ["A1-2", "B3-4"]), ("A..B", ["A1-1", ".2-3", "B4-4"]),
    ("ABA", ["A1-1", "B2-2", "A3-3"]), ("..A", [".1-2", "A3-3"]), ("A..", ["A1-1", ".2-3"]),
    ("A", ["A1-1"]), (".", [".1-1"]),
])
@pytest.mark.parametrize("every", [None, 1, 40, 100_000])
def test_collapse(spark, rows, text, runs, every):
    got = ops.collapse_intervals(series(spark, text).orderBy(F.rand(3)), ["idpozo"], "fecha",
                                 "value", every=every)
    want = sorted(((1, None if r[0] == "." else r[0], month(int(r[1:].split("-")[0])),
                    month(int(r[1:].split("-")[1]))) for r in runs), key=repr)
    assert rows(got) == want


def test_collapse_spans_unobserved_months_and_keeps_wells_apart(spark, rows):
    data = [(1, month(1), "A"), (1, month(5), "A"), (2, month(6), "A")]
    df = spark.createDataFrame(data, "idpozo int, fecha date, value string")
    assert rows(ops.collapse_intervals(df, ["idpozo"], "fecha", "value")) == [
        (1, "A", month(1), month(5)), (2, "A", month(6), month(6))]


def test_collapse_carries_the_first_name(spark, rows):
    data = [(1, month(1), "A", "old"), (1, month(2), "A", "new"), (1, month(3), "B", None)]
    df = spark.createDataFrame(data, "idpozo int, fecha date, value string, name string")
    got = ops.collapse_intervals(df, ["idpozo"], "fecha", "value", carry=("name",))
    assert rows(got) == [(1, "A", "old", month(1), month(2)), (1, "B", None, month(3), month(3))]


def hot_rows(n, seed, values="AB."):
    """One key holds a third of the rows, at seconds spread unevenly."""
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    data = []
    for key, size in ((0, n // 3), *((k, n // 30) for k in range(1, 21))):
        for s in sorted(rng.sample(range(n * 3), size)):
            # Bursts: half of the seconds fall into a short stretch.
            at = s if rng.random() < 0.5 else s // 50
            data.append((key, start + dt.timedelta(seconds=at), rng.choice(values)))
    unique = {(k, t): v for k, t, v in data}
    return [(k, t, None if v == "." else v) for (k, t), v in unique.items()]


@pytest.mark.parametrize("every", [1, 17, 100, 10_000])
@pytest.mark.parametrize("values", ["AB.", "AAAAAAAAAAAAB", "A"])
def test_hot_entity_gives_the_same_runs(spark, rows, every, values):
    data = hot_rows(600, 7, values)
    df = spark.createDataFrame(data, "k int, t timestamp_ntz, v string")
    got = ops.collapse_intervals(df, ["k"], "t", "v", every=every)
    assert rows(got) == sorted(expected_runs(data), key=repr)


@pytest.mark.parametrize("every", [1, 40, 500])
def test_hot_entity_gives_the_same_transitions(spark, rows, every):
    df = spark.createDataFrame(hot_rows(600, 8), "k int, t timestamp_ntz, v string")
    assert rows(ops.detect_transitions(df, ["k"], "t", ["v"], every=every)) == rows(
        ops.detect_transitions(df, ["k"], "t", ["v"]))


@pytest.mark.parametrize("every", [1, 40, 500])
def test_hot_entity_gives_the_same_previous_time(spark, rows, every):
    df = spark.createDataFrame(hot_rows(600, 9), "k int, t timestamp_ntz, v string")
    assert rows(ops.previous(df, ["k"], "t", every=every), "k", "t", "previous") == rows(
        ops.previous(df, ["k"], "t"), "k", "t", "previous")


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "bigint"])
def test_slices_follow_time_and_wrong_clocks_do_not_fill_them(spark, kind):
    # A row far off in time is a slice of its own and leaves the others as they are.
    days = [-700_000, *range(18_000, 18_400), 2_000_000]
    expression = {"date": "date_from_unix_date(cast(id as int))",
                  "timestamp": "timestamp_seconds(id * 86400)",
                  "timestamp_ntz": "cast(timestamp_seconds(id * 86400) as timestamp_ntz)",
                  "bigint": "id"}[kind]
    every = 40 * (86_400 if "timestamp" in kind else 1)
    df = spark.createDataFrame([(d,) for d in days], "id bigint").selectExpr(f"{expression} as t")
    got = [r["s"] for r in df.select("t", slice_of(F.col("t"), kind, every).alias("s")).orderBy("t").collect()]
    assert got == sorted(got) and max(got.count(s) for s in set(got)) <= 40
    assert got.count(got[0]) == got.count(got[-1]) == 1


def test_building_a_query_runs_no_job(spark):
    df = spark.createDataFrame(hot_rows(300, 3), "k int, t timestamp_ntz, v string")
    spark.sparkContext.setJobGroup("building", "building")
    ops.collapse_intervals(ops.dedupe_key(df, ["k", "t"], ["v"]), ["k"], "t", "v")
    ops.detect_transitions(df, ["k"], "t", ["v"])
    ops.previous(df, ["k"], "t")
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs


def test_intervals_are_disjoint_and_transitions_are_their_starts(spark, rows):
    df = spark.createDataFrame(hot_rows(900, 11), "k int, t timestamp_ntz, v string")
    runs = ops.collapse_intervals(df, ["k"], "t", "v")
    moves = ops.detect_transitions(df, ["k"], "t", ["v"])
    assert rows(runs, "k", "valid_from", "v") == rows(moves, "k", "t", "v")
    ordered = runs.orderBy("k", "valid_from").collect()
    for a, b in zip(ordered, ordered[1:]):
        assert a["k"] != b["k"] or a["valid_to"] < b["valid_from"]


@pytest.mark.parametrize("states, kept", [
    ([("a", "b", "c")] * 3, [1]),
    ([("a", "b", "c"), ("x", "b", "c"), ("x", "y", "c"), ("x", "y", "z")], [1, 2, 3, 4]),
    ([("a", "b", "c"), ("x", "y", "z"), ("x", "y", "z")], [1, 2]),
    ([("a", None, "c"), ("a", None, "c"), ("a", "b", "c"), ("a", None, "c")], [1, 3, 4]),
    ([(None, None, None), (None, None, None)], [1]),
    ([("a", "b", "c"), ("x", "b", "c"), ("a", "b", "c")], [1, 2, 3]),
])
@pytest.mark.parametrize("every", [None, 1])
def test_transitions(spark, rows, states, kept, every):
    data = [(well, month(i + 1), *s) for well in (1, 2) for i, s in enumerate(states)]
    df = spark.createDataFrame(data[::-1], "idpozo int, fecha date, a string, b string, c string")
    got = ops.detect_transitions(df, ["idpozo"], "fecha", ["a", "b", "c"], every=every)
    assert rows(got, "idpozo", "fecha") == [(w, month(m)) for w in (1, 2) for m in kept]


@pytest.mark.parametrize("months, filled", [([1, 3], [1, 2, 3]), ([1, 13], list(range(1, 14))),
                                            ([5], [5]), ([1, 2, 6], [1, 2, 3, 4, 5, 6])])
def test_calendar_fill(spark, rows, months, filled):
    data = [(w, month(m), float(m), None) for w in (1, 2) for m in months]
    df = spark.createDataFrame(data, "idpozo int, fecha date, oil double, gas double")
    got = ops.fill_calendar(df, ["idpozo"], "fecha", ["oil", "gas"])
    assert rows(got, "idpozo", "fecha", "oil") == sorted(
        [(w, month(m), float(m) if m in months else None) for w in (1, 2) for m in filled],
        key=repr)
    again = ops.fill_calendar(got, ["idpozo"], "fecha", ["oil", "gas"])
    assert rows(again) == rows(got)


def test_dedupe_prefers_values_over_null(spark, rows):
    df = spark.createDataFrame([(1, None, "b"), (1, 2.0, None), (1, 3.0, "a")],
                               "k int, x double, s string")
    assert rows(ops.dedupe_key(df, ["k"], ["x", "s"])) == [(1, 2.0, "a")]
    assert rows(ops.dedupe_rows(df, ["k"], ["x", "s"])) == [(1, 2.0, None)]
    assert rows(ops.dedupe_rows(df, ["k"], ["s", "x"])) == [(1, "a", 3.0)]


def test_gap_audit(spark, rows):
    data = [(1, month(m)) for m in (1, 2, 2, 6, 9)] + [(2, month(4)), (3, None)]
    df = spark.createDataFrame(data, "idpozo int, fecha date")
    gaps = ops.gap_audit(df, "idpozo", "fecha")
    assert rows(gaps) == [(1, month(1), month(9), 9, 4, 5, 3), (2, month(4), month(4), 1, 1, 0, 0)]
    assert rows(ops.gap_headline(gaps)) == [(2, 1, 5, 3)]


def test_cadence_counts_gaps_and_copies(spark, rows):
    at = [dt.datetime(2024, 1, 1, 0, 0, s) for s in (0, 1, 2, 2, 5)]
    df = spark.createDataFrame([(1, t) for t in at] + [(2, t) for t in at[:3]],
                               "k int, t timestamp_ntz")
    for every in (None, 2):
        assert rows(cadence_breaks(df, ["k"], "t", every=every)) == [(1, 2)]
