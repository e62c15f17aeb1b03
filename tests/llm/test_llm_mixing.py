import math

import pytest
from pyspark.sql import functions as F

from wellspark.llm import mixing
from wellspark.llm.shared import fraction


def smallest(mean, u):
    k, p = 0, math.exp(-mean)
    total = p
    while total <= u and k < mean + 12 * math.sqrt(mean) + 24:
        k += 1
        p = p * mean / k
        total += p
    return k


@pytest.mark.parametrize("mean", [0.01, 0.5, 1.0, 3.7, 40.0])
def test_draw_inverts_the_distribution(spark, mean):
    us = [0.0, 1e-9, 0.1, 0.3678, 0.5, 0.9, 0.999999, 1 - 2**-53] + [i / 97 for i in range(97)]
    got = spark.createDataFrame([(u,) for u in us], "u double").select("u", mixing.poisson(F.lit(mean), F.col("u")).alias("k")).collect()
    assert [r["k"] for r in got] == [smallest(mean, r["u"]) for r in got]


def test_mix_against_brute_force(spark, rows):
    """Every copy is there that the draws ask for, and the sources reach their weights."""
    data = [(i, f"text {i}", ["big"] * 60 + ["mid"] * 30 + ["tiny"] * 9 + [None], i) for i in range(4000)]
    data = [(i, t, s[i % 100], c) for i, t, s, c in data]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string, copy int")
    weights = {"big": 1.0, "mid": 1.0, "tiny": 2.0, "none such": 4.0}
    out = mixing.poisson_mix(docs, weights, size=0.5)
    n = {"big": 2400, "mid": 1200, "tiny": 360, None: 40}
    weight = {s: weights.get(s, 0.0) for s in n}
    rate = {s: weight[s] * 0.5 * 4000 / sum(weight.values()) / n[s] for s in n}
    u = {r[0]: r[1] for r in docs.select("doc_id", fraction("mix 0", "doc_id", "text")).collect()}
    want = [(i, t, s, k) for i, t, s, _ in data if rate[s] for k in range(1, smallest(rate[s], u[i]) + 1)]
    assert rows(out, "doc_id", "text", "source", "copy") == sorted(want, key=repr)
    got = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}
    assert abs(got["tiny"] - 1000) < 100 and abs(got["big"] - 500) < 100 and None not in got


def test_equal_weights_nulls_repeated_rows_and_determinism(spark, rows):
    data = [(1, None, "a"), (1, None, "a"), (None, "x", None), (2, "", "b")] * 50
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    first = rows(mixing.poisson_mix(docs))
    assert first == rows(mixing.poisson_mix(docs.repartition(7)))
    rates = {r["source"]: r["rate"] for r in mixing.repetition_rates(docs).collect()}
    assert rates == pytest.approx({"a": 200 / 3 / 100, "b": 200 / 3 / 50, None: 200 / 3 / 50})


def test_large_rates_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "x", "a"), *[(i, "y", "b") for i in range(2, 402)]], "doc_id long, text string, source string")
    n = mixing.poisson_mix(docs).filter("source = 'a'").count()
    assert abs(n - 200.5) < 90
    assert mixing.poisson_mix(docs.limit(0)).count() == 0
    assert mixing.poisson_mix(docs, {}).count() == 0
    with pytest.raises(ValueError):
        mixing.poisson_mix(docs, {"a": -1.0})


def test_order_is_shuffled(spark):
    docs = spark.createDataFrame([(i, "x", "a") for i in range(2000)], "doc_id long, text string, source string")
    ids = [r["doc_id"] for r in mixing.poisson_mix(docs, size=2.0).collect()]
    rising = sum(a < b for a, b in zip(ids, ids[1:])) / len(ids)
    assert 0.45 < rising < 0.55
