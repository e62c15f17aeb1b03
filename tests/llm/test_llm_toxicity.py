import random

import numpy as np
import pytest

from wellspark.llm import toxicity
from wellspark.llm.shared import fold


def made(n=900, seed=1):
    """Invented prose; toxic texts have words of a few stems, with endings of their own."""
    rng = random.Random(seed)
    syllables = ["ta", "ri", "no", "lem", "sor", "vek", "un", "dor"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    docs, labels = [], []
    for i in range(n):
        toxic = i % 6 == 0
        tokens = [word() for _ in range(rng.randint(20, 120))]
        if toxic:
            for _ in range(max(2, len(tokens) // 20)):
                tokens[rng.randrange(len(tokens))] = "zgrim" + rng.choice(syllables) + rng.choice(syllables)
        docs.append((i, " ".join(tokens)))
        if i % 3 != 1:
            labels.append((i, int(toxic)))
    return docs, labels


def test_held_out_accuracy_and_defined_cases(spark, documents):
    docs, labels = made()
    toxic = {i for i, _ in docs if i % 6 == 0}
    docs += [(5000, None), (5001, ""), (5002, "123 !"), (None, "ta ri no"), (5003, "zgrimta norivek " * 30_000), (5003, "zgrimta norivek " * 30_000)]
    frame = documents([(i, t, "x") for i, t in docs], "doc_id long, text string, score string")
    marks = spark.createDataFrame([(*x, 0) for x in labels] + [(None, 1, 0), (3, None, 0), (4, 7, 0)], "doc_id long, toxic int, text int")
    out = toxicity.score_toxicity(frame, marks).withColumn("held", fold() == 0)
    assert sorted(out.columns) == ["doc_id", "held", "predicted", "score", "text"]
    got = out.collect()
    assert len(got) == len(docs)
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        if r["doc_id"] is not None and r["doc_id"] < 5000 and r["held"]:
            assert r["predicted"] == (r["doc_id"] in toxic), r
    special = {r["text"]: r["predicted"] for r in got if r["doc_id"] is None or r["doc_id"] >= 5000}
    assert special[None] == special[""] == special["123 !"] == special["ta ri no"] == 0
    assert special["zgrimta norivek " * 30_000] == 1


def test_without_both_labels_and_empty_tables(spark, documents):
    marks = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    docs = documents([(1, "a"), (2, "b")])
    assert {r["score"] for r in toxicity.score_toxicity(docs, marks).collect()} == {0.0}
    assert {r["score"] for r in toxicity.score_toxicity(docs, marks.limit(0)).collect()} == {0.0}
    assert toxicity.score_toxicity(docs.limit(0), marks).count() == 0
    docs, labels = made(120)
    assert toxicity.score_toxicity(documents(docs).limit(0), spark.createDataFrame(labels, "doc_id long, toxic int")).count() == 0


def chances(counts, totals, c):
    """P(letter | context) of one model, from the definition."""
    def p(s):
        if not s:
            return 1e-3
        total = totals.get(s[:-1], (0, 0))[c]
        lower = p(s[1:])
        if not total:
            return lower
        kept = {x: max(n[c] - toxicity.DISCOUNT, 0) / total for x, n in counts.items() if x[:-1] == s[:-1]}
        return kept.get(s, 0.0) + max(1 - sum(kept.values()), 1e-9) * lower
    return p


def test_ratios_by_definition(spark):
    texts = spark.createDataFrame([("abab ab cab", 0), ("abba zz zza", 1), ("zab zab", 1)], "text string, toxic int")
    arrays = toxicity._string_counts(texts)
    counts, totals = (dict(zip(a.tolist(), map(tuple, n.tolist()))) for a, n in (arrays[:2], arrays[2:]))
    assert counts["^ab"][0] > 0 and counts["zz"] == counts["zz"][:2]
    assert all(counts[s][0] == counts[s][1] for s in counts if len(s) <= toxicity.SHARED)
    model = toxicity.ratios(*arrays)
    p, q = chances(counts, totals, 0), chances(counts, totals, 1)
    for word in ("ab", "zab", "abab", "zz", "xyz", "cabzz"):
        marked = f"^{word}$"
        want = sum(np.log(q(marked[max(0, e - toxicity.ORDER):e]) / p(marked[max(0, e - toxicity.ORDER):e])) for e in range(2, len(marked) + 1))
        assert model.word(word) == pytest.approx(want, abs=1e-9)
