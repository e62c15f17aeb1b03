import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wellspark.llm import syncmers as s


def naive(text):
    """Positions of the closed syncmers by their definition."""
    codes = np.array([ord(c) for c in text], np.uint64)
    inner = lambda t: int(s._rolling(np.array([ord(c) for c in t], np.uint64), s.S)[0])
    del codes
    out = []
    for i in range(len(text) - s.K + 1):
        h = [inner(text[j:j + s.S]) for j in range(i, i + s.K - s.S + 1)]
        if min(h) in (h[0], h[-1]):
            out.append(i)
    return out


def some(n, seed=0, letters="abcdefgh éß𝒳"):
    rng = random.Random(seed)
    return "".join(rng.choice(letters) for _ in range(n))


@pytest.mark.parametrize("n", [31, 32, 33, 57, 300])
def test_anchors_by_definition(n):
    for seed in range(4):
        text = some(n, seed)
        positions, hashes = s.anchors(text)
        want = naive(text)
        if want:
            assert positions.tolist() == want
            gaps = np.diff([-1, *want, n - s.K + 1])
            assert gaps.max() <= s.K - s.S + 1
            where = dict(zip(want, hashes.tolist()))
            assert all(where[p] == s.anchors(text[p:p + s.K])[1][0] for p in want)
        else:
            assert len(hashes) == 1


def test_passages_keep_their_anchors_and_chunks_do_not_matter(monkeypatch):
    passage = some(400, 5)
    a, b = some(100, 1) + passage + some(50, 2), some(333, 3) + passage
    inside = {(p - 100, h) for p, h in zip(*map(np.ndarray.tolist, s.anchors(a))) if 100 <= p <= 500 - s.K}
    there = {(p - 333, h) for p, h in zip(*map(np.ndarray.tolist, s.anchors(b))) if p >= 333}
    assert inside == there and inside
    assert s.aligned(a, b)[0] == 233
    want = s.anchors(a + b)
    monkeypatch.setattr(s, "_CHUNK", 13)
    got = s.anchors(a + b)
    assert all((x == y).all() for x, y in zip(want, got))


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] or ""))
    texts = [t or "" for _, t in rows]
    out = []
    for i, (doc_id, _) in enumerate(rows):
        t, following = texts[i], texts[(i + 1) % len(rows)]
        n = len(t) // 4
        edited = t[:len(t) - n] + following[:n]
        f, e, x = (s.anchors(y)[1] for y in (t, edited, following))
        out.append((doc_id, len(t), hashlib.sha256(edited.encode()).hexdigest(), s.encode(f), s.encode(e),
                    round(s.likeness(f, e), 9), round(s.likeness(f, x), 9)))
    return out


@pytest.mark.parametrize("count", [1, 2, 5, 300])
def test_edits_against_brute_force(documents, rows, count):
    rng = random.Random(count)
    data = [(rng.randint(-500, 10_000) * 3, some(rng.choice([0, 1, 3, 4, 31, 40, 200, 2000]), i)) for i in range(count)]
    data = list({i: (i, t) for i, t in data}.values())
    out = s.edited_fingerprints(documents(data)).withColumn("near_edited", F.round("near_edited", 9)).withColumn("near_next", F.round("near_next", 9))
    assert rows(out) == sorted(brute(data), key=repr)


def test_nulls_ties_repeated_rows_and_clashing_columns(spark, rows):
    data = [(None, "null one", 1), (None, None, 1), (5, some(90, 1), 2), (5, some(90, 2), 2), (5, some(90, 2), 2), (9, None, 3)]
    docs = spark.createDataFrame(data, "doc_id long, text string, bucket int")
    out = s.edited_fingerprints(docs).withColumn("near_edited", F.round("near_edited", 9)).withColumn("near_next", F.round("near_next", 9))
    assert rows(out) == sorted(brute([r[:2] for r in data]), key=repr)
    made = s.fingerprints(docs.withColumn("n_anchors", F.lit("x"))).collect()
    assert all(r["fingerprint"] == s.encode(s.anchors(r["text"] or "")[1]) for r in made)


def test_empty_table(documents):
    assert s.edited_fingerprints(documents([])).count() == 0


def test_likeness_bounds():
    a, b = (s.anchors(some(500, i))[1] for i in (1, 2))
    none = np.zeros(0, np.uint32)
    assert s.likeness(a, a) == 1 and s.likeness(none, none) == 1 and s.likeness(a, none) == 0 and 0 <= s.likeness(a, b) < 0.1
    assert (s.decode(s.encode(a)) == a).all()


def naive_likeness(a, b):
    """k-th occurrences matched, longest rising run by trying all predecessors."""
    seen, where = {}, {}
    for i, h in enumerate(b):
        where[h, sum(x == h for x in b[:i])] = i
    pairs = []
    for h in a:
        k = seen[h] = seen.get(h, -1) + 1
        if (h, k) in where:
            pairs.append(where[h, k])
    best = []
    for i, p in enumerate(pairs):
        best.append(1 + max((best[j] for j in range(i) if pairs[j] < p), default=0))
    return 2 * max(best, default=0) / (len(a) + len(b)) if a or b else 1.0


def bag(a, b):
    return 2 * sum(min(a.count(h), b.count(h)) for h in set(a)) / max(1, len(a) + len(b))


def test_likeness_by_order_against_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        a = [rng.randint(0, 12) for _ in range(rng.randint(0, 25))]
        b = rng.choice([[rng.randint(0, 12) for _ in range(rng.randint(0, 25))], a[len(a) // 2:] + a[:len(a) // 2], a[:5] + a[9:], a[::-1]])
        got = s.likeness(np.array(a, np.uint32), np.array(b, np.uint32))
        assert got == pytest.approx(naive_likeness(a, b)) and got <= bag(a, b) + 1e-12 or not a + b
        assert got == pytest.approx(s.likeness(np.array(b, np.uint32), np.array(a, np.uint32)))


def test_moved_passages_count_on_one_side():
    """A text whose passages are swapped has all anchors of the old one, but only the larger part in order."""
    first, second = some(3000, 1), some(1500, 2)
    a, b = (s.anchors(t)[1] for t in (first + second, second + first))
    assert bag(a.tolist(), b.tolist()) > 0.95 and 0.6 < s.likeness(a, b) < 0.72
    c = s.anchors(first[:1000] + some(200, 9) + first[1000:] + second)[1]
    assert s.likeness(a, c) > 0.95
