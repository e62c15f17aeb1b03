import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wellspark.llm import jaccard
from wellspark.llm.components import components


def shingles(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ")
    words = [w for w in words.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), d), d)
    return sorted((d, len(s), least[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def corpus(seed=5):
    """Near copies of several sizes, a chain of edits, a passage in many texts, short and empty texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    text = lambda n: [word() for _ in range(n)]
    out = []
    for size in (6, 20, 60, 61, 63, 64, 66, 70, 130, 180, 500, 3000):
        base = text(size)
        for _ in range(6):
            new = list(base)
            for _ in range(rng.randint(0, max(1, size // 25))):
                new[rng.randrange(len(new))] = word()
            out.append(" ".join(new[rng.randint(0, size // 12):]))
    chain = text(80)
    for _ in range(15):
        chain = chain[2:] + text(2)
        out.append(" ".join(chain))
    passage, group = text(40), text(70)
    out += [" ".join(text(rng.randint(5, 60)) + passage + text(rng.randint(0, 20))) for _ in range(90)]
    out += [" ".join([*group[:i % 60], word(), *group[i % 60 + 1:]]) for i in range(90)]
    out += ["One two", "one  TWO\n", "one two three", "", " \n", None, "word " * 50, "word " * 80, " ".join(group).upper()]
    return [(10 * i + 7, t) for i, t in enumerate(out)]


@pytest.mark.parametrize("frequent,block", [(64, 2048), (4, 16)])
def test_against_brute_force(documents, rows, monkeypatch, frequent, block):
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    data = corpus()
    out = jaccard.similar_documents(documents(data))
    assert rows(out, "doc_id", "n_shingles", "component_id") == sorted(brute(data), key=repr)


def test_one_of_each_group_stays(documents, rows):
    data = corpus(6)
    want = sorted((d, dict(data)[d]) for d, _, c in brute(data) if d == c)
    assert rows(jaccard.one_per_component(documents(data)), "doc_id", "text") == sorted(want, key=repr)


def test_repeated_rows_null_ids_and_clashing_columns(spark, rows):
    text = "a b c d e f g"
    data = [(3, text, 1, 1)] * 2 + [(None, text.upper(), 2, 2), (4, "", 3, 3), (4, "", 3, 3), (5, "", 3, 3), (None, "z", 1, 1)]
    docs = spark.createDataFrame(data, "doc_id long, text string, node int, component long")
    assert rows(jaccard.similar_documents(docs), "doc_id", "n_shingles", "component_id") == sorted(
        [(3, 3, 3), (3, 3, 3), (None, 3, 3), (4, 0, 4), (4, 0, 4), (5, 0, 5), (None, 1, None)], key=repr)
    assert rows(jaccard.one_per_component(docs), "doc_id", "text", "node", "component") == sorted(
        [(3, text, 1, 1), (4, "", 3, 3), (5, "", 3, 3), (None, "z", 1, 1)], key=repr)


def test_empty_table(documents):
    assert jaccard.similar_documents(documents([])).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 2**63)), st.sets(st.integers(0, 2**63)), st.sets(st.integers(0, 2**63), min_size=1), st.sampled_from([64, 128]))
def test_bitmaps_rule_out_no_link(a, b, common, bits):
    x, y = (np.unique(np.array(sorted(s | common), np.uint64)) for s in (a, b))
    maps = [np.frombuffer(jaccard.bitmap(s, bits), np.uint64) for s in (x, y)]
    if jaccard.linked(x, y):
        bound = jaccard.most_common(len(x), np.array([len(y)]), maps[0], maps[1][None])
        assert bound[0] >= len(np.intersect1d(x, y)) and jaccard.possible(len(x), len(y), bound)[0]
    wide = jaccard.bitmap(x, 2 * bits)
    assert jaccard.fold_bitmap(wide) == jaccard.bitmap(x, bits)


def test_components_of_long_chains_and_stars(spark, rows):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(5, 5), (250, 300)]
    want = [(i, 100) for i in range(100, 141)] + [(i, 7) for i in [7, *range(200, 260), 300]]
    assert rows(components(spark.createDataFrame(edges, "a long, b long"))) == sorted(want, key=repr)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
