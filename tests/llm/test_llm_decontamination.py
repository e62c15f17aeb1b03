import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wellspark.llm import decontamination as d


def words(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def grams(w, size):
    return [tuple(w[i:i + size]) for i in range(len(w) - size + 1)]


def brute(docs, items):
    """Best similarity of every item-sized window, by multisets."""
    out = {}
    for i, t in items:
        w = words(t)
        if not w:
            continue
        size = min(5, len(w))
        want = Counter(grams(w, size))
        for doc, text in docs:
            g = grams(words(text), size)
            span = min(len(w) - size + 1, len(g))
            for s in range(len(g) - span + 1):
                have = Counter(g[s:s + span])
                sim = sum((have & want).values()) / sum((have | want).values()) if g else 0
                if sim >= 0.75 and sim > out.get((doc, i), 0):
                    out[doc, i] = sim
    return sorted((doc, i, round(s, 9)) for (doc, i), s in out.items())


def fixture(seed=2):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijk") for _ in range(4))
    text = lambda n: [word() for _ in range(n)]
    items = [(k, text(n)) for k, n in enumerate((3, 5, 8, 20, 30, 40, 40, 55))]
    docs = []
    for k, item in items:
        for edits in (0, 1, 2, 3, 5):
            new = list(item)
            for _ in range(edits):
                new[rng.randrange(len(new))] = word()
            docs.append(" ".join(text(rng.randint(0, 30)) + new + text(rng.randint(0, 30))))
        docs.append(" ".join(item[:len(item) * 4 // 5]).upper())
        docs.append("\n".join(text(9) + item[:len(item) // 2] + ["more"] + item[len(item) // 2:]))
    docs += [" ".join(text(50)) for _ in range(20)] + ["", None, " ", "aa bb"]
    return list(enumerate(docs)), [(k, " ".join(w)) for k, w in items] + [(90, None), (91, " \n")]


@pytest.mark.parametrize("slice_items", [500, 3])
def test_against_brute_force(spark, documents, rows, monkeypatch, slice_items):
    monkeypatch.setattr(d, "SLICE_ITEMS", slice_items)
    docs, items = fixture()
    out = d.contaminated(documents(docs), spark.createDataFrame(items, "item_id long, text string"))
    assert rows(out.select("doc_id", "item_id", F.round("similarity", 9))) == sorted(brute(docs, items), key=repr)


def test_clean_documents_stay(spark, documents, rows):
    docs, items = fixture(3)
    frame = documents([(i, t, i) for i, t in docs], "doc_id long, text string, key long")
    out = d.drop_contaminated(frame, spark.createDataFrame(items, "item_id long, text string"))
    bad = {x for x, _, _ in brute(docs, items)}
    assert out.columns == frame.columns
    assert rows(out, "doc_id") == sorted([(i,) for i, _ in docs if i not in bad], key=repr)


def test_repeated_rows_null_ids_and_empty_tables(spark, documents, rows):
    items = spark.createDataFrame([(1, "a b c d e f"), (1, "q r s t u v")], "item_id long, text string")
    docs = documents([(1, "a b c d e f"), (1, "a b c d e f"), (None, "x a b c d e f"), (2, "none")])
    assert rows(d.contaminated(docs, items), "doc_id", "item_id", "similarity", "start") == sorted(
        [(1, 1, 1.0, 0), (None, 1, 1.0, 1)], key=repr)
    assert d.contaminated(documents([]), items).count() == 0
    assert d.contaminated(docs, items.limit(0)).count() == 0
    assert d.drop_contaminated(docs, items.limit(0)).count() == 4


def test_blocks_find_every_pair_within_the_radius(spark):
    rng = random.Random(1)
    masks = d._near_masks()
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, d.RADIUS)):
            b ^= 1 << bit
        blocks = [((a >> 8 * i) & 255, (b >> 8 * i) & 255) for i in range(d.BLOCKS)]
        assert any(x ^ y in masks for x, y in blocks)


def test_simhash_is_the_majority_of_bits(spark):
    rng = random.Random(4)
    for n in (1, 2, 5, 36):
        h = [rng.getrandbits(64) - (1 << 63) for _ in range(n)]
        got = spark.createDataFrame([(h,)], "h array<bigint>").select(d.simhash(F.col("h"))).first()[0]
        want = sum(1 << b for b in range(64) if 2 * sum((x >> b) & 1 for x in h) > n)
        assert got % (1 << 64) == want


def moved_passages():
    """Items that stand in the texts with parts swapped, or trimmed at both ends and added to in the middle."""
    rng = random.Random(7)
    text = lambda n: ["".join(rng.choice("abcdefghijk") for _ in range(4)) for _ in range(n)]
    items, docs = [], []
    for k, n in enumerate((60, 60, 100, 150)):
        item = text(n)
        items.append((k, " ".join(item)))
        third, trim, more = n * 2 // 3, n // 25, n // 12
        for new in (item[n // 2:] + item[:n // 2], item[third:] + item[:third],
                    item[trim:n // 2] + text(more) + item[n // 2:n - trim], item[trim:n // 2] + text(2 * more) + item[n // 2:n - trim]):
            docs += [" ".join(text(a) + new + text(b)) for a, b in ((0, 0), (80, 9), (3, 200))]
    again = text(7)
    items.append((9, " ".join(again * 5 + text(10))))
    docs += [" ".join(text(12) + again * n + text(10)) for n in (4, 5, 6, 40)] + [items[-1][1] + " " + " ".join(text(20))]
    return list(enumerate(docs)), items


@pytest.mark.parametrize("stretch", [64, 1])
def test_swapped_and_trimmed_passages(spark, documents, rows, monkeypatch, stretch):
    monkeypatch.setattr(d, "STRETCH", stretch)
    docs, items = moved_passages()
    out = d.contaminated(documents(docs), spark.createDataFrame(items, "item_id long, text string"))
    want = brute(docs, items)
    assert len(want) > 30 and rows(out.select("doc_id", "item_id", F.round("similarity", 9))) == sorted(want, key=repr)


@pytest.mark.parametrize("longest", [100, 1 << 14])
def test_rolling_prints_are_those_of_each_window(spark, longest):
    rng = random.Random(5)
    h = [rng.getrandbits(64) - (1 << 63) for _ in range(40)]
    frame = spark.createDataFrame([(h, n) for n in (1, 2, 7, 36, 40, 60)], "h array<bigint>, n int")
    for n, got in frame.select("n", d.rolling_simhash(F.col("h"), F.col("n"), longest)).collect():
        cut = [(i, h[i:i + n]) for i in range(max(1, len(h) - n + 1))]
        want = spark.createDataFrame(cut, "i int, h array<bigint>").select("i", d.simhash(F.col("h"))).collect()
        assert got == [x for _, x in sorted(want)]
