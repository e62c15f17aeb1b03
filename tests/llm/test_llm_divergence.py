import random
import re
from collections import Counter, defaultdict

import pytest

from wellspark.llm import divergence
from wellspark.llm.divergence import audit_sources

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
COLUMNS = ("lang", "source", "part", "item", "value", "rank")


def brute(data, least=3, limit=200):
    docs = [(text or "", lang or "", source or "") for _, text, lang, source in data]
    held, seen = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in docs:
        words = ["".join(c.lower() if c.isascii() else c for c in w) for w in TERM.findall(text)]
        held[lang, source].update(words)
        seen[lang].update(set(words))
    out = []
    for lang in {x[1] for x in docs}:
        vocabulary = sorted(t for t, n in seen[lang].items() if n >= least)
        size = len(vocabulary)
        sources = sorted({x[2] for x in docs if x[1] == lang})

        def shares(count):
            total = sum(count[t] for t in vocabulary) + size
            return {t: 1 + 10**9 * (count[t] + 1) // total for t in vocabulary}

        p = {s: shares(held[lang, s]) for s in sources}
        q = shares(sum((held[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in vocabulary), o.encode()) for o in sources if o != s]
            terms = [(-((p[s][t] - q[t]) ** 2 // q[t]), t.encode()) for t in vocabulary if held[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:limit])):
                out += [(lang, s, part, item.decode(), -value, r + 1) for r, (value, item) in enumerate(found)]
    return sorted(out, key=repr)


def corpus(n=300, seed=4, words=40):
    rng = random.Random(seed)
    vocabulary = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(words)] + ["Été", "日本", "😀", "É", "ſ", "x_y", "A1b"]
    data = []
    for i in range(n):
        lang, source = rng.choice(["en", "fr", "", None]), rng.choice(["a", "b", "é", "😀", "", None])
        bias = vocabulary[:8] if source == "a" else vocabulary
        text = rng.choice([" ", "\n", "\x7f", "-"]).join(rng.choice(bias if rng.random() < 0.5 else vocabulary) for _ in range(rng.randint(0, 15)))
        data.append((i, rng.choice([text, text.upper(), text]), lang, source))
    return data


KINDS = "doc_id long, text string, lang string, source string"


@pytest.mark.parametrize("least,limit", [(3, 200), (1, 5), (6, 1)])
def test_against_brute_force(spark, rows, least, limit):
    data = [*corpus(), (900, None, None, None), (901, "", "none kept", "a"), (902, "rare", "none kept", "b"),
            (903, "wa " * 5000, "en", "a"), (904, None, "en", "no words")]
    out = audit_sources(spark.createDataFrame(data, KINDS), least, limit)
    assert rows(out, *COLUMNS) == brute(data, least, limit)


def test_many_ties_at_the_limit(spark, rows):
    """Four hundred terms of one value: the first in UTF-8 order are reported, by any salting."""
    many = [f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}é{'z' * (i // 676)}" for i in range(400)]
    data = [(i, " ".join(many), "en", "a") for i in range(3)] + [(i, "other", "en", "b") for i in range(3, 8)]
    for salts in (1, 7):
        assert rows(audit_sources(spark.createDataFrame(data, KINDS), salts=salts), *COLUMNS) == brute(data)


def test_long_texts_in_pieces_and_full_tasks(spark, rows, monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 16)
    monkeypatch.setattr(divergence, "MOST_HELD", 20)
    text = b"Ab cd \xc3\xa9\xc3\xa9, longer than a piece of sixteen bytes"
    assert [w for p in divergence._pieces(text) for w in p] == text.lower().replace(b",", b"").split()
    data = corpus(60)
    sent = [b.to_pylist() for b in divergence._counted(iter(
        spark.createDataFrame(data, KINDS).select("lang", "source", "text").toArrow().to_batches()))]
    assert len(sent) > 20
    held = Counter()
    for r in (r for b in sent for r in b):
        held[r["term"]] += r["n"]
    assert sum(held.values()) == sum(len(TERM.findall(t)) for _, t, _, _ in data)


def test_large_counts_are_exact(spark):
    """Beyond what a double or a long product can hold."""
    from pyspark.sql import functions as F

    numbers = [(0, 1), (10**17, 3 * 10**17 + 1), (10**18, 10**18 + 7), (5, 6)]
    got = spark.createDataFrame(numbers, "c long, t long").select("c", "t", divergence._share(F.col("c"), F.col("t")).alias("p")).collect()
    assert [r["p"] for r in got] == [1 + 10**9 * (c + 1) // t for c, t in numbers]


def test_repeated_rows_extra_columns_and_empty_table(spark, rows):
    data = [(1, "same text", "en", "a")] * 3 + [(2, "same other", "en", "b")] * 3
    docs = spark.createDataFrame([(*d, 1, "x") for d in data], KINDS + ", value int, term string")
    assert rows(audit_sources(docs), *COLUMNS) == brute(data)
    assert audit_sources(docs.limit(0)).count() == 0
