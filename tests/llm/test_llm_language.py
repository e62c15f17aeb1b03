import math
import random
from collections import defaultdict

import numpy as np

from wellspark.llm import language


def naive_bits(training, text):
    """Method C with exclusion, straight from its description."""
    counts = [defaultdict(lambda: defaultdict(int)) for _ in range(language.ORDER + 1)]
    for t in training:
        data = b"\n" * language.ORDER + t
        for i in range(language.ORDER, len(data)):
            for k in range(language.ORDER + 1):
                counts[k][data[i - k:i]][data[i]] += 1
    total, data = 0.0, b"\n" * language.ORDER + text
    for i in range(language.ORDER, len(data)):
        out: set = set()
        for k in range(language.ORDER, -1, -1):
            c = counts[k].get(data[i - k:i])
            if c is None or (k and sum(c.values()) < language.LEAST):
                continue
            c = {b: n for b, n in c.items() if b not in out}
            if not c:
                continue
            n, q = sum(c.values()), len(c)
            if data[i] in c:
                total -= math.log2(c[data[i]] / (n + q))
                break
            total -= math.log2(q / (n + q))
            out |= set(c)
        else:
            total += math.log2(max(1, 256 - len(out)))
    return total


def trees(training):
    counts = {}
    for name, texts in training.items():
        values = []
        for t in texts:
            data = b"\n" * language.ORDER + t
            values += [int.from_bytes(data[i:i + language.ORDER + 1], "big") for i in range(len(t))]
        s, n = np.unique(np.array(values, np.int64), return_counts=True)
        counts[name] = s, n.astype(float)
    return language.build_trees(sorted(training), counts)


TRAINING = {"a": [b"abracadabra", "überall".encode(), b"abc abc"], "b": [b"banana bandana", b"nab", b"xyz"], "c": [b"\n\nc"]}


def test_code_lengths_against_the_definition():
    model, rng = trees(TRAINING), random.Random(1)
    texts = [b"", b"abra", "ü ß".encode(), b"banana", b"\n\n\n", b"zzz", *(bytes(rng.choice(b"abcnxz \n\xc3") for _ in range(30)) for _ in range(20))]
    got = model.lengths(texts)
    for row, text in zip(got, texts):
        assert np.allclose(row, [naive_bits(TRAINING[x], text) for x in model.languages], rtol=1e-5)


def test_chances_of_every_context_add_up():
    model = trees(TRAINING)
    known = (model.symbol > 0).sum()
    chance = 2.0 ** -model.bits.astype(float)
    total = chance[:, 1:].sum(axis=1) + (256 - known) * chance[:, 0]
    assert np.allclose(total, 1, rtol=1e-4)


def test_chunks_do_not_matter(monkeypatch):
    model = trees(TRAINING)
    texts = [b"abracadabra " * 40, b"", b"banana" * 30]
    want = model.lengths(texts)
    monkeypatch.setattr(language, "_CHUNK", 17)
    assert np.allclose(model.lengths(texts), want)


def made(n=150, seed=3):
    rng = random.Random(seed)
    parts = {"en": ["the", "and", "tion"], "de": ["über", "schaft", "keit"], "el": ["λόγος", "και", "των"]}
    return [(i, " ".join(rng.choice(parts[x]) for _ in range(rng.randint(2, 40))), x)
            for i in range(n) for x in [rng.choice(sorted(parts))]]


def test_held_out_accuracy_and_defined_cases(spark):
    data = made() + [(1000, None, "en"), (1001, "", "en"), (1002, "12 34 ½ !?", None), (None, "the and the", None), (1003, "the and", None),
                     (1003, "the and", None), (1004, "the and tion " * 20_000, None)]
    docs = spark.createDataFrame([(*r, "x") for r in data], "doc_id long, text string, lang string, score string")
    out = language.identify(docs)
    assert sorted(out.columns) == ["doc_id", "lang", "lang_pred", "score", "text"]
    got = out.collect()
    assert len(got) == len(data)
    for r in got:
        if r["text"] in (None, "", "12 34 ½ !?"):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] == (r["lang"] or "en") and 0.5 < r["score"] <= 1


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "the", None)], "doc_id long, text string, lang string")
    assert [(r["lang_pred"], r["score"]) for r in language.identify(docs).collect()] == [("und", 0.0)]
    assert language.identify(docs.limit(0)).count() == 0


def test_a_language_of_a_few_long_texts_is_learned(spark):
    """Each text is far beyond the bound, so no draw would take one; the first drawn stays."""
    words = {"xx": "zor zim zuq zaf", "yy": "bla ble blo blu"}
    data = [(i, " ".join([w] * 2000), lang) for lang, w in words.items() for i in ((1, 2, 3) if lang == "xx" else range(10, 40))]
    data += [(i, w, None) for i, w in ((100, "zim zaf zor"), (101, "blo blu bla"))]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs, sample_bytes=50).collect()}
    assert got[100] == "xx" and got[101] == "yy"
