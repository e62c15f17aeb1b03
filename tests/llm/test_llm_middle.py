import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from wellspark.llm import middle


def brute(doc_id, text, seed=1, plain=10, spm=20):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    key = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(key[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 100 - plain:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < spm:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts():
    rng = random.Random(5)
    parts = ["abc", "Z", " ", "\n", "\r\n", "é", "日本", "😀", "é", "\x00", " ", "\x85", "$1", "\\", "<P", "<S", "M>", "<", ">"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    return [*made, None, "", "a", "<P>", "x <S> y", "<M", "a" * 5000, "\n" * 3000]


COLUMNS = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")


@pytest.mark.parametrize("seed,plain,spm", [(1, 10, 20), (7, 0, 50), (2, 0, 0), (2, 100, 0)])
def test_against_brute_force(documents, rows, seed, plain, spm):
    data = list(enumerate(texts()))
    out = middle.fill_in_middle(documents(data), seed, plain, spm)
    assert rows(out, *COLUMNS) == sorted((brute(*d, seed, plain, spm) for d in data), key=repr)


def test_round_trip(documents):
    data = list(enumerate(texts()))
    out = middle.fill_in_middle(documents(data), plain_percent=0)
    back = {r[0]: r[1] for r in out.select("doc_id", middle.restore(F.col("output"), F.col("form"))).collect()}
    assert back == {i: t or "" for i, t in data}


def test_very_long_text_needs_no_stack(documents, rows):
    """Two million units, in one text; a quantifier that recurses would end the task."""
    data = [(i, "ab, 日" * 400_000) for i in range(3)]
    out = middle.fill_in_middle(documents(data), plain_percent=0)
    assert rows(out, *COLUMNS) == sorted((brute(*d, plain=0) for d in data), key=repr)


def test_null_ids_repeated_rows_extra_columns_and_empty_table(spark, rows):
    data = [(None, "one two", 1, "f")] * 2 + [(3, None, 2, "g")] * 2
    docs = spark.createDataFrame(data, "doc_id long, text string, n int, form string")
    assert rows(middle.fill_in_middle(docs), *COLUMNS) == sorted((brute(*d[:2]) for d in data), key=repr)
    assert middle.fill_in_middle(docs.limit(0)).count() == 0
