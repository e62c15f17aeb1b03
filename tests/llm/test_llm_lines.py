import random
from collections import defaultdict

import pytest

from wellspark.llm.lines import drop_repeated_lines

BLANK = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANK))


def brute(rows, least, min_length=1, keep_first=False):
    found = defaultdict(list)
    for r, (doc_id, text) in enumerate(rows):
        for i, line in enumerate((text or "").split("\n")):
            found[key(line)].append((r, i))
    gone = set()
    for k, places in found.items():
        if len(k) >= min_length and len({r for r, _ in places}) >= least:
            gone |= set(places[1:] if keep_first else places)
    out = []
    for r, (doc_id, text) in enumerate(rows):
        lines = (text or "").split("\n")
        kept = [x for i, x in enumerate(lines) if (r, i) not in gone]
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out)


def random_rows(n=120, seed=3):
    rng = random.Random(seed)
    common = ["Read more", "  read MORE\t", "Äpfel", "äpfel", "", "   ", "x", "\x85", "Cookies\r", "日本"]
    return [(i, "\n".join(rng.choice(common) if rng.random() < 0.4 else f"line {rng.random()}"
                          for _ in range(rng.randint(1, 12)))) for i in range(n)]


@pytest.mark.parametrize("bits", [1 << 27, 1 << 12])
@pytest.mark.parametrize("least,min_length", [(10, 1), (2, 1), (3, 3)])
def test_against_brute_force(documents, rows, bits, least, min_length):
    """A full filter (4096 bits) makes everything a suspect, and the result stays the same."""
    data = [*random_rows(), (500, None), (501, ""), (502, "\n\n"), (503, "Read more\n" * 3000)]
    out = drop_repeated_lines(documents(data), least, min_length, filter_bits=bits)
    assert rows(out, "doc_id", "kept", "n_lines", "n_dropped") == sorted(brute(data, least, min_length), key=repr)


def test_first_occurrence_stays(documents, rows):
    data = [(i, f"own {i}\nshared\nother {i % 2}") for i in range(12)]
    out = drop_repeated_lines(documents(data), 3, keep_first=True)
    assert rows(out, "doc_id", "kept", "n_lines", "n_dropped") == sorted(brute(data, 3, keep_first=True), key=repr)


def test_repeated_rows_null_ids_and_clashing_columns(spark, rows):
    data = [(1, "same\nown", 5, "a")] * 3 + [(None, "same", 5, "b"), (2, None, None, None)]
    docs = spark.createDataFrame(data, "doc_id long, text string, n_lines int, key string")
    out = drop_repeated_lines(docs, 4)
    assert sorted(out.columns) == ["doc_id", "kept", "key", "n_dropped", "n_lines", "text"]
    assert rows(out, "doc_id", "kept", "n_lines", "n_dropped", "key") == sorted(
        [(1, "own", 2, 1, "a")] * 3 + [(None, "", 1, 1, "b"), (2, "", 1, 0, None)], key=repr)


def test_empty_table(documents):
    assert drop_repeated_lines(documents([])).count() == 0
