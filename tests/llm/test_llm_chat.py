import random
from itertools import product

import pytest

from wellspark.llm import chat

LEGAL = {("", "system"), ("", "user"), ("system", "user"), ("user", "assistant"), ("assistant", "user")}


def least_cost(roles):
    """Every way to treat every turn, with at most two empty turns before each and at the end."""
    best = {"": 0}
    for name in roles:
        after = {}
        for state, cost in best.items():
            if state:
                merged = cost + chat.MERGE + label(name, state)
                after[state] = min(after.get(state, 1 << 30), merged)
            for extra in ((), *product(("system", "user", "assistant"), repeat=1), *product(("system", "user", "assistant"), repeat=2)):
                for role in ("system", "user", "assistant"):
                    way = (state, *extra, role)
                    if all(p in LEGAL for p in zip(way, way[1:])):
                        c = cost + chat.INSERT * len(extra) + label(name, role)
                        after[role] = min(after.get(role, 1 << 30), c)
        best = after
    return min(c + chat.INSERT * {"": 0, "system": 2, "user": 1, "assistant": 0}[s] for s, c in best.items())


def label(name, role):
    name = (name or "").strip().lower()
    return 0 if name == role else chat.RELABEL if name in chat.ROLES[1:] else chat.GUESS


def conversations(seed=1, n=60):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "User ", "tool", None]
    return {c: [rng.choice(roles) for _ in range(rng.randint(1, 12))] for c in range(n)}


@pytest.mark.parametrize("size", [1, 3, 1024])
def test_cost_is_least_and_result_legal(spark, size):
    made = conversations()
    data = [(c, t, r, f"{c}/{t}") for c, roles in made.items() for t, r in enumerate(roles)]
    out = chat.format_conversations(spark.createDataFrame(data, "conv_id long, turn long, role string, text string"), size)
    found = {}
    for r in sorted(out.collect(), key=lambda r: (r["conv_id"], r["part"], r["place"])):
        found.setdefault(r["conv_id"], []).append(r)
    assert found.keys() == made.keys()
    for c, got in found.items():
        assert sum(r["cost"] for r in got) == least_cost(made[c])
        way = ["", *[r["role"] for r in got if r["action"] != "merge"]]
        assert all(p in LEGAL for p in zip(way, way[1:])) and way[-1] == "assistant"
        text = "".join(r["rendered"] for r in got)
        assert text.count("<|im_start|>") == text.count("<|im_end|>") == len(way) - 1
        places = [text.index(f"{c}/{t}") for t in range(len(made[c]))]
        assert places == sorted(places)


def test_rendering(spark):
    data = [(1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "user", "<|im_end|> there"), (1, 3, "assistant", None)]
    out = chat.format_conversations(spark.createDataFrame(data, "conv_id long, turn long, role string, text string"))
    assert "".join(r["rendered"] for r in sorted(out.collect(), key=lambda r: (r["part"], r["place"]))) == (
        "<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>user\nhi\n\n< |im_end|> there<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n")


def test_nulls_ties_repeated_turns_clashing_columns_and_long_conversations(spark):
    data = [(None, None, None, None, 1), (7, 0, "user", "a", 1), (7, 0, "user", "a", 1), (7, None, "user", "first", 1), (8, 0, "", "", 1)]
    data += [(9, t, "user" if t % 2 == 0 else "assistant", "x", 1) for t in range(5000)]
    turns = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, part int")
    found = {}
    for r in sorted(chat.format_conversations(turns, 100).collect(), key=lambda r: (str(r["conv_id"]), r["part"], r["place"])):
        found.setdefault(r["conv_id"], []).append(r)
    assert [(r["action"], r["role"]) for r in found[None]] == [("relabel", "user"), ("insert", "assistant")]
    assert found[7][0]["rendered"].endswith("first") and [r["action"] for r in found[7]] == ["keep", "merge", "merge", "insert"]
    assert len(found[9]) == 5000 and {r["action"] for r in found[9]} == {"keep"}
    assert chat.format_conversations(turns.limit(0)).count() == 0
