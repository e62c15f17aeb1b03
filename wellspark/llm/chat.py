"""Chat formatting: the cheapest legal sequence of turns, and its rendering."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspark.llm.shared import partitions, shared_table

SLICE = 1024  # turn numbers that are repaired at a time
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("", "system", "user", "assistant")
# After a state: the roles that may follow. A conversation ends after an assistant's turn.
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
MERGE, RELABEL, INSERT, GUESS = 1, 6, 4, 1  # costs; GUESS: a role for a turn that has none
FAR = 1 << 40
_OPEN, _CLOSE = "<|im_start|>{}\n", "<|im_end|>\n"


def role_of(name: str | None) -> int:
    """The number of a role, 0 for null and unknown names."""
    name = (name or "").strip().lower()
    return ROLES.index(name) if name in ROLES else 0


def _steps(role: int) -> dict[tuple[int, int], tuple[int, str, tuple[int, ...]]]:
    """Per (state, next state): the cheapest way to take a turn of this role: cost, action, insertions.

    Of equally cheap ways the order is keep, merge, relabel, insert.
    """
    found: dict[tuple[int, int], tuple[int, int, str, tuple[int, ...]]] = {}

    def offer(s: int, t: int, cost: int, rank: int, action: str, inserted: tuple[int, ...] = ()):
        if (s, t) not in found or (cost, rank) < found[s, t][:2]:
            found[s, t] = cost, rank, action, inserted

    def label(t: int) -> tuple[int, str]:
        return (0, "keep") if t == role else (GUESS if role == 0 else RELABEL, "relabel")

    for s in range(4):
        if s != START:
            offer(s, s, MERGE + label(s)[0], 1, "merge")
        for t in NEXT[s]:
            cost, action = label(t)
            offer(s, t, cost, 0 if action == "keep" else 2, action)
            for u in NEXT[t]:
                cost, action = label(u)
                offer(s, u, INSERT + cost, 3, action, (t,))
    return {k: (v[0], v[2], v[3]) for k, v in found.items()}


STEPS = [_steps(r) for r in range(4)]
COSTS = np.full((4, 4, 4), FAR, np.int64)
for _r, _table in enumerate(STEPS):
    for (_s, _t), _way in _table.items():
        COSTS[_r, _s, _t] = _way[0]
ENDING = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}


def cost_matrix(roles: Iterable[int]) -> np.ndarray:
    """Least cost from every state before the turns to every state after them."""
    out = np.where(np.eye(4, dtype=bool), 0, FAR)
    for r in roles:
        out = np.minimum((out[:, :, None] + COSTS[r][None]).min(axis=1), FAR)
    return out


def best_states(matrices: list[np.ndarray], end: np.ndarray) -> list[int]:
    """The states around the matrices on the cheapest way from START; of equal ones the smallest."""
    behind = [end]
    for m in reversed(matrices):
        behind.append(np.minimum((m + behind[-1][None, :]).min(axis=1), FAR))
    behind.reverse()
    states = [START]
    for m, after in zip(matrices, behind[1:]):
        states.append(int((m[states[-1]] + after).argmin()))
    return states


def end_costs() -> np.ndarray:
    return np.array([len(ENDING[s]) * INSERT for s in range(4)], np.int64)


def repair(roles: list[int], first: int, last: int) -> list[tuple[int, str, tuple[int, ...]]]:
    """Per turn: state after it, action and inserted roles, on the cheapest way between two states."""
    end = np.full(4, FAR, np.int64)
    end[last] = 0
    behind = [end]
    for r in reversed(roles):
        behind.append(np.minimum((COSTS[r] + behind[-1][None, :]).min(axis=1), FAR))
    behind.reverse()
    out, s = [], first
    for r, after in zip(roles, behind[1:]):
        t = int((COSTS[r][s] + after).argmin())
        _, action, inserted = STEPS[r][s, t]
        out.append((t, action, inserted))
        s = t
    return out


def render(text: str | None, state: int, before: int, action: str) -> str:
    """The part of the conversation that a turn adds: the end of the turn before, its own start, its text."""
    body = (text or "").replace("<|", "< |")  # a text cannot hold a mark of the format
    if action == "merge":
        return "\n\n" + body
    return (_CLOSE if before != START else "") + _OPEN.format(ROLES[state]) + body


def format_conversations(turns: DataFrame, slice_size: int = SLICE) -> DataFrame:
    """The repaired turns of ``turns`` (conv_id, turn, role, text), in rows that joined give the text.

    Columns: conv_id, part, place, turn, role, action (keep, merge, relabel, insert), cost,
    rendered. The rendered parts of a conversation in the order of part and place are its text.
    Turns go by number, null first, then by role and text. Legal is: a system turn or none, then
    user and assistant in turn, ending with the assistant. Each turn is kept, relabelled or merged
    into the one before; empty turns are inserted; the whole way has the least cost.

    A conversation of any length is cut into parts of ``slice_size`` turn numbers. Each part gives
    its cost from every state to every state, these small matrices are solved per conversation,
    and each part is then repaired between its two states. Null and unknown roles are guessed at a
    low cost, null texts are empty, repeated turns are turns like others, null ids are one
    conversation. An empty table gives an empty result.
    """
    spark, kinds = turns.sparkSession, dict(turns.dtypes)
    ids = f"conv_id {kinds['conv_id']}, part long"
    part = F.floor(F.coalesce(F.col("turn"), F.lit(0)) / slice_size).cast("long")
    rows = turns.select("conv_id", part.alias("part"), "turn", "role", "text")
    # Costs follow from the roles, whose order among equal turn numbers the texts do not change.
    dealt = (rows.select("conv_id", "part", "turn", "role").repartition(partitions(spark), "conv_id", "part")
             .sortWithinPartitions("conv_id", "part", "turn", "role"))

    def groups(batches, columns: int):
        """(key, rows) of each conversation and part, also where it spans batches."""
        def each():
            for batch in batches:
                yield from zip(*(batch.column(i).to_pylist() for i in range(columns)))

        return groupby(each(), key=lambda r: r[:2])

    def matrices(batches):
        out, kind = [], schema(kinds["conv_id"], [("costs", pa.list_(pa.int64()))])
        for k, g in groups(batches, 3):
            out.append((*k, cost_matrix(role_of(r[2]) for r in g).ravel().tolist()))
            if len(out) == 1000:
                yield _batch(out, kind)
                out = []
        yield _batch(out, kind)

    costs = shared_table(dealt.select("conv_id", "part", "role").mapInArrow(matrices, f"{ids}, costs array<long>"))

    def solved(batches):
        def each():
            for batch in batches:
                yield from zip(*(batch.column(i).to_pylist() for i in range(3)))

        out, kind = [], schema(kinds["conv_id"], [("first", pa.int32()), ("last", pa.int32()), ("ends", pa.bool_())])
        for conv, g in groupby(each(), key=lambda r: r[0]):
            g = list(g)
            states = best_states([np.array(r[2], np.int64).reshape(4, 4) for r in g], end_costs())
            out += [(conv, r[1], states[i], states[i + 1], i == len(g) - 1) for i, r in enumerate(g)]
            if len(out) > 1000:
                yield _batch(out, kind)
                out = []
        yield _batch(out, kind)

    states = (costs.repartition(partitions(spark), "conv_id").sortWithinPartitions("conv_id", "part")
              .mapInArrow(solved, f"{ids}, first int, last int, ends boolean")
              .withColumnsRenamed({"conv_id": "_conv", "part": "_part"}))
    joined = rows.join(states, rows["conv_id"].eqNullSafe(states["_conv"]) & (rows["part"] == states["_part"]))
    by = ["conv_id", "part", "turn", "role", "text"]
    again = (joined.select("conv_id", "part", "turn", "role", "text", "first", "last", "ends")
             .repartition(partitions(spark), "conv_id", "part").sortWithinPartitions(*by))
    columns = [("place", pa.int32()), ("turn", _arrow(kinds["turn"])), ("role", pa.string()), ("action", pa.string()),
               ("cost", pa.int32()), ("rendered", pa.string())]

    def repaired(batches):
        out = []
        for (conv, number), g in groups(batches, 8):
            g = list(g)
            roles = [role_of(r[3]) for r in g]
            state, place = g[0][5], 0
            for r, role, (t, action, inserted) in zip(g, roles, repair(roles, g[0][5], g[0][6])):
                cost = STEPS[role][state, t][0]
                for u in inserted:
                    out.append((conv, number, place, r[2], ROLES[u], "insert", INSERT, render("", u, state, "insert")))
                    state, place, cost = u, place + 1, cost - INSERT
                out.append((conv, number, place, r[2], ROLES[t], action, cost, render(r[4], t, state, action)))
                state, place = t, place + 1
            if g[0][7]:
                for u in ENDING[state]:
                    out.append((conv, number, place, g[-1][2], ROLES[u], "insert", INSERT, render("", u, state, "insert")))
                    state, place = u, place + 1
                out[-1] = (*out[-1][:-1], out[-1][-1] + _CLOSE)
            if len(out) > 5000:
                yield _batch(out, schema(kinds["conv_id"], columns))
                out = []
        yield _batch(out, schema(kinds["conv_id"], columns))

    return again.mapInArrow(repaired, f"{ids}, place int, turn {kinds['turn']}, role string, action string, cost int, rendered string")


def _arrow(name: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[name]


def schema(conv_id: str, columns: list[tuple[str, pa.DataType]]) -> pa.Schema:
    return pa.schema([("conv_id", _arrow(conv_id)), ("part", pa.int64()), *columns])


def _batch(rows: list[tuple], kind: pa.Schema) -> pa.RecordBatch:
    data = zip(*rows) if rows else [[] for _ in kind]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(data, kind)], schema=kind)
