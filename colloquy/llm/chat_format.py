"""Chat formatting with minimum-cost role repair.

A legal chat is an optional system turn, then user and assistant in turn, ending
with an assistant; tool turns stand after an assistant or another tool turn and lead
back to an assistant. Dynamic programming over that automaton finds the cheapest way
to make a conversation legal: each turn keeps its role or is relabelled, is joined
to the turn before or starts a new one, and empty turns may be inserted. The
repaired sequence is then rendered. Ties are settled by the order of the choices
in the code, so the result does not depend on how rows are dealt.

A sorted stream of turns is read once; a task holds one conversation at a time.

Defined cases: turns are in order of turn, then role and text; null turns come
first; a null or unknown role may become any role but tool at the price of a relabelling;
a null text is empty; a text that holds a turn mark has it broken by a space; each row
with a null conv_id is a conversation of its own; repeated rows are turns of their own;
a text of any length is kept whole; repairs of equal cost tie as the choices stand in
the code; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship

ROLES = ("system", "user", "assistant", "tool")
START = -1
#: Role after role that is legal without repair.
FOLLOWS = {(START, 0), (START, 1), (0, 1), (1, 2), (2, 1), (2, 3), (3, 3), (3, 2)}
#: Turns to insert at the end of a chat that ends with this role.
ENDS = {START: (), 0: (1, 2), 1: (2,), 2: (), 3: (2,)}
KEEP, RELABEL, MERGE, INSERT = 0, 2, 1, 3


def _ways(state: int, role: int) -> tuple[int, tuple[int, ...]] | None:
    """Cost and inserted roles to start a turn of that role after state; None if none is legal."""
    if (state, role) in FOLLOWS:
        return KEEP, ()
    for between in (1, 2):
        if (state, between) in FOLLOWS and (between, role) in FOLLOWS:
            return INSERT, (between,)
    return None


def _paths(state: int, role: int) -> tuple[int, tuple[int, ...]] | None:
    """As _ways, with two inserted roles where one is not enough."""
    if found := _ways(state, role):
        return found
    for first in (1, 2):
        if (state, first) in FOLLOWS and (found := _ways(first, role)):
            return INSERT + found[0], (first, *found[1])
    return None


_START_TURN = {(s, r): w for s in (START, *range(len(ROLES))) for r in range(len(ROLES)) if (w := _paths(s, r))}


def repair(roles: list[str | None]) -> tuple[int, list[tuple[int, list[int]]], int, int, int]:
    """Least cost, the repaired turns (role, places of the joined turns), and how many were merged, relabelled, inserted."""
    table = [{START: (0, None, None, None)}]  # state -> cost, state before, how, role
    for given in roles:
        number = ROLES.index(given) if given in ROLES else None
        row: dict[int, tuple] = {}
        for state, (cost, *_) in table[-1].items():
            for role in range(len(ROLES)):
                if role == 3 and number != 3:
                    continue  # no other turn becomes a tool's
                price = cost + (KEEP if role == number else RELABEL)
                steps = []
                if state == role:
                    steps.append((price + MERGE, "merge", ()))
                if (state, role) in _START_TURN:
                    extra, between = _START_TURN[state, role]
                    steps.append((price + extra, "start", between))
                for total, how, between in steps:
                    if role not in row or total < row[role][0]:
                        row[role] = (total, state, how, between)
        table.append(row)
    ends = {}
    for state, (cost, *_) in table[-1].items():
        ends[state] = (cost + INSERT * len(ENDS[state]), ENDS[state])
    state = min(ends, key=lambda s: (ends[s][0], s))
    cost, tail = ends[state]
    turns: list[tuple[int, list[int]]] = [(r, []) for r in reversed(tail)]
    inserted, merged, changed = len(tail), 0, 0
    joined: list[int] = []
    for place in range(len(roles), 0, -1):
        _, before, how, between = table[place][state]
        joined.append(place - 1)
        changed += roles[place - 1] != ROLES[state]
        if how == "merge":
            merged += 1
        else:
            turns.append((state, joined[::-1]))
            joined = []
            turns += [(r, []) for r in reversed(between)]
            inserted += len(between)
        state = before
    return cost, turns[::-1], merged, changed, inserted


def plain(text: str) -> str:
    """Text whose turn marks are broken by a space, so that it cannot end or begin a turn."""
    return text.replace("<|im_start|>", "<|im_start |>").replace("<|im_end|>", "<|im_end |>")


def render(turns: list[tuple[int, list[int]]], texts: list[str]) -> str:
    return "".join(f"<|im_start|>{ROLES[r]}\n" + "\n\n".join(plain(texts[i]) for i in places) + "<|im_end|>\n" for r, places in turns)


def format_chats(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_out, cost, n_merged, n_relabelled, n_inserted, rendered of each conversation.

    turns: conv_id, turn, role, text.
    """
    ship(turns.sparkSession)
    names = ["conv_id", "n_turns", "n_out", "cost", "n_merged", "n_relabelled", "n_inserted", "rendered"]
    types = [pa.int64(), *[pa.int32()] * 6, pa.string()]

    def run(batches):
        current, roles, texts, rows = None, [], [], []

        def finish():
            cost, out, merged, changed, inserted = repair(roles)
            rows.append((current, len(roles), len(out), cost, merged, changed, inserted, render(out, texts)))

        for batch in batches:
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if roles and (conv != current or conv is None):
                    finish()
                    roles, texts = [], []
                current = conv
                roles.append(role)
                texts.append(text or "")
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                rows.clear()
        if roles:
            finish()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    ordered = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.lower(F.trim("role")).alias("role"), "text").repartition(F.coalesce("conv_id", F.xxhash64("text", "turn", "role"))).sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(run, "conv_id long, n_turns int, n_out int, cost int, n_merged int, n_relabelled int, n_inserted int, rendered string")
