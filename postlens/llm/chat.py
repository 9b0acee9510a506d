"""Repairing the roles of conversations at least cost, and rendering them."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import shuffle_width, staged

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("", "system", "user", "assistant")
#: The automaton of legal turns: an optional system turn, then user and assistant in turn, the last one the assistant's.
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
FINAL = ASSISTANT
MERGE_COST, RELABEL_COST, UNKNOWN_COST, INSERT_COST = 2, 4, 1, 3
NEVER = 10**9

Step = tuple[int, str, tuple[int, ...]]  # cost, action, roles of empty turns before


def _fillers(state: int, goal: int) -> tuple[int, ...] | None:
    """The fewest empty turns after which ``goal`` is legal; None if it never is."""
    ways: list[tuple[int, tuple[int, ...]]] = [(state, ())]
    seen = {state}
    for at, roles in ways:
        if goal in NEXT[at]:
            return roles
        for role in NEXT[at]:
            if role not in seen:
                seen.add(role)
                ways.append((role, (*roles, role)))
    return None


def _steps(role: int) -> dict[tuple[int, int], Step]:
    """The best way to take a turn of this role (START: unknown) from one state to another.

    Ties fall to the first of: as it is, relabelled, after empty turns, merged.
    """
    best: dict[tuple[int, int], Step] = {}
    for state, goal in product(range(4), (SYSTEM, USER, ASSISTANT)):
        label = 0 if role == goal else UNKNOWN_COST if role == START else RELABEL_COST
        ways: list[Step] = []
        roles = _fillers(state, goal)
        if roles is not None:
            ways.append((label + INSERT_COST * len(roles), "relabel" if label else "keep", roles))
        if state == goal:
            ways.append((label + MERGE_COST, "merge", ()))
        if ways:
            best[state, goal] = min(ways, key=lambda w: w[0])
    return best


STEPS = {role: _steps(role) for role in range(4)}
MOVES = {role: sorted((s, t, step[0]) for (s, t), step in STEPS[role].items()) for role in range(4)}


def ending(state: int) -> tuple[int, tuple[int, ...]]:
    """What it costs to end in this state, and the empty turns that do."""
    if state in (FINAL, START):
        return 0, ()
    roles = (*_fillers(state, FINAL), FINAL)
    return INSERT_COST * len(roles), roles


def role_number(role: str | None) -> int:
    name = role.strip().lower() if role else ""
    return ROLES.index(name) if name in ROLES else START


def advance(costs: list[int], role: int) -> list[int]:
    out = [NEVER] * 4
    for s, t, cost in MOVES[role]:
        if costs[s] + cost < out[t]:
            out[t] = costs[s] + cost
    return out


def least_path(roles: list[int], entry: int, leave: int) -> list[tuple[int, int]]:
    """(state before, state after) of each turn on the cheapest way from ``entry`` to ``leave``; ties fall to lower states."""
    table = [[0 if s == entry else NEVER for s in range(4)]]
    for role in roles:
        table.append(advance(table[-1], role))
    path, state = [], leave
    for k in range(len(roles) - 1, -1, -1):
        before = next(s for s in range(4) if (s, state) in STEPS[roles[k]]
                      and table[k][s] + STEPS[roles[k]][s, state][0] == table[k + 1][state])
        path.append((before, state))
        state = before
    return path[::-1]


def opening(role: int) -> str:
    return f"<|im_start|>{ROLES[role]}\n"


CLOSING = "<|im_end|>\n"


def _render(before: int, after: int, step: Step, text: str) -> str:
    """A turn's part of the conversation: what it closes and opens, and its text."""
    if step[1] == "merge":
        return f"\n{text}"
    empty = "".join(opening(r) + CLOSING for r in step[2])
    return (CLOSING if before != START else "") + empty + opening(after) + text


def repair_conversations(turns: DataFrame) -> DataFrame:
    """Repair (conv_id, turn, role, text) rows to legal conversations at the least cost, and render them.

    Legal is an optional system turn, then user and assistant in turn, ending with the
    assistant. A turn may be kept, relabelled, merged into the one before or follow
    empty turns; dynamic programming over the states of that automaton finds the cheapest choice.

    One row per turn: conv_id, place (from 0), turn, role, new_role, action (keep, relabel, merge),
    inserted (roles of empty turns before it), cost, ending (roles of empty turns after the last one),
    rendered. The rendered parts of a conversation, by place, are its text.

    Turns go by number, null first, then by role and text, so ties and repeated rows have one
    order. Roles are compared without case and white space; null and other roles are unknown
    and cheap to relabel. A null text is empty. A null conv_id is an id like any other.
    No rows give no rows; other columns are not read.

    Turns are dealt by ranges, so a long conversation is spread over tasks: each piece
    says what it costs from any state to any other, pieces are chained by those
    sixteen numbers, and then every piece is repaired by itself.
    """
    spark = turns.sparkSession
    width = shuffle_width(spark)
    id_type, turn_type = (turns.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    order = ["conv_id", "turn", "role", F.xxhash64("text")]
    dealt = turns.select("conv_id", "turn", "role", "text").repartitionByRange(width, *order).sortWithinPartitions(*order)

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        piece, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            yield batch.assign(piece=piece, seq=range(at, at + len(batch)))
            at += len(batch)

    fields = f"conv_id {id_type}, turn {turn_type}, role string, text string"
    numbered = staged(dealt.mapInPandas(number, f"{fields}, piece int, seq long"), "turns")

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, costs, n, first = None, None, 0, 0
        for batch in batches:
            out = []
            for conv, piece, seq, role in zip(_keys(batch["conv_id"]), batch["piece"], batch["seq"], batch["role"]):
                if (piece, conv) != key:
                    if key:
                        out.append((*key, first, n, sum(costs, [])))
                    key, n, first = (piece, conv), 0, seq
                    costs = [[0 if s == t else NEVER for t in range(4)] for s in range(4)]
                kind = role_number(role)
                costs, n = [advance(c, kind) for c in costs], n + 1
            yield pd.DataFrame(out, columns=["piece", "conv_id", "first", "n", "costs"])
        if key:
            yield pd.DataFrame([(*key, first, n, sum(costs, []))], columns=["piece", "conv_id", "first", "n", "costs"])

    pieces = (numbered.select("conv_id", "piece", "seq", "role").repartition(width, "piece").sortWithinPartitions("piece", "seq")
              .mapInPandas(weigh, f"piece int, conv_id {id_type}, first long, n long, costs array<long>"))

    def chain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, held = None, []
        for batch in batches:
            out = []
            for row in zip(_keys(batch["conv_id"]), batch["piece"], batch["n"], batch["costs"]):
                if held and row[0] != conv:
                    out += _chained(held)
                    held = []
                conv = row[0]
                held.append(row)
            yield pd.DataFrame(out, columns=["conv_id", "piece", "before", "entry", "leave", "last"])
        if held:
            yield pd.DataFrame(_chained(held), columns=["conv_id", "piece", "before", "entry", "leave", "last"])

    chained = pieces.repartition(width, "conv_id").sortWithinPartitions("conv_id", "piece").mapInPandas(
        chain, f"conv_id {id_type}, piece int, before long, entry int, leave int, last boolean")

    ends = chained.select("piece", "conv_id", F.lit(-1).cast("long").alias("seq"), "before", "entry", "leave", "last",
                          F.lit(None).cast(turn_type).alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    rows = numbered.select("piece", "conv_id", "seq", F.lit(0).cast("long").alias("before"), F.lit(0).alias("entry"), F.lit(0).alias("leave"),
                           F.lit(False).alias("last"), "turn", "role", "text")
    together = ends.unionByName(rows).repartition(width, "piece").sortWithinPartitions("piece", "conv_id", "seq")

    def repair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        head, held = None, []
        for batch in batches:
            out = []
            for conv, row in zip(_keys(batch["conv_id"]), batch.drop(columns=["piece", "conv_id"]).itertuples(index=False)):
                if row.seq < 0:
                    if head:
                        out += _repaired(head, held)
                    head, held = (conv, row), []
                else:
                    held.append(row)
            yield frame(out)
        if head:
            yield frame(_repaired(head, held))

    def frame(out: list[tuple]) -> pd.DataFrame:
        names = ["conv_id", "place", "turn", "role", "new_role", "action", "inserted", "cost", "ending", "rendered"]
        columns = {n: [r[k] for r in out] for k, n in enumerate(names)}
        return pd.DataFrame({n: pd.Series(v, dtype=object) for n, v in columns.items()})

    return together.mapInPandas(repair, f"conv_id {id_type}, place long, turn {turn_type}, role string, new_role string, action string, "
                                        "inserted array<string>, cost long, ending array<string>, rendered string")


def _keys(ids: pd.Series) -> list:
    """Ids that compare equal when null."""
    return [None if pd.isna(x) else x for x in ids.astype(object)]


def _chained(pieces: list[tuple]) -> list[tuple]:
    """pieces (conv_id, piece, turns, costs) of one conversation in order; which states each is entered and left in."""
    table = [[0, NEVER, NEVER, NEVER]]
    for _, _, _, costs in pieces:
        table.append([min(table[-1][s] + costs[4 * s + t] for s in range(4)) for t in range(4)])
    state = min(range(4), key=lambda t: (table[-1][t] + ending(t)[0], t))
    out = []
    for k in range(len(pieces) - 1, -1, -1):
        conv, piece, _, costs = pieces[k]
        before = next(s for s in range(4) if table[k][s] + costs[4 * s + state] == table[k + 1][state])
        out.append((conv, piece, sum(p[2] for p in pieces[:k]), before, state, k == len(pieces) - 1))
        state = before
    return out[::-1]


def _repaired(head: tuple, held: list) -> list[tuple]:
    conv, way = head
    roles = [role_number(row.role) for row in held]
    out = []
    for k, (row, role, (before, after)) in enumerate(zip(held, roles, least_path(roles, way.entry, way.leave))):
        step = STEPS[role][before, after]
        rendered, cost, closing = _render(before, after, step, row.text or ""), step[0], ()
        if way.last and k == len(held) - 1:
            extra, closing = ending(after)
            cost += extra
            rendered += CLOSING + "".join(opening(r) + CLOSING for r in closing)
        out.append((conv, way.before + k, None if pd.isna(row.turn) else row.turn, row.role, ROLES[after], step[1],
                    [ROLES[r] for r in step[2]], cost, [ROLES[r] for r in closing], rendered))
    return out
