from __future__ import annotations

from itertools import product

import pytest

from postlens.llm import chat
from postlens.llm.chat import repair_conversations

SCHEMA = "conv_id long, turn int, role string, text string, cost string"


def legal(roles: list[str]) -> bool:
    rest = roles[1:] if roles[:1] == ["system"] else roles
    return len(rest) % 2 == 0 and bool(rest) and all(r == ("user", "assistant")[k % 2] for k, r in enumerate(rest))


def least_cost(roles: list[str]) -> int:
    """All ways to take the turns, with up to two empty turns before each and after the last."""
    fillers = [list(f) for n in range(3) for f in product(("system", "user", "assistant"), repeat=n)]
    best = 10**9

    def go(k: int, so_far: list[str], cost: int) -> None:
        nonlocal best
        rest = so_far[1:] if so_far[:1] == ["system"] else so_far
        if cost >= best or any(r != ("user", "assistant")[i % 2] for i, r in enumerate(rest)):
            return
        if k == len(roles):
            for f in fillers:
                if legal(so_far + f):
                    best = min(best, cost + 3 * len(f))
            return
        for role in ("system", "user", "assistant"):
            label = 0 if roles[k] == role else 1 if roles[k] not in ("system", "user", "assistant") else 4
            if so_far and so_far[-1] == role:
                go(k + 1, so_far, cost + label + 2)
            for f in fillers:
                go(k + 1, so_far + f + [role], cost + label + 3 * len(f))

    go(0, [], 0)
    return best


CASES = [list(c) for n in (1, 2, 3) for c in product(("system", "user", "assistant", "tool"), repeat=n)]
CASES += [["user", "user", "assistant", "assistant", "user"], ["assistant", "system", "user", "user", "tool"]]


def conversations(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (repr(r["conv_id"]), r["place"])):
        out.setdefault(r["conv_id"], []).append(r)
    return out


def parse(text: str) -> list[tuple[str, str]]:
    out = []
    for part in text.split("<|im_start|>")[1:]:
        role, body = part.split("\n", 1)
        assert body.endswith("<|im_end|>\n")
        out.append((role, body.removesuffix("<|im_end|>\n")))
    return out


def test_against_all_choices(spark):
    rows = [(i, t, r, f"{i}.{t}", "x") for i, case in enumerate(CASES) for t, r in enumerate(case)]
    found = conversations(repair_conversations(spark.createDataFrame(rows, SCHEMA)).collect())
    assert len(found) == len(CASES)
    for i, case in enumerate(CASES):
        assert sum(r["cost"] for r in found[i]) == least_cost(case), case
        turns = parse("".join(r["rendered"] for r in found[i]))
        assert legal([role for role, _ in turns])
        texts = [line for _, body in turns for line in body.split("\n") if line]
        assert texts == [f"{i}.{t}" for t in range(len(case))]


def test_a_long_conversation_is_repaired_as_a_whole(spark):
    roles = ["user", "assistant", "assistant", "user", "user", "tool", "system"] * 60
    rows = [(1, t, r, f"t{t}", None) for t, r in enumerate(roles)] + [(2, 0, "user", "a", None)]
    found = conversations(repair_conversations(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect())
    table = [0] + [chat.NEVER] * 3
    for r in roles:
        table = chat.advance(table, chat.role_number(r))
    assert sum(r["cost"] for r in found[1]) == min(c + chat.ending(s)[0] for s, c in enumerate(table))
    assert legal([role for role, _ in parse("".join(r["rendered"] for r in found[1]))])
    assert [r["place"] for r in found[1]] == list(range(len(roles)))


@pytest.mark.parametrize("rows", [
    [], [(None, None, None, None, None)], [(3, 1, " USER ", None, "x"), (3, 1, "user", None, "x"), (3, 1, "user", "a", "x")],
])
def test_odd_rows(spark, rows):
    found = repair_conversations(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == len(rows)
    for turns in conversations(found).values():
        assert legal([role for role, _ in parse("".join(r["rendered"] for r in turns))])
