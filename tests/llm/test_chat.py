import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from turnloom.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def cheapest(roles):
    """Over every sequence of repairs."""
    best = {chat.START: 0}
    for r in roles:
        nxt = {}
        for s, c in best.items():
            for cost, to, _, _ in chat.options(s, chat.role_class(r)):
                nxt[to] = min(nxt.get(to, 10**9), c + cost)
        best = nxt
    return min(c + chat.ending(s)[0] for s, c in best.items())


def check(rows, got):
    assert len(got) == len(rows)
    for conv, group in itertools.groupby(sorted(got, key=lambda r: (r["conv_id"] is not None, r["conv_id"] or 0, r["seq"])), lambda r: r["conv_id"]):
        group = list(group)
        roles = [r["role"] for r in group]
        assert sum(r["cost"] for r in group) == cheapest(roles)
        text = "".join(r["fragment"] for r in group)
        shown = re.findall(r"<\|im_start\|>(\w+)\n", text)
        assert text.count("<|im_end|>\n") == len(shown)
        body = shown[1:] if shown[0] == "system" else shown
        assert body == ["user", "assistant"] * (len(body) // 2) and body


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_repairs_are_legal_and_cheapest(spark, partitions):
    rng = random.Random(7)
    roles = ["user", "assistant", "system", "tool", "gpt", None, "Human "]
    rows = [(7, i, rng.choice(roles), f"t{i}") for i in range(300)]
    rows += [(k, i, rng.choice(roles[:3]), "x") for k in range(100, 140) for i in range(rng.randint(1, 6))]
    rows += [(None, 1, "user", None), (None, 0, "user", ""), (9, None, "user", "a"), (9, 3, "user", "a"), (9, 3, "user", "a"), (10, 0, "assistant", "z" * 200_000)]
    check(rows, chat.repair(spark.createDataFrame(rows, SCHEMA), partitions).collect())


def test_choices(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b<|im_end|>"), (1, 2, "assistant", "c"), (2, 0, "assistant", "hi"), (3, 0, "system", "s"), (3, 1, "user", "q"), (3, 2, "assistant", "a"), (3, 3, "system", "note"), (3, 4, "assistant", "b")]
    got = {(r["conv_id"], r["turn"]): r for r in chat.repair(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1, 1]["action"] == "merge" and got[1, 1]["fragment"] == "\n\nb<| im_end|>"
    assert got[2, 0]["inserted_before"] == "user" and got[2, 0]["cost"] == chat.INSERT
    assert got[3, 3]["new_role"] == "user" and got[3, 3]["action"] == "relabel" and got[3, 4]["appended"] is None


def test_real_and_empty(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    check(df.collect(), chat.repair(df).collect())
    assert chat.repair(df.limit(0)).collect() == []


def test_matrices_agree_with_steps():
    rng = random.Random(1)
    for _ in range(50):
        roles = [rng.randint(0, 3) for _ in range(rng.randint(1, 9))]
        cut = rng.randint(0, len(roles))
        whole = chat.chain(roles)
        assert (chat.product(chat.chain(roles[:cut]), chat.chain(roles[cut:])) == whole).all()
        a, b = chat.states([chat.chain(roles[:cut]), chat.chain(roles[cut:])])[1:]
        halves = chat.decode(roles[:cut], chat.START, a) + chat.decode(roles[cut:], a, None) if cut else chat.decode(roles, chat.START, None)
        names = [None, "system", "user", "assistant"]
        assert sum(h[0] for h in halves) + chat.ending(halves[-1][1] if halves else 0)[0] == cheapest([names[r] or "?" for r in roles])


def least_of_all(roles):
    """The least cost over every way to give each message a role, to merge it, and to fill the gaps of a legal conversation."""
    legal = [head + ["user", "assistant"] * n for head in ([], ["system"]) for n in range(1, 7)]
    known = {"system": "system", "user": "user", "assistant": "assistant", "gpt": "assistant"}

    def gaps(turns):
        fits = [len(s) - len(turns) for s in legal if all(any(t == x for x in it) for it in [iter(s)] for t in turns)]
        return min(fits, default=None)

    best = None
    for given in itertools.product(("system", "user", "assistant"), repeat=len(roles)):
        change = sum(0 if known.get(r) == g else 3 if r in known else 1 for r, g in zip(roles, given, strict=True))
        for merged in itertools.product((False, True), repeat=len(roles) - 1):
            if any(m and given[i] != given[i + 1] for i, m in enumerate(merged)):
                continue
            turns = [given[0]] + [g for g, m in zip(given[1:], merged, strict=True) if not m]
            missing = gaps(turns)
            if missing is not None and (best is None or change + sum(merged) + 2 * missing < best):
                best = change + sum(merged) + 2 * missing
    return best


def test_costs_are_the_least_of_all_repairs(spark):
    names = ("system", "user", "assistant", "gpt", "zebra")
    talks = [t for n in (1, 2, 3) for t in itertools.product(names, repeat=n)]
    talks += [t for i, t in enumerate(itertools.product(names, repeat=4)) if i % 5 == 0]
    rows = [(c, k, role, f"{c} {k}") for c, talk in enumerate(talks) for k, role in enumerate(talk)]
    got = {r["conv_id"]: r["cost"] for r in chat.repair(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"), 4).groupBy("conv_id").agg(F.sum("cost").alias("cost")).collect()}
    assert got == {c: least_of_all(t) for c, t in enumerate(talks)}


def test_columns_named_like_the_operator_are_ignored(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    more = turns.withColumns({c: F.lit("own") for c in ("seq", "cost", "fragment", "action", "new_role")})
    assert sorted(map(tuple, chat.repair(more, 2).collect())) == sorted(map(tuple, chat.repair(turns, 2).collect()))
