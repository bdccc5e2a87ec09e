"""Chat formatting by minimum-cost role repair.

A conversation is legal when an optional system message is followed by user and
assistant in turn, ending with assistant.  Dynamic programming over the automaton of
legal turns (its state is the last role) chooses the cheapest repair: keep a
message, merge it into the one before (`MERGE`), give it another role
(`RELABEL`; `ALIAS_FREE` names cost nothing, an unknown role `UNKNOWN`), or put
empty messages before it or at the end (`INSERT` each).  Ties go to the option listed first in
`options`, and between states to the earlier one.

Scale: turns are range-sorted by (conversation, turn), so that a conversation of any
length is dealt over partitions.  A stretch of turns acts on the automaton as a
4 x 4 min-plus matrix; each partition reports the matrices of its first and last
conversation only, these few are chained on the driver, and each partition then
decodes its own turns between known states, one conversation's stretch at a time.  No
conversation is ever gathered.

One row per input turn: its action, its role after repair, what is inserted before
or appended after it, its cost, and its fragment; the rendered conversation is the
concatenation of its fragments in `seq` order.

Defined results: a null text is an empty message; a null or unknown role is an
unknown role; turns with equal numbers are ordered by role and text; rows with a
null conv_id are one conversation; marks of the template inside texts are broken
up; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_dir

MERGE, RELABEL, INSERT, UNKNOWN = 1, 3, 2, 1
ROLES = ("", "system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
ALIAS_FREE = {"human": USER, "prompter": USER, "gpt": ASSISTANT, "bot": ASSISTANT, "model": ASSISTANT, "ai": ASSISTANT, "developer": SYSTEM}
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
INF = 1 << 40
OUT_ROWS = 5000
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def role_class(role: str | None) -> int:
    """1 to 3 for a known role or an alias, 0 for any other."""
    name = (role or "").strip().lower()
    return ROLES.index(name) if name in ROLES[1:] else ALIAS_FREE.get(name, 0)


@cache
def options(state: int, role: int) -> tuple[tuple[int, int, str, int], ...]:
    """(cost, next state, action, inserted role) of every repair of a message in a state."""
    out = []
    for to in (SYSTEM, USER, ASSISTANT):
        change = 0 if to == role else (RELABEL if role else UNKNOWN)
        word = "" if to == role else "relabel"
        if to in LEGAL[state]:
            out.append((change, to, word or "keep", 0))
        if to == state:
            out.append((change + MERGE, to, f"{word}+merge" if word else "merge", 0))
        for between in LEGAL[state]:
            if to not in LEGAL[state] and to in LEGAL[between]:
                out.append((change + INSERT, to, word or "keep", between))
    return tuple(out)


@cache
def step(role: int) -> np.ndarray:
    m = np.full((4, 4), INF, np.int64)
    for s in range(4):
        for cost, to, _, _ in options(s, role):
            m[s, to] = min(m[s, to], cost)
    return m


def ending(state: int) -> tuple[int, tuple[int, ...]]:
    """(cost, roles appended) that make a conversation end legally after a state."""
    missing = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}[state]
    return INSERT * len(missing), missing


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), INF)


def chain(roles: list[int]) -> np.ndarray:
    m = np.where(np.eye(4, dtype=bool), 0, INF)
    for r in roles:
        m = product(m, step(r))
    return m


def states(matrices: list[np.ndarray]) -> list[int]:
    """The states between the stretches of one conversation, on a cheapest path from START to a legal end."""
    best = [np.where(np.arange(4) == START, 0, INF)]
    for m in matrices:
        best.append(np.minimum((best[-1][:, None] + m).min(axis=0), INF))
    total = best[-1] + np.array([ending(s)[0] for s in range(4)])
    path = [int(np.argmin(total))]
    for m, b in zip(matrices[::-1], best[-2::-1], strict=True):
        path.append(int(np.argmin(b + m[:, path[-1]])))
    return path[::-1]


def decode(roles: list[int], first: int, last: int | None) -> list[tuple[int, int, str, int]]:
    """(cost, state, action, inserted) by message, from state `first` to `last` (None: to the cheapest legal end)."""
    cost = {first: 0}
    back: list[dict[int, tuple[int, tuple]]] = []
    for r in roles:
        nxt: dict[int, int] = {}
        how: dict[int, tuple[int, tuple]] = {}
        for s in sorted(cost):
            for o in options(s, r):
                c = cost[s] + o[0]
                if c < nxt.get(o[1], INF):
                    nxt[o[1]], how[o[1]] = c, (s, o)
        cost = nxt
        back.append(how)
    at = last if last is not None else min(sorted(cost), key=lambda s: cost[s] + ending(s)[0])
    out = []
    for how in reversed(back):
        prev, o = how[at]
        out.append((o[0], at, o[2], o[3]))
        at = prev
    return out[::-1]


def _clean(text: str | None) -> str:
    return (text or "").replace("<|im_", "<| im_")


def fragments(rows: list[tuple], first: int, last: int | None, ends: bool) -> list[tuple]:
    """rows are (conv_id, turn, role, text, seq) of one conversation, or of a stretch of one."""
    out, state = [], first
    made = decode([role_class(r[2]) for r in rows], first, last)
    for n, ((conv, turn, role, text, seq), (cost, to, action, inserted)) in enumerate(zip(rows, made, strict=True)):
        if action.endswith("merge"):
            piece = "\n\n" + _clean(text)
        else:
            piece = (CLOSE if state != START else "") + (f"{OPEN}{ROLES[inserted]}\n{CLOSE}" if inserted else "") + f"{OPEN}{ROLES[to]}\n" + _clean(text)
        appended: tuple[int, ...] = ()
        if ends and n == len(rows) - 1:
            more, appended = ending(to)
            cost += more
            piece += CLOSE + "".join(f"{OPEN}{ROLES[r]}\n{CLOSE}" for r in appended)
        out.append((conv, turn, seq, role, ROLES[to], action, ROLES[inserted] or None, ",".join(ROLES[r] for r in appended) or None, cost, piece))
        state = to
    return out


COLUMNS = (
    ("conv_id", "bigint", pa.int64()),
    ("turn", "bigint", pa.int64()),
    ("seq", "bigint", pa.int64()),
    ("role", "string", pa.string()),
    ("new_role", "string", pa.string()),
    ("action", "string", pa.string()),
    ("inserted_before", "string", pa.string()),
    ("appended", "string", pa.string()),
    ("cost", "int", pa.int32()),
    ("fragment", "string", pa.string()),
)


def _stretches(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[list[tuple]]:
    """Runs of equal conv_id in a partition, in bounded pieces: a run that goes on in the next batch is cut there."""
    for batch in batches:
        rows = list(zip(*[batch.column(c).to_pylist() for c in columns], strict=True))
        a = 0
        for b in range(1, len(rows) + 1):
            if b == len(rows) or rows[b][0] != rows[a][0]:
                yield rows[a:b]
                a = b


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First and last conversation of the partition: (part, last?, conv_id, matrix, only one)."""
    first = None
    conv, m = None, None
    for run in _stretches(batches, ("conv_id", "role")):
        part = chain([role_class(r[1]) for r in run])
        if m is not None and run[0][0] == conv:
            m = product(m, part)
        else:
            if m is not None and first is None:
                first = (conv, m)
            conv, m = run[0][0], part
    if m is None:
        return
    only = first is None
    rows = [(*(first or (conv, m)), False), (conv, m, True)]
    yield pa.RecordBatch.from_arrays(
        [pa.array([TaskContext.get().partitionId()] * 2, pa.int32()), pa.array([r[2] for r in rows]), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1].ravel().tolist() for r in rows], pa.list_(pa.int64())), pa.array([only] * 2)],
        names=["part", "last", "conv_id", "matrix", "only"],
    )


def _bounds(rows: list) -> dict[int, dict[str, tuple[int, int | None]]]:
    """By partition: for its first and last conversation, the states at its edges and whether it goes on."""
    chains: list[list[tuple[int, str, object, np.ndarray]]] = []
    for r in sorted(rows, key=lambda r: (r["part"], r["last"])):
        if r["only"] and r["last"]:
            continue
        item = (r["part"], "last" if r["last"] or r["only"] else "first", r["conv_id"], np.array(r["matrix"], np.int64).reshape(4, 4))
        if chains and chains[-1][-1][2] == r["conv_id"] and chains[-1][-1][0] != r["part"]:
            chains[-1].append(item)
        else:
            chains.append([item])
    out: dict[int, dict[str, tuple[int, int | None]]] = {}
    for c in chains:
        path = states([x[3] for x in c])
        for i, (part, name, _, _) in enumerate(c):
            out.setdefault(part, {})[name] = (path[i], path[i + 1] if i + 1 < len(c) else None)
    return out


def _decoder(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = shared.value.get(TaskContext.get().partitionId(), {})
        done, held, out = 0, [], []

        def decoded(last_one: bool) -> list[tuple]:
            first, last = mine["last"] if last_one else mine["first"] if done == 0 and "first" in mine else (START, None)
            return fragments(held, first, last, last is None)

        for rows in _stretches(batches, ("conv_id", "turn", "role", "text", "seq")):
            if held and rows[0][0] != held[0][0]:
                out += decoded(False)
                done, held = done + 1, []
                if len(out) >= OUT_ROWS:
                    yield _output(out)
                    out = []
            held = held + rows
        if held:
            yield _output(out + decoded(True))

    return run


def _output(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, _, t) in zip(cols, COLUMNS, strict=True)], names=[n for n, _, _ in COLUMNS])


def repair(turns: DataFrame, partitions: int | None = None) -> DataFrame:
    """Per row of turns (conv_id, turn, role, text): COLUMNS; see the module's text."""
    spark = turns.sparkSession
    shared_dir(spark)
    slim = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    order = ["conv_id", "turn", "role", "text"]
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the checkpoint fixes partitions and order, so that both passes see the same
    dealt = slim.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("seq", F.monotonically_increasing_id())
    dealt = dealt.checkpoint()
    edges = dealt.select("conv_id", "role").mapInArrow(_summaries, "part int, last boolean, conv_id bigint, matrix array<bigint>, only boolean").collect()
    shared = spark.sparkContext.broadcast(_bounds(edges))
    return dealt.mapInArrow(_decoder(shared), ", ".join(f"{n} {t}" for n, t, _ in COLUMNS))
