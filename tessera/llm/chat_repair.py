"""Chat formatting with minimum-cost role repair.

A conversation is legal if it is an optional system turn, then user and
assistant turns in alternation from a user turn to an assistant turn.  Each
source turn may be kept, given another role, merged into the turn before it,
or preceded by empty turns; dynamic programming over the automaton of the last
turn's role finds the cheapest repair.

Min-plus steps are associative, so a conversation of any length may lie across
many tasks: rows are range-partitioned by conversation and turn, each task
sums up the one or two conversations at its edges in a 4 x 4 matrix, and the
driver chains these (a few numbers per task, never rows).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import arrow_schema, keep

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)     # states: nothing yet, or the last turn's role
MERGE, RELABEL, INSERT = 10, 21, 34           # costs; a missing or unknown role costs nothing
FAR = 1 << 40
#: Legal turns that follow each state.
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}


def _fillers() -> dict[tuple[int, int], tuple[int, ...]]:
    """Fewest empty turns to insert so that a turn of a role may follow a state."""
    out = {}
    for s in range(4):
        paths = [((), s)]
        for _ in range(3):
            for path, at in paths:
                for r in NEXT[at]:
                    out.setdefault((s, r), path)
            paths = [((*path, r), r) for path, at in paths for r in NEXT[at]]
    return out


FILL = _fillers()
#: Empty turns that end a conversation left in a state; none for one without turns.
CLOSE = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}


def _options(role: int) -> list[list[tuple[int, str, tuple[int, ...]] | None]]:
    """[state][new state] -> (cost, action, empty turns before), the cheapest way
    to take a turn of ``role`` (-1: unknown)."""
    table: list[list] = [[None] * 4 for _ in range(4)]
    for s in range(4):
        for r in (SYSTEM, USER, ASSISTANT):
            change = 0 if role in (r, -1) else RELABEL
            label = "relabel" if role != r else "keep"
            ways = []
            if (s, r) in FILL:
                ways.append((change + INSERT * len(FILL[s, r]), label, FILL[s, r]))
            if s == r:
                ways.append((change + MERGE, "merge" if role == r else "relabel+merge", ()))
            if ways:
                table[s][r] = min(ways, key=lambda w: w[0])
    return table


OPTIONS = {role: _options(role) for role in (-1, SYSTEM, USER, ASSISTANT)}
COST = {role: np.array([[t[s][r][0] if t[s][r] else FAR for r in range(4)] for s in range(4)])
        for role, t in OPTIONS.items()}


def role_code(role: str | None) -> int:
    name = (role or "").strip().lower()
    return 1 + ROLES.index(name) if name in ROLES else -1


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus product."""
    return np.minimum((a[..., :, None] + b).min(axis=-2), FAR)


def forward(roles: list[int], entry: list[int]) -> tuple[list[int], list[list[int]]]:
    """Costs per end state, and per turn the state before each state; ties go
    to the first state."""
    cost, back = entry, []
    for role in roles:
        table = OPTIONS[role]
        new, come = [FAR] * 4, [0] * 4
        for s in range(4):
            if cost[s] >= FAR:
                continue
            for r in (1, 2, 3):
                way = table[s][r]
                if way is not None and cost[s] + way[0] < new[r]:
                    new[r], come[r] = cost[s] + way[0], s
        cost = new
        back.append(come)
    return cost, back


def trace(back: list[list[int]], last: int) -> list[int]:
    """The states from the entry to ``last``."""
    states = [last]
    for come in reversed(back):
        states.append(come[states[-1]])
    return states[::-1]


def last_state(cost: list[int]) -> int:
    """Where the cheapest closed conversation ends."""
    return min(range(4), key=lambda s: (cost[s] + INSERT * len(CLOSE[s]), s))


OPEN, SHUT = "<|im_start|>{}\n", "<|im_end|>\n"


def fragments(rows: list[tuple], states: list[int], started: bool, ends: bool) -> Iterator[tuple]:
    """(turn, part, role, action, rendered) for rows (turn, role code, text)
    taken along ``states``; the concatenated ``rendered`` is the conversation.
    A turn's end mark leads what follows it."""
    for (turn, code, text), s, r in zip(rows, states, states[1:]):
        _, action, before = OPTIONS[code][s][r]
        part = 0
        for empty in before:
            yield turn, part, ROLES[empty - 1], "insert", (SHUT if started else "") + OPEN.format(ROLES[empty - 1])
            started, part = True, part + 1
        if action.endswith("merge"):
            shown = "\n" + (text or "")
        else:
            shown = (SHUT if started else "") + OPEN.format(ROLES[r - 1]) + (text or "")
        started = True
        yield turn, part, ROLES[r - 1], action, shown
    if ends:
        turn = rows[-1][0]
        for i, empty in enumerate(CLOSE[states[-1]]):
            yield turn, 1000 + i, ROLES[empty - 1], "insert", SHUT + OPEN.format(ROLES[empty - 1])
        yield turn, 2000, ROLES[ASSISTANT - 1], "close", SHUT


def repair(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """The repaired and rendered conversations, as fragments.

    One row per source turn, inserted turn and end: ``conv_id``, ``turn`` (the
    source turn's, or that beside which something was inserted), ``seq`` (order
    of the fragments of a conversation; not dense), ``role`` (repaired),
    ``action`` (keep, relabel, merge, relabel+merge, insert, close) and
    ``rendered``.  Concatenating ``rendered`` by ``seq`` gives the conversation;
    no task and no row holds a whole one, so its length has no bound.

    Turns are taken in order of turn, nulls first, then of role and text.  A
    null or unknown role may become any role at no cost (action relabel); roles
    are compared without case or outer spaces.  A null text is empty; empty
    turns are kept.  Repeated rows are turns of their own (mostly merged).  Null
    ids form one conversation.  An empty table gives no rows.
    """
    src = df.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                    F.col(role_col).cast("string").alias("role"),
                    F.col(text_col).cast("string").alias("text"))
    order = ["conv_id", "turn", "role", "h", "text"]
    rows = keep(src.withColumn("h", F.xxhash64("text"))
                .repartitionByRange(*order[:4]).sortWithinPartitions(*order)
                .select("conv_id", "turn", "role", "text"))
    none = object()

    def convs(batches: Iterator[pa.RecordBatch], texts: bool) -> Iterator[tuple]:
        """(id, [(turn, role code, text)]) of each run of one conversation."""
        at, run = none, []
        for b in batches:
            ids, turns, roles = (b.column(i).to_pylist() for i in range(3))
            held = b.column(3).to_pylist() if texts else [None] * len(ids)
            for c, t, r, x in zip(ids, turns, roles, held):
                if at is none or c != at:
                    if run:
                        yield at, run
                    at, run = c, []
                run.append((t, role_code(r), x))
        if run:
            yield at, run

    def edges(found: Iterator[tuple]) -> Iterator[tuple]:
        """(0 first / 1 last / 2 only, id, run) of a task's outer conversations."""
        first = last = None
        for i, (c, run) in enumerate(found):
            if not i:
                first = c, run
            else:
                last = c, run
        if first is not None:
            yield (0 if last is not None else 2), *first
        if last is not None:
            yield 1, *last

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for place, c, run in edges(convs(batches, False)):
            m = np.where(np.eye(4, dtype=bool), 0, FAR)
            for _, code, _ in run:
                m = times(m, COST[code])
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([place], pa.int32()),
                 pa.array([c], ids_type), pa.array([m.ravel().tolist()])], ["p", "place", "conv_id", "m"])

    ids_type = arrow_schema(T.StructType([rows.schema["conv_id"]])).field(0).type
    kind = rows.schema["conv_id"].dataType.simpleString()
    found = sorted((r["p"], r["place"] % 2, r["place"], r["conv_id"], r["m"]) for r in
                   rows.mapInArrow(sums, f"p int, place int, conv_id {kind}, m array<bigint>").collect())
    # Chains: edge runs of one conversation in neighbouring tasks.
    chains: list[list] = []
    for i, e in enumerate(found):
        before = found[i - 1] if i else None
        if before and before[3] == e[3] and before[0] != e[0]:
            chains[-1].append(e)
        else:
            chains.append([e])
    entry: dict[tuple[int, int], list[int]] = {}
    for chain in chains:
        v = np.array([0, FAR, FAR, FAR])
        for p, _, place, _, m in chain:
            entry[p, place] = v.tolist()
            v = times(v, np.array(m).reshape(4, 4))
    split = {(e[0], e[2]) for chain in chains if len(chain) > 1 for e in chain}

    def exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of split conversations: the end costs, and each end state's entry."""
        p = TaskContext.get().partitionId()
        for place, _, run in edges(convs(batches, False)):
            if (p, place) in split:
                cost, back = forward([code for _, code, _ in run], entry[p, place])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p], pa.int32()), pa.array([place], pa.int32()), pa.array([cost]),
                     pa.array([[trace(back, s)[0] for s in range(4)]])], ["p", "place", "cost", "come"])

    leave: dict[tuple[int, int], int] = {}
    if split:
        got = {(r["p"], r["place"]): (r["cost"], r["come"]) for r in rows.mapInArrow(
            exits, "p int, place int, cost array<bigint>, come array<bigint>").collect()}
        for chain in chains:
            if len(chain) > 1:
                s = last_state(got[chain[-1][0], chain[-1][2]][0])
                for e in reversed(chain):
                    leave[e[0], e[2]] = s
                    s = got[e[0], e[2]][1][s]
    heads = {(c[0][0], c[0][2]) for c in chains}
    tails = {(c[-1][0], c[-1][2]) for c in chains}
    schema = T.StructType([src.schema["conv_id"], src.schema["turn"], T.StructField("seq", T.LongType()),
                           T.StructField("role", T.StringType()), T.StructField("action", T.StringType()),
                           T.StructField("rendered", T.StringType())])
    arrow = arrow_schema(schema)

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = TaskContext.get().partitionId()
        out: list[tuple] = []
        runs = convs(batches, True)
        held = next(runs, None)
        seq = p << 40
        i = 0
        while held is not None:
            following = next(runs, None)
            c, run = held
            place = (2 if i == 0 and following is None else 0 if i == 0
                     else 1 if following is None else -1)
            key = (p, place)
            cost, back = forward([code for _, code, _ in run], entry.get(key, [0, FAR, FAR, FAR]))
            states = trace(back, leave[key] if key in leave else last_state(cost))
            for turn, _, role, action, shown in fragments(
                    run, states, place >= 0 and key not in heads, place < 0 or key in tails):
                out.append((c, turn, seq, role, action, shown))
                seq += 1
                if len(out) >= 2048:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, f.type) for x, f in zip(zip(*out), arrow)], schema=arrow)
                    out = []
            held, i = following, i + 1
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, f.type) for x, f in zip(zip(*out), arrow)], schema=arrow)

    return rows.mapInArrow(render, schema)
