"""Role repair against enumeration of every repair."""

import itertools

import pytest

from tessera.llm import chat_repair as C

ROLES = {"s": "system", "u": "user", "a": "assistant", "x": "tool", "n": None}
TURN = {"system": 1, "user": 2, "assistant": 3}


def legal(roles):
    body = roles[1:] if roles[:1] == ["system"] else roles
    return bool(body) and len(body) % 2 == 0 and all(
        r == ("user", "assistant")[i % 2] for i, r in enumerate(body))


def cheapest(source):
    """Least cost over all ways to relabel, merge and insert, by enumeration."""
    best = None
    n = len(source)
    for labels in itertools.product(("system", "user", "assistant"), repeat=n):
        change = sum(0 if r not in TURN or r == x else C.RELABEL for r, x in zip(source, labels))
        for merges in itertools.product((0, 1), repeat=n - 1):
            if any(m and labels[i] != labels[i + 1] for i, m in enumerate(merges)):
                continue
            turns = [labels[0], *[x for x, m in zip(labels[1:], merges) if not m]]
            cost = change + C.MERGE * sum(merges) + C.INSERT * (shortest_fill(turns) or 0)
            if shortest_fill(turns) is not None and (best is None or cost < best):
                best = cost
    return best


def shortest_fill(turns):
    """How few turns make ``turns`` legal by insertion (breadth first)."""
    frontier, seen = {(C.START, 0): 0}, {}
    while frontier:
        (s, at), cost = min(frontier.items(), key=lambda kv: kv[1])
        del frontier[s, at]
        if (s, at) in seen:
            continue
        seen[s, at] = cost
        if at == len(turns) and s == C.ASSISTANT:
            return cost
        for r in C.NEXT[s]:
            steps = [((r, at), cost + 1)]
            if at < len(turns) and TURN[turns[at]] == r:
                steps.append(((r, at + 1), cost))
            for k, v in steps:
                if k not in seen and v < frontier.get(k, 99) and v <= 2 * len(turns) + 4:
                    frontier[k] = v
    return None


def run_cost(rows):
    price = {"keep": 0, "close": 0, "insert": C.INSERT, "merge": C.MERGE}
    cost = 0
    for r, source in rows:
        if r.action in price:
            cost += price[r.action]
        else:
            cost += (C.RELABEL if source in TURN else 0) + (C.MERGE if "merge" in r.action else 0)
    return cost


@pytest.fixture(scope="module")
def repaired(spark):
    seqs = ["".join(s) for n in (1, 2, 3, 4) for s in itertools.product("suaxn", repeat=n)]
    seqs = [s for i, s in enumerate(seqs) if len(s) < 4 or i % 7 == 0]
    rows = [(i, t, ROLES[r], f"t{t}", "clash", 0) for i, s in enumerate(seqs) for t, r in enumerate(s)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, rendered string, seq int")
    out: dict = {}
    for r in sorted(C.repair(df).collect(), key=lambda r: r.seq):
        out.setdefault(r.conv_id, []).append(r)
    return seqs, out


def test_least_cost_and_legal(repaired):
    seqs, out = repaired
    for i, s in enumerate(seqs):
        rows = out[i]
        turns = [r.role for r in rows if r.action != "close" and "merge" not in r.action]
        assert legal(turns), (s, turns)
        source = [ROLES[c] for c in s]
        cost = run_cost([(r, source[r.turn] if r.action not in ("insert", "close") else None) for r in rows])
        assert cost == cheapest([x or "?" for x in source]), (s, [(r.role, r.action) for r in rows])


def test_rendered(repaired):
    seqs, out = repaired
    # One relabel (21) is cheaper than a merge and an insertion (44).
    text = "".join(r.rendered for r in out[seqs.index("suu")])
    assert text == ("<|im_start|>system\nt0<|im_end|>\n<|im_start|>user\nt1<|im_end|>\n"
                    "<|im_start|>assistant\nt2<|im_end|>\n")
    text = "".join(r.rendered for r in out[seqs.index("uua")])
    assert text == ("<|im_start|>user\nt0\nt1<|im_end|>\n<|im_start|>assistant\nt2<|im_end|>\n")
    text = "".join(r.rendered for r in out[seqs.index("u")])
    assert text == "<|im_start|>user\nt0<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    for i, s in enumerate(seqs):
        text = "".join(r.rendered for r in out[i])
        assert text.endswith("<|im_end|>\n") and text.count("<|im_start|>") == text.count("<|im_end|>")
        assert all(f"t{t}" in text for t in range(len(s)))


def whole(df):
    out: dict = {}
    for r in sorted(C.repair(df).collect(), key=lambda r: (r.conv_id is not None, r.conv_id or 0, r.seq)):
        out[r.conv_id] = out.get(r.conv_id, "") + r.rendered
    return out


def test_long_conversation_over_many_tasks(spark):
    """The same repair whether a conversation lies in one task or in many."""
    import random
    rnd = random.Random(2)
    rows = [(7, t, rnd.choice(["user", "assistant", "system", "User ", None, "tool"]), f"{t} ") for t in range(3000)]
    rows += [(c, t, rnd.choice(["user", "assistant"]), None) for c in (1, 5, 9) for t in range(5)]
    rows += [(None, None, "user", "hi"), (None, 3, "assistant", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    n = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = whole(df)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "23")
        assert whole(df) == one
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", n)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert one[7].count("<|im_start|>") == one[7].count("<|im_end|>")
    assert set(one) == {None, 1, 5, 7, 9}


def test_repeated_rows_and_empty_table(spark):
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, "assistant", "b")], schema)
    assert whole(df)[1] == "<|im_start|>user\na\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n"
    assert C.repair(spark.createDataFrame([], schema)).count() == 0
