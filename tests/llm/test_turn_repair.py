"""Turn repair against a plain search over all edits, joined blocks, and hard rows."""

import hashlib
import heapq
import random
import re

import pyarrow as pa
import pytest

from brinemark.llm import turn_repair as tr

SHAPE = re.compile(r"(s?(ua)+)?\Z")
ALPHABET = "sua"


def naive(rows):
    """(cost, audit) by least-first search over (rows read, output so far folded to its last role)."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, out = heapq.heappop(heap)
        if (i, out) in done:
            continue
        done.add((i, out))
        if i == len(rows) and SHAPE.match({"": "", "s": "s", "u": "u", "a": "ua"}[out]):
            return cost, audit

        def go(token, price, edit, j):
            ok = {"": "su", "s": "u", "u": "a", "a": "u"}[out]
            if token in ok and token:
                heapq.heappush(heap, (cost + price, audit + edit, j, token))

        for token in "ua":
            go(token, 5, "I", i)
        if i < len(rows):
            initial, fault = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, out))
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                go(initial, extra, "K", i + 1)
                for token in "ua":
                    go(token, 1 + extra, "R", i + 1)
    raise AssertionError


def random_rows(dice, n):
    return [(dice.choice("suaxt"), dice.choice(["", "", "", "blank", "duplicate", "truncated"])) for _ in range(n)]


def test_graph_equals_search():
    graph, dice = tr.StackGraph(), random.Random(5)
    for _ in range(1500):
        rows = random_rows(dice, dice.randrange(9))
        if rows and dice.random() < 0.5:
            rows = [(i, "") for i, _ in rows]
        assert graph.best(graph.read({0: (0, "")}, [(i, f, 1) for i, f in rows])) == naive(rows)


def test_stacks_are_few_and_accept_the_grammar():
    graph = tr.StackGraph()
    assert len(graph.tops) <= 8
    for text, good in (("", True), ("ua", True), ("sua", True), ("uaua", True), ("s", False), ("u", False), ("au", False), ("uas", False), ("ss", False)):
        node = 0
        for token in text:
            node = graph.moves[node].get(token) if node is not None else None
        assert (node is not None and graph.accepts[node]) == good


def test_joined_blocks_equal_one_block():
    graph, dice = tr.StackGraph(), random.Random(6)
    for _ in range(60):
        rows = [(i, f, dice.choice([1, 1, 1, 3])) for i, f in random_rows(dice, dice.randrange(1, 40))]
        whole = graph.best(graph.read({0: (0, "")}, rows))
        size, conversation = dice.randrange(1, 9), tr.Conversation("c")
        for k in range(0, len(rows), size):
            part = [{"place": tr.CELL + k + j, "conv_key": "c", "initial": i, "fault": f, "times": n} for j, (i, f, n) in enumerate(rows[k:k + size])]
            for r in part:
                r["place"] = tr.CELL * (1 + k) + part.index(r)
            conversation.add(tr.read_cell(pa.Table.from_pylist(part)).to_pylist()[0])
        head, *edits = conversation.parsed(graph)
        assert (head["cost"], head["audit"]) == whole
        spelled = "".join("I" * len(e["before"]) + e["edit"] + "D" * (n - 1) + "I" * len(e["after"]) for e, (_, _, n) in zip(edits, rows))
        assert spelled == whole[1]


TURNS = [
    ("a", 0, "system", "Rules."), ("a", 1, "user", "Hi?"), ("a", 2, "user", "Hello?"), ("a", 3, "assistant", "Cut off"),
    ("b", 1, "assistant", "First."), ("b", 4, "assistant", "Second."), ("b", 4, "assistant", "Second."), ("b", 9, "tool", "x."),
    (None, None, None, None), (None, 3, "user", "Alone."), ("c", 0, "user", "  \n\t"), ("d", None, "user", "é" * 5000 + "!"), ("d", None, None, "ok."),
    ("e", 5, "", "No role."), ("e", 6, "user", "汉字。")]


def by_hand(rows):
    rows = sorted(((t is not None, t or 0, r if r is not None else " ", x if x is not None else " ", t) for _, t, r, x in rows), key=lambda v: v[:4])
    seen, coded, count = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, _, r, x, _ in rows:
        last = re.sub(r"[\x20\x09-\x0D]+\Z", "", x)[-1:]
        fault = "blank" if not last else "duplicate" if (r, x) in seen else "" if last in ".!?" else "truncated"
        seen.add((r, x))
        coded.append((r[:1], fault))
        if fault:
            count[fault] += 1
    initials = [i for i, _ in coded]
    cost, audit = naive(coded)
    due, at, out = "u", 0, []
    for e in audit:
        if e == "I":
            out.append(tr.ROLES[due] + ":")
        else:
            _, _, r, x, _ = rows[at]
            at += 1
            if e == "D":
                continue
            out.append((r if e == "K" else tr.ROLES[due]) + ":" + x)
            if e == "K" and r[:1] == "s":
                continue
        due = "a" if due == "u" else "u"
    known = [v[4] for v in rows if v[4] is not None]
    return {
        "gaps": max(known) - min(known) + 1 - len(set(known)) if known else 0, **count,
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(out).encode()).hexdigest()}


def test_hard_rows_equal_search(spark):
    dice = random.Random(9)
    more = [(f"r{c}", t, dice.choice(["system", "user", "assistant", "tool"]), dice.choice(["A.", "B.", "C", "", "D?", "E!"]))
            for c in range(25) for t in range(dice.randrange(1, 7))]
    turns = spark.createDataFrame(TURNS + more, "conv_id string, turn long, role string, text string").repartition(5)
    rows = {r["conv_id"]: r.asDict() for r in tr.digests(turns, *tr.repair_turns(turns)).collect()}
    assert set(rows) == {c for c, *_ in TURNS + more}
    for conv in rows:
        got = rows[conv]
        got.pop("conv_id")
        assert got == by_hand([t for t in TURNS + more if t[0] == conv]), conv


def test_long_conversation_over_many_blocks(spark):
    dice = random.Random(3)
    turns = [(7, t, dice.choice(["user", "assistant"]) if dice.random() < 0.2 else ("user", "assistant")[t % 2], f"{dice.randrange(4000)}.") for t in range(3000)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(8)
    conversations, edits = tr.repair_turns(df)
    got = tr.digests(df, conversations, edits).collect()
    assert len(got) == 1
    seen, coded = set(), []
    for _, _, r, x in turns:
        coded.append((r[0], "duplicate" if (r, x) in seen else "", 1))
        seen.add((r, x))
    graph = tr.StackGraph()
    assert (got[0]["cost"], got[0]["audit"]) == graph.best(graph.read({0: (0, "")}, coded))
    left = sorted((r["place"], r["step"], r["role"]) for r in tr.repaired(edits).collect())
    roles = [r for _, _, r in left]
    assert roles == ["user", "assistant"] * (len(roles) // 2)


def test_empty_table_and_ids_without_rows(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    some = spark.createDataFrame([(1,), (None,)], "conv_id long")
    assert tr.digests(none, *tr.repair_turns(none)).collect() == []
    rows = tr.digests(some, *tr.repair_turns(none)).collect()
    assert {r["conv_id"] for r in rows} == {1, None}
    assert all(r["audit"] == "" and r["cost"] == 0 and r["repaired_sha256"] == hashlib.sha256(b"").hexdigest() for r in rows)


def test_clashing_names_are_not_read(spark):
    from pyspark.sql import functions as F
    turns = spark.createDataFrame(TURNS, "conv_id string, turn long, role string, text string")
    wide = turns.select("*", *[F.lit("mine").alias(c) for c in ("place", "times", "fault", "initial", "conv_key", "fresh", "edit", "step")])
    key = lambda df: sorted(map(str, tr.digests(df, *tr.repair_turns(df)).collect()))
    assert key(wide) == key(turns)
