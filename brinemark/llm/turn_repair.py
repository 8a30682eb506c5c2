"""Conversation repair by generalised LR parsing over the grammar of roles.

The stacks of all repairs that are still open form one graph: a node is an LR state on
top of another node and stands for every repair that leads to it. Rows are read one by
one; delete, keep, rerole and insert push and carry nodes at their price, and nodes
that meet merge by the least (cost, audit). Long conversations are read in blocks: a
block maps every node before it to the nodes after it, and blocks are joined in order.
"""

from __future__ import annotations

import hashlib
import json
import os.path
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from brinemark.llm.columns import quoted, stored

# The grammar of role initials, prices of edits and the roles that edits may give.
GRAMMAR = (
    ("chat", ()), ("chat", ("pairs",)), ("chat", ("s", "pairs")),
    ("pairs", ("pairs", "pair")), ("pairs", ("pair",)), ("pair", ("u", "a")))
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}
LEGAL_PAIRS = {"su", "ua", "au"}
BLANKS = " \t\n\x0b\f\r"
CELL = 512  # rows of a block; no effect on results

BLOCKS = "conv_key string, first long, last_initial string, blank long, duplicate long, truncated long, illegal long, initials string, times array<long>, table binary"
PARSED = ("conv_key string, place long, before string, edit string, role string, after string, "
          "blank long, duplicate long, truncated long, illegal long, cost long, audit string")
Weight = tuple[int, str]


class StackGraph:
    """LR stacks over ``grammar`` as shared nodes (state, node below), found once; node 0 is the empty stack.

    ``moves[node][token]`` is the node after a shift and every reduction that needs no
    look ahead; ``accepts[node]`` tells whether the input may end there. The grammar is
    left-recursive, so that stacks, and with them nodes, are few.
    """

    def __init__(self, grammar: tuple = GRAMMAR):
        self.grammar = grammar
        self.goal = grammar[0][0]
        self.heads = {head for head, _ in grammar}
        self._states, self._nodes = [self._closure({(k, 0) for k, (h, _) in enumerate(grammar) if h == self.goal})], [(0, None)]
        self.moves: list[dict[str, int]] = []
        tokens = sorted({t for _, body in grammar for t in body if t not in self.heads})
        while len(self.moves) < len(self._nodes):
            node = len(self.moves)
            shifted = {t: self._push(node, t) for t in tokens}
            self.moves.append({t: self._reduced(to) for t, to in shifted.items() if to is not None})
        self.accepts = [self._may_end(n) for n in range(len(self.moves))]
        # Nodes that a shift ends in; the others are reduced at once.
        self.tops = sorted({0, *(to for moves in self.moves for to in moves.values())})

    def _closure(self, items: set) -> frozenset:
        items, todo = set(items), list(items)
        while todo:
            k, dot = todo.pop()
            body = self.grammar[k][1]
            for j, (head, _) in enumerate(self.grammar):
                if dot < len(body) and head == body[dot] and (j, 0) not in items:
                    items.add((j, 0))
                    todo.append((j, 0))
        return frozenset(items)

    def _push(self, node: int, symbol: str) -> int | None:
        moved = {(k, d + 1) for k, d in self._states[self._nodes[node][0]] if self.grammar[k][1][d:d + 1] == (symbol,)}
        if not moved:
            return None
        state = self._closure(moved)
        if state not in self._states:
            self._states.append(state)
        made = (self._states.index(state), node)
        if made not in self._nodes:
            self._nodes.append(made)
        return self._nodes.index(made)

    def _pop(self, node: int, production: int) -> int:
        for _ in self.grammar[production][1]:
            node = self._nodes[node][1]
        return node

    def _reduced(self, node: int) -> int:
        items = self._states[self._nodes[node][0]]
        while len(items) == 1:
            (k, dot), = items
            if dot < len(self.grammar[k][1]) or self.grammar[k][0] == self.goal:
                break
            node = self._push(self._pop(node, k), self.grammar[k][0])
            items = self._states[self._nodes[node][0]]
        return node

    def _may_end(self, node: int) -> bool:
        ends = [k for k, d in self._states[self._nodes[node][0]] if d == len(self.grammar[k][1]) and self.grammar[k][0] == self.goal]
        return any(self._pop(node, k) == 0 for k in ends)

    def read(self, tops: dict[int, Weight], rows: list[tuple[str, str, int]]) -> dict[int, Weight]:
        """Stack tops after ``rows`` (initial, fault, times), from ``tops``."""
        tops = self._settled(tops)
        for initial, fault, times in rows:
            after: dict[int, Weight] = {}
            extra = TRUNCATED if fault == "truncated" else 0
            for node, (cost, audit) in tops.items():
                _offer(after, node, cost + DELETE, audit + "D")
                if fault not in ("blank", "duplicate"):
                    to = self.moves[node].get(initial)
                    if to is not None:
                        _offer(after, to, cost + KEEP + extra, audit + "K")
                    for token in ROLES:
                        to = self.moves[node].get(token)
                        if to is not None:
                            _offer(after, to, cost + REROLE + extra, audit + "R")
            if times > 1:
                # Further copies of a row are duplicates.
                after = {n: (c + DELETE * (times - 1), a + "D" * (times - 1)) for n, (c, a) in after.items()}
            tops = self._settled(after)
        return tops

    def _settled(self, tops: dict[int, Weight]) -> dict[int, Weight]:
        """With all inserts, without tops that no continuation can bring back: any top
        goes on like any other after at most two inserts."""
        tops, todo = dict(tops), list(tops)
        while todo:
            node = todo.pop()
            cost, audit = tops[node]
            for token in ROLES:
                to = self.moves[node].get(token)
                if to is not None and _offer(tops, to, cost + INSERT, audit + "I"):
                    todo.append(to)
        return _pruned(tops)

    def best(self, tops: dict[int, Weight]) -> Weight:
        return min(w for n, w in tops.items() if self.accepts[n])


def _offer(tops: dict[int, Weight], node: int, cost: int, audit: str) -> bool:
    if node in tops and tops[node] <= (cost, audit):
        return False
    tops[node] = (cost, audit)
    return True


def _pruned(tops: dict[int, Weight]) -> dict[int, Weight]:
    least = min(c for c, _ in tops.values())
    return {n: w for n, w in tops.items() if w[0] <= least + 2 * INSERT}


def _batches(rows: list[dict], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(rows), size):
        yield pa.RecordBatch.from_pylist(rows[k:k + size], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in ddl.split(", ")])


def read_cell(cell: pa.Table) -> pa.Table:
    """One row per conversation (or part of one) in a cell of consecutive rows, with its table of stack tops."""
    graph, out, run = StackGraph(), [], []

    def close(run: list[dict], starts_cell: bool) -> None:
        rows = [(r["initial"], r["fault"], r["times"]) for r in run]
        # A run that starts within its cell starts its conversation; only others need every stack.
        entries = graph.tops if starts_cell else (0,)
        table = [[e, n, c, a] for e in entries for n, (c, a) in graph.read({e: (0, "")}, rows).items()]
        counts = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, fault, times in rows:
            if fault == "blank":
                counts["blank"] += times
            else:
                counts["duplicate"] += times - (fault != "duplicate")
                counts["truncated"] += fault == "truncated"
        initials = [i for i, _, _ in rows]
        illegal = sum(n - 1 for _, _, n in rows) + sum(a + b not in LEGAL_PAIRS for a, b in zip(initials, initials[1:]))
        out.append({
            "conv_key": run[0]["conv_key"], "first": run[0]["place"], "last_initial": initials[-1], **counts, "illegal": illegal,
            # One character a row; a role without a token of the grammar is "-".
            "initials": initials[0] + "\n" + "".join(i if i in ("s", "u", "a") else "-" for i in initials),
            "times": [n for _, _, n in rows] if any(n > 1 for _, _, n in rows) else None,
            "table": zlib.compress(json.dumps(table).encode(), 1)})

    rows = sorted(cell.to_pylist(), key=lambda r: r["place"])
    starts_cell = rows[0]["place"] % CELL == 0
    for r in rows:
        if run and r["conv_key"] != run[-1]["conv_key"]:
            close(run, starts_cell)
            run, starts_cell = [], False
        run.append(r)
    close(run, starts_cell)
    return pa.Table.from_pylist(out, schema=_arrow(BLOCKS))


class Conversation:
    """The blocks of one conversation, joined in order."""

    def __init__(self, key: str | None):
        self.key, self.tops, self.sure, self.blocks, self.last = key, {0: (0, "")}, [], [], None
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)

    def add(self, block: dict) -> None:
        first_initial, initials = block["initials"].split("\n", 1)
        after: dict[int, Weight] = {}
        for entry, node, cost, audit in json.loads(zlib.decompress(block["table"])):
            if entry in self.tops:
                before = self.tops[entry]
                _offer(after, node, before[0] + cost, before[1] + audit)
        shared = os.path.commonprefix([a for _, a in after.values()])
        self.sure.append(shared)
        self.tops = _pruned({n: (c, a[len(shared):]) for n, (c, a) in after.items()})
        for name in self.counts:
            self.counts[name] += block[name]
        if self.last is not None:
            self.counts["illegal"] += self.last + first_initial not in LEGAL_PAIRS
        self.last = block["last_initial"]
        self.blocks.append((block["first"], initials, block["times"]))

    def parsed(self, graph: StackGraph) -> Iterator[dict]:
        cost, tail = graph.best(self.tops)
        audit = "".join(self.sure) + tail
        yield {"conv_key": self.key, "cost": cost, "audit": audit, **self.counts}
        at, due = 0, "u"  # the token that the output needs next

        def inserts() -> str:
            nonlocal at, due
            made = ""
            while audit[at:at + 1] == "I":
                made, due, at = made + due, "a" if due == "u" else "u", at + 1
            return made

        for b, (first, initials, times) in enumerate(self.blocks):
            for k, initial in enumerate(initials):
                before, edit = inserts(), audit[at]
                at += 1 + (times[k] - 1 if times else 0)
                role = ROLES[due] if edit == "R" else None
                if edit != "D":
                    due = "a" if edit + initial != "Ks" and due == "u" else "u"
                ends = b == len(self.blocks) - 1 and k == len(initials) - 1
                yield {"conv_key": self.key, "place": first + k, "before": before, "edit": edit, "role": role,
                       "after": inserts() if ends else ""}


def join_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation one row with its cost and audit, and one row per input row with its edit; blocks come sorted."""
    graph, now, schema, out = StackGraph(), None, _arrow(PARSED), []

    def ready(least: int) -> Iterator[pa.RecordBatch]:
        if len(out) >= least:
            yield from _batches(out, schema)
            out.clear()

    for batch in batches:
        for block in batch.to_pylist():
            if now is not None and now.key != block["conv_key"]:
                for row in now.parsed(graph):
                    out.append(row)
                    yield from ready(2000)
                now = None
            now = now or Conversation(block["conv_key"])
            now.add(block)
    if now is not None:
        out.extend(now.parsed(graph))
    yield from ready(1)


def hash_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the lines of every conversation, newline-joined, read in one stream."""
    schema, key, state, out = pa.schema([("conv_key", pa.string()), ("repaired_sha256", pa.string())]), None, None, []
    for batch in batches:
        for conv_key, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if state is None or conv_key != key:
                if state is not None:
                    out.append({"conv_key": key, "repaired_sha256": state.hexdigest()})
                key, state = conv_key, hashlib.sha256(line.encode())
            else:
                state.update(b"\n" + line.encode())
        yield from _batches(out, schema)
        out.clear()
    if state is not None:
        yield from _batches([{"conv_key": key, "repaired_sha256": state.hexdigest()}], schema)


def numbered(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Distinct rows with ``times`` and their ``place`` in (conversation, turn, role, text) order; without texts:
    ``fault`` and ``initial`` by place.

    Equal rows are counted before the shuffle; then ranges of the order, not
    conversations, are dealt to tasks, so that a long conversation is split.
    """
    rows = turns.select(
        quoted(conv_id).cast("string").alias("conv_key"), quoted(turn).alias("turn"),
        F.coalesce(quoted(role), F.lit(" ")).alias("role"), F.coalesce(quoted(text), F.lit(" ")).alias("text"))
    order = ["conv_key", "turn", "role", "text"]
    rows = rows.groupBy(*order).agg(F.count(F.lit(1)).alias("times"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    last = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    rows = rows.select("*", F.substring("role", 1, 1).alias("initial"), last.alias("last"), F.unhex(F.sha2(F.col("text"), 256)).alias("digest"))
    rows = stored(rows.withColumn("place", F.monotonically_increasing_id()), "turns")
    # Every place is found once, so this join has no hot key.
    firsts = rows.groupBy("conv_key", "role", "digest").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("fresh"))
    fault = F.when(F.col("last") == "", "blank").when(F.col("fresh").isNull(), "duplicate").when(
        ~F.col("last").isin(".", "!", "?"), "truncated")
    faults = rows.select("place", "conv_key", "initial", "last", "times").join(firsts, "place", "left").select(
        "place", "conv_key", "initial", "times", F.coalesce(fault, F.lit("")).alias("fault"))
    return rows, faults


def repair_turns(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The cheapest repair of every conversation: (``conversations``, ``edits``).

    ``conversations``: conv_key (the id as text), gaps, blank, duplicate, truncated,
    illegal, cost, audit. ``edits``: conv_key, place, step, edit, role, text, times, one
    row per edit in order; role and text are those after the edit (what a delete
    removes otherwise). Rows of a conversation stand by turn (NULLs first), then role
    and text. Rows without any character other than blanks and rows whose role and
    text came before must go; one that ends in other than ``.!?`` costs more if it
    stays. Edits and prices: Keep 0, Rerole 1, Delete 2, Insert 5; of the cheapest
    repairs the ASCII-least audit counts.

    A NULL role or text is one space, a NULL conversation one of its own, NULL turns
    come first. Repeated rows are duplicates; an empty table has no conversations;
    columns other than the four named are not read. A long conversation is read in
    blocks of ``CELL`` rows in many tasks; what is joined per conversation is one
    character a row. Texts are only moved and digested, never held by conversation.
    """
    rows, faults = numbered(turns, conv_id, turn, role, text)
    cells = faults.withColumn("cell", F.expr(f"place div {CELL}"))
    blocks = cells.groupBy("cell").applyInArrow(read_cell, BLOCKS)
    blocks = blocks.repartition("conv_key").sortWithinPartitions("conv_key", "first")
    parsed = stored(blocks.mapInArrow(join_blocks, PARSED), "turns-parsed")

    found = rows.groupBy(F.col("conv_key").alias("key_")).agg(
        F.min("turn").alias("least_"), F.max("turn").alias("most_"), F.count_distinct("turn").alias("turns_"))
    gaps = F.coalesce(F.col("most_") - F.col("least_") + 1 - F.col("turns_"), F.lit(0)).cast("long")
    conversations = parsed.where(F.col("place").isNull()).join(found, F.col("conv_key").eqNullSafe(F.col("key_"))).select(
        "conv_key", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    given = parsed.where(F.col("place").isNotNull()).select("place", "before", "edit", F.col("role").alias("new_"), "after")
    edits = rows.join(given, "place").select("conv_key", "place", F.explode(_steps()).alias("step_"))
    return conversations, edits.select("conv_key", "place", "step_.*")


def _steps() -> Column:
    """The edits around one row: inserts before it, its own, deletes of its copies, inserts after it."""
    def made(step, edit, role, text, times) -> Column:
        return F.struct(step.alias("step"), edit.alias("edit"), role.alias("role"), text.alias("text"), times.alias("times"))

    one, blank, insert = F.lit(1).cast("long"), F.lit(""), F.lit("I")
    named = lambda c: F.when(c == "u", F.lit(ROLES["u"])).otherwise(F.lit(ROLES["a"]))
    letters = lambda c: F.filter(F.split(c, ""), lambda x: x != "")
    before = F.transform(letters(F.col("before")), lambda c, k: made(k, insert, named(c), blank, one))
    after = F.transform(letters(F.col("after")), lambda c, k: made(k + 20, insert, named(c), blank, one))
    gone = F.col("edit") == "D"
    own = F.array(
        made(F.lit(10), F.col("edit"), F.coalesce("new_", "role"), F.col("text"), F.when(gone, F.col("times")).otherwise(one)),
        made(F.lit(11), F.lit("D"), F.col("role"), F.col("text"), F.col("times") - 1))
    own = F.filter(own, lambda s: (s["step"] == 10) | (~gone & (s["times"] > 0)))
    return F.concat(before, own, after)


def repaired(edits: DataFrame) -> DataFrame:
    """The turns that a repair leaves: conv_key, place, step, role, text."""
    return edits.where(F.col("edit") != "D").select("conv_key", "place", "step", "role", "text")


def digests(turns: DataFrame, conversations: DataFrame, edits: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """``conversations`` for every id of ``turns``, with the SHA-256 of its repaired ``role:text`` lines.

    A digest is one sequence by nature, so the texts of one conversation stream through
    one task, in batches; ids without rows have zeros and the digest of no text.
    """
    lines = repaired(edits).repartition("conv_key").sortWithinPartitions("conv_key", "place", "step")
    lines = lines.select("conv_key", F.concat("role", F.lit(":"), "text").alias("line"))
    hashed = lines.mapInArrow(hash_lines, "conv_key string, repaired_sha256 string")
    ids = turns.select(quoted(conv_id).alias("conv_id")).distinct()
    left = ids.join(conversations, ids["conv_id"].cast("string").eqNullSafe(conversations["conv_key"]), "left")
    hashed = hashed.select(F.struct("conv_key").alias("k_"), "repaired_sha256")
    left = left.join(hashed, F.col("conv_id").cast("string").eqNullSafe(F.col("k_.conv_key")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return left.select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def damage(turns: DataFrame) -> DataFrame:
    """Rows of conv_id, turn, role, text damaged by a hash of conversation and turn; NULLs of role and text become one space.

    0: dropped, 1: text emptied, 2: without ``.!?``, 3: twice, 4: role user; else as it is.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    text = F.when(h == 1, "").when(h == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    rows = turns.select(
        "conv_id", "turn", F.when(h == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"), h.alias("h_"))
    rows = rows.where(F.col("h_") != 0).withColumn("copy_", F.explode(F.sequence(F.lit(1), F.when(F.col("h_") == 3, 2).otherwise(1))))
    return rows.select("conv_id", "turn", "role", "text")
