"""Conversation structure repair: the cheapest edits that make roles alternate, found by Dial's bucket queue.

A conversation's rows are the layers of a graph; its four states say what came before: nothing, a
system turn, a user turn, an assistant turn. Arcs are the edits Keep, Rerole, Delete and Insert, at
costs of 0 to 6, so distances to the end are settled from a ring of buckets. Any letter leads to one
node, so the audit is the walk along tight arcs that takes the least letter at each node.

Spark sorts all rows by conversation and turn through a range shuffle. A task reads its range as a
stream and settles each conversation that lies inside it. What touches the ends of a range, or is
longer than a block, is left open and settled block by block: each block's distances between states
(a 4 x 4 table), the tables of a conversation added up from its end, and each block's walk from each
state; no task holds more than a block of rows, and only the digest of a conversation's text, which
is sequential, reads its repaired text as one stream.

Nulls: a null role or text is one space; null turns sort first; a null conversation is one of its own.
Rows of one turn stand in the order of role and the digest of their text, so repeated rows are
neighbours and all but the first are duplicates. Texts of any length are kept whole. An empty table
gives no row. Only the four columns named are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.llm.session import partitions, written

START, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
#: The state after an inserted or reroled turn, and its role.
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: What is inserted after the last row, and its cost.
TAIL = ((), (USER, ASSISTANT), (ASSISTANT,), ())
END = tuple(INSERT * len(t) for t in TAIL)
_BEFORE = tuple(tuple(s for s in range(4) if NEXT[s] == t) for t in range(4))
#: States from which a row of an initial may be kept, by the state it leads to.
_KEPT_FROM = {("s", SYSTEM): (START,), ("u", USER): _BEFORE[USER], ("a", ASSISTANT): _BEFORE[ASSISTANT]}
_KEPT_TO = {"s": {START: SYSTEM}, "u": dict.fromkeys(_BEFORE[USER], USER), "a": {USER: ASSISTANT}}
_LEGAL = {"su", "ua", "au"}
FAR = 1 << 60

#: Rows and bytes of text of a block; a longer conversation is settled in several.
BLOCK_ROWS = 4096
BLOCK_BYTES = 8 << 20
_SPACES = " \t\n\x0b\x0c\r"


def distances(rows: list[tuple[str, bool, bool]], exits: tuple[int, ...] = END) -> list[int]:
    """Distance to the end of each node, four a layer. rows: initial of the role, must go, truncated;
    exits: distances after the last row.
    """
    n = len(rows)
    dist = [FAR] * (4 * n + 4)
    open_ends = [e for e in exits if e < FAR]
    width = max(open_ends) - min(open_ends) + REROLE + CUT + 1
    buckets: list[list[int]] = [[] for _ in range(width)]
    waiting = 0
    for state, e in enumerate(exits):
        if e < FAR:
            dist[4 * n + state] = e
            buckets[e % width].append(4 * n + state)
            waiting += 1
    d = min(open_ends)

    def reach(node: int, cost: int) -> int:
        if cost < dist[node]:
            dist[node] = cost
            buckets[cost % width].append(node)
            return 1
        return 0

    while waiting:
        bucket = buckets[d % width]
        while bucket:
            node = bucket.pop()
            waiting -= 1
            if dist[node] != d:
                continue
            i, state = divmod(node, 4)
            before = _BEFORE[state]
            if i < n:
                for s in before:
                    waiting += reach(4 * i + s, d + INSERT)
            if i:
                initial, must_go, cut = rows[i - 1]
                base = 4 * i - 4
                waiting += reach(base + state, d + DELETE)
                if not must_go:
                    more = d + (CUT if cut else 0)
                    for s in _KEPT_FROM.get((initial, state), ()):
                        waiting += reach(base + s, more + KEEP)
                    for s in before:
                        waiting += reach(base + s, more + REROLE)
        d += 1
    return dist


def walk(rows: list[tuple[str, bool, bool]], dist: list[int], state: int = START) -> tuple[str, int, list[tuple[int, int]]]:
    """The least audit of tight arcs from the first layer; the state it ends in; and the turns that are
    left: the row's number (-1 for an inserted one) and the state of its new role (0 for its own).
    """
    i, letters, turns = 0, [], []
    while i < len(rows):
        here, below = dist[4 * i + state], 4 * i + 4
        initial, must_go, cut = rows[i]
        more = CUT if cut else 0
        kept = None if must_go else _KEPT_TO.get(initial, {}).get(state)
        if dist[below + state] + DELETE == here:
            letters.append("D")
            i += 1
        elif dist[4 * i + NEXT[state]] + INSERT == here:
            state = NEXT[state]
            letters.append("I")
            turns.append((-1, state))
        elif kept is not None and dist[below + kept] + more + KEEP == here:
            letters.append("K")
            turns.append((i, 0))
            state, i = kept, i + 1
        else:
            state = NEXT[state]
            letters.append("R")
            turns.append((i, state))
            i += 1
    return "".join(letters), state, turns


class _Summary:
    """What a run of rows adds to its conversation's figures."""

    def __init__(self) -> None:
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = self.first = self.last = None

    def add(self, turn: int | None, initial: str, fault: str) -> None:
        self.blank += fault == "blank"
        self.duplicate += fault == "duplicate"
        self.truncated += fault == "truncated"
        if self.last is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in _LEGAL
        self.last = initial
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.last_turn = turn
            self.first_turn = turn if self.first_turn is None else self.first_turn

    def join(self, later: _Summary) -> None:
        for name in ("blank", "duplicate", "truncated"):
            setattr(self, name, getattr(self, name) + getattr(later, name))
        self.illegal += later.illegal + (self.last is not None and later.first is not None and self.last + later.first not in _LEGAL)
        self.turns += later.turns - (later.first_turn is not None and later.first_turn == self.last_turn)
        self.first = later.first if self.first is None else self.first
        self.last = self.last if later.last is None else later.last
        self.first_turn = later.first_turn if self.first_turn is None else self.first_turn
        self.last_turn = self.last_turn if later.last_turn is None else later.last_turn

    def values(self) -> tuple:
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal


def _fault(blank: bool, again: bool, cut: bool) -> str:
    return "blank" if blank else "duplicate" if again else "truncated" if cut else ""


def _turn(row: tuple | None, state: int) -> str:
    if row is None:
        return ROLES[state] + ":"
    return f"{ROLES[state] if state else row[1]}:{row[2]}"


_RESULT = [*[T.StructField(c, T.LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())]
_FIGURES = ("blank", "duplicate", "truncated", "illegal", "turns", "first_turn", "last_turn")
_ROW = [
    T.StructField("part", T.LongType()), T.StructField("seg", T.LongType()), T.StructField("i", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
    T.StructField("digest", T.BinaryType()), T.StructField("empty", T.BooleanType()), T.StructField("cut", T.BooleanType()), T.StructField("present", T.BooleanType()),
]


def _arrow(fields: list[T.StructField]) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T.StructType(fields))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _settle(rows: list[tuple]) -> tuple:
    """A whole conversation. rows: turn, role, text, digest, empty, cut, present."""
    rows = [r for r in rows if r[6]]
    seen, facts, summary = set(), [], _Summary()
    for turn, role, _, digest, empty, cut, _ in rows:
        again = (role, digest) in seen
        seen.add((role, digest))
        summary.add(turn, role[:1], _fault(empty, again, cut))
        facts.append((role[:1], empty or again, cut))
    dist = distances(facts)
    audit, state, turns = walk(facts, dist)
    lines = [_turn(None if i < 0 else rows[i], s) for i, s in turns] + [_turn(None, s) for s in TAIL[state]]
    return *summary.values(), dist[START], audit + "I" * len(TAIL[state]), hashlib.sha256("\n".join(lines).encode()).hexdigest()


def _settle_range(batches: Iterator[pa.RecordBatch], fields: list[T.StructField], block_rows: int, block_bytes: int) -> Iterator[pa.RecordBatch]:
    """A range of sorted rows: conversations inside it are settled, the rows of others are handed on with part, seg and i."""
    schema, part, seg = _arrow(fields), TaskContext.get().partitionId(), 0
    rows: list[tuple] = []
    held, size, key, at_edge = False, 0, None, True  # at_edge: the conversation may have begun before this range or block
    out: list[tuple] = []

    def close(inside: bool) -> None:
        nonlocal rows, size, seg
        if inside and not at_edge:
            out.append((key, *_settle(rows), *[None] * len(_ROW)))
        else:
            out.extend((key, *[None] * len(_RESULT), part, seg, i, *r) for i, r in enumerate(rows))
            seg += 1
        rows, size = [], 0

    for batch in batches:
        for conv, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if held and conv != key:
                close(inside=True)
                at_edge = False
            elif len(rows) >= block_rows or size >= block_bytes:
                at_edge = True
                close(inside=False)
            held, key = True, conv
            rows.append(tuple(row))
            size += len(row[2])
        if out:
            yield _batch(out, schema)
            out = []
    if rows:
        close(inside=False)
    yield _batch(out, schema)


def _facts(table: pa.Table) -> tuple[list[dict], list[tuple[str, bool, bool]]]:
    rows = sorted((r for r in table.to_pylist() if r["present"]), key=lambda r: r["i"])
    return rows, [(r["role"][:1], r["empty"] or r["again"], r["cut"]) for r in rows]


def _between(table: pa.Table, schema: pa.Schema) -> pa.Table:
    """A block's distances from each state before it to each state after it."""
    _, facts = _facts(table)
    to = [distances(facts, tuple(0 if s == e else FAR for s in range(4)))[:4] for e in range(4)]
    row = (table["conv"][0].as_py(), table["part"][0].as_py(), table["seg"][0].as_py(), [to[e][s] for s in range(4) for e in range(4)])
    return pa.Table.from_batches([_batch([row], schema)])


def _add_up(table: pa.Table, schema: pa.Schema) -> pa.Table:
    """For each block of one conversation: the distances from the states after it to the end."""
    exits, out = END, []
    for r in sorted(table.to_pylist(), key=lambda r: (r["part"], r["seg"]), reverse=True):
        out.append((r["part"], r["seg"], list(exits)))
        m = r["between"]
        exits = tuple(min(m[4 * s + e] + exits[e] for e in range(4)) for s in range(4))
    return pa.Table.from_batches([_batch(out, schema)])


def _walks(table: pa.Table, plan: pa.Table, schema: pa.Schema) -> pa.Table:
    """A block's walk from each state before it."""
    rows, facts = _facts(table)
    dist, summary = distances(facts, tuple(plan["exits"][0].as_py())), _Summary()
    for r in rows:
        summary.add(r["turn"], r["role"][:1], _fault(r["empty"], r["again"], r["cut"]))
    conv, part, seg = table["conv"][0].as_py(), table["part"][0].as_py(), table["seg"][0].as_py()
    out = []
    for entry in range(4):
        audit, state, turns = walk(facts, dist, entry)
        lines = [_turn(None if i < 0 else (None, rows[i]["role"], rows[i]["text"]), s) for i, s in turns]
        out.append((conv, part, seg, entry, state, dist[entry], audit, "\n".join(lines) if lines else None, *[getattr(summary, f) for f in _FIGURES], summary.first, summary.last))
    return pa.Table.from_batches([_batch(out, schema)])


def _join_up(batches: Iterator[pa.RecordBatch], fields: list[T.StructField]) -> Iterator[pa.RecordBatch]:
    """Blocks of whole conversations in order, four rows each: the row of the state that was reached counts."""
    schema = _arrow(fields)
    held, key = False, None
    out: list[tuple] = []

    def close() -> None:
        for s in TAIL[state]:
            add(_turn(None, s))
        out.append((key, *summary.values(), cost, "".join(audit) + "I" * len(TAIL[state]), sha.hexdigest()))

    def add(text: str) -> None:
        nonlocal any_text
        sha.update((("\n" if any_text else "") + text).encode())
        any_text = True

    for batch in batches:
        for r in batch.to_pylist():
            if not held or r["conv"] != key:
                if held:
                    close()
                held, key, place = True, r["conv"], None
                state, cost, audit, sha, any_text, summary = START, None, [], hashlib.sha256(), False, _Summary()
            if (r["part"], r["seg"]) == place or r["entry"] != state:
                continue
            place = (r["part"], r["seg"])
            cost = r["dist"] if cost is None else cost
            audit.append(r["audit"])
            if r["repaired"] is not None:
                add(r["repaired"])
            state = r["exit"]
            block = _Summary()
            for f in _FIGURES:
                setattr(block, f, r[f])
            block.first, block.last = r["first_initial"], r["last_initial"]
            summary.join(block)
        if out:
            yield _batch(out, schema)
            out.clear()
    if held:
        close()
    yield _batch(out, schema)


def repair(conversations: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: str | None = None, block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    A row where `present` is false only names its conversation. One without any other row has zeros,
    an empty audit and the digest of an empty text.
    """
    conv_type = conversations.schema[conv_id].dataType
    whole = F.coalesce(F.col(text).cast("string"), F.lit(" "))
    base = conversations.select(
        F.col(conv_id).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"), whole.alias("text"),
        F.unhex(F.sha2(whole, 256)).alias("digest"), F.rtrim(whole, F.lit(_SPACES)).alias("trimmed"), (F.col(present) if present else F.lit(True)).alias("present"),
    )
    marked = base.select("conv", "turn", "role", "text", "digest", (F.col("trimmed") == "").alias("empty"), (~F.right("trimmed", F.lit(1)).isin(".", "!", "?")).alias("cut"), "present", F.spark_partition_id().alias("from"))
    order = ["conv", "turn", "role", "digest", "from"]  # copies are alike, so those of a very common row may lie in several ranges
    ranges = marked.repartitionByRange(partitions(conversations.sparkSession), *order).sortWithinPartitions(*order).drop("from")
    conv = T.StructField("conv", conv_type)
    fields = [conv, *_RESULT, *_ROW]
    found = written(ranges.mapInArrow(lambda it: _settle_range(it, fields, block_rows, block_bytes), T.StructType(fields)), "conversations")
    names = [f.name for f in _RESULT]
    done = found.where("part is null").select("conv", *names)

    rows = found.where("part is not null").select("conv", *[f.name for f in _ROW])
    rows = written(_marked_repeats(rows), "open-turns")
    at = [T.StructField("part", T.LongType()), T.StructField("seg", T.LongType())]
    four = T.ArrayType(T.LongType())
    table_of = [conv, *at, T.StructField("between", four)]
    exits_of = [*at, T.StructField("exits", four)]
    walk_of = [
        conv, *at, T.StructField("entry", T.LongType()), T.StructField("exit", T.LongType()), T.StructField("dist", T.LongType()), T.StructField("audit", T.StringType()), T.StructField("repaired", T.StringType()),
        *[T.StructField(f, T.LongType()) for f in _FIGURES], T.StructField("first_initial", T.StringType()), T.StructField("last_initial", T.StringType()),
    ]
    tables = rows.groupBy("part", "seg").applyInArrow(lambda t: _between(t, _arrow(table_of)), T.StructType(table_of))
    exits = tables.groupBy("conv").applyInArrow(lambda t: _add_up(t, _arrow(exits_of)), T.StructType(exits_of))
    walks = rows.groupBy("part", "seg").cogroup(exits.groupBy("part", "seg")).applyInArrow(lambda t, plan: _walks(t, plan, _arrow(walk_of)), T.StructType(walk_of))
    ends = [conv, *_RESULT]
    streamed = walks.repartition(partitions(conversations.sparkSession), "conv").sortWithinPartitions("conv", "part", "seg", "entry")
    return done.unionByName(streamed.mapInArrow(lambda it: _join_up(it, ends), T.StructType(ends))).withColumnRenamed("conv", conv_id)


def _marked_repeats(rows: DataFrame) -> DataFrame:
    """Open rows with `again`: whether role and text stand earlier in the conversation, in this block or another."""
    key = ["conv", "role", "digest"]
    first = rows.where("present").groupBy(*key).agg(F.min(F.struct("part", "seg", "i")).alias("first"))
    first = first.select(*[F.col(c).alias(f"{c}_") for c in key], "first")
    on = [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in key]
    return rows.join(first, on, "left").select(*rows.columns, F.coalesce(F.struct("part", "seg", "i") > F.col("first"), F.lit(False)).alias("again"))
