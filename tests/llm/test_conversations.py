"""Conversation repair against an independent search, a long conversation cut into many blocks, and the query against its SQL."""

import hashlib
import heapq
import random
import zlib

import duckdb

from folioforge.llm.conversations import repair
from folioforge.llm.queries import OP11_SQL, damaged_conversations, op11_conversations

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
WHITE = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """Best-first search over (cost, audit): rows are (role, text, must_go, cut)."""
    heap, done = [(0, "", 0, "", "")], set()  # cost, audit, rows used, roles so far (last two kinds), repaired lines
    while heap:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            return cost, audit, "\n".join(lines[:-1].split("\x00")) if lines else ""
        want = "assistant" if state == "u" else "user"
        heapq.heappush(heap, (cost + 3, audit + "I", i, want[0], lines + want + ":\x00"))
        if i < len(rows):
            role, text, must_go, cut = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state, lines))
            if not must_go:
                more = 3 if cut else 0
                if role[:1] == want[0] or (role[:1] == "s" and state == ""):
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[:1], f"{lines}{role}:{text}\x00"))
                heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, want[0], f"{lines}{want}:{text}\x00"))


def plain(rows, damage=False):
    """rows: conv_id, turn, role, text. The result by conversation, in plain Python."""
    out = {c: [] for c, *_ in rows}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        text = "" if kind == 1 else text.translate(dict.fromkeys(map(ord, ".!?"))) if kind == 2 else text
        out[conv] += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    result = {}
    for conv, own in out.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, facts, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in own:
            bare = text.strip(WHITE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            facts.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        turns = [t for t, *_ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, text = cheapest(facts)
        result[conv] = (gaps, *counts.values(), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return result


def found(df):
    rows = [tuple(r) for r in df.collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


def random_rows(n, conversations, seed):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "", " \t", "What? ", "a b c!", "é…", "x.y", "Well.\n"]
    roles = ["user", "assistant", "system", "tool", "", "u", "Assistant"]
    return [(rng.randrange(conversations), rng.choice([None, *range(6)]), rng.choice(roles[:3] if rng.random() < 0.7 else roles), rng.choice(texts)) for _ in range(n)]


def test_equals_search(spark):
    rows = random_rows(900, 120, 1)
    assert found(repair(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_blocks_equal_whole(spark):
    """Conversations that are cut into many blocks and lie in several ranges."""
    rng = random.Random(2)
    rows = [(7, t, rng.choice(["user", "assistant", "system"]), rng.choice(["A.", "B", f"n {t}.", ""])) for t in range(400) for _ in range(rng.randrange(3))]
    rows += random_rows(60, 3, 3) + [(9, 1, "user", "same.")] * 50
    df = spark.createDataFrame(rows, SCHEMA)
    want = plain(rows)
    assert found(repair(df.repartition(5), block_rows=7)) == want
    assert found(repair(df, block_bytes=20)) == want


def test_edges(spark):
    """Nulls in any column, a conversation without a row, a very long text, repeated rows, clashing columns, an empty table."""
    rows = [(None, None, None, None), (None, None, "user", "Hi."), (1, None, "user", None), (1, 2, None, "x."), (2, 5, "user", "w " * 500_000), (2, 9, "assistant", "Ok."), (3, 1, "user", "Hi."), (3, 1, "user", "Hi.")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(repair(df)) == plain(rows)
    more = df.selectExpr("*", "'k' as part", "1 as seg", "2 as conv", "3 as digest", "conv_id is null or conv_id <> 3 as there")
    got = found(repair(more, present="there"))
    assert got[3] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert {k: v for k, v in got.items() if k != 3} == {k: v for k, v in plain(rows).items() if k != 3}
    assert repair(df.limit(0)).count() == 0


def test_query_equals_sql_and_plain(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS FROM '{sf}/conversations.parquet'")
    got = op11_conversations(spark, sf)
    names = got.columns
    want = {r[0]: r[1:] for r in con.execute(f"SELECT {', '.join(names)} FROM ({OP11_SQL})").fetchall()}
    assert found(got) == want
    rows = con.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    assert want == plain(rows, damage=True)


def test_damage_of_nulls(spark):
    rows = [(None, None, None, None), (None, 3, "user", None)]
    rows += [(c, t, None if c % 3 == 0 else "user", None if (t or 0) % 4 == 0 else "Ab. c?") for c in range(12) for t in [None, *range(9)]]
    assert found(repair(damaged_conversations(spark.createDataFrame(rows, SCHEMA)), present="present")) == plain(rows, damage=True)
