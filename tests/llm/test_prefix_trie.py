"""The trie of conversation prefixes against brute force, with containers of all sizes."""

import hashlib
import random
import zlib

import duckdb
import pytest

from metrolens.llm import prefix_trie
from tests.conftest import SF_SMALL

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows, block=100, heads=6):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tid = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            convs.setdefault(c, []).append(((turn is not None, turn or 0), tid, (role, text)))
    own = {c: [x[2] for x in sorted(t)] for c, t in convs.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = c - (c % block if c >= 0 else -(-c % block))
        out[c] = tuple(own.get(base, [])[:h] + turns[h:])
    return out


def brute(convs):
    nodes = {}
    for c, seq in convs.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(seq[:d], []).append(c)
    kids, out = {}, []
    for p in nodes:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        mine = kids.get(p, [])
        leaves[p] = sum(leaves[k] for k in mine) or 1
        saved[p] = sum(saved[k] for k in mine) + (len(nodes[p]) - 1) * (len(p[-1][1]) if p else 0)
    for p, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in members if convs[c] == p))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(kids.get(p, [])), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(seed, n, alphabet, longest):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        c = rng.choice([rng.randrange(0, 600), rng.randrange(-150, 50), rng.randrange(10 ** 12, 10 ** 12 + 300)])
        if any(r[0] == c for r in rows):
            continue
        first = ["hot"] * rng.randrange(0, 4)
        for t, word in enumerate(first + [rng.choice(alphabet) for _ in range(rng.randrange(0, longest) + (not first))]):
            rows.append((c, t if t else rng.choice([0, None]), rng.choice(["user", None, ""]) if rng.random() < 0.1 else "user", word))
    rng.shuffle(rows)
    return rows


def run(spark, rows, **sizes):
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", conv string, pos int").repartition(4)
    turns, convs = prefix_trie.rebuilt_turns(prefix_trie.turns_of(table))
    return sorted(map(tuple, prefix_trie.prefix_trie(turns, convs, **sizes).collect()), key=str)


@pytest.mark.parametrize("capacity,stretch", [(1 << 13, 1 << 10), (40, 1 << 10), (12, 3), (1, 1)])
def test_equals_brute_force(spark, capacity, stretch):
    rows = conversations(capacity, 160, ["a", "b", "cc", "é日", "", None], 6)
    rows += [(300, 5, "user", "same"), (300, 5, "user", "same"), (None, 1, "user", "no conversation"), (301, 0, None, None)]
    assert run(spark, rows, capacity=capacity, stretch=stretch) == brute(rebuilt(rows))


def test_copies_long_conversations_and_empty_ones(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 60) for t in range(7)]  # large groups of copies
    rows += [(1000 + c, t, "bot", f"deep {t}" if t < 40 + c else f"own {c}") for c in range(0, 300, 100) for t in range(60)]
    rows += [(5001, 0, "user", "alone"), (5003, 0, "user", "alone")]  # shorter than their heads, whose conversation is absent
    assert run(spark, rows, capacity=25, stretch=8) == brute(rebuilt(rows))


def test_null_and_text_edges(spark):
    rows = [(100, None, None, "first"), (100, 1, "a", None), (100, 1, "a", None), (101, None, "", ""), (102, 0, "x" * 50_000, "y" * 300_000)]
    rows += [(102, k, "u", "z") for k in range(1, 9)]
    assert run(spark, rows) == brute(rebuilt(rows))


def test_no_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.query(empty).count() == 0
    assert prefix_trie.query(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).count() == 0


def test_positions_over_several_tasks(spark):
    rows = [(7, t, "u", str(t)) for t in range(3000)] + [(c, t, "u", str(t)) for c in range(20) for t in range(c) if c != 7]
    got = prefix_trie.turns_of(spark.createDataFrame(rows, SCHEMA)).collect()
    by = {}
    for r in got:
        by.setdefault(r.conv, []).append(r.pos)
    assert {c: sorted(p) for c, p in by.items()} == {c: list(range(1, n + 1)) for c, n in [(7, 3000)] + [(c, c) for c in range(1, 20) if c != 7]}


def test_ids_are_hashed_in_order(spark):
    members = {"a": [5, -3, 10 ** 15, 4096, 4095, 0], "b": list(range(20_000)), "": [9]}
    df = spark.createDataFrame([(k, c) for k, v in members.items() for c in v], "key string, conv long").repartition(5)
    want = {k: hashlib.sha256(",".join(map(str, sorted(v))).encode()).hexdigest() for k, v in members.items()}
    assert {r.key: r.ends for r in prefix_trie.joined_hashes(df).collect()} == want


def test_query_equals_brute_force_and_sql(spark):
    table = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    got = sorted(map(tuple, prefix_trie.query(table).collect()), key=str)
    assert got == brute(rebuilt([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF_SMALL}/conversations.parquet'")
    rel = con.sql(prefix_trie.ORACLE)
    assert rel.columns == prefix_trie.query(table).columns
    assert sorted(rel.fetchall(), key=str) == got
