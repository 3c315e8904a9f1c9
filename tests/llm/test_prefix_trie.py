"""The trie of conversations against a plain one built in Python."""

import hashlib
import os
import random
import zlib

import duckdb
import pytest

from tidemark.llm.prefix_trie import BAND, prefix_nodes
from tidemark.llm.reports import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def plain(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    rebuilt = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        rebuilt[c] = own.get(base, [])[:h] + ts[h:]
    members, ends, kids = {}, {}, {}
    for c in sorted(rebuilt):
        path = tuple(rebuilt[c])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
            if d:
                kids.setdefault(path[:d - 1], set()).add(path[:d])
        ends.setdefault(path, []).append(c)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = kids.get(node, ())
        leaves[node] = sum(leaves[k] for k in below) if below else 1
        saved[node] = sum(saved[k] for k in below) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
    return sorted(
        (m[0], len(n), members[n[:-1]][0] if n else -1, len(m), len(kids.get(n, ())), leaves[n], saved[n],
         hashlib.sha256(",".join(map(str, ends.get(n, []))).encode()).hexdigest())
        for n, m in members.items()
    )


def found(spark, rows):
    nodes = prefix_nodes(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS depth", "'x' AS p1", "2 AS place"))
    assert nodes.columns == NAMES
    return sorted(tuple(-1 if v is None else v for v in r) for r in nodes.collect())


def test_random_conversations(spark):
    rnd = random.Random(2)
    rows = []
    for conv in [*range(0, 40), *range(100, 140), 205, 300, 301, -7, -100]:
        opening = [("system", f"shared {conv // 100 % 2}"), ("user", "a"), ("assistant", "ää日")]
        turns = opening[:rnd.randint(0, 3)] + [(rnd.choice(["user", "assistant", ""]), rnd.choice(["a", "b", "cc", ""])) for _ in range(rnd.randint(0, 7))]
        rows += [(conv, i * 2, role, text) for i, (role, text) in enumerate(turns or [("user", "only")])]
    rnd.shuffle(rows)
    assert found(spark, rows) == plain(rows)


def test_deep_conversations(spark):
    """Two long conversations that part after 150 turns, through three levels of bands."""
    assert BAND ** 2 < 300
    rows = [(c, i, "user", f"{i % 7}" if i < 150 else f"{c} {i}") for c in (400, 402) for i in range(300 if c == 400 else 170)]
    rows += [(c, i, "user", f"{i % 7}") for c in (401, 403) for i in range(64)]
    assert found(spark, rows) == plain(rows)


def test_odd_rows(spark):
    rows = [
        (1, None, None, None), (1, None, "user", "x"), (1, 0, "user", "x"), (1, 0, "user", "x"), (1, 0, "assistant", "x"), (2, 5, "", ""), (2, 5, "", ""),
        (None, 1, "user", "lost"), (None, None, None, None), (100, 1, "user", "b" * 5000), (101, 1, "user", "b" * 5000), (107, -3, "user", None), (999, 0, None, "y"),
    ]
    rows += [(55, 7, "user", "again")] * 40
    assert found(spark, rows) == plain(rows)
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_nodes(empty).collect() == []
    assert prefix_nodes(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).collect() == []


def test_conversations_without_turns(spark):
    """A conversation whose turns are all replaced by an absent one stays a member of the root and ends there."""
    bare = next(c for c in range(1001, 1100) if zlib.crc32(str(c).encode()) % 6 >= 2)
    rows = [(bare, 0, "user", "a")]
    assert found(spark, rows) == [(bare, 0, -1, 1, 0, 1, 0, hashlib.sha256(str(bare).encode()).hexdigest())]
    assert found(spark, rows + [(5, i, "user", "z") for i in range(9)]) == plain(rows + [(5, i, "user", "z") for i in range(9)])


@pytest.mark.parametrize("parts", ["1", "8"])
def test_query(spark, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = QUERIES["op12_prefix_trie"](spark, SF_DIR).select(*NAMES).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF_DIR}/conversations.parquet'")
        expected = con.execute(f"SELECT {', '.join(NAMES)} FROM ({ORACLES['op12_prefix_trie']})").fetchall()
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, expected))
