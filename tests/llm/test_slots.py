"""Slot sharding against a recount of its own rows."""

import zlib
from collections import Counter, defaultdict

from tidemark.llm import slots
from tidemark.llm.reports import op7_slot_shards

SF = "/root/testdata/sf0.001"


def check(rows, shards=8):
    load, places = Counter({i: 0 for i in range(shards)}), defaultdict(list)
    for r in rows:
        load[r["shard"]] += r["size"]
        places[r["shard"]].append(r["slot"])
        assert r["law"] == "bytes" and r["grown_shard"] is None
    for found in places.values():
        assert sorted(found) == list(range(len(found)))
    return load


def test_query(spark):
    rows = op7_slot_shards(spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
    load = check(rows)
    assert max(load.values()) - min(load.values()) <= 0.01 * sum(load.values())


def test_odd_rows(spark):
    rows = [(1, None), (1, None), (None, "a"), (None, "a"), (2, ""), (3, "é" * 50_000), (4, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "7 AS shard", "'s' AS size", "1 AS virtual_slot", "2 AS slot")
    found = slots.shard_by_bytes(docs).collect()
    check(found)
    assert sorted(r["size"] for r in found) == [1, 1, 1, 2, 2, 2, 100_001]
    assert slots.shard_by_bytes(docs.limit(0)).count() == 0


def test_edits_move_few_slots_and_level():
    sizes = [(i * 7919) % 101 + 1 for i in range(512)]
    first = slots.first_map(512, 8)
    level = slots.rebalanced(first, sizes, 8)
    grown = slots.rebalanced(level, sizes, 9)
    for owner, shards in ((level, 8), (grown, 9)):
        load = [sum(s for s, o in zip(sizes, owner) if o == i) for i in range(shards)]
        assert max(load) - min(load) <= 2 * min(sizes) + 2
    # Growing by a shard moves about a ninth of the bytes.
    moved = sum(s for s, a, b in zip(sizes, level, grown) if a != b)
    assert moved <= 1.3 * sum(sizes) / 9


def test_versions_are_kept(spark, tmp_path):
    sizes = [(i, 1) for i in range(16)]
    path = slots.store_map(spark, {1: [0] * 16, 2: [i % 2 for i in range(16)]}, sizes, str(tmp_path / "map"))
    assert {r["shard"] for r in slots.read_map(spark, path, 1).collect()} == {0}
    newest = {r["virtual_slot"]: r for r in slots.read_map(spark, path).collect()}
    assert (newest[5]["shard"], newest[5]["first_row"], newest[5]["bytes"]) == (1, 2, 5)


def test_one_hot_key(spark):
    docs = spark.range(3000).selectExpr("IF(id % 3 = 0, 5, id) AS doc_id", "repeat('a', CAST(id % 50 AS INT)) AS text")
    rows = slots.shard_by_bytes(docs).collect()
    assert len(rows) == 3000
    check(rows)


def test_hot_keys_and_hot_rows_spread(spark):
    """Half the rows under one key, a third of all rows equal: shards stay within a hundredth."""
    docs = spark.range(12_000).selectExpr("IF(id % 2 = 0, 5, id) AS doc_id", "IF(id % 6 < 2, 'same', repeat('a', CAST(id % 97 AS INT))) AS text")
    docs = docs.unionByName(spark.range(6000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "'same' AS text"))
    rows = slots.shard_by_bytes(docs).collect()
    assert len(rows) == 18_000
    load = check(rows)
    assert max(load.values()) - min(load.values()) <= 0.01 * sum(load.values())
