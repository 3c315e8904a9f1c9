"""SimHash near-duplicates against brute force over all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import simhash
from tidemark.llm.components import components
from tidemark.llm.reports import op3_simhash

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_print(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Smallest key per row; ``prints`` is a list of (key, fingerprint)."""
    at = {}
    for k, f in prints:
        at.setdefault(f, []).append(k)
    distinct = sorted(at)
    parent = {f: f for f in distinct}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, f in enumerate(distinct):
        for g in distinct[i + 1:]:
            if (f ^ g).bit_count() <= 3:
                parent[root(f)] = root(g)
    least = {}
    for f in distinct:
        for k in at[f]:
            if k is not None:
                least[root(f)] = min(k, least.get(root(f), k))
    return [(k, f, least.get(root(f))) for k, f in prints]


def test_query(spark):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    expected = brute_components([(k, brute_print(t)) for k, t in texts])
    found = [(r["doc_id"], int(r["fingerprint"], 16), r["component_id"]) for r in op3_simhash(spark, SF).collect()]
    assert sorted(found) == sorted(expected)


def odd_texts():
    rnd = random.Random(6)
    base = " ".join(f"w{rnd.randrange(500)}" for _ in range(400))
    texts = [None, "", " \t", "a", "A b", "a B", "É é", "x " * 70_000, base, base.upper().lower()]
    for _ in range(150):
        words = base.split()
        for _ in range(rnd.randint(1, 3)):
            words[rnd.randrange(len(words))] = f"v{rnd.randrange(1000)}"
        texts.append(" ".join(words))
    return texts


def test_odd_rows_and_a_large_group(spark):
    rows = [(i + 10, t) for i, t in enumerate(odd_texts())] + [(None, "a b c d"), (None, ""), (3, None), (10, None), (7, "twice"), (7, "twice")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'z' AS fp", "1 AS fingerprint", "2 AS component_id")
    expected = brute_components([(k, brute_print(t)) for k, t in rows])
    found = [(r["doc_id"], int(r["fingerprint"], 16), r["component_id"]) for r in simhash.near_duplicates(docs).collect()]
    order = lambda x: (x[0] is None, x)
    assert sorted(map(repr, found)) == sorted(map(repr, expected))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    wanted = {c for _, _, c in expected if c is not None}
    assert sorted(x for x in ids if x is not None) == sorted(wanted) and ids.count(None) == 1
    assert order
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.keep_one(docs.limit(0)).count() == 0


def reached(values, i, j):
    parent = list(range(len(values)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in zip(i, j):
        assert (int(values[a]) ^ int(values[b])).bit_count() <= 3
        parent[root(a)] = root(b)
    groups = {}
    for x in range(len(values)):
        groups.setdefault(root(x), set()).add(x)
    return sorted(map(sorted, groups.values()))


def test_forests_agree():
    rnd = np.random.default_rng(1)
    bits = (rnd.random((600, 20)) < 0.12) @ (1 << np.arange(20))
    values = np.unique(bits.astype(np.uint64) | np.uint64(1 << 63))
    walked, probed = simhash.walked_forest(values), simhash.probed_forest(values)
    assert reached(values, *walked) == reached(values, *probed)
    full = [(i, j) for i in range(len(values)) for j in range(i) if (int(values[i]) ^ int(values[j])).bit_count() <= 3]
    assert reached(values, *zip(*full)) == reached(values, *walked)


def test_no_link_is_lost(spark):
    rnd = random.Random(8)
    prints = set()
    for _ in range(300):
        f = rnd.getrandbits(64)
        prints.add(f)
        g = f
        for b in rnd.sample(range(64), rnd.randint(1, 3)):
            g ^= 1 << b
        prints.add(g)
    for b in range(40):
        prints.add(0xABCDEF << 30 | 1 << b)
    prints = sorted(prints)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in prints]
    links = simhash.near_links(spark.createDataFrame(signed, "fp bigint")).collect()
    as_groups = components(spark.createDataFrame(links)).collect()
    root = {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in as_groups}
    for i, f in enumerate(prints):
        for g in prints[i + 1:]:
            if (f ^ g).bit_count() <= 3:
                assert root[f] == root[g]


@pytest.mark.parametrize("n", [1, 2, 50])
def test_components_of_paths_and_stars(spark, n):
    path = [(i, i + 1) for i in range(n)] + [(1000, 1000 + i) for i in range(n)] + [(5000, None)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(path, "a bigint, b bigint")).collect()}
    assert found == {**{i: 0 for i in range(n + 1)}, **({1000 + i: 1000 for i in range(n)} if n > 1 else {})}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_variants(spark):
    df = spark.createDataFrame([(-1,), (5,)], "fp bigint").select(simhash.variants(F.col("fp")).alias("v"))
    full, five = [r["v"] for r in df.collect()]
    assert len(set(full)) == 64 and full[0] == 0xFFFFFFFE and full[33] == 1 << 37 | 1 << 32 | 0xFFFFFFFD
    assert five[0] == 4 and five[33] == 1 << 37 | 1 << 32


def test_checksum_of_very_many_links(spark):
    """More links than a sum of their hashes could hold in a long."""
    from tidemark.llm.components import _mark

    links = spark.range(20_000_000).selectExpr("id AS a", "id + 1 AS b")
    mark = _mark(links)
    assert mark[0] == 20_000_000 and mark == _mark(links.repartition(3)) and mark != _mark(links.where("a <> 17"))
