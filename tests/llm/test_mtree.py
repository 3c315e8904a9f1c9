"""M-tree search against brute force."""

import duckdb
import numpy as np
import pandas as pd
import pytest

from tidemark.llm import mtree
from tidemark.llm.reports import ORACLES, op6_m_tree

SF = "/root/testdata/sf0.01"


def brute(rows, every, k):
    """Rows as {id: vector}; vectors are padded with zeros."""
    out = []
    ints = {i: [int(np.floor(256 * float(np.float32(x)))) for x in v] for i, v in rows.items()}
    for q in sorted(ints):
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(ints[q], ints[c])), c) for c in ints if c != q)
            out += [(q, r, c, -s) for r, (s, c) in enumerate(scores[:k], 1)]
    return out


def rows_of(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


def test_query(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    expected = duck.execute(ORACLES["op6_m_tree"]).fetchall()
    found = op6_m_tree(spark, SF)
    assert [f.dataType.simpleString() for f in found.schema] == ["bigint", "int", "bigint", "bigint"]
    assert rows_of(found) == sorted(expected)


def test_many_trees_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(mtree, "TREE_ROWS", 64)
    monkeypatch.setattr(mtree, "PAGE", 8)
    monkeypatch.setattr(mtree, "BLOCK", 10)
    monkeypatch.setattr(mtree, "PIVOTS", 6)
    rnd = np.random.default_rng(3)
    centres = rnd.normal(size=(5, 8))
    rows = {i: (centres[i % 5] + 0.1 * rnd.normal(size=8)).astype(np.float32).tolist() for i in range(500)}
    rows |= {i: rows[7] for i in range(500, 700)}  # one vector holds many rows
    frame = spark.createDataFrame(list(rows.items()), "vec_id bigint, embedding array<float>")
    assert rows_of(mtree.top_k(frame, 10, 5)) == brute(rows, 10, 5)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (50, None), (100, [nan, 1.0]), (150, [1.0, None]), (200, [inf, 0.0]), (None, [9.0, 9.0]), (250, []), (1, [1.0]),
            (2, [0.5, 0.5, 0.25]), (3, [0.5, 0.5, 0.25]), (3, [0.5, 0.5, 0.25]), (300, [-1.0, 1e-9]), (-50, [3.0, -2.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "1 AS id", "2 AS v", "3 AS score", "4 AS rank")
    clean = {i: v for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    assert rows_of(mtree.top_k(frame)) == brute(clean, 50, 5)
    assert mtree.top_k(frame.limit(0)).count() == 0
    assert mtree.top_k(frame.where("vec_id = 0")).count() == 0


@pytest.mark.parametrize("same", [False, True])
def test_tree_prunes_and_stays_exact(same):
    rnd = np.random.default_rng(1)
    vectors = (rnd.normal(size=(40, 4)).repeat(100, axis=0) * 300 + rnd.normal(size=(4000, 4)) * 5).astype(np.int64)
    if same:
        vectors[:] = vectors[0]
    ids = np.arange(4000)
    longest = float((vectors ** 2).sum(axis=1).max())
    made = mtree.build(ids, vectors, longest)
    assert sum(len(p[2]) for p in made if p[1]) == 4000
    rows = pd.DataFrame([(0, p, leaf, i, x.tobytes(), c, r, a) for p, leaf, i, x, c, r, a in made],
                        columns=["tree", "page", "leaf", "ids", "objects", "child", "radius", "away"])
    tree = mtree.Tree(rows, 4, longest)
    for q in range(0, 4000, 400):
        scores = vectors @ vectors[q]
        expected = sorted(((int(s), int(i)) for i, s in enumerate(scores) if i != q), key=lambda x: (-x[0], x[1]))[:5]
        assert tree.search(vectors[q], q, 5, -np.inf) == expected
        assert tree.search(vectors[q], q, 5, expected[-1][0]) == expected
    if not same:
        assert tree.computed < 0.5 * 4000 * 20  # most distances are never computed


def test_trees_out_of_reach_are_not_searched(spark, monkeypatch):
    monkeypatch.setattr(mtree, "PIVOTS", 16)
    kept, plain = [], mtree.settle

    def noted(frame, label, *by):
        out = plain(frame, label, *by)
        kept.append((label, out))
        return out

    monkeypatch.setattr(mtree, "settle", noted)
    rnd = np.random.default_rng(5)
    centres = rnd.normal(size=(16, 12))
    centres *= 4 / np.linalg.norm(centres, axis=1)[:, None]
    rows = {i: (centres[i % 16] + 0.02 * rnd.normal(size=12)).astype(np.float32).tolist() for i in range(1600)}
    frame = spark.createDataFrame(list(rows.items()), "vec_id bigint, embedding array<float>")
    found = mtree.top_k(frame, 10, 5)
    assert rows_of(found) == brute(rows, 10, 5)
    asked = {label: frame for label, frame in kept}["other-trees"].count()
    assert asked <= 0.1 * 160 * 15, asked  # of all pairs of a query and another tree


def test_reach_never_misses():
    rnd = np.random.default_rng(6)
    vectors = (rnd.normal(size=(30, 6)).repeat(40, axis=0) * 200 + rnd.normal(size=(1200, 6)) * 40).astype(np.int64)
    longest = float((vectors ** 2).sum(axis=1).max())
    points = mtree.lift(vectors, longest)
    pivots = points[mtree.far_apart(points, 24)]
    gaps = np.stack([np.linalg.norm(points - p, axis=1) for p in pivots])
    cell, radius = gaps.argmin(axis=0), np.full(len(pivots), -np.inf)
    for i in range(len(pivots)):
        radius[i] = gaps[i, cell == i].max(initial=-np.inf)
    for q in range(0, 1200, 30):
        scores = vectors @ vectors[q]
        for least in np.sort(scores)[[-2, -6, -60]]:
            assert set(cell[scores >= least]) <= set(mtree.within(vectors[q], int(least), pivots, radius, longest))
