"""Exact top-k search by inner product in a forest of M-trees.

Vectors are lifted by one coordinate to a common length, after which a larger inner product with a query is a smaller
Euclidean distance to it. They are dealt to trees near a pivot; each tree is a table of pages. An entry of a page holds an
object, the covering radius of its subtree and its distance to the page's own object. The search opens the most promising
page first and, by the triangle inequality over stored distances, skips entries without computing their distance.
Distances only prune: scores are computed in integers.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.functions import pandas_udf

from ..session import settle

PIVOTS = 32
MOST_PIVOTS = 256
PIVOT_SAMPLE = 2048
TREE_ROWS = 16_384
PAGE = 128
FANOUT = 16
BLOCK = 20_000
PAGES = "tree int, page int, leaf boolean, ids array<bigint>, objects binary, child array<int>, radius array<double>, away array<double>"


def lift(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with the coordinate that brings their squared length to ``longest``."""
    vectors = vectors.astype(np.float64)
    rest = np.sqrt(np.maximum(longest - np.einsum("ij,ij->i", vectors, vectors), 0))
    return np.concatenate([vectors, rest[:, None]], axis=1)


def far_apart(points: np.ndarray, n: int) -> np.ndarray:
    """Indexes of up to ``n`` points, each the farthest from those before; fewer where points coincide."""
    chosen = [0]
    gap = np.linalg.norm(points - points[0], axis=1)
    while len(chosen) < n:
        i = int(gap.argmax())
        if gap[i] <= 0:
            break
        chosen.append(i)
        gap = np.minimum(gap, np.linalg.norm(points - points[i], axis=1))
    return np.array(chosen)


def build(ids: np.ndarray, vectors: np.ndarray, longest: float) -> list[tuple]:
    """Pages of one tree, in bulk: ``(page, leaf, ids, vectors, child, radius, away)``; page 0 is the root."""
    points = lift(vectors, longest)
    pages: list[tuple | None] = []

    def page(members: np.ndarray, centre: int) -> tuple[int, float]:
        """Write the page of ``members`` around an object; its number and covering radius."""
        number = len(pages)
        pages.append(None)
        away = np.linalg.norm(points[members] - points[centre], axis=1)
        if len(members) <= PAGE:
            pages[number] = (number, True, ids[members], vectors[members], [-1] * len(members), [0.0] * len(members), away)
            return number, float(away.max(initial=0.0))
        step = max(1, len(members) // 512)
        seeds = members[::step][far_apart(points[members[::step]], FANOUT)]
        if len(seeds) > 1:
            nearest = np.stack([np.linalg.norm(points[members] - points[s], axis=1) for s in seeds]).argmin(axis=0)
            groups = [(s, members[nearest == i]) for i, s in enumerate(seeds) if (nearest == i).any()]
        else:
            groups = [(members[0], members)]
        if len(groups) == 1:
            # Points that coincide, at least in the sample: cut them evenly.
            parts = np.array_split(members, min(FANOUT, -(-len(members) // PAGE)))
            groups = [(int(p[0]), p) for p in parts]
        child, radius = [], []
        for seed, group in groups:
            found = page(group, int(seed))
            child.append(found[0])
            radius.append(found[1])
        objects = np.array([s for s, _ in groups])
        pages[number] = (number, False, ids[objects], vectors[objects], child, radius, np.linalg.norm(points[objects] - points[centre], axis=1))
        return number, float(away.max(initial=0.0))

    page(np.arange(len(ids)), 0)
    return pages


class Tree:
    """Pages of one tree, ready to be searched."""

    def __init__(self, rows: pd.DataFrame, width: int, longest: float):
        self.longest, self.pages, self.computed = longest, {}, 0
        for r in rows.itertuples(index=False):
            vectors = np.frombuffer(r.objects, np.int64).reshape(len(r.ids), width)
            self.pages[r.page] = (
                r.leaf, np.asarray(r.ids, np.int64), vectors, lift(vectors, longest) if not r.leaf else vectors.astype(np.float64),
                np.asarray(r.child), np.asarray(r.radius, float), np.asarray(r.away, float),
            )

    def search(self, query: np.ndarray, own: int, k: int, floor: float) -> list[tuple[int, int]]:
        """The ``k`` best ``(score, id)`` of at least ``floor``, best first, ties to the smaller id, without ``own``."""
        q = query.astype(np.float64)
        whole = float(q @ q) + self.longest
        slack = 1e-6 * (1.0 + math.sqrt(whole))
        lifted = np.append(q, 0.0)
        best: list[tuple[int, int]] = []
        # The root has no entry above it, so no distance to its object is known.
        waiting: list[tuple[float, int, float]] = [(0.0, 0, math.nan)]
        # Floating products are exact while every sum stays below 2 ** 53, which the longest vectors decide.
        exact = whole < 1 << 52
        while waiting:
            least = best[-1][0] if len(best) == k else floor
            limit = math.inf if least == -math.inf else math.sqrt(max(0.0, whole - 2.0 * least)) + slack
            near, number, known = heapq.heappop(waiting)
            if near > limit:
                break
            leaf, ids, vectors, points, child, radius, away = self.pages[number]
            if math.isnan(known):
                keep = np.arange(len(ids))
            else:
                keep = np.flatnonzero(np.abs(known - away) - radius <= limit)
                if not len(keep):
                    continue
            self.computed += len(keep)
            if leaf:
                scores = (points[keep] @ q).astype(np.int64) if exact else vectors[keep] @ query
                good = keep[scores >= least] if least != -math.inf else keep
                if len(good):
                    scores = scores[scores >= least] if least != -math.inf else scores
                    found = [(int(s), int(i)) for s, i in zip(scores, ids[good]) if i != own]
                    best = sorted(best + found, key=lambda x: (-x[0], x[1]))[:k]
            else:
                apart = np.linalg.norm(points[keep] - lifted, axis=1)
                for i, d in zip(keep.tolist(), apart.tolist()):
                    bound = max(0.0, d - radius[i])
                    if bound <= limit:
                        heapq.heappush(waiting, (bound, int(child[i]), d))
        return best


def within(query: np.ndarray, least: float, pivots: np.ndarray, radius: np.ndarray, longest: float) -> np.ndarray:
    """Indexes of the pivots whose cell may hold a vector that scores ``least`` or more with the query.

    A cell's vectors lie inside its covering radius and are nearer to its pivot than to any other, which bounds their distance twice.
    """
    q = query.astype(np.float64)
    whole = float(q @ q) + longest
    apart = np.linalg.norm(pivots - np.append(q, 0.0), axis=1)
    limit = math.sqrt(max(0.0, whole - 2.0 * least)) + 1e-6 * (1.0 + math.sqrt(whole))
    return np.flatnonzero(np.maximum(apart - radius, (apart - apart.min()) / 2) <= limit)


def scaled(vector: Column) -> Column:
    """floor(256 x) of each component."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * 256).cast("bigint"))


def usable(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    return vector.isNotNull() & F.forall(vector, finite)


def matrix(column: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(column), width), np.int64)
    for i, v in enumerate(column):
        out[i, :len(v)] = v
    return out


def top_k(vectors: DataFrame, every: int = 50, k: int = 5, *, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score``: for each query its ``k`` best by integer inner product.

    Queries are the rows whose key is divisible by ``every``; candidates are all rows but the query's own. Vectors that
    are null or hold a null or non-finite component, and rows without a key, take no part. A vector shorter than others
    counts as ending in zeros. Rows that repeat a key count once, with the largest vector of the key. Ties go to the
    smaller key; a query with fewer than ``k`` candidates gives fewer rows, one without any gives none. Scores must fit
    a long.

    Pivots, up to ``MOST_PIVOTS`` with the rows, come from a bounded sample (``PIVOT_SAMPLE`` rows) and only decide which tree a
    vector goes to; every vector is indexed. A pivot with many vectors gets several trees, so that no task holds more than about
    ``TREE_ROWS`` vectors or ``BLOCK`` queries. Queries first search the tree of their own vector; what they find there bounds
    the others, and only trees in cells that can reach this bound are searched.
    """
    v = F.col(f"`{vector}`")
    rows = vectors.where(F.col(f"`{key}`").isNotNull() & usable(v)).select(F.col(f"`{key}`").cast("bigint").alias("id"), scaled(v).alias("v"))
    rows = settle(rows.groupBy("id").agg(F.max("v").alias("v")), "vectors")
    length = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    width, longest, n = rows.agg(F.max(F.size("v")), F.max(length), F.count("*")).first()
    if not n:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    width = max(1, width)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(PIVOT_SAMPLE).select("v").collect()
    points = lift(matrix(pd.Series([r["v"] for r in sample]), width), longest)
    pivots = points[far_apart(points, max(PIVOTS, min(MOST_PIVOTS, n // TREE_ROWS)))]

    @pandas_udf("cell int, gap double")
    def cell(column: pd.Series) -> pd.DataFrame:
        own = lift(matrix(column, width), longest)
        gaps = np.stack([np.linalg.norm(own - p, axis=1) for p in pivots])
        return pd.DataFrame({"cell": gaps.argmin(axis=0).astype(np.int32), "gap": gaps.min(axis=0)})

    dealt = settle(rows.withColumn("x", cell("v")).select("id", "v", "x.*"), "vector-cells")
    balls = dealt.groupBy("cell").agg(F.count("*").alias("n"), F.max("gap").alias("radius")).collect()
    counts, radius = {b["cell"]: b["n"] for b in balls}, np.full(len(pivots), -np.inf)
    for b in balls:
        radius[b["cell"]] = b["radius"]
    first, parts, trees = [], [], 0
    for i in range(len(pivots)):
        first.append(trees)
        parts.append(max(1, -(-counts.get(i, 0) // TREE_ROWS)))
        trees += parts[-1] if counts.get(i) else 0
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("cell") + 1)
    tree = (pick(first) + F.pmod(F.xxhash64("id"), pick(parts))).cast("int")
    dealt = dealt.select("id", "v", tree.alias("tree"))

    def pages_of(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id")
        made = build(group["id"].to_numpy(), matrix(group["v"], width), longest)
        number = int(group["tree"].iloc[0])
        return pd.DataFrame(
            [(number, p, leaf, i, x.astype(np.int64).tobytes(), c, r, a) for p, leaf, i, x, c, r, a in made],
            columns=["tree", "page", "leaf", "ids", "objects", "child", "radius", "away"],
        )

    pages = settle(dealt.groupBy("tree").applyInPandas(pages_of, PAGES), "tree-pages")
    queries = dealt.where(F.col("id") % every == 0)
    blocks = max(1, -(-queries.count() // BLOCK))
    queries = settle(queries.withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int")), "queries")
    copies = pages.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))) if blocks > 1 else pages.withColumn("block", F.lit(0))

    def search(own_pages: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(own_pages) and len(asked):
            found = Tree(own_pages, width, longest)
            for query, bound, v in zip(asked["id"], asked["bound"], matrix(asked["v"], width)):
                floor = -math.inf if bound is None or pd.isna(bound) else int(bound)
                out += [(query, i, s) for s, i in found.search(v, query, k, floor)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    def searched(asked: DataFrame) -> DataFrame:
        return (
            copies.groupBy("tree", "block").cogroup(asked.groupBy("tree", "block"))
            .applyInPandas(search, "query_id bigint, vec_id bigint, score bigint")
        )

    @pandas_udf(T.ArrayType(T.IntegerType()))
    def reached(column: pd.Series, bound: pd.Series) -> pd.Series:
        least = bound.fillna(-np.inf)
        cells = (within(v, b, pivots, radius, longest) if b > -np.inf else range(len(pivots)) for v, b in zip(matrix(column, width), least))
        return pd.Series([[t for i in own if counts.get(i) for t in range(first[i], first[i] + parts[i])] for own in cells], dtype=object)

    home = settle(searched(queries.withColumn("bound", F.lit(None).cast("bigint"))), "home-results")
    bounds = home.groupBy("query_id").agg(F.when(F.count("*") == k, F.min("score")).alias("bound"))
    others = settle(
        queries.join(bounds, F.col("id") == F.col("query_id"), "left").drop("query_id").withColumnRenamed("tree", "own")
        .withColumn("tree", F.explode(reached("v", F.col("bound").cast("double")))).where("tree <> own").select("id", "v", "tree", "block", "bound"),
        "other-trees",
    )
    found = home.union(searched(others)) if trees > 1 else home
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
