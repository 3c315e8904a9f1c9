"""Approximate vector search: cells that a query need not read, short codes for those it reads, exact scores for the best.

A vector lies in the folders of its two nearest cells. Its product code, a byte for each few dimensions, names the nearest entry
of a codebook per piece; the sum of a query's products with those entries is close to the whole product. A search reads ids and
codes of the nearest cells only, and full vectors only of the best by code.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from ..functions.scalars import check_range
from ..functions.vectors import as_vector, cosine_similarity
from ..schemas import SEARCH_ROWS
from ..session import fresh_path
from .vectors import QUERY_BLOCK, apply_filter, cosine_topk

#: Vectors of one cell that meet one block of queries in a task.
CODE_BLOCK = 65_536
#: Sampled vectors that the codebooks are made from, and those that serve as queries when the number of probes is chosen.
BOOK_SAMPLE, TRIAL_QUERIES = 16_384, 256


def unit_rows(vectors) -> np.ndarray:
    matrix = np.array(list(vectors), dtype=np.float64)
    return matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-300)


def codebook(rows: np.ndarray, entries: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Centres of the rows by Lloyd's rounds, starting at distinct rows; fewer than ``entries`` if there are fewer rows."""
    distinct = np.unique(rows, axis=0)
    centres = distinct[np.random.default_rng(seed).permutation(len(distinct))[:entries]]
    for _ in range(rounds):
        nearest = np.argmin((centres ** 2).sum(1) - 2 * rows @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, rows)
        counts = np.bincount(nearest, minlength=len(centres))
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def encode(units: np.ndarray, books: list[np.ndarray]) -> np.ndarray:
    """One byte per piece: the nearest entry of the piece's codebook."""
    out, start = np.empty((len(units), len(books)), np.uint8), 0
    for j, book in enumerate(books):
        piece = units[:, start:start + book.shape[1]]
        out[:, j] = np.argmin((book ** 2).sum(1) - 2 * piece @ book.T, axis=1)
        start += book.shape[1]
    return out


def query_tables(units: np.ndarray, books: list[np.ndarray]) -> np.ndarray:
    """For each query the products of its pieces with all entries, ``(queries, pieces, 256)``."""
    out, start = np.zeros((len(units), len(books), 256)), 0
    for j, book in enumerate(books):
        out[:, j, :len(book)] = units[:, start:start + book.shape[1]] @ book.T
        start += book.shape[1]
    return out


def code_scores(table: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return table[np.arange(codes.shape[1]), codes].sum(axis=1)


def _by_distance(units: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """For each row the cells, nearest first."""
    if not len(centres):
        return np.zeros((len(units), 0), int)
    return np.argsort(-(units @ centres.T), axis=1, kind="stable")


class CellIndex:
    """Vectors in a folder per cell, each in its two nearest cells (``home`` is the nearest), with a product code beside them.

    Centres, codebooks and the number of rows per cell live on the driver: as many cells as the square root of the rows, but not
    more than an eighth of the sample. They are stored beside the cells, so ``open`` finds the index again.
    """

    def __init__(self, path: str, schema: StructType, centres: np.ndarray, books: list[np.ndarray], sizes: dict[int, int], probes: int, vector: str):
        self.path, self.schema, self.vector = path, schema, vector
        self.centres, self.books, self.sizes, self.probes = centres, books, sizes, probes

    @classmethod
    def build(
        cls, points: DataFrame, lists: int | None = None, vector: str = "vector", seed: int = 7, sample: int = 100_000, path: str | None = None,
        dims_a_piece: int = 4, k: int = 25, target: float = 0.96,
    ) -> CellIndex:
        """Centres and codebooks come from at most ``sample`` points, those with the smallest hash of their id; every point is stored.

        ``probes`` becomes the smallest number of cells that holds ``target`` of the nearest neighbours of sampled points. Points without a vector are left out.
        """
        from pyspark.ml.clustering import KMeans
        from pyspark.ml.functions import array_to_vector

        spark = points.sparkSession
        held = points.filter(F.col(vector).isNotNull())
        path = path or fresh_path(spark, "cells")
        total = held.count()
        drawn = held.select("id", F.col(vector).cast("array<double>").alias("v")).orderBy(F.xxhash64("id"), "id").limit(sample)
        lists = max(1, min(lists or math.ceil(math.sqrt(total)), max(1, min(total, sample) // 8)))
        if lists > 1:
            means = KMeans(k=lists, seed=seed, featuresCol="_features", distanceMeasure="cosine")
            centres = unit_rows(means.fit(drawn.select(array_to_vector("v").alias("_features"))).clusterCenters())
        else:
            centres = np.zeros((1, drawn.select(F.size("v")).first()[0])) if total else np.zeros((0, 1))
        units = unit_rows(r["v"] for r in drawn.limit(BOOK_SAMPLE).collect()) if total else np.zeros((0, 1))
        pieces = max(1, units.shape[1] // dims_a_piece)
        books = [codebook(units[:, at], 256) for at in np.array_split(np.arange(units.shape[1]), pieces)] if total else []
        probes = _enough_probes(units, centres, max(1, round(k * len(units) / max(total, 1))), target)

        names, schema = held.columns, held.schema

        def place(batches):
            for batch in batches:
                if len(batch):
                    own = unit_rows(batch[vector])
                    near = _by_distance(own, centres)[:, :2]
                    codes = [row.tobytes() for row in encode(own, books)]
                    for rank in range(near.shape[1]):
                        yield batch.assign(code=codes, home=near[:, 0], cell=near[:, rank])[[*names, "code", "home", "cell"]]

        schema = StructType([*schema.fields]).add("code", "binary").add("home", "integer").add("cell", "integer")
        held.mapInPandas(place, schema).hint("rebalance", "cell").write.partitionBy("cell").parquet(path)
        sizes = {r["cell"]: r["count"] for r in spark.read.schema(schema).parquet(path).groupBy("cell").count().collect()}
        index = cls(path, schema, centres, books, sizes, probes, vector)
        index._store(spark)
        return index

    def _store(self, spark: SparkSession) -> None:
        row = (
            self.centres.tolist(), [b.tolist() for b in self.books], {int(c): int(n) for c, n in self.sizes.items()}, self.probes, self.vector, self.schema.json(),
        )
        kinds = "centres array<array<double>>, books array<array<array<double>>>, sizes map<int, bigint>, probes int, vector string, fields string"
        spark.createDataFrame([row], kinds).coalesce(1).write.parquet(f"{self.path}/_model")

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> CellIndex:
        import json

        found = spark.read.parquet(f"{path}/_model").first()
        schema = StructType.fromJson(json.loads(found["fields"]))
        return cls(path, schema, np.array(found["centres"]), [np.array(b) for b in found["books"]], dict(found["sizes"]), found["probes"], found["vector"])

    def cells(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(self.path)

    def search(
        self, spark: SparkSession, query: Sequence[float], k: int, probes: int | None = None, spec: dict | None = None, rerank: int | None = None
    ) -> DataFrame:
        """The ``k`` best by exact score among the ``rerank`` best by code (4 ``k`` unless given) in the ``probes`` nearest cells."""
        unit = unit_rows([query])
        nearest = [int(c) for c in _by_distance(unit, self.centres)[0][:probes or self.probes]]
        table = query_tables(unit, self.books)[0] if self.books else None

        @F.pandas_udf("double")
        def by_code(codes: pd.Series) -> pd.Series:
            packed = np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1)
            return pd.Series(code_scores(table, packed))

        # A vector whose home is read too is taken there.
        read = self.cells(spark).filter(F.col("cell").isin(nearest) & ((F.col("cell") == F.col("home")) | ~F.col("home").isin(nearest)))
        best = apply_filter(read, spec).select("cell", "id", by_code("code").alias("_near")).orderBy(F.desc("_near"), "id").limit(rerank or 4 * k)
        full = read.join(best.select("cell", "id"), ["cell", "id"], "left_semi")
        return cosine_topk(full.drop("code", "home"), query, k, None, self.vector)

    def candidates(self, spark: SparkSession, queries: DataFrame, rerank: int, probes: int | None = None) -> DataFrame:
        """``(query_id, id, cell)``: for every query ``(query_id, vector)`` the ``rerank`` best by code in its nearest cells.

        A cell is cut into blocks of bounded size, queries likewise; a block of both meets in a task that keeps ``rerank`` rows per query.
        """
        centres, books, probes = self.centres, self.books, probes or self.probes
        blocks = {cell: math.ceil(n / CODE_BLOCK) for cell, n in self.sizes.items()}
        wanted = queries.filter(F.col("vector").isNotNull()).select(F.col("query_id").cast("bigint").alias("query_id"), F.col("vector").cast("array<double>").alias("v"))
        columns = max(1, math.ceil(wanted.count() / QUERY_BLOCK))

        def visit(batches):
            for asked in batches:
                if len(asked):
                    near = _by_distance(unit_rows(asked["v"]), centres)[:, :probes]
                    rows = [(i, int(c), b, list(map(int, near[i]))) for i in range(len(asked)) for c in near[i] for b in range(blocks.get(int(c), 0))]
                    if rows:
                        at, cell, block, visited = zip(*rows)
                        yield asked.iloc[list(at)].assign(cell=cell, block=block, visited=visited)

        visits = wanted.mapInPandas(visit, "query_id bigint, v array<double>, cell int, block int, visited array<int>")
        visits = visits.withColumn("column", F.pmod(F.xxhash64("query_id"), F.lit(columns)).cast("int"))
        parts = F.get(F.lit([max(1, blocks.get(c, 1)) for c in range(max(1, len(centres)))]), F.col("cell"))
        codes = self.cells(spark).select(F.col("id").cast("bigint").alias("id"), "cell", "home", "code").withColumn(
            "block", F.pmod(F.xxhash64("id"), parts).cast("int")
        ).withColumn("column", F.explode(F.sequence(F.lit(0), F.lit(columns - 1))))

        def meet(own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
            found = []
            if len(own) and len(asked):
                own = own.sort_values("id", kind="stable")
                ids, homes, cell = own["id"].to_numpy(), own["home"].to_numpy(), int(own["cell"].iloc[0])
                packed = np.frombuffer(b"".join(own["code"]), np.uint8).reshape(len(own), -1)
                for query, vector, visited in zip(asked["query_id"], asked["v"], asked["visited"]):
                    scores = code_scores(query_tables(unit_rows([vector]), books)[0], packed)
                    scores[(homes != cell) & np.isin(homes, visited)] = -np.inf
                    best = np.argsort(-scores, kind="stable")[:rerank]
                    best = best[scores[best] > -np.inf]
                    found.append(pd.DataFrame({"query_id": query, "id": ids[best], "cell": cell, "near": scores[best]}))
            shape = {"query_id": "int64", "id": "int64", "cell": "int32", "near": "float64"}
            return pd.concat(found).astype(shape) if found else pd.DataFrame({c: [] for c in shape}).astype(shape)

        by = ("cell", "block", "column")
        met = codes.groupBy(*by).cogroup(visits.groupBy(*by)).applyInPandas(meet, "query_id bigint, id bigint, cell int, near double")
        order = Window.partitionBy("query_id").orderBy(F.desc("near"), "id")
        return met.withColumn("_at", F.row_number().over(order)).filter(F.col("_at") <= rerank).select("query_id", "id", "cell")

    def search_batch(self, spark: SparkSession, queries: DataFrame, k: int, probes: int | None = None, rerank: int | None = None) -> DataFrame:
        """``(query_id, id, score, rank)``: the ``k`` best by exact score among each query's candidates."""
        check_range("k", k, SEARCH_ROWS)
        few = self.candidates(spark, queries, rerank or 4 * k, probes)
        stored = self.cells(spark).select(F.col("id").cast("bigint").alias("id"), "cell", F.col(self.vector).cast("array<double>").alias("_v"))
        asked = queries.select(F.col("query_id").cast("bigint").alias("query_id"), F.col("vector").alias("_q"))
        score = cosine_similarity(F.col("_v"), as_vector("_q"))
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
        scored = few.join(stored, ["cell", "id"]).join(asked, "query_id").select("query_id", "id", score.alias("score"))
        return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _enough_probes(units: np.ndarray, centres: np.ndarray, k: int, target: float) -> int:
    """Cells to read so that ``target`` of the ``k`` nearest sampled neighbours of sampled queries lie in one of them."""
    if len(units) < 2:
        return len(centres)
    asked = units[:TRIAL_QUERIES]
    alike = asked @ units.T
    alike[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    nearest = np.argsort(-alike, axis=1)[:, :k]
    homes = _by_distance(units, centres)[:, :2]
    order = _by_distance(asked, centres)
    turn = np.empty_like(order)
    np.put_along_axis(turn, order, np.arange(len(centres))[None, :].repeat(len(asked), 0), axis=1)
    # Each neighbour is met when the first of its two cells is read.
    met = np.min(np.take_along_axis(turn[:, :, None], homes[nearest].reshape(len(asked), -1, 1), axis=1).reshape(len(asked), nearest.shape[1], -1), axis=2)
    return int(np.quantile(met, target, method="higher")) + 1
