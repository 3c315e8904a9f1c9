"""Search documents, embeddings and vector search."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.json_text import sorted_json
from ..functions.scalars import check_range, iso_text
from ..functions.vectors import as_vector, cosine_similarity, l2_distance
from ..schemas import EMBEDDING_DIM, SEARCH_ROWS
from .mutations import upsert_points
from .reads import active_only, missing_ids, recent_records, semi_by_ids
from .spread import salted_join

QUERY_BLOCK = 4096
POINT_BLOCK = 32_768


def _condition(spec: dict[str, Any]) -> Column:
    key = spec.get("key")
    if not key:
        raise ValueError("a filter condition needs a 'key'")
    column = F.col(key)
    if "match" in spec:
        return F.coalesce(column == F.lit(spec["match"]), F.lit(False))
    if "range" in spec:
        tests = {
            "gte": lambda v: column >= v, "lte": lambda v: column <= v,
            "gt": lambda v: column > v, "lt": lambda v: column < v,
        }
        bounds = [tests[name](F.lit(value)) for name, value in spec["range"].items() if value is not None]
        return F.coalesce(reduce(lambda a, b: a & b, bounds, F.lit(True)), F.lit(False))
    raise ValueError(f"unsupported filter condition: {spec}")


def metadata_filter(spec: dict[str, list[dict[str, Any]]] | None) -> Column | None:
    """``must`` (all), ``must_not`` (none) and ``should`` (at least one) as one column; None without conditions."""
    spec = spec or {}
    must = [_condition(c) for c in spec.get("must", [])]
    must_not = [~_condition(c) for c in spec.get("must_not", [])]
    should = [_condition(c) for c in spec.get("should", [])]
    parts = must + must_not + ([reduce(lambda a, b: a | b, should)] if should else [])
    return reduce(lambda a, b: a & b, parts) if parts else None


def apply_filter(df: DataFrame, spec: dict[str, list[dict[str, Any]]] | None) -> DataFrame:
    condition = metadata_filter(spec)
    return df if condition is None else df.filter(condition)


def build_search_document(records: DataFrame) -> DataFrame:
    """``id``, the text to embed and the metadata of each record."""
    text = F.concat_ws(
        "\n",
        F.concat(F.lit("source: "), "source"),
        F.concat(F.lit("timestamp: "), iso_text("timestamp")),
        F.concat(F.lit("tags: "), F.concat_ws(", ", "tags")),
        F.concat(F.lit("data: "), sorted_json("raw_data")),
    )
    metadata = F.struct("source", iso_text("timestamp").alias("timestamp"), "tags", "processed")
    return records.select("id", text.alias("text"), metadata.alias("metadata"))


def distinct_texts(df: DataFrame, text: str = "text") -> DataFrame:
    """Each distinct text once, under the digest that leads back to its rows."""
    return df.select(F.sha2(text, 256).alias("text_key"), text).dropDuplicates(["text_key"])


def tf_idf_vectors(texts: DataFrame, text: str, dim: int) -> DataFrame:
    """``text_key`` and ``vector`` of distinct texts: unit-length TF-IDF of hashed words."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import IDF, HashingTF, Normalizer, Tokenizer
    from pyspark.ml.functions import vector_to_array

    stages = [
        Tokenizer(inputCol=text, outputCol="_words"),
        HashingTF(numFeatures=dim, inputCol="_words", outputCol="_tf"),
        IDF(inputCol="_tf", outputCol="_idf"),
        Normalizer(inputCol="_idf", outputCol="_unit"),
    ]
    return Pipeline(stages=stages).fit(texts).transform(texts).select(
        "text_key", vector_to_array("_unit", "float32").alias("vector")
    )


def embed_texts(
    df: DataFrame, text: str = "text", dim: int = EMBEDDING_DIM, encoder: Callable[[Column], Column] | None = None
) -> DataFrame:
    """Adds ``vector``; each distinct text is embedded once. ``encoder``, such as a pandas UDF around a model, maps
    the text column to the vector column; without one it is TF-IDF.

    Copies of one text may be a large share of the rows, so the way back to them is salted.
    """
    distinct = distinct_texts(df.filter(F.col(text).isNotNull()), text)
    if encoder is None:
        vectors = tf_idf_vectors(distinct, text, dim)
    else:
        vectors = distinct.select("text_key", encoder(F.col(text)).alias("vector"))
    keyed = df.withColumn("text_key", F.sha2(text, 256))
    return salted_join(keyed, vectors, ["text_key"], "left", salt_by=F.struct(*[c for c in df.columns if c != text])).drop("text_key")


def index_documents(points: DataFrame | None, documents: DataFrame, dim: int = EMBEDDING_DIM, order: str | None = None) -> DataFrame:
    """Points ``(id, vector, payload)`` after embedding and upserting ``(id, text, metadata)``.

    Of several documents with one id the last in ``order`` counts, without ``order`` the one with the largest text.
    """
    place = F.struct(order, "text") if order else F.col("text")
    last = documents.groupBy("id").agg(F.max_by(F.struct("text", "metadata"), place).alias("_d")).select("id", "_d.*")
    embedded = embed_texts(last, "text", dim).select("id", "vector", F.struct("text", "metadata.*").alias("payload"), F.lit(0).alias("_seq"))
    fresh = embedded.drop("_seq")
    return fresh if points is None else upsert_points(points, embedded, "_seq")


def index_by_ids(records: DataFrame, ids: DataFrame, points: DataFrame | None = None, dim: int = EMBEDDING_DIM) -> tuple[DataFrame, DataFrame]:
    """Points for the requested records and a report ``(requested, indexed, missing)``."""
    found = semi_by_ids(records, ids)
    counts = [
        ids.select("id").distinct().agg(F.count(F.lit(1))).scalar().alias("requested"),
        found.agg(F.count(F.lit(1))).scalar().alias("indexed"),
        missing_ids(records, ids).agg(F.count(F.lit(1))).scalar().alias("missing"),
    ]
    report = records.sparkSession.range(1).select(*counts)
    return index_documents(points, build_search_document(found), dim), report


def index_recent(records: DataFrame, limit: int, source: str | None = None, dim: int = EMBEDDING_DIM) -> DataFrame:
    return index_documents(None, build_search_document(recent_records(records, limit, source)), dim)


def cosine_topk(
    points: DataFrame, query: Sequence[float], k: int, spec: dict | None = None, vector: str = "vector"
) -> DataFrame:
    """The ``k`` points most similar to the query among those that pass the filter; ties go to the lower id."""
    check_range("k", k, SEARCH_ROWS)
    score = cosine_similarity(as_vector(vector), as_vector(query))
    return apply_filter(points, spec).withColumn("score", score).orderBy(F.desc("score"), "id").limit(k)


def cosine_topk_batch(
    points: DataFrame, queries: DataFrame, k: int, vector: str = "vector", query_block: int = QUERY_BLOCK, point_block: int = POINT_BLOCK
) -> DataFrame:
    """The ``k`` best points for every query ``(query_id, vector)``.

    Points and queries are cut into blocks of bounded size by hash. Each pair of blocks meets in one group, which
    multiplies two matrices and keeps ``k`` rows per query, so only those go to the final ranking. Nothing but the two
    counts reaches the driver. A vector without length has similarity 0, a null one takes no part.
    """
    check_range("k", k, SEARCH_ROWS)
    left = points.filter(F.col(vector).isNotNull()).select(F.col("id").cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    right = queries.filter(F.col("vector").isNotNull()).select(
        F.col("query_id").cast("bigint").alias("query_id"), F.col("vector").cast("array<double>").alias("v")
    )
    rows, columns = (max(1, math.ceil(df.count() / size)) for df, size in ((left, point_block), (right, query_block)))
    blocks = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    slot = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    left = left.withColumn("row", slot("id", rows)).withColumn("column", blocks(columns))
    right = right.withColumn("column", slot("query_id", columns)).withColumn("row", blocks(rows))

    def unit(vectors: pd.Series) -> np.ndarray:
        matrix = np.array(vectors.tolist(), dtype=np.float64)
        return matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-300)

    def search(own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(own) and len(asked):
            own = own.sort_values("id", kind="stable")
            ids, stored = own["id"].to_numpy(), unit(own["v"])
            for start in range(0, len(asked), 256):
                part = asked.iloc[start:start + 256]
                for query, scores in zip(part["query_id"], unit(part["v"]) @ stored.T):
                    # Ties go to the lower id, so everything as good as the k-th best takes part in the sort.
                    bar = np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) > k else -np.inf
                    best = np.flatnonzero(scores >= bar)
                    best = best[np.argsort(-scores[best], kind="stable")][:k]
                    found.append(pd.DataFrame({"query_id": query, "id": ids[best], "score": scores[best]}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "id": [], "score": []}).astype({"query_id": "int64", "id": "int64"})

    met = left.groupBy("row", "column").cogroup(right.groupBy("row", "column")).applyInPandas(search, "query_id bigint, id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def distance_threshold(
    points: DataFrame, query: Sequence[float], threshold: float = 1.0, limit: int = 10, vector: str = "vector"
) -> DataFrame:
    """Nearest points closer than ``threshold`` (L2), with their cosine similarity."""
    stored, wanted = as_vector(vector), as_vector(query)
    near = points.withColumn("distance", l2_distance(stored, wanted)).filter(F.col("distance") < threshold)
    return near.withColumn("similarity", cosine_similarity(stored, wanted)).orderBy("distance", "id").limit(limit)


def recall(approximate: DataFrame, exact: DataFrame, on: Sequence[str] = ("id",)) -> DataFrame:
    """Share of the exact result that the approximate one found; for results of many queries ``on`` also names the query."""
    hits = exact.join(approximate.select(*on, F.lit(True).alias("_hit")), list(on), "left")
    asked = [F.count_distinct("query_id").alias("queries")] if "query_id" in on else []
    return hits.agg(
        F.count(F.lit(1)).alias("expected"), F.count_if("_hit").alias("found"),
        F.try_divide(F.count_if("_hit"), F.count(F.lit(1))).alias("recall"), *asked,
    )
