"""Search documents, embeddings and vector search."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ann, vectors
from ..operators.reads import active_only
from ..sources import tables
from ..sources.tables import table
from .registry import report, with_views
from .views import ACTIVE, IDS, POINTS, RECORDS, iso

ON_POINTS = with_views(POINTS)
QUERY = "(SELECT vector FROM points WHERE id = 0)"
SPEC = {
    "must": [{"key": "label", "range": {"gte": 2, "lt": 9}}],
    "must_not": [{"key": "label", "match": 4}],
    "should": [{"key": "label", "match": 3}, {"key": "label", "range": {"gt": 5}}],
}
PASSES = "label >= 2 AND label < 9 AND label <> 4 AND (label = 3 OR label > 5)"


def _query(spark, sf) -> list[float]:
    """The query vector: one stored vector, read by its id."""
    return tables.points(spark, sf).filter("id = 0").select("vector").first()["vector"]


def _rounded(df, *columns):
    for column in columns:
        df = df.withColumn(column, F.round(column, 6))
    return df


@report("filtered_points", f"{ON_POINTS} SELECT id, CAST(label AS BIGINT) AS label FROM points WHERE {PASSES}")
def filtered_points(spark, sf):
    return vectors.apply_filter(tables.points(spark, sf), SPEC).select("id", "label")


@report(
    "nearest_points",
    f"""{ON_POINTS} SELECT id, CAST(label AS BIGINT) AS label, round(list_cosine_similarity(vector, {QUERY}), 6) AS score FROM points
    ORDER BY list_cosine_similarity(vector, {QUERY}) DESC, id LIMIT 25""",
)
def nearest_points(spark, sf):
    return _rounded(vectors.cosine_topk(tables.points(spark, sf), _query(spark, sf), 25).drop("vector"), "score")


@report(
    "nearest_filtered_points",
    f"""{ON_POINTS} SELECT id, CAST(label AS BIGINT) AS label, round(list_cosine_similarity(vector, {QUERY}), 6) AS score FROM points
    WHERE {PASSES} ORDER BY list_cosine_similarity(vector, {QUERY}) DESC, id LIMIT 25""",
)
def nearest_filtered_points(spark, sf):
    return _rounded(vectors.cosine_topk(tables.points(spark, sf), _query(spark, sf), 25, SPEC).drop("vector"), "score")


def _label_means(spark, sf):
    """One query per label: the mean of its vectors."""
    axes = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("axis", "x"))
    means = axes.groupBy("label", "axis").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct("axis", "x")))
    return means.groupBy(F.col("label").alias("query_id")).agg(F.transform(ordered, lambda s: s["x"]).alias("vector"))


@report(
    "nearest_points_per_label",
    f"""{ON_POINTS}, means AS (
      SELECT query_id, list(x ORDER BY axis) AS vector FROM (
        SELECT label AS query_id, axis, avg(vector[axis]) AS x
        FROM points, LATERAL (SELECT unnest(generate_series(1, len(vector))) AS axis) GROUP BY 1, 2) GROUP BY 1)
    SELECT CAST(query_id AS BIGINT) AS query_id, id, round(score, 6) AS score, rank FROM (
      SELECT query_id, id, score, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank
      FROM (SELECT m.query_id, p.id, list_cosine_similarity(p.vector, m.vector) AS score FROM points p, means m)) WHERE rank <= 10""",
)
def nearest_points_per_label(spark, sf):
    return _rounded(vectors.cosine_topk_batch(tables.points(spark, sf), _label_means(spark, sf), 10), "score")


@report(
    "points_within_distance",
    f"""{ON_POINTS} SELECT id, round(list_distance(vector, {QUERY}), 6) AS distance, round(list_cosine_similarity(vector, {QUERY}), 6) AS similarity
    FROM points WHERE list_distance(vector, {QUERY}) < 1.35 ORDER BY list_distance(vector, {QUERY}), id LIMIT 10""",
)
def points_within_distance(spark, sf):
    near = vectors.distance_threshold(tables.points(spark, sf), _query(spark, sf), 1.35)
    return _rounded(near.select("id", "distance", "similarity"), "distance", "similarity")


def _index(spark, sf):
    return ann.CellIndex.build(tables.points(spark, sf))


def _asked(spark, sf):
    return tables.points(spark, sf).filter("id % 100 = 0").select(F.col("id").alias("query_id"), "vector")


@report("nearest_points_by_cell")
def nearest_points_by_cell(spark, sf):
    found = _index(spark, sf).search(spark, _query(spark, sf), 25)
    return _rounded(found.select("id", "label", "cell", "score"), "score")


@report("cell_search_recall")
def cell_search_recall(spark, sf):
    """Over all queries whose id is divisible by 100, against brute force."""
    queries = _asked(spark, sf)
    exact = vectors.cosine_topk_batch(tables.points(spark, sf), queries, 25)
    return vectors.recall(_index(spark, sf).search_batch(spark, queries, 25), exact, ("query_id", "id"))


@report(
    "nearest_points_all_cells",
    f"""{ON_POINTS} SELECT id, CAST(label AS BIGINT) AS label, round(list_cosine_similarity(vector, {QUERY}), 6) AS score
    FROM points ORDER BY list_cosine_similarity(vector, {QUERY}) DESC, id LIMIT 25""",
)
def nearest_points_all_cells(spark, sf):
    """With every cell read and every vector scored in full the stored index gives the exact result."""
    index = _index(spark, sf)
    found = index.search(spark, _query(spark, sf), 25, probes=len(index.centres), rerank=sum(index.sizes.values()))
    return _rounded(found.select("id", "label", "score"), "score")


@report("cell_recall_bound", "SELECT CAST(25 AS BIGINT) AS expected, true AS enough")
def cell_recall_bound(spark, sf):
    """At least nine tenths of the 25 nearest points are found, over all queries of ``cell_search_recall``."""
    return cell_search_recall(spark, sf).select(F.expr("expected div queries").alias("expected"), (F.col("recall") >= 0.9).alias("enough"))


@report(
    "cell_search_cost",
    f"""{ON_POINTS} SELECT count(*) FILTER (WHERE vector IS NOT NULL) AS points, true AS few FROM points""",
)
def cell_search_cost(spark, sf):
    """No query of ``cell_search_recall`` scores more than a quarter of the points in full."""
    index = _index(spark, sf)
    scored = index.candidates(spark, _asked(spark, sf), 100).groupBy("query_id").agg(F.count(F.lit(1)).alias("scored"))
    points = tables.points(spark, sf).filter("vector IS NOT NULL").agg(F.count(F.lit(1))).scalar()
    most = scored.agg(F.max("scored").alias("most")).withColumn("points", points)
    return most.select("points", (F.col("most") * 4 <= F.col("points")).alias("few"))


@report(
    "embedding_shape",
    """SELECT count(*) AS docs, count(DISTINCT text) AS texts, CAST(384 AS BIGINT) AS dim, true AS alike,
    count(*) FILTER (WHERE trim(text) = '') AS without_words FROM documents WHERE text IS NOT NULL""",
)
def embedding_shape(spark, sf):
    """Every text has 384 values of unit length, or none but zeros without words; copies have one vector."""
    from ..functions.vectors import norm

    docs = table(spark, sf, "documents").filter("text IS NOT NULL").select("doc_id", "text")
    length = norm(F.col("vector").cast("array<double>"))
    rows = vectors.embed_texts(docs).select(
        F.sha2("text", 256).alias("text_key"), F.size("vector").alias("dim"), F.xxhash64("vector").alias("mark"), length.alias("length")
    )
    per_text = rows.groupBy("text_key").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("mark").alias("marks"), F.min("dim").alias("low"), F.max("dim").alias("high"),
        F.max(F.abs(F.col("length") - 1)).alias("off"), F.max(F.when(F.col("length") == 0, F.col("length"))).alias("zero"),
    )
    fine = (F.col("marks") == 1) & (F.col("low") == F.col("high")) & ((F.col("off") < 1e-4) | F.col("zero").isNotNull())
    return per_text.agg(
        F.sum("n").alias("docs"), F.count(F.lit(1)).alias("texts"), F.max("high").alias("dim"), F.bool_and(fine).alias("alike"),
        F.coalesce(F.sum(F.when(F.col("zero").isNotNull(), F.col("n"))), F.lit(0)).alias("without_words"),
    )


SEARCH_TEXT = f"""'source: ' || source || chr(10) || 'timestamp: ' || {iso('"timestamp"')} || chr(10) ||
      'tags: ' || replace(tags, ',', ', ') || chr(10) || 'data: ' || CASE
        WHEN id % 7 = 0 THEN '{{"batch": ' || (id % 4) || ', "note": "no reading"}}' WHEN id % 97 = 0 THEN '{{"value": "n/a"}}'
        ELSE '{{"batch": ' || (id % 4) || ', "value": ' || CAST(value AS BIGINT) || '}}' END AS text"""


@report(
    "search_documents",
    f"{with_views(RECORDS, ACTIVE)} SELECT id, {SEARCH_TEXT}, source AS meta_source, processed AS meta_processed FROM active",
)
def search_documents(spark, sf):
    docs = vectors.build_search_document(active_only(tables.records(spark, sf)))
    return docs.select("id", "text", F.col("metadata.source").alias("meta_source"), F.col("metadata.processed").alias("meta_processed"))


@report("distinct_texts", "SELECT sha256(text) AS text_key, length(any_value(text)) AS chars FROM documents GROUP BY 1")
def distinct_texts(spark, sf):
    found = vectors.distinct_texts(table(spark, sf, "documents"))
    return found.select("text_key", F.length("text").cast("bigint").alias("chars"))


@report("embedded_documents")
def embedded_documents(spark, sf):
    embedded = vectors.embed_texts(table(spark, sf, "documents").select("doc_id", "text"))
    return embedded.select("doc_id", F.transform("vector", lambda x: F.round(x.cast("double"), 5)).alias("vector"))


@report(
    "indexed_records",
    f"{with_views(RECORDS, ACTIVE, IDS)} SELECT id, CAST(384 AS BIGINT) AS dim, {SEARCH_TEXT} FROM active WHERE id IN (SELECT id FROM requested)",
)
def indexed_records(spark, sf):
    points, _ = vectors.index_by_ids(tables.records(spark, sf), tables.requested_ids(spark, sf))
    return points.select("id", F.size("vector").alias("dim"), F.col("payload.text").alias("text"))


@report(
    "index_report",
    f"""{with_views(RECORDS, ACTIVE, IDS)} SELECT count(DISTINCT r.id) AS requested, count(DISTINCT a.id) AS indexed,
    count(DISTINCT CASE WHEN a.id IS NULL THEN r.id END) AS missing FROM requested r LEFT JOIN active a ON a.id = r.id""",
)
def index_report(spark, sf):
    _, counts = vectors.index_by_ids(tables.records(spark, sf), tables.requested_ids(spark, sf))
    return counts


@report(
    "indexed_recent_records",
    f"""{with_views(RECORDS, ACTIVE)} SELECT id, CAST(384 AS BIGINT) AS dim, source FROM active ORDER BY "timestamp" DESC, id DESC LIMIT 50""",
)
def indexed_recent_records(spark, sf):
    points = vectors.index_recent(tables.records(spark, sf), 50)
    return points.select("id", F.size("vector").alias("dim"), F.col("payload.source").alias("source"))
