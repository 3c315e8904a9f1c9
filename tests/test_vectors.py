import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import ann, vectors


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=8)], i % 3) for i in range(300)]
    return spark.createDataFrame(rows, "id BIGINT, vector ARRAY<FLOAT>, label INT")


def test_filter_conditions(points):
    def labels(spec):
        return {r.label for r in vectors.apply_filter(points, spec).select("label").distinct().collect()}

    assert labels(None) == {0, 1, 2} == labels({})
    assert labels({"must": [{"key": "label", "match": 1}]}) == {1}
    assert labels({"must_not": [{"key": "label", "match": 1}]}) == {0, 2}
    assert labels({"should": [{"key": "label", "match": 1}, {"key": "label", "range": {"gte": 2}}]}) == {1, 2}
    assert labels({"must": [{"key": "label", "range": {"gt": 0, "lt": 2, "gte": None}}], "must_not": [{"key": "label", "match": 2}]}) == {1}
    for broken in ({"must": [{"match": 1}]}, {"must": [{"key": "label"}]}):
        with pytest.raises(ValueError):
            vectors.metadata_filter(broken)


@pytest.mark.parametrize("query_block, point_block", [(7, 11), (4096, 32_768)])
def test_batch_search_equals_brute_force_in_blocks(spark, points, query_block, point_block):
    queries = points.filter("id < 20").select(F.col("id").alias("query_id"), "vector")
    found = vectors.cosine_topk_batch(points, queries, 5, query_block=query_block, point_block=point_block).collect()
    rows = points.collect()
    matrix = np.array([r.vector for r in rows])
    unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    for q in range(20):
        expected = np.argsort(-(unit @ unit[q]), kind="stable")[:5]
        assert [r.id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q] == list(expected)


def test_topk_bounds_and_single_query(points):
    query = points.filter("id = 4").first().vector
    assert vectors.cosine_topk(points, query, 1).first().id == 4
    for k in (0, 101):
        with pytest.raises(ValueError):
            vectors.cosine_topk(points, query, k)


def test_all_cells_give_the_exact_result(spark, points):
    query = points.filter("id = 9").first().vector
    index = ann.CellIndex.build(points, lists=4)
    exact = vectors.cosine_topk(points, query, 10)
    assert vectors.recall(index.search(spark, query, 10, probes=4, rerank=300), exact).first()["recall"] == 1.0


def test_cells_that_are_not_probed_are_not_read(spark, points):
    import re

    index = ann.CellIndex.build(points, lists=4)
    plan = index.search(spark, points.first().vector, 3, probes=1)._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[.*cell", plan)


def test_zero_vectors_have_one_score(spark):
    points = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, None)], "id BIGINT, vector ARRAY<DOUBLE>")
    assert {r.id: r.score for r in vectors.cosine_topk(points.filter("id < 3"), [1.0, 0.0], 5).collect()} == {1: 0.0, 2: 1.0}
    queries = spark.createDataFrame([(7, [1.0, 0.0]), (8, [0.0, 0.0])], "query_id BIGINT, vector ARRAY<DOUBLE>")
    found = {(r.query_id, r.id): r.score for r in vectors.cosine_topk_batch(points, queries, 5).collect()}
    assert found == {(7, 1): 0.0, (7, 2): 1.0, (8, 1): 0.0, (8, 2): 0.0}


def test_the_last_document_of_an_id_is_indexed(spark):
    docs = spark.createDataFrame([(1, "old words", 1), (1, "new words", 2), (2, "other", 1)], "id BIGINT, text STRING, at INT")
    docs = docs.withColumn("metadata", F.struct(F.lit("s").alias("source")))
    found = {r.id: r.payload.text for r in vectors.index_documents(None, docs, 16, order="at").collect()}
    assert found == {1: "new words", 2: "other"}


def test_embedding_equals_tf_idf_by_hand(spark):
    from pyspark.ml.feature import HashingTF

    texts = ["a b b c", "a c", "a b b c", "d", "A D"]
    frame = spark.createDataFrame(list(enumerate(texts)), "id BIGINT, text STRING")
    found = {r.id: r.vector for r in vectors.embed_texts(frame, dim=32).collect()}
    hasher = HashingTF(numFeatures=32)
    distinct = list(dict.fromkeys(texts))
    counts = {}
    for text in distinct:
        counts[text] = np.zeros(32)
        for word in text.lower().split():
            counts[text][hasher.indexOf(word)] += 1
    df = sum((c > 0).astype(float) for c in counts.values())
    idf = np.log((len(distinct) + 1) / (df + 1))
    for i, text in enumerate(texts):
        expected = counts[text] * idf
        length = np.linalg.norm(expected)
        assert np.allclose(found[i], expected / length if length else expected, atol=1e-6)
    assert found[0] == found[2] and math.isclose(sum(x * x for x in found[0]), 1.0, abs_tol=1e-5)


def test_reindexing_replaces_points(spark, make_records):
    rows = make_records((1, "a", "2024-03-01 10:00:00", '{"b": 1, "a": [2, "é"]}'), (2, "b", "2024-03-01 10:00:00.5", "{}"))
    wanted = spark.createDataFrame([(0, 2), (1, 7), (2, 2)], "position INT, id BIGINT")
    first, report = vectors.index_by_ids(rows, wanted, dim=16)
    assert tuple(report.first()) == (2, 1, 1)
    second, _ = vectors.index_by_ids(rows, spark.createDataFrame([(0, 1), (1, 2)], "position INT, id BIGINT"), first, dim=16)
    assert sorted(r.id for r in second.collect()) == [1, 2]
    texts = {r.id: r.text for r in vectors.build_search_document(rows).collect()}
    assert texts[1] == 'source: a\ntimestamp: 2024-03-01T10:00:00\ntags: a\ndata: {"a": [2, "\\u00e9"], "b": 1}'
    assert "timestamp: 2024-03-01T10:00:00.500000" in texts[2]


def test_a_model_can_take_the_place_of_tf_idf(spark):
    import pandas as pd
    from pyspark.sql.types import ArrayType, FloatType

    @F.pandas_udf(ArrayType(FloatType()))
    def lengths(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: [float(len(text)), 1.0])

    frame = spark.createDataFrame([(1, "ab"), (2, "abc"), (3, "ab"), (4, None)], "id BIGINT, text STRING")
    found = {r.id: r.vector for r in vectors.embed_texts(frame, encoder=lengths).collect()}
    assert found == {1: [2.0, 1.0], 2: [3.0, 1.0], 3: [2.0, 1.0], 4: None}


def test_batch_search_in_cells_equals_single_searches(spark, points):
    index = ann.CellIndex.build(points, lists=6)
    queries = points.filter("id < 12").select(F.col("id").alias("query_id"), "vector")
    found = index.search_batch(spark, queries, 5, 2).collect()
    for q in queries.collect()[:4]:
        single = [r.id for r in index.search(spark, q.vector, 5, 2).collect()]
        assert [r.id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q.query_id] == single
    exact = vectors.cosine_topk_batch(points, queries, 5)
    whole = vectors.recall(index.search_batch(spark, queries, 5, 6, rerank=300), exact, ("query_id", "id")).first().asDict()
    assert whole == {"expected": 60, "found": 60, "recall": 1.0, "queries": 12}


def test_index_recall_over_many_queries(spark):
    from tidemark.plans import vector_reports

    sf = "/root/testdata/sf0.001"
    queries = vector_reports.tables.points(spark, sf).filter("id % 100 = 0").count()
    found = vector_reports.cell_search_recall(spark, sf).first()
    assert queries > 1 and found["expected"] == 25 * queries and found["recall"] >= 0.9
    assert vector_reports.cell_recall_bound(spark, sf).first().asDict() == {"expected": 25, "enough": True}


def test_codes_are_searched_before_vectors(spark, points):
    """The pass over the cells reads ids and codes; vectors are read for the best by code."""
    import re

    index = ann.CellIndex.build(points, lists=4)
    plan = index.search(spark, points.first().vector, 3, probes=1)._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: struct<([^>]*(?:<[^>]*>)?[^>]*)>", plan)
    assert any("code" in s and "vector" not in s for s in schemas)
    assert index.candidates(spark, points.limit(3).select(F.col("id").alias("query_id"), "vector"), 7).groupBy("query_id").count().first()["count"] <= 7


def test_product_codes_equal_a_plain_search(spark):
    rng = np.random.default_rng(5)
    units = ann.unit_rows(rng.normal(size=(400, 8)))
    books = [ann.codebook(units[:, :4], 16), ann.codebook(units[:, 4:], 16)]
    codes = ann.encode(units, books)
    for row in range(0, 400, 37):
        for j, piece in enumerate((units[row, :4], units[row, 4:])):
            assert codes[row, j] == min(range(16), key=lambda e: (round(sum((books[j][e] - piece) ** 2), 12), e))
    near = np.concatenate([books[0][codes[:, 0]], books[1][codes[:, 1]]], axis=1)
    table = ann.query_tables(units[:1], books)[0]
    assert np.allclose(ann.code_scores(table, codes), near @ units[0])
    assert len(ann.codebook(np.ones((9, 4)), 16)) == 1


def test_every_vector_lies_in_its_two_nearest_cells(spark, points):
    index = ann.CellIndex.build(points, lists=5)
    rows = index.cells(spark).select("id", "cell", "home", "vector").collect()
    assert len(rows) == 600 == sum(index.sizes.values())
    near = {r.id: set(np.argsort(-(ann.unit_rows([r.vector]) @ index.centres.T)[0])[:2]) for r in rows}
    for i, cells in near.items():
        assert {r.cell for r in rows if r.id == i} == cells
    assert len({r.id for r in index.search(spark, rows[0].vector, 50, probes=5, rerank=300).collect()}) == 50


def test_index_is_found_again(spark, points, tmp_path):
    built = ann.CellIndex.build(points, path=str(tmp_path / "index"))
    found = ann.CellIndex.open(spark, built.path)
    query = points.filter("id = 7").first().vector
    spec = {"must": [{"key": "label", "match": 1}]}
    assert [r.id for r in found.search(spark, query, 9, spec=spec).collect()] == [r.id for r in built.search(spark, query, 9, spec=spec).collect()]
    assert {r.label for r in found.search(spark, query, 9, spec=spec).collect()} == {1} and found.probes == built.probes


def test_index_of_odd_points(spark):
    schema = "id BIGINT, vector ARRAY<FLOAT>, label INT"
    odd = spark.createDataFrame([(1, None, 0), (2, [0.0] * 8, 1), (3, [1.0] * 8, 1), (4, [1.0] * 8, 2)], schema)
    index = ann.CellIndex.build(odd)
    assert [r.id for r in index.search(spark, [1.0] * 8, 5).collect()] == [3, 4, 2]
    queries = spark.createDataFrame([(1, [1.0] * 8), (2, None)], "query_id BIGINT, vector ARRAY<FLOAT>")
    assert [(r.query_id, r.id) for r in index.search_batch(spark, queries, 5).orderBy("rank").collect()] == [(1, 3), (1, 4), (1, 2)]
    empty = ann.CellIndex.build(spark.createDataFrame([], schema))
    assert empty.search(spark, [1.0] * 8, 5).collect() == [] == empty.search_batch(spark, queries, 5).collect()
