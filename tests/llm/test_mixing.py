"""Temperature mixing against a plain recomputation."""

import math
from collections import Counter, defaultdict

import pytest

from tidemark.llm.mixing import mix_sources, token_count
from tidemark.llm.reports import op4_temperature_mix

SF = "/root/testdata/sf0.001"


def words(text):
    return len((text or "").encode().split()) + 1


def weights(shares, a):
    z = sum(s ** a for s in shares.values())
    return {k: s ** a / z for k, s in shares.items()}


def entropy(w):
    return -sum(x * math.log(x) for x in w.values()) / math.log(len(w))


def skewed(spark, n=6000):
    return spark.range(n).selectExpr(
        "id AS doc_id", "repeat('wo rd ', CAST(1 + id % 5 AS INT)) AS text",
        "CASE WHEN id % 10 < 6 THEN 'big' WHEN id % 10 < 9 THEN 'mid' ELSE 'small' END AS source", "'own' AS mix_pass", "1 AS block",
    )


@pytest.mark.parametrize("target, limit", [(0.9, 10.0), (0.99, 1.5), (0.5, 2.0)])
def test_weights_and_budget(spark, target, limit):
    docs = skewed(spark)
    totals = Counter()
    for r in docs.collect():
        totals[r["source"]] += words(r["text"])
    shares = {k: v / sum(totals.values()) for k, v in totals.items()}
    rows = mix_sources(docs, target, limit).collect()
    a = rows[0]["mix_exponent"]
    w = weights(shares, a)
    ratio = lambda a: max(shares.values()) ** (1 - a) / min(shares.values()) ** (1 - a)
    assert ratio(a) <= limit * 1.0001
    assert entropy(w) >= target - 1e-6 or ratio(a) == pytest.approx(limit, rel=1e-4)
    if a < 1:
        assert entropy(weights(shares, a + 1e-4)) < target or ratio(a) == pytest.approx(limit, rel=1e-4)
    dealt, seen = Counter(), defaultdict(set)
    for r in rows:
        dealt[r["source"]] += r["mix_tokens"]
        assert (r["doc_id"], r["mix_pass"]) not in seen[r["source"]]
        seen[r["source"]].add((r["doc_id"], r["mix_pass"]))
        assert r["mix_weight"] == pytest.approx(w[r["source"]])
    # Nothing is left out, the first source to be read whole is read once, and the parts are the weights.
    assert {d for s in seen.values() for d, _ in s} == set(range(6000))
    for source, tokens in dealt.items():
        assert tokens / sum(dealt.values()) == pytest.approx(w[source], rel=0.02)
    half = Counter()
    for r in rows:
        if r["mix_position"] < 0.5:
            half[r["source"]] += r["mix_tokens"]
    for source, tokens in half.items():
        assert tokens / sum(half.values()) == pytest.approx(w[source], rel=0.05)


def test_own_budget(spark):
    rows = mix_sources(skewed(spark), 0.9, 10.0, budget=5000).collect()
    assert sum(r["mix_tokens"] for r in rows) == pytest.approx(5000, rel=0.03)


def test_query_keeps_every_document(spark):
    rows = op4_temperature_mix(spark, SF).collect()
    assert {r["doc_id"] for r in rows} == {r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    plan = op4_temperature_mix(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_odd_rows(spark):
    rows = [(1, None, None), (1, None, None), (None, "a b", "x"), (3, "", "null"), (4, " \x0b a\tb\r\n", "x"), (5, "w " * 30_000, "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").selectExpr("*", "1 AS _source", "2 AS _block", "3 AS tokens", "4 AS mix_weight")
    out = mix_sources(docs)
    first = out.where("mix_pass = 0").collect()
    assert sorted((r["doc_id"] or 0, r["source"] or "") for r in first) == sorted((r[0] or 0, r[2] or "") for r in rows)
    assert sorted(r["mix_tokens"] for r in first) == [1, 1, 1, 3, 3, 30_001]
    assert out.columns[:6] == ["doc_id", "text", "source", "_source", "_block", "tokens"]
    assert mix_sources(docs.limit(0)).count() == 0


def test_token_count(spark):
    texts = ["", " ", "a", " a", "a ", "\x0ba\x0c\rb\x1cc d", None]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(token_count(__import__("pyspark").sql.functions.col("t"))).collect()
    assert [r[0] for r in found] == [words(t) for t in texts]


def test_a_small_last_block_stays_beside_a_huge_one(spark):
    rows = spark.range(41).selectExpr("id AS doc_id", "CASE WHEN id = 0 THEN repeat('w ', 3000000) END AS text", "'x' AS source")
    found = mix_sources(rows).where("mix_pass = 0").select("doc_id").collect()
    assert sorted(r[0] for r in found) == list(range(41))
    assert mix_sources(rows, budget=0).count() == 0 and mix_sources(rows.where("doc_id > 0"), budget=1).count() >= 1
