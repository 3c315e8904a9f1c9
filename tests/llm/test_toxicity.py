"""The convolutional classifier: gradients, pooling, held-out accuracy, odd rows."""

import random
import zlib

import numpy as np
import pytest

from tidemark.llm import toxicity
from tidemark.llm.reports import op8_toxicity

SF = "/root/testdata/sf0.01"


def prose(rnd, n, bad):
    words = [f"w{int(rnd.paretovariate(0.7))}" for _ in range(n)]
    if bad:
        for _ in range(rnd.randint(2, 4)):
            words.insert(rnd.randrange(n), rnd.choice(["vile", "scum", "moron"]))
    return " ".join(words)


@pytest.fixture(scope="module")
def model():
    rnd = random.Random(1)
    texts = [toxicity.words_of(prose(rnd, rnd.randint(20, 300), i % 4 == 0)) for i in range(1200)]
    toxic = np.array([int(i % 4 == 0) for i in range(1200)])
    return toxicity.train(texts, toxic, np.ones(1200))


def test_learns(model):
    rnd = random.Random(2)
    sums = model.sums()
    rows = toxicity.Rows(model.known)
    rate = lambda text: toxicity.score(model, sums, toxicity.word_rows(toxicity.words_of(text), rows))
    got = [(i % 4 == 0, rate(prose(rnd, 150, i % 4 == 0))) for i in range(800)]
    assert np.mean([(s >= 0.3) == t for t, s in got]) > 0.97
    assert 0 <= rate("") < 0.3 and rate("") == rate(None)


def test_pooling_equals_a_plain_loop(model, monkeypatch):
    rnd = random.Random(3)
    for n in (0, 1, 2, 3, 50):
        places = toxicity.word_rows(toxicity.words_of(prose(rnd, n, False) if n else ""), toxicity.Rows(model.known))
        expected = []
        for size, f, b in zip(toxicity.SIZES, model.filters, model.biases):
            windows = [sum(model.table[places[i + o]] @ f[o] for o in range(size)) for i in range(len(places) - size + 1)]
            expected += np.maximum(np.max(windows, axis=0) + b, 0).tolist()
        for chunk in (7, 1 << 15):
            monkeypatch.setattr(toxicity, "CHUNK", chunk)
            assert np.allclose(toxicity.pooled(model, model.sums(), places), expected, atol=1e-5)


def test_query(spark):
    docs = {r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = op8_toxicity(spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    held = [r for r in rows if r["held_out"] and toxic.get(r["doc_id"]) is not None]
    assert np.mean([r["predicted"] == toxic[r["doc_id"]] for r in held]) >= 0.9


def test_thresholds():
    assert toxicity.best_threshold([10, 60, 90], [50, 2, 0], [0, 1, 9]) == 0.9
    assert toxicity.best_threshold([10, 40, 90], [50, 0, 0], [0, 5, 9]) == 0.4
    assert toxicity.best_threshold([10], [5], [0]) == 1.0


def test_odd_rows(spark):
    rnd = random.Random(5)
    rows = [(i, prose(rnd, 60, i % 3 == 0), ["en", None][i % 2]) for i in range(300)]
    rows += [(400, None, "en"), (401, "", None), (402, "?! ", "en"), (403, "scum " * 40_000, "xx"), (0, "again", "en"), (None, "vile scum", "en")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").selectExpr("*", "1 AS score", "'a' AS id", "2 AS toxic", "3 AS language")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)] + [(None, 1), (5, None), (3, 1)], "doc_id bigint, toxic int")
    found = toxicity.rate(docs, labels, sample=200).collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 for r in found)
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[403]["predicted"] == 1 and by_id[400]["score"] == by_id[401]["score"] and not by_id[None]["held_out"]
    assert toxicity.rate(docs.limit(0), labels).count() == 0
    assert {r["score"] for r in toxicity.rate(docs, labels.limit(0)).collect()} == {0.5}


def test_unknown_words_go_by_their_stem():
    texts = [[b"vejus", b"other"], [b"vejute", b"other"], [b"vejuer"], [b"vejua"], [b"vejuo", "été".encode()]] * 2
    known = toxicity.vocabulary(texts)
    rows = toxicity.Rows(known)
    assert rows[b"vejuxx"] == known[toxicity.stem_hash(b"vejus")] > 0 and rows[b"nothing"] == 0
    assert toxicity.stem_hash("étéré".encode()) == toxicity.stem_hash("étér".encode()) != toxicity.stem_hash("été".encode())


def test_long_texts_are_learnt_whole(spark):
    rnd = random.Random(7)
    ends = lambda bad: " ".join(f"w{rnd.randrange(50)}" for _ in range(9_000)) + (" vile scum" if bad else " kind words")
    docs = spark.createDataFrame([(i, ends(i % 3 == 0), "en") for i in range(60)], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id bigint, toxic int")
    assert docs.selectExpr("min(length(text))").first()[0] > 24_000
    seen = {}
    model = toxicity.fit(docs, labels)
    rows = toxicity.Rows(model.known)
    assert rows[b"vile"] and rows[b"kind"] and rows[b"vile"] != rows[b"kind"]
    for r in toxicity.rate(docs, labels).collect():
        seen.setdefault(r["doc_id"] % 3 == 0, []).append(r["score"])
    assert min(seen[True]) > max(seen[False])


def test_rows_that_do_not_fit_give_way():
    assert toxicity.picked([5, 90, 5, 5, 5], 3, 20) == [0, 2, 3] and toxicity.picked([90, 80], 3, 20) == [1] and toxicity.picked([], 3, 20) == []
    lengths = np.array([3, 3, 50, 1, 1, 1])
    assert [b.tolist() for b in toxicity.batches(np.arange(6), lengths, 2, 10)] == [[0, 1], [2], [3, 4], [5]]


def test_executors_need_no_copy_of_the_package(tmp_path):
    """The query in a session whose workers cannot import the package."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = f"""
import sys
sys.path.insert(0, {root!r})
from tidemark.session import build_session
from tidemark.llm import toxicity
spark = build_session("bare", "local[2]", **{{"spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false"}})
docs = spark.range(80).selectExpr("id AS doc_id", "IF(id % 2 = 0, 'a vile slur', 'a kind word') AS text", "'en' AS lang")
rated = toxicity.rate(docs, docs.selectExpr("doc_id", "CAST(doc_id % 2 = 0 AS INT) AS toxic"))
assert spark.range(1).mapInPandas(lambda b: (x.assign(id=0 if __import__("importlib.util").util.find_spec("tidemark") is None else 1) for x in b), "id bigint").first()[0] == 0
print("rows", rated.count(), rated.where("predicted = 1").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYSPARK_PYTHON": sys.executable}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 80 40" in done.stdout, done.stderr[-2000:]
