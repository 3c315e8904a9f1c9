"""The corpus pipeline, stage by stage, against brute force on the smallest tables."""

import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import pii
from tidemark.llm.reports import op1_quality_rules
from tidemark.session import settle

from .test_pii import brute as brute_private
from .test_simhash import brute_components, brute_print

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        out.append(settle(stage(spark, out[-1], SF), "stage"))
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns(stages):
    for after in stages[1:-1]:
        assert after.dtypes == stages[0].dtypes


def test_quality(spark, stages):
    kept = {r["doc_id"] for r in op1_quality_rules(spark, SF).where("kept").collect()}
    before, after = texts(stages[0]), texts(stages[1])
    assert after == {i: t for i, t in before.items() if i in kept} and 0 < len(after) < len(before)


def test_one_of_each_group(stages):
    before, after = texts(stages[1]), texts(stages[2])
    groups = brute_components([(i, brute_print(t)) for i, t in before.items()])
    assert after == {i: before[i] for i in {c for _, _, c in groups}}
    assert stages[2].count() == len(after)


def test_private_data(stages):
    before = texts(stages[2])
    rows = {r["doc_id"]: r for r in stages[3].collect()}
    assert set(rows) == set(before)
    for i, text in before.items():
        clean = rows[i]["text"]
        assert rows[i]["n_chars"] == len(clean)
        for start, kind, end in brute_private(text):
            assert text[start:end] not in clean or pii.KINDS[kind] == "phone"
        if "[" not in clean:
            assert clean == text


def test_mix(stages):
    before, after = texts(stages[3]), texts(stages[4])
    assert after == before and stages[4].count() >= len(before)


def test_tokens(spark, stages):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    before = texts(stages[4])
    rows = stages[5].collect()
    assert len(rows) == stages[4].count()
    for r in rows:
        ids = library.encode(before[r["doc_id"]] or "", add_special_tokens=False).ids
        assert list(r["ids"]) == ids and r["n_tokens"] == len(ids)
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert corpus_pipeline.run(spark, SF).count() == len(rows)


def test_empty_and_odd_tables(spark, tmp_path, stages):
    odd = [(1, None, None, None, None), (None, "a b", "en", "s", 3), (2, "", "en", "s", 0), (2, "", "en", "s", 0)]
    odd += [(i, " ".join(f"w{i * 1000 + k % 900}" for k in range(80)), None, None, 7) for i in range(3, 9)]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, stages[0].schema)
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = settle(stage(spark, docs, SF), f"odd-{k}")
        assert docs.count() >= (6 if rows else 0)
