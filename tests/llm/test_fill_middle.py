"""Fill-in-the-middle against plain slices of strings, and back."""

import hashlib
import os
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import fill_middle as fim
from tidemark.llm.reports import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain(doc, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def random_rows(n):
    rnd = random.Random(4)
    letters = "ab \n<PSM>éß日本👩‍"
    rows = [(rnd.randint(-9, 10**12), "".join(rnd.choice(letters) for _ in range(rnd.choice([0, 1, 2, 3, 50])))) for _ in range(n)]
    return rows + [(7, "x<M>y"), (8, ""), (9, None), (None, "no id"), (None, None), (10, "日" * 999)]


@pytest.mark.parametrize("block", [1, 2, 7, 64, 1 << 20])
def test_scatter_and_gather(monkeypatch, block):
    monkeypatch.setattr(fim, "BLOCK", block)
    rows = random_rows(250)
    column = pa.array([t for _, t in rows], pa.string())
    for part, start in ((column, 0), (column.slice(100, 60), 100)):
        docs = [d for d, _ in rows[start:start + len(part)]]
        output, n, forms, prefix, middle = fim.rearrange(part, docs)
        for i, (doc, text) in enumerate(rows[start:start + len(part)]):
            expected = plain(doc, text)
            got = (int(n[i]), str(forms[i]), *((None, None) if forms[i] == "plain" else (int(prefix[i]), int(middle[i]))), output[i].as_py())
            assert got == expected
        back = fim.restored_texts(output, forms)
        assert back.to_pylist() == [t or "" for t in part.to_pylist()]
    assert len(fim.rearrange(pa.array([], pa.string()), [])[0]) == 0


def test_displacements_are_a_permutation():
    starts, shifts = np.array([0, 3, 3, 5]), np.array([4, 9, -3, -3])
    where = np.concatenate([to for _, _, to in fim._displaced(7, starts, shifts)])
    assert where.tolist() == [4, 5, 6, 0, 1, 2, 3]


def test_rows(spark):
    rows = random_rows(60) + [(11, "twice"), (11, "twice"), (12, "long " * 300_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' AS output", "1 AS form", "text AS restored", "2 AS _text")
    made = fim.fill_middle(docs)
    found = [tuple(r) for r in made.collect()]
    assert sorted(found, key=repr) == sorted([(d, *plain(d, t)) for d, t in rows], key=repr)
    back = fim.restore(made.selectExpr("*", "'kept' AS _text", "output AS restored"))
    assert sorted((str(r["doc_id"]), r["restored"], r["_text"]) for r in back.collect()) == sorted((str(d), t or "", "kept") for d, t in rows)
    assert fim.restore(fim.fill_middle(docs.limit(0))).count() == 0


def test_query(spark):
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    rows = QUERIES["op13_fill_middle"](spark, SF_DIR).select(*names).collect()
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
        expected = con.execute(f"SELECT {', '.join(names)} FROM ({ORACLES['op13_fill_middle']})").fetchall()
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, expected))
