"""Repeated strings: suffix arrays, anchors and the whole operator against brute force."""

import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import repeats, suffixes
from tidemark.llm.reports import op9_suffix_array

SF = "/root/testdata/sf0.001"
SPAN = suffixes.SPAN


def brute(rows):
    """``rows`` are (key, text); results in the same order."""
    keyed = [((1 << 63) - 1 if k is None else k, (t or "").encode()) for k, t in rows]
    least = {}
    for k, raw in keyed:
        for i in range(len(raw) - SPAN + 1):
            s = raw[i:i + SPAN]
            least[s] = min(k, least.get(s, k))
    out = []
    for (key, _), (k, raw) in zip(rows, keyed):
        gone = bytearray(len(raw))
        for i in range(len(raw) - SPAN + 1):
            if least[raw[i:i + SPAN]] < k:
                gone[i:i + SPAN] = b"\1" * SPAN
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        left = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((key, len(raw), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return out


def values(df):
    return sorted((tuple(r)[:5] for r in df.collect()), key=repr)


def random_bytes(rnd, n, letters):
    return bytes(rnd.choice(letters) for _ in range(n))


@pytest.mark.parametrize("letters", [b"ab", b"a", b"abcdefg", bytes(range(256)), b"\x00a", b"\x00\xff"])
def test_suffix_array(letters):
    rnd = random.Random(1)
    for n in [0, 1, 2, 3, 10, 50, 200]:
        for _ in range(8):
            raw = random_bytes(rnd, n, letters)
            order = suffixes.suffix_array(np.frombuffer(raw, np.uint8)).tolist()
            assert sorted(order) == list(range(n))
            heads = [raw[i:i + SPAN] for i in order]
            if 0 not in letters:
                assert heads == sorted(heads)
            # With zero bytes at the end order is free; equal strings still stand together.
            whole = [h for h in heads if len(h) == SPAN]
            assert len([1 for a, b in zip(whole, whole[1:]) if a != b]) + bool(whole) == len(set(whole))


def test_common_prefixes():
    text = np.frombuffer(b"abcabdabcabd", np.uint8)
    order = suffixes.suffix_array(text)
    raw = text.tobytes()
    for (a, b), found in zip(zip(order, order[1:]), suffixes.common_prefixes(text, order)[1:]):
        same = next((i for i, (x, y) in enumerate(zip(raw[a:], raw[b:])) if x != y), min(len(raw) - a, len(raw) - b))
        assert found == min(same, SPAN)


def test_every_string_has_one_anchor_stretch():
    rnd = random.Random(2)
    texts = [random_bytes(rnd, n, b"ab ") for n in (0, 10, 49, 50, 51, 400, 0, 90)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0] + [len(t) for t in texts])
    seen = {}
    for text, first, last, h, f in repeats.anchors(data, offsets):
        for t, a, b, x, y in zip(text.tolist(), first.tolist(), last.tolist(), h.tolist(), f.tolist()):
            for start in range(a, b + 1):
                seen.setdefault((t, start), set()).add(x)
    assert set(seen) == {(t, i) for t, raw in enumerate(texts) for i in range(len(raw) - SPAN + 1)}
    by_string = {}
    for (t, i), hashes in seen.items():
        assert by_string.setdefault(texts[t][i:i + SPAN], hashes) == hashes


def planted(rnd, n):
    words = [f"w{i}" for i in range(3000)]
    prose = lambda k: " ".join(rnd.choice(words) for _ in range(k))
    passage, longer, rows = prose(30), prose(300), []
    for i in range(n):
        text = prose(rnd.randint(1, 150))
        if i % 3 == 0:
            text = text[:rnd.randint(0, 60)] + passage + text[60:]
        if i % 7 == 0:
            a = rnd.randint(0, 1000)
            text += longer[a:a + rnd.randint(40, 400)]
        if i % 10 == 0 and rows:
            text = rows[rnd.randrange(len(rows))][1]
        if i % 11 == 0 and rows:
            text = rows[rnd.randrange(len(rows))][1]
            at = rnd.randint(0, len(text))
            text = text[:at] + "é" + text[at + 2:]
        rows.append((i, text))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("together, block", [(512, 1 << 19), (4, 200), (0, 1000)])
def test_planted(spark, monkeypatch, together, block):
    monkeypatch.setattr(repeats, "TOGETHER", together)
    monkeypatch.setattr(repeats, "BLOCK", block)
    monkeypatch.setattr(repeats, "FLUSH", 5000)
    rows = planted(random.Random(together), 250)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert values(repeats.repeated_strings(docs)) == sorted(brute(rows), key=repr)


def test_odd_rows(spark):
    same = "the same words stand here in more than fifty bytes of text, again and again"
    rows = [(5, same), (5, same), (5, same + "x"), (None, same), (None, same), (9, None), (8, ""), (7, "short"), (6, "a" * 300), (10, "a" * 120),
            (11, "ab" * 100), (12, "b" + "ab" * 40), (13, "é" * 60), (14, "\x00" * 130), (15, "\x00" * 60), (3, "y" + same), (20, "z" * 49), (21, "z" * 49)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'q' AS raw", "1 AS uid", "2 AS doc", "3 AS n_bytes")
    assert values(repeats.repeated_strings(docs)) == sorted(brute(rows), key=repr)
    assert repeats.repeated_strings(docs.limit(0)).count() == 0
    left = {r["doc_id"]: r["kept"] for r in repeats.repeated_strings(docs, kept=True).collect()}
    assert left[5] is not None or left[3] is None


def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert values(op9_suffix_array(spark, SF)) == sorted(brute(rows), key=repr)


def test_query_equals_the_sql(spark):
    import duckdb

    from tidemark.llm.reports import ORACLES

    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert values(op9_suffix_array(spark, SF)) == sorted(duck.execute(ORACLES["op9_suffix_array"]).fetchall(), key=repr)
