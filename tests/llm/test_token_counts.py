"""Token counts against the tokenizers library, with chunks far smaller than the texts."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import token_counts
from tidemark.llm.token_counts import BETWEEN, INSIDE, Counter, count_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "  ", "\n", "   a", "a   ", "a \n b", "\x1c a\x1db", "don't I'LL we've 'tis ''s !!'stuv", "<|endoftext|>", "a <|endoftext|>  b<|endoftext|><|endoftext|> ",
    "  <|endoftext|>  ", "日本語" * 90, "x" * 700, "ab" * 333, "a" * 301 + " " + "b" * 97, " " * 400, " \n" * 150, "0123456789" * 40, "=" * 500, "'" * 100, "'re" * 120,
    "👩‍👩‍👧 🇩🇪" * 30, "́" * 200, "a\u0085b　c d", "the quick brown fox " * 40, "Donaudampfschiff" * 30, "<|endoftext" * 20, "﻿A\u0000B",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    with open(PATH, encoding="utf-8") as file:
        return Counter(file.read())


def random_texts(n, longest):
    rnd = random.Random(11)
    pools = ["abcdefghij", "the and of ", "äöüßéèñç", "0123456789", " \t\n", "#*$%&|<>.,!?'-", "日本語中文한국", "αβγΣσς", "'s't're'll", "ééé", "aaaa", "👩‍👧"]
    out = []
    for _ in range(n):
        text = ""
        while len(text) < rnd.randint(0, longest):
            pool = rnd.choice(pools)
            text += "".join(rnd.choice(pool) for _ in range(rnd.choice([1, 3, 9, 40])))
        out.append(text)
    return out


def size(library, text):
    return len(library.encode(text or "", add_special_tokens=False))


def test_whole_texts(library, counter):
    for text in ODD + random_texts(1500, 200):
        assert counter.count(text) == size(library, text), text


def test_every_kind_of_character(library, counter):
    """White space is what the library takes for it: a piece never cuts a run."""
    points = [*range(0, 0x3100), *range(0x3100, 0x110000, 211)]
    for cp in points:
        if not 0xD800 <= cp < 0xE000:
            text = f"a{chr(cp)}{chr(cp)} {chr(cp)}b  {chr(cp)}1"
            assert counter.count(text) == size(library, text), hex(cp)


def test_marks_are_proven(library, counter):
    """At every place between runs, and at every place inside one whose pair fits, the halves encode as the whole does."""
    for text in [t for t in random_texts(300, 120) if "<|" not in t]:
        total, at, index, kind, left, right = counter.boundaries(text)
        assert total == size(library, text)
        for p, k, how in zip(at, index, kind):
            if how == BETWEEN:
                assert size(library, text[:p]) == k and size(library, text[p:]) == total - k
    a = {"at": [5], "kind": [INSIDE], "dropped": [2], "ids": [counter.library.token_to_id("h")]}
    b = {"at": [5], "kind": [INSIDE], "dropped": [3], "ids": [counter.library.token_to_id("e")]}
    assert counter.splice(a, b) is None  # "he" would merge
    assert counter.splice(a, b | {"ids": [counter.library.token_to_id("#")]}) == 5
    assert counter.splice(a, b | {"at": [6]}) is None


@pytest.mark.parametrize("chunk,overlap", [(48, 12), (16, 3)])
def test_chunks_equal_the_library(spark, library, chunk, overlap):
    texts = ODD + random_texts(150, 600)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in count_tokens(docs, PATH, limit=40, chunk=chunk, overlap=overlap).collect()}
    for i, text in enumerate(texts):
        n = size(library, text)
        assert (found[i]["n_bytes"], found[i]["n_tokens"], found[i]["over_limit"]) == (len(text.encode()), n, n > 40), text


def test_widened_when_nothing_is_proven(spark, library, monkeypatch):
    """Runs of one letter have boundaries that depend on where a chunk starts."""
    rounds = []
    inner = token_counts._by_chunks
    monkeypatch.setattr(token_counts, "_by_chunks", lambda texts, sent, chunk, overlap: rounds.append((chunk, overlap)) or inner(texts, sent, chunk, overlap))
    texts = ["b" + "x" * 1000 + " tail of words", "words " * 100, "y" * 13 + "x" * 555]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r["doc_id"]: r["n_tokens"] for r in count_tokens(docs, PATH, chunk=61, overlap=7).collect()}
    assert found == {i: size(library, t) for i, t in enumerate(texts)}
    assert len(rounds) > 1 and rounds[1][1] == 4 * rounds[0][1]


def test_odd_rows(spark, library):
    long = "so it goes, " * 30
    rows = [(1, None), (1, ""), (2, long), (2, long), (None, long), (None, "no key"), (3, long * 50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' AS uid", "1 AS n_tokens", "text AS part", "2 AS seam")
    found = count_tokens(docs, PATH, chunk=64, overlap=8)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    expected = sorted((d is None, d, len((t or "").encode()), size(library, t)) for d, t in rows if d is not None)
    assert sorted((r[0] is None, r[0], r[1], r[2]) for r in found.collect() if r[0] is not None) == expected
    assert sorted(r[2] for r in found.collect() if r[0] is None) == sorted(size(library, t) for d, t in rows if d is None)
    assert count_tokens(docs.limit(0), PATH).count() == 0
