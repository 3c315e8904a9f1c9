"""BPE against the tokenizers library and a plain greedy merge."""

import hashlib
import random
import time

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm.bpe import FOREST_ROWS, NONE, Rendered, SegmentTree, WordBpe, decode_ids, encode_texts

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "\x1c a\x1db", "Don't I'LL we've", "ΣΑΣ ὈΔΥΣΣΕΎΣ", "İstanbul ǅ", "<|endoftext|>a<|startoftext|> <|endoftext", "é Å",
    "日本語 テスト", "١٢٣ ½ Ⅷ", "a​b c　d\u0085e", "👩‍👩‍👧 🇩🇪", "x" * 3000, "ab" * 1500, "...!!??---", "﻿A\u0000B", "ﬁ ŉ ſ",
    " x y", "'s 'S ''t 're's",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    with open(PATH, encoding="utf-8") as file:
        return WordBpe(file.read())


def random_texts(n):
    rnd = random.Random(3)
    pools = ["abcdefghij", "the and of ", "äöüßéèñçÉÑ", "0123456789", " \t\n", "#*$%&|<>.,!?'-", "日本語中文한국", "αβγΣσςΩ", "́̈‍", "ǅŉİı"]
    return ["".join(rnd.choice(rnd.choice(pools)) for _ in range(rnd.randint(0, 120))) for _ in range(n)]


def test_equal_to_the_library(library, own):
    for text in ODD + random_texts(3000):
        expected = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == expected, text
        assert own.decode(expected) == library.decode(expected, skip_special_tokens=False)


def test_merges_equal_a_plain_loop(own):
    rnd = random.Random(5)
    for _ in range(200):
        word = "".join(rnd.choice("therandouing") for _ in range(rnd.randint(1, 40)))
        symbols = [own.first[b] for b in word.encode()[:-1]] + [own.last[word.encode()[-1]]]
        while True:
            ranked = [(own.merges[p][0], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in own.merges]
            if not ranked:
                break
            i = min(ranked)[1]
            symbols[i:i + 2] = [own.merges[symbols[i], symbols[i + 1]][1]]
        assert own.encode_word(word) == symbols


def made_words(n, seed=9):
    rnd = random.Random(seed)
    parts = ["the", "er", "tion", "ou", "in", "q", "zx", "anly", "sh", "éè", "日本"]
    return list({"".join(rnd.choice(parts) for _ in range(rnd.randint(1, 6))) for _ in range(n)})


def test_words_merged_together_equal_the_library(library, own):
    words = {w for t in ODD + random_texts(500) for w in own.pieces(t) if isinstance(w, str)}
    # Lengths beside those at which a word takes larger trees, or one of its own; more words than one forest takes.
    words |= {("thering" * 20)[:n] for n in range(1, 130)} | {"é" * n for n in range(1, 70)}
    words |= set(made_words(2 * FOREST_ROWS))
    found = list(own.encode_words(list(words)))
    assert len(found) == len(words) == len(dict(found))
    for word, ids in found:
        assert ids == own.encode_word(word), word
    by_word = dict(found)
    for word in made_words(500):
        assert by_word.get(word, own.encode_word(word)) == library.encode(word, add_special_tokens=False).ids
    assert list(own.encode_words([])) == []


def test_more_words_than_memory_holds(own):
    known = Rendered(own)
    known.size = 20
    for seed in (1, 2, 1):
        words = made_words(300, seed) + ["x" * 100, own.special["<|endoftext|>"]]
        table = known.table([words, words[:5], []])
        assert table.keys() == set(words)
        assert all(table[w] == known.make(w) for w in words)
        assert len(known) <= 20 and len(known.older) <= 20


def test_new_words_together_take_less_time(own):
    words = made_words(20_000)
    start = time.process_time()
    for word in words:
        own.encode_word(word)
    alone = time.process_time() - start
    start = time.process_time()
    assert sum(1 for _ in own.encode_words(words)) == len(words)
    assert time.process_time() - start < alone * 0.6


def test_segment_tree():
    rnd = random.Random(1)
    for n in (1, 2, 3, 7, 64, 65):
        leaves = [rnd.randint(0, 99) for _ in range(n)]
        tree = SegmentTree(list(leaves))
        for _ in range(200):
            i = rnd.randrange(n)
            leaves[i] = rnd.choice([NONE, rnd.randint(0, 99)])
            tree.put(i, leaves[i])
            assert tree.root() == min(leaves)


def test_rows(spark, library):
    rows = [(i, t) for i, t in enumerate(ODD + random_texts(50))] + [(900, None), (901, "again and"), (901, "again and"), (None, "no key")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' AS ids", "1 AS n_tokens", "text AS decoded")
    found = encode_texts(docs, PATH).collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        r = by_id[doc]
        assert (r["ids"], r["n_tokens"]) == (ids, len(ids))
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    back = decode_ids(encode_texts(docs, PATH), PATH).where("doc_id = 901").first()["decoded"]
    assert back == "again</w> and</w>"
    assert encode_texts(docs.limit(0), PATH).count() == 0
