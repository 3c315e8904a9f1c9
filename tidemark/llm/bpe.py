"""Byte-pair encoding with a given vocabulary file, and decoding.

Merges of one word are chosen by a segment tree over the ranks of adjacent pairs. Its root holds the lowest rank and,
among equal ranks, the leftmost place; a merge changes three leaves, each in logarithmic time, and encoding ends when the
root holds no mergeable pair. A word of n symbols so takes O(n log n) steps, however long it is.

New words of some texts are merged together: a forest keeps the trees of words of like length as rows of one array, and each
step makes the next merge of every word that has one. Longer words have a tree of their own.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import ROWS_AT_ONCE, kept_in_worker, no_cycles

NONE = 1 << 62
PLACE, SHORT = 1 << 32, 1 << 12
CACHED_CHARS = 64
#: Entries of the younger half of a cache; see ``Recent``.
CACHED_WORDS = 120_000
#: Leaves of a forest's trees: a word takes the smallest that holds it and a place on either side.
FOREST_LEAVES = (16, 64)
#: Words of a forest, so that its arrays take a few MB whatever the number of new words.
FOREST_ROWS = 1 << 12
#: Code points of the texts whose new words are merged together, unless one text has more.
CHARS_AT_ONCE = 1 << 20
#: White space as Unicode defines it; str.split() also cuts at \\x1c-\\x1f.
WHITE = "\t-\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, the others from code point 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    shifted = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(shifted)) for b in range(256)]


class SegmentTree:
    """Minimum over leaves, with point updates."""

    def __init__(self, leaves: list[int]):
        self.half = half = 1 << max(0, (len(leaves) - 1).bit_length())
        self.nodes = nodes = [NONE] * half + leaves + [NONE] * (half - len(leaves))
        for i in range(half - 1, 0, -1):
            a, b = nodes[2 * i], nodes[2 * i + 1]
            nodes[i] = a if a < b else b

    def root(self) -> int:
        return self.nodes[1]

    def put(self, leaf: int, value: int) -> None:
        nodes, i = self.nodes, leaf + self.half
        nodes[i] = value
        while i > 1:
            other = nodes[i ^ 1]
            if other < value:
                value = other
            i >>= 1
            if nodes[i] == value:
                break
            nodes[i] = value


class Forest:
    """Segment trees of many words, one row for each: the tree's nodes, symbols, and links to the places on either side.

    Places 0 and n + 1 of a word of n symbols hold ``pad``, which no merge knows.
    """

    def __init__(self, symbols: np.ndarray, pad: int, ranks, products: np.ndarray):
        self.pad, self.ranks, self.products = pad, ranks, products
        self.rows, self.half = rows, half = symbols.shape
        self.symbols = symbols.ravel()
        self.after = np.tile(np.arange(1, half + 1), rows)
        self.before = np.tile(np.arange(-1, half - 1), rows)
        self.nodes = np.full((rows, 2 * half), NONE)
        self.nodes[:, half:2 * half - 1] = self.leaves(symbols[:, :-1], symbols[:, 1:], np.arange(half - 1))
        width = half
        while width > 1:
            np.minimum(self.nodes[:, width:2 * width:2], self.nodes[:, width + 1:2 * width:2], out=self.nodes[:, width // 2:width])
            width //= 2
        self.nodes = self.nodes.ravel()

    def leaves(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Rank and place in one number; ``NONE`` for a pair without a merge."""
        ranks = self.ranks(left, right)
        return np.where(ranks < 0, NONE, ranks * self.half + place)

    def put(self, trees: np.ndarray, places: np.ndarray, values: np.ndarray) -> None:
        """Sets leaves of the trees that start at the given nodes, and all nodes above them, level by level."""
        nodes, at = self.nodes, places + self.half
        nodes[trees + at] = values
        for _ in range(self.half.bit_length() - 1):
            at >>= 1
            child = trees + 2 * at
            nodes[trees + at] = np.minimum(nodes[child], nodes[child + 1])

    def merge(self) -> np.ndarray:
        """The symbols left of every row, with ``pad`` at all other places."""
        symbols, after, before, half = self.symbols, self.after, self.before, self.half
        rows = np.arange(self.rows)
        while True:
            best = self.nodes[2 * half * rows + 1]
            open_ = best != NONE
            rows, best = rows[open_], best[open_]
            if not len(rows):
                return symbols.reshape(self.rows, half)
            start, trees = half * rows, 2 * half * rows
            i, merged = best % half, self.products[best // half]
            j = after[start + i]
            k, h = after[start + j], before[start + i]
            symbols[start + i], symbols[start + j] = merged, self.pad
            after[start + i], before[start + k] = k, i
            values = np.concatenate([
                np.full(len(rows), NONE), self.leaves(merged, symbols[start + k], i), self.leaves(symbols[start + h], merged, h)
            ])
            self.put(np.tile(trees, 3), np.concatenate([j, i, h]), values)


class Recent(dict):
    """A bounded memory: when it is full it becomes the older half, and what is asked for again moves up."""

    def __init__(self, size: int = CACHED_WORDS):
        self.size, self.older = size, {}

    def __missing__(self, key):
        found = self.older.pop(key, None)
        if found is None:
            found = self.make(key)
        self.keep(key, found)
        return found

    def keep(self, key, found) -> None:
        if isinstance(key, str) and len(key) > CACHED_CHARS:
            return
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = found


class Words(Recent):
    """Word -> ids."""

    def __init__(self, bpe: WordBpe):
        super().__init__()
        self.make = bpe.encode_word


class WordBpe:
    """A lower-casing word tokenizer read from its vocabulary file's text."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"]
        self.names = {i: s for s, i in self.ids.items()}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            # A pair listed twice has the rank of its last place.
            self.merges[self.ids[a], self.ids[b]] = (rank, self.ids[a + b])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names.update({i: s for s, i in self.special.items()})
        self.cut_special = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")")
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace("\\s", WHITE)
        self.all_words = regex.compile(pattern).findall
        # The same for texts of ASCII alone, where the standard module is faster.
        ascii_pattern = pattern.replace("\\p{L}", "A-Za-z").replace("\\p{N}", "0-9").replace(WHITE, "\\t-\\r ")
        self.ascii_words = re.compile(ascii_pattern, re.ASCII).findall
        letters = byte_letters()
        self.first = [self.ids[x] for x in letters]
        self.last = [self.ids[x + self.end] for x in letters]
        self.pad = max(self.names) + 1
        pairs = sorted((a * (self.pad + 1) + b, rank, merged) for (a, b), (rank, merged) in self.merges.items())
        # The last key is above all others, so that a search always ends at one.
        self.pair_keys = np.array([p[0] for p in pairs] + [NONE], np.int64)
        self.pair_ranks = np.array([p[1] for p in pairs] + [-1], np.int64)
        self.products = np.zeros(len(model["merges"]), np.int64)
        self.products[self.pair_ranks[:-1]] = [p[2] for p in pairs]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of symbols, -1 for a pair that is not merged."""
        keys = left * (self.pad + 1) + right
        at = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], -1)

    def encode_words(self, words: list[str]) -> Iterator[tuple[str, list[int]]]:
        """Each word once with its ids, in no order; short words together."""
        raw = [w.encode("utf-8", "replace") for w in words]
        sizes = np.array([len(r) for r in raw], np.int64)
        first, last = np.array(self.first, np.int64), np.array(self.last, np.int64)
        low = 0
        groups = []
        for half in FOREST_LEAVES:
            fit = np.flatnonzero((sizes > low) & (sizes <= half - 2))
            groups += [(half, fit[i:i + FOREST_ROWS]) for i in range(0, len(fit), FOREST_ROWS)]
            low = half - 2
        for half, chosen in groups:
            size = sizes[chosen, None]
            place = np.arange(half)
            symbols = np.full((len(chosen), half), self.pad, np.int64)
            symbols[(place > 0) & (place <= size)] = first[np.frombuffer(b"".join([raw[i] for i in chosen]), np.uint8)]
            symbols[np.arange(len(chosen)), size[:, 0]] = last[[raw[i][-1] for i in chosen]]
            merged = Forest(symbols, self.pad, self.ranks, self.products).merge()
            left = merged != self.pad
            ids, ends = merged[left].tolist(), np.cumsum(left.sum(axis=1)).tolist()
            start = 0
            for i, end in zip(chosen.tolist(), ends):
                yield words[i], ids[start:end]
                start = end
        for i in np.flatnonzero(sizes > low).tolist():
            yield words[i], self.encode_word(words[i])

    def encode_word(self, word: str) -> list[int]:
        raw = word.encode("utf-8", "replace")
        symbols = [self.first[b] for b in raw[:-1]] + [self.last[raw[-1]]]
        n, merges = len(symbols), self.merges
        if n == 1:
            return symbols
        # A leaf holds rank and place in one number; short words keep it small.
        place = SHORT if n <= SHORT else PLACE
        leaves = []
        for i in range(n - 1):
            found = merges.get((symbols[i], symbols[i + 1]))
            leaves.append(NONE if found is None else found[0] * place + i)
        tree = SegmentTree(leaves)
        put, nodes = tree.put, tree.nodes
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (best := nodes[1]) != NONE:
            i = best % place
            j = after[i]
            merged = symbols[i] = merges[symbols[i], symbols[j]][1]
            symbols[j] = -1
            after[i] = k = after[j]
            if j < n - 1:
                put(j, NONE)
            found = None
            if k < n:
                before[k] = i
                found = merges.get((merged, symbols[k]))
            put(i, NONE if found is None else found[0] * place + i)
            if (h := before[i]) >= 0:
                found = merges.get((symbols[h], merged))
                put(h, NONE if found is None else found[0] * place + h)
        return [s for s in symbols if s >= 0]

    def words_of(self, text: str) -> list[str]:
        """Folded words of a text without special tokens. Lower-casing goes by character, so sigma has one small form."""
        if text.isascii():
            return self.ascii_words(text.lower())
        return self.all_words(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def pieces(self, text: str) -> list[str | int]:
        """The text's words, and ids in place of special tokens."""
        if "<|" not in text:
            return self.words_of(text)
        out: list[str | int] = []
        for part in self.cut_special.split(text):
            if part in self.special:
                out.append(self.special[part])
            else:
                out += self.words_of(part)
        return out

    def encode(self, text: str | None, words: Words | None = None) -> list[int]:
        words = Words(self) if words is None else words
        out: list[int] = []
        for piece in self.pieces(text or ""):
            if isinstance(piece, int):
                out.append(piece)
            else:
                out += words[piece]
        return out

    def decode(self, ids: list[int]) -> str:
        """The tokens joined by one space, as this vocabulary has no decoder of its own; unknown ids give nothing."""
        return " ".join(self.names[i] for i in ids if i in self.names)


class Rendered(Recent):
    """Word, or id of a special token -> (ids as text, tokens as text, ids as bytes)."""

    def __init__(self, bpe: WordBpe):
        super().__init__()
        self.bpe = bpe
        self.digits = {i: str(i) for i in bpe.names}

    def entry(self, ids: list[int]) -> tuple[str, str, bytes]:
        digits, names = self.digits, self.bpe.names
        return " ".join([digits[i] for i in ids]), " ".join([names[i] for i in ids]), array("i", ids).tobytes()

    def make(self, piece: str | int) -> tuple[str, str, bytes]:
        return self.entry([piece] if isinstance(piece, int) else self.bpe.encode_word(piece))

    def table(self, texts: list[list[str | int]]) -> dict[str | int, tuple[str, str, bytes]]:
        """The entries of all pieces of some texts; words that are not in memory are merged together."""
        out, new, get = {}, [], self.get
        for piece in set().union(*texts):
            found = get(piece)
            if found is not None:
                out[piece] = found
            elif isinstance(piece, int) or piece in self.older:
                out[piece] = self[piece]
            else:
                new.append(piece)
        for word, ids in self.bpe.encode_words(new):
            out[word] = self.entry(ids)
            self.keep(word, out[word])
        return out


def _rendered(file_text: str) -> Rendered:
    kept = kept_in_worker("bpe")
    mark = hashlib.sha1(file_text.encode()).digest()
    if mark not in kept:
        kept.clear()
        kept[mark] = Rendered(WordBpe(file_text))
    return kept[mark]


def read_vocabulary(spark: SparkSession, path: str) -> str:
    """The vocabulary file's text; its size is that of a tokenizer file, a few MB."""
    if "://" in path:
        return spark.read.text(path, wholetext=True).first()[0]
    with open(path, encoding="utf-8") as file:
        return file.read()


def _some_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int | None], list[str]]]:
    """Keys and texts of a few rows at a time; null text as empty."""
    for batch, start in ((b, i) for b in batches for i in range(0, b.num_rows, ROWS_AT_ONCE)):
        part = batch.slice(start, ROWS_AT_ONCE)
        keys, texts, size = [], [], 0
        for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            keys.append(key)
            texts.append(text or "")
            size += len(texts[-1])
            if size >= CHARS_AT_ONCE:
                yield keys, texts
                keys, texts, size = [], [], 0
        if keys:
            yield keys, texts


def encode_texts(docs: DataFrame, vocabulary: str, *, key: str = "doc_id", text: str = "text", ids: bool = True) -> DataFrame:
    """``doc_id``, ``ids`` (array of ints), ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` of every row.

    ``vocabulary`` is the path of a tokenizer file; its text is broadcast, so executors need not have the file. The
    hashes are of the ids joined by one space and of the decoded text. ``ids=False`` leaves the array out.

    Null text counts as empty: no tokens, hashes of the empty string. Any length of text or word is encoded whole. Every
    row gives a row, repeated ones too. Other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(read_vocabulary(docs.sparkSession, vocabulary))
    schema = "doc_id bigint, " + "ids array<int>, " * ids + "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    fields = [("doc_id", pa.int64()), *[("ids", pa.list_(pa.int32()))] * ids, ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    shape = pa.schema(fields)

    def run(batches):
        known = _rendered(sent.value)
        for keys, texts in _some_texts(batches):
            out = []
            with no_cycles():
                pieces = [known.bpe.pieces(t) for t in texts]
                entry = known.table(pieces).__getitem__
                for doc, words in zip(keys, pieces):
                    found = list(map(entry, words))
                    raw = b"".join([x[2] for x in found])
                    row = (
                        len(raw) // 4, hashlib.sha256(" ".join([x[0] for x in found]).encode()).hexdigest(),
                        hashlib.sha256(" ".join([x[1] for x in found]).encode()).hexdigest(),
                    )
                    out.append((doc, np.frombuffer(raw, np.int32), *row) if ids else (doc, *row))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), shape)], schema=shape)

    rows = docs.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, schema)


def decode_ids(rows: DataFrame, vocabulary: str, *, ids: str = "ids") -> DataFrame:
    """The rows with a column ``decoded``: the text of an array of ids, null for a null array; unknown ids give nothing."""
    sent = rows.sparkSession.sparkContext.broadcast(read_vocabulary(rows.sparkSession, vocabulary))

    @F.pandas_udf("string")
    def decoded(column: pd.Series) -> pd.Series:
        bpe = _rendered(sent.value).bpe
        return column.map(lambda x: None if x is None else bpe.decode(list(x)))

    return rows.drop("decoded").withColumn("decoded", decoded(F.col(f"`{ids}`")))
