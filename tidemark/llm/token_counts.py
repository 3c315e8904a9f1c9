"""Token counts of texts of any length, huge ones by overlapping chunks.

A huge text is cut into chunks that start a little before the end of the one before, and any task may encode any chunk.
Two neighbours are spliced at a place of their overlap where both have a token boundary and which is proven to be one of
the whole text. The vocabulary splits a text into runs (letters, digits, other signs, each with at most one space before, white
space, and endings like 're) and merges bytes inside a run by rank, the leftmost first. That gives two proofs:

* *Between runs.* No run holds a sign followed by white space, nor two ASCII signs of different classes except a space
  or an apostrophe and what follows. At such a place a run ends whatever stands around, and the runs on either side depend on
  nothing beyond it.
* *Inside a run.* A sequence of tokens is the encoding of its bytes exactly if each pair of neighbours, alone, encodes to
  itself: the first merge across one of their boundaries would also be made in that pair alone. Both chunks give such
  sequences, so at a common boundary inside a run only the pair that meets there has to be tried.

An overlap without such a place is widened fourfold, and the chunks with it, until one holds the run that caused it.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType
from tokenizers import Tokenizer

from ..session import settle
from .bpe import WHITE, byte_letters, read_vocabulary
from .common import ROWS_AT_ONCE, by_value, kept_in_worker, no_cycles

#: Code points of a chunk (longer texts are cut) and of the part it shares with the chunk before.
CHUNK, OVERLAP = 1 << 16, 1 << 9
WIDER = 4
INSIDE, BETWEEN = 0, 1
#: A run never crosses from a sign to white space, and into a sign only from one space; these pieces are whole runs.
PIECES = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+").findall
#: Fixed value: the runs that a byte-level vocabulary of this kind merges within.
RUNS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts whose runs are no longer go whole to the faster of two encoders, whose time grows with the square of a run.
SHORT_RUN = 256
LONG_SPACE = re.compile(f"[{WHITE}]{{{SHORT_RUN + 1}}}").search
#: Fixed classes of ASCII; 0 stands for all that is not ASCII.
LETTER, DIGIT, OTHER, SPACE = 1, 2, 3, 4


def _classes() -> np.ndarray:
    out = np.full(128, OTHER, np.int8)
    for first, last, kind in (("A", "Z", LETTER), ("a", "z", LETTER), ("0", "9", DIGIT), ("\t", "\r", SPACE), (" ", " ", SPACE)):
        out[ord(first):ord(last) + 1] = kind
    return out


def _by_ranks(spec: dict) -> tiktoken.Encoding | None:
    """The same merges as a table of ranks; None for a vocabulary that such a table does not describe."""
    cut, model = spec["pre_tokenizer"], spec["model"]
    plain = cut["type"] == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"] and not spec["normalizer"] and not model["ignore_merges"]
    letters = byte_letters()
    byte = {x: b for b, x in enumerate(letters)}
    merged = ["".join(pair if isinstance(pair, list) else pair.split(" ")) for pair in model["merges"]]
    if not plain or len({*letters, *merged}) != 256 + len(merged):
        return None
    ranks = {bytes([byte[x] for x in token]): rank for rank, token in enumerate([*letters, *merged])}
    return tiktoken.Encoding("ranks", pat_str=RUNS, mergeable_ranks=ranks, special_tokens={})


class Counter:
    """Numbers of tokens, and the library's encoder with what splicing needs to know."""

    def __init__(self, file_text: str):
        self.library = Tokenizer.from_str(file_text)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.cut_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.names = {i: s for s, i in self.library.get_vocab(with_added_tokens=False).items()}
        self.sizes = np.zeros(max(self.names) + 1, np.int64)
        self.sizes[list(self.names)] = [len(s) for s in self.names.values()]
        self.classes = _classes()
        self.ranks = _by_ranks(json.loads(file_text))

    def count_segment(self, text: str) -> int:
        if self.ranks is None:
            return len(self.library.encode(text, add_special_tokens=False))
        if max(map(len, text.split()), default=0) <= SHORT_RUN and not LONG_SPACE(text):
            return len(self.ranks.encode_ordinary(text))
        sizes = ((self.ranks.encode_ordinary(p) if len(p) <= SHORT_RUN else self.library.encode(p, add_special_tokens=False)) for p in PIECES(text))
        return sum(map(len, sizes))

    def segments(self, text: str) -> list[str]:
        """The texts between special tokens, each encoded by itself."""
        if self.cut_special is None or not any(s in text for s in self.special):
            return [text]
        return self.cut_special.split(text)[::2]

    def count(self, text: str) -> int:
        parts = self.segments(text)
        return len(parts) - 1 + sum(map(self.count_segment, parts))

    def boundaries(self, text: str) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Number of tokens, and of every boundary that may serve as a splice: code point, tokens before it, kind, ids beside it."""
        found = self.library.encode(text, add_special_tokens=False)
        ids, words = np.array(found.ids, np.int64), np.array(found.word_ids, np.int64)
        raw = np.frombuffer(text.encode(), np.uint8)
        ends = np.cumsum(self.sizes[ids])
        if len(ends) and ends[-1] != len(raw):
            raise ValueError("the vocabulary does not cover the text byte by byte")
        starts = (raw & 0xC0) != 0x80
        points = np.cumsum(starts)
        index = np.arange(1, len(ids))
        at = ends[:-1]
        whole = starts[at] if len(at) else np.zeros(0, bool)
        before, after = raw[at - 1], raw[at]
        kinds = np.where(raw < 128, self.classes[raw & 127], 0)
        left, right = kinds[at - 1], kinds[at]
        # ASCII on both sides, of different classes; white space and an apostrophe may go with what follows.
        between = (left > 0) & (right > 0) & (left != right) & (left != SPACE) & ~((before == ord("'")) & (right == LETTER))
        # Endings like 're are fixed strings, not runs of a class: nothing within three bytes of an apostrophe counts as inside.
        marks = np.concatenate([[0], np.cumsum(raw == ord("'"))])
        inside = (words[1:] == words[:-1]) & (marks[at] == marks[np.maximum(at - 3, 0)])
        use = whole & (between | inside)
        return len(ids), points[at[use]] - 1, index[use], np.where(between, BETWEEN, INSIDE)[use], ids[:-1][use], ids[1:][use]

    def fits(self, left: int, right: int) -> bool:
        """Whether two tokens side by side stay as they are."""
        return [t.id for t in self.library.model.tokenize(self.names[left] + self.names[right])] == [left, right]

    def splice(self, tail: dict, head: dict) -> int | None:
        """Tokens that both chunks count twice or wrongly; None if no place is proven."""
        a, b = ({at: (kind, drop, i) for at, kind, drop, i in zip(s["at"], s["kind"], s["dropped"], s["ids"])} for s in (tail, head))
        for at in sorted(a.keys() & b.keys(), key=lambda p: (-a[p][0], p)):
            (kind, drop, left), (other, more, right) = a[at], b[at]
            if kind == other and (kind == BETWEEN or self.fits(left, right)):
                return drop + more
        return None


def _counter(file_text: str) -> Counter:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    kept = kept_in_worker("token counts")
    mark = hash(file_text)  # computed once for the broadcast text, not for every row
    if mark not in kept:
        kept.clear()
        kept[mark] = Counter(file_text)
    return kept[mark]


MARKS = "struct<at:array<bigint>,kind:array<int>,dropped:array<bigint>,ids:array<int>>"
MARKS_ARROW = pa.struct([("at", pa.list_(pa.int64())), ("kind", pa.list_(pa.int32())), ("dropped", pa.list_(pa.int64())), ("ids", pa.list_(pa.int32()))])


def _chunks(texts: DataFrame, sent, chunk: int, overlap: int) -> DataFrame:
    """``(uid, part, i, last, low, text)``: chunks of the parts between special tokens; ``low`` is a chunk's first code point."""
    shape = pa.schema([("uid", pa.int64()), ("part", pa.int32()), ("i", pa.int32()), ("last", pa.bool_()), ("low", pa.int64()), ("text", pa.string())])

    def run(batches):
        cut = _counter(sent.value).segments
        for uid, text in ((u.as_py(), t.as_py()) for b in batches for u, t in zip(b.column(0), b.column(1))):
            for part, segment in enumerate(cut(text)):
                n = max(1, -(-len(segment) // chunk))
                for i in range(n):
                    low = max(0, i * chunk - overlap)
                    row = (uid, part, i, i == n - 1, low, segment[low:(i + 1) * chunk])
                    yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, shape)], schema=shape)

    return texts.select("uid", "text").mapInArrow(run, "uid bigint, part int, i int, last boolean, low bigint, text string")


def _encoded(chunks: DataFrame, sent, chunk: int, overlap: int) -> DataFrame:
    """``(uid, part, seam, n, tail, head)``: the tokens of every chunk, and for each seam the marks of the chunk before or after it."""
    shape = pa.schema([("uid", pa.int64()), ("part", pa.int32()), ("seam", pa.int32()), ("n", pa.int64()), ("tail", MARKS_ARROW), ("head", MARKS_ARROW)])

    def run(batches):
        counter = _counter(sent.value)
        for batch in batches:
            out = []
            for row in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
                uid, part, i, low = row["uid"], row["part"], row["i"], row["low"]
                total, at, index, kind, left, right = counter.boundaries(row["text"])
                at = at + low
                # The special token before a part is counted with its first chunk.
                out.append((uid, part, 0, total + (i == 0 and part > 0), None, None))
                if i > 0:
                    use = (at > low) & (at < i * chunk)
                    out.append((uid, part, i, 0, None, _marks(at[use], kind[use], index[use], right[use])))
                if not row["last"]:
                    use = (at > (i + 1) * chunk - overlap) & (at < (i + 1) * chunk)
                    out.append((uid, part, i + 1, 0, _marks(at[use], kind[use], total - index[use], left[use]), None))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), shape)], schema=shape)

    return chunks.mapInArrow(run, f"uid bigint, part int, seam int, n bigint, tail {MARKS}, head {MARKS}")


def _marks(at, kind, dropped, ids) -> dict:
    return {"at": at.tolist(), "kind": kind.tolist(), "dropped": dropped.tolist(), "ids": ids.tolist()}


def _by_chunks(texts: DataFrame, sent, chunk: int, overlap: int) -> DataFrame:
    """``(uid, n_tokens, failed)``; ``failed`` where a seam found no proven place."""

    @by_value(LongType(), keeps=True)
    def dropped(tail, head):
        # Rows that count a chunk's tokens come along and have no marks.
        return None if tail is None or head is None else _counter(sent.value).splice(tail, head)

    chunks = _chunks(texts, sent, chunk, overlap).repartition("uid", "part", "i")
    seams = _encoded(chunks, sent, chunk, overlap).groupBy("uid", "part", "seam").agg(
        F.sum("n").alias("n"), F.max("tail").alias("tail"), F.max("head").alias("head")
    )
    return seams.withColumn("drops", dropped("tail", "head")).groupBy("uid").agg(
        (F.sum("n") - F.coalesce(F.sum("drops"), F.lit(0))).alias("n_tokens"),
        F.bool_or((F.col("seam") > 0) & F.col("drops").isNull()).alias("failed"),
    )


def count_tokens(
    docs: DataFrame, vocabulary: str, *, key: str = "doc_id", text: str = "text", limit: int = 512, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit`` of every row, as the tokenizers library counts.

    ``vocabulary`` is the path of a byte-level BPE file; its text is broadcast, so executors need not have the file. Texts
    of up to ``chunk`` code points are counted where they are read; of longer ones only chunks travel, so that one text keeps
    many tasks busy. They are written once, with a number that retried tasks find again, and only they.

    Null text counts as empty: no bytes, no tokens. A special token's string counts as that token. Every row gives a row,
    repeated ones and those without a key too. Other columns are not read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(read_vocabulary(spark, vocabulary))
    rows = docs.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    sized = rows.withColumn("n_bytes", F.octet_length("text").cast("bigint"))

    @by_value(LongType(), keeps=True)
    def counted(value):
        return _counter(sent.value).count(value)

    short = sized.where(F.length("text") <= chunk).select("doc_id", "n_bytes", counted("text").alias("n_tokens"))
    long = settle(sized.where(F.length("text") > chunk).withColumn("uid", F.monotonically_increasing_id()), "long-texts")
    open_, found = long, None
    while not open_.isEmpty():
        done = settle(_by_chunks(open_, sent, chunk, overlap), "token-counts")
        whole = done.where(~F.col("failed"))
        found = whole if found is None else found.union(whole)
        open_ = open_.join(done.where("failed").select("uid"), "uid", "left_semi")
        overlap *= WIDER
        chunk = max(chunk, WIDER * overlap)
    counts = short if found is None else short.union(long.join(found, "uid").select("doc_id", "n_bytes", "n_tokens"))
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
