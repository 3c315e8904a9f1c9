"""Toxicity by a small convolutional text classifier, trained in numpy.

Words are hashed; the hashes that enough training texts have get rows of an embedding table, other words the row of their
first letters, if that is common enough. Filters over one, two and three neighbouring words are max-pooled over the
whole text and a logistic layer gives the score. For scoring, each filter's part at each offset is multiplied into the
table beforehand, so a word costs one row of sums. Besides the score's fixed cut, a threshold per language is calibrated
on labelled rows; language is no input of the score.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import settle
from .common import by_value, kept_in_worker

LEAST = 5
STEM = 4
WIDTH = 12
FILTERS = 8
SIZES = (1, 2, 3)
CUT = 0.3
#: Bounds of the training sample: rows in all, and words of a row on average (a row may have far more).
SAMPLE = 6000
SAMPLE_WORDS = 2000
WORD_CHARS = 6
EPOCHS = 6
BATCH = 48
#: A training batch ends before it has more words than this, unless one text has.
BATCH_WORDS = 1 << 19
CHUNK = 1 << 15
CACHED_WORDS = 400_000
#: Every ASCII character but letters and digits parts words, besides white space.
PARTS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "replace").translate(PARTS).split()


def word_hash(word: bytes) -> int:
    return zlib.crc32(word)


def stem_hash(word: bytes) -> int:
    """Hash of a word's first letters, in a space of its own."""
    return zlib.crc32(word[:4 * STEM].decode("utf-8", "replace")[:STEM].encode() + b"~") | 1 << 32


class Split:
    """The words of texts, one text at a time, as often as asked for."""

    def __init__(self, texts: list[str | None]):
        self.texts = texts

    def __iter__(self):
        return map(words_of, self.texts)


def vocabulary(texts: list[list[bytes]] | Split, least: int = LEAST) -> dict[int, int]:
    """Row of each hash of a word or stem that at least ``least`` texts have; row 0 is for what has none."""
    seen: Counter = Counter()
    for words in texts:
        distinct = set(words)
        seen.update({word_hash(w) for w in distinct} | {stem_hash(w) for w in distinct})
    return {h: i for i, h in enumerate(sorted(h for h, n in seen.items() if n >= least), 1)}


class Rows(dict):
    """Word -> row, filled on demand and bounded."""

    def __init__(self, known: dict[int, int]):
        self.known = known

    def __missing__(self, word: bytes) -> int:
        found = self.known.get(word_hash(word)) or self.known.get(stem_hash(word), 0)
        if len(word) <= 64:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = found
        return found


def word_rows(words: list[bytes], rows: Rows) -> np.ndarray:
    """A text's words as rows; row 0 also pads texts of fewer words than the widest filter."""
    return np.array(list(map(rows.__getitem__, words)) + [0] * (max(SIZES) - len(words)), np.int32)


@dataclass
class Model:
    """Rows of hashes, their table, filters ``[size][offset]`` as (width, filters), biases, output layer."""

    known: dict[int, int]
    table: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    bias: float

    def sums(self) -> np.ndarray:
        """Per row of the table the part of each size, offset and filter."""
        return np.concatenate([self.table @ f[o] for f in self.filters for o in range(len(f))], axis=1)


def pooled(model: Model, sums: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Max-pooled filters of one text, in chunks, so that memory does not grow with it."""
    best = np.full((len(SIZES), FILTERS), -np.inf, np.float32)
    wide = max(SIZES)
    for start in range(0, max(1, len(places) - wide + 1), CHUNK):
        part = sums[places[start:start + CHUNK + wide - 1]]
        at = 0
        for i, size in enumerate(SIZES):
            total = part[:len(part) - size + 1, at:at + FILTERS]
            for o in range(1, size):
                total = total + part[o:len(part) - size + 1 + o, at + o * FILTERS:at + (o + 1) * FILTERS]
            best[i] = np.maximum(best[i], total.max(axis=0))
            at += size * FILTERS
    return np.maximum(best + np.stack(model.biases), 0).ravel()


def squashed(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def score(model: Model, sums: np.ndarray, places: np.ndarray) -> float:
    return float(squashed(pooled(model, sums, places) @ model.out + model.bias))


def _start(texts: list[np.ndarray], toxic: np.ndarray, known: dict[int, int], rnd) -> Model:
    """Small random numbers, but for the first embedding column: how much likelier a word is in toxic texts, shrunk."""
    seen = [np.unique(t) for t in texts]
    counts = np.zeros((2, len(known) + 1))
    for places, label in zip(seen, toxic):
        counts[int(label), places] += 1
    n = np.maximum(np.bincount(toxic.astype(int), minlength=2), 1)
    lean = np.log((counts[1] + 0.5) / (n[1] + 1)) - np.log((counts[0] + 0.5) / (n[0] + 1))
    often = counts.sum(axis=0)
    table = rnd.normal(0, 0.05, (len(known) + 1, WIDTH)).astype(np.float32)
    table[:, 0] = lean * often / (often + 5)
    table[0] = 0
    filters = [rnd.normal(0, 0.1, (size, WIDTH, FILTERS)).astype(np.float32) for size in SIZES]
    for f in filters:
        f[:, 0, :FILTERS // 2] += 0.5 / len(f)
        f[:, 0, FILTERS // 2:] -= 0.5 / len(f)
    biases = [np.zeros(FILTERS, np.float32) for _ in SIZES]
    out = np.tile(np.r_[np.full(FILTERS // 2, 0.5), np.full(FILTERS - FILTERS // 2, -0.1)], len(SIZES)).astype(np.float32)
    return Model(known, table, filters, biases, out, -1.0)


def batches(order: np.ndarray, lengths: np.ndarray, rows: int = BATCH, words: int = BATCH_WORDS) -> list[np.ndarray]:
    """``order`` in runs of at most ``rows`` texts, and of at most ``words`` words where a run has more than one text."""
    out, start, held = [], 0, 0
    for i, n in enumerate(lengths[order].tolist()):
        if i > start and (i - start == rows or held + n > words):
            out.append(order[start:i])
            start, held = i, 0
        held += n
    return out + [order[start:]]


def train(texts: list[list[bytes]] | Split, toxic: np.ndarray, weights: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Model:
    """Minibatch Adagrad on the weighted log loss; gradients reach the words that won a pooling."""
    rnd = np.random.default_rng(seed)
    known = vocabulary(texts)
    rows_of = Rows(known)
    texts = [word_rows(words, rows_of) for words in texts]
    model = _start(texts, toxic, known, rnd)
    weights = weights / weights.mean()
    memory = {"out": np.full(model.out.shape, 1e-6), "bias": 1e-6, "table": np.full(len(model.table), 1e-6)}
    memory |= {f"f{i}": np.full(f.shape, 1e-6) for i, f in enumerate(model.filters)}
    memory |= {f"b{i}": np.full(FILTERS, 1e-6) for i in range(len(SIZES))}

    def step(name, value, gradient, rate):
        memory[name] += gradient ** 2
        return value - (rate * gradient / np.sqrt(memory[name])).astype(value.dtype if hasattr(value, "dtype") else float)

    sizes = np.array([len(t) for t in texts])
    for _ in range(epochs):
        for chosen in batches(rnd.permutation(len(texts)), sizes):
            lengths = np.array([len(texts[i]) for i in chosen])
            places = np.concatenate([texts[i] for i in chosen])
            first = np.r_[0, np.cumsum(lengths)[:-1]]
            owner = np.repeat(np.arange(len(chosen)), lengths)
            x = model.table[places]
            tops, winners = [], []
            for i, size in enumerate(SIZES):
                f = model.filters[i]
                total = np.full((len(places), FILTERS), -np.inf, np.float32)
                kept = len(places) - size + 1
                total[:kept] = sum(x[o:kept + o] @ f[o] for o in range(size))
                # A window that starts in a text's last words would reach into the next text.
                for back in range(1, size):
                    total[first + lengths - back] = -np.inf
                best = np.maximum.reduceat(total, first, axis=0)
                at, column = np.nonzero(total == best[owner])
                won = np.zeros((len(chosen), FILTERS), np.int64)
                won[owner[at[::-1]], column[::-1]] = at[::-1]
                tops.append(best + model.biases[i])
                winners.append(won)
            flat = np.concatenate(tops, axis=1)
            hidden = np.maximum(flat, 0)
            error = (squashed(hidden @ model.out + model.bias) - toxic[chosen]) * weights[chosen] / len(chosen)
            back = (error[:, None] * model.out[None, :]) * (flat > 0)
            rows, moves = [], []
            updates = []
            for i, size in enumerate(SIZES):
                f, own = model.filters[i], back[:, i * FILTERS:(i + 1) * FILTERS]
                gradient = np.zeros(f.shape)
                for o in range(size):
                    met = x[winners[i] + o]  # (texts, filters, width)
                    gradient[o] = np.einsum("tf,tfw->wf", own, met)
                    rows.append(places[winners[i] + o].ravel())
                    moves.append((own[:, :, None] * f[o].T[None]).reshape(-1, WIDTH))
                updates.append((i, gradient, own.sum(axis=0)))
            model.out = step("out", model.out, hidden.T @ error + 1e-4 * model.out, 0.05)
            model.bias = float(step("bias", model.bias, float(error.sum()), 0.1))
            for i, gradient, own in updates:
                model.filters[i] = step(f"f{i}", model.filters[i], gradient, 0.02)
                model.biases[i] = step(f"b{i}", model.biases[i], own, 0.02)
            rows, moves = np.concatenate(rows), np.concatenate(moves)
            distinct, inverse = np.unique(rows, return_inverse=True)
            summed = np.zeros((len(distinct), WIDTH))
            np.add.at(summed, inverse, moves)
            memory["table"][distinct] += (summed ** 2).mean(axis=1)
            change = 0.1 * summed / np.sqrt(memory["table"][distinct])[:, None]
            change[distinct == 0] = 0
            model.table[distinct] -= change.astype(np.float32)
    return model


def in_training(key: Column) -> Column:
    """Rows whose labels may be learnt from: the checksum of the key's text leaves 2 in no division by 4. Null keys may not."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 != 2, F.lit(False))


def one_label(labels: DataFrame, key: str, label: str) -> DataFrame:
    """One label per key, toxic if any of its rows says so; null keys and labels are left out."""
    return (
        labels.where(F.col(f"`{key}`").isNotNull() & F.col(f"`{label}`").isNotNull())
        .groupBy(F.col(f"`{key}`").alias("id")).agg(F.max(F.col(f"`{label}`").cast("int")).alias("toxic"))
    )


def picked(sizes: list[int], rows: int, budget: int) -> list[int]:
    """Places of at most ``rows`` sizes that fit the budget together, in order; one that does not fit gives way to the next.

    Where none fits alone, the smallest is taken, so that a label never goes without a text.
    """
    out = []
    for i, n in enumerate(sizes):
        if len(out) < rows and n <= budget:
            out.append(i)
            budget -= n
    return out or [min(range(len(sizes)), key=sizes.__getitem__)][:rows] if sizes else []


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, words: int = SAMPLE_WORDS, *, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model | None:
    """A model from a bounded sample of the labelled rows outside the held-out quarter; None without any of them.

    At most ``sample`` rows of at most ``words`` words each on average are drawn, half of either label where there are
    enough, by the hash of their key; they are weighted back to the frequencies found. A text of any length is learnt from
    whole or not at all: what no longer fits the label's half of the words gives way to the next row.
    """
    known = one_label(labels, key, label).where(in_training(F.col("id")))
    totals = dict(known.groupBy("toxic").count().collect())
    texts = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text")).withColumn("mark", F.xxhash64("text"))
    # Only sizes move before the rows are chosen; rows repeated in the table are one.
    sized = texts.select("id", "mark", F.coalesce(F.length("text"), F.lit(0)).alias("size")).join(known, "id").dropDuplicates(["id", "mark"])
    half = max(1, sample // 2)
    chosen = []
    for wanted in ("toxic < 1", "toxic >= 1"):
        # A top-n per label keeps at most n rows of a task before anything moves.
        near = sized.where(wanted).orderBy(F.xxhash64("id"), "id", "mark").limit(2 * half).collect()
        chosen += [near[i] for i in picked([r["size"] for r in near], half, half * words * WORD_CHARS)]
    if not chosen:
        return None
    drawn = docs.sparkSession.createDataFrame([(r["id"], r["mark"], r["toxic"]) for r in chosen], sized.select("id", "mark", "toxic").schema)
    rows = texts.join(F.broadcast(drawn), ["id", "mark"]).groupBy("id", "mark").agg(F.max("text").alias("text"), F.max("toxic").alias("toxic")).collect()
    rows.sort(key=lambda r: (r["id"], r["text"] or ""))
    toxic = np.array([min(r["toxic"], 1) for r in rows])
    got = np.bincount(toxic, minlength=2)
    real = np.array([sum(n for t, n in totals.items() if min(t, 1) == c) for c in (0, 1)], float)
    return train(Split([r["text"] for r in rows]), toxic, (real / np.maximum(got, 1))[toxic])


def scores(docs: DataFrame, model: Model | None, text: str = "text") -> Column:
    """Score column of a text; one half for all without a model."""
    if model is None:
        return F.lit(0.5)
    # Plain values: an object of a class of this package could not be read where executors have no copy of it.
    sent = docs.sparkSession.sparkContext.broadcast((model.known, model.table, model.filters, model.biases, model.out, model.bias))
    mark = zlib.crc32(model.table.tobytes() + model.out.tobytes())

    @by_value(T.DoubleType(), keeps=True)
    def scored(text):
        kept = kept_in_worker("toxicity")
        if kept.get("mark") != mark:
            own = Model(*sent.value)
            kept.clear()
            kept.update(mark=mark, model=own, sums=own.sums(), rows=Rows(own.known))
        own, sums, rows = kept["model"], kept["sums"], kept["rows"]
        return score(own, sums, word_rows(words_of(text), rows))

    return scored(F.col(f"`{text}`"))


def best_threshold(cells: list[int], clean: list[int], toxic: list[int]) -> float:
    """The cut, in hundredths, with the best F1 on the counted rows; among equals the highest. Without toxic rows: 1."""
    best, found, hit, wrong, total = (0.0, 100), False, 0, 0, sum(toxic)
    for at, c, t in sorted(zip(cells, clean, toxic), reverse=True):
        hit, wrong = hit + t, wrong + c
        f1 = 2 * hit / (hit + wrong + total) if total else 0.0
        if f1 > best[0] + 1e-12:
            best, found = (f1, at), True
    return best[1] / 100 if found else 1.0


def thresholds(marked: DataFrame) -> DataFrame:
    """``(language, threshold)`` from labelled scores, counted per language and hundredth before they are gathered."""
    counts = marked.groupBy("language", F.floor(F.col("score") * 100).cast("int").alias("at")).agg(
        F.sum((F.col("toxic") < 1).cast("bigint")).alias("clean"), F.sum((F.col("toxic") >= 1).cast("bigint")).alias("bad")
    )

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"language": [rows["language"].iloc[0]], "threshold": [best_threshold(rows["at"].tolist(), rows["clean"].tolist(), rows["bad"].tolist())]})

    return counts.groupBy("language").applyInPandas(choose, "language string, threshold double")


def rate(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", language: str = "lang", label: str = "toxic", **sizes) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted``, ``threshold`` and ``flagged`` of every row.

    ``predicted`` cuts the score at 0.3, ``flagged`` at the language's own threshold (0.3 where no label tells). Null and
    empty texts are scored as a text of padding. A null language is a language of its own; a null key is not held out and
    never learnt from. Rows repeated in the table are each scored; an empty table gives an empty result. Without any label
    to learn from all scores are one half. Other columns are not read.
    """
    model = fit(docs, labels, key=key, text=text, label=label, **sizes)
    name = F.coalesce(F.concat(F.lit("="), F.col(f"`{language}`").cast("string")), F.lit("null"))
    scored = settle(
        docs.select(F.col(f"`{key}`").alias("doc_id"), name.alias("language"), scores(docs, model, text).alias("score")), "toxicity-scores"
    )
    known = one_label(labels, key, label).where(in_training(F.col("id")))
    cuts = thresholds(scored.join(known, F.col("doc_id") == F.col("id")))
    out = scored.join(cuts, "language", "left").withColumn("threshold", F.coalesce("threshold", F.lit(CUT)))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    return out.select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"), "threshold",
        (F.col("score") >= F.col("threshold")).alias("flagged"),
    )
