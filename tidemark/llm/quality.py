"""Quality rules with risk-controlled cutoffs.

Each rule turns a text into a number that grows with some fault. A quarter of the labelled documents draws, per stratum,
one path of ever stricter cutoffs for all rules together: those come first that reject the fewest good documents for the
bad ones. The others, which the path has not seen, are the holdout: along the path, joint cutoffs are certified while the
exact binomial test shows that all rules together reject at most the allowed part of good documents. Tests in a fixed order
need no correction; over strata the error is split evenly (Bonferroni). Of the certified cutoffs those with the largest
surplus of bad over good documents rejected are used, and among equals the mildest.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import settle
from .common import by_value, spare

SPACES = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
UPPER, LOWER = bytes(range(65, 91)), bytes(range(97, 123))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters")
MEASURED = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])
GRID = 1000
RISK = 0.04
ERROR = 0.05

RULES = {
    "symbols": lambda c: c("n_symbols") / F.greatest(c("word_chars"), F.lit(1)),
    "repeats": lambda c: c("n_repeat_words") / F.greatest(c("n_words"), F.lit(1)),
    "lines": lambda c: c("n_dup_lines") / F.greatest(c("n_lines"), F.lit(1)),
    "capitals": lambda c: c("n_upper") / F.greatest(c("n_letters"), F.lit(1)),
}


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a three-word window which occurs at least twice in the list."""
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    if len(seen) == len(windows):
        return 0
    twice = np.fromiter((seen[w] > 1 for w in windows), bool, len(windows))
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift:shift + len(windows)] |= twice
    return int(covered.sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The counts of one text, in the order of ``COUNTS``; all zero for a null text."""
    if not text:
        return (0,) * len(COUNTS)
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at exactly \x20 and \x09-\x0D
    lines, dup = set(), 0
    held = 0
    for line in raw.split(b"\n"):
        if line.strip():
            held += 1
            if line in lines:
                dup += 1
            else:
                lines.add(line)
    size = len(raw)
    upper = size - len(raw.translate(None, UPPER))
    return (
        len(words), len(text) - (size - len(raw.translate(None, SPACES))), size - len(raw.translate(None, SYMBOLS)), dup,
        repeated_words(words), held, upper, upper + size - len(raw.translate(None, LOWER)),
    )


measured = by_value(MEASURED)(measure)


def base_failed(c) -> Column:
    """The fixed rule: under 50 words, or more than half of the words in repeated windows. ``c`` gives a count's column."""
    return (c("n_words") < 50) | (100 * c("n_repeat_words") > 50 * c("n_words"))


def cell(value: Column) -> Column:
    return F.least(F.floor(value * GRID), F.lit(GRID)).cast("int")


def at_most(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Bin(n, p): the incomplete beta function by its continued fraction."""
    if k < 0:
        return 0.0
    if k >= n:
        return 1.0
    a, b, x = n - k, k + 1.0, 1.0 - p
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return min(1.0, front * _fraction(a, b, x) / a)
    return max(0.0, 1.0 - front * _fraction(b, a, 1 - x) / b)


def _fraction(a: float, b: float, x: float) -> float:
    # Modified Lentz evaluation of the standard fraction; terms needed grow with sqrt(max(a, b)).
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    out = d
    for m in range(1, 200 + int(20 * math.sqrt(max(a, b)))):
        for term in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + term * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + term / c
            c = c if abs(c) > tiny else tiny
            out *= c * d
        if abs(c * d - 1) < 1e-14:
            break
    return out


def drawn_path(rule: list[str], cells: list[int], good: list[int], bad: list[int]) -> list[tuple[str, int, float]]:
    """``(rule, cutoff, level)`` of one stratum, from the counts per rule and cell of the documents that draw the path.

    The level of a cutoff is (good + 1) / (bad + 1) over the documents at or above it, or that of a milder cutoff of the rule if it is lower.
    Only cutoffs that lower the level of their rule are listed, and only below 1, where more bad than good documents go.
    """
    tails, k, hits, last = {}, 0, 0, None
    for r, at, g, b in sorted(zip(rule, cells, good, bad), key=lambda x: (x[0], -x[1])):
        if r != last:
            k, hits, last = 0, 0, r
        k, hits = k + g, hits + b
        if at >= 1:
            tails.setdefault(r, []).append((at, (k + 1.0) / (hits + 1.0)))
    out = []
    for r, steps in tails.items():
        least = 1.0
        for at, level in reversed(steps):
            if level < least:
                least = level
                out.append((r, at, level))
    return out


def certified(levels: list[float], good: list[int], bad: list[int], risk: float, error: float) -> tuple[float | None, int, int]:
    """``(level, good rejected, bad rejected)`` for the holdout of one stratum: documents of that level or a lower one go.

    Documents that no cutoff of the path reaches have a null level. None if no level can be certified or if no certified one
    rejects more bad documents than good ones.
    """
    n, best, k, hits = sum(good), (None, 0, 0), 0, 0
    for level, g, b in sorted(x for x in zip(levels, good, bad) if x[0] is not None and not math.isnan(x[0])):
        k, hits = k + g, hits + b
        if at_most(k, n, risk) > error:
            break
        if hits - k > best[2] - best[1]:
            best = (level, k, hits)
    return best


def cutoffs(marked: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Certified cutoffs ``(stratum, rule, cutoff, n_good, good_rejected, bad_rejected)``; the counts are those of all rules of the stratum together.

    ``marked`` has one labelled row per document: ``id``, ``stratum``, ``good`` and a cell per rule. Rows are counted per cell
    before anything is gathered, so that a stratum comes to one task as at most ``GRID`` + 1 counts per rule, and then as a
    count per level of its path. ``risk`` bounds the part of good documents of a stratum that all rules together reject.
    """
    n_good, n_bad = F.sum(F.col("good").cast("bigint")).alias("n_good"), F.sum((~F.col("good")).cast("bigint")).alias("n_bad")
    draws = F.substring(F.sha2(F.col("id").cast("string"), 256), 1, 1) < "4"
    pairs = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("at")) for r in RULES])).alias("x")
    drawing = marked.where(draws).select("stratum", "good", pairs).groupBy("stratum", F.col("x.rule").alias("rule"), F.col("x.at").alias("at")).agg(n_good, n_bad)

    def draw(rows: pd.DataFrame) -> pd.DataFrame:
        found = drawn_path(rows["rule"].tolist(), rows["at"].tolist(), rows["n_good"].tolist(), rows["n_bad"].tolist())
        return pd.DataFrame([(rows["stratum"].iloc[0], *x) for x in found], columns=["stratum", "rule", "at", "level"])

    path = settle(drawing.groupBy("stratum").applyInPandas(draw, "stratum string, rule string, at int, level double"), "quality-path")
    steps = path.groupBy("stratum").agg(F.sort_array(F.collect_list(F.struct("level", "rule", "at"))).alias("steps"))
    # Steps are sorted by level, so the first that a document reaches is its own.
    reached = F.filter("steps", lambda s: reduce(or_, [(s["rule"] == r) & (s["at"] <= F.col(r)) for r in RULES]))
    held = marked.where(~draws).join(steps, "stratum", "left").select("stratum", "good", F.get(reached, F.lit(0))["level"].alias("level"))
    counts = settle(held.groupBy("stratum", "level").agg(n_good, n_bad), "quality-levels")
    split = error / max(1, counts.select("stratum").distinct().count())

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        found = certified(rows["level"].tolist(), rows["n_good"].tolist(), rows["n_bad"].tolist(), risk, split)
        return pd.DataFrame(
            [(rows["stratum"].iloc[0], found[0], int(rows["n_good"].sum()), found[1], found[2])],
            columns=["stratum", "most", "n_good", "good_rejected", "bad_rejected"],
        ).astype({"most": "float64"})

    chosen = counts.groupBy("stratum").applyInPandas(choose, "stratum string, most double, n_good bigint, good_rejected bigint, bad_rejected bigint")
    # A stratum without a certified level comes with a missing number, which Spark orders above all others.
    allowed = chosen.withColumn("most", F.when(~F.isnan("most"), F.col("most")))
    cut = F.min(F.when(F.col("level") <= F.col("most"), F.col("at"))).cast("bigint").alias("cutoff")
    return (
        allowed.join(path, "stratum", "left").groupBy("stratum", "rule", "n_good", "good_rejected", "bad_rejected").agg(cut)
        .select("stratum", "rule", "cutoff", "n_good", "good_rejected", "bad_rejected")
    )


def stratum_of(column: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{column}`").cast("string")), F.lit("null"))


def one_label(labels: DataFrame, key: str, label: str) -> DataFrame:
    """One label per document: good if any of its rows says so; null keys and labels are left out."""
    return (
        labels.where(F.col(f"`{key}`").isNotNull() & F.col(f"`{label}`").isNotNull())
        .groupBy(F.col(f"`{key}`").alias("id")).agg((F.max(F.col(f"`{label}`").cast("int")) == 1).alias("good"))
    )


def judge(
    docs: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR, *, key: str = "doc_id", text: str = "text",
    stratum: str = "lang", label: str = "quality",
) -> tuple[DataFrame, DataFrame]:
    """Counts and verdict of every row, and the cutoffs behind them.

    The first frame has a row per row of ``docs``: ``doc_id``, ``stratum``, the counts, ``base_failed``, a cell per rule,
    ``rejected_by`` (rules, comma-joined) and ``kept``. It is a written table, so the texts are measured once.

    A row that fails the base rule is never kept and takes no part in the calibration. A null text counts as no words, a
    null stratum is a stratum of its own, a document labelled both good and bad is good, rows repeated in the table are
    each judged but count as one labelled document. Where labels are too few to certify any cutoff (for the defaults and four strata
    under 108 good documents in the holdout of the stratum), nothing is rejected beyond the base rule. An empty table gives an empty result.
    """
    q = docs.select(F.col(f"`{key}`").alias("doc_id"), stratum_of(stratum).alias("stratum"), measured(F.col(f"`{text}`")).alias("q"))
    flat = settle(q.select("doc_id", "stratum", "q.*"), "quality-counts")
    cells = {rule: cell(of(F.col)) for rule, of in RULES.items()}
    flat = flat.withColumns({"base_failed": base_failed(F.col), **cells})
    marked = flat.where(~F.col("base_failed")).join(one_label(labels, key, label), F.col("doc_id") == F.col("id"))
    # Rows repeated under one key are no independent trials: a document is one, by its row of the highest cells.
    highest = F.max(F.struct(*sorted(RULES), "stratum", "good")).alias("x")
    marked = marked.groupBy("id").agg(highest).select("id", "x.*")
    chosen = settle(cutoffs(marked, risk, error), "quality-cutoffs")
    wide = by_stratum(chosen)
    verdict = flat.join(wide, "stratum", "left").withColumn("rejected_by", rejecting(F.col))
    return verdict.drop("cuts").withColumn("kept", ~F.col("base_failed") & (F.col("rejected_by") == "")), chosen


def by_stratum(chosen: DataFrame) -> DataFrame:
    """A row per stratum with a map ``cuts`` from rule to cutoff, for the rules that have one."""
    return (
        chosen.where(F.col("cutoff").isNotNull()).groupBy("stratum")
        .agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("rule", F.col("cutoff").cast("int"))))).alias("cuts"))
    )


def rejecting(c) -> Column:
    """Names of the rules whose cutoff a row reaches; ``c`` gives the column of a rule's cell and of ``cuts``."""
    return F.concat_ws(",", *[F.when(c(rule) >= F.element_at(c("cuts"), F.lit(rule)), F.lit(rule)) for rule in sorted(RULES)])


def keep_good(docs: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR, *, text: str = "text", stratum: str = "lang", **names: str) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their own columns.

    The texts are measured a second time rather than joined back by key, so they never pass through a shuffle and
    repeated keys keep their own verdicts.
    """
    _, chosen = judge(docs, labels, risk, error, text=text, stratum=stratum, **names)
    s, q, cuts = spare(docs, "stratum", "q", "cuts")
    wide = by_stratum(chosen).select(F.col("stratum").alias(s), F.col("cuts").alias(cuts))
    rows = docs.withColumns({s: stratum_of(stratum), q: measured(F.col(f"`{text}`"))}).join(wide, s, "left")
    count = lambda name: F.col(f"{q}.{name}")
    cells = {rule: cell(of(count)) for rule, of in RULES.items()}
    hit = rejecting(lambda name: F.col(cuts) if name == "cuts" else cells[name])
    return rows.where(~base_failed(count) & (hit == "")).select(*[F.col(f"`{c}`") for c in docs.columns])
