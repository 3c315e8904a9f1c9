"""Personal data: fixed patterns, and further spans by weak supervision.

Candidates are the fixed patterns' matches, tokens with a digit or an at sign, and phone-like runs of digits. Labelers by
pattern, gazetteer and context vote on each. Expectation-maximisation over the counted vote patterns estimates how
reliable each labeler is and how likely each pattern is private data. With these likelihoods a final classifier is trained
on the spans' own shape and neighbourhood; it decides on every candidate of the corpus.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import settle
from .common import by_value

KINDS = ("email", "ip", "card", "phone")
#: Kinds the method adds: credentials, and anything else private that no fixed pattern takes.
ADDED = ("secret", "other")
WIDTH = 1024
PER_PATTERN = 200
SAMPLE = 8000
SURE = 0.8

# An address has one at sign; the part before it is taken from the characters to its left.
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind's place, end)`` of the fixed patterns' matches, sorted."""
    out = []
    if "@" in text:
        last = 0
        for m in DOMAIN.finditer(text):
            start = m.start()
            while start > last and text[start - 1] in LOCAL_CHARS:
                start -= 1
            if start < m.start():
                out.append((start, 0, m.end()))
                last = m.end()
    if re.search("[0-9]", text):
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            if m.end() - m.start() <= 40:
                digits = re.sub("[^0-9]", "", m[0])
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(c.isascii() and c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


SIGNS = re.compile("[0-9@]")
EDGES = frozenset(" \t\n\r\x0b\x0c\"'<>()[]{},;|")
NUMBERS = re.compile(r"(?<![0-9A-Za-z+])\(?[0-9][0-9().\-/ ]{5,28}[0-9](?![0-9A-Za-z])")
WORD = re.compile(r"[^\W\d_]+")


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Spans to be voted on: the fixed matches, then phone-like runs and tokens that overlap nothing before them."""
    taken = [(s, e) for s, _, e in base]
    if SIGNS.search(text) is None:
        return taken
    covered = sorted(taken)
    out = sorted(set(taken))

    found = [(m.start(), m.end()) for m in NUMBERS.finditer(text) if 7 <= sum(c.isdigit() for c in m[0]) <= 15]
    at = 0
    while (m := SIGNS.search(text, at)) is not None:
        start = m.start()
        while start > at and text[start - 1] not in EDGES:
            start -= 1
        end = m.end()
        while end < len(text) and text[end] not in EDGES:
            end += 1
        at = end
        stop = end
        while stop > start and text[stop - 1] in ".:!?":
            stop -= 1
        if stop - start >= 6:
            found.append((start, stop))
    ends, fresh = -1, []
    for start, end in sorted(found):
        if start >= ends:
            fresh.append((start, end))
            ends = end
    # Both lists are in order: a fresh span is free if it ends before the next fixed one and starts after all before it.
    i, reach = 0, 0
    for start, end in fresh:
        while i < len(covered) and covered[i][0] < end:
            reach = max(reach, covered[i][1])
            i += 1
        if reach <= start:
            out.append((start, end))
    return sorted(out)


# Words that stand before private data and words that stand before plain numbers.
PRIVATE_BEFORE = frozenset(
    "password passwd pwd token secret key apikey contact call phone tel telephone mobile mail email write reach card visa iban account "
    "ssn host ip login user passwort kontakt telefon konto schlüssel courriel téléphone contacter carte compte contraseña correo "
    "teléfono tarjeta cuenta clave".split()
)
PLAIN_BEFORE = frozenset(
    "version page chapter figure table section year in since nc by sa license seite kapitel jahr seit année page depuis página año desde "
    "capítulo lizenz licence licencia release art no nr vol".split()
)
PRIVATE_NAMES = frozenset("com org net edu gov io de fr es co uk info mail example gmail yahoo outlook akia ghp sk pk xoxb".split())

# A run of hexadecimal digits without any letter is a secret only behind a name.
SECRET = re.compile(r"(?:[A-Z]{4}[0-9A-Z]{16}|[A-Za-z_-]+[=:][0-9a-f]{16,}|(?=[0-9]*+[a-f])[0-9a-f]{16,}|(?:gh[pous]|sk|pk|xox[abp])[_-][A-Za-z0-9_-]{16,})")
PLAIN = re.compile(r"(?:[vV]?[0-9]{1,4}(?:[.,:/-][0-9]{1,4}){0,2}[%.]?|[0-9]{1,2}(?:st|nd|rd|th)|[0-9]+(?:px|kg|km|cm|mm|mb|gb|h|min|s)?)")
MIXED = re.compile(r"(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9+/=_-]{14,}")


def before(text: str, start: int) -> str:
    """The last word in the 24 characters before a span, lower-cased."""
    words = WORD.findall(text[max(0, start - 24):start])
    return words[-1].lower() if words else ""


def votes(text: str, start: int, end: int, fixed: bool) -> str:
    """One character per labeler: ``+`` private, ``-`` not, ``0`` no opinion."""
    span = text[start:end]
    word = before(text, start)
    inner = {w.lower() for w in WORD.findall(span)}
    digits = sum(c.isdigit() for c in span)
    out = (
        1 if fixed else -1 if digits >= 14 and CARD.fullmatch(span) else 0,
        1 if SECRET.fullmatch(span) else 0,
        -1 if PLAIN.fullmatch(span) and not fixed else 0,
        1 if "@" in span or inner & PRIVATE_NAMES or any(w.startswith("akia") for w in inner) else 0,
        1 if word in PRIVATE_BEFORE or inner & PRIVATE_BEFORE else -1 if word in PLAIN_BEFORE else 0,
        1 if MIXED.fullmatch(span) else -1 if len(span) < 8 and digits < 5 else 0,
        1 if digits >= 9 else -1 if digits <= 3 and "@" not in span else 0,
    )
    return "".join("-0+"[v + 1] for v in out)


LABELERS = 7


def features(text: str, start: int, end: int) -> list[int]:
    """Places of a span's features in a vector of ``WIDTH``: shape, length, kinds of characters, words beside it."""
    span = text[start:end]
    shape = re.sub(r"[0-9]", "9", re.sub(r"[^\W\d_]", lambda m: "A" if m[0].isupper() else "a", span))
    named = [f"len{min(len(span) // 4, 16)}", f"digits{min(sum(c.isdigit() for c in span), 20)}", f"before {before(text, start)}", "bias"]
    after = WORD.match(text, end + 1)
    named.append(f"after {after[0].lower() if after else ''}")
    marked = f"^{shape}$"
    named += {marked[i:i + 3] for i in range(len(marked) - 2)}
    named += [f"has {c}" for c in "@.-+()=_:/ " if c in span]
    return sorted({zlib.crc32(x.encode()) % WIDTH for x in named})


@dataclass(frozen=True)
class Reliabilities:
    """``prior`` of private data and, per labeler, class (0 plain, 1 private) and vote (-, 0, +), the vote's probability."""

    prior: float
    table: np.ndarray

    def posterior(self, pattern: str) -> float:
        log = np.log([1 - self.prior, self.prior])
        for i, v in enumerate(pattern):
            log = log + np.log(self.table[i, :, "-0+".index(v)])
        return float(1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500))))


def estimate(patterns: list[str], counts: list[int], rounds: int = 100) -> Reliabilities:
    """Expectation-maximisation over vote patterns with their counts; no true label is used.

    It starts from the majority of votes. A labeler that votes for a class is held to be better than chance, by pseudo-counts.
    """
    n = np.array(counts, float)
    coded = np.array([["-0+".index(v) for v in p] for p in patterns]).reshape(-1, LABELERS)
    lean = (coded - 1).sum(axis=1)
    private = np.where(lean > 0, 0.9, np.where(lean < 0, 0.1, 0.5))
    smooth = np.array([[2.0, 2.0, 1.0], [1.0, 2.0, 2.0]])
    for _ in range(rounds):
        weight = np.stack([(1 - private) * n, private * n])
        prior = (weight[1].sum() + 1) / (n.sum() + 2)
        table = np.empty((LABELERS, 2, 3))
        for i in range(LABELERS):
            for v in range(3):
                table[i, :, v] = weight[:, coded[:, i] == v].sum(axis=1)
            table[i] += smooth
            table[i] /= table[i].sum(axis=1, keepdims=True)
        found = Reliabilities(float(prior), table)
        new = np.array([found.posterior(p) for p in patterns])
        if np.abs(new - private).max(initial=0) < 1e-9:
            break
        private = new
    return found


def train(rows: list[list[int]], wanted: np.ndarray, weights: np.ndarray, steps: int = 300) -> np.ndarray:
    """Logistic regression on binary features towards soft labels, by full-batch Adagrad with a small penalty."""
    x = np.zeros((len(rows), WIDTH), np.float32)
    for i, places in enumerate(rows):
        x[i, places] = 1
    w, seen = np.zeros(WIDTH), np.full(WIDTH, 1e-8)
    share = weights / weights.sum()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ ((p - wanted) * share) + 1e-4 * w
        seen += gradient ** 2
        w -= 0.3 * gradient / np.sqrt(seen)
    return w


def likely(w: np.ndarray, places: list[int]) -> float:
    return float(1 / (1 + np.exp(-np.clip(w[places].sum(), -30, 30))))


FOUND = T.ArrayType(T.StructType([
    T.StructField("votes", T.StringType()), T.StructField("mark", T.LongType()), T.StructField("places", T.ArrayType(T.IntegerType()))
]))


@by_value(FOUND)
def voted(value):
    text = value or ""
    base = base_spans(text)
    fixed = {(s, e) for s, _, e in base}
    rows = []
    for start, end in candidates(text, base):
        near = text[max(0, start - 24):end + 8].encode("utf-8", "replace")
        mark = int.from_bytes(hashlib.blake2b(near, digest_size=7).digest(), "big")
        rows.append((votes(text, start, end, (start, end) in fixed), mark, features(text, start, end)))
    return rows


def fit(docs: DataFrame, *, text: str = "text", per_pattern: int = PER_PATTERN, sample: int = SAMPLE) -> np.ndarray | None:
    """Weights of the final classifier, or None where the corpus has no candidate.

    The vote patterns of all candidates are counted (at most 3 to the number of labelers rows reach the driver). The
    classifier is trained on a bounded sample: at most ``per_pattern`` candidates of a pattern, the ones with the smallest
    hash of their neighbourhood, ``sample`` in all, weighted by how often their pattern occurs.
    """
    rows = settle(docs.select(F.explode(voted(F.col(f"`{text}`"))).alias("x")).select("x.*"), "pii-candidates")
    counted = sorted((r[0], r[1]) for r in rows.groupBy("votes").count().collect())
    if not counted:
        return None
    patterns, counts = [p for p, _ in counted], [c for _, c in counted]
    truth = estimate(patterns, counts)
    each = max(1, min(per_pattern, sample // len(patterns)))
    nth = F.row_number().over(Window.partitionBy("votes").orderBy("mark", "places"))
    drawn = rows.withColumn("nth", nth).where(F.col("nth") <= each).drop("nth").collect()
    drawn.sort(key=lambda r: (r["votes"], r["mark"], r["places"]))
    of = dict(counted)
    got = {p: sum(1 for r in drawn if r["votes"] == p) for p in patterns}
    wanted = np.array([truth.posterior(r["votes"]) for r in drawn])
    # The square root keeps rare patterns from being outvoted by common ones.
    weights = np.array([np.sqrt(of[r["votes"]]) / got[r["votes"]] for r in drawn])
    return train([list(r["places"]) for r in drawn], wanted, weights)


def all_spans(text: str, w: np.ndarray | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Fixed spans, and fixed and added ones together, as ``(start, kind's place, end)``."""
    base = base_spans(text)
    if w is None:
        return base, base
    fixed = {(s, e) for s, _, e in base}
    more = []
    for start, end in candidates(text, base):
        if (start, end) not in fixed and likely(w, features(text, start, end)) >= SURE:
            secret = SECRET.fullmatch(text, start, end) or MIXED.fullmatch(text, start, end)
            more.append((start, len(KINDS) + (0 if secret else 1), end))
    return base, sorted(base + more)


def listed(spans: list[tuple[int, int, int]]) -> str:
    names = KINDS + ADDED
    return ",".join(f"{names[k]}:{s}:{e}" for s, k, e in spans)


def span_columns(w: np.ndarray | None, text: Column) -> Column:
    """Struct ``n_email, n_ip, n_card, n_phone, base, spans``: counts of the fixed spans, and both lists as text."""
    kind = T.StructType([T.StructField(f"n_{k}", T.LongType()) for k in KINDS] + [T.StructField("base", T.StringType()), T.StructField("spans", T.StringType())])

    @by_value(kind)
    def found(value):
        base, both = all_spans(value or "", w)
        kinds = [k for _, k, _ in base]
        return (*[kinds.count(i) for i in range(len(KINDS))], listed(base), listed(both))

    return found(text)


def find_private(docs: DataFrame, w: np.ndarray | None = None, *, fitted: bool = False, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, counts of the fixed kinds, ``base`` and ``spans`` (``kind:start:end`` in code points) of every row.

    Without ``fitted`` the classifier is first fitted on ``docs`` itself. A null text counts as empty. A text of any length
    is read whole, and so is a token of any length. Rows repeated in the table each come
    back; an empty table gives an empty result. Equal starts are ordered by kind. Other columns are not read.
    """
    w = w if fitted else fit(docs, text=text)
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), span_columns(w, F.col(f"`{text}`")).alias("x"))
    return rows.select("doc_id", "x.*")


def redacted(value: str, w: np.ndarray | None) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first, then the longest, counts."""
    names = KINDS + ADDED
    out, at = [], 0
    for start, kind, end in sorted(all_spans(value, w)[1], key=lambda x: (x[0], -x[2], x[1])):
        if start >= at:
            out += [value[at:start], f"[{names[kind].upper()}]"]
        at = max(at, end)
    return "".join(out) + value[at:]


def redact(docs: DataFrame, *, text: str = "text", size: str | None = "n_chars") -> DataFrame:
    """The rows of ``docs`` with private spans in the text replaced, and ``size`` (if there) set to the new length.

    A null text stays null. Nothing of an overlapped span is left in the text.
    """
    w = fit(docs, text=text)

    @by_value(T.StringType())
    def clean(value):
        return None if value is None else redacted(value, w)

    out = docs.withColumn(text, clean(F.col(f"`{text}`")))
    if size in docs.columns:
        out = out.withColumn(size, F.length(F.col(f"`{text}`")).cast(docs.schema[size].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
