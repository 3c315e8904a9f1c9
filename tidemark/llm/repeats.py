"""Removal of byte strings that repeat an earlier document, over whole texts.

A string of ``SPAN`` bytes is known by its anchor, the lowest hash among its ``GRAM``-byte pieces, so documents that share a
string share an anchor. Consecutive strings with the same anchor make a stretch. One exchange of anchor and stretch hashes settles two cases: an anchor that no other document
has, and a stretch that a smaller document holds in full. What remains are stretches that agree in part, mostly at the
ends of shared passages. Their bytes meet by anchor and are sorted into suffix arrays, whose common prefixes tell which
strings a smaller document has.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import settle
from .common import by_value, kept_in_worker
from .suffixes import SPAN, shared_windows

GRAM = 20
WINDOW = SPAN - GRAM + 1
BLOCK = 1 << 15
#: Bytes of text whose anchors a task gathers before it sends them on.
FLUSH = 4 << 20
#: Anchors a bucket should hold, and the most stretches of an anchor that go into one suffix array.
BUCKET = 700_000
TOGETHER = 512
#: Strings in a stretch, which only texts that repeat themselves reach, and bytes of text that are handled at once.
LONGEST = 4096
SLICE = 4 << 20
LAST = (1 << 63) - 1
LOW48 = np.uint64((1 << 48) - 1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables() -> dict:
    """Random values of the bytes, and powers of an odd base with their inverses modulo 2 ** 64."""
    kept = kept_in_worker("repeats")
    if kept.get("block") != BLOCK:
        kept["block"] = BLOCK
        base = 0x9E3779B97F4A7C15
        inverse = pow(base, -1, 1 << 64)
        for name, b in (("up", base), ("down", inverse)):
            powers = np.full(BLOCK + SPAN + 2, b, np.uint64)
            powers[0] = 1
            kept[name] = np.multiply.accumulate(powers)
        kept["bytes"], kept["others"] = (np.random.default_rng(n).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1) for n in (50, 51))
    return kept


def _slide(values: np.ndarray, size: int, best) -> np.ndarray:
    """Best of each window of ``size``, by doubling."""
    have = 1
    while 2 * have <= size:
        values = best(values[:-have], values[have:])
        have *= 2
    rest = size - have
    return best(values[:-rest], values[rest:]) if rest else values


def block_anchors(data: np.ndarray, firsts: np.ndarray, ends: np.ndarray):
    """Stretches of adjoining texts: arrays of text, first and last start of the stretch's strings, anchor, stretch hash.

    ``firsts`` and ``ends`` bound each text in ``data``. Texts shorter than ``SPAN`` have none.
    """
    n = len(data)
    if n < SPAN:
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    tables = _tables()
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(tables["bytes"][data] * tables["up"][:n], out=sums[1:])
    grams = mixed((sums[GRAM:] - sums[:-GRAM]) * tables["down"][:n - GRAM + 1])
    least = _slide(grams, WINDOW, np.minimum)
    # Strings that would run from one text into the next have no anchor.
    edge = np.zeros(n + 1, np.int32)
    fits = ends - firsts >= SPAN
    np.add.at(edge, firsts[fits], 1)
    np.add.at(edge, ends[fits] - SPAN + 1, -1)
    least[np.cumsum(edge[:-1])[:len(least)] <= 0] = 0
    heads = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    stops = np.r_[heads[1:], len(least)]
    kept = least[heads] > 0
    heads, stops = heads[kept], stops[kept]
    if len(heads) and (stops - heads).max() > LONGEST:
        # One piece of text over and over: its stretch is cut evenly.
        heads, stops = (np.concatenate(x) for x in zip(*[(np.arange(a, b, LONGEST), np.minimum(np.arange(a, b, LONGEST) + LONGEST, b)) for a, b in zip(heads, stops)]))
    last, stop = stops - 1, stops - 1 + SPAN
    stretch = mixed((sums[stop] - sums[heads]) * tables["down"][heads] + (stop - heads).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    text = np.searchsorted(firsts, heads, side="right") - 1
    return text, heads, last, least[heads] & LOW48, stretch & LOW48


def anchors(data: np.ndarray, offsets: np.ndarray):
    """``block_anchors`` over any number of texts of any length, in blocks; starts are relative to the text.

    A text longer than a block is cut into pieces that overlap by ``SPAN`` - 1 bytes, so that each string is in one piece.
    """
    i, count = 0, len(offsets) - 1
    while i < count:
        begin = offsets[i]
        if offsets[i + 1] - begin > BLOCK:
            for a in range(int(begin), int(offsets[i + 1]) - SPAN + 1, BLOCK - SPAN + 1):
                b = min(a + BLOCK, int(offsets[i + 1]))
                _, first, last, h, f = block_anchors(data[a:b], np.array([0]), np.array([b - a]))
                yield np.full(len(h), i), first + (a - begin), last + (a - begin), h, f
            i += 1
            continue
        j = int(np.searchsorted(offsets, begin + BLOCK, side="right")) - 1
        j = max(i + 1, min(j, count))
        bounds = offsets[i:j + 1] - begin
        text, first, last, h, f = block_anchors(data[begin:offsets[j]], bounds[:-1], bounds[1:])
        # Empty texts share their start with the next one; searchsorted took the last of them, which is the right one.
        yield text + i, first - bounds[text], last - bounds[text], h, f
        i = j


def slices(batches, rows: int = 512):
    """The rows of Arrow batches, few at a time: what is made of them in Python stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and each row's bounds in them; a null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def key_of(h: np.ndarray, f: np.ndarray) -> np.ndarray:
    """One number for an anchor and its stretch."""
    return mixed(h * np.uint64(0x9E3779B97F4A7C15) ^ f)


def packed48(x: np.ndarray) -> bytes:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked48(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


SENT = pa.schema([("bucket", pa.int32()), ("kind", pa.int8()), ("docs", pa.binary()), ("counts", pa.binary()), ("h", pa.binary()), ("f", pa.binary())])
SENT_DDL = "bucket int, kind tinyint, docs binary, counts binary, h binary, f binary"
#: Kinds of a sent run: anchors to be compared, the same known to be shared, stretches known to repeat a smaller document.
OPEN, SHARED, COVERED = 0, 1, 2


def _runs(docs: np.ndarray) -> tuple[bytes, bytes]:
    cuts = np.r_[0, np.flatnonzero(docs[1:] != docs[:-1]) + 1] if len(docs) else np.zeros(0, int)
    return docs[cuts].tobytes(), np.diff(np.r_[cuts, len(docs)]).astype(np.int32).tobytes()


def reduced(doc: np.ndarray, h: np.ndarray, f: np.ndarray):
    """Anchors of a flush by kind, each of an (anchor, stretch, document) once.

    Of a stretch that several documents hold only the smallest goes on; the others are covered. Of an anchor with several
    stretches in several documents one entry goes on, marked as shared, and the rest is told at once. So whatever a
    flush repeats is sent once, however hot it is.
    """
    order = np.lexsort((doc, f, h))
    doc, h, f = doc[order], h[order], f[order]
    keep = np.r_[True, (h[1:] != h[:-1]) | (f[1:] != f[:-1]) | (doc[1:] != doc[:-1])] if len(h) else np.zeros(0, bool)
    doc, h, f = doc[keep], h[keep], f[keep]
    head = np.r_[True, (h[1:] != h[:-1]) | (f[1:] != f[:-1])] if len(h) else keep
    covered = (doc[~head], h[~head], f[~head])
    doc, h, f = doc[head], h[head], f[head]
    group = np.cumsum(np.r_[True, h[1:] != h[:-1]]) - 1 if len(h) else np.zeros(0, int)
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(h) else np.zeros(0, int)
    if len(h):
        several = (np.minimum.reduceat(doc, starts) != np.maximum.reduceat(doc, starts))[group]
    else:
        several = np.zeros(0, bool)
    lead = np.zeros(len(h), bool)
    lead[starts] = True
    told = several & ~lead
    return {
        OPEN: (doc[~several], h[~several], f[~several]), SHARED: (doc[several & lead], h[several & lead], f[several & lead]),
        COVERED: covered, SHARED + 10: (doc[told], h[told], f[told]),
    }


def sent_rows(doc, h, f, buckets: int):
    """Packed rows of a flush. Told ones travel by document, past the comparison."""
    for kind, (d, a, s) in reduced(doc, h, f).items():
        to = (a % np.uint64(buckets)).astype(np.int64) if kind in (OPEN, SHARED) else (mixed(d.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((d, to))
        d, a, s, to = d[order], a[order], s[order], to[order]
        cuts = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]) if len(to) else np.zeros(0, int)
        for x, y in zip(cuts, np.r_[cuts[1:], len(to)]):
            docs, counts = _runs(d[x:y])
            yield int(to[x]), kind, docs, counts, packed48(a[x:y]), packed48(s[x:y])


def send(buckets: int):
    def run(batches):
        waiting, held = [], 0

        def flush():
            doc, h, f = (np.concatenate(x) for x in zip(*waiting))
            rows = list(sent_rows(doc, h, f, buckets))
            return pa.RecordBatch.from_arrays([pa.array(list(c), t.type) for c, t in zip(zip(*rows), SENT)], schema=SENT) if rows else None

        for batch in slices(batches):
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            data, offsets = as_bytes(batch.column(1))
            for text, _, _, h, f in anchors(data, offsets):
                waiting.append((ids[text], h, f))
            held += int(offsets[-1] - offsets[0])
            if held >= FLUSH and waiting:
                out = flush()
                waiting, held = [], 0
                if out is not None:
                    yield out
        if waiting and (out := flush()) is not None:
            yield out

    return run


def _unpacked(rows) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    doc, h, f, kind = [], [], [], []
    for k, docs, counts, a, s in rows:
        doc.append(np.repeat(np.frombuffer(docs, np.int64), np.frombuffer(counts, np.int32)))
        h.append(unpacked48(a))
        f.append(unpacked48(s))
        kind.append(np.full(len(doc[-1]), k))
    return tuple(map(np.concatenate, (doc, h, f, kind)))


def compare(batches):
    """Rows sorted by bucket to ``(doc, kind, keys)``: stretches of a document that are covered, and those still open."""
    kept, last = [], None
    for batch in slices(batches, 64):
        for bucket, *row in zip(*(column.to_pylist() for column in batch.columns)):
            if bucket != last and kept:
                yield from _compared(kept)
                kept = []
            kept.append(row)
            last = bucket
    if kept:
        yield from _compared(kept)


def _compared(kept: list):
    doc, h, f, kind = _unpacked(kept)
    kept.clear()
    told = kind > SHARED
    out = [(doc[told], np.where(kind[told] == COVERED, COVERED, SHARED), key_of(h[told], f[told]))]
    doc, h, f, kind = doc[~told], h[~told], f[~told], kind[~told]
    if len(h):
        order = np.lexsort((doc, f, h))
        doc, h, f, kind = doc[order], h[order], f[order], kind[order]
        starts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        group = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(h)]))
        shared = ((np.minimum.reduceat(doc, starts) != np.maximum.reduceat(doc, starts)) | (np.maximum.reduceat(kind, starts) == SHARED))[group]
        inner = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (f[1:] != f[:-1])])
        least = np.repeat(doc[inner], np.diff(np.r_[inner, len(h)]))
        # One stretch alone needs no further look: its smallest document keeps it and all others are covered.
        kinds_of = np.bincount(group[inner], minlength=len(starts))
        marked = (np.maximum.reduceat(kind, starts) == SHARED)[group]
        several = (kinds_of[group] > 1) | marked
        covered = shared & (doc > least)
        still = shared & several & (doc == least)
        key = key_of(h, f)
        out += [(doc[covered], np.full(covered.sum(), COVERED), key[covered]), (doc[still], np.full(still.sum(), SHARED), key[still])]
    doc, kind, key = (np.concatenate(x) for x in zip(*out))
    out.clear()
    if not len(doc):
        return
    order = np.lexsort((kind, doc))
    doc, kind, key = doc[order], kind[order], key[order]
    cuts = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (kind[1:] != kind[:-1])])
    blobs = [key[x:y].tobytes() for x, y in zip(cuts, np.r_[cuts[1:], len(doc)])]
    for x in range(0, len(cuts), 20_000):
        at = cuts[x:x + 20_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc[at]), pa.array(kind[at].astype(np.int8)), pa.array(blobs[x:x + 20_000], pa.binary())], names=["doc", "kind", "keys"]
        )


@by_value(T.BinaryType())
def squeezed(text):
    return zstandard.ZstdCompressor(level=1).compress(text.encode("utf-8", "replace"))


def unsqueezed(raw: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(raw)


def merged(first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes of overlapping or adjoining intervals."""
    order = np.argsort(first, kind="stable")
    first, stop = first[order], np.maximum.accumulate(stop[order])
    head = np.r_[True, first[1:] > stop[:-1]]
    return first[head], stop[np.r_[np.flatnonzero(head)[1:] - 1, len(stop) - 1]]


FOUND = pa.schema([
    ("uid", pa.int64()), ("doc", pa.int64()), ("raw", pa.binary()), ("covered", pa.binary()), ("h", pa.int64()), ("first", pa.int64()), ("bytes", pa.binary()),
])
FOUND_DDL = "uid bigint, doc bigint, raw binary, covered binary, h bigint, first bigint, bytes binary"


def _located(rows: list[tuple]) -> pa.RecordBatch:
    """One batch of ``locate``: the texts are laid end to end, so that their anchors are computed together."""
    texts = [unsqueezed(raw) for _, _, raw, _ in rows]
    offsets = np.cumsum([0] + [len(x) for x in texts])
    joined = b"".join(texts)
    # A reply holds for its own text only: its key is mixed with the text's number.
    salt = mixed(np.arange(1, len(rows) + 1, dtype=np.uint64))
    known = {SHARED: [], COVERED: []}
    for i, (_, _, _, replies) in enumerate(rows):
        for reply in replies:
            known[reply["kind"]].append(np.frombuffer(reply["keys"], np.uint64) ^ salt[i])
    shared, covered = (np.concatenate(known[k] or [np.zeros(0, np.uint64)]) for k in (SHARED, COVERED))
    parts = [(text, first, last, h, key_of(h, f) ^ salt[text]) for text, first, last, h, f in anchors(np.frombuffer(joined, np.uint8), offsets)]
    none = np.zeros(0, np.int64)
    text, first, last, h, key = (np.concatenate(x) for x in zip(*parts)) if parts else (none, none, none, none, none.view(np.uint64))
    gone = np.isin(key, covered)
    still = np.flatnonzero(np.isin(key, shared) & ~gone)
    owner, start, stop = text[gone], first[gone], last[gone] + SPAN
    cuts = np.searchsorted(owner, np.arange(len(rows) + 1))
    spans = []
    for i in range(len(rows)):
        a, b = start[cuts[i]:cuts[i + 1]], stop[cuts[i]:cuts[i + 1]]
        spans.append(np.stack(merged(a, b)).astype(np.int64).tobytes() if len(a) else b"")
    uids, docs = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)
    at = offsets[text[still]]
    pieces = [joined[a:b] for a, b in zip((at + first[still]).tolist(), (at + last[still] + SPAN).tolist())]
    n, m = len(rows), len(still)
    columns = [
        np.r_[uids, uids[text[still]]], np.r_[docs, docs[text[still]]], [r[2] for r in rows] + [None] * m, spans + [None] * m,
        [None] * n + h[still].tolist(), [None] * n + first[still].tolist(), [None] * n + pieces,
    ]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, FOUND)], schema=FOUND)


def locate(batches):
    """Texts with the keys of their covered and open stretches: the covered bytes, and each open stretch with its bytes."""
    waiting, size = [], 0
    for batch in slices(batches):
        for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
            waiting.append(row)
            size += 4 * len(row[2])
            if size >= SLICE:
                yield _located(waiting)
                waiting, size = [], 0
    if waiting:
        yield _located(waiting)


def sort_stretches(batches):
    """Open stretches, sorted by anchor, to the bytes that a smaller document's stretch holds: ``(uid, first, stop)``.

    Whole anchors are gathered up to about a megabyte and sorted together.
    """
    rows: list[tuple] = []
    size = 0

    def solved():
        distinct: dict[bytes, int] = {}
        least: list[int] = []
        for _, doc, _, text, _ in rows:
            i = distinct.setdefault(text, len(distinct))
            if i == len(least):
                least.append(doc)
            else:
                least[i] = min(least[i], doc)
        owners = np.array(least, np.int64)
        hits = shared_windows(list(distinct), owners)
        out = []
        for uid, doc, first, text, _ in rows:
            i = distinct[text]
            starts = np.arange(len(text) - SPAN + 1) if doc > owners[i] else hits[i]
            if len(starts):
                a, b = merged(starts + first, starts + first + SPAN)
                out += [(uid, int(x), int(y)) for x, y in zip(a, b)]
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*out)], names=["uid", "first", "stop"]) if out else None

    last = None
    for batch in slices(batches, 8192):
        for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if row[4] != last and size >= 1 << 20:
                if (out := solved()) is not None:
                    yield out
                rows, size = [], 0
            rows.append(row)
            size += len(row[3])
            last = row[4]
    if rows and (out := solved()) is not None:
        yield out


STRINGS = pa.schema([("bucket", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("doc", pa.binary()), ("uid", pa.binary()), ("first", pa.binary()), ("stop", pa.binary())])
STRINGS_DDL = "bucket int, a binary, b binary, doc binary, uid binary, first binary, stop binary"
#: Strings that a task gathers before it compares and sends them.
STRINGS_AT_ONCE = 400_000


def _string_hashes(data: np.ndarray, offsets: np.ndarray):
    """128 bits of every string of some stretches: row, place in the row, two hashes."""
    tables, n = _tables(), int(offsets[-1] - offsets[0])
    own = data[offsets[0]:offsets[-1]]
    hashes = []
    for name in ("bytes", "others"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(tables[name][own] * tables["up"][:n], out=sums[1:])
        hashes.append(mixed((sums[SPAN:] - sums[:-SPAN]) * tables["down"][:n - SPAN + 1]))
    counts = np.maximum(np.diff(offsets) - SPAN + 1, 0)
    row = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = offsets[:-1][row] - offsets[0] + place
    return row, place, hashes[0][at], hashes[1][at]


def _covered_strings(a, b, doc, uid, first):
    """Those that a smaller document has, as merged intervals ``(uid, first, stop)``; and the others as they came, each once."""
    order = np.lexsort((first, uid, doc, b, a))
    a, b, doc, uid, first = (x[order] for x in (a, b, doc, uid, first))
    if not len(a):
        return (uid, first, first), (a, b, doc, uid, first)
    heads = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    least = np.repeat(doc[heads], np.diff(np.r_[heads, len(a)]))
    gone = doc > least
    u, f = uid[gone], first[gone]
    order = np.lexsort((f, u))
    u, f = u[order], f[order]
    head = np.flatnonzero(np.r_[True, (u[1:] != u[:-1]) | (f[1:] > f[:-1] + SPAN)]) if len(u) else np.zeros(0, int)
    ends = np.r_[head[1:] - 1, len(u) - 1] if len(u) else head
    return (u[head], f[head], f[ends] + SPAN), tuple(x[~gone] for x in (a, b, doc, uid, first))


def send_strings(buckets: int):
    """Stretches of hot anchors to their strings by hash. What a task can tell by itself goes on as intervals: of a string in
    several documents only the smallest one's travels, so a hot string is a row per task, not one per document."""

    def run(batches):
        waiting, held = [], 0

        def flush():
            told, (a, b, doc, uid, first) = _covered_strings(*(np.concatenate(x) for x in zip(*waiting)))
            to = (a % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            cuts = np.flatnonzero(np.r_[True, np.diff(to[order]) != 0]) if len(to) else np.zeros(0, int)
            rows = []
            for x, y in zip(cuts, np.r_[cuts[1:], len(to)]):
                at = order[x:y]
                rows.append((int(to[at[0]]), *(v[at].tobytes() for v in (a, b, doc, uid, first)), None))
            if len(told[0]):
                rows.append((int(mixed(told[0][:1].view(np.uint64))[0] % np.uint64(buckets)), None, None, None, *(v.tobytes() for v in told)))
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), STRINGS)], schema=STRINGS)

        for batch in slices(batches, 256):
            uid, doc, first = (batch.column(i).to_numpy() for i in range(3))
            data, offsets = as_bytes(batch.column(3))
            i = 0
            while i < len(uid):
                j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + BLOCK, side="right")) - 1)
                j = min(j, len(uid))
                row, place, a, b = _string_hashes(data, offsets[i:j + 1])
                waiting.append((a, b, doc[i:j][row], uid[i:j][row], first[i:j][row] + place))
                held += len(row)
                i = j
            if held >= STRINGS_AT_ONCE:
                yield flush()
                waiting, held = [], 0
        if held:
            yield flush()

    return run


def compare_strings(batches):
    """Rows sorted by bucket to ``(uid, first, stop)``."""

    def solved(rows: list[dict]):
        parts = [[np.frombuffer(r[c], np.uint64 if c in "ab" else np.int64) for c in ("a", "b", "doc", "uid", "first")] for r in rows if r["a"] is not None]
        found = [_covered_strings(*(np.concatenate(x) for x in zip(*parts)))[0]] if parts else []
        found += [tuple(np.frombuffer(r[c], np.int64) for c in ("uid", "first", "stop")) for r in rows if r["a"] is None]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], names=["uid", "first", "stop"])

    kept = []
    for batch in slices(batches, 64):
        for row in batch.to_pylist():
            if kept and row["bucket"] != kept[0]["bucket"]:
                yield solved(kept)
                kept = []
            kept.append(row)
    if kept:
        yield solved(kept)


def hot_strings(stretches: DataFrame, buckets: int) -> DataFrame:
    """As ``sort_stretches``, for anchors with very many stretches: their strings meet by hash, so no anchor has to fit a task."""
    sent = stretches.select("uid", "doc", "first", "bytes").mapInArrow(send_strings(buckets), STRINGS_DDL)
    return sent.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(compare_strings, "uid bigint, first bigint, stop bigint")


RESULT = T.StructType([
    T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("kept", T.BinaryType()),
])


@by_value(RESULT)
def cut_out(raw, own, more):
    text = unsqueezed(raw)
    first, stop = np.frombuffer(own, np.int64).reshape(2, -1)
    if more:
        pairs = np.array([(m["first"], m["stop"]) for m in more], np.int64)
        first, stop = np.concatenate([first, pairs[:, 0]]), np.concatenate([stop, pairs[:, 1]])
    if not len(first):
        return 0, 0, text
    first, stop = merged(first, stop)
    pieces, at = [], 0
    for a, b in zip(first.tolist(), stop.tolist()):
        pieces.append(text[at:a])
        at = b
    return int((stop - first).sum()), len(first), b"".join(pieces) + text[at:]


def repeated_strings(docs: DataFrame, *, key: str = "doc_id", text: str = "text", kept: bool = False) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` of every row, and with ``kept`` the bytes left.

    A byte goes if a ``SPAN``-byte string that covers it also starts in a row of a smaller key. Strings are judged on the
    input, not on what is left. Rows of equal keys do not take from each other; a row without a key counts as larger than
    all with one. A null text is empty, a text shorter than ``SPAN`` bytes keeps all. Rows repeated in the table each come
    back; an empty table gives an empty result. Other columns are not read.
    """
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    order = F.coalesce(F.col(f"`{key}`").cast("bigint"), F.lit(LAST))
    rows = docs.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), order.alias("doc"), value.alias("text"))
    uid = F.xxhash64("doc", "text")
    facts = settle(
        rows.select("doc_id", uid.alias("uid"), F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("whole")),
        "repeats-texts",
    )
    total = facts.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(64, -(-2 * total // ((WINDOW + 1) * BUCKET)))
    sent = rows.select("doc", "text").mapInArrow(send(int(buckets)), SENT_DDL)
    replies = sent.repartition(int(buckets), "bucket").sortWithinPartitions("bucket").mapInArrow(compare, "doc bigint, kind tinyint, keys binary")
    asked = replies.groupBy("doc").agg(F.collect_list(F.struct("kind", "keys")).alias("replies"))
    joined = rows.select("doc", uid.alias("uid"), squeezed("text").alias("raw")).join(asked, "doc").select("uid", "doc", "raw", "replies")
    found = settle(joined.mapInArrow(locate, FOUND_DDL), "repeats-found")
    stretches = found.where("h IS NOT NULL").select("uid", "doc", "first", "bytes", "h")
    # Written first, the few hot anchors have a known size, and Spark need not move the stretches to look them up.
    hot = settle(stretches.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > TOGETHER).select("h"), "repeats-hot")
    few = stretches.join(hot, "h", "left_anti").select("uid", "doc", "first", "bytes", "h")
    many = stretches.join(hot, "h", "left_semi").select("uid", "doc", "first", "bytes")
    solved = few.repartition("h").sortWithinPartitions("h").mapInArrow(sort_stretches, "uid bigint, first bigint, stop bigint").union(hot_strings(many, 4 * int(buckets)))
    spans = solved.groupBy("uid").agg(F.collect_set(F.struct("first", "stop")).alias("found"))
    texts = found.where("raw IS NOT NULL").select("uid", "raw", "covered").dropDuplicates(["uid"])
    changed = texts.join(spans, "uid", "left").select("uid", cut_out("raw", "covered", "found").alias("x")).where("x.n_removed > 0")
    columns = ["uid", F.col("x.n_removed").alias("n_removed"), F.col("x.n_spans").alias("n_spans"), F.sha2("x.kept", 256).alias("left")]
    changed = changed.select(*columns, *[F.col("x.kept").alias("kept")] * kept)
    out = facts.join(changed, "uid", "left")
    return out.select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("bigint").alias("n_spans"), F.coalesce("left", "whole").alias("kept_sha256"), *["kept"] * kept,
    )
