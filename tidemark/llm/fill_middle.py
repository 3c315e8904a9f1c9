"""Fill-in-the-middle texts: prefix, middle and suffix change places, for a whole batch of texts at once.

The texts of a batch lie one after another in one buffer of bytes. A scan over it finds where each cut falls. Every piece
between two cuts moves by a constant number of bytes, so the change of that number is noted at the first byte of each
piece (a difference array), its running sum is the displacement of every byte, and one scatter builds all outputs. Reading
back by the same displacements restores the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import spare

#: Fixed markers and shares of the three forms.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, SPM = 90, 20
#: Bytes whose displacements are held at once; a longer text takes several rounds.
BLOCK = 1 << 20


def draws(doc: int | None) -> list[int]:
    """Four numbers that only depend on the document's id; without one, on its absence."""
    digest = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    return [int(digest[k:k + 8], 16) for k in range(0, 32, 8)]


def _blocks(size: int) -> Iterator[tuple[int, int]]:
    for low in range(0, size, BLOCK):
        yield low, min(low + BLOCK, size)


def _points(buffer: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Code points that begin before each of the ascending byte places."""
    out, before = np.zeros(len(places), np.int64), 0
    for low, high in _blocks(len(buffer)):
        running = np.cumsum((buffer[low:high] & 0xC0) != 0x80)
        a, b = np.searchsorted(places, [low, high], side="right")
        out[a:b] = before + running[places[a:b] - low - 1]
        before += int(running[-1])
    return out


def _places(buffer: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Byte places of the ascending code points; one behind the last is the end."""
    out, before = np.full(len(points), len(buffer), np.int64), 0
    for low, high in _blocks(len(buffer)):
        first = np.flatnonzero((buffer[low:high] & 0xC0) != 0x80)
        a, b = np.searchsorted(points, [before, before + len(first)])
        out[a:b] = low + first[points[a:b] - before]
        before += len(first)
    return out


def _displaced(size: int, starts: np.ndarray, shifts: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """For each block of bytes the place every byte moves to. Pieces begin at the ascending ``starts``; empty ones add up."""
    change = np.diff(shifts, prepend=0)
    carried = 0
    for low, high in _blocks(size):
        a, b = np.searchsorted(starts, [low, high])
        steps = np.zeros(high - low, np.int64)
        np.add.at(steps, starts[a:b] - low, change[a:b])
        steps[0] += carried
        moves = np.cumsum(steps)
        carried = int(moves[-1])
        yield low, high, moves + np.arange(low, high)


def scatter(buffer: np.ndarray, size: int, starts: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    out = np.zeros(size, np.uint8)
    for low, high, to in _displaced(len(buffer), starts, shifts):
        out[to] = buffer[low:high]
    return out


def gather(buffer: np.ndarray, size: int, starts: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    out = np.empty(size, np.uint8)
    for low, high, source in _displaced(size, starts, shifts):
        out[low:high] = buffer[source]
    return out


def _buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of strings, nulls empty, and the places where its rows begin, with the end."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def _strings(buffer: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(buffer))


def _layout(bounds: np.ndarray, cuts: np.ndarray, forms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bounds of the outputs, first bytes of all pieces and their displacements. ``cuts`` has two rows of byte places."""
    sizes = np.diff(bounds)
    extra = np.where(forms == "plain", 0, len(PREFIX + SUFFIX + MIDDLE))
    to = np.concatenate([[0], np.cumsum(sizes + extra)])
    begin, first, second, end = bounds[:-1], cuts[0], cuts[1], bounds[1:]
    prefix, middle, suffix = first - begin, second - first, end - second
    psm, spm = forms == "psm", forms == "spm"
    at_prefix = to[:-1] + np.select([psm, spm], [3, 6 + suffix], 0)
    at_suffix = to[:-1] + np.select([psm, spm], [6 + prefix, 3], prefix + middle)
    at_middle = to[:-1] + np.where(psm | spm, 9 + prefix + suffix, prefix)
    starts = np.stack([begin, first, second], 1).ravel()
    return to, starts, np.stack([at_prefix, at_middle, at_suffix], 1).ravel() - starts


def _mark(out: np.ndarray, to: np.ndarray, bounds: np.ndarray, cuts: np.ndarray, forms: np.ndarray) -> None:
    begin, prefix, suffix = to[:-1], cuts[0] - bounds[:-1], bounds[1:] - cuts[1]
    for form, places in (
        ("psm", ((PREFIX, 0 * prefix), (SUFFIX, 3 + prefix), (MIDDLE, 6 + prefix + suffix))),
        ("spm", ((SUFFIX, 0 * prefix), (PREFIX, 3 + suffix), (MIDDLE, 6 + prefix + suffix))),
    ):
        use = forms == form
        for marker, place in places:
            at = (begin + place)[use]
            for k, byte in enumerate(marker):
                out[at + k] = byte


def rearrange(column: pa.Array, docs: list[int | None]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Outputs, code points, forms, and code points of prefix and middle."""
    buffer, bounds = _buffer(column)
    points = _points(buffer, bounds)
    n = np.diff(points)
    h = np.array([draws(d) for d in docs], np.int64).reshape(-1, 4)
    raw = memoryview(buffer)
    marked = np.array([any(m in part for m in (PREFIX, SUFFIX, MIDDLE)) for part in (bytes(raw[a:b]) for a, b in zip(bounds, bounds[1:]))], bool)
    forms = np.where((n == 0) | marked | (h[:, 2] % 100 >= PLAIN), "plain", np.where(h[:, 3] % 100 < SPM, "spm", "psm"))
    first, second = np.sort(np.stack([h[:, 0] % (n + 1), h[:, 1] % (n + 1)]), axis=0)
    order = np.stack([points[:-1] + first, points[:-1] + second], 1).ravel()
    cuts = _places(buffer, order).reshape(-1, 2).T
    to, starts, shifts = _layout(bounds, cuts, forms)
    out = scatter(buffer, int(to[-1]), starts, shifts)
    _mark(out, to, bounds, cuts, forms)
    return _strings(out, to), n, forms, first, second - first


def restored_texts(column: pa.Array, forms: np.ndarray) -> pa.Array:
    """The texts that ``rearrange`` was given, from outputs and forms alone: markers are unique in a text that has them."""
    buffer, to = _buffer(column)
    raw = memoryview(buffer)
    sizes = np.zeros((len(forms), 3), np.int64)
    for i, (a, b, form) in enumerate(zip(to, to[1:], forms)):
        whole = bytes(raw[a:b])
        if form == "plain":
            sizes[i, 0] = b - a
            continue
        second, third = whole.index(SUFFIX if form == "psm" else PREFIX), whole.index(MIDDLE)
        prefix, suffix = (second - 3, third - second - 3) if form == "psm" else (third - second - 3, second - 3)
        sizes[i] = prefix, b - a - third - 3, suffix
    bounds = np.concatenate([[0], np.cumsum(sizes.sum(1))])
    cuts = np.stack([bounds[:-1] + sizes[:, 0], bounds[:-1] + sizes[:, 0] + sizes[:, 1]])
    _, starts, shifts = _layout(bounds, cuts, forms)
    return _strings(gather(buffer, int(bounds[-1]), starts, shifts), bounds)


def fill_middle(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n``, ``form``, ``prefix_chars``, ``middle_chars``, ``output`` of every row.

    Null text counts as empty, which stays plain; so does a text that holds a marker. Every row gives a row, and rows of one
    id and text give the same one; a row without an id draws from the empty id. Other columns are not read. A text of any
    length is handled whole, with displacements of one block of bytes in memory at a time.
    """
    shape = pa.schema([
        ("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string()),
    ])

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            output, n, forms, prefix, middle = rearrange(batch.column(1), batch.column(0).to_pylist())
            plain = forms == "plain"
            columns = [batch.column(0), pa.array(n), pa.array(forms.tolist()), pa.array(prefix, mask=plain), pa.array(middle, mask=plain), output]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, shape)], schema=shape)

    rows = docs.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restore(rows: DataFrame, *, output: str = "output", form: str = "form") -> DataFrame:
    """The rows with a column ``restored``, rebuilt from ``output`` and ``form``. A null output is empty, a null form plain."""
    [text, kind] = spare(rows, "text", "kind")
    sent = rows.drop("restored").withColumn(text, F.col(f"`{output}`")).withColumn(kind, F.coalesce(F.col(f"`{form}`"), F.lit("plain")))
    kept = [c for c in sent.columns if c not in (text, kind)]
    schema = sent.select(*[F.col(f"`{c}`") for c in kept], F.lit("").cast("string").alias("restored")).schema

    def run(batches):
        for batch in batches:
            back = restored_texts(batch.column(text), np.array(batch.column(kind).to_pylist(), object))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], back], [*kept, "restored"])

    return sent.mapInArrow(run, schema)
