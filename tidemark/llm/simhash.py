"""Near-duplicates by SimHash, found through deletion-variant signatures.

A 64-bit fingerprint is cut into two segments. If two fingerprints differ in at most three bits, one of the segments
differs in at most one. Each segment is indexed under 32 variants, in each of which one bit is a wildcard: segments that
differ in at most one bit agree in a variant. Equal variants meet, and the whole fingerprints are compared.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import settle
from .common import by_value, spare
from .components import components

DISTANCE = 3
SHINGLE = 3
SEED = 42
CHUNK = 1 << 16
PAIRWISE = 1 << 19


def fingerprint(text: str | None) -> int:
    """Unsigned fingerprint of a text: A-Z lower-cased, words between ASCII white space, three-word shingles with repeats."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    total = len(words) - SHINGLE + 1
    ones = np.zeros(64, np.int64)
    hashed = map(partial(xxhash.xxh64_intdigest, seed=SEED), map(b" ".join, zip(words, words[1:], words[2:])))
    for start in range(0, total, CHUNK):
        part = np.fromiter(hashed, np.uint64, min(CHUNK, total - start))
        bits = np.unpackbits(part.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total, bitorder="little").tobytes(), "little")


@by_value(T.LongType())
def fingerprints(text):
    found = fingerprint(text)
    return found - (1 << 64) if found >> 63 else found


def variants(fingerprint: Column) -> Column:
    """Array of a fingerprint's 64 variants: segment, wildcard's place and the segment's bits with the wildcard cleared."""
    out = []
    for segment in range(2):
        half = F.shiftrightunsigned(fingerprint, 32) if segment else fingerprint.bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint"))
        for place in range(32):
            clear = F.lit(0xFFFFFFFF ^ (1 << place)).cast("bigint")
            out.append(half.bitwiseAND(clear).bitwiseOR(F.lit((segment << 37) | (place << 32)).cast("bigint")))
    return F.array(*out)


def near_masks(bits: list[int], distance: int = DISTANCE) -> list[int]:
    """All masks of at least one and at most ``distance`` of the given single-bit values."""
    level, out = [(0, 0)], []
    for _ in range(distance):
        level = [(m | b, i + 1) for m, start in level for i, b in enumerate(bits[start:], start)]
        out += [m for m, _ in level]
    return out


def walked_forest(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of a spanning forest over distinct values: each value looks once through those not yet reached."""
    left = np.arange(len(values))
    waiting, firsts, seconds = [], [], []
    while len(left):
        if not waiting:
            waiting.append(int(left[0]))
            left = left[1:]
        i = waiting.pop()
        near = np.bitwise_count(values[left] ^ values[i]) <= DISTANCE
        if near.any():
            found = left[near]
            firsts.append(np.full(len(found), i))
            seconds.append(found)
            waiting += found.tolist()
            left = left[~near]
    none = np.zeros(0, np.int64)
    return np.concatenate(firsts or [none]), np.concatenate(seconds or [none])


def probed_forest(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``walked_forest`` for sorted values, by looking each up under every mask of the bits in which they vary.

    The values of a bucket share 31 bits, so there are at most 6,017 masks and the work per value has a bound.
    """
    parent = np.arange(len(values)).tolist()

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    vary = int(np.bitwise_or.reduce(values ^ values[0]))
    out = []
    for mask in near_masks([1 << i for i in range(64) if vary >> i & 1]):
        other = values ^ np.uint64(mask)
        at = np.minimum(np.searchsorted(values, other), len(values) - 1)
        for i in np.flatnonzero((values[at] == other) & (values < other)).tolist():
            a, b = root(i), root(int(at[i]))
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((i, int(at[i])))
    pairs = np.array(out, np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def links_of_buckets(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links inside whole buckets, sorted by key and value. Small buckets by shifted comparison, larger ones as a forest."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    small = 8
    firsts, seconds = [], []
    size_at = np.repeat(sizes, sizes)
    keep = (size_at > 1) & (size_at <= small)
    k, v = keys[keep], values[keep]
    place = (k >> 32) & 31
    shift_by = np.where(k >> 37 == 1, 32, 0).astype(np.uint64)
    for step in range(1, min(small, len(k))):
        same = k[step:] == k[:-step]
        if not same.any():
            break
        apart = v[step:] ^ v[:-step]
        # Equal segments agree in all 32 variants: take them in the first.
        half = (apart >> shift_by[step:]) & np.uint64(0xFFFFFFFF)
        hit = same & (np.bitwise_count(apart) <= DISTANCE) & ((half != 0) | (place[step:] == 0))
        firsts.append(v[:-step][hit])
        seconds.append(v[step:][hit])
    for at in np.flatnonzero(sizes > small):
        own = values[starts[at]:starts[at] + sizes[at]]
        i, j = walked_forest(own) if len(own) <= PAIRWISE else probed_forest(own)
        firsts.append(own[i])
        seconds.append(own[j])
    none = np.zeros(0, np.uint64)
    return np.concatenate(firsts or [none]), np.concatenate(seconds or [none])


def _join_variants(batches):
    """Sorted (key, fp) batches to links; the last bucket of a batch waits for the next."""
    keys, values = np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def linked(k, v):
        a, b = links_of_buckets(k, v)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    for batch in batches:
        keys = np.concatenate([keys, batch.column(0).to_numpy()])
        values = np.concatenate([values, batch.column(1).to_numpy().view(np.uint64)])
        if not len(keys) or keys[0] == keys[-1]:
            continue
        whole = int(np.searchsorted(keys, keys[-1]))
        yield linked(keys[:whole], values[:whole])
        keys, values = keys[whole:], values[whole:]
    if len(keys):
        yield linked(keys, values)


def sort_unsigned(column: Column) -> Column:
    """A signed column whose order is the unsigned order of the bits."""
    return column.bitwiseXOR(F.lit(-(1 << 63)).cast("bigint"))


def near_links(prints: DataFrame) -> DataFrame:
    """Distinct links ``(a, b)`` between distinct fingerprints ``fp`` (signed) that differ in at most three bits.

    Links within a bucket of more than 8 fingerprints are a spanning forest of all of them: nothing that can be reached
    is lost, and a group of thousands gives thousands of links, not their square.
    """
    pairs = prints.select(F.explode(variants(F.col("fp"))).alias("key"), "fp")
    met = pairs.repartition("key").sortWithinPartitions("key", sort_unsigned(F.col("fp"))).mapInArrow(_join_variants, "a bigint, b bigint")
    return met.distinct()


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` and ``fp`` (signed) of every row.

    ``component_id`` is the smallest key that links of at most three differing bits reach. A null, empty or blank text has
    fingerprint zero and is linked like any other. Rows without a key take part; a component of such rows alone has a
    null id. Rows repeated in the table each come back. An empty table gives an empty result. Other columns are not read.
    """
    rows = settle(docs.select(F.col(f"`{key}`").alias("doc_id"), fingerprints(F.col(f"`{text}`")).alias("fp")), "fingerprints")
    prints = settle(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    reached = settle(components(near_links(prints)).join(prints.withColumnRenamed("fp", "node"), "node"), "components")
    roots = reached.groupBy("root").agg(F.min("least").alias("of_root"))
    linked = reached.join(roots, "root").select(F.col("node").alias("fp"), "of_root")
    # A linked component takes its own smallest key, even a null one; an unlinked fingerprint its rows' smallest.
    labels = prints.join(linked, "fp", "left").select("fp", F.coalesce("of_root", "least").alias("component_id"))
    return rows.join(labels, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "fp")


def keep_one(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with one row of each component: that of the smallest key, with its own columns.

    Where rows repeat that key, one of them stays. A component of rows without any key keeps one per fingerprint.
    """
    found = near_duplicates(docs, key=key, text=text)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "fp"))
    named = found.where("component_id IS NOT NULL").groupBy("component_id").agg(first.alias("x")).select("x.doc_id", "x.fp")
    nameless = found.where("component_id IS NULL").groupBy("fp").agg(F.lit(None).cast(found.schema["doc_id"].dataType).alias("doc_id")).select("doc_id", "fp")
    i, p, q = spare(docs, "id", "fp", "fp2")
    chosen = named.union(nameless).select(F.col("doc_id").alias(i), F.col("fp").alias(q))
    rows = docs.withColumn(p, fingerprints(F.col(f"`{text}`")))
    met = rows.join(chosen, F.col(p).eqNullSafe(F.col(q)) & F.col(f"`{key}`").eqNullSafe(F.col(i)))
    return met.dropDuplicates([key, p]).select(*[F.col(f"`{c}`") for c in docs.columns])
