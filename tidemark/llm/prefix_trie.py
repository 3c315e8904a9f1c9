"""The trie of all conversations by their first turns, with totals of every subtree.

Prefixes of a conversation have a digest each: the exclusive or of one digest per turn, of its place and content. It
can be summed piece by piece, so that even one conversation that holds much of the table is spread over tasks.

Totals go up by bands of ``BAND`` depths. A node adds its own figures to its ancestors inside its band, at most ``BAND``
rows; what the first nodes of the bands then hold goes to the first nodes of the bands above in the same way, in bands of
bands. So the rounds grow with the logarithm of the greatest depth. On the way back every first node of a band, now complete,
adds its total to its ancestors in the band above it.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.spread import salted_join
from ..session import settle

#: Depths of a band, and so the most ancestors that one node is added to.
BAND = 8
#: Fixed: rebuilt conversations take fewer than this many turns from the first conversation of their hundred.
SHARED = 6
KEY = ("depth", "p1", "p2")


def ordered_turns(turns: DataFrame) -> DataFrame:
    """``(conv, place, slice, content, chars)``: places count up inside a conversation's slice. Null ids take no part.

    Turns are ordered by turn (null first), role and text. Slices are range partitions of all turns with sampled bounds; a running
    number makes rows distinct, so that neither a long conversation nor repeated rows have to stay in one.
    """
    text, role = F.coalesce(F.col("text"), F.lit("")), F.coalesce(F.col("role"), F.lit(""))
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv"), F.col("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"),
    ).where("conv IS NOT NULL").withColumn("row", F.monotonically_increasing_id())
    order = [F.asc("conv"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text"), F.asc("row")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    return settle(ranged.select(
        "conv", F.col("at").alias("place"), F.shiftright("at", 33).cast("int").alias("slice"),
        F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))).alias("content"),
        F.length("text").cast("bigint").alias("chars"),
    ), "turns")


def _turn_digest(depth: Column, content: Column) -> list[Column]:
    """120 bits of the digest of a turn at its depth, as two numbers."""
    mixed = F.md5(F.concat(depth.cast("string"), F.lit(":"), content))
    return [F.conv(F.substring(mixed, at, 15), 16, 10).cast("bigint") for at in (1, 16)]


def _digested(rows: DataFrame) -> DataFrame:
    x1, x2 = _turn_digest(F.col("depth"), F.col("content"))
    return rows.withColumn("x1", x1).withColumn("x2", x2).drop("content")


def rebuilt_prefixes(turns: DataFrame) -> DataFrame:
    """``(conv, depth, p1, p2, chars, ends)``: every prefix of every rebuilt conversation, the empty one too.

    ``p1`` and ``p2`` are the prefix's digest, ``chars`` the code points of its last text, ``ends`` whether it is the whole.
    """
    ordered = ordered_turns(turns)
    down = Window.partitionBy("conv").orderBy("slice")
    pieces = ordered.groupBy("conv", "slice").agg(F.min("place").alias("first"), F.count("*").alias("size"))
    pieces = pieces.withColumn("start", F.sum("size").over(down) - F.col("size"))
    sizes = pieces.groupBy("conv").agg(F.sum("size").alias("size"))
    convs = sizes.select(
        "conv", "size", (F.col("conv") - F.col("conv") % 100).alias("base"), (F.crc32(F.col("conv").cast("string")) % SHARED).alias("h"),
    )
    bases = sizes.where("conv % 100 = 0").select(F.col("conv").alias("base"), F.col("size").alias("base_size"))
    convs = settle(convs.join(bases, "base", "left").select(
        "conv", "base", "h", F.least("h", F.coalesce("base_size", F.lit(0))).alias("taken"),
        (F.least("h", F.coalesce("base_size", F.lit(0))) + F.greatest(F.col("size") - F.col("h"), F.lit(0))).alias("n"),
    ), "conversations")
    pieces = settle(pieces.join(convs, "conv"), "pieces")

    placed = ordered.join(pieces, ["conv", "slice"]).withColumn("own", F.col("place") - F.col("first") + F.col("start") + 1)
    heads = (
        placed.where(f"conv % 100 = 0 AND own < {SHARED}").select(F.col("conv").alias("base"), F.col("own").alias("depth"), "content", "chars")
        .join(convs, "base").where("depth <= taken")
    )
    # At most five turns a conversation here, so a window over one is small.
    above = Window.partitionBy("conv").orderBy("depth")
    heads = settle(_digested(heads).select(
        "conv", "depth", F.bit_xor("x1").over(above).alias("p1"), F.bit_xor("x2").over(above).alias("p2"), "chars", (F.col("depth") == F.col("n")).alias("ends"), "taken",
    ), "shared-turns")
    opened = heads.where("depth = taken").select("conv", F.col("p1").alias("h1"), F.col("p2").alias("h2"))

    inside = Window.partitionBy("conv", "slice").orderBy("depth")
    own = _digested(placed.where("own > h").select("conv", "slice", (F.col("own") - F.col("h") + F.col("taken")).alias("depth"), "content", "chars", "n"))
    own = settle(own.select(
        "conv", "slice", "depth", "chars", (F.col("depth") == F.col("n")).alias("ends"),
        F.bit_xor("x1").over(inside).alias("x1"), F.bit_xor("x2").over(inside).alias("x2"),
    ), "own-turns")
    # The last row of a slice holds the slice's whole digest.
    totals = own.groupBy("conv", "slice").agg(F.max(F.struct("depth", "x1", "x2")).alias("t")).select("conv", "slice", "t.x1", "t.x2")
    before = down.rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.join(opened, "conv", "left").select(
        "conv", "slice", *[F.coalesce(F.bit_xor(f"x{i}").over(before), F.lit(0)).bitwiseXOR(F.coalesce(f"h{i}", F.lit(0))).alias(f"c{i}") for i in (1, 2)]
    )
    own = own.join(carried, ["conv", "slice"]).select(
        "conv", "depth", F.col("x1").bitwiseXOR(F.col("c1")).alias("p1"), F.col("x2").bitwiseXOR(F.col("c2")).alias("p2"), "chars", "ends",
    )
    zero = F.lit(0).cast("bigint")
    roots = convs.select("conv", zero.alias("depth"), zero.alias("p1"), zero.alias("p2"), zero.alias("chars"), (F.col("n") == 0).alias("ends"))
    return roots.union(heads.select(*roots.columns)).union(own.select(*roots.columns))


def _with_ancestors(prefixes: DataFrame, step: int) -> DataFrame:
    """The prefixes at multiples of ``step``, each with those before it on its path, back to the start of its band.

    ``up`` holds ``p1, p2`` of each, the lowest depth first. The first prefix of a band has the whole band above it. A group
    has one conversation's prefixes of one band, at most ``BAND + 1``.
    """
    at = prefixes.where(f"depth % {step} = 0").withColumn("j", F.expr(f"depth div {step}"))
    bands = F.when((F.col("j") % BAND == 0) & (F.col("j") > 0), F.array(F.expr(f"j div {BAND}"), F.expr(f"j div {BAND} - 1"))).otherwise(F.array(F.expr(f"j div {BAND}")))
    paths = at.withColumn("band", F.explode(bands)).groupBy("conv", "band").agg(
        F.sort_array(F.collect_list(F.struct("depth", "p1", "p2", "chars", "ends"))).alias("path")
    )
    each = paths.select("conv", "path", F.posexplode("path").alias("i", "x")).where("i > 0 OR x.depth = 0")
    return each.select(
        "conv", "x.*", F.flatten(F.transform(F.slice("path", F.lit(1), F.col("i")), lambda y: F.array(y["p1"], y["p2"]))).alias("up"),
    )


def _to_ancestors(rows: DataFrame, step: int, with_self: bool, *sums: str) -> DataFrame:
    """The rows' figures under the keys of their ancestors in ``up``, and their own."""
    n = F.expr("size(up) div 2")
    places = F.sequence(F.lit(0).cast("bigint"), n if with_self else n - 1)
    reached = rows.withColumn("n", n).withColumn("k", F.explode(places))
    own = F.col("k") == F.col("n")
    return reached.select(
        (F.col("depth") - (F.col("n") - F.col("k")) * step).alias("depth"),
        *[F.when(own, F.col(p)).otherwise(F.get("up", (F.col("k") * 2 + i).cast("int"))).alias(p) for i, p in enumerate(("p1", "p2"))],
        *sums,
    )


def _summed(rows: DataFrame, *sums: str) -> DataFrame:
    return rows.groupBy(*KEY).agg(*[F.sum(s).alias(s) for s in sums])


def _subtree_totals(nodes: DataFrame, prefixes: DataFrame, deepest: int) -> DataFrame:
    """``(depth, p1, p2, n_leaves, saved_tokens)`` of every node, from the nodes' own ``n_leaves`` and ``saved_tokens``."""
    figures = ("n_leaves", "saved_tokens")
    levels, step = [], 1
    here = nodes
    while True:
        band = step * BAND
        # The first node of a band stays by itself here; the others reach up to it.
        alone = F.when(F.col("depth") % band == 0, F.array().cast("array<bigint>")).otherwise(F.col("up"))
        sums = settle(_summed(_to_ancestors(here.withColumn("up", alone), step, True, *figures), *figures), "band-totals")
        levels.append((step, here, sums))
        if band > deepest:
            break
        ups = _with_ancestors(prefixes, band).groupBy(*KEY).agg(F.min("up").alias("up"))
        here = settle(sums.where(f"depth % {band} = 0").join(ups, list(KEY)), "band-roots")
        step = band
    *lower, (_, _, total) = levels
    for step, here, sums in reversed(lower):
        roots = here.where(f"depth > 0 AND depth % {step * BAND} = 0").select(*KEY, "up")
        passed = _to_ancestors(roots.join(total, list(KEY)), step, False, *figures)
        total = settle(_summed(sums.select(*KEY, *figures).union(passed), *figures), "totals")
    return total


def _ends(prefixes: DataFrame) -> DataFrame:
    """``(depth, p1, p2, ends_sha256)``: the digest of the ids that end at a node.

    One digest is sequential by nature: a node's ids come sorted through one task, which holds no more than a batch of them.
    """
    shape = pa.schema([("depth", pa.int64()), ("p1", pa.int64()), ("p2", pa.int64()), ("ends_sha256", pa.string())])

    def run(batches):
        node, digest = None, None
        for batch in batches:
            done, ids = [], []
            for *key, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if key != node:
                    if node is not None:
                        digest.update(",".join(ids).encode())
                        done.append((*node, digest.hexdigest()))
                    node, digest, ids = key, hashlib.sha256(), []
                elif not ids:
                    ids.append("")
                ids.append(str(conv))
            if node is not None and ids:
                digest.update(",".join(ids).encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(map(list, zip(*done)), shape)], schema=shape)
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*node, digest.hexdigest()), shape)], schema=shape)

    rows = prefixes.where("ends").select(*KEY, "conv").repartition(*KEY).sortWithinPartitions(*KEY, "conv")
    return rows.mapInArrow(run, "depth bigint, p1 bigint, p2 bigint, ends_sha256 string")


def prefix_nodes(turns: DataFrame) -> DataFrame:
    """A row per distinct prefix of the rebuilt conversations: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    Prefixes count as equal if their 120-bit digests are. Null roles and texts are empty; turns without a conversation take no
    part; repeated turns stay, ordered by turn (null first), role and text. Other columns are not read. Without a conversation
    there is no node, not even the root.
    """
    prefixes = settle(rebuilt_prefixes(turns), "prefixes")
    deepest = prefixes.agg(F.max("depth")).first()[0]
    nodes = _with_ancestors(prefixes, 1).groupBy(*KEY).agg(
        F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.count_if("ends").alias("n_ends"), F.max("chars").alias("chars"), F.min("up").alias("up"),
    )
    # A node is childless if all its members end there.
    nodes = settle(nodes.select(
        *KEY, "conv_id", "n_convs", "up", (F.col("n_convs") == F.col("n_ends")).cast("bigint").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
    ), "nodes")
    last = F.size("up") - F.lit(2)
    parent = [F.when(F.col("depth") > 0, F.col("depth") - 1).alias("depth"), F.get("up", last).alias("p1"), F.get("up", last + 1).alias("p2")]
    children = nodes.where("depth > 0").groupBy(*parent).agg(F.count("*").alias("n_children"))
    totals = _subtree_totals(nodes, prefixes, deepest or 0)
    empty = hashlib.sha256(b"").hexdigest()
    rows = (
        nodes.drop("n_leaves", "saved_tokens").join(totals, list(KEY)).join(children, list(KEY), "left").join(_ends(prefixes), list(KEY), "left")
    )
    up = nodes.select(*[F.col(k).alias(f"parent_{k}") for k in KEY], F.col("conv_id").alias("parent_conv_id"))
    keyed = rows.select("*", *[c.alias(f"parent_{k}") for c, k in zip(parent, KEY)])
    above = nodes.select(*[c.alias(f"parent_{k}") for c, k in zip(parent, KEY)])
    linked = salted_join(keyed, up, [f"parent_{k}" for k in KEY], "left", salt_by=F.col("p1"), counted=above)
    return linked.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
    )
