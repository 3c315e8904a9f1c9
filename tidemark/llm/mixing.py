"""Temperature mixing of sources.

Each source's share of the tokens is raised to an exponent between 0 (all alike) and 1 (as found). The exponent is found
by bisection: the largest one at which the weights have the wanted entropy, but no lower than the one at which no source
is repeated more than the limit allows. The weights are then realised: every source is read in passes, each pass is an
own permutation of the source's blocks, and the last pass stops at the source's budget.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import settle
from .common import spare

BLOCKS = 1024
ENTROPY = 0.9
REPEATS = 2.0
SEED = 42


def token_count(text: Column) -> Column:
    """Words of a text plus one for its end, so that an empty or null text still has a place in the budget."""
    parts = F.split(F.coalesce(text, F.lit("")), "[ \\t-\\r]+")
    outer = (parts[0] == "").cast("int") + F.when(F.size(parts) > 1, F.element_at(parts, -1) == "").otherwise(F.lit(False)).cast("int")
    return (F.size(parts) - outer + 1).cast("bigint")


def figures_at(totals: DataFrame, exponents: list[float]) -> dict[float, tuple[float, float]]:
    """For each exponent: entropy of the weights as a part of the largest possible, and the most passes over one source."""
    raised = totals.select("share", F.explode(F.array(*map(F.lit, exponents))).alias("a")).withColumn("p", F.pow("share", "a"))
    rows = raised.groupBy("a").agg(
        F.count("*").alias("n"), F.sum("p").alias("z"), F.sum(F.col("p") * F.log("share")).alias("l"),
        (F.max(F.col("p") / F.col("share")) / F.min(F.col("p") / F.col("share"))).alias("repeats"),
    ).collect()
    return {
        r["a"]: ((math.log(r["z"]) - r["a"] * r["l"] / r["z"]) / math.log(r["n"]) if r["n"] > 1 else 1.0, r["repeats"]) for r in rows
    }


def bisect(totals: DataFrame, good, *, rising: bool, levels: int = 5, rounds: int = 6) -> float:
    """Where ``good(entropy, repeats)`` changes between exponents 0 and 1, by bisection, ``levels`` halvings in one job.

    ``rising``: good from some exponent on (the lowest good one is returned), else good up to one (the highest good one).
    """
    low, high, parts = 0.0, 1.0, 2 ** levels
    ends = figures_at(totals, [low, high])
    if rising and (not ends or good(*ends[low])):
        return low
    if not rising and (not ends or good(*ends[high])):
        return high
    for _ in range(rounds):
        inner = [low + (high - low) * i / parts for i in range(parts + 1)]
        found = figures_at(totals, inner[1:-1])
        # The left end is on one side, the right end on the other; keep the cell where it changes.
        left = 0
        for i, a in enumerate(inner[1:-1], start=1):
            if good(*found[a]) != rising:
                left = i
        low, high = inner[left], inner[left + 1]
    return high if rising else low


def mixing_exponent(totals: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS) -> float:
    """The exponent for a frame of source shares (``share`` in 0..1): nearest to 1 that reaches ``entropy``, within ``repeats``."""
    by_entropy = bisect(totals, lambda h, _: h >= entropy - 1e-12, rising=False)
    by_limit = bisect(totals, lambda _, r: r <= repeats * (1 + 1e-12), rising=True)
    return max(by_entropy, by_limit)


def mix_sources(
    docs: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS, budget: int | None = None, blocks: int = BLOCKS,
    seed: int = SEED, *, key: str = "doc_id", source: str = "source", text: str = "text",
) -> DataFrame:
    """Every chosen copy of every row, with the columns of ``docs`` followed by those of the mix.

    Added: ``mix_pass`` (0 for the first copy), ``mix_position`` (0..1; reading all sources in this order keeps the
    weights at any point), ``mix_tokens``, ``mix_share`` (of the tokens found), ``mix_weight`` and ``mix_exponent``; a
    column of ``docs`` by one of these names gives way to them.
    ``budget`` is the number of tokens to deal; by default it is the least that reads every source whole at least once,
    so nothing is left out and small sources are read again. A budget stops a source after whole blocks: less than one
    block, 1/``blocks`` of the source, is dealt beyond it.

    A null source is a source of its own, a null or empty text weighs one token, rows repeated in the table are each
    dealt, and an empty table gives an empty mix. Ties between blocks are settled by the block's number.
    """
    added = ("mix_pass", "mix_position", "mix_tokens", "mix_share", "mix_weight", "mix_exponent")
    docs = docs.drop(*added)
    s, b, t = spare(docs, "source", "block", "tokens")
    name = F.coalesce(F.concat(F.lit("="), F.col(f"`{source}`").cast("string")), F.lit("null"))
    rows = docs.withColumns({s: name, b: F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(blocks)).cast("int"), t: token_count(F.col(f"`{text}`"))})

    cells = settle(rows.groupBy(F.col(s).alias("s"), F.col(b).alias("b")).agg(F.sum(t).alias("tokens")), "mix-cells")
    whole = cells.agg(F.sum("tokens")).first()[0] or 0
    totals = settle(
        cells.groupBy("s").agg(F.sum("tokens").alias("total")).withColumn("share", F.col("total") / F.lit(float(max(whole, 1)))), "mix-totals"
    )
    a = mixing_exponent(totals, entropy, repeats)
    z, least = totals.agg(F.sum(F.pow("share", F.lit(a))), F.max(F.col("total") / F.pow("share", F.lit(a)))).first()
    # total / weight is what the whole mix must hold for the source to be read once.
    size = float(budget) if budget is not None else (least or 0.0) * (z or 0.0)
    weighed = totals.withColumn("weight", F.pow("share", F.lit(a)) / F.lit(z or 1.0)).withColumn("goal", F.col("weight") * F.lit(size))
    passes = weighed.withColumn(
        "pass", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("goal") / F.col("total") - 1e-9).cast("int") - 1, F.lit(0))))
    )
    order = Window.partitionBy("s", "pass").orderBy(F.xxhash64("s", "b", "pass", F.lit(seed)), "b")
    dealt = (
        cells.join(passes, "s")
        .withColumn("before", F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("tokens") + F.col("pass") * F.col("total"))
        # Tokens are whole numbers, so half of one is tolerance enough; without a budget the first pass is whole by definition.
        .where((F.col("before") < F.col("goal") - F.least(F.lit(0.5), F.col("goal") / 2)) | (F.lit(budget is None) & (F.col("pass") == 0)))
        .select(
            F.col("s").alias(s), F.col("b").alias(b), F.col("pass").alias("mix_pass"),
            F.least(F.col("before") / F.col("goal"), F.lit(1.0)).alias("mix_position"),
            F.col("share").alias("mix_share"), F.col("weight").alias("mix_weight"),
        )
    )
    return rows.join(dealt, [s, b]).withColumn("mix_tokens", F.col(t)).withColumn("mix_exponent", F.lit(a)).select(*[F.col(f"`{c}`") for c in docs.columns], *added)
