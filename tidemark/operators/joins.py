"""Lookups by key, the bulk form of per-row queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import post_key
from .reads import active_only


def enrich_left_join(ids: DataFrame, records: DataFrame, posts: DataFrame) -> DataFrame:
    """For each requested ``(position, id)`` the record's source and the text looked up for it.

    The lookup key runs from 1 to 100, so at most 100 rows of the lookup (one per key) can match; that bound is
    what makes the broadcast safe.
    """
    lookup = (
        posts.filter(F.col("id").between(1, 100))
        .groupBy(F.col("id").alias("post_id"))
        .agg(F.any_value(F.struct("title", "body")).alias("post"))
    )
    found = active_only(records).select("id", "source", F.lit(True).alias("_found"))
    joined = ids.join(found, "id", "left").withColumn("post_id", post_key("id")).join(F.broadcast(lookup), "post_id", "left")
    missing = F.col("_found").isNull()
    no_post = F.col("post").isNull()
    return joined.select(
        "position",
        F.col("id").alias("record_id"),
        F.when(missing, F.lit("unknown")).otherwise(F.col("source")).alias("source"),
        F.when(~missing, F.col("post.title")).alias("external_title"),
        F.when(~missing, F.col("post.body")).alias("external_body"),
        (~missing & ~no_post).alias("enriched"),
        F.when(missing, F.format_string("Record %d not found", "id"))
        .when(no_post, F.format_string("Post %d not found", "post_id"))
        .alias("error"),
    )


def enrich_summary(enriched: DataFrame) -> DataFrame:
    return enriched.agg(
        F.count(F.lit(1)).alias("total"), F.count_if("enriched").alias("enriched"), F.count_if(~F.col("enriched")).alias("failed")
    )


def new_keys(incoming: DataFrame, existing: DataFrame, on: list[str]) -> DataFrame:
    """Incoming rows whose key is not stored yet."""
    return incoming.join(existing.select(*on), on, "left_anti")


def known_keys(incoming: DataFrame, existing: DataFrame, on: list[str], existing_id: str = "id") -> DataFrame:
    """Incoming rows whose key is stored, with the id of the stored row."""
    return incoming.join(existing.select(*on, F.col(existing_id).alias("existing_id")), on)


def left_join_count(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows of ``right`` per row of ``left``, 0 when there are none.

    The right side is counted per key before the join, so a key with very many rows costs one row here.
    """
    counts = right.filter(F.col(right_key).isNotNull()).groupBy(F.col(right_key).alias(left_key)).agg(F.count(F.lit(1)).alias("_n"))
    return left.join(counts, left_key, "left").withColumn("n", F.coalesce("_n", F.lit(0))).drop("_n")


def date_spine(rows: DataFrame, category: str, at: str) -> DataFrame:
    """Every day of the covered range for every category; the days are generated on the category rows."""
    span = rows.agg(F.struct(F.min(F.col(at).cast("date")).alias("low"), F.max(F.col(at).cast("date")).alias("high"))).scalar()
    categories = rows.select(category).distinct().withColumn("_span", span)
    return categories.select(category, F.explode(F.sequence("_span.low", "_span.high")).alias("day"))


def lookup_once(rows: DataFrame, lookup: DataFrame, on: str | Column, how: str = "left") -> DataFrame:
    """One join in place of a query per row."""
    return rows.join(lookup, on, how)
