"""Validation of incoming records: every failed rule is reported, rejects keep their original row."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import clean_tags, instant, wall_clock
from ..schemas import BATCH_MAX_ROWS, BATCH_MIN_ROWS, RESERVED_SOURCES, SOURCE_MAX_LENGTH, SOURCE_MIN_LENGTH, TAGS_MAX_COUNT
from .spread import salted_join


def _failures(*rules: tuple[str, Column]) -> Column:
    """Codes of the rules that fail, in the given order."""
    codes = F.array(*[F.when(failed, F.lit(code)) for code, failed in rules])
    return F.filter(codes, lambda code: code.isNotNull())


def normalize_requests(df: DataFrame, as_of: datetime | str | Column) -> DataFrame:
    """Defaults and clean-up: a missing timestamp is ``as_of``, a zone is dropped, tags are lower-cased."""
    stamp = F.when(F.col("timestamp").isNull(), instant(as_of)).otherwise(wall_clock("timestamp"))
    return df.withColumn("parsed_at", stamp).withColumn("tags", clean_tags("tags"))


def validate_requests(df: DataFrame, as_of: datetime | str | Column) -> DataFrame:
    """Adds ``errors``, the codes of all failed rules, to request rows."""
    source, data = F.col("source"), F.col("data")
    length = F.length(source)
    rules = [
        ("source_missing", source.isNull()),
        ("source_length", (length < SOURCE_MIN_LENGTH) | (length > SOURCE_MAX_LENGTH)),
        ("source_reserved", F.lower(source).isin(RESERVED_SOURCES)),
        ("data_missing", data.isNull()),
        ("data_not_object", data.isNotNull() & F.json_object_keys(data).isNull()),
        ("timestamp_invalid", F.col("parsed_at").isNull()),
        ("timestamp_future", F.col("parsed_at") > instant(as_of)),
        ("too_many_tags", F.size("tags") > TAGS_MAX_COUNT),
    ]
    return normalize_requests(df, as_of).withColumn("errors", _failures(*rules))


def split_valid(checked: DataFrame, original: list[str]) -> tuple[DataFrame, DataFrame]:
    """Valid rows and the quarantine, which keeps the original row as JSON and the error codes."""
    valid = checked.filter(F.size("errors") == 0).drop("errors")
    rejected = checked.filter(F.size("errors") > 0).withColumn("original_row", F.to_json(F.struct(*original)))
    return valid, rejected


def reject_whole_batches(checked: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Rows of the batches in which every row is valid."""
    clean = checked.groupBy(batch).agg(F.bool_or(F.size("errors") > 0).alias("_bad")).filter(~F.col("_bad")).drop("_bad")
    return salted_join(checked, clean, [batch], "left_semi")


def batch_sizes(df: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Rows per batch and whether that size is allowed."""
    sizes = df.groupBy(batch).agg(F.count(F.lit(1)).alias("row_count"))
    return sizes.withColumn("size_ok", F.col("row_count").between(BATCH_MIN_ROWS, BATCH_MAX_ROWS))


def batch_ingest_summary(checked: DataFrame, position: str, batch: str = "batch_id") -> DataFrame:
    """Per batch: rows inserted, rows in error and the first error by position."""
    failed = F.size("errors") > 0
    return checked.groupBy(batch).agg(
        F.count_if(~failed).alias("inserted"),
        F.count_if(failed).alias("errors"),
        F.min(F.when(failed, F.struct(F.col(position).alias("p"), F.array_join("errors", ",").alias("e"))))["e"].alias("first_error"),
    )


def clean_transform(df: DataFrame, key: str = "id", name: str = "name", price: str = "price") -> DataFrame:
    """Drop rows without id, trim the name, make the price a number with default 0."""
    return df.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("id"),
        F.trim(F.coalesce(name, F.lit(""))).alias("name"),
        F.coalesce(F.col(price).try_cast("double"), F.lit(0.0)).alias("price"),
    )


def add_computed(df: DataFrame, column: str, out: str, factor: float) -> DataFrame:
    return df.withColumn(out, F.col(column) * F.lit(factor))


def filter_above(df: DataFrame, column: str, threshold: float) -> DataFrame:
    return df.filter(F.col(column) > threshold)


def validate_customers(df: DataFrame) -> DataFrame:
    """Customer rules: an integer id, an email with ``@`` (returned in lower case), an age from 0 to 150, a date.

    ``df`` holds the four fields as text plus the text of lines that did not parse.
    """
    age = F.col("age").try_cast("int")
    rules = [
        ("row_malformed", F.col("corrupt_line").isNotNull()),
        ("id_invalid", F.col("id").try_cast("bigint").isNull()),
        ("email_invalid", ~F.coalesce(F.contains("email", F.lit("@")), F.lit(False))),
        ("age_invalid", age.isNull()),
        ("age_out_of_range", ~age.between(0, 150)),
        ("purchase_date_invalid", F.col("purchase_date").isNull()),
    ]
    return df.withColumn("errors", _failures(*rules)).withColumn("email", F.lower("email"))
