"""Named reports: each is a query over the test tables, most with the SQL that must give the same rows."""

from __future__ import annotations

import textwrap
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Result columns in the few types that any client reads alike."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("bigint")
        elif isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            column = column.cast("double")
        elif isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.StringType):
            column = F.concat_ws(",", column)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def report(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"report {name!r} exists already")

        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(spark, sf_dir))

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = textwrap.dedent(oracle).strip()
        return run

    return add


def with_views(*views: str) -> str:
    """``WITH`` clause of the given views, each written as ``name AS (...)``."""
    return "WITH " + ",\n".join(view.strip() for view in views)
