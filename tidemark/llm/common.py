"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import sys
import types
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import arrow_udf
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

ROWS_AT_ONCE = 256
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Rows go to Python workers in batches of a few megabytes. Texts are long; by number of rows a batch has no bound."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def spare(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that the frame does not have yet, whatever extra columns it carries."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        fresh = f"_{name}"
        while fresh.lower() in taken:
            fresh = f"_{fresh}"
        taken.add(fresh.lower())
        out.append(fresh)
    return out


def kept_in_worker(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, so that tasks after the first find it filled.

    Only for what can be rebuilt at any time; whoever fills it also bounds it. A worker keeps one such dictionary: asking
    for another name drops it.
    """
    module = sys.modules.setdefault("_tidemark_worker", types.ModuleType("_tidemark_worker"))
    if getattr(module, "name", None) != name:
        module.name, module.held = name, {}
    return module.held


@contextmanager
def no_cycles() -> Iterator[None]:
    """Without the search for cycles, which would walk through large memories again and again; nothing here makes cycles."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def by_value(kind: DataType, *, keeps: bool = False) -> Callable:
    """Decorator: a function of one value, or of a value per column, as an Arrow function of columns.

    Values become Python objects a few rows at a time, so a batch of long texts is held once, as Arrow has it. A struct is
    returned as a tuple. A function that ``keeps`` something in the worker says so; others drop what was kept there.
    """

    def wrap(fn: Callable):
        arrow = to_arrow_type(kind)

        def run(*columns: pa.Array) -> pa.Array:
            parts = []
            if not keeps:
                kept_in_worker("")
            with no_cycles():
                for start in range(0, len(columns[0]), ROWS_AT_ONCE):
                    values = [c.slice(start, ROWS_AT_ONCE).to_pylist() for c in columns]
                    parts.append(pa.array([fn(*row) for row in zip(*values)], arrow))
            return pa.concat_arrays(parts) if parts else pa.array([], arrow)

        names = {1: lambda a: run(a), 2: lambda a, b: run(a, b), 3: lambda a, b, c: run(a, b, c)}
        typed = names[fn.__code__.co_argcount]
        typed.__annotations__ = {**{n: pa.Array for n in typed.__code__.co_varnames}, "return": pa.Array}
        return arrow_udf(typed, kind)

    return wrap
