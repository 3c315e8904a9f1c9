"""JSON texts whose exact spelling matters."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def respelled(text: str | None) -> str | None:
    try:
        return None if text is None else json.dumps(json.loads(text), sort_keys=True, default=str)
    except (ValueError, RecursionError):
        return None


@F.pandas_udf(StringType())
def sorted_json(raw: pd.Series) -> pd.Series:
    """The same JSON value with sorted keys and ``", "`` / ``": "`` separators; null for a text that is no JSON."""
    return raw.map(respelled)
