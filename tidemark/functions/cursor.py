"""Opaque paging positions: base64 of ``{"id":..,"timestamp":..}``."""

from __future__ import annotations

import base64
import binascii
import json
from datetime import datetime

from pyspark.sql import Column, functions as F

from .scalars import iso_text


def cursor_text(record_id: str | Column, ts: str | Column) -> Column:
    """Cursor of every row, as a column."""
    body = F.to_json(F.struct(F.col(record_id) if isinstance(record_id, str) else record_id, iso_text(ts).alias("timestamp")))
    return F.base64(F.encode(body, "UTF-8"))


def cursor_parts(cursor: str | Column) -> Column:
    """Column form of decoding: a struct ``(id, timestamp)``, null for anything invalid."""
    text = F.try_to_binary(cursor, F.lit("base64")).cast("string")
    parsed = F.from_json(text, "id BIGINT, timestamp STRING")
    stamp = parsed["timestamp"].try_cast("timestamp_ntz")
    return F.when(parsed["id"].isNotNull() & stamp.isNotNull(), F.struct(parsed["id"].alias("id"), stamp.alias("timestamp")))


def encode_cursor(record_id: int, ts: datetime) -> str:
    text = json.dumps({"id": record_id, "timestamp": ts.isoformat()}, separators=(",", ":"))
    return base64.b64encode(text.encode()).decode()


def decode_cursor(cursor: str | None) -> tuple[int, datetime] | None:
    """One position for the driver, ``None`` when absent or invalid (which means the first page)."""
    if not cursor:
        return None
    try:
        body = json.loads(base64.b64decode(cursor))
        return int(body["id"]), datetime.fromisoformat(body["timestamp"])
    except (ValueError, KeyError, TypeError, binascii.Error):
        return None
