"""Column functions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F


def check_range(name: str, value: int, bounds: tuple[int, int]) -> int:
    low, high = bounds
    if not low <= value <= high:
        raise ValueError(f"{name} must be between {low} and {high}, got {value}")
    return value


def instant(value: datetime | str | Column) -> Column:
    """A wall-clock instant: a literal, a string literal or a column such as a scalar subquery."""
    if isinstance(value, Column):
        return value
    text = value.replace(tzinfo=None).isoformat(sep=" ") if isinstance(value, datetime) else value
    return F.lit(text).cast("timestamp_ntz")


def hour_of(ts: str | Column) -> Column:
    """Start of the hour, null for a null time. ``date_trunc`` would leave the zone-free type, day and hour keep it."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return ts.cast("date").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(ts))


def month_of(ts: str | Column) -> Column:
    """Month partition value ``yyyyMM``, taken from the wall clock."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.format_string("%04d%02d", F.year(ts), F.month(ts))


def iso_text(ts: str | Column) -> Column:
    """ISO-8601 with six fraction digits, or none when the fraction is zero."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    text = ts.cast("string")
    whole = F.replace(F.substring(text, 1, 19), F.lit(" "), F.lit("T"))
    fraction = F.concat(F.lit("."), F.rpad(F.substring(text, 21, 6), 6, "0"))
    return F.when(F.length(text) > 19, F.concat(whole, fraction)).otherwise(whole)


def wall_clock(text: str | Column) -> Column:
    """Parse an ISO timestamp and drop its zone without converting; null when it does not parse."""
    text = F.col(text) if isinstance(text, str) else text
    return text.try_cast("timestamp_ntz")


def number_at(raw: str | Column, path: str = "$.value") -> Column:
    """A number inside a JSON text; null when absent or not numeric."""
    return F.get_json_object(raw, path).try_cast("double")


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """Share in percent, null for an empty whole."""
    return F.round(F.try_divide(part, whole) * 100, digits)


def clean_tags(tags: str | Column) -> Column:
    return F.transform(F.coalesce(tags, F.array().cast("array<string>")), F.lower)


def post_key(record_id: str | Column) -> Column:
    """Lookup key of a record: its id modulo 100, with 0 mapped to 1."""
    record_id = F.col(record_id) if isinstance(record_id, str) else record_id
    rest = F.pmod(record_id, F.lit(100))
    return F.when(rest == 0, F.lit(1)).otherwise(rest).cast("bigint")


def absolute_url(href: str | Column, base: str | Column) -> Column:
    href = F.col(href) if isinstance(href, str) else href
    base = F.lit(base) if isinstance(base, str) else base
    return F.when(F.startswith(href, F.lit("http")), href).otherwise(F.concat(base, F.lit("/"), href))


def backoff_seconds(attempt: str | Column, base: float, ceiling: float, spread: float = 0.0) -> Column:
    """Delay before the next try; ``spread`` is the share of random jitter, never below zero."""
    attempt = F.col(attempt) if isinstance(attempt, str) else attempt
    delay = F.least(F.lit(base) * F.pow(F.lit(2.0), attempt), F.lit(float(ceiling)))
    if spread:
        delay = F.greatest(F.lit(0.0), delay + delay * spread * (F.rand() * 2 - 1))
    return delay


def seconds(value: float) -> Column:
    """A day-time interval of the given length."""
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(value).cast("decimal(18,6)"))


def days(value: int) -> Column:
    return F.make_dt_interval(F.lit(value))


def hours(value: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(value))


def epoch_micros(ts: str | Column) -> Column:
    """Microseconds of the wall clock since 1970, independent of the session zone."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def event_time(ts: str | Column) -> Column:
    """The wall clock as an instant in UTC, for watermarks, which do not take the zone-free type."""
    return F.timestamp_micros(epoch_micros(ts))


def from_event_time(at: str | Column) -> Column:
    """Back to the wall clock, whatever the session zone."""
    micros = F.unix_micros(at).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(8,0)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), micros.cast("decimal(18,6)")
    )
