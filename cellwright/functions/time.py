"""Time as exact microseconds, independent of the session's time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["bucket_start", "from_micros", "iso_time", "epoch_time", "micros", "seconds"]


def micros(ts: str) -> Column:
    """Microseconds since 1970 of a timestamp column, with or without zone (then taken as UTC)."""
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', to_utc_ntz)".replace("to_utc_ntz", f"cast(`{ts}` as timestamp_ntz)"))


def from_micros(us: Column | str) -> Column:
    return F.timestamp_micros(us)


def seconds(ts: str) -> Column:
    return micros(ts) / F.lit(1e6)


def bucket_start(us: Column, every_us: int, mode: str = "floor") -> Column:
    """Start of the bucket of width every_us that holds us ("floor"), or the nearest multiple of it, of
    two equally near ones the even one ("nearest": what a rounding cast to integers does)."""
    if mode == "floor":
        return F.floor(us / F.lit(every_us)).cast("long") * every_us
    if mode == "nearest":
        return F.rint(us / F.lit(float(every_us))).cast("long") * every_us
    raise ValueError("mode is 'floor' or 'nearest'")


def iso_time(text: Column) -> Column:
    """Timestamp of YYYY-mm-ddTHH:MM:SS with up to six decimals, read as UTC; null for anything shorter
    than 19 characters or malformed."""
    part = F.regexp_extract(text, r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?)(?:\d*)?(?:Z|[+-]00:?00)?$", 1)
    return F.when(part != "", F.try_to_timestamp(F.concat(part, F.lit("Z"))))


def epoch_time(number: Column) -> Column:
    """Timestamp of a number as text: an integer is microseconds, a decimal one seconds."""
    whole = F.timestamp_micros(number.try_cast("long"))
    return F.when(number.rlike(r"^-?\d+$"), whole).otherwise(F.timestamp_micros(F.round(number.try_cast("double") * 1e6).cast("long")))
