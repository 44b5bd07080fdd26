"""Date and time functions over Columns, in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnLike, _c


def iso_utc(ts: ColumnLike) -> Column:
    """ISO form with milliseconds and Z."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def strict_utc(x: ColumnLike) -> Column:
    """A timestamp of exactly yyyy-MM-ddTHH:mm:ssZ; null for others."""
    return F.when(_c(x).rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"), F.try_to_timestamp(_c(x), F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")))


def completed_week(day: ColumnLike) -> Column:
    """struct(start, end): the seven whole days before a day."""
    d = F.to_date(_c(day))
    return F.struct(F.date_sub(d, 7).alias("start"), d.alias("end"))


def day_start_seconds(ts: ColumnLike) -> Column:
    """Unix seconds of a day's start."""
    return F.unix_seconds(F.date_trunc("day", _c(ts).cast("timestamp")))


def elapsed_today(now: ColumnLike, launched: ColumnLike, seen: ColumnLike) -> Column:
    """Seconds from the latest of the day's start, the launch and the last look until now, 0 at least."""
    n = F.unix_seconds(_c(now).cast("timestamp"))
    since = F.greatest(day_start_seconds(now), F.unix_seconds(_c(launched).cast("timestamp")), F.unix_seconds(_c(seen).cast("timestamp")))
    return F.greatest(F.lit(0), n - since)


def backoff_ms(failures: ColumnLike) -> Column:
    """30 s, doubled with each failure after the first, 15 minutes at most."""
    return F.least(F.lit(900_000).cast("double"), F.pow(F.lit(2.0), _c(failures) - 1) * 30_000).cast("long")


def settled(now: ColumnLike, ended: ColumnLike, grace_s: int = 120) -> Column:
    """Whether a grace has passed since the end; false while there is none."""
    return F.coalesce(F.unix_seconds(_c(now).cast("timestamp")) - F.unix_seconds(_c(ended).cast("timestamp")) >= grace_s, F.lit(False))


def active(now: ColumnLike, last: ColumnLike, within_s: int = 180) -> Column:
    """Whether something was seen less than `within_s` seconds ago."""
    return F.coalesce(F.unix_seconds(_c(now).cast("timestamp")) - F.unix_seconds(_c(last).cast("timestamp")) < within_s, F.lit(False))


def duration_ms(start_ns: ColumnLike, end_ns: ColumnLike) -> Column:
    """Milliseconds between two times in nanoseconds, three places."""
    return F.round((_c(end_ns) - _c(start_ns)) / 1e6, 3)
