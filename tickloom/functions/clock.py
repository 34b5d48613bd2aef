"""Time columns: keys, buckets, sessions, recency filters."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Hour limits (first hour, last hour) of the sessions and day periods.
SESSIONS = (("Asia", 0, 7), ("Europe", 8, 12), ("US", 13, 20), ("Off-hours", 21, 23))
PERIODS = (("Night", 0, 5), ("Morning", 6, 11), ("Afternoon", 12, 17), ("Evening", 18, 23))

# Day names by Spark's dayofweek, which starts with 1 = Sunday.
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def as_instant(value) -> Column:
    """A point in time as a column: None is now, text and naive datetimes are UTC."""
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    return F.timestamp_micros(F.lit(epoch_micros(value)))


def epoch_micros(value) -> int:
    """The same point in time in microseconds, on the driver."""
    if value is None:
        value = datetime.now(timezone.utc)
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    if value.tzinfo is None:
        value = value.replace(tzinfo=timezone.utc)
    return int(value.timestamp()) * 1_000_000 + value.microsecond


def _wall_clock(text: Column, source_tz: str) -> Column:
    """Instant of ``yyyy-MM-dd HH:mm:ss`` text by plain arithmetic.

    A cast would read the text in the session zone, and appending a zone makes every row look
    the zone up; neither is needed for a fixed shape.
    """

    def part(start: int) -> Column:
        return F.substring(text, start, 2).try_cast("int")

    days = F.unix_date(F.substring(text, 1, 10).try_cast("date"))
    seconds = days.cast("bigint") * 86400 + part(12) * 3600 + part(15) * 60 + part(18)
    at = F.timestamp_seconds(seconds)
    return at if source_tz == "UTC" else F.to_utc_timestamp(at, source_tz)


def parse_instant(text: Column, source_tz: str = "UTC", strict: bool = False) -> Column:
    """Text without surrounding blanks to TIMESTAMP, NULL when it is not one.

    Text without an offset is read in ``source_tz`` whatever the session zone is; text with an
    offset keeps its own; 12 to 14 digits are epoch milliseconds. ``strict`` accepts only
    ``yyyy-MM-dd HH:mm:ss``. Time-only text is refused: Spark would add today's date to it.
    """
    clock = r"(?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d$"
    if strict:
        return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2} " + clock), _wall_clock(text, source_tz))
    zone = F.lit(" " + source_tz)
    has_zone = text.rlike(r":\d{2}(?:\.\d+)?\s*(?:Z|[A-Z][A-Za-z]|[+-]\d)")
    return (
        F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}[ T]" + clock), _wall_clock(text, source_tz))
        .when(text.rlike(r"^\d{12,14}$"), F.timestamp_millis(text.try_cast("bigint")))
        .when(~text.rlike(r"^\d{4}(?:-|$)"), F.lit(None))
        .when(has_zone, text.try_cast("timestamp"))
        .when(text.contains(":"), F.concat(text, zone).try_cast("timestamp"))
        .otherwise(F.concat(text.try_cast("date").cast("string"), F.lit(" 00:00:00"), zone).try_cast("timestamp"))
    )


def date_key(when: Column) -> Column:
    """yyyyMMdd as INT."""
    return F.year(when) * 10000 + F.month(when) * 100 + F.dayofmonth(when)


def time_key(when: Column) -> Column:
    """HHmmss as INT."""
    return F.hour(when) * 10000 + F.minute(when) * 100 + F.second(when)


def bucket(when: Column, seconds: int) -> Column:
    """Start of the epoch-aligned bucket that holds ``when``."""
    secs = F.unix_seconds(when)
    return F.timestamp_seconds(secs - F.pmod(secs, F.lit(seconds)))


def day_name(weekday: Column) -> Column:
    """Name of a dayofweek number."""
    return F.element_at(F.array(*[F.lit(d) for d in DAY_NAMES]), weekday)


def _by_hour(hour: Column, limits) -> Column:
    out = None
    for name, first, last in limits:
        hit = hour.between(first, last)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def trading_session(hour: Column) -> Column:
    return _by_hour(hour, SESSIONS)


def day_period(hour: Column) -> Column:
    return _by_hour(hour, PERIODS)


def moment_key(rows: DataFrame, when: str, ident: str | Sequence[str]) -> Column:
    """An ordering key of (time, id) to find a group's first or last row by.

    With one integer id it is a single number, which keeps an aggregation buffer at a fixed width, so
    Spark hashes; several ids, or text, make a struct, and Spark sorts. Null ids count as the smallest.
    """
    names = [ident] if isinstance(ident, str) else list(ident)
    integer = ("tinyint", "smallint", "int", "bigint")
    if len(names) == 1 and rows.schema[names[0]].dataType.simpleString() in integer:
        place = F.coalesce(F.col(names[0]).cast("decimal(19,0)"), F.lit(Decimal(-(2**63) - 1)))
        return (F.unix_micros(when).cast("decimal(18,0)") * F.lit(Decimal(2 * 10**19)) + place).cast("decimal(38,0)")
    return F.struct(when, *names)


def within(when: Column, as_of, seconds: int) -> Column:
    """as_of - seconds <= when <= as_of."""
    now = as_instant(as_of)
    return (when >= now - F.expr(f"INTERVAL {int(seconds)} SECONDS")) & (when <= now)
