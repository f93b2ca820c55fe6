"""Time text, calendar keys and date parts as built-in Column expressions.

Every helper returns a ``Column`` so it stays inside whole-stage codegen;
nothing here runs Python per row.

The calendar key is the minute of a zone-less time shaped ``yyyyMMddHHmm``
as a BIGINT. It is built by arithmetic on the time fields rather than by
formatting text: the fields of a TIMESTAMP_NTZ do not depend on the session
zone, and adding five integers is cheaper than printing and re-parsing a
string.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text layout of staged times and of the calendar key.
TIME_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
KEY_FORMAT = "yyyyMMddHHmm"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def blank_to_null(col: Column | str) -> Column:
    """``NULLIF(x, '')``: an empty text is a missing value."""
    return F.nullif(_c(col), F.lit(""))


def parse_time_lenient(col: Column | str) -> Column:
    """Time text to TIMESTAMP_NTZ; unparseable text becomes NULL."""
    return _c(col).try_cast("timestamp_ntz")


def parse_time_strict(col: Column | str) -> Column:
    """Time text to TIMESTAMP_NTZ; NULL stays NULL, unparseable text raises.

    Written with ``try_cast`` + ``raise_error`` so that it fails whatever the
    session's ANSI setting is.
    """
    raw = _c(col)
    parsed = raw.try_cast("timestamp_ntz")
    return F.when(raw.isNull(), F.lit(None).cast("timestamp_ntz")).otherwise(
        F.coalesce(parsed, F.raise_error(F.concat(F.lit("bad time text: "), raw)))
    )


def minute_key_of(ts: Column | str) -> Column:
    """Minute key ``yyyyMMddHHmm`` (BIGINT) of a TIMESTAMP_NTZ; NULL in, NULL out."""
    t = _c(ts)
    return (
        F.year(t).cast("bigint") * 100000000
        + F.month(t) * 1000000
        + F.dayofmonth(t) * 10000
        + F.hour(t) * 100
        + F.minute(t)
    )


def minute_key(col: Column | str) -> Column:
    """Strict key from time text: bad text raises (calendar and item facts)."""
    return minute_key_of(parse_time_strict(col))


def try_minute_key(col: Column | str) -> Column:
    """Lenient key from time text: bad text gives NULL (order fact)."""
    return minute_key_of(parse_time_lenient(col))


def minute_floor(ts: Column | str) -> Column:
    """Truncate a time to its minute, keeping it zone-less."""
    return F.date_trunc("minute", _c(ts)).cast("timestamp_ntz")


def format_time(ts: Column | str) -> Column:
    """Time as staged text ``yyyy-MM-dd HH:mm:ss`` (session zone must be UTC)."""
    return F.date_format(_c(ts), TIME_TEXT_FORMAT)


def add_minutes(ts: Column | str, minutes: Column) -> Column:
    """``ts + minutes`` for a zone-less time."""
    return F.timestamp_add("MINUTE", minutes, _c(ts))


def weekday_name(ts: Column | str) -> Column:
    """Full English weekday name, e.g. ``Monday``."""
    return F.date_format(_c(ts), "EEEE")


def year_quarter(ts: Column | str) -> Column:
    """``<year>Q<quarter>``, e.g. ``2017Q4``."""
    t = _c(ts)
    return F.concat(F.year(t).cast("string"), F.lit("Q"), F.quarter(t).cast("string"))
