"""Epochs and ISO 8601 strings. Strings keep their own offset; instants are UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.]\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?)?$"
#: Microseconds from 1601 to 1970, and from 1970 to 2001.
EPOCH_1601, EPOCH_2001 = -11_644_473_600_000_000, 978_307_200_000_000


def _iso(micros: Column) -> Column:
    """ISO 8601 with Z; the fraction is left out where it is zero."""
    ts = F.timestamp_micros(micros)
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    part = F.pmod(micros, F.lit(1_000_000))
    return F.when(micros.isNotNull(), F.concat(whole, F.when(part == 0, "").otherwise(F.concat(F.lit("."), F.lpad(part.cast("string"), 6, "0"))), F.lit("Z")))


def from_chromium(us: Column) -> Column:
    """Microseconds since 1601."""
    return _iso(us.cast("long") + EPOCH_1601)


def from_firefox(us: Column) -> Column:
    """Microseconds since 1970."""
    return _iso(us.cast("long"))


def from_safari(seconds: Column) -> Column:
    """Seconds, with a fraction, since 2001."""
    return _iso(F.rint(seconds.cast("double") * 1e6).cast("long") + EPOCH_2001)


def instant(iso: Column) -> Column:
    """The instant in UTC; null for anything that isn't ISO 8601."""
    return F.when(iso.rlike(_ISO), F.try_to_timestamp(iso))


def normalised(iso: Column) -> Column:
    """The string with Z written as an offset, its own offset kept; null if it can't be read."""
    return F.when(instant(iso).isNotNull(), F.regexp_replace(F.regexp_replace(iso, "Z$", "+00:00"), r"^(\d{4}-\d{2}-\d{2}) ", "$1T"))


def wall_clock(iso: Column) -> Column:
    """HH:mm as the string has it."""
    return F.when(instant(iso).isNotNull(), F.substring(iso, 12, 5))


def weekday(iso: Column) -> Column:
    """English name of the day as the string has it."""
    return F.when(instant(iso).isNotNull(), F.date_format(F.to_date(F.substring(iso, 1, 10)), "EEEE"))


def within_years(iso: Column, as_of: str, years: int = 5) -> Column:
    """At most so many years of 365.25 days from as_of, in whole days."""
    at = instant(iso)
    days = F.floor((F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros(at)) / F.lit(86_400_000_000))
    return F.coalesce(F.abs(days / 365.25) <= years, F.lit(False))


def within_calendar_years(iso: Column, as_of: str, years: int = 2) -> Column:
    return F.coalesce(F.abs(F.year(instant(iso)) - F.year(F.lit(as_of).cast("timestamp"))) <= years, F.lit(False))
