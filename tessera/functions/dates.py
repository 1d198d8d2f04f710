"""Date functions; the session's time zone must be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import let, strip


def epoch_date(c: Column) -> Column:
    """ISO date of an epoch in seconds, or in milliseconds if over 1e10; null if it is no number."""
    x = strip(c.cast("string")).try_cast("double")
    return F.date_format(F.timestamp_seconds(F.when(x > 1e10, x / 1000).otherwise(x)), "yyyy-MM-dd")


_TIME = r"(?:[01]\d|2[0-3])(?::[0-5]\d(?::[0-5]\d(?:[.,]\d+)?)?|[0-5]\d(?:[0-5]\d(?:[.,]\d+)?)?)?"
_ZONE = r"(?:Z|[+-](?:(?:[01]\d|2[0-2])(?::\d\d(?::\d\d(?:\.\d+)?)?|\d\d(?:\d\d(?:\.\d+)?)?)?|23(?::[0-5]\d(?::[0-5]\d(?:\.\d+)?)?|[0-5]\d(?:[0-5]\d(?:\.\d+)?)?)?))"
_ISO = rf"(?s)^(\d{{4}}-\d{{2}}-\d{{2}}|\d{{8}}|\d{{4}}-W\d{{2}}(?:-\d)?|\d{{4}}W\d{{2}}\d?)(?:.{_TIME}{_ZONE}?)?$"


def iso_date(c: Column) -> Column:
    """The date part as written, in the value's own offset; null if it is no ISO 8601 date or date and time.

    Calendar and week dates, in the extended and the basic form; any one character may stand before the time.
    """

    def read(day: Column) -> Column:
        digits = F.replace(day, F.lit("-"), F.lit(""))
        plain = F.try_to_date(digits, "yyyyMMdd")
        year, week = F.substring(digits, 1, 4).try_cast("int"), F.substring(digits, 6, 2).try_cast("int")
        weekday = F.coalesce(F.nullif(F.substring(digits, 8, 1), F.lit("")).try_cast("int"), F.lit(1))
        monday = F.date_add(F.trunc(F.to_date(F.concat(F.substring(digits, 1, 4), F.lit("-01-04"))), "week"), 7 * (week - 1))
        there = (week >= 1) & weekday.between(1, 7) & (F.year(F.date_add(monday, 3)) == year)
        return F.when(F.contains(day, F.lit("W")), F.when(there, F.date_add(monday, weekday - 1))).otherwise(plain)

    day = F.nullif(F.regexp_extract(strip(c), _ISO, 1), F.lit(""))
    return F.date_format(let(day, lambda d: F.when(~F.startswith(d, F.lit("0000")), read(d))), "yyyy-MM-dd")


def posted_date(c: Column) -> Column:
    """ISO dates, and month/day/year with or without a 12-hour time."""
    t = strip(c)
    day = F.regexp_extract(t, r"^(\d{1,2}/\d{1,2}/\d{4})(?: \d{1,2}:\d{2} [AaPp][Mm])?$", 1)
    return F.coalesce(iso_date(t), F.date_format(F.try_to_date(F.nullif(day, F.lit("")), "M/d/yyyy"), "yyyy-MM-dd"))


def sort_date(c: Column) -> Column:
    """A date to sort by; null where the text is none."""
    return F.try_to_date(F.substring(iso_date(c.cast("string")), 1, 10), "yyyy-MM-dd")
