"""Naive-timestamp and model-calendar expressions.

Times are TIMESTAMP_NTZ throughout: the data carry no zone, and an expression
on naive timestamps cannot depend on the session time zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND_US = 1_000_000
HOUR_US = 3_600 * SECOND_US
DAY_US = 24 * HOUR_US
UNIT_US = {"days": DAY_US, "hours": HOUR_US}


def naive(t: Column) -> Column:
    """Timestamp (or ISO text such as ``2000-01-31 06:00``) as TIMESTAMP_NTZ."""
    return t.cast("timestamp_ntz")


def _epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def _one_micro() -> Column:
    return F.expr("INTERVAL '0 00:00:00.000001' DAY TO SECOND")


def micros(t: Column) -> Column:
    """Microseconds since 1970-01-01, independent of the session zone."""
    return F.call_function("div", naive(t) - _epoch(), _one_micro())


def from_micros(us: Column) -> Column:
    """Inverse of :func:`micros`."""
    return _epoch() + _one_micro() * us


def floor_to(us: Column, width: int) -> Column:
    """Largest multiple of ``width`` not above ``us``, in integers."""
    return us - F.pmod(us, F.lit(width))


def midnight(t: Column) -> Column:
    return naive(t).cast("date").cast("timestamp_ntz")


def month_day(t: Column) -> Column:
    """``month*100 + day``, e.g. 1231 for New Year's Eve."""
    return F.month(t) * 100 + F.dayofmonth(t)


def is_leap_day(t: Column) -> Column:
    return month_day(t) == 229


def keeps_leap_day(calendar: str) -> bool:
    return calendar.lower() != "noleap"


def day_bound(day: str | dt.date) -> Column:
    """Midnight of a literal day."""
    return F.lit(str(day)).cast("date").cast("timestamp_ntz")


def in_years(t: Column, first: int, last: int) -> Column:
    """Inclusive year range, written as a timestamp range so that it reaches the scan."""
    return (t >= day_bound(f"{first:04d}-01-01")) & (t < day_bound(f"{last + 1:04d}-01-01"))


def in_half_open(t: Column, start: str | dt.date, end: str | dt.date) -> Column:
    return (t >= day_bound(start)) & (t < day_bound(end))


def in_days(t: Column, first: str, last: str) -> Column:
    """Inclusive slice between bare dates; the last date covers its whole day."""
    after = dt.date.fromisoformat(last) + dt.timedelta(days=1)
    return in_half_open(t, first, after)


def stamp(t: Column, precision: str = "second") -> Column:
    """``yyyy-MM-dd HH:mm[:ss]`` text without going through a time zone."""
    width = {"minute": 16, "second": 19}[precision]
    return F.substring(naive(t).cast("string"), 1, width)


# --- calendars Spark has no type for ---------------------------------------------------


def civil_key(year: Column, month: Column, day: Column) -> Column:
    """Sortable integer date, valid in every calendar (Feb 30 included)."""
    return year * 10000 + month * 100 + day


def _bound_key(day: str, calendar: Column) -> Column:
    y, m, d = (int(p) for p in day.split("-"))
    key = lambda dd: F.lit(y * 10000 + m * 100 + dd)
    return F.when(calendar == "360_day", key(min(d, 30))).otherwise(key(d))


def in_calendar_window(
    year: Column, month: Column, day: Column, second: Column, calendar: Column, first: str, last: str
) -> Column:
    """Inclusive window between midnights, read in the calendar of each row.

    Rows after 00:00 on the last date fall outside, because the bound is midnight.
    A 360-day calendar has no day 31, so the bound is moved to day 30.
    """
    key = civil_key(year, month, day)
    end = _bound_key(last, calendar)
    return (key >= _bound_key(first, calendar)) & ((key < end) | ((key == end) & (second == 0)))


def civil_iso(year: Column, month: Column, day: Column, second: Column) -> Column:
    """ISO text of calendar fields; the only portable form for non-Gregorian dates."""
    second = second.cast("int")
    return F.format_string(
        "%04d-%02d-%02d %02d:%02d:%02d",
        year.cast("int"),
        month.cast("int"),
        day.cast("int"),
        F.floor(second / 3600).cast("int"),
        F.floor(F.pmod(second, F.lit(3600)) / 60).cast("int"),
        F.pmod(second, F.lit(60)).cast("int"),
    )


def noleap_day_of_year(t: Column) -> Column:
    """Day of year with Feb 29 taken out (Mar 1 is always day 60)."""
    leap = F.dayofyear(F.make_date(F.year(t), F.lit(12), F.lit(31))) == 366
    return F.dayofyear(t) - F.when(leap & (F.month(t) > 2), 1).otherwise(0)


def noleap_day_number(t: Column) -> Column:
    """Days on a 365-day calendar; differences ignore every Feb 29."""
    return F.year(t) * 365 + noleap_day_of_year(t) - 1


def elapsed(t: Column, since: Column, unit: str) -> Column:
    """Real elapsed time in ``unit``."""
    return (micros(t) - micros(since)) / F.lit(float(UNIT_US[unit]))


def elapsed_noleap(t: Column, since: Column, unit: str) -> Column:
    """Elapsed time on the 365-day calendar."""
    pos = lambda c: noleap_day_number(c).cast("bigint") * DAY_US + (micros(c) - micros(midnight(c)))
    return (pos(t) - pos(since)) / F.lit(float(UNIT_US[unit]))


def decode_offset(offset: Column, units: Column, calendar: Column) -> Column:
    """Fields ``(year, month, day, second)`` of an offset such as 59.25 *days since 2000-01-01*.

    ``standard``, ``noleap`` and ``360_day`` axes are decoded with integer day
    arithmetic, so the result also holds dates that Spark's own types cannot.
    """
    since = naive(F.regexp_extract(units, r"since\s+(.+)$", 1))
    per_unit = F.when(units.startswith("hours"), F.lit(HOUR_US)).otherwise(F.lit(DAY_US))
    in_day = F.rint(offset * per_unit).cast("bigint") + (micros(since) - micros(midnight(since)))
    days = F.call_function("div", floor_to(in_day, DAY_US), F.lit(DAY_US)).cast("int")
    second = F.call_function("div", F.pmod(in_day, F.lit(DAY_US)), F.lit(SECOND_US)).cast("int")

    greg = F.date_add(since.cast("date"), days)
    n365 = noleap_day_number(since) + days
    # any non-leap year gives month and day of a 365-day position
    pos = F.date_add(F.lit("2001-01-01").cast("date"), F.pmod(n365, F.lit(365)))
    n360 = F.year(since) * 360 + (F.month(since) - 1) * 30 + (F.dayofmonth(since) - 1) + days

    def fields(y, m, d):
        return F.struct(
            y.cast("int").alias("year"), m.cast("int").alias("month"), d.cast("int").alias("day"), second.alias("second")
        )

    return (
        F.when(calendar == "noleap", fields(F.floor(n365 / 365), F.month(pos), F.dayofmonth(pos)))
        .when(
            calendar == "360_day",
            fields(
                F.floor(n360 / 360), F.floor(F.pmod(n360, F.lit(360)) / 30) + 1, F.pmod(n360, F.lit(30)) + 1
            ),
        )
        .otherwise(fields(F.year(greg), F.month(greg), F.dayofmonth(greg)))
    )
