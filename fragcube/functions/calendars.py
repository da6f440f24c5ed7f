"""Dates of calendars as column arithmetic on day numbers.

Every calendar numbers its days without gaps.  In all of them but ``360_day`` the
year is counted from March, which puts the leap day last: months then start at the
same day in each year, and calendars differ only in how many days lie before a year.
``standard`` is Julian up to 4 October 1582 and Gregorian from the day after, the 15th.

Years are astronomical (there is a year 0).  A date that its calendar does not have,
an epoch that cannot be read and a unit of no fixed length are errors; NULL gives NULL.

Parts that are used more than once (the epoch, the day number) are columns of their own
while a table passes, so that expressions stay short; all of it is generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cf import MICROSECONDS, known_unit_us

# Names of calendars, and other names of them.
CALENDARS = ("360_day", "noleap", "all_leap", "julian", "proleptic_gregorian", "standard")
SAME = {"365_day": "noleap", "366_day": "all_leap", "gregorian": "standard"}
DAY_US = MICROSECONDS["days"]
#: Julian day numbers less Gregorian ones of the same day: both count from their own 1 March of year 0.
JULIAN_AHEAD = 2
REAL = {"standard": 0, "proleptic_gregorian": 0, "julian": JULIAN_AHEAD}
#: Gregorian numbers of 15 October 1582, the first day of the new style, and of 1 January 1970.
CHANGEOVER, UNIX = 578_041, 719_468
EPOCH = (
    r"^\s*(\w+)\s+since\s+([+-]?\d{1,6})-(\d{1,2})-(\d{1,2})"
    r"(?:[T\s]\s*(\d{1,2}):(\d{1,2})(?::(\d{1,2}(?:\.\d+)?))?)?\s*(?:Z|UTC|GMT|([+-])(\d{1,2}):?(\d{2})?)?\s*$"
)


def known(calendar: str) -> str:
    name = SAME.get(calendar.lower(), calendar.lower())
    if name not in CALENDARS:
        raise ValueError(f"unknown calendar {calendar!r}")
    return name


def _div(value: Column, by: int) -> Column:
    """Whole-number division, rounding down; exact below 2**53."""
    return F.floor(value / F.lit(by))


def day_number(y: Column, m: Column, d: Column, calendar: str) -> Column:
    """Number of a day, rising by one from day to day; whether the date exists is not looked at (:func:`exists`)."""
    calendar = known(calendar)
    y, m, d = y.cast("long"), m.cast("long"), d.cast("long")
    if calendar == "360_day":
        return y * 360 + (m - 1) * 30 + d - 1
    if calendar == "standard":
        new_style = (y * 100 + m) * 100 + d >= 15821015
        return F.when(new_style, day_number(y, m, d, "proleptic_gregorian")).otherwise(day_number(y, m, d, "julian") - JULIAN_AHEAD)
    year = y - F.when(m <= 2, 1).otherwise(0)  # from March
    leaps = {"noleap": F.lit(0), "all_leap": year, "julian": _div(year, 4)}.get(calendar)
    if leaps is None:
        leaps = _div(year, 4) - _div(year, 100) + _div(year, 400)
    return year * 365 + leaps + _div(F.pmod(m - 3, F.lit(12)) * 153 + 2, 5) + d - 1


def date_of(number: Column, calendar: str) -> Column:
    """``struct<y,m,d>`` of a day's number."""
    calendar, number = known(calendar), number.cast("long")
    if calendar == "360_day":
        day = F.pmod(number, F.lit(360))
        return _date(_div(number, 360), _div(day, 30) + 1, F.pmod(day, F.lit(30)) + 1)
    if calendar == "standard":
        return F.when(number >= CHANGEOVER, date_of(number, "proleptic_gregorian")).otherwise(date_of(number + JULIAN_AHEAD, "julian"))
    if calendar in ("noleap", "all_leap"):
        length = 365 if calendar == "noleap" else 366
        year, day = _div(number, length), F.pmod(number, F.lit(length))
    elif calendar == "julian":
        year = _div(number * 4 + 3, 1461)
        day = number - _div(year * 1461, 4)
    else:
        century = _div(number * 4 + 3, 146097)
        rest = number - _div(century * 146097, 4)
        own = _div(rest * 4 + 3, 1461)
        year, day = century * 100 + own, rest - _div(own * 1461, 4)
    month = _div(day * 5 + 2, 153)
    return _date(year + F.when(month >= 10, 1).otherwise(0), F.pmod(month + 2, F.lit(12)) + 1, day - _div(month * 153 + 2, 5) + 1)


def _date(y: Column, m: Column, d: Column) -> Column:
    return F.struct(y.cast("int").alias("y"), m.cast("int").alias("m"), d.cast("int").alias("d"))


def exists(y: Column, m: Column, d: Column, calendar: str) -> Column:
    """Whether a calendar has this date."""
    calendar = known(calendar)
    if calendar == "360_day":
        return m.between(1, 12) & d.between(1, 30)
    fourth, gregorian = y % 4 == 0, (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))
    leap = {"noleap": F.lit(False), "all_leap": F.lit(True), "julian": fourth, "proleptic_gregorian": gregorian}.get(calendar)
    if leap is None:
        leap = F.when(y <= 1582, fourth).otherwise(gregorian)
    length = F.when(m == 2, F.when(leap, 29).otherwise(28)).when(m.isin(4, 6, 9, 11), 30).otherwise(31)
    fits = m.between(1, 12) & (d >= 1) & (d <= length)
    return fits & ~((y == 1582) & (m == 10) & d.between(5, 14)) if calendar == "standard" else fits


#: Columns that exist while a table passes.
OWN = [f"_calendar_{k}" for k in ("parts", "y", "m", "d", "clock", "unit", "epoch", "days", "us", "number")]
PARTS, Y, M, D, CLOCK, UNIT, EPOCH_DAY, DAYS, US, NUMBER = OWN
#: Between the parts of an epoch; text that has it is no epoch.
BREAK = "\u0001"


def _with_epoch(df: DataFrame, units: Column, calendar: str) -> DataFrame:
    """Microseconds of the unit, number of the epoch's day, and microseconds in that day, zone undone.

    The pattern is matched once a row: its groups become a list.  Empty ones are not
    cast, as a cast that fails is slow even where it gives NULL.
    """
    groups = F.lit(BREAK.join(f"${i}" for i in range(1, 11)))
    split = df.withColumn(PARTS, F.split(F.regexp_replace(F.replace(units, F.lit(BREAK), F.lit("?")), F.lit(EPOCH), groups), BREAK))
    matched = F.size(PARTS) == 10
    text = lambda i: F.get(F.col(PARTS), F.lit(i - 1))
    part = lambda i, to: F.when(matched & (text(i) != ""), text(i).try_cast(to))
    hour, minute, zone_hour, zone_minute = (F.coalesce(part(i, "long"), F.lit(0)) for i in (5, 6, 9, 10))
    second = F.coalesce(F.round(part(7, "double") * 1_000_000).cast("long"), F.lit(0))
    west = F.when(matched & (text(8) == "-"), 1).otherwise(-1)
    fine = (hour < 24) & (minute < 60) & (second < 60_000_000)
    wrong = F.raise_error(F.concat(F.lit(f"no time of the calendar {calendar}: "), units)).cast("long")
    unit = F.when(matched, text(1)).otherwise(F.regexp_extract(units, r"^\s*(\w+)", 1))
    read = split.withColumns({
        Y: part(2, "long"), M: part(3, "long"), D: part(4, "long"),
        CLOCK: F.when(units.isNull(), None).when(fine, (hour * 60 + minute + west * (zone_hour * 60 + zone_minute)) * 60_000_000 + second).otherwise(wrong),
        UNIT: known_unit_us(F.when(units.isNotNull(), unit)),
    })
    is_date = exists(F.col(Y), F.col(M), F.col(D), calendar)
    number = F.when(units.isNull(), None).when(F.coalesce(is_date, F.lit(False)), day_number(F.col(Y), F.col(M), F.col(D), calendar)).otherwise(wrong)
    return read.withColumn(EPOCH_DAY, number)


def _with_moment(df: DataFrame, value: Column, units: Column, calendar: str) -> DataFrame:
    """Day number and microseconds in it.  Whole days are split off first, so long spans keep their microseconds."""
    unit, day = F.col(UNIT), F.lit(DAY_US)
    spans = value.cast("double") * F.greatest(unit / day, F.lit(1.0))  # weeks are days here
    per_day = F.greatest(day / unit, F.lit(1.0))
    whole = _with_epoch(df, units, calendar).withColumn(DAYS, F.floor(spans / per_day))
    us = F.round((spans - F.col(DAYS) * per_day) * F.least(unit, day)).cast("long") + F.col(CLOCK)
    parts = whole.withColumn(US, us)
    return parts.withColumn(NUMBER, F.col(EPOCH_DAY) + F.col(DAYS) + _div(F.col(US), DAY_US)).withColumn(US, F.pmod(F.col(US), day))


def decode(df: DataFrame, name: str, value: Column, units: Column, calendar: str) -> DataFrame:
    """``df`` with ``value``, in ``"<unit> since <epoch>"``, as ``struct<y,m,d,us>`` in column ``name``; epochs may differ by row."""
    calendar = known(calendar)
    date, number, us = date_of(F.col(NUMBER), calendar), F.col(NUMBER), F.col(US)
    whole = F.struct(date["y"].alias("y"), date["m"].alias("m"), date["d"].alias("d"), us.alias("us"))
    return _with_moment(df, value, units, calendar).withColumn(name, F.when(number.isNotNull() & us.isNotNull(), whole)).drop(*OWN)


def encode(df: DataFrame, name: str, date: Column, units: Column, calendar: str) -> DataFrame:
    """The inverse of :func:`decode`: ``struct<y,m,d,us>`` as a number of ``units``; a date that does not exist is an error."""
    calendar = known(calendar)
    wrong = F.raise_error(F.concat(F.lit(f"no date of the calendar {calendar}: "), F.concat_ws("-", date["y"], date["m"], date["d"]))).cast("long")
    number = day_number(date["y"], date["m"], date["d"], calendar)
    own = F.when(date.isNull(), None).when(exists(date["y"], date["m"], date["d"], calendar), number).otherwise(wrong)
    read = _with_epoch(df, units, calendar).withColumn(NUMBER, own)
    spans = (F.col(NUMBER) - F.col(EPOCH_DAY)) * (F.lit(DAY_US) / F.col(UNIT)) + (date["us"] - F.col(CLOCK)) / F.col(UNIT)
    return read.withColumn(name, spans).drop(*OWN)


def timestamps(df: DataFrame, name: str, value: Column, units: Column, calendar: str) -> DataFrame:
    """:func:`decode` for calendars of real days, as zone-free timestamps.

    A timestamp has Gregorian dates at all times, so days before the changeover keep
    their place in time, not their Julian date.
    """
    calendar = known(calendar)
    if calendar not in REAL:
        raise ValueError(f"dates of {calendar!r} are no timestamps")
    since = (F.col(NUMBER) - UNIX - REAL[calendar]).cast("int")
    midnight = F.date_add(F.lit("1970-01-01").cast("date"), since).cast("timestamp_ntz")
    return _with_moment(df, value, units, calendar).withColumn(name, F.timestamp_add("MICROSECOND", F.col(US), midnight)).drop(*OWN)


def convert(date: Column, calendar: str, to: str) -> Column:
    """A date of one real calendar as the date of the same day in another; model years have no such days."""
    calendar, to = known(calendar), known(to)
    if calendar not in REAL or to not in REAL:
        raise ValueError(f"days of {calendar!r} and {to!r} are not the same days")
    return date_of(day_number(date["y"], date["m"], date["d"], calendar) - REAL[calendar] + REAL[to], to)
