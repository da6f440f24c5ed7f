"""Calendars against tables of all their days, built from the lengths of months alone."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from fragcube.functions import calendars

LEAP = {
    "noleap": lambda y: False,
    "all_leap": lambda y: True,
    "julian": lambda y: y % 4 == 0,
    "proleptic_gregorian": lambda y: y % 4 == 0 and (y % 100 != 0 or y % 400 == 0),
    "standard": lambda y: y % 4 == 0 and (y <= 1582 or y % 100 != 0 or y % 400 == 0),
}


def day_table(calendar, first, last):
    out = []
    for y in range(first, last):
        for m in range(1, 13):
            n = 30 if calendar == "360_day" else 30 if m in (4, 6, 9, 11) else 31 if m != 2 else 29 if LEAP[calendar](y) else 28
            out += [(y, m, d) for d in range(1, n + 1) if not (calendar == "standard" and (y, m) == (1582, 10) and 5 <= d <= 14)]
    return np.array(out, np.int32)


@pytest.mark.parametrize("calendar", [*LEAP, "360_day"])
def test_every_day_of_three_thousand_years(spark, calendar):
    want = day_table(calendar, -600, 2400)
    units = F.lit("days since -600-01-01")
    got = calendars.decode(spark.range(len(want)), "at", F.col("id"), units, calendar)
    got = calendars.encode(got, "back", F.col("at"), units, calendar).select("id", "at.y", "at.m", "at.d", "back").toArrow().to_pandas().sort_values("id")
    assert (got[["y", "m", "d"]].to_numpy() == want).all() and (got["back"] == got["id"]).all()


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def of(spark, how, *rest):
    return how(spark.range(1), "v", *rest).first()["v"]


def test_epochs_zones_and_parts_of_days(spark):
    at = lambda v, units, calendar: tuple(of(spark, calendars.decode, F.lit(v), F.lit(units), calendar))
    assert at(1, "days since 1582-10-04", "standard") == (1582, 10, 15, 0)
    assert at(1, "days since 1582-10-04", "julian") == (1582, 10, 5, 0)
    assert at(-1, "day since 2001-03-01", "all_leap") == (2001, 2, 29, 0)
    assert at(1, "days since 2000-02-28 18:30", "365_day") == (2000, 3, 1, 66_600_000_000)
    assert at(0, "hours since 2000-01-01 00:30:00 +01:00", "noleap") == (1999, 12, 31, 84_600_000_000)
    assert at(-0.25, "seconds since 2000-01-01T00:00:00Z", "360_day") == (1999, 12, 30, 86_399_750_000)
    assert at(1.5, "weeks since 2000-02-25", "360_day") == (2000, 3, 5, 43_200_000_000)
    assert at(3000 * 365 * 24 + 0.5, "hours since 0000-01-01", "noleap") == (3000, 1, 1, 1_800_000_000)
    assert of(spark, calendars.decode, F.lit(None).cast("double"), F.lit("days since 2000-01-01"), "noleap") is None
    assert of(spark, calendars.decode, F.lit(1.0), F.lit(None).cast("string"), "noleap") is None


@pytest.mark.parametrize("units, calendar", [
    ("days since 2001-02-29", "noleap"), ("days since 2000-01-31", "360_day"), ("days since 1582-10-10", "standard"), ("days since 2000-13-01", "julian"),
    ("days since soon", "noleap"), ("months since 2000-01-01", "noleap"), ("days since 2000-01-01 24:00", "noleap"), ("2000-01-01", "noleap"),
])
def test_what_is_no_epoch_is_an_error(spark, units, calendar):
    with pytest.raises(Exception, match="no time of the calendar|not a unit of time"):
        of(spark, calendars.decode, F.lit(1.0), F.lit(units), calendar)


def test_dates_that_do_not_exist_are_no_numbers(spark):
    date = F.struct(F.lit(2001).alias("y"), F.lit(2).alias("m"), F.lit(29).alias("d"), F.lit(0).alias("us"))
    assert of(spark, calendars.encode, date, F.lit("days since 2001-01-01"), "all_leap") == 59
    with pytest.raises(Exception, match="no date of the calendar"):
        of(spark, calendars.encode, date, F.lit("days since 2001-01-01"), "noleap")


def test_real_days_in_other_calendars(spark):
    date = lambda y, m, d: F.struct(F.lit(y).alias("y"), F.lit(m).alias("m"), F.lit(d).alias("d"))
    assert tuple(one(spark, calendars.convert(date(1582, 10, 15), "standard", "julian"))) == (1582, 10, 5)
    assert tuple(one(spark, calendars.convert(date(1917, 10, 25), "julian", "gregorian"))) == (1917, 11, 7)
    with pytest.raises(ValueError):
        calendars.convert(date(2000, 1, 1), "360_day", "julian")
    at = lambda v, units, calendar: of(spark, calendars.timestamps, F.lit(v), F.lit(units), calendar)
    assert at(730_121.5, "days since 0001-01-01", "standard") == datetime.datetime(2000, 1, 1, 12)  # its epoch lies two days before the Gregorian one
    assert at(730_119.5, "days since 0001-01-01", "proleptic_gregorian") == datetime.datetime(2000, 1, 1, 12)
    assert at(0, "days since 1917-10-25", "julian") == datetime.datetime(1917, 11, 7)
    with pytest.raises(ValueError):
        at(0, "days since 2000-01-01", "noleap")


def test_the_pattern_of_an_epoch_is_matched_once(spark):
    epochs = ["days since 2000-02-28", "hours since 2000-02-28 06:00", "hours since 2000-02-28 06:00:00.5 -06:30", "\u0001" * 9, None]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(epochs)], "i int, units string")
    out = calendars.decode(df.filter("i <> 3"), "at", F.lit(24.0), F.col("units"), "noleap")
    assert out._jdf.queryExecution().optimizedPlan().toString().count(calendars.EPOCH[:12]) == 1
    got = {r["i"]: r["at"] and tuple(r["at"]) for r in out.collect()}
    assert got == {0: (2000, 3, 24, 0), 1: (2000, 3, 1, 21_600_000_000), 2: (2000, 3, 1, 45_000_500_000), 4: None}
    with pytest.raises(Exception, match="no time of the calendar|not a unit of time"):
        calendars.decode(df.filter("i = 3"), "at", F.lit(24.0), F.col("units"), "noleap").collect()
