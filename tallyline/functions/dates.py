"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyline.functions.numbers import ratio


def parse_date_text(col: Column, pivot_year: int = 70) -> Column:
    """Date from day/month/two-digit-year text, with or without leading zeros; NULL if not a date.

    Spark reads every two-digit year as 20xx, so years from ``pivot_year`` on are moved to 19xx.
    """
    parsed = F.try_to_date(col, "d/M/yy")
    return F.when(F.year(parsed) >= 2000 + pivot_year, F.add_months(parsed, -1200)).otherwise(parsed)


# Year, month, day and what there is of hour, minute, second and its fraction, told apart by place: any one sign or
# none may stand between two fields, and any few between the day and the hour.
_TIME_FIELDS = (
    r"^\s*(\d{4})\D?(\d{1,2})\D?(\d{1,2})"
    r"(?:\D{0,3}(\d{1,2})(?:\D?(\d{1,2})(?:\D?(\d{1,2})(?:[.,](\d{1,6})\d*)?)?)?)?\s*Z?\s*$"
)


def parse_time_text(col: Column) -> Column:
    """Time from text that gives its fields in order, whatever separates them; NULL if it is no time.

    Missing hours, minutes and seconds are 0, digits of a second past the sixth are cut off, and a zone other than Z
    is not read. ``2021-01-08 21:10:57``, ``2021/1/8 21.10`` and ``20210108T211057`` are read alike but for seconds.
    """
    fields = [F.regexp_extract(col, _TIME_FIELDS, i) for i in range(1, 8)]
    year, month, day, hour, minute = (F.coalesce(f.try_cast("int"), F.lit(0)) for f in fields[:5])
    whole = F.coalesce(fields[5].try_cast("int"), F.lit(0)).cast("string")
    second = F.concat(whole, F.lit("."), fields[6], F.lit("0")).cast("decimal(8,6)")
    return F.when(col.rlike(_TIME_FIELDS), F.try_make_timestamp_ntz(year, month, day, hour, minute, second))


def dow_sunday_zero(col: Column) -> Column:
    return F.dayofweek(col) - 1


def year_month(col: Column) -> Column:
    """``yyyy-MM`` text."""
    return F.date_format(col, "yyyy-MM")


def day_of(col: Column) -> Column:
    return F.to_date(col)


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end``, taken from the interval so that no time zone enters."""
    gap = end - start
    return (
        F.extract(F.lit("DAY"), gap) * 86400
        + F.extract(F.lit("HOUR"), gap) * 3600
        + F.extract(F.lit("MINUTE"), gap) * 60
        + F.floor(F.extract(F.lit("SECOND"), gap))
    )


def minutes_between(start: Column, end: Column, digits: int = 2) -> Column:
    return ratio(seconds_between(start, end), F.lit(60), digits)
