"""Week and month periods as Column expressions.

A week is an int YYYYWW of the ISO calendar, with a 53rd week in some years; a month is YYYYMM. The index of a week counts
whole weeks from Monday 1970-01-05, so that differences of indexes are weeks in any year.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "DATE'1970-01-05'"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def year_week(date: Column | str) -> Column:
    """ISO YYYYWW of a date."""
    return (F.date_part(F.lit("YEAROFWEEK"), col(date)) * 100 + F.weekofyear(col(date))).cast("int")


def monday(week: Column | str) -> Column:
    """First day of a week YYYYWW."""
    w = col(week).cast("int")
    first = F.trunc(F.make_date(F.floor(w / 100).cast("int"), F.lit(1), F.lit(4)), "week")
    return F.date_add(first, 7 * (w % 100 - 1))


def week_index(date: Column | str) -> Column:
    return F.floor(F.datediff(col(date).cast("date"), F.expr(EPOCH)) / 7).cast("int")


def from_index(index: Column | str) -> Column:
    """YYYYWW of a week index."""
    return year_week(F.date_add(F.expr(EPOCH), 7 * col(index)))


def add_weeks(week: Column | str, n: Column | int) -> Column:
    """The week n weeks later, right across years of 52 and 53 weeks."""
    return year_week(F.date_add(monday(week), F.lit(7) * n))


def add_periods(period: Column | str, n: Column | int, per_year: int = 52) -> Column:
    """As add_weeks for years of always per_year periods; a 53rd week counts as the first of the next year."""
    at = F.floor(col(period) / 100) * per_year + col(period) % 100 - 1 + n
    return (F.floor(at / per_year) * 100 + F.pmod(at, F.lit(per_year)) + 1).cast("int")


def last_year(week: Column | str, clamp: bool = False) -> Column:
    """The same week a year before; with clamp week 53 becomes week 52."""
    before = (col(week) - 100).cast("int")
    return F.when(col(week) % 100 == 53, before - 1).otherwise(before) if clamp else before


def normalise(text: Column | str) -> Column:
    """`2025-9` and `2025/9` as `2025-09`; what is all digits stays; other texts become null."""
    t = F.trim(col(text).cast("string"))
    dashed = r"^(\d{4})[-/](\d{1,2})$"
    joined = F.concat_ws("-", F.regexp_extract(t, dashed, 1), F.lpad(F.regexp_extract(t, dashed, 2), 2, "0"))
    return F.when(t.rlike(r"^\d+$"), t).when(t.rlike(dashed), joined)


def forecast_step(week: Column | str, snapshot: Column | str) -> Column:
    """Whole weeks from the snapshot's week to the forecast's, plus one."""
    return (F.floor(F.datediff(monday(week), monday(snapshot)) / 7) + 1).cast("int")


def easter(year: Column | str) -> Column:
    """Easter Sunday of a Gregorian year."""
    y = col(year).cast("int")
    div = lambda a, b: F.floor(a / b).cast("int")
    golden, century = y % 19, div(y, 100)
    skipped, moon = div(century, 4), div(century + 8, 25)
    epact = (19 * golden + century - skipped - div(century - moon + 1, 3) + 15) % 30
    weekday = (32 + 2 * (century % 4) + 2 * div(y % 100, 4) - epact - y % 100 % 4) % 7
    late = div(golden + 11 * epact + 22 * weekday, 451)
    days = epact + weekday - 7 * late + 114
    return F.make_date(y, div(days, 31), days % 31 + 1)
