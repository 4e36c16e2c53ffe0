"""Fiscal dates as column expressions.

The fiscal year starts on 1 February and is named after the year it ends in:
2023-02-01 is the first day of FY24. All of these are plain expressions, so a
fact gets its fiscal columns in the scan stage, without joining a calendar.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

START_MONTH = 2
MONTHS_BEFORE = START_MONTH - 1


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def as_date(value: str | dt.date | Column) -> Column:
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("date")


def _month_position(d: Column) -> Column:
    """0 for the first fiscal month (February) up to 11 (January)."""
    return F.pmod(F.month(d) - START_MONTH, F.lit(12))


def year(d) -> Column:
    return F.year(F.add_months(_col(d), 12 - MONTHS_BEFORE))


def quarter(d) -> Column:
    return (F.floor(_month_position(_col(d)) / 3) + 1).cast("int")


def month(d) -> Column:
    return (_month_position(_col(d)) + 1).cast("int")


def quarter_index(d) -> Column:
    """Quarters as consecutive integers; subtract to get a distance."""
    return year(d) * 4 + quarter(d)


def quarter_begin(d) -> Column:
    d = _col(d)
    return F.add_months(F.trunc(d, "MM"), -F.pmod(_month_position(d), F.lit(3)))


def quarter_end(d) -> Column:
    return F.date_sub(F.add_months(quarter_begin(d), 3), 1)


def year_begin(d) -> Column:
    d = _col(d)
    return F.add_months(F.trunc(d, "MM"), -_month_position(d))


def week(d) -> Column:
    """Week of the quarter; weeks start on the quarter's first day."""
    d = _col(d)
    return (F.floor(F.datediff(d, quarter_begin(d)) / 7) + 1).cast("int")


def week_start(d) -> Column:
    d = _col(d)
    return F.date_add(quarter_begin(d), ((week(d) - 1) * 7).cast("int"))


def year_label(d) -> Column:
    return F.concat(F.lit("FY"), F.substring(year(d).cast("string"), 3, 2))


def quarter_label(d) -> Column:
    return F.concat(year_label(d), F.lit("-Q"), quarter(d).cast("string"))


def label_of_index(index) -> Column:
    """'FY24-Q1' for a ``quarter_index`` value."""
    zero_based = _col(index) - 1
    return F.concat(
        F.lit("FY"),
        F.substring(F.floor(zero_based / 4).cast("string"), 3, 2),
        F.lit("-Q"),
        (F.pmod(zero_based, F.lit(4)) + 1).cast("string"),
    )


def begin_of_index(index) -> Column:
    """First day of the quarter with this ``quarter_index``."""
    zero_based = _col(index) - 1
    return F.add_months(
        F.make_date(F.floor(zero_based / 4).cast("int") - 1, F.lit(START_MONTH), F.lit(1)),
        (F.pmod(zero_based, F.lit(4)) * 3).cast("int"),
    )


def quarters_from(d, as_of) -> Column:
    """0 in the quarter of ``as_of``, -1 in the one before, and so on."""
    return quarter_index(d) - quarter_index(as_date(as_of))


def is_restricted(d, as_of) -> Column:
    """The current quarter, and the previous one in a quarter's first month."""
    distance = quarters_from(d, as_of)
    first_month = F.month(as_date(as_of)).isin(2, 5, 8, 11)
    return F.when((distance == 0) | ((distance == -1) & first_month), 1).otherwise(0)


def in_unfinished_week(d, as_of) -> Column:
    """True for days of the current quarter whose week has under 7 days so far."""
    start = week_start(d)
    last_day = F.least(F.date_add(start, 6), quarter_end(d), F.date_sub(as_date(as_of), 1))
    return (quarters_from(d, as_of) == 0) & (F.datediff(last_day, start) + 1 < 7)


def window_start(as_of, quarters_back: int) -> Column:
    """First day of the quarter ``quarters_back`` before the one of ``as_of``."""
    return F.add_months(quarter_begin(as_date(as_of)), -3 * quarters_back)


def rolling_month_start(as_of, months_back: int) -> Column:
    return F.trunc(F.add_months(as_date(as_of), -months_back), "MM")


def label_first_day(label) -> Column:
    """'2022Q1' to the display date '2022-02-01' (Q2 May, Q3 August, Q4 November)."""
    label = _col(label)
    suffix = F.right(label, F.lit(2))
    day = (
        F.when(suffix == "Q1", "-02-01")
        .when(suffix == "Q2", "-05-01")
        .when(suffix == "Q3", "-08-01")
        .when(suffix == "Q4", "-11-01")
    )
    return F.concat(F.substring(label, 1, 4), day)


def fund_quarter(name) -> Column:
    """'1Q FY22 ...' or '1QFY22...' to '2022Q1'."""
    name = _col(name)
    packed = F.replace(name, F.lit(" "), F.lit(""))
    return F.concat(F.lit("20"), F.substring(packed, 5, 2), F.lit("Q"), F.substring(name, 1, 1))


def gate_quarter(d) -> Column:
    """Quarter gate of a claim-by date; 1 and 2 March still count as winter."""
    d = _col(d)
    y, m = F.year(d), F.month(d)
    winter_exception = (m == 3) & F.dayofmonth(d).isin(1, 2)
    shift = F.when(~winter_exception & (m >= 9), 2).otherwise(1)
    q = (
        F.when(winter_exception | m.isin(12, 1, 2), "Q2")
        .when(m <= 5, "Q3")
        .when(m <= 8, "Q4")
        .otherwise("Q1")
    )
    return F.concat((y + shift).cast("string"), q)


def relative_quarter_bucket(d, as_of) -> Column:
    """Ordered display bucket of a date's quarter against the current one."""
    distance = quarters_from(d, as_of)
    return (
        F.when(distance == 0, "1. Current Qtr")
        .when(distance == -1, "2. Previous Qtr")
        .when(distance == -2, "3. Two Qtrs Ago")
        .when(distance < -2, "4. Older")
        .otherwise("5. Future")
    )


def workdays(start, end) -> Column:
    """Monday-to-Friday days after ``start`` up to ``end``, closed form.

    Whole weeks give five days each; the remainder is counted over the ISO
    weekday of both ends, so no calendar join and no per-row sequence.
    """
    start, end = _col(start), _col(end)

    def before(d: Column) -> Column:
        # Monday-to-Friday days in [1970-01-05 (a Monday), d]
        days = F.datediff(d, F.lit("1970-01-05").cast("date")) + 1
        return F.floor(days / 7) * 5 + F.least(F.pmod(days, F.lit(7)), F.lit(5))

    return (before(end) - before(start)).cast("int")


def boundary_weeks(start, end) -> Column:
    """Sunday boundaries crossed, as a warehouse DATEDIFF(week) counts them."""
    epoch = F.lit("1970-01-04").cast("date")
    number = lambda d: F.floor(F.datediff(_col(d), epoch) / 7)
    return (number(end) - number(start)).cast("int")


def workday_distance(start, end) -> Column:
    """Days less two per Monday crossed, plus one from a Sunday, less one to a Saturday.

    The warehouse formula, kept beside ``workdays`` because the two differ at
    weekends.
    """
    start, end = _col(start), _col(end)
    monday = F.lit("1970-01-05").cast("date")
    weeks = F.floor(F.datediff(end, monday) / 7) - F.floor(F.datediff(start, monday) / 7)
    from_sunday = F.when(F.dayofweek(start) == 1, 1).otherwise(0)
    to_saturday = F.when(F.dayofweek(end) == 7, 1).otherwise(0)
    return (F.datediff(end, start) - weeks * 2 + from_sunday - to_saturday).cast("int")


def boundary_days(start, end) -> Column:
    """Midnights crossed between two timestamps."""
    return F.datediff(_col(end).cast("date"), _col(start).cast("date"))


def sunday_week(d) -> tuple[Column, Column]:
    """The Sunday and Saturday around a date."""
    d = _col(d)
    start = F.date_sub(d, F.dayofweek(d) - 1)
    return start, F.date_add(start, 6)
