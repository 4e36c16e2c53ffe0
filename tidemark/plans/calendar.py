"""The fiscal calendar as a table; facts use ``functions.fiscal`` directly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import fiscal


def days(spark: SparkSession, first: str, last: str) -> DataFrame:
    bounds = spark.range(1).select(F.lit(first).cast("date").alias("a"), F.lit(last).cast("date").alias("b"))
    return bounds.select(F.explode(F.sequence("a", "b")).alias("date_key"))


def fiscal_calendar(dates: DataFrame, as_of: str, quarters_back: int = 12) -> DataFrame:
    """One row per day before ``as_of``, without the current quarter's unfinished week."""
    d = F.col("date_key")
    begin = fiscal.quarter_begin(d)
    previous, year_ago = F.add_months(begin, -3), F.add_months(begin, -12)
    table = dates.filter(
        (d < fiscal.as_date(as_of)) & (fiscal.quarters_from(d, as_of) >= -quarters_back)
        & ~fiscal.in_unfinished_week(d, as_of)
    ).select(
        d,
        fiscal.week(d).alias("fiscal_week"),
        fiscal.month(d).alias("fiscal_month"),
        fiscal.week_start(d).alias("week_start"),
        F.trunc(d, "MM").alias("month_start"),
        F.last_day(d).alias("month_end"),
        F.add_months(F.trunc(d, "MM"), -1).alias("previous_month_start"),
        begin.alias("quarter_begin"),
        fiscal.quarter_label(d).alias("fiscal_quarter"),
        previous.alias("previous_quarter_begin"),
        fiscal.quarter_label(previous).alias("previous_quarter"),
        year_ago.alias("year_ago_quarter_begin"),
        fiscal.quarter_label(year_ago).alias("year_ago_quarter"),
        fiscal.year_label(d).alias("fiscal_year"),
        fiscal.year_begin(d).alias("year_begin"),
        F.date_sub(F.add_months(fiscal.year_begin(d), 12), 1).alias("year_end"),
        fiscal.year_label(F.add_months(d, -12)).alias("last_fiscal_year"),
        fiscal.quarters_from(d, as_of).alias("quarters_from_current"),
        F.when(fiscal.quarters_from(d, as_of) == 0, 1).otherwise(0).alias("is_current_quarter"),
        fiscal.is_restricted(d, as_of).alias("is_restricted"),
    )
    completed = table.groupBy("fiscal_quarter").agg(F.max("fiscal_week").alias("completed_weeks"))
    return table.join(completed, "fiscal_quarter")


def date_hierarchy(dates: DataFrame) -> DataFrame:
    """Fiscal date attributes for joining to daily facts."""
    d = F.col("date_key")
    return dates.select(
        d, fiscal.week(d).alias("fiscal_week"), fiscal.month(d).alias("fiscal_month"),
        fiscal.quarter_label(d).alias("fiscal_quarter"), fiscal.year_label(d).alias("fiscal_year"),
        F.date_format(d, "MMM").alias("month_name"), F.date_format(d, "E").alias("day_name"),
        F.date_format(d, "MMM d, yyyy").alias("display_date"),
    ).distinct()


def by_day(facts: DataFrame, day: str, supplied: DataFrame, columns: Sequence[str], date_key: str = "date_key") -> DataFrame:
    """Attach columns of a calendar that the finance department supplies; days it lacks get NULLs.

    A supplied calendar may count weeks as it likes; nothing is derived from the date here.
    """
    days_ = supplied.select(F.col(date_key).alias("_day"), *columns).dropDuplicates(["_day"])
    return facts.join(days_, F.col(day) == F.col("_day"), "left").drop("_day")


def by_week(weekly: DataFrame, supplied: DataFrame, quarter: str, week: str, date_key: str = "date_key") -> DataFrame:
    """Attach the first and last day of each (quarter, week) of a supplied calendar."""
    weeks = supplied.groupBy(F.col(quarter).alias("_quarter"), F.col(week).alias("_week")).agg(
        F.min(date_key).alias("week_start"), F.max(date_key).alias("week_end"))
    same = (F.col(quarter) == F.col("_quarter")) & (F.col(week) == F.col("_week"))
    return weekly.join(weeks, same, "left").drop("_quarter", "_week")
