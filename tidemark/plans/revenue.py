"""Revenue facts: fiscal weeks and quarters with their comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fiscal
from tidemark.operators import period
from tidemark.operators.aggregates import distinct_cube


def with_fiscal_week(df: DataFrame, day: str) -> DataFrame:
    return df.withColumns({"quarter_index": fiscal.quarter_index(day), "fiscal_week": fiscal.week(day)})


def in_calendar(df: DataFrame, day: str, as_of: str, quarters_back: int = 6) -> DataFrame:
    """Facts the reporting calendar covers: recent quarters, finished weeks."""
    d = F.col(day)
    return df.filter(
        (d < fiscal.as_date(as_of)) & (d >= fiscal.window_start(as_of, quarters_back))
        & ~fiscal.in_unfinished_week(d, as_of)
    )


def by_account_week(sales: DataFrame, account: str, day: str, as_of: str, measures: Sequence[Column],
                    dims: Sequence[str] = (), quarters_back: int = 6) -> DataFrame:
    """Sales summed per account and fiscal week.

    Done before account attributes are joined: an account with a third of all
    sales brings one row per week to that join.
    """
    recent = with_fiscal_week(in_calendar(sales, day, as_of, quarters_back), day)
    return recent.groupBy(account, "quarter_index", "fiscal_week", *dims).agg(*measures)


def labelled(df: DataFrame) -> DataFrame:
    """Quarter index to its label, first day and week start."""
    begin = fiscal.begin_of_index("quarter_index")
    return df.withColumns({
        "fiscal_quarter": fiscal.label_of_index("quarter_index"),
        "quarter_begin": begin,
    })


def weekly_fact(weekly: DataFrame, dims: Sequence[str], measures: Sequence[str], as_of: str) -> DataFrame:
    """Weekly totals by ``dims`` beside the previous and the year-ago quarter's week."""
    base = weekly.groupBy("quarter_index", "fiscal_week", *dims).agg(*[F.sum(m).alias(m) for m in measures])
    compared = period.weekly_comparison(base, "quarter_index", "fiscal_week", dims, measures, as_of)
    return labelled(compared).withColumn(
        "week_start", F.expr("date_add(quarter_begin, (fiscal_week - 1) * 7)"))


def quarterly_fact(weekly: DataFrame, dims: Sequence[str], measures: Sequence[str], as_of: str) -> DataFrame:
    """Quarter totals; the current quarter compares with equal weeks of the others."""
    base = weekly.groupBy("quarter_index", "fiscal_week", *dims).agg(*[F.sum(m).alias(m) for m in measures])
    last_week = period.weeks_in_quarter(fiscal.quarter_index(fiscal.as_date(as_of)), as_of)
    return labelled(period.quarterly_comparison(
        base, "quarter_index", "fiscal_week", dims, measures, as_of, last_week))


def order_count_cube(orders: DataFrame, order_id: str, day: str, dims: dict[str, str], fixed: Sequence[str],
                     as_of: str, prefix: str, quarters_back: int = 6) -> DataFrame:
    """Distinct orders per quarter over a labelled cube, with QoQ and YoY.

    An order counts as "to date" when its first week is within the weeks the
    current quarter has completed.
    """
    recent = with_fiscal_week(in_calendar(orders, day, as_of, quarters_back), day)
    this = fiscal.quarter_index(fiscal.as_date(as_of))
    last_week = period.weeks_in_quarter(this, as_of)
    to_date = F.col("fiscal_week") <= last_week
    cells = distinct_cube(
        recent, ["quarter_index", *fixed], dims,
        {"orders": (order_id, F.lit(True)), "orders_to_date": (order_id, to_date)}, prefix)
    return labelled(period.cell_comparison(
        cells, "quarter_index", [*fixed, *dims, "aggregated_by"], ["orders"], as_of, to_date=["orders_to_date"]))


def source_measures(sales: DataFrame, keys: Sequence[str], amount: str, source: str, kind: str, phase: str,
                    new_part: str, expansion_part: str, net_new_part: str) -> DataFrame:
    """Total, new-business and new-customer revenue, ruled by source, and the rest.

    Integrated sources count new orders in full; the core source names its new,
    expansion and net-new parts itself: new business is new and expansion, new
    customers are new and net-new. Renewal and expansion follow by difference.
    """
    integrated, unintegrated, core = (F.col(source) == s for s in ("Integrated", "Unintegrated", "Core"))
    is_new = F.upper(F.col(kind)) == "NEW"
    zero = F.lit(0).cast("decimal(24,4)")
    new_business = (
        F.when((integrated | unintegrated) & is_new, F.col(amount))
        .when(core, F.coalesce(F.col(new_part), zero) + F.coalesce(F.col(expansion_part), zero))
    )
    new_customer = (
        F.when(integrated & F.col(phase).isNotNull() & is_new, F.col(amount))
        .when(core, F.coalesce(F.col(new_part), zero) + F.coalesce(F.col(net_new_part), zero))
    )
    summed = sales.groupBy(*keys).agg(
        F.sum(amount).alias("total"), F.sum(new_business).alias("new_business"),
        F.sum(new_customer).alias("new_customer"))
    return summed.withColumns({
        "renewal": F.coalesce("total", zero) - F.coalesce("new_business", zero),
        "expansion": F.coalesce("new_business", zero) - F.coalesce("new_customer", zero),
    })
