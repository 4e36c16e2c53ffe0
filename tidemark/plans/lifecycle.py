"""Customer lifecycle: seats, active users, renewals, health, account attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fiscal, numbers
from tidemark.functions.text import not_null_label
from tidemark.operators import latest, period
from tidemark.operators.aggregates import distinct_cube


def control_flag(df: DataFrame, account: str, control: DataFrame, control_account: str) -> DataFrame:
    """'Control' for accounts of the held-out group, else 'Test'."""
    held_out = control.select(F.col(control_account).alias("_control")).distinct()
    return df.join(held_out, F.col(account) == F.col("_control"), "left").withColumn(
        "test_control", F.when(F.col("_control").isNotNull(), "Control").otherwise("Test")).drop("_control")


def seat_rate(assignments: DataFrame, usage: DataFrame, keys: Sequence[str], seat_keys: Sequence[str], day: str,
              purchased: str, assigned: str, user: str, every: int = 15) -> DataFrame:
    """Purchased, assigned and used seats on every ``every``-th day of a seat.

    Assigned seats are capped at purchased ones, users at assigned seats. Days
    are numbered per seat over all its days with a record, also those without a
    purchased seat, which are left out afterwards.
    """
    bought = F.col(purchased) != 0
    daily = assignments.groupBy(day, *keys).agg(
        F.sum(F.when(bought, F.col(purchased))).alias("seats_purchased"), F.sum(F.when(bought, F.col(assigned))).alias("_assigned"),
        F.max(F.when(bought, 1).otherwise(0)).alias("_bought"))
    numbered = latest.day_ordinal(daily, seat_keys, day, "day_bucket").filter(
        (F.col("day_bucket") % every == 0) & (F.col("_bought") == 1)).drop("_bought")
    users = usage.groupBy(day, *keys).agg(F.count_distinct(user).alias("_users"))
    seats_assigned = F.coalesce(numbers.capped("_assigned", F.col("seats_purchased")), F.lit(0))
    return (
        numbered.join(users, [day, *keys], "left")
        .withColumn("seats_assigned", seats_assigned)
        .withColumn("seats_used", F.least(F.coalesce("_users", F.lit(0)).cast("double"), F.col("seats_assigned")))
        .drop("_assigned", "_users")
    )


def active_users(usage: DataFrame, assignments: DataFrame, keys: Sequence[str], user: str, fixed: Sequence[str],
                 cube: Sequence[str]) -> DataFrame:
    """Distinct users of assigned seats over a cube, labelled by its non-NULL columns.

    Rows that differ only in which dimension was rolled up, and are equal
    otherwise, appear once.
    """
    seats = assignments.select(*keys).distinct()
    used = usage.join(seats, list(keys), "left_semi")
    cells = distinct_cube(used, list(fixed), {c: c for c in cube}, {"active_users": (user, F.lit(True))}, "C")
    return cells.drop("aggregated_by").withColumn("present", not_null_label(list(cube))).distinct()


def renewal_rate(finance: DataFrame, keys: Sequence[str], pairs: dict[str, tuple[str, str]], must_be_positive: str) -> DataFrame:
    """Renewed over up-for-renewal per key, for several measures.

    ``pairs`` maps a rate's name to (renewed, up for renewal). Identical source
    rows count once. Rows without a positive ``must_be_positive`` rate go.
    """
    columns = list(dict.fromkeys(c for pair in pairs.values() for c in pair))
    sums = finance.select(*keys, *columns).distinct().groupBy(*keys).agg(*[F.sum(c).alias(c) for c in columns])
    rated = sums.withColumns({name: numbers.ratio(top, bottom) for name, (top, bottom) in pairs.items()})
    return rated.filter(F.col(must_be_positive) > 0)


def snapshot_renewals(finance: DataFrame, keys: Sequence[str], snapshot: str, value: str, renewed: str, due: str,
                      revenue: str) -> DataFrame:
    """Seats renewed and due at one kind of snapshot, with the rate in percent."""
    sums = finance.filter(F.col(snapshot) == value).groupBy(*keys).agg(
        F.sum(renewed).alias("seats_renewed"), F.sum(due).alias("seats_due"), F.sum(revenue).alias("active_revenue"))
    rate = numbers.ratio("seats_renewed", "seats_due", 2) * 100
    return sums.withColumn("seat_renewal_rate", F.coalesce(rate, F.lit(0.0)))


def health_score(scores: DataFrame, account: str, evaluated: str, scored: str, score: str, group: Sequence[str]) -> DataFrame:
    """Average score of the latest scoring of each evaluation; equal rows once."""
    newest = latest.latest_ties(scores, [account, evaluated], scored)
    return newest.select(*group, evaluated, score, scored).distinct().groupBy(*group).agg(F.avg(score).alias("health_score"))


def revenue_growth(finance: DataFrame, account: str, year: str, amount: str) -> DataFrame:
    """Yearly revenue per account as a percentage of its earlier year."""
    yearly = finance.groupBy(account, year).agg(F.sum(amount).cast("double").alias("yearly"))
    return period.year_ratio(yearly, account, year, "yearly", "growth")


def download_rate(downloads: DataFrame, assignments: DataFrame, countries: DataFrame, user: str, product: str,
                  seat_user: str, pool: str, country: str, country_code: str) -> DataFrame:
    """Downloads by users who hold a seat in the product's pool."""
    seats = assignments.select(F.col(seat_user).alias("_user"), F.col(pool).alias("pool"), F.replace(
        F.col(pool), F.lit("1_"), F.lit("")).alias("_product")).distinct()
    asked = downloads.select(user, F.upper(F.col(product)).alias(product), F.upper(F.col(country)).alias(country)).distinct()
    held = asked.join(seats, (F.col(user) == F.col("_user")) & (F.col(product) == F.col("_product"))).drop("_user", "_product")
    return held.join(countries, F.col(country) == F.col(country_code), "left")


def latest_bands(bands: DataFrame, parent: str, child: str, year: str, quarter: str, *tiebreak: str) -> DataFrame:
    """Revenue band of the last quarter of the newest year, per parent and child."""
    first = latest.first_by(bands.distinct(), [parent, year], [F.col(quarter).desc(), *[F.col(c).asc() for c in (child, *tiebreak)]])
    newest = bands.groupBy(F.col(child).alias("_child")).agg(F.max(year).alias("_year"))
    return first.join(newest, (F.col(child) == F.col("_child")) & (F.col(year) == F.col("_year")), "left_semi")


def rolling_window(df: DataFrame, day: str, as_of: str, months: int) -> DataFrame:
    d = F.col(day)
    return df.filter((d >= fiscal.rolling_month_start(as_of, months)) & (d < fiscal.as_date(as_of)))


def renewal_window_start(as_of: str, months: int = 15):
    """First day of the fiscal quarter that holds the month ``months`` back."""
    return fiscal.quarter_begin(fiscal.rolling_month_start(as_of, months))
