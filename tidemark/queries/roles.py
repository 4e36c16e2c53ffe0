"""The roles the given tables play, in Spark and in SQL.

orders/lineitem are sales, customer/nation/region the accounts, part the
products, events the web activity, documents the posts.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.tables import Catalog

SALES_AS_OF = "2001-07-15"
WEB_AS_OF = "2024-01-31"


def money(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)")


def net_units() -> Column:
    """Extended price less discount in ten-thousandths, as a whole number.

    Cents times percent points: exact like decimals, at the cost of long
    arithmetic. Sum it over small groups only; beyond, use ``as_money``.
    """
    cents = F.rint(F.col("l_extendedprice") * 100).cast("bigint")
    return cents * (F.lit(100) - F.rint(F.col("l_discount") * 100).cast("bigint"))


def as_money(units: Column) -> Column:
    """Ten-thousandths as a decimal, for sums of any size."""
    return (units.cast("decimal(18,0)") * F.lit(Decimal("0.0001"))).cast("decimal(24,4)")


def net_amount() -> Column:
    """Extended price less discount, exact to four decimals."""
    return as_money(net_units())


SQL_NET = "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(24,4))"


def order_day() -> Column:
    return F.col("o_orderdate").cast("date")


def order_amounts(t: Catalog) -> DataFrame:
    """One row per order: its date, customer, priority, status and net amount.

    Lines are summed before the join, on the join's own key.
    """
    lines = t.lineitem.groupBy("l_orderkey").agg(
        as_money(F.sum(net_units())).alias("net"), F.count(F.lit(1)).alias("lines"))
    heads = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", order_day().alias("day"))
    return heads.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).drop("l_orderkey")


SQL_ORDER_AMOUNTS = f"""order_amounts AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, CAST(o_orderdate AS DATE) AS day, net, lines
  FROM orders JOIN (SELECT l_orderkey, sum({SQL_NET}) AS net, count(*) AS lines FROM lineitem GROUP BY 1)
    ON o_orderkey = l_orderkey)"""


def accounts(t: Catalog) -> DataFrame:
    return (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "c_name", "c_mktsegment", "c_acctbal", "n_nationkey",
                F.col("n_name").alias("country"), F.col("r_name").alias("geo"))
    )


SQL_ACCOUNTS = """accounts AS (
  SELECT c_custkey, c_name, c_mktsegment, c_acctbal, n_nationkey, n_name AS country, r_name AS geo
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


# Fiscal expressions for the SQL twins.

def sql_year(d: str) -> str:
    return f"year({d} + INTERVAL 11 MONTH)"


def sql_quarter(d: str) -> str:
    return f"(((month({d}) + 10) % 12) // 3 + 1)"


def sql_index(d: str) -> str:
    return f"({sql_year(d)} * 4 + {sql_quarter(d)})"


def sql_begin(d: str) -> str:
    return f"CAST(date_trunc('month', {d}) - ((month({d}) + 10) % 3) * INTERVAL 1 MONTH AS DATE)"


def sql_week(d: str) -> str:
    return f"((CAST({d} AS DATE) - {sql_begin(d)}) // 7 + 1)"


def sql_label(d: str) -> str:
    return f"('FY' || right(CAST({sql_year(d)} AS VARCHAR), 2) || '-Q' || {sql_quarter(d)})"


def sql_index_label(i: str) -> str:
    return f"('FY' || right(CAST(({i} - 1) // 4 AS VARCHAR), 2) || '-Q' || (({i} - 1) % 4 + 1))"


def sql_from(d: str, as_of: str) -> str:
    return f"({sql_index(d)} - {sql_index(f'DATE {chr(39)}{as_of}{chr(39)}')})"


def sql_calendar(as_of: str, first: str, back: int = 12) -> str:
    """The calendar by windows over its days, independent of the column rules."""
    a = f"DATE '{as_of}'"
    return f"""calendar_days AS (
  SELECT CAST(d AS DATE) AS date_key, {sql_index('d')} AS qi, {sql_week('d')} AS fiscal_week
  FROM (SELECT unnest(generate_series(DATE '{first}', {a} - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d)
  WHERE {sql_from('d', as_of)} >= -{back}),
calendar AS (
  SELECT *, max(fiscal_week) OVER (PARTITION BY qi) AS completed_weeks FROM (
    SELECT *, count(*) OVER (PARTITION BY qi, fiscal_week) AS days_in_week,
           min(date_key) OVER (PARTITION BY qi, fiscal_week) AS week_start
    FROM calendar_days)
  WHERE NOT (qi = {sql_index(a)} AND days_in_week < 7))"""
