"""Revenue by fiscal period: calendar, week and quarter comparisons, cubes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import fiscal
from tidemark.operators import period
from tidemark.operators.aggregates import labeled_cube, with_total
from tidemark.operators.joins import densify
from tidemark.plans import calendar, revenue, traffic
from tidemark.queries.output import plain
from tidemark.queries.registry import query
from tidemark.queries.roles import (
    SALES_AS_OF, SQL_ACCOUNTS, SQL_ORDER_AMOUNTS, accounts, order_amounts, order_day, sql_begin, sql_calendar,
    sql_from, sql_index, sql_index_label, sql_label, sql_week, sql_year,
)
from tidemark.sources.tables import Catalog

AS_OF = SALES_AS_OF
A = f"DATE '{AS_OF}'"


def order_days(t: Catalog):
    """The distinct days on which something was ordered."""
    return t.orders.select(order_day().alias("date_key")).distinct()


@query("fiscal_calendar", "K1 W10 W11 O1", f"""
WITH {sql_calendar(AS_OF, '1990-01-01')},
order_days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date_key FROM orders)
SELECT CAST(date_key AS VARCHAR) AS date_key, fiscal_week, CAST((month(date_key) + 10) % 12 + 1 AS BIGINT) AS fiscal_month,
  CAST(week_start AS VARCHAR) AS week_start,
  CAST(CAST(date_trunc('month', date_key) AS DATE) AS VARCHAR) AS month_start,
  CAST(last_day(date_key) AS VARCHAR) AS month_end,
  CAST(CAST(date_trunc('month', date_key) - INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS previous_month_start,
  CAST({sql_begin('date_key')} AS VARCHAR) AS quarter_begin, {sql_label('date_key')} AS fiscal_quarter,
  CAST(CAST({sql_begin('date_key')} - INTERVAL 3 MONTH AS DATE) AS VARCHAR) AS previous_quarter_begin,
  {sql_index_label('(qi - 1)')} AS previous_quarter,
  CAST(CAST({sql_begin('date_key')} - INTERVAL 12 MONTH AS DATE) AS VARCHAR) AS year_ago_quarter_begin,
  {sql_index_label('(qi - 4)')} AS year_ago_quarter,
  'FY' || right(CAST({sql_year('date_key')} AS VARCHAR), 2) AS fiscal_year,
  CAST(make_date({sql_year('date_key')} - 1, 2, 1) AS VARCHAR) AS year_begin, CAST(make_date({sql_year('date_key')}, 1, 31) AS VARCHAR) AS year_end,
  'FY' || right(CAST({sql_year('date_key')} - 1 AS VARCHAR), 2) AS last_fiscal_year,
  CAST(qi - {sql_index(A)} AS BIGINT) AS quarters_from_current,
  CAST(qi = {sql_index(A)} AS BIGINT) AS is_current_quarter,
  CAST(qi = {sql_index(A)} OR (qi = {sql_index(A)} - 1 AND month({A}) IN (2, 5, 8, 11)) AS BIGINT) AS is_restricted,
  completed_weeks
FROM calendar SEMI JOIN order_days USING (date_key) ORDER BY date_key""")
def _(t):
    bounds = t.orders.agg(F.min(order_day()).alias("first"), F.max(order_day()).alias("last"))
    every_day = bounds.select(F.explode(F.sequence("first", "last")).alias("date_key"))
    with_orders = calendar.fiscal_calendar(every_day, AS_OF).join(order_days(t), "date_key", "left_semi")
    return plain(with_orders.orderBy("date_key"))


WEEKLY_BASE = f"""
weekly AS (
  SELECT {sql_index('day')} AS qi, {sql_week('day')} AS fiscal_week, geo, o_orderpriority AS priority,
         sum(net) AS revenue, sum(CASE WHEN o_orderstatus = 'O' THEN net END) AS new_revenue
  FROM order_amounts JOIN accounts ON o_custkey = c_custkey JOIN calendar ON date_key = day
  WHERE {sql_from('day', AS_OF)} >= -6 GROUP BY ALL)"""


def account_weeks(t: Catalog):
    """Sales per account and week, with the account's region."""
    sales = order_amounts(t)
    is_open = F.col("o_orderstatus") == "O"
    weekly = revenue.by_account_week(
        sales, "o_custkey", "day", AS_OF,
        [F.sum("net").alias("revenue"), F.sum(F.when(is_open, F.col("net"))).alias("new_revenue")],
        ["o_orderpriority"])
    return weekly.join(accounts(t), F.col("o_custkey") == F.col("c_custkey")).withColumnRenamed(
        "o_orderpriority", "priority")


@query("weekly_revenue_by_region", "K8 J15 J20 J21 B17 G5", f"""
WITH {SQL_ORDER_AMOUNTS}, {SQL_ACCOUNTS}, {sql_calendar(AS_OF, '1995-01-01')}, {WEEKLY_BASE},
dims AS (SELECT DISTINCT geo, priority FROM weekly),
weeks AS (SELECT DISTINCT qi, fiscal_week, week_start, {sql_begin('date_key')} AS quarter_begin FROM calendar
          WHERE {sql_from('date_key', AS_OF)} >= -6)
SELECT {sql_index_label('w.qi')} AS fiscal_quarter, w.fiscal_week, CAST(w.quarter_begin AS VARCHAR) AS quarter_begin,
  CAST(w.week_start AS VARCHAR) AS week_start, d.geo, d.priority,
  CAST(b.revenue AS DOUBLE) AS revenue, CAST(b.new_revenue AS DOUBLE) AS new_revenue,
  CAST(p.revenue AS DOUBLE) AS qoq_revenue, CAST(p.new_revenue AS DOUBLE) AS qoq_new_revenue,
  CAST(y.revenue AS DOUBLE) AS yoy_revenue, CAST(y.new_revenue AS DOUBLE) AS yoy_new_revenue
FROM weeks w CROSS JOIN dims d
LEFT JOIN weekly b ON b.qi = w.qi AND b.fiscal_week = w.fiscal_week AND b.geo = d.geo AND b.priority = d.priority
LEFT JOIN weekly p ON p.qi = w.qi - 1 AND p.fiscal_week = w.fiscal_week AND p.geo = d.geo AND p.priority = d.priority
LEFT JOIN weekly y ON y.qi = w.qi - 4 AND y.fiscal_week = w.fiscal_week AND y.geo = d.geo AND y.priority = d.priority
WHERE NOT (coalesce(b.revenue, 0) = 0 AND coalesce(b.new_revenue, 0) = 0 AND coalesce(p.revenue, 0) = 0
  AND coalesce(p.new_revenue, 0) = 0 AND coalesce(y.revenue, 0) = 0 AND coalesce(y.new_revenue, 0) = 0)""")
def _(t):
    fact = revenue.weekly_fact(account_weeks(t), ["geo", "priority"], ["revenue", "new_revenue"], AS_OF)
    return plain(fact, "fiscal_quarter", "fiscal_week", "quarter_begin", "week_start", "geo", "priority",
                 "revenue", "new_revenue", "qoq_revenue", "qoq_new_revenue", "yoy_revenue", "yoy_new_revenue")


@query("quarterly_revenue_to_date", "K7 J15 J20 B17", f"""
WITH {SQL_ORDER_AMOUNTS}, {SQL_ACCOUNTS}, {sql_calendar(AS_OF, '1995-01-01')}, {WEEKLY_BASE},
last_week AS (SELECT max(fiscal_week) AS w FROM calendar WHERE qi = {sql_index(A)}),
base AS (SELECT qi, geo, priority, sum(revenue) AS revenue, sum(new_revenue) AS new_revenue FROM weekly GROUP BY ALL),
qtd AS (SELECT qi, geo, priority, sum(revenue) AS revenue, sum(new_revenue) AS new_revenue FROM weekly
        WHERE fiscal_week <= (SELECT w FROM last_week) GROUP BY ALL),
grid AS (SELECT DISTINCT c.qi, d.geo, d.priority FROM
   (SELECT DISTINCT qi FROM calendar WHERE {sql_from('date_key', AS_OF)} >= -6) c
   CROSS JOIN (SELECT DISTINCT geo, priority FROM weekly) d),
joined AS (
  SELECT g.*, b.revenue, b.new_revenue,
    CASE WHEN g.qi = {sql_index(A)} THEN pt.revenue ELSE p.revenue END AS qoq_revenue,
    CASE WHEN g.qi = {sql_index(A)} THEN pt.new_revenue ELSE p.new_revenue END AS qoq_new_revenue,
    CASE WHEN g.qi = {sql_index(A)} THEN yt.revenue ELSE y.revenue END AS yoy_revenue,
    CASE WHEN g.qi = {sql_index(A)} THEN yt.new_revenue ELSE y.new_revenue END AS yoy_new_revenue
  FROM grid g LEFT JOIN base b USING (qi, geo, priority)
  LEFT JOIN base p ON p.qi = g.qi - 1 AND p.geo = g.geo AND p.priority = g.priority
  LEFT JOIN base y ON y.qi = g.qi - 4 AND y.geo = g.geo AND y.priority = g.priority
  LEFT JOIN qtd pt ON pt.qi = g.qi - 1 AND pt.geo = g.geo AND pt.priority = g.priority
  LEFT JOIN qtd yt ON yt.qi = g.qi - 4 AND yt.geo = g.geo AND yt.priority = g.priority)
SELECT {sql_index_label('qi')} AS fiscal_quarter, geo, priority, CAST(revenue AS DOUBLE) AS revenue,
  CAST(new_revenue AS DOUBLE) AS new_revenue, CAST(qoq_revenue AS DOUBLE) AS qoq_revenue,
  CAST(qoq_new_revenue AS DOUBLE) AS qoq_new_revenue, CAST(yoy_revenue AS DOUBLE) AS yoy_revenue,
  CAST(yoy_new_revenue AS DOUBLE) AS yoy_new_revenue
FROM joined WHERE coalesce(revenue, 0) <> 0 OR coalesce(new_revenue, 0) <> 0 OR coalesce(qoq_revenue, 0) <> 0
  OR coalesce(qoq_new_revenue, 0) <> 0 OR coalesce(yoy_revenue, 0) <> 0 OR coalesce(yoy_new_revenue, 0) <> 0""")
def _(t):
    fact = revenue.quarterly_fact(account_weeks(t), ["geo", "priority"], ["revenue", "new_revenue"], AS_OF)
    return plain(fact, "fiscal_quarter", "geo", "priority", "revenue", "new_revenue", "qoq_revenue",
                 "qoq_new_revenue", "yoy_revenue", "yoy_new_revenue")


CUBE_DIMS = {"country": "CNTRY", "priority": "PRIO", "segment": "SEG"}
SQL_CUBE_LABEL = """'QTR-GEO' || CASE WHEN grouping(country) = 0 THEN '-CNTRY' ELSE '' END
  || CASE WHEN grouping(priority) = 0 THEN '-PRIO' ELSE '' END || CASE WHEN grouping(segment) = 0 THEN '-SEG' ELSE '' END"""


@query("quarterly_order_cube", "G9 K7 G4 J5", f"""
WITH {SQL_ACCOUNTS}, {sql_calendar(AS_OF, '1995-01-01')},
raw AS MATERIALIZED (SELECT o_orderkey, qi, fiscal_week, geo, country, o_orderpriority AS priority, nullif(c_mktsegment, 'FURNITURE') AS segment
  FROM orders JOIN accounts ON o_custkey = c_custkey JOIN calendar ON date_key = CAST(o_orderdate AS DATE)
  WHERE {sql_from('date_key', AS_OF)} >= -6),
cells AS MATERIALIZED (SELECT qi, geo, country, priority, segment, {SQL_CUBE_LABEL} AS aggregated_by, count(DISTINCT o_orderkey) AS orders,
  nullif(count(DISTINCT CASE WHEN fiscal_week <= (SELECT max(fiscal_week) FROM calendar WHERE qi = {sql_index(A)}) THEN o_orderkey END), 0) AS to_date
  FROM raw GROUP BY qi, geo, CUBE (country, priority, segment)),
seen AS (SELECT qi + lag AS qn, lag, geo, country, priority, segment, aggregated_by, CASE WHEN lag > 0 AND qi + lag = {sql_index(A)} THEN to_date ELSE orders END AS orders FROM cells, (VALUES (0), (1), (4)) l(lag))
SELECT {sql_index_label("qn")} AS fiscal_quarter, geo, country, priority, segment, aggregated_by, max(orders) FILTER (lag = 0) AS orders, max(orders) FILTER (lag = 1) AS qoq_orders, max(orders) FILTER (lag = 4) AS yoy_orders
FROM seen GROUP BY qn, geo, country, priority, segment, aggregated_by HAVING bool_or(lag = 0)""")
def _(t):
    orders = t.orders.select(
        "o_orderkey", "o_custkey", order_day().alias("day"), F.col("o_orderpriority").alias("priority"))
    attributed = orders.join(
        accounts(t).select("c_custkey", "geo", "country",
                           F.nullif(F.col("c_mktsegment"), F.lit("FURNITURE")).alias("segment")),
        F.col("o_custkey") == F.col("c_custkey"))
    cube = revenue.order_count_cube(attributed, "o_orderkey", "day", CUBE_DIMS, ["geo"], AS_OF, "QTR-GEO")
    return plain(cube, "fiscal_quarter", "geo", "country", "priority", "segment", "aggregated_by",
                 "orders", "qoq_orders", "yoy_orders")


@query("revenue_cube_with_total", "G9 G12", f"""
WITH {SQL_ACCOUNTS}, sales AS (SELECT {sql_label('o_orderdate')} AS fiscal_quarter, geo, country, c_mktsegment AS segment,
    CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders JOIN accounts ON o_custkey = c_custkey)
SELECT fiscal_quarter, geo, country, segment, CAST(sum(price) AS DOUBLE) AS revenue, count(*) AS orders,
  'QTR-GEO' || CASE WHEN grouping(country) = 0 THEN '-CNTRY' ELSE '' END
  || CASE WHEN grouping(segment) = 0 THEN '-SEG' ELSE '' END AS aggregated_by
FROM sales GROUP BY fiscal_quarter, geo, CUBE (country, segment)
UNION ALL SELECT fiscal_quarter, NULL, NULL, NULL, CAST(sum(price) AS DOUBLE), count(*), 'QTR' FROM sales GROUP BY 1""")
def _(t):
    sales = t.orders.join(accounts(t), F.col("o_custkey") == F.col("c_custkey")).select(
        fiscal.quarter_label(order_day()).alias("fiscal_quarter"), "geo", "country",
        F.col("c_mktsegment").alias("segment"), F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    # rows combine per full dimension tuple before the cube multiplies them
    compact = sales.groupBy("fiscal_quarter", "geo", "country", "segment").agg(
        F.sum("price").alias("revenue"), F.count(F.lit(1)).alias("orders"))
    sums = [F.sum("revenue").alias("revenue"), F.sum("orders").alias("orders")]
    cube = labeled_cube(compact, ["fiscal_quarter", "geo"], {"country": "CNTRY", "segment": "SEG"}, sums, "QTR-GEO")
    total = compact.groupBy("fiscal_quarter").agg(*sums)
    return plain(with_total(cube, total, "aggregated_by", "QTR"))


@query("revenue_measures_by_source", "K27 G19 G1", f"""
WITH {SQL_ORDER_AMOUNTS}, sourced AS (SELECT day, net,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Integrated' WHEN '2-HIGH' THEN 'Integrated' WHEN '3-MEDIUM' THEN 'Core' ELSE 'Unintegrated' END AS source,
    CASE o_orderstatus WHEN 'O' THEN 'New' WHEN 'P' THEN 'Renewal' END AS kind,
    CASE WHEN o_custkey % 3 <> 0 THEN 'Phase' END AS phase,
    CASE WHEN lines > 2 THEN net END AS new_part, CASE WHEN lines <= 2 THEN net END AS expansion_part, CASE WHEN lines = 1 THEN net END AS net_new_part FROM order_amounts)
SELECT {sql_label('day')} AS fiscal_quarter, source, CAST(sum(net) AS DOUBLE) AS total,
  CAST(sum(nb) AS DOUBLE) AS new_business, CAST(sum(nc) AS DOUBLE) AS new_customer,
  CAST(coalesce(sum(net), 0) - coalesce(sum(nb), 0) AS DOUBLE) AS renewal,
  CAST(coalesce(sum(nb), 0) - coalesce(sum(nc), 0) AS DOUBLE) AS expansion
FROM (SELECT *, CASE WHEN source <> 'Core' AND upper(kind) = 'NEW' THEN net
        WHEN source = 'Core' THEN coalesce(new_part, 0) + coalesce(expansion_part, 0) END AS nb,
      CASE WHEN source = 'Integrated' AND phase IS NOT NULL AND upper(kind) = 'NEW' THEN net
        WHEN source = 'Core' THEN coalesce(new_part, 0) + coalesce(net_new_part, 0) END AS nc FROM sourced)
GROUP BY 1, 2""")
def _(t):
    source = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Integrated").when(
        F.col("o_orderpriority") == "3-MEDIUM", "Core").otherwise("Unintegrated")
    sales = order_amounts(t).select(
        fiscal.quarter_label("day").alias("fiscal_quarter"), "net", source.alias("source"),
        F.when(F.col("o_orderstatus") == "O", "New").when(F.col("o_orderstatus") == "P", "Renewal").alias("kind"),
        F.when(F.col("o_custkey") % 3 != 0, "Phase").alias("phase"),
        F.when(F.col("lines") > 2, F.col("net")).alias("new_part"),
        F.when(F.col("lines") <= 2, F.col("net")).alias("expansion_part"),
        F.when(F.col("lines") == 1, F.col("net")).alias("net_new_part"))
    return plain(revenue.source_measures(
        sales, ["fiscal_quarter", "source"], "net", "source", "kind", "phase", "new_part", "expansion_part", "net_new_part"))


@query("yearly_revenue_ratio", "W8 G15", f"""
WITH yearly AS (SELECT o_custkey, CAST({sql_year('o_orderdate')} AS BIGINT) AS fiscal_year,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM orders GROUP BY 1, 2),
lagged AS (SELECT *, lag(revenue, 1, 0) OVER (PARTITION BY o_custkey ORDER BY fiscal_year) AS earlier FROM yearly)
SELECT o_custkey, fiscal_year, revenue, CASE WHEN earlier = 0 THEN 0.0 ELSE revenue / earlier * 100 END AS ratio FROM lagged""")
def _(t):
    yearly = t.orders.groupBy("o_custkey", fiscal.year(order_day()).alias("fiscal_year")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("revenue"))
    return plain(period.year_ratio(yearly, "o_custkey", "fiscal_year", "revenue", "ratio"))


@query("compared_quarters", "W12", f"""
WITH ranked AS (SELECT qi, row_number() OVER (ORDER BY qi DESC) AS position
  FROM (SELECT DISTINCT {sql_index('o_orderdate')} AS qi FROM orders))
SELECT r.position, {sql_index_label('r.qi')} AS fiscal_quarter, count(*) AS orders,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM ranked r JOIN orders ON {sql_index('o_orderdate')} = r.qi WHERE r.position IN (1, 2, 5) GROUP BY ALL""")
def _(t):
    orders = t.orders.select(
        fiscal.quarter_index(order_day()).alias("qi"), F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    per_quarter = orders.groupBy("qi").agg(F.count(F.lit(1)).alias("orders"), F.sum("price").alias("revenue"))
    chosen = period.ranked_quarters(per_quarter, "qi")
    joined = per_quarter.join(chosen, "qi").withColumn("fiscal_quarter", fiscal.label_of_index("qi"))
    return plain(joined, "position", "fiscal_quarter", "orders", "revenue")


@query("dense_weeks_by_region", "J15", f"""
WITH {SQL_ACCOUNTS}, weekly AS (SELECT geo, {sql_index('o_orderdate')} AS qi, count(*) AS orders
  FROM orders JOIN accounts ON o_custkey = c_custkey WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' GROUP BY 1, 2),
bounds AS (SELECT min({sql_index('o_orderdate')}) AS lo, max({sql_index('o_orderdate')}) AS hi FROM orders)
SELECT d.geo, {sql_index_label('q.qi')} AS fiscal_quarter, coalesce(w.orders, 0) AS orders
FROM (SELECT DISTINCT geo FROM weekly) d
CROSS JOIN (SELECT unnest(generate_series((SELECT lo FROM bounds), (SELECT hi FROM bounds))) AS qi) q
LEFT JOIN weekly w ON w.geo = d.geo AND w.qi = q.qi""")
def _(t):
    urgent = t.orders.filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F"))
    per_account = urgent.groupBy("o_custkey", fiscal.quarter_index(order_day()).alias("qi")).agg(
        F.count(F.lit(1)).alias("orders"))
    by_region = per_account.join(accounts(t), F.col("o_custkey") == F.col("c_custkey")).groupBy("geo", "qi").agg(
        F.sum("orders").alias("orders"))
    quarters = t.orders.select(fiscal.quarter_index(order_day()).alias("q"))
    lo, hi = quarters.agg(F.min("q").alias("v")).scalar(), quarters.agg(F.max("q").alias("v")).scalar()
    grid = densify(by_region, ["geo"], F.sequence(lo, hi), "qi")
    joined = grid.join(by_region, ["geo", "qi"], "left")
    return plain(joined.select("geo", fiscal.label_of_index("qi").alias("fiscal_quarter"),
                               F.coalesce("orders", F.lit(0)).alias("orders")))


@query("supplied_calendar", "J21 K1", f"""
WITH supplied AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date_key, {sql_label('o_orderdate')} AS fiscal_quarter,
  (CAST(o_orderdate AS DATE) - {sql_begin('o_orderdate')} + dayofweek({sql_begin('o_orderdate')})) // 7 + 1 AS sunday_week FROM orders WHERE o_orderkey % 9 <> 0),
sums AS (SELECT fiscal_quarter, sunday_week, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM orders LEFT JOIN supplied ON CAST(o_orderdate AS DATE) = date_key GROUP BY 1, 2)
SELECT s.fiscal_quarter, s.sunday_week, orders, revenue, CAST(min(date_key) AS VARCHAR) AS week_start, CAST(max(date_key) AS VARCHAR) AS week_end
FROM sums s LEFT JOIN supplied c ON s.fiscal_quarter = c.fiscal_quarter AND s.sunday_week = c.sunday_week GROUP BY ALL""")
def _(t):
    day = order_day()
    begin = fiscal.quarter_begin(day)
    # a calendar whose weeks start on Sundays, and which lacks some days
    supplied = t.orders.filter("o_orderkey % 9 <> 0").select(
        day.alias("date_key"), fiscal.quarter_label(day).alias("fiscal_quarter"),
        (F.floor((F.datediff(day, begin) + F.dayofweek(begin) - 1) / 7) + 1).alias("sunday_week")).distinct()
    facts = calendar.by_day(t.orders.select(day.alias("day"), F.col("o_totalprice").cast("decimal(18,2)").alias("price")), "day", supplied, ["fiscal_quarter", "sunday_week"])
    weekly = facts.groupBy("fiscal_quarter", "sunday_week").agg(F.count(F.lit(1)).alias("orders"), F.sum("price").alias("revenue"))
    return plain(calendar.by_week(weekly, supplied, "fiscal_quarter", "sunday_week"), "fiscal_quarter", "sunday_week", "orders", "revenue", "week_start", "week_end")


@query("trial_comparison", "K14 K7 G8", f"""
WITH {SQL_ACCOUNTS}, {sql_calendar(AS_OF, '1995-01-01')},
v AS (SELECT qi, fiscal_week, geo, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS loaded, CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS used FROM orders JOIN accounts ON o_custkey = c_custkey JOIN calendar ON date_key = CAST(o_orderdate AS DATE) WHERE {sql_from('date_key', AS_OF)} >= -6),
whole AS (SELECT qi, geo, count(DISTINCT loaded) AS downloads, count(DISTINCT used) AS activations FROM v GROUP BY 1, 2),
part AS (SELECT qi, geo, nullif(count(DISTINCT loaded), 0) AS downloads, nullif(count(DISTINCT used), 0) AS activations FROM v WHERE fiscal_week <= (SELECT max(fiscal_week) FROM calendar WHERE qi = {sql_index(A)}) GROUP BY 1, 2),
earlier AS (SELECT *, false AS current FROM whole UNION ALL SELECT *, true FROM part)
SELECT {sql_index_label('w.qi')} AS fiscal_quarter, w.geo, w.downloads, w.activations, p.downloads AS qoq_downloads, p.activations AS qoq_activations, y.downloads AS yoy_downloads, y.activations AS yoy_activations
FROM whole w LEFT JOIN earlier p ON p.qi = w.qi - 1 AND p.geo = w.geo AND p.current = (w.qi = {sql_index(A)}) LEFT JOIN earlier y ON y.qi = w.qi - 4 AND y.geo = w.geo AND y.current = (w.qi = {sql_index(A)})""")
def _(t):
    steps = t.orders.select("o_custkey", "o_orderstatus", order_day().alias("day")).join(accounts(t).select("c_custkey", "geo"), F.col("o_custkey") == F.col("c_custkey"))
    status = F.col("o_orderstatus")
    fact = traffic.trial_comparison(steps, ["geo"], {"downloads": ("o_custkey", status != "P"), "activations": ("o_custkey", status == "F")}, "day", AS_OF)
    return plain(fact, "fiscal_quarter", "geo", "downloads", "activations", "qoq_downloads", "qoq_activations", "yoy_downloads", "yoy_activations")


CONTRIBUTION = ["new_acv", "new_customer_acv", "expansion_acv", "created_acv"]


@query("contribution_by_month", "K31 K7 U3", f"""
WITH {SQL_ACCOUNTS}, {sql_calendar(AS_OF, '1995-01-01')},
deals AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS closed, CAST(o_orderdate AS DATE) - 40 AS created, geo, nullif(c_mktsegment, 'FURNITURE') AS tier, CAST(o_totalprice AS DECIMAL(18,2)) AS acv, o_orderpriority IN ('1-URGENT', '2-HIGH') AS fresh
  FROM orders JOIN accounts ON o_custkey = c_custkey),
base AS MATERIALIZED (SELECT qi, fiscal_week, CAST(date_trunc('month', date_key) AS DATE) AS month, geo, tier, 'CLOSED' AS metric, CASE WHEN k % 2 = 0 THEN acv END AS new_acv, CASE WHEN k % 2 = 0 AND fresh THEN acv END AS new_customer_acv, CASE WHEN k % 2 = 0 AND NOT fresh THEN acv END AS expansion_acv, NULL::DECIMAL(18,2) AS created_acv
  FROM deals JOIN calendar ON date_key = closed WHERE {sql_from('date_key', AS_OF)} >= -6
  UNION ALL SELECT qi, fiscal_week, CAST(date_trunc('month', date_key) AS DATE), geo, tier, 'CREATED', NULL, NULL, NULL, CASE WHEN k % 5 = 0 THEN acv END FROM deals JOIN calendar ON date_key = created WHERE {sql_from('date_key', AS_OF)} >= -6),
seen AS (SELECT 0 AS lag, qi AS qn, month AS mn, * FROM base UNION ALL
  SELECT lag, qi + lag, CAST(month + to_months(CAST(3 * lag AS INT)) AS DATE), base.* FROM base, (VALUES (1), (4)) l(lag) WHERE qi + lag = {sql_index(A)} AND fiscal_week <= (SELECT max(fiscal_week) FROM base WHERE qi = {sql_index(A)}))
SELECT {sql_index_label('qn')} AS fiscal_quarter, CAST(mn AS VARCHAR) AS month, geo, tier, metric, {', '.join(f"CAST(sum({m}) FILTER (lag = {lag}) AS DOUBLE) AS {p}{m}" for m in CONTRIBUTION for p, lag in (('', 0), ('qoq_', 1), ('yoy_', 4)))}
FROM seen WHERE mn <= {A} GROUP BY qn, mn, geo, tier, metric HAVING {' OR '.join(f"coalesce(sum({m}) FILTER (lag = {lag}), 0) <> 0" for m in CONTRIBUTION for lag in (0, 1, 4))}""")
def _(t):
    k, acv, fresh = F.col("o_orderkey"), F.col("o_totalprice").cast("decimal(18,2)"), F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    deals = t.orders.select("o_custkey", order_day().alias("closed"), F.when(k % 2 == 0, acv).alias("new_acv"), F.when((k % 2 == 0) & fresh, acv).alias("new_customer_acv"),
                            F.when((k % 2 == 0) & ~fresh, acv).alias("expansion_acv"), F.when(k % 5 == 0, acv).alias("created_acv"))

    def stream(metric, day, measures):
        rows = revenue.with_fiscal_week(revenue.in_calendar(deals.withColumn("day", day), "day", AS_OF), "day")
        return rows.groupBy("o_custkey", "quarter_index", "fiscal_week", F.trunc("day", "MM").alias("month")).agg(
            *[F.sum(m).alias(m) for m in measures]).withColumn("metric", F.lit(metric))

    # summed per account before attributes are joined, then once more
    both = stream("CLOSED", F.col("closed"), CONTRIBUTION[:3]).unionByName(stream("CREATED", F.date_sub("closed", 40), CONTRIBUTION[3:]), allowMissingColumns=True)
    side = accounts(t).select("c_custkey", "geo", F.nullif("c_mktsegment", F.lit("FURNITURE")).alias("tier"))
    dims = ["geo", "tier", "metric"]
    base = both.join(side, F.col("o_custkey") == F.col("c_custkey")).groupBy("quarter_index", "fiscal_week", "month", *dims).agg(*[F.sum(m).alias(m) for m in CONTRIBUTION])
    this = fiscal.quarter_index(fiscal.as_date(AS_OF))
    last_week = base.filter(F.col("quarter_index") == this).agg(F.max("fiscal_week").alias("w")).scalar()
    shown = period.monthly_to_date(base, "quarter_index", "month", "fiscal_week", dims, CONTRIBUTION, AS_OF, last_week)
    columns = [f"{p}{m}" for m in CONTRIBUTION for p in ("", "qoq_", "yoy_")]
    return plain(shown.withColumn("fiscal_quarter", fiscal.label_of_index("quarter_index")), "fiscal_quarter", "month", *dims, *columns)
