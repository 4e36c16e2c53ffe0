"""Joins, latest-record selection, windows and aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import fiscal, numbers, text
from tidemark.operators import aggregates, joins, latest
from tidemark.queries.output import plain
from tidemark.queries.registry import query
from tidemark.queries.roles import SALES_AS_OF, SQL_ACCOUNTS, SQL_NET, accounts, net_amount, order_day, sql_label
from tidemark.sources.tables import Catalog

A = f"DATE '{SALES_AS_OF}'"

# ---- roles derived from the tables ----------------------------------------


def phases(t: Catalog):
    """Customer phases: a priority's stretch, from one change to the next.

    Built on one row per customer and day, however many orders a day has.
    """
    days = t.orders.groupBy("o_custkey", order_day().cast("timestamp_ntz").alias("day")).agg(
        F.max("o_orderpriority").alias("phase"))
    ranged = joins.validity_intervals(days, "o_custkey", "day", "phase")
    return ranged.select(
        F.col("o_custkey").alias("parent_id"), "phase", F.col("day").cast("date").alias("phase_start"),
        F.coalesce(F.date_sub(F.col("valid_to").cast("date"), 1), F.lit("9999-12-31").cast("date")).alias("phase_end"))


SQL_PHASES = """phases AS (
  SELECT parent_id, phase, day AS phase_start, coalesce(lead(day) OVER (PARTITION BY parent_id ORDER BY day) - 1, DATE '9999-12-31') AS phase_end
  FROM (SELECT o_custkey AS parent_id, CAST(o_orderdate AS DATE) AS day, max(o_orderpriority) AS phase FROM orders GROUP BY 1, 2))"""


def merges(t: Catalog):
    """Account merges: accounts with a low balance were merged into a later one."""
    k, segment = F.col("c_custkey"), F.col("c_mktsegment")
    return t.customer.filter("c_acctbal < 2000").select(
        k.alias("victim"), F.when(segment.isin("BUILDING", "MACHINERY"), k + 1).otherwise(k + 3).alias("survivor"),
        F.when(segment == "FURNITURE", "PENDING").otherwise("COMPLETED").alias("status"))


def current_accounts(t: Catalog):
    """Accounts still current: most merged ones are gone, as are the richest."""
    k = F.col("c_custkey")
    return t.customer.filter("NOT (c_acctbal < 2000 AND c_mktsegment <> 'HOUSEHOLD') AND c_acctbal < 9500").select(
        k.alias("account"), F.when(F.col("c_mktsegment") == "AUTOMOBILE", k - k % 100).otherwise(k).alias("parent"))


SQL_MERGES = """merges AS (SELECT c_custkey AS victim, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c_custkey + 1 ELSE c_custkey + 3 END AS survivor,
  CASE WHEN c_mktsegment = 'FURNITURE' THEN 'PENDING' ELSE 'COMPLETED' END AS status FROM customer WHERE c_acctbal < 2000),
current_accounts AS (SELECT c_custkey AS account, CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN c_custkey - c_custkey % 100 ELSE c_custkey END AS parent
  FROM customer WHERE NOT (c_acctbal < 2000 AND c_mktsegment <> 'HOUSEHOLD') AND c_acctbal < 9500),
moved AS (SELECT DISTINCT victim AS old_id, survivor AS new_id FROM merges WHERE survivor IN (SELECT account FROM current_accounts) AND victim NOT IN (SELECT account FROM current_accounts))"""


# ---- joins -----------------------------------------------------------------

@query("left_and_inner_join", "J1 J2", """
SELECT o_orderkey, c_name, n_name FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey
JOIN nation ON n_nationkey = coalesce(c_nationkey, 0)""")
def _(t):
    funded = t.customer.filter("c_acctbal > 0")
    joined = t.orders.join(funded, F.col("o_custkey") == F.col("c_custkey"), "left")
    return joined.join(t.nation, F.col("n_nationkey") == F.coalesce("c_nationkey", F.lit(0))).select("o_orderkey", "c_name", "n_name")


@query("normalised_key_join", "J3", """
SELECT c_custkey, s_suppkey FROM customer JOIN supplier
ON lower(trim(split_part(c_name, '#', 2))) = lower(trim(split_part(s_name, '#', 2)))""")
def _(t):
    number = lambda c: text.join_key(F.concat(F.lit(" "), F.split_part(c, F.lit("#"), F.lit(2))))
    return joins.normalised(t.customer.select("c_custkey", "c_name"), t.supplier.select("s_suppkey", "s_name"),
                            number(F.col("c_name")), number(F.col("s_name")), "inner").select("c_custkey", "s_suppkey")


@query("padded_id_join", "J4", """
SELECT o_orderkey, c_name FROM (SELECT o_orderkey, lpad(trim(replace(CAST(o_custkey AS VARCHAR) || '.0 ', '.0', '')), 10, '0') AS k FROM orders)
LEFT JOIN (SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS k, c_name FROM customer WHERE c_mktsegment <> 'BUILDING') USING (k)""")
def _(t):
    spelled = F.concat(F.col("o_custkey").cast("string"), F.lit(".0 "))
    return joins.normalised(
        t.orders.select("o_orderkey", "o_custkey"), t.customer.filter("c_mktsegment <> 'BUILDING'").select("c_custkey", "c_name"),
        text.padded_id(spelled), text.padded_id("c_custkey")).select("o_orderkey", "c_name")


@query("null_safe_text_join", "J5 J6", """
WITH a AS (SELECT nullif(lang, 'fr') AS lang, nullif(source, 'src1') AS source, count(*) AS docs FROM documents GROUP BY 1, 2),
b AS (SELECT nullif(lang, 'fr') AS lang, nullif(source, 'src1') AS source, sum(n_chars) AS chars FROM documents WHERE n_chars > 1000 GROUP BY 1, 2)
SELECT a.lang, a.source, docs, CAST(chars AS BIGINT) AS chars FROM a LEFT JOIN b
ON coalesce(a.lang, 'NULL') = coalesce(b.lang, 'NULL') AND coalesce(a.source, 'NULL') = coalesce(b.source, 'NULL')""")
def _(t):
    docs = t.documents.select(F.nullif("lang", F.lit("fr")).alias("lang"), F.nullif("source", F.lit("src1")).alias("source"), "n_chars")
    a = docs.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("docs"))
    b = docs.filter("n_chars > 1000").groupBy("lang", "source").agg(F.sum("n_chars").alias("chars"))
    return joins.text_null_safe(a, b, ["lang", "source"], surrogate="NULL")


@query("phase_interval_join", "J7 W9", f"""
WITH {SQL_PHASES}
SELECT l_orderkey, l_linenumber, parent_id, phase, CAST(phase_start AS VARCHAR) AS phase_start FROM lineitem JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN phases ON o_custkey = parent_id AND CAST(l_shipdate AS DATE) BETWEEN phase_start AND phase_end""")
def _(t):
    shipped = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("shipped")).join(
        t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return plain(joins.interval_join(shipped, phases(t), {"o_custkey": "parent_id"}, "shipped", "phase_start", "phase_end"),
                 "l_orderkey", "l_linenumber", "parent_id", "phase", "phase_start")


@query("full_interval_join", "J8", f"""
WITH {SQL_PHASES}, late AS (SELECT * FROM phases WHERE phase = '1-URGENT'),
facts AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS ordered, min(CAST(l_shipdate AS DATE)) AS first_ship, max(CAST(l_shipdate AS DATE)) AS last_ship
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F' GROUP BY 1, 2, 3)
SELECT o_orderkey, parent_id, phase, CAST(phase_start AS VARCHAR) AS phase_start FROM facts FULL JOIN late ON o_custkey = parent_id AND
  (ordered BETWEEN phase_start AND phase_end OR first_ship BETWEEN phase_start AND phase_end OR last_ship BETWEEN phase_start AND phase_end)""")
def _(t):
    ships = t.lineitem.groupBy("l_orderkey").agg(
        F.min(F.col("l_shipdate").cast("date")).alias("first_ship"), F.max(F.col("l_shipdate").cast("date")).alias("last_ship"))
    facts = t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", order_day().alias("ordered")).join(
        ships, F.col("o_orderkey") == F.col("l_orderkey")).drop("l_orderkey")
    late = phases(t).filter("phase = '1-URGENT'").withColumn("phase_id", F.concat_ws("|", "parent_id", "phase_start"))
    return plain(joins.full_interval_join(
        facts, late, {"o_custkey": "parent_id"}, ["ordered", "first_ship", "last_ship"], "o_orderkey", "phase_id",
        "phase_start", "phase_end"), "o_orderkey", "parent_id", "phase", "phase_start")


@query("event_in_entitlement", "J10", """
WITH signups AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS starts, CAST(ts AS DATE) + 2 AS ends FROM events WHERE event_type = 'signup'),
views AS (SELECT event_id, user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'view')
SELECT v.event_id, CAST(s.starts AS VARCHAR) AS starts FROM views v LEFT JOIN signups s ON v.user_id = s.user_id AND v.day BETWEEN s.starts AND s.ends""")
def _(t):
    day = F.col("ts").cast("date")
    signups = t.events.filter("event_type = 'signup'").select(F.col("user_id").alias("subscriber"), day.alias("starts")).distinct(
    ).withColumn("ends", F.date_add("starts", 2))
    views = t.events.filter("event_type = 'view'").select("event_id", "user_id", day.alias("day"))
    return plain(joins.interval_join(views, signups, {"user_id": "subscriber"}, "day", "starts", "ends"), "event_id", "starts")


@query("full_outer_stages", "J11", """
WITH quotes AS (SELECT CASE WHEN o_orderkey % 9 <> 0 THEN o_orderkey END AS id, o_orderpriority AS quote FROM orders WHERE o_orderstatus <> 'O'),
bills AS (SELECT CASE WHEN l_orderkey % 4 <> 0 THEN l_orderkey END AS id, count(*) AS lines FROM lineitem WHERE l_returnflag = 'N' AND l_linenumber > 3 GROUP BY l_orderkey)
SELECT coalesce(q.id, b.id) AS id, quote, lines FROM quotes q FULL JOIN bills b ON q.id = b.id""")
def _(t):
    quotes = t.orders.filter("o_orderstatus <> 'O'").select(
        F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderkey")).alias("id"), F.col("o_orderpriority").alias("quote"))
    bills = t.lineitem.filter("l_returnflag = 'N' AND l_linenumber > 3").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("lines")).select(F.when(F.col("l_orderkey") % 4 != 0, F.col("l_orderkey")).alias("id"), "lines")
    return joins.full_outer(quotes, bills, ["id"])


@query("without_returns", "J12 J13", """
SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_returnflag = 'R' AND l_orderkey = o_orderkey)""")
def _(t):
    return joins.without(t.orders, t.lineitem.filter("l_returnflag = 'R'"), "o_orderkey", "l_orderkey").select("o_orderkey")


@query("yes_never_no", "J14", """
SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'A' AND l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def _(t):
    flag = F.col("l_returnflag")
    return joins.yes_never_no(t.lineitem, "l_orderkey", flag == "A", flag == "R")


@query("hierarchy_parent", "J16", """
SELECT c.c_custkey, p.c_name AS parent_name, p.c_mktsegment AS parent_segment FROM customer c JOIN customer p ON p.c_custkey = c.c_custkey - c.c_custkey % 10
WHERE p.c_custkey <> c.c_custkey""")
def _(t):
    parents = t.customer.select(F.col("c_custkey").alias("parent"), F.col("c_name").alias("parent_name"),
                                F.col("c_mktsegment").alias("parent_segment"))
    children = t.customer.select("c_custkey", (F.col("c_custkey") - F.col("c_custkey") % 10).alias("up")).filter("up <> c_custkey")
    return children.join(parents, F.col("up") == F.col("parent")).select("c_custkey", "parent_name", "parent_segment")


@query("survivor_resolution", "J17", f"""
WITH {SQL_MERGES}
SELECT o_orderkey, coalesce(new_id, o_custkey) AS account FROM orders LEFT JOIN moved ON o_custkey = old_id""")
def _(t):
    return joins.resolve_survivor(t.orders, "o_custkey", merges(t), current_accounts(t), "victim", "survivor", "account", "account"
                                  ).select("o_orderkey", "account")


@query("survivor_and_parent", "J18", f"""
WITH {SQL_MERGES}, step AS (SELECT o_orderkey, coalesce(survivor, o_custkey) AS survivor_id FROM orders
  LEFT JOIN (SELECT * FROM merges WHERE status = 'COMPLETED') ON o_custkey = victim)
SELECT o_orderkey, survivor_id, parent AS parent_id, survivor AS parent_survivor_id, coalesce(survivor, parent, survivor_id) AS final_id
FROM step LEFT JOIN current_accounts ON survivor_id = account LEFT JOIN merges ON parent = victim""")
def _(t):
    return joins.resolve_family(t.orders, "o_custkey", merges(t), current_accounts(t), "victim", "survivor", "status", "account", "parent"
                                ).select("o_orderkey", "survivor_id", "parent_id", "parent_survivor_id", "final_id")


@query("lookup_by_either_key", "J19", """
WITH brands AS (SELECT p_partkey, p_brand, p_type FROM part WHERE p_size > 20)
SELECT l_orderkey, l_linenumber, coalesce(a.p_brand, b.p_brand) AS p_brand, coalesce(a.p_type, b.p_type) AS p_type
FROM lineitem LEFT JOIN brands a ON l_partkey = a.p_partkey LEFT JOIN brands b ON l_suppkey = b.p_partkey""")
def _(t):
    return joins.lookup_twice(t.lineitem, t.part.filter("p_size > 20"), "p_partkey", "l_partkey", "l_suppkey",
                              ["p_brand", "p_type"]).select("l_orderkey", "l_linenumber", "p_brand", "p_type")


@query("parsed_number_join", "J22", """
SELECT o_orderkey, n_name FROM orders JOIN nation ON try_cast(split_part('W_' || lpad(CAST(o_orderkey % 40 AS VARCHAR), 2, '0'), '_', 2) AS INTEGER) = n_nationkey""")
def _(t):
    code = F.concat(F.lit("W_"), F.lpad((F.col("o_orderkey") % 40).cast("string"), 2, "0"))
    return t.orders.select("o_orderkey", F.split_part(code, F.lit("_"), F.lit(2)).try_cast("int").alias("n")).join(
        t.nation, F.col("n") == F.col("n_nationkey")).select("o_orderkey", "n_name")


# ---- latest record, ranks --------------------------------------------------

@query("latest_order_per_account", "W1 W3", """
SELECT o_custkey, o_orderkey, o_orderstatus, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_totalprice DESC, o_orderkey DESC) = 1""")
def _(t):
    return latest.latest_by(t.orders, ["o_custkey"], "o_orderdate", "o_totalprice", "o_orderkey").select(
        "o_custkey", "o_orderkey", "o_orderstatus", order_day().cast("string").alias("day"))


@query("pick_by_priority", "W2", """
SELECT o_custkey, o_orderkey, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey
  ORDER BY CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END, o_orderdate DESC, o_orderkey DESC) = 1""")
def _(t):
    order = [F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).asc(), F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey").desc()]
    return latest.first_by(t.orders, ["o_custkey"], order).select("o_custkey", "o_orderkey", "o_orderstatus")


@query("latest_ties", "W4", """
SELECT l_suppkey, l_orderkey, l_linenumber FROM lineitem QUALIFY dense_rank() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC NULLS LAST) = 1""")
def _(t):
    return latest.latest_ties(t.lineitem, ["l_suppkey"], "l_shipdate").select("l_suppkey", "l_orderkey", "l_linenumber")


@query("day_buckets", "W5 B16", """
WITH ranked AS (SELECT user_id, event_id, CAST(ts AS DATE) AS day, dense_rank() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE)) AS bucket FROM events)
SELECT user_id, event_id, CAST(day AS VARCHAR) AS day, bucket FROM ranked WHERE bucket % 15 = 0""")
def _(t):
    daily = t.events.select("user_id", "event_id", F.col("ts").cast("date").alias("day"))
    return plain(latest.day_ordinal(daily, ["user_id"], "day", "bucket").filter(F.col("bucket") % 15 == 0))


@query("two_ranks", "W13", f"""
WITH bands AS (SELECT DISTINCT o_custkey - o_custkey % 10 AS parent, o_custkey AS child, year(o_orderdate) AS fy, quarter(o_orderdate) AS qtr,
    CASE WHEN o_totalprice > 250000 THEN 'HIGH' ELSE 'LOW' END AS band FROM orders)
SELECT parent, child, CAST(fy AS BIGINT) AS fy, CAST(qtr AS BIGINT) AS qtr, band FROM bands
QUALIFY row_number() OVER (PARTITION BY parent, fy ORDER BY fy, qtr DESC, child, band) = 1 AND dense_rank() OVER (PARTITION BY child ORDER BY fy DESC) = 1""")
def _(t):
    k = F.col("o_custkey")
    bands = t.orders.select(
        (k - k % 10).alias("parent"), k.alias("child"), F.year("o_orderdate").alias("fy"), F.quarter("o_orderdate").alias("qtr"),
        F.when(F.col("o_totalprice") > 250000, "HIGH").otherwise("LOW").alias("band")).distinct()
    first = latest.first_by(bands, ["parent", "fy"], [F.col("qtr").desc(), F.col("child").asc(), F.col("band").asc()])
    newest = bands.groupBy(F.col("child").alias("c")).agg(F.max("fy").alias("newest"))
    return plain(first.join(newest, (F.col("child") == F.col("c")) & (F.col("fy") == F.col("newest")), "left_semi"))


@query("one_row_per_key", "W15", """
SELECT user_id, event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY event_id) = 1""")
def _(t):
    daily = t.events.select("user_id", "event_type", "event_id", F.col("ts").cast("date").alias("day"))
    return latest.one_per_key(daily, ["user_id", "event_type", "day"], "event_id").drop("day")


# ---- aggregates ------------------------------------------------------------

@query("grouped_measures", "G1 G2", f"""
SELECT l_returnflag, l_linestatus, sum(l_quantity) AS quantity, CAST(sum({SQL_NET}) AS DOUBLE) AS net, min(l_quantity) AS least, max(l_quantity) AS most,
  sum(l_quantity) / count(*) AS mean_quantity, count(*) AS lines FROM lineitem WHERE l_shipdate <= {A} GROUP BY ALL""")
def _(t):
    lines = t.lineitem.filter(F.col("l_shipdate") <= F.lit(SALES_AS_OF).cast("timestamp_ntz"))
    return plain(lines.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("quantity"), F.sum(net_amount()).alias("net"), F.min("l_quantity").alias("least"),
        F.max("l_quantity").alias("most"), F.avg("l_quantity").alias("mean_quantity"), F.count(F.lit(1)).alias("lines")))


@query("distinct_and_conditional_counts", "G4 G5", """
SELECT event_type, count(DISTINCT user_id) AS users, count(DISTINCT CAST(ts AS DATE)) AS days,
  count(DISTINCT CASE WHEN value > 50 THEN user_id END) AS big_users, CAST(sum(CASE WHEN value > 50 THEN 1 ELSE 0 END) AS BIGINT) AS big_events
FROM events GROUP BY 1""")
def _(t):
    big = F.col("value") > 50
    rows = t.events.select("event_type", "user_id", F.col("ts").cast("date").alias("day"), big.alias("big"))
    counted = aggregates.distinct_cube(rows, ["event_type"], {}, {
        "users": ("user_id", F.lit(True)), "days": ("day", F.lit(True)), "big_users": ("user_id", F.col("big"))}, "TYPE")
    events = rows.groupBy("event_type").agg(F.sum(F.col("big").cast("bigint")).alias("big_events"))
    return counted.drop("aggregated_by").join(events, "event_type")


@query("pivoted_answers", "G6", """
SELECT l_orderkey, sum(CASE WHEN l_linenumber = 1 THEN l_quantity END) AS clicks, sum(CASE WHEN l_linenumber = 2 THEN l_quantity END) AS calls,
  sum(CASE WHEN l_linenumber = 3 THEN l_quantity END) AS attendees FROM lineitem GROUP BY 1""")
def _(t):
    return aggregates.pivot_sum(t.lineitem, ["l_orderkey"], "l_linenumber", F.col("l_quantity"), {1: "clicks", 2: "calls", 3: "attendees"})


@query("having_distinct", "G7", """
SELECT o_custkey, count(DISTINCT o_orderstatus) AS statuses, count(*) AS orders FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderstatus) > 2 AND count(*) > 10""")
def _(t):
    return t.orders.groupBy("o_custkey").agg(
        F.count_distinct("o_orderstatus").alias("statuses"), F.count(F.lit(1)).alias("orders")
    ).filter((F.col("statuses") > 2) & (F.col("orders") > 10))


@query("sorted_arrays", "G13", """
SELECT o_custkey, array_to_string(list_sort(list_distinct(list(o_orderpriority))), ',') AS priorities, array_to_string(list_sort(list_distinct(list(o_orderstatus))), ',') AS statuses
FROM orders GROUP BY 1""")
def _(t):
    return t.orders.groupBy("o_custkey").agg(
        F.array_join(aggregates.distinct_sorted("o_orderpriority"), ",").alias("priorities"),
        F.array_join(aggregates.distinct_sorted("o_orderstatus"), ",").alias("statuses"))


@query("any_and_all_flags", "G14", """
SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, bool_or(event_type = 'purchase') AS bought, bool_and(value < 100) AS all_small, bool_or(event_type = 'error' AND value > 10) AS bad_error
FROM events GROUP BY 1, 2""")
def _(t):
    kind = F.col("event_type")
    return t.events.groupBy("user_id", F.col("ts").cast("date").cast("string").alias("day")).agg(
        F.bool_or(kind == "purchase").alias("bought"), F.bool_and(F.col("value") < 100).alias("all_small"),
        F.bool_or((kind == "error") & (F.col("value") > 10)).alias("bad_error"))


@query("guarded_ratio", "G15", """
SELECT l_suppkey, round(CAST(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS DOUBLE) / nullif(sum(CASE WHEN l_linestatus = 'F' AND l_linenumber = 7 THEN l_quantity ELSE 0 END), 0), 4) AS return_rate
FROM lineitem GROUP BY 1""")
def _(t):
    sums = t.lineitem.groupBy("l_suppkey").agg(
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))).alias("returned"),
        F.sum(F.when((F.col("l_linestatus") == "F") & (F.col("l_linenumber") == 7), F.col("l_quantity")).otherwise(0)).alias("done"))
    return sums.select("l_suppkey", numbers.ratio("returned", "done").alias("return_rate"))


@query("equal_allocation", "G16", """
SELECT l_orderkey, l_linenumber, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) / count(*) OVER (PARTITION BY l_orderkey) AS share
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""")
def _(t):
    totals = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    return aggregates.allocate_equally(t.lineitem.select("l_orderkey", "l_linenumber"), totals, ["l_orderkey"], "price", "share")


@query("percentage_split", "G17 G18", """
SELECT l_orderkey, l_linenumber, CAST((coalesce(CAST(l_quantity AS DECIMAL(18,2)), 0) + coalesce(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS DECIMAL(18,2)) END, 0)) * 4 / 10 AS DOUBLE) AS share FROM lineitem""")
def _(t):
    quantity = F.col("l_quantity").cast("decimal(18,2)")
    bundle = numbers.nvl_sum(quantity, F.when(F.col("l_returnflag") == "R", quantity))
    return t.lineitem.select("l_orderkey", "l_linenumber", F.lit(40).cast("decimal(5,0)").alias("pct"), bundle.alias("b")).select(
        "l_orderkey", "l_linenumber", numbers.split_share("b", "pct").cast("double").alias("share"))


@query("first_use_lag", "G20", """
WITH granted AS (SELECT user_id, min(CAST(ts AS DATE)) AS granted FROM events WHERE event_type = 'signup' GROUP BY 1),
used AS (SELECT e.user_id, event_type, granted, min(CAST(ts AS DATE)) AS first_use FROM events e JOIN granted g ON e.user_id = g.user_id AND CAST(ts AS DATE) >= granted GROUP BY ALL)
SELECT event_type, CAST(sum(first_use - granted) AS DOUBLE) / count(*) AS average_lag FROM used GROUP BY 1""")
def _(t):
    day = F.col("ts").cast("date")
    granted = t.events.filter("event_type = 'signup'").groupBy(F.col("user_id").alias("g")).agg(F.min(day).alias("granted"))
    # one row per user, type and day before the join
    used = t.events.select("user_id", "event_type", day.alias("day")).distinct().join(
        granted, (F.col("user_id") == F.col("g")) & (F.col("day") >= F.col("granted")))
    return aggregates.first_use_lag(used, ["user_id", "event_type"], ["event_type"], "granted", "day", "average_lag")


@query("capped_values", "G21", """
SELECT l_orderkey, least(sum(l_quantity), 100) AS assigned, least(count(*), 3) AS used, sum(l_quantity) AS purchased FROM lineitem GROUP BY 1""")
def _(t):
    sums = t.lineitem.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("purchased"), F.count(F.lit(1)).alias("n"))
    return sums.select("l_orderkey", numbers.capped("purchased", F.lit(100.0)).alias("assigned"),
                       numbers.capped("n", F.lit(3).cast("bigint")).alias("used"), "purchased")


CUBE = ["priority", "status", "country"]


@query("cube_not_null_label", "G8 G11 G10", f"""
WITH {SQL_ACCOUNTS}, rows AS (SELECT {sql_label('o_orderdate')} AS fiscal_quarter, o_orderkey, o_custkey, o_orderpriority AS priority, nullif(o_orderstatus, 'P') AS status, country
  FROM orders JOIN accounts ON o_custkey = c_custkey),
cubed AS (SELECT fiscal_quarter, priority, status, country, count(DISTINCT o_custkey) AS accounts FROM rows GROUP BY fiscal_quarter, CUBE (priority, status, country))
SELECT DISTINCT *, CASE WHEN priority IS NOT NULL AND status IS NOT NULL AND country IS NOT NULL THEN 'ALL_NOT_NULL' WHEN priority IS NULL AND status IS NULL AND country IS NULL THEN 'ALL_NULL'
  ELSE concat_ws(', ', CASE WHEN priority IS NOT NULL THEN 'priority' END, CASE WHEN status IS NOT NULL THEN 'status' END, CASE WHEN country IS NOT NULL THEN 'country' END) || ' Not Null' END AS present
FROM cubed""")
def _(t):
    rows = t.orders.select(fiscal.quarter_label(order_day()).alias("fiscal_quarter"), "o_custkey", F.col("o_orderpriority").alias("priority"),
                           F.nullif("o_orderstatus", F.lit("P")).alias("status")).join(
        accounts(t).select("c_custkey", "country"), F.col("o_custkey") == F.col("c_custkey"))
    cubed = aggregates.distinct_cube(rows, ["fiscal_quarter"], {c: c for c in CUBE}, {"accounts": ("o_custkey", F.lit(True))}, "Q")
    return cubed.drop("aggregated_by").withColumn("present", text.not_null_label(CUBE)).distinct()
