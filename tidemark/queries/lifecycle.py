"""Seats, active users, renewals, health, account attributes, social facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import fiscal
from tidemark.operators import joins
from tidemark.operators.reconcile import coverage
from tidemark.plans import calendar, lifecycle, social
from tidemark.queries.output import plain
from tidemark.queries.registry import query
from tidemark.queries.relations import SQL_MERGES, SQL_PHASES, current_accounts, merges, phases
from tidemark.queries.roles import (
    SALES_AS_OF, SQL_ACCOUNTS, SQL_NET, accounts, net_amount, order_day, sql_label, sql_quarter, sql_week,
    sql_year,
)
from tidemark.sources.tables import Catalog

A = f"DATE '{SALES_AS_OF}'"


def seats(t: Catalog):
    """Order lines as daily seat assignments of the ordering account."""
    lines = t.lineitem.select(
        "l_orderkey", F.col("l_shipdate").cast("date").alias("day"), F.col("l_suppkey").alias("tenant"),
        F.concat(F.lit("1_"), F.col("l_linenumber").cast("string")).alias("pool"), "l_quantity", "l_partkey", "l_linestatus",
        F.when(F.col("l_orderkey") % 11 == 0, 0).otherwise(F.col("l_quantity")).alias("bought"),
        F.when(F.col("l_returnflag") == "R", F.col("l_quantity") + 10).otherwise(F.col("l_quantity") - 5).alias("assigned"))
    owned = lines.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joins.resolve_survivor(owned, "o_custkey", merges(t), current_accounts(t), "victim", "survivor", "account", "account")


SQL_SEATS = f"""{SQL_MERGES}, seats AS (SELECT CAST(l_shipdate AS DATE) AS day, l_suppkey AS tenant, '1_' || l_linenumber AS pool, l_quantity, CASE WHEN l_orderkey % 11 = 0 THEN 0 ELSE l_quantity END AS bought, l_partkey, l_linestatus,
  CASE WHEN l_returnflag = 'R' THEN l_quantity + 10 ELSE l_quantity - 5 END AS assigned, coalesce(new_id, o_custkey) AS account
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN moved ON o_custkey = old_id)"""


def control(t: Catalog):
    """Accounts of the held-out group (a semi-random digit of 1), as their survivors."""
    held = t.customer.withColumn("semi_random_digit", F.col("c_custkey") % 10).filter("semi_random_digit = 1").select("c_custkey")
    return joins.resolve_survivor(held, "c_custkey", merges(t), current_accounts(t), "victim", "survivor", "account", "control_account")


SQL_CONTROL = """control AS (SELECT DISTINCT coalesce(new_id, c_custkey) AS control_account FROM customer LEFT JOIN moved ON c_custkey = old_id WHERE c_custkey % 10 = 1)"""


@query("seat_rate", "K34 G21 J17 W5 B16", f"""
WITH {SQL_SEATS}, {SQL_CONTROL}, numbered AS (SELECT *, dense_rank() OVER (PARTITION BY tenant, pool ORDER BY day) AS day_bucket FROM seats),
n AS (SELECT day, tenant, pool, account, day_bucket, sum(bought) AS seats_purchased, sum(assigned) AS assigned FROM numbered WHERE bought <> 0 GROUP BY ALL),
u AS (SELECT day, tenant, pool, account, count(DISTINCT l_partkey) AS users FROM seats WHERE l_linestatus = 'F' GROUP BY ALL)
SELECT CAST(day AS VARCHAR) AS day, tenant, pool, account, seats_purchased, least(assigned, seats_purchased) AS seats_assigned, least(CAST(coalesce(users, 0) AS DOUBLE), least(assigned, seats_purchased)) AS seats_used, day_bucket,
  CASE WHEN control_account IS NOT NULL THEN 'Control' ELSE 'Test' END AS test_control
FROM n LEFT JOIN u USING (day, tenant, pool, account) LEFT JOIN control ON account = control_account WHERE day_bucket % 15 = 0""")
def _(t):
    rows = seats(t)
    rated = lifecycle.seat_rate(rows, rows.filter("l_linestatus = 'F'"), ["tenant", "pool", "account"], ["tenant", "pool"], "day",
                                "bought", "assigned", "l_partkey")
    return plain(lifecycle.control_flag(rated, "account", control(t), "control_account"),
                 "day", "tenant", "pool", "account", "seats_purchased", "seats_assigned", "seats_used", "day_bucket", "test_control")


CUBE = ["product", "account", "phase", "seat_type"]


@query("active_users", "K35 G8 G11 B15", f"""
WITH {SQL_MERGES}, {SQL_CONTROL}, {SQL_PHASES}, usage AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_custkey AS account, o_orderpriority AS product, nullif(o_orderstatus, 'P') AS seat_type, o_orderkey % 997 AS user_id FROM orders
  WHERE o_orderdate >= date_trunc('month', {A} - INTERVAL 16 MONTH) AND o_orderdate < {A}),
used AS (SELECT * FROM usage WHERE (account, product) IN (SELECT (o_custkey, o_orderpriority) FROM orders WHERE o_orderstatus <> 'O')),
r AS (SELECT u.*, strftime(day, '%Y-%m') AS month, phase, CASE WHEN control_account IS NOT NULL THEN 'Control' ELSE 'Test' END AS test_control FROM used u LEFT JOIN phases ON account = parent_id AND day BETWEEN phase_start AND phase_end AND phase <> '5-LOW' LEFT JOIN control ON account = control_account),
c AS (SELECT month, test_control, product, account, phase, seat_type, count(DISTINCT user_id) AS active_users FROM r GROUP BY month, test_control, CUBE (product, account, phase, seat_type))
SELECT DISTINCT *, CASE WHEN product IS NOT NULL AND account IS NOT NULL AND phase IS NOT NULL AND seat_type IS NOT NULL THEN 'ALL_NOT_NULL' WHEN product IS NULL AND account IS NULL AND phase IS NULL AND seat_type IS NULL THEN 'ALL_NULL'
  ELSE concat_ws(', ', CASE WHEN product IS NOT NULL THEN 'product' END, CASE WHEN account IS NOT NULL THEN 'account' END, CASE WHEN phase IS NOT NULL THEN 'phase' END, CASE WHEN seat_type IS NOT NULL THEN 'seat_type' END) || ' Not Null' END AS present FROM c""")
def _(t):
    usage = lifecycle.rolling_window(t.orders.select(
        order_day().alias("day"), F.col("o_custkey").alias("account"), F.col("o_orderpriority").alias("product"),
        F.nullif("o_orderstatus", F.lit("P")).alias("seat_type"), (F.col("o_orderkey") % 997).alias("user_id")), "day", SALES_AS_OF, 16)
    seated = t.orders.filter("o_orderstatus <> 'O'").select(F.col("o_custkey").alias("account"), F.col("o_orderpriority").alias("product"))
    in_phase = joins.interval_join(usage, phases(t).filter("phase <> '5-LOW'"), {"account": "parent_id"}, "day", "phase_start", "phase_end")
    flagged = lifecycle.control_flag(in_phase, "account", control(t), "control_account").withColumn("month", F.date_format("day", "yyyy-MM"))
    return plain(lifecycle.active_users(flagged, seated, ["account", "product"], "user_id", ["month", "test_control"], CUBE))


def finance(t: Catalog):
    net = net_amount()
    rows = t.lineitem.select(
        "l_orderkey", F.when(F.col("l_returnflag") == "N", net).alias("renewed"), F.when(F.col("l_returnflag") != "A", net).alias("due"),
        F.when(F.col("l_returnflag") == "N", F.col("l_quantity")).alias("seats_renewed"), F.col("l_quantity").alias("seats_due"),
        F.when(F.col("l_linenumber") < 4, net).alias("adjusted"))
    owned = rows.join(t.orders.select("o_orderkey", "o_custkey", order_day().alias("day")), F.col("l_orderkey") == F.col("o_orderkey"))
    return joins.resolve_survivor(owned, "o_custkey", merges(t), current_accounts(t), "victim", "survivor", "account", "account").withColumn(
        "period", fiscal.quarter_label("day"))


@query("renewal_rate", "K36 G15 G7 J17", f"""
WITH {SQL_MERGES}, {SQL_CONTROL}, f AS (SELECT DISTINCT {sql_label('o_orderdate')} AS period, coalesce(new_id, o_custkey) AS account, CASE WHEN l_returnflag = 'N' THEN {SQL_NET} END AS renewed, CASE WHEN l_returnflag <> 'A' THEN {SQL_NET} END AS due,
  CASE WHEN l_returnflag = 'N' THEN l_quantity END AS seats_renewed, l_quantity AS seats_due, CASE WHEN l_linenumber < 4 THEN {SQL_NET} END AS adjusted
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN moved ON o_custkey = old_id
  WHERE o_orderdate >= (SELECT m - to_months(CAST((month(m) + 10) % 3 AS INT)) FROM (SELECT date_trunc('month', {A} - INTERVAL 15 MONTH) AS m)) AND o_orderdate < {A})
SELECT period, account, CASE WHEN control_account IS NOT NULL THEN 'Control' ELSE 'Test' END AS test_control, CAST(sum(renewed) AS DOUBLE) AS renewed, CAST(sum(due) AS DOUBLE) AS due, sum(seats_renewed) AS seats_renewed, sum(seats_due) AS seats_due, CAST(sum(adjusted) AS DOUBLE) AS adjusted,
  round(CAST(sum(renewed) AS DOUBLE) / nullif(CAST(sum(due) AS DOUBLE), 0), 4) AS rate, round(sum(seats_renewed) / nullif(sum(seats_due), 0), 4) AS seat_rate, round(CAST(sum(adjusted) AS DOUBLE) / nullif(CAST(sum(due) AS DOUBLE), 0), 4) AS adjusted_rate
FROM f LEFT JOIN control ON account = control_account GROUP BY 1, 2, 3 HAVING rate > 0""")
def _(t):
    rows = finance(t).filter(F.col("day").between(lifecycle.renewal_window_start(SALES_AS_OF), F.date_sub(fiscal.as_date(SALES_AS_OF), 1)))
    rated = lifecycle.renewal_rate(rows, ["period", "account"], {
        "rate": ("renewed", "due"), "seat_rate": ("seats_renewed", "seats_due"), "adjusted_rate": ("adjusted", "due")}, "rate")
    return plain(lifecycle.control_flag(rated, "account", control(t), "control_account"),
                 "period", "account", "test_control", "renewed", "due", "seats_renewed", "seats_due", "adjusted", "rate", "seat_rate", "adjusted_rate")


@query("snapshot_renewals", "K36 G15", f"""
SELECT {sql_label('l_shipdate')} AS period, l_returnflag AS band, sum(CASE WHEN l_linestatus = 'F' THEN l_quantity END) AS seats_renewed, sum(l_quantity) AS seats_due, CAST(sum({SQL_NET}) AS DOUBLE) AS active_revenue,
  coalesce(round(sum(CASE WHEN l_linestatus = 'F' THEN l_quantity END) / nullif(sum(l_quantity), 0), 2) * 100, 0) AS seat_renewal_rate FROM lineitem WHERE l_linenumber = 1 GROUP BY 1, 2""")
def _(t):
    rows = t.lineitem.select(
        fiscal.quarter_label(F.col("l_shipdate").cast("date")).alias("period"), F.col("l_returnflag").alias("band"),
        F.when(F.col("l_linenumber") == 1, "EoQ").otherwise("Other").alias("snapshot"),
        F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).alias("renewed"), F.col("l_quantity").alias("due"), net_amount().alias("net"))
    return plain(lifecycle.snapshot_renewals(rows, ["period", "band"], "snapshot", "EoQ", "renewed", "due", "net"))


@query("account_revenue_growth", "K36 W8", f"""
WITH {SQL_MERGES}, f AS (SELECT coalesce(new_id, o_custkey) AS account, CAST({sql_year('o_orderdate')} AS BIGINT) AS fiscal_year, CAST(sum({SQL_NET}) AS DOUBLE) AS yearly
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN moved ON o_custkey = old_id GROUP BY 1, 2),
l AS (SELECT *, lag(yearly, 1, 0) OVER (PARTITION BY account ORDER BY fiscal_year) AS earlier FROM f)
SELECT account, fiscal_year, yearly, CASE WHEN earlier = 0 THEN 0.0 ELSE yearly / earlier * 100 END AS growth FROM l""")
def _(t):
    rows = t.lineitem.select("l_orderkey", net_amount().alias("net")).join(
        t.orders.select("o_orderkey", "o_custkey", fiscal.year(order_day()).alias("fiscal_year")), F.col("l_orderkey") == F.col("o_orderkey"))
    # one row per account and year before merged accounts are looked up
    yearly = rows.groupBy("o_custkey", "fiscal_year").agg(F.sum("net").alias("net"))
    owned = joins.resolve_survivor(yearly, "o_custkey", merges(t), current_accounts(t), "victim", "survivor", "account", "account")
    return plain(lifecycle.revenue_growth(owned, "account", "fiscal_year", "net"))


@query("health_score", "K36 W4", f"""
WITH s AS (SELECT l_suppkey AS account, CAST(date_trunc('month', l_shipdate) AS DATE) AS evaluated, CAST(l_shipdate AS DATE) AS scored, l_returnflag AS product, l_quantity AS score FROM lineitem),
n AS (SELECT DISTINCT account, product, evaluated, score, scored FROM (SELECT * FROM s QUALIFY dense_rank() OVER (PARTITION BY account, evaluated ORDER BY scored DESC) = 1))
SELECT account, product, {sql_label('evaluated')} AS period, sum(score) / count(*) AS health_score FROM n GROUP BY 1, 2, 3""")
def _(t):
    shipped = F.col("l_shipdate").cast("date")
    rows = t.lineitem.select(
        F.col("l_suppkey").alias("account"), F.trunc(shipped, "MM").alias("evaluated"), shipped.alias("scored"),
        F.col("l_returnflag").alias("product"), F.col("l_quantity").alias("score")).withColumn("period", fiscal.quarter_label("evaluated"))
    return lifecycle.health_score(rows, "account", "evaluated", "scored", "score", ["account", "product", "period"])


@query("download_rate", "K36", """
WITH a AS (SELECT DISTINCT user_id, upper('p' || CAST(json_extract(props, '$.k') AS INT) % 5) AS product, upper('n' || user_id % 30) AS country FROM events WHERE event_type = 'click'),
b AS (SELECT DISTINCT o_custkey AS u, '1_P' || o_orderkey % 5 AS pool FROM orders)
SELECT user_id, product, country, pool, n_name FROM a JOIN b ON user_id = u AND product = replace(pool, '1_', '') LEFT JOIN nation ON country = 'N' || n_nationkey""")
def _(t):
    k = F.get_json_object("props", "$.k").cast("int") % 5
    downloads = t.events.filter("event_type = 'click'").select(
        "user_id", F.concat(F.lit("p"), k.cast("string")).alias("product"), F.concat(F.lit("n"), (F.col("user_id") % 30).cast("string")).alias("country"))
    held = t.orders.select(F.col("o_custkey").alias("seat_user"), F.concat(F.lit("1_P"), (F.col("o_orderkey") % 5).cast("string")).alias("pool"))
    countries = t.nation.select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("code"), "n_name")
    return lifecycle.download_rate(downloads, held, countries, "user_id", "product", "seat_user", "pool", "country", "code").select(
        "user_id", "product", "country", "pool", "n_name")


@query("account_attributes", "K37 W13 J3", f"""
WITH {SQL_ACCOUNTS}, bands AS (SELECT DISTINCT o_custkey - o_custkey % 10 AS parent, o_custkey AS child, {sql_year('o_orderdate')} AS fy, {sql_quarter('o_orderdate')} AS q, CASE WHEN o_totalprice > 250000 THEN 'HIGH' ELSE 'LOW' END AS band FROM orders),
pick AS (SELECT * FROM bands QUALIFY row_number() OVER (PARTITION BY parent, fy ORDER BY q DESC, child, band) = 1 AND dense_rank() OVER (PARTITION BY child ORDER BY fy DESC) = 1)
SELECT c_custkey, c_custkey - c_custkey % 10 AS parent, c_mktsegment, country, geo, band, CASE WHEN c_custkey % 10 = 1 THEN 'Control' ELSE 'Test' END AS test_control
FROM accounts LEFT JOIN pick ON child = c_custkey AND pick.parent = c_custkey - c_custkey % 10""")
def _(t):
    k = F.col("o_custkey")
    bands = t.orders.select(
        (k - k % 10).alias("band_parent"), k.alias("child"), fiscal.year(order_day()).alias("fy"), fiscal.quarter(order_day()).alias("q"),
        F.when(F.col("o_totalprice") > 250000, "HIGH").otherwise("LOW").alias("band"))
    picked = lifecycle.latest_bands(bands, "band_parent", "child", "fy", "q", "band").select("band_parent", "child", "band")
    customer = t.customer.select("c_custkey", (F.col("c_custkey") - F.col("c_custkey") % 10).alias("parent"), "c_mktsegment", F.col("c_nationkey"))
    listed = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.lower("n_name").alias("search"), F.col("n_name").alias("country"), F.col("r_name").alias("geo"))
    located = customer.join(listed, F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")) == F.col("search"), "left")
    banded = located.join(picked, (F.col("child") == F.col("c_custkey")) & (F.col("band_parent") == F.col("parent")), "left")
    flagged = lifecycle.control_flag(banded, "c_custkey", t.customer.withColumn("semi_random_digit", F.col("c_custkey") % 10).filter("semi_random_digit = 1").select(F.col("c_custkey").alias("held")), "held")
    return flagged.select("c_custkey", "parent", "c_mktsegment", "country", "geo", "band", "test_control")


@query("date_and_customer_dimensions", "K38 G3", f"""
SELECT 'date' AS kind, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS key, {sql_label('o_orderdate')} || ' W' || {sql_week('o_orderdate')} || ' ' || strftime(o_orderdate, '%b %-d, %Y') AS detail FROM (SELECT DISTINCT o_orderdate FROM orders)
UNION ALL SELECT 'customer', role || '/' || conv_id, CAST(max(turn) AS VARCHAR) FROM conversations GROUP BY role, conv_id""")
def _(t):
    dates = calendar.date_hierarchy(t.orders.select(order_day().alias("date_key")).distinct())
    days = dates.select(F.lit("date").alias("kind"), F.col("date_key").cast("string").alias("key"),
                        F.concat("fiscal_quarter", F.lit(" W"), F.col("fiscal_week").cast("string"), F.lit(" "), "display_date").alias("detail"))
    customers = social.customer_dimension(t.conversations, ["role", "conv_id"], "turn")
    return days.unionByName(customers.select(F.lit("customer").alias("kind"), F.concat_ws("/", "role", "conv_id").alias("key"),
                                             F.col("latest_delivery").cast("string").alias("detail")))


# ---- social ----------------------------------------------------------------

NETWORKS = ["TWITTER", "FACEBOOK", "INSTAGRAM", "LINKEDIN", "YOUTUBE", "TIKTOK"]


def posts(t: Catalog):
    """Documents as posts: the network by id, metrics from the text's size."""
    k, n = F.col("doc_id"), F.col("n_chars")
    base = t.documents.select(
        F.concat(F.lit("P"), (k % 40).cast("string")).alias("profile_id"), F.date_add(F.lit("2024-01-01").cast("date"), (k % 90).cast("int")).alias("created"),
        F.col("lang").alias("post_type"), F.col("text").alias("tags"), (k % 6).alias("_n"),
        F.when(k % 3 != 0, n % 50).alias("post_content_clicks"), F.when(k % 4 != 0, n % 7).alias("post_link_clicks"), (n % 11).alias("link_in_bio_clicks"),
        (n % 5).alias("card_clicks"), F.when(k % 2 == 0, n % 3).alias("card_teaser_clicks"), F.when(k % 5 != 0, n % 13).alias("reactions"), (n % 17).alias("shares_count"),
        (n % 19).alias("likes"), (n % 23).alias("comments_count"), (n % 1000).alias("video_views"), n.alias("impressions"), (n % 31).alias("card_impressions"),
        (n % 2).alias("dislikes"), (n % 4).alias("saves"))
    return {name: base.filter(F.col("_n") == i).drop("_n") for i, name in enumerate(NETWORKS)}


SQL_POSTS = f"""raw_posts AS (SELECT *, {NETWORKS}[doc_id % 6 + 1] AS network, 'P' || doc_id % 40 AS profile_id, DATE '2024-01-01' + CAST(doc_id % 90 AS INT) AS created, coalesce(CASE WHEN doc_id % 3 <> 0 THEN n_chars % 50 END, 0) AS content, coalesce(CASE WHEN doc_id % 4 <> 0 THEN n_chars % 7 END, 0) AS link FROM documents),
post_rows AS (SELECT network, profile_id, created, lang AS post_type, text AS tags, CASE network WHEN 'TWITTER' THEN content + link WHEN 'FACEBOOK' THEN content + link WHEN 'INSTAGRAM' THEN n_chars % 11 WHEN 'YOUTUBE' THEN n_chars % 5 + CASE WHEN doc_id % 2 = 0 THEN n_chars % 3 ELSE 0 END ELSE content END AS clicks,
  coalesce(CASE WHEN doc_id % 5 <> 0 THEN n_chars % 13 END, 0) AS reactions, n_chars % 17 AS shares, n_chars % 19 AS likes, n_chars % 23 AS comments, n_chars % 1000 AS video_views, CASE network WHEN 'YOUTUBE' THEN n_chars % 31 WHEN 'TIKTOK' THEN n_chars % 1000 ELSE n_chars END AS impressions,
  CASE network WHEN 'YOUTUBE' THEN n_chars % 2 ELSE 0 END AS dislikes, CASE network WHEN 'INSTAGRAM' THEN n_chars % 4 ELSE 0 END AS saves FROM raw_posts),
post_fact AS (SELECT network, profile_id, created, post_type, tags, CAST(sum(clicks) AS BIGINT) AS clicks, CAST(sum(reactions) AS BIGINT) AS reactions, CAST(sum(shares) AS BIGINT) AS shares, CAST(sum(likes) AS BIGINT) AS likes, CAST(sum(comments) AS BIGINT) AS comments,
  CAST(sum(video_views) AS BIGINT) AS video_views, CAST(sum(impressions) AS BIGINT) AS impressions, CAST(sum(dislikes) AS BIGINT) AS dislikes, CAST(sum(saves) AS BIGINT) AS saves FROM post_rows GROUP BY ALL)"""


def post_fact(t: Catalog):
    return social.network_fact(posts(t), social.POST_MEASURES, ["profile_id", "created", "post_type", "tags"], "created")


@query("social_posts", "K39 B3 U2 G18 J1", f"""
WITH {SQL_POSTS} SELECT p.* EXCLUDE (tags, created), CAST(created AS VARCHAR) AS created, length(tags) AS tag_length, {sql_label('created')} AS fiscal_quarter, c_name AS customer FROM post_fact p LEFT JOIN (SELECT 'P' || c_custkey AS profile_id, c_name FROM customer) USING (profile_id)""")
def _(t):
    names = t.customer.select(F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("profile_id"), F.col("c_name").alias("customer"))
    named = social.with_customer(post_fact(t), names, "profile_id", "customer")
    return plain(named.withColumn("tag_length", F.length("tags")), "network", "profile_id", "created", "post_type", "clicks", "reactions", "shares", "likes",
                 "comments", "video_views", "impressions", "dislikes", "saves", "tag_length", "fiscal_quarter", "customer")


@query("brand_posts", "K39 B8", f"""
WITH {SQL_POSTS}, b AS (SELECT *, CASE WHEN tags ILIKE '%license%' THEN 'License brand' WHEN tags ILIKE '%reserved%' THEN 'Rights brand' WHEN tags ILIKE '%email%' THEN 'Mail brand' WHEN tags ILIKE '%thenti%' THEN 'Thenti' ELSE 'NON_BRAND_TAGS' END AS brand_tag FROM post_fact)
SELECT network, profile_id, brand_activation, budget_owner, country, CAST(created AS VARCHAR) AS created, brand_tag, CASE WHEN network = 'YOUTUBE' THEN CAST(video_views * 15.45 AS DOUBLE) ELSE CAST(impressions AS DOUBLE) END AS impressions, reactions + shares + comments + dislikes + saves AS engagements FROM b LEFT JOIN (SELECT ['License brand', 'Mail brand', 'Thenti', 'x', 'y'][r_regionkey + 1] AS tag, 'Activation ' || r_regionkey AS brand_activation, r_name AS budget_owner FROM region) ON brand_tag = tag
  LEFT JOIN (SELECT 'P' || c_custkey AS pid, n_name AS country FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 4 <> 0) ON profile_id = pid WHERE brand_tag <> 'NON_BRAND_TAGS'""")
def _(t):
    rules = [("%license%", "License brand"), ("%reserved%", "Rights brand"), ("%email%", "Mail brand"), ("%thenti%", "Thenti")]
    branded = social.brand_posts(post_fact(t), "tags", rules)
    names = F.array(*[F.lit(x) for x in ("License brand", "Mail brand", "Thenti", "x", "y")])
    activations = t.region.select(F.get(names, F.col("r_regionkey").cast("int")).alias("brand_tag"),
                                  F.concat(F.lit("Activation "), F.col("r_regionkey").cast("string")).alias("brand_activation"), F.col("r_name").alias("budget_owner"))
    countries = t.customer.filter("c_custkey % 4 <> 0").join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("profile_id"), F.col("n_name").alias("country"))
    known = social.with_brand_lookups(branded, activations, countries, "profile_id")
    return plain(known.withColumn("impressions", F.round("impressions", 2)), "network", "profile_id", "brand_activation", "budget_owner", "country",
                 "created", "brand_tag", "impressions", "engagements")


PROFILE_MEASURES = {
    "USER": {"impressions": ["size"], "reactions": ["words"], "followers": []},
    "ASSISTANT": {"impressions": ["size", "words"], "reactions": ["words"], "followers": ["turn"]},
    "SYSTEM": {"impressions": ["words"], "reactions": [], "followers": []},
}


@query("social_profiles", "K39", f"""
WITH r AS (SELECT upper(role) AS network, 'P' || conv_id AS profile_id, DATE '2024-01-01' + CAST(turn AS INT) AS day, length(text) AS size, CASE WHEN turn % 3 <> 0 THEN len(string_split(text, ' ')) END AS words, turn FROM conversations)
SELECT network, profile_id, CAST(day AS VARCHAR) AS day, CAST(sum(CASE network WHEN 'USER' THEN size WHEN 'SYSTEM' THEN coalesce(words, 0) ELSE size + coalesce(words, 0) END) AS BIGINT) AS impressions, CAST(sum(CASE network WHEN 'SYSTEM' THEN 0 ELSE coalesce(words, 0) END) AS BIGINT) AS reactions, CAST(sum(CASE network WHEN 'ASSISTANT' THEN turn ELSE 0 END) AS BIGINT) AS followers, {sql_label('day')} AS fiscal_quarter FROM r GROUP BY network, profile_id, day""")
def _(t):
    rows = t.conversations.select(
        F.upper("role").alias("role"), F.concat(F.lit("P"), F.col("conv_id").cast("string")).alias("profile_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("turn").cast("int")).alias("day"), F.length("text").alias("size"),
        F.when(F.col("turn") % 3 != 0, F.size(F.split("text", " "))).alias("words"), "turn")
    by_network = {n: rows.filter(F.col("role") == n).drop("role") for n in PROFILE_MEASURES}
    return plain(social.network_fact(by_network, PROFILE_MEASURES, ["profile_id", "day"], "day"),
                 "network", "profile_id", "day", "impressions", "reactions", "followers", "fiscal_quarter")


@query("post_coverage", "K45 B6", f"""
WITH {SQL_POSTS}, expected AS (SELECT 'P' || c_custkey AS profile_id FROM customer)
SELECT profile_id, CAST(coalesce(sum(likes), 0) AS BIGINT) AS likes, CAST(coalesce(sum(impressions), 0) AS BIGINT) AS impressions FROM expected LEFT JOIN (SELECT * FROM post_fact WHERE network = 'FACEBOOK') USING (profile_id) GROUP BY 1""")
def _(t):
    expected = t.customer.select(F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("profile_id"))
    return coverage(expected, post_fact(t).filter("network = 'FACEBOOK'"), "profile_id", ["likes", "impressions"])
