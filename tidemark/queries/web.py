"""Web traffic, visits, trials and touches, on the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import attribution, joins
from tidemark.plans import revenue, traffic
from tidemark.plans.traffic import TrafficRules
from tidemark.queries.output import plain
from tidemark.queries.registry import query
from tidemark.queries.roles import (
    SALES_AS_OF, SQL_ACCOUNTS, accounts, order_day, sql_calendar, sql_from, sql_index_label,
)
from tidemark.sources.tables import Catalog

A = f"DATE '{SALES_AS_OF}'"


def hits(t: Catalog):
    """Events as page hits of one visit per user and day."""
    k, kind = F.col("k"), F.col("event_type")
    page = (
        F.when(kind == "view", F.concat(F.lit("site:en:products:p"), (k % 4).cast("string")))
        .when(kind == "click", F.concat(F.lit("site:en:support:p"), (k % 3).cast("string")))
        .when(kind == "error", F.lit("site:en:404")).when(kind == "signup", F.lit("site:en:trial"))
        .otherwise(F.when(k % 2 == 0, F.lit("site:cart details")).otherwise(F.lit("site:en:order:support")))
    )
    day = F.col("ts").cast("date")
    parsed = t.events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))  # parsed once per row
    return parsed.select(
        "event_id", "ts", "user_id", "value", "k", day.alias("day"),
        F.concat_ws("-", "user_id", day).alias("visit_id"), page.alias("page"),
        F.when(kind == "click", "link-click").when(kind == "purchase", "add-to-cart").otherwise(kind).alias("event"),
        F.when(k % 5 == 0, F.lit("Sign In")).when(k % 17 == 0, F.lit("")).otherwise(F.concat(F.lit("link "), k.cast("string"))).alias("link"),
        F.when(k % 19 == 0, 1).when(k % 3 == 0, 0).alias("form_attempt"),
        F.when(k % 7 == 0, F.lit("moe")).otherwise(F.lit("web")).alias("origin"),
        F.when(k % 11 == 0, F.lit("Renew")).alias("renewal"),
        F.when(k % 13 == 0, F.lit("DE:1")).alias("platform"),
        F.when(k % 3 == 0, F.lit("https://help")).otherwise(F.lit("https://home")).alias("referrer"),
        (kind == "purchase").cast("int").alias("cart_add"), (kind.isin("view", "click")).cast("int").alias("page_view"),
        F.concat(F.lit("S"), (F.col("user_id") % 6).cast("string")).alias("site"),
        F.concat(F.lit("N"), (F.col("user_id") % 25).cast("string")).alias("country_code"),
        F.when(k % 4 == 0, F.lit(None)).otherwise(F.concat(F.lit("F"), (F.col("user_id") % 3).cast("string"))).alias("family"),
    )


SQL_HITS = """hits AS (SELECT event_id, ts, user_id, value, k, CAST(ts AS DATE) AS day, user_id || '-' || CAST(ts AS DATE) AS visit_id,
  CASE event_type WHEN 'view' THEN 'site:en:products:p' || k % 4 WHEN 'click' THEN 'site:en:support:p' || k % 3 WHEN 'error' THEN 'site:en:404'
    WHEN 'signup' THEN 'site:en:trial' ELSE CASE WHEN k % 2 = 0 THEN 'site:cart details' ELSE 'site:en:order:support' END END AS page,
  CASE event_type WHEN 'click' THEN 'link-click' WHEN 'purchase' THEN 'add-to-cart' ELSE event_type END AS event,
  CASE WHEN k % 5 = 0 THEN 'Sign In' WHEN k % 17 = 0 THEN '' ELSE 'link ' || k END AS link, CASE WHEN k % 19 = 0 THEN 1 WHEN k % 3 = 0 THEN 0 END AS form_attempt, CASE WHEN k % 7 = 0 THEN 'moe' ELSE 'web' END AS origin,
  CASE WHEN k % 11 = 0 THEN 'Renew' END AS renewal, CASE WHEN k % 13 = 0 THEN 'DE:1' END AS platform,
  CASE WHEN k % 3 = 0 THEN 'https://help' ELSE 'https://home' END AS referrer, CAST(event_type = 'purchase' AS INT) AS cart_add,
  CAST(event_type IN ('view', 'click') AS INT) AS page_view, 'S' || user_id % 6 AS site, 'N' || user_id % 25 AS country_code,
  CASE WHEN k % 4 <> 0 THEN 'F' || user_id % 3 END AS family
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS INT) AS k FROM events))"""

RULES = TrafficRules(retired_page="site:en:404", retired_referrer="https://help", retired_days=("2024-01-05", "2024-01-12"))
SQL_FLAGS = f"""{SQL_HITS}, flagged AS (SELECT *,
  page = 'site:en:404' AND referrer = 'https://help' AND day BETWEEN DATE '2024-01-05' AND DATE '2024-01-12' AS is_retired,
  lower(origin) LIKE '%moe%' OR lower(coalesce(renewal, '')) = 'renew' OR coalesce(platform, '') LIKE 'DE:%' AS is_renewal,
  page LIKE '%:support' AS is_support, lower(page) LIKE '%cart details%' OR cart_add = 1 AS is_cart_add FROM hits)"""


def flagged(t: Catalog):
    return traffic.exclusion_flags(hits(t), RULES, "day", "page", "referrer", "origin", "renewal", "platform", "cart_add")


@query("traffic_exclusion_flags", "K21 B11", f"""
WITH {SQL_FLAGS} SELECT event_id, is_retired, is_renewal, is_support, is_cart_add FROM flagged""")
def _(t):
    return flagged(t).select("event_id", "is_retired", "is_renewal", "is_support", "is_cart_add")


def site_list(t: Catalog):
    """Which pages of which site belong to which segment, per country."""
    pages = hits(t).select("site", "page", "country_code").distinct()
    number = F.substring("site", 2, 1).cast("int")
    return pages.select(
        F.upper("site").alias("site_name"), F.upper("page").alias("page_name"), "country_code",
        F.when(number % 2 == 0, F.lit("Core 0")).when(number == 3, F.lit("Core 3")).alias("core_segment"),
        F.when(number % 3 == 0, F.lit("Region")).alias("region_segment"))


def segment_places(t: Catalog):
    return t.spark.createDataFrame(
        [("Core 0", "Brazil", "AMER", "Latin America"), ("Core 3", "Japan", "JAPAN", "Japan"), ("Region", None, "EMEA", None)],
        "segment string, site_country string, site_geo string, site_region string")


@query("site_segments", "K22", f"""
WITH {SQL_HITS}, places(segment, site_country, site_geo, site_region) AS (VALUES ('Core 0', 'Brazil', 'AMER', 'Latin America'), ('Core 3', 'Japan', 'JAPAN', 'Japan'), ('Region', NULL, 'EMEA', NULL)),
sites AS (SELECT DISTINCT site, page, country_code, CASE WHEN CAST(substr(site, 2, 1) AS INT) % 2 = 0 THEN 'Core 0' WHEN site = 'S3' THEN 'Core 3' END AS core_segment,
  CASE WHEN CAST(substr(site, 2, 1) AS INT) % 3 = 0 THEN 'Region' END AS region_segment FROM hits)
SELECT event_id, 'Core Site' AS segment_type, segment, site_country, site_geo, site_region FROM hits JOIN sites USING (site, page, country_code) JOIN places ON segment = core_segment
UNION ALL SELECT event_id, 'Region Site', segment, site_country, site_geo, site_region FROM hits JOIN sites USING (site, page, country_code) JOIN places ON segment = region_segment""")
def _(t):
    segments = traffic.segment_list(
        site_list(t), {"core_segment": "Core Site", "region_segment": "Region Site"}, segment_places(t))
    return traffic.segmented_hits(hits(t), segments, "site", "page", "country_code").select(
        "event_id", "segment_type", "segment", "site_country", "site_geo", "site_region")


@query("cart_add_visits", "K23 W15 J13", f"""
WITH {SQL_FLAGS}, quoted AS (SELECT visit_id FROM flagged GROUP BY 1 HAVING max(CAST(page LIKE '%404%' AS INT)) = 1 AND max(CAST(page LIKE '%trial%' AS INT)) = 0)
SELECT event_id, visit_id, family, visit_id IN (SELECT visit_id FROM quoted) AS is_quote_only FROM flagged WHERE is_cart_add
QUALIFY row_number() OVER (PARTITION BY visit_id, family ORDER BY ts DESC, event_id DESC) = 1""")
def _(t):
    return traffic.cart_add_visits(
        flagged(t), "visit_id", F.col("page").like("%404%"), F.col("page").like("%trial%"), ["visit_id", "family"], "ts", "event_id"
    ).select("event_id", "visit_id", "family", "is_quote_only")


@query("visit_fact", "K24 G14", f"""
WITH {SQL_FLAGS}, h AS (SELECT *, CAST(lower(link) NOT LIKE '%sign in%' AND event = 'link-click' AS BIGINT) AS is_prospect,
  CAST(upper(page) LIKE '%:PRODUCTS:%' AS BIGINT) AS is_product_page, CASE WHEN event IN ('link-click', 'add-to-cart') OR length(link) = 0 OR coalesce(form_attempt, 0) > 0 THEN 0 ELSE 1 END AS bounce_page
  FROM flagged WHERE NOT is_retired AND NOT is_renewal),
d AS (SELECT visit_id, family, country_code, max(is_prospect) AS is_prospect, max(is_product_page) AS is_product_page, max(CAST(cart_add AS BIGINT)) AS cart_add FROM h GROUP BY 1, 2, 3),
v AS (SELECT visit_id, CAST(min(bounce_page) AS BIGINT) AS bounce_page, count(DISTINCT page) AS pages_distinct, CAST(sum(page_view) AS BIGINT) AS page_views_sum FROM h GROUP BY 1)
SELECT d.*, v.bounce_page, v.pages_distinct, v.page_views_sum, CASE WHEN pages_distinct = 0 THEN page_views_sum ELSE pages_distinct END AS page_views,
  CAST(pages_distinct = 1 AND bounce_page = 1 AS BIGINT) AS is_bounce_distinct, CAST(page_views_sum = 1 AND bounce_page = 1 AS BIGINT) AS is_bounce_sum,
  CAST(pages_distinct = 1 AND bounce_page = 1 AS BIGINT) AS is_bounce FROM d JOIN v USING (visit_id)""")
def _(t):
    kept = flagged(t).filter("NOT is_retired AND NOT is_renewal")
    ready = traffic.hit_flags(kept, RULES, "page", "event", "link", "form_attempt")
    return plain(traffic.visit_fact(ready, "visit_id", ["family", "country_code"], "page", "page_view",
                                    ["is_prospect", "is_product_page", "cart_add"]))


CUBE_SQL = """'WEEK-GEO' || CASE WHEN grouping(priority) = 0 THEN '-PRIO' ELSE '' END || CASE WHEN grouping(segment) = 0 THEN '-SEG' ELSE '' END"""


@query("weekly_traffic_cube", "K25 K9 G10 J5", f"""
WITH {SQL_ACCOUNTS}, {sql_calendar(SALES_AS_OF, '1995-01-01')},
visits AS MATERIALIZED (SELECT o_orderkey, o_custkey, o_orderstatus, qi, fiscal_week, geo, o_orderpriority AS priority, nullif(c_mktsegment, 'FURNITURE') AS segment
  FROM orders JOIN accounts ON o_custkey = c_custkey JOIN calendar ON date_key = CAST(o_orderdate AS DATE) WHERE {sql_from('date_key', SALES_AS_OF)} >= -6),
cells AS MATERIALIZED (SELECT qi, fiscal_week, geo, priority, segment, {CUBE_SQL} AS aggregated_by, count(DISTINCT o_orderkey) AS visits, count(DISTINCT CASE WHEN o_orderstatus <> 'P' THEN o_custkey END) AS new_visitors,
  count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_custkey END) AS buyers, nullif(count(DISTINCT CASE WHEN o_orderstatus = 'O' THEN o_orderkey END), 0) AS orders FROM visits GROUP BY qi, fiscal_week, geo, CUBE (priority, segment)),
seen AS (SELECT qi + lag AS qn, lag, cells.* FROM cells, (VALUES (0), (1), (4)) l(lag)),
side AS (SELECT qn, fiscal_week, geo, priority, segment, aggregated_by, {', '.join(f"max({m}) FILTER (lag = {lag}) AS {p}{m}" for m in ('visits', 'new_visitors', 'buyers', 'orders') for p, lag in (('', 0), ('qoq_', 1), ('yoy_', 4)))}
  FROM seen GROUP BY ALL HAVING bool_or(lag = 0))
SELECT {sql_index_label("qn")} AS fiscal_quarter, fiscal_week, geo, priority, segment, aggregated_by, visits, new_visitors, buyers, orders, coalesce(qoq_visits, visits) AS qoq_visits, coalesce(yoy_visits, visits) AS yoy_visits,
  coalesce(qoq_new_visitors, new_visitors) AS qoq_new_visitors, coalesce(yoy_buyers, buyers) AS yoy_buyers, coalesce(qoq_orders, 0) AS qoq_orders, coalesce(yoy_orders, 0) AS yoy_orders FROM side""")
def _(t):
    recent = revenue.with_fiscal_week(revenue.in_calendar(
        t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", order_day().alias("day"), F.col("o_orderpriority").alias("priority")),
        "day", SALES_AS_OF), "day")
    visits = recent.join(accounts(t).select("c_custkey", "geo", F.nullif("c_mktsegment", F.lit("FURNITURE")).alias("segment")),
                         F.col("o_custkey") == F.col("c_custkey"))
    status = F.col("o_orderstatus")
    cube = traffic.weekly_cube(
        visits, ["geo"], {"priority": "PRIO", "segment": "SEG"},
        {"visits": ("o_orderkey", F.lit(True)), "new_visitors": ("o_custkey", status != "P"), "buyers": ("o_custkey", status == "F")},
        visits.filter("o_orderstatus = 'O'"), "o_orderkey", SALES_AS_OF, "WEEK-GEO")
    return plain(cube, "fiscal_quarter", "fiscal_week", "geo", "priority", "segment", "aggregated_by", "visits", "new_visitors", "buyers",
                 "orders", "qoq_visits", "yoy_visits", "qoq_new_visitors", "yoy_buyers", "qoq_orders", "yoy_orders")


# ---- trials ----------------------------------------------------------------

# Product codes standing in for the trial and the ordered product.
CODES = ["AAX", "AAY", "BBX", "CCX", "DDX", "EEX"]
CLASSES = ["Alpha Draw", "Alpha Plan", "Beta", "Gamma", "Alpha Collection", "Epsilon Collection"]


def coded_by(position, values):
    return F.element_at(F.array(*[F.lit(v) for v in values]), position + 1)


def sql_coded(position, values):
    return f"[{', '.join(repr(v) for v in values)}][{position} + 1]"


def trial_tables(t: Catalog):
    day = F.col("ts").cast("date")
    parsed = t.events.withColumn("c", F.get_json_object("props", "$.k").cast("int") % 6)
    base = parsed.select("event_id", "user_id", "event_type", "value", day.alias("day"), "c", coded_by(F.col("c"), CODES).alias("product"))
    base = base.withColumn("subscription_id", F.concat_ws("-", "user_id", "product"))
    downloads = base.filter("event_type = 'signup'").select(
        "user_id", "product", F.col("subscription_id"), F.col("day").alias("entitled"), F.date_add("day", 6).alias("ended"),
        coded_by(F.col("c"), CLASSES).alias("product_name")).distinct()
    actor = F.when(F.col("value") < 60, F.col("user_id")).otherwise(F.col("user_id") + 1)
    activations = base.filter("event_type = 'click'").groupBy("subscription_id", "product", actor.alias("user_id")).agg(
        F.min("day").alias("activated"))
    return base, downloads, activations


SQL_TRIALS = f"""web AS (SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS day, c, {sql_coded('c', CODES)} AS product, user_id || '-' || {sql_coded('c', CODES)} AS subscription_id
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS INT) % 6 AS c FROM events)),
downloads AS (SELECT DISTINCT user_id, product, subscription_id, day AS entitled, day + 6 AS ended, {sql_coded('c', CLASSES)} AS product_name FROM web WHERE event_type = 'signup'),
activations AS (SELECT subscription_id, product, CASE WHEN value < 60 THEN user_id ELSE user_id + 1 END AS activation_user, min(day) AS activated FROM web WHERE event_type = 'click' GROUP BY ALL),
trials AS (SELECT d.*, activation_user, activated, coalesce(d.user_id = activation_user, false) AS valid_activation,
  dense_rank() OVER (PARTITION BY d.user_id, d.product, entitled, ended ORDER BY coalesce(d.user_id = activation_user, false) DESC, activated ASC NULLS LAST, d.subscription_id DESC) = 1 AS valid_download
  FROM downloads d LEFT JOIN activations a ON a.subscription_id = d.subscription_id AND a.product = d.product AND activated BETWEEN entitled AND ended)"""


def trials(t: Catalog):
    base, downloads, activations = trial_tables(t)
    return base, attribution.valid_downloads(
        downloads, activations, ["subscription_id", "product"], ["user_id", "product", "entitled", "ended"],
        "user_id", "entitled", "ended", "activated", "subscription_id")


@query("trial_downloads", "K14 J10 W7", f"""
WITH {SQL_TRIALS} SELECT user_id, product, subscription_id, CAST(entitled AS VARCHAR) AS entitled, CAST(activated AS VARCHAR) AS activated, activation_user, valid_activation, valid_download FROM trials""")
def _(t):
    _, found = trials(t)
    return plain(found, "user_id", "product", "subscription_id", "entitled", "activated", "activation_user", "valid_activation", "valid_download")


@query("trial_conversions", "K14 K15 J9 W6", f"""
WITH {SQL_TRIALS}, bought AS (SELECT event_id AS order_id, user_id, day AS ordered, product AS ordered_product, {sql_coded('c', CLASSES)} AS ordered_class FROM web WHERE event_type = 'purchase'),
tiers AS (SELECT order_id, b.user_id, ordered, t.product, activated, entitled, subscription_id, min(CASE WHEN t.product = ordered_product THEN 1 WHEN left(t.product, 3) = left(ordered_product, 3) THEN 2
    WHEN upper(product_name) LIKE '%ALPHA%' AND upper(ordered_class) LIKE '%ALPHA%' THEN 2 WHEN upper(ordered_class) LIKE '%COLLECTION%' THEN 3 ELSE 4 END) AS match_tier
  FROM bought b JOIN trials t ON b.user_id = t.user_id AND ordered >= activated AND ordered <= entitled + 90 GROUP BY ALL),
ranked AS (SELECT *, dense_rank() OVER (PARTITION BY order_id, ordered, user_id ORDER BY match_tier, activated DESC, subscription_id DESC) AS match_rank FROM tiers)
SELECT order_id, user_id, CAST(ordered AS VARCHAR) AS ordered, product, CAST(activated AS VARCHAR) AS activated, CAST(entitled AS VARCHAR) AS entitled, subscription_id, CAST(match_tier AS BIGINT) AS match_tier, CAST(match_rank AS BIGINT) AS match_rank, match_rank = 1 AS converted FROM ranked""")
def _(t):
    base, found = trials(t)
    candidates = found.select(F.col("user_id").alias("trial_user"), "product", "product_name", "subscription_id", "entitled", "activated")
    bought = base.filter("event_type = 'purchase'").select(
        F.col("event_id").alias("order_id"), "user_id", F.col("day").alias("ordered"), F.col("product").alias("ordered_product"),
        coded_by(F.col("c"), CLASSES).alias("ordered_class"))
    tier = attribution.match_tier("product", "ordered_product", "product_name", "ordered_class", ["ALPHA"])
    won = attribution.trial_conversions(
        bought, candidates, "user_id", "trial_user", "order_id", "ordered", "activated", "entitled", "subscription_id", "product",
        tier)
    return plain(won, "order_id", "user_id", "ordered", "product", "activated", "entitled", "subscription_id", "match_tier", "match_rank", "converted")


@query("last_click_before_purchase", "W14", """
SELECT p.event_id, p.user_id, CAST(c.ts AS VARCHAR) AS matched_at, c.event_id AS click_id, c.value AS click_value
FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') c ON p.user_id = c.user_id AND p.ts >= c.ts""")
def _(t):
    bought = t.events.filter("event_type = 'purchase'").select("event_id", "user_id", F.col("ts").alias("bought_at"))
    clicks = t.events.filter("event_type = 'click'").select(
        "user_id", F.col("ts").alias("at"), F.col("event_id").alias("click_id"), F.col("value").alias("click_value"))
    found = joins.asof_join(bought, clicks, "user_id", "bought_at", "at", ["click_id", "click_value"])
    return plain(found, "event_id", "user_id", "matched_at", "click_id", "click_value")


@query("last_touch_of_order", "W14 K26", """
WITH touches AS (SELECT l_orderkey, l_suppkey, l_returnflag, max(l_shipdate) AS touched FROM lineitem GROUP BY 1, 2, 3)
SELECT l_orderkey, l_returnflag, CAST(CAST(touched AS DATE) AS VARCHAR) AS touched, coalesce(n, 1000 + l_suppkey) AS campaign
FROM (SELECT * FROM touches QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY touched DESC NULLS LAST, l_suppkey DESC, l_returnflag DESC) = 1)
LEFT JOIN (SELECT s_suppkey, s_nationkey AS n FROM supplier WHERE s_acctbal > 0) ON l_suppkey = s_suppkey""")
def _(t):
    stack = t.lineitem.select("l_orderkey", "l_suppkey", "l_returnflag", "l_shipdate", (F.col("l_suppkey") + 1000).alias("campaign"))
    taxonomy = t.supplier.filter("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    won = attribution.last_touch(stack, "l_orderkey", "l_shipdate", ["l_suppkey", "l_returnflag", "campaign"],
                                 taxonomy, "l_suppkey", "s_nationkey", "campaign")
    return won.select("l_orderkey", "l_returnflag", F.col("touched_at").cast("date").cast("string").alias("touched"), "campaign")


@query("undelivered_leads", "K18 J13", """
WITH snaps AS (SELECT user_id, CAST(json_extract(props, '$.k') AS INT) % 3 AS industry, event_id, ts, floor(value / 10) AS score FROM events WHERE event_type <> 'error'),
newest AS (SELECT * FROM snaps QUALIFY row_number() OVER (PARTITION BY user_id, industry ORDER BY ts DESC, score DESC) = 1)
SELECT event_id, user_id, CAST(industry AS BIGINT) AS industry, CAST(score AS BIGINT) AS score FROM newest WHERE score >= 7
AND user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND value > 120)""")
def _(t):
    snapshots = t.events.filter("event_type <> 'error'").select(
        "user_id", (F.get_json_object("props", "$.k").cast("int") % 3).alias("industry"), "event_id", "ts",
        F.floor(F.col("value") / 10).alias("score"))
    delivered = t.events.filter("event_type = 'error' AND value > 120").select("user_id")
    return plain(attribution.undelivered(snapshots, delivered, "user_id", ["user_id", "industry"], "ts", "score", 7, "user_id"),
                 "event_id", "user_id", "industry", "score")
