"""Projection, filters, predicates, scalar functions, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import fiscal, keys, numbers, text
from tidemark.operators import conform
from tidemark.operators.conform import Target
from tidemark.operators.dimensions import last_refresh
from tidemark.operators.joins import without
from tidemark.queries.output import plain
from tidemark.queries.registry import query
from tidemark.queries.roles import (
    SALES_AS_OF, SQL_ACCOUNTS, accounts, order_day, sql_begin, sql_index, sql_label, sql_quarter, sql_year,
)
from tidemark.sources.sinks import report_columns, sort_id

SALES_DATE = f"DATE '{SALES_AS_OF}'"

# ---- projections -----------------------------------------------------------

@query("scan_rename", "A1 B1 B4a", "SELECT c_custkey AS account_id, c_name AS account_name, c_mktsegment AS segment FROM customer")
def _(t):
    columns = ["c_custkey", "c_name", "c_mktsegment"]
    return t.customer.select(*columns).withColumnsRenamed(
        {"c_custkey": "account_id", "c_name": "account_name", "c_mktsegment": "segment"})


@query("declared_projection", "B2 B6", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(CAST(o_totalprice AS DECIMAL(38,6)) AS DOUBLE) AS price,
  CAST(o_orderstatus AS VARCHAR) AS status, 'EUR' AS currency, CAST(NULL AS VARCHAR) AS channel FROM orders""")
def _(t):
    return plain(conform.conform(t.orders, {
        "order_id": Target("string", source="O_ORDERKEY"),
        "price": Target("decimal(38,6)", source="o_totalprice"),
        "status": Target("string", source="o_orderstatus"),
        "currency": Target("string", default="EUR"),
        "channel": Target("string"),
    }))


@query("declared_aggregation", "B3 G1", """
SELECT upper(o_orderpriority) AS priority, 'store' AS channel, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
  count(o_orderkey) AS orders, CAST(0.0 AS DOUBLE) AS refunds
FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1""")
def _(t):
    spec = {
        "priority": Target("string", source="o_orderpriority", shape=F.upper),
        "channel": Target("string", default="store"),
        "revenue": Target("decimal(18,2)", source="o_totalprice", agg="sum"),
        "orders": Target("bigint", source="o_orderkey", agg="count"),
        "refunds": Target("double", default=0.0, agg="sum"),
    }
    return plain(conform.conform_agg(t.orders, spec, F.col("o_orderstatus") != "P"))


@query("columns_except", "B4", "SELECT p_partkey, p_name AS product, p_brand, p_type, p_size FROM part")
def _(t):
    return plain(conform.columns_except(t.part, ["P_RETAILPRICE"], {"P_NAME": "product"}))


@query("sentinels_to_null", "B5 F17", """
SELECT doc_id, CASE WHEN lang NOT IN ('fr', '*') THEN lang END AS lang,
  CASE WHEN upper(source) NOT IN ('SRC0', 'UNKNOWN') THEN source END AS source,
  coalesce(CASE WHEN lang NOT IN ('fr', '*') THEN lang END, 'none') AS lang_or_default FROM documents""")
def _(t):
    lang = text.null_if_any("lang", ["fr", "*"])
    return t.documents.select(
        "doc_id", lang.alias("lang"), text.null_if_any("source", ["src0", "unknown"], ignore_case=True).alias("source"),
        F.coalesce(lang, F.lit("none")).alias("lang_or_default"))


STATUS = {"O": "Open", "F": "Fulfilled", "P": "Pending"}


@query("coded_status", "B7", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Fulfilled' WHEN 'P' THEN 'Pending' END AS status,
  CASE WHEN o_orderstatus IN ('F') THEN 'Closed' ELSE 'Open' END AS stage FROM orders""")
def _(t):
    return t.orders.select("o_orderkey", text.coded("o_orderstatus", STATUS).alias("status"),
                           F.when(F.col("o_orderstatus").isin("F"), "Closed").otherwise("Open").alias("stage"))


@query("keyword_class", "B8 F8", """
SELECT doc_id, CASE WHEN text ILIKE '%license%' THEN 'License' WHEN text ILIKE '%the %' THEN 'English'
  WHEN text ILIKE '%der %' THEN 'German' WHEN text ILIKE '%le %' THEN 'French' ELSE 'Other' END AS class FROM documents""")
def _(t):
    rules = [("%license%", "License"), ("%the %", "English"), ("%der %", "German"), ("%le %", "French")]
    return t.documents.select("doc_id", text.keyword_class("text", rules, "Other").alias("class"))


@query("origin_segment", "B9", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN CASE WHEN o_orderpriority = '1-URGENT' THEN 'Accounts'
    WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN 'E-Commerce' WHEN o_orderpriority = '5-LOW' THEN 'Inside Sales'
    ELSE 'Other' END ELSE 'Other' END AS origin FROM orders""")
def _(t):
    inner = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "Accounts")
        .when(F.col("o_orderpriority").isin("2-HIGH", "3-MEDIUM"), "E-Commerce")
        .when(F.col("o_orderpriority") == "5-LOW", "Inside Sales").otherwise("Other"))
    return t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "O", inner).otherwise("Other").alias("origin"))


@query("page_patterns", "B11", """
SELECT page_id, (url LIKE '%/en/%' OR url LIKE '%/fr/%') AS west, NOT (url ILIKE '%HTML' OR url ILIKE '%#TOP') AS plain_page
FROM pages""")
def _(t):
    return t.pages.select("page_id", text.like_any("url", ["%/en/%", "%/fr/%"]).alias("west"),
                          (~text.like_any("url", ["%html", "%#top"], ignore_case=True)).alias("plain_page"))


@query("composite_filter", "B12", """
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE ((upper(o_orderstatus) = 'P' AND coalesce(nullif(o_orderpriority, '5-LOW'), '') <> '') OR upper(o_orderstatus) IN ('O', 'F'))
AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R' AND l_linenumber = 1)""")
def _(t):
    status = F.upper("o_orderstatus")
    wanted = ((status == "P") & (F.coalesce(F.nullif("o_orderpriority", F.lit("5-LOW")), F.lit("")) != "")) | status.isin("O", "F")
    # exclusions as a left anti join, which keeps rows with NULL keys
    excluded = t.lineitem.filter((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1))
    kept = without(t.orders.filter(wanted), excluded, "o_orderkey", "l_orderkey")
    return kept.select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query("fiscal_windows", "B13 B14 B15 I14", f"""
SELECT o_orderkey, CAST(o_orderdate AS DATE) BETWEEN DATE '2000-02-01' AND {SALES_DATE} AS in_session,
  o_orderdate >= {sql_begin(SALES_DATE)} - INTERVAL 18 MONTH AND o_orderdate < {SALES_DATE} AS last_six_quarters,
  o_orderdate >= date_trunc('month', {SALES_DATE} - INTERVAL 16 MONTH) AS rolling_months,
  o_orderdate >= {SALES_DATE} - INTERVAL 40 DAY AS last_forty_days FROM orders""")
def _(t):
    day = order_day()
    return t.orders.select(
        "o_orderkey", day.between(F.lit("2000-02-01"), fiscal.as_date(SALES_AS_OF)).alias("in_session"),
        ((day >= fiscal.window_start(SALES_AS_OF, 6)) & (day < fiscal.as_date(SALES_AS_OF))).alias("last_six_quarters"),
        (day >= fiscal.rolling_month_start(SALES_AS_OF, 16)).alias("rolling_months"),
        (day >= F.date_sub(fiscal.as_date(SALES_AS_OF), 40)).alias("last_forty_days"))


@query("membership", "B18", """
SELECT o_orderkey, o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) AS in_debt
FROM orders WHERE (o_custkey, o_orderpriority) IN (
  SELECT (o_custkey, o_orderpriority) FROM orders WHERE o_orderstatus = 'P')""")
def _(t):
    pending = t.orders.filter("o_orderstatus = 'P'").select("o_custkey", "o_orderpriority").distinct()
    debtors = t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("debtor"))
    member = t.orders.join(pending, ["o_custkey", "o_orderpriority"], "left_semi")
    return member.join(debtors, F.col("o_custkey") == F.col("debtor"), "left").select(
        "o_orderkey", F.col("debtor").isNotNull().alias("in_debt"))


@query("scalar_subquery", "B19", """
SELECT o_orderkey, (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) - CAST(o_orderdate AS DATE) AS age_days
FROM orders WHERE o_totalprice > (SELECT sum(CAST(o_totalprice AS DECIMAL(18,2))) / count(*) FROM orders)""")
def _(t):
    mean = t.orders.agg((F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1))).alias("m"))
    newest = t.orders.agg(F.max(order_day()).alias("d"))
    return plain(t.orders.filter(F.col("o_totalprice") > mean.scalar()).select(
        "o_orderkey", F.datediff(newest.scalar(), order_day()).alias("age_days")))


@query("null_or_zero_pruning", "B17", """
SELECT o_custkey, CAST(coalesce(sum(CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN 1 ELSE 0 END), 0) AS BIGINT) AS urgent_pending,
  CAST(sum(CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN 1 END) AS BIGINT) AS low_done
FROM orders GROUP BY 1
HAVING NOT (coalesce(urgent_pending, 0) = 0 AND coalesce(low_done, 0) = 0)""")
def _(t):
    p, s = F.col("o_orderpriority"), F.col("o_orderstatus")
    sums = t.orders.groupBy("o_custkey").agg(
        F.sum(F.when((p == "1-URGENT") & (s == "P"), 1).otherwise(0)).alias("urgent_pending"),
        F.sum(F.when((p == "5-LOW") & (s == "F"), 1)).alias("low_done"))
    return sums.filter(~numbers.all_zero("urgent_pending", "low_done"))


# ---- scalar functions ------------------------------------------------------

@query("text_functions", "F1 F2 F3 F4 F5", r"""
SELECT c_custkey, lower(c_name) || '|' || left(c_mktsegment, 3) || '|' || right(c_name, 4) AS packed,
  CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey AS VARCHAR) || c_mktsegment END AS strict_joined,
  lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS padded, length(c_name) AS name_length,
  split_part(c_name, '#', 2) AS number_text, split_part(c_name || ' Ltd', ' ', 1) AS first_word,
  strpos(c_name, '#') AS mark_at, replace(c_name, 'Customer', 'Account') AS renamed,
  CAST(try_cast(ltrim(split_part(c_name, '#', 2), '0') AS BIGINT) AS BIGINT) AS number FROM customer""")
def _(t):
    half = F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey").cast("string"))
    return plain(t.customer.select(
        "c_custkey",
        F.concat(F.lower("c_name"), F.lit("|"), F.left("c_mktsegment", F.lit(3)), F.lit("|"), F.right("c_name", F.lit(4))).alias("packed"),
        text.strict_concat(half, "c_mktsegment").alias("strict_joined"),
        F.lpad(F.col("c_custkey").cast("string"), 10, "0").alias("padded"), F.length("c_name").alias("name_length"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("number_text"),
        text.before_space(F.concat("c_name", F.lit(" Ltd"))).alias("first_word"),
        F.locate("#", "c_name").alias("mark_at"), F.replace("c_name", F.lit("Customer"), F.lit("Account")).alias("renamed"),
        F.ltrim(F.split_part("c_name", F.lit("#"), F.lit(2)), F.lit("0")).try_cast("bigint").alias("number")))


@query("pattern_functions", "F6 F7", r"""
SELECT page_id, nullif(regexp_extract(url, '/([0-9]+)', 1), '') AS page_number, regexp_replace(url, '[^0-9]', '', 'g') AS digits,
  regexp_full_match(url, 'https?://m\..*') AS is_mobile, CAST(len(string_split(url, '/')) - 1 AS BIGINT) AS slashes,
  array_to_string(list_slice(string_split(url, '/'), 1, 3), '/') AS origin, split_part(url, '?', 1) AS path FROM pages""")
def _(t):
    return plain(t.pages.select(
        "page_id", F.nullif(F.regexp_extract("url", "/([0-9]+)", 1), F.lit("")).alias("page_number"),
        F.regexp_replace("url", "[^0-9]", "").alias("digits"),
        text.matches_whole("url", r"https?://m\..*").alias("is_mobile"),
        F.regexp_count("url", F.lit("/")).alias("slashes"),
        F.substring_index("url", "/", 3).alias("origin"), text.cut_suffix("url", "?").alias("path")))


@query("numbers_from_text", "F9 F11 F18", """
SELECT l_orderkey, l_linenumber, CAST(round(CAST(l_extendedprice AS DECIMAL(18,2))) AS BIGINT) AS whole,
  CAST(round(CAST(l_discount AS DECIMAL(4,2)) * 100) AS BIGINT) AS percent,
  round(CASE WHEN l_tax = 0 THEN NULL ELSE l_discount / l_tax END, 4) AS ratio_or_null,
  CASE WHEN l_tax = 0 THEN 0.0 ELSE round(l_discount / l_tax, 4) END AS ratio_or_zero,
  abs(l_linenumber - 4) % 2 AS odd_distance, CAST(NULL AS BIGINT) AS not_a_number FROM lineitem""")
def _(t):
    with_commas = F.format_number(F.col("l_extendedprice").cast("decimal(18,2)"), 2)
    percent_text = F.concat(F.format_number(F.col("l_discount").cast("decimal(4,2)") * 100, 0), F.lit("%"))
    return plain(t.lineitem.select(
        "l_orderkey", "l_linenumber", numbers.whole_number(with_commas).cast("bigint").alias("whole"),
        numbers.percent(percent_text).cast("bigint").alias("percent"),
        numbers.ratio("l_discount", "l_tax").alias("ratio_or_null"),
        numbers.ratio("l_discount", "l_tax", null_on_zero=False).alias("ratio_or_zero"),
        (F.abs(F.col("l_linenumber") - 4) % 2).alias("odd_distance"),
        numbers.whole_number(F.concat("l_returnflag", F.lit("x"))).cast("bigint").alias("not_a_number")))


@query("tactic_ids", "F10", """
WITH raw AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN lpad(CAST(o_orderkey AS VARCHAR), 10, '9')
    WHEN 1 THEN lpad(CAST(o_orderkey AS VARCHAR), 7, '8') WHEN 2 THEN lpad(CAST(o_orderkey AS VARCHAR), 6, '7')
    ELSE 'T' || lpad(CAST(o_orderkey AS VARCHAR), 6, '0') END AS raw_id FROM orders)
SELECT o_orderkey, CASE WHEN length(raw_id) = 10 AND try_cast(raw_id AS BIGINT) IS NOT NULL THEN left(raw_id, 7)
  WHEN length(raw_id) IN (6, 7) AND try_cast(raw_id AS BIGINT) IS NOT NULL THEN raw_id END AS tactic FROM raw""")
def _(t):
    key = F.col("o_orderkey").cast("string")
    raw = (
        F.when(F.col("o_orderkey") % 4 == 0, F.lpad(key, 10, "9")).when(F.col("o_orderkey") % 4 == 1, F.lpad(key, 7, "8"))
        .when(F.col("o_orderkey") % 4 == 2, F.lpad(key, 6, "7")).otherwise(F.concat(F.lit("T"), F.lpad(key, 6, "0"))))
    return t.orders.select("o_orderkey", text.tactic_key(raw).alias("tactic"))


@query("date_functions", "F12 F13 F14 F24", f"""
SELECT o_orderkey, CAST(strptime(strftime(o_orderdate, '%m/%d/%Y %I:%M:%S %p'), '%m/%d/%Y %I:%M:%S %p') AS VARCHAR) AS parsed,
  date_diff('day', CAST(o_orderdate AS DATE), {SALES_DATE}) AS days_apart,
  CAST(floor(({SALES_DATE} - DATE '1970-01-04') / 7) - floor((CAST(o_orderdate AS DATE) - DATE '1970-01-04') / 7) AS BIGINT) AS weeks_apart,
  CAST(CAST(o_orderdate + INTERVAL 3 MONTH AS DATE) AS VARCHAR) AS plus_quarter,
  CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month_start, month(o_orderdate) AS month_number,
  strftime(o_orderdate, '%b') AS month_name, strftime(o_orderdate, '%a') AS day_name,
  strftime(o_orderdate, '%b %-d, %Y') AS display,
  (SELECT count(*) FROM generate_series(CAST(o_orderdate AS DATE) + 1, {SALES_DATE}, INTERVAL 1 DAY) g(d) WHERE isodow(d) < 6) AS workdays
FROM orders WHERE o_orderdate <= {SALES_DATE}""")
def _(t):
    day = order_day()
    stamp = F.date_format("o_orderdate", "MM/dd/yyyy hh:mm:ss a")
    return plain(t.orders.filter(day <= fiscal.as_date(SALES_AS_OF)).select(
        "o_orderkey", F.to_timestamp_ntz(stamp, F.lit("MM/dd/yyyy hh:mm:ss a")).alias("parsed"),
        fiscal.boundary_days(day, fiscal.as_date(SALES_AS_OF)).alias("days_apart"),
        fiscal.boundary_weeks(day, fiscal.as_date(SALES_AS_OF)).alias("weeks_apart"),
        F.add_months(day, 3).alias("plus_quarter"), F.trunc(day, "MM").alias("month_start"), F.month(day).alias("month_number"),
        F.date_format(day, "MMM").alias("month_name"), F.date_format(day, "E").alias("day_name"),
        F.date_format(day, "MMM d, yyyy").alias("display"),
        fiscal.workdays(day, fiscal.as_date(SALES_AS_OF)).alias("workdays")))


@query("greatest_date_and_bands", "F16 F25", f"""
WITH d AS (SELECT l_orderkey, l_linenumber, {SALES_DATE} - CAST(l_shipdate AS DATE) AS age, CASE WHEN l_returnflag = 'R' THEN CAST(l_shipdate AS DATE) + 7 END AS returned,
  CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS done FROM lineitem),
v AS (SELECT *, CASE WHEN done IS NULL THEN 9999 WHEN returned IS NULL THEN age END AS days FROM d)
SELECT l_orderkey, l_linenumber, CAST(greatest(coalesce(returned, DATE '1900-01-01'), coalesce(done, DATE '1900-01-01')) AS VARCHAR) AS closed,
  CASE WHEN days IS NULL THEN 'N/A' WHEN days = 9999 THEN 'NOT COMPLETE' WHEN days <= 100 THEN '< 100 days'
    WHEN days <= 1000 THEN '100 to 1000 days' ELSE '> 1000 days' END AS band FROM v""")
def _(t):
    shipped = F.col("l_shipdate").cast("date")
    returned = F.when(F.col("l_returnflag") == "R", F.date_add(shipped, 7))
    done = F.when(F.col("l_linestatus") == "F", shipped)
    never = F.lit("1900-01-01").cast("date")
    days = F.when(done.isNull(), 9999).when(returned.isNull(), F.datediff(fiscal.as_date(SALES_AS_OF), shipped))
    return plain(t.lineitem.select(
        "l_orderkey", "l_linenumber", F.greatest(F.coalesce(returned, never), F.coalesce(done, never)).alias("closed"),
        numbers.band(days, [(100, "< 100 days"), (1000, "100 to 1000 days")], "> 1000 days", "N/A", 9999, "NOT COMPLETE").alias("band")))


@query("hashed_keys", "F19", """
SELECT c_custkey, CAST(('0x' || md5(c_name))::UHUGEINT % 10000000 AS BIGINT) AS name_key,
  CAST(('0x' || md5(coalesce(nullif(c_mktsegment, 'BUILDING'), 'Unknown')))::UHUGEINT % 10000000 AS BIGINT) AS segment_key FROM customer""")
def _(t):
    segment = F.coalesce(F.nullif("c_mktsegment", F.lit("BUILDING")), F.lit("Unknown"))
    return t.customer.select("c_custkey", keys.hash_key("c_name").alias("name_key"), keys.hash_key(segment).alias("segment_key"))


@query("content_row_keys", "F20", "SELECT count(DISTINCT (l_orderkey, l_partkey, l_suppkey, l_linenumber)) AS distinct_keys FROM lineitem")
def _(t):
    key = keys.row_key("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return t.lineitem.select(key.alias("k")).agg(F.count_distinct("k").alias("distinct_keys"))


@query("json_functions", "F22", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, array_to_string(json_keys(props), ',') AS names,
  '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS packed FROM events""")
def _(t):
    return t.events.select(
        "event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.array_join(F.json_object_keys("props"), ",").alias("names"),
        F.to_json(F.struct("event_id", "event_type")).alias("packed"))


@query("array_to_rows", "F21", """
SELECT vec_id, CAST(p - 1 AS BIGINT) AS position, CAST(embedding[p] AS DOUBLE) AS value
FROM embeddings, (SELECT unnest(generate_series(1, (SELECT max(len(embedding)) FROM embeddings))) AS p) WHERE p <= len(embedding)""")
def _(t):
    return t.embeddings.select("vec_id", F.posexplode("embedding").alias("position", "v")).select(
        "vec_id", F.col("position").cast("bigint").alias("position"), F.col("v").cast("double").alias("value"))


@query("currency_conversion", "F26", """
WITH rates AS (SELECT n_nationkey, CASE WHEN n_nationkey % 5 <> 0 THEN 1 + n_nationkey / 4.0 END AS rate FROM nation),
terms AS (SELECT l_orderkey, l_linenumber, l_extendedprice, rate, CASE l_linenumber WHEN 1 THEN 'A07' WHEN 2 THEN 'A02' WHEN 3 THEN 'A01' WHEN 4 THEN 'A06' ELSE 'X' END AS term
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN rates ON s_nationkey = n_nationkey)
SELECT l_orderkey, l_linenumber, l_extendedprice / coalesce(rate, 1) AS converted,
  l_extendedprice / coalesce(rate, 1) * CASE term WHEN 'A07' THEN 365.0 WHEN 'A02' THEN 12.0 WHEN 'A01' THEN 1.0 WHEN 'A06' THEN CAST(1 AS DOUBLE) / 3 ELSE CAST(1 AS DOUBLE) END AS yearly
FROM terms""")
def _(t):
    rate = F.when(F.col("s_nationkey") % 5 != 0, 1 + F.col("s_nationkey") / 4.0).cast("double")
    rates = t.supplier.select("s_suppkey", rate.alias("rate"))
    term = text.coded(F.col("l_linenumber").cast("string"), {"1": "A07", "2": "A02", "3": "A01", "4": "A06"}, "X")
    converted = numbers.in_base_currency("l_extendedprice", "rate")
    return plain(t.lineitem.join(rates, F.col("l_suppkey") == F.col("s_suppkey")).withColumn("term", term).select(
        "l_orderkey", "l_linenumber", converted.alias("converted"),
        numbers.annualised(converted, "term").alias("yearly")))


@query("last_refresh", "G22 F15 F23", """
SELECT 'orders' AS source, CAST(CAST((max(o_orderdate) AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles' AS TIMESTAMP) AS VARCHAR) AS refreshed_at FROM orders
UNION ALL SELECT 'lineitem', CAST(CAST((max(l_shipdate) AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles' AS TIMESTAMP) AS VARCHAR) FROM lineitem""")
def _(t):
    return plain(last_refresh({"orders": (t.orders, "o_orderdate"), "lineitem": (t.lineitem, "l_shipdate")},
                              "UTC", "America/Los_Angeles"))


# ---- fiscal labels ---------------------------------------------------------

@query("quarter_labels", "K2 K3 K4 K5", f"""
WITH f AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, {sql_quarter('o_orderdate')} || 'Q' || CASE WHEN o_orderkey % 2 = 0 THEN ' ' ELSE '' END
   || 'FY' || right(CAST({sql_year('o_orderdate')} AS VARCHAR), 2) || ' MDF' AS fund FROM orders),
q AS (SELECT *, month(d) // 3 + 1 - CAST(strftime(d, '%m%d') IN ('0301', '0302') AS INT) AS gq, '20' || substr(replace(fund, ' ', ''), 5, 2) || 'Q' || left(fund, 1) AS year_quarter FROM f)
SELECT o_orderkey, fund, year_quarter,
  left(year_quarter, 4) || CASE right(year_quarter, 2) WHEN 'Q1' THEN '-02-01' WHEN 'Q2' THEN '-05-01' WHEN 'Q3' THEN '-08-01' WHEN 'Q4' THEN '-11-01' END AS first_day,
  (year(d) + 1 + gq // 4) || 'Q' || (gq % 4 + 1) AS gate,
  CASE WHEN {sql_index('d')} = {sql_index(SALES_DATE)} THEN '1. Current Qtr' WHEN {sql_index('d')} = {sql_index(SALES_DATE)} - 1 THEN '2. Previous Qtr'
    WHEN {sql_index('d')} = {sql_index(SALES_DATE)} - 2 THEN '3. Two Qtrs Ago' WHEN {sql_index('d')} < {sql_index(SALES_DATE)} THEN '4. Older' ELSE '5. Future' END AS bucket
FROM q""")
def _(t):
    day = order_day()
    fund = F.concat(fiscal.quarter(day).cast("string"), F.lit("Q"), F.when(F.col("o_orderkey") % 2 == 0, " ").otherwise(""),
                    fiscal.year_label(day), F.lit(" MDF"))
    named = t.orders.select("o_orderkey", day.alias("d"), fund.alias("fund")).withColumn("year_quarter", fiscal.fund_quarter("fund"))
    return named.select("o_orderkey", "fund", "year_quarter", fiscal.label_first_day("year_quarter").alias("first_day"),
                        fiscal.gate_quarter("d").alias("gate"), fiscal.relative_quarter_bucket("d", SALES_AS_OF).alias("bucket"))


@query("restricted_quarters", "K6", f"""
SELECT {sql_label('o_orderdate')} AS fiscal_quarter, count(*) AS orders,
  max(CAST({sql_index('o_orderdate')} = {sql_index("DATE '2001-05-20'")} OR {sql_index('o_orderdate')} = {sql_index("DATE '2001-05-20'")} - 1 AS BIGINT)) AS restricted_in_may,
  max(CAST({sql_index('o_orderdate')} = {sql_index("DATE '2001-06-20'")} AS BIGINT)) AS restricted_in_june FROM orders GROUP BY 1""")
def _(t):
    return plain(t.orders.groupBy(fiscal.quarter_label(order_day()).alias("fiscal_quarter")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.max(fiscal.is_restricted(order_day(), "2001-05-20")).alias("restricted_in_may"),
        F.max(fiscal.is_restricted(order_day(), "2001-06-20")).alias("restricted_in_june")))


# ---- order, limit, set operations ------------------------------------------

@query("top_accounts", "O1 O3", """
SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue, count(*) AS orders
FROM orders GROUP BY 1 ORDER BY revenue DESC, o_custkey LIMIT 100""")
def _(t):
    return plain(t.orders.groupBy("o_custkey").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("revenue"), F.count(F.lit(1)).alias("orders")
    ).orderBy(F.col("revenue").desc(), "o_custkey").limit(100))


@query("report_names", "A13 O2", """
SELECT c_mktsegment AS "Segment", count(*) AS "Accounts", CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 2 ELSE 99 END AS "SortId"
FROM customer GROUP BY 1""")
def _(t):
    counted = t.customer.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "sort_id", sort_id(F.col("c_mktsegment"), ["BUILDING", "MACHINERY"]))
    return plain(report_columns(counted, {"c_mktsegment": "Segment", "n": "Accounts", "sort_id": "SortId"}))


@query("union_aligned", "U1 U3 U5", """
SELECT 'order' AS kind, CAST(o_orderkey AS VARCHAR) AS id, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS amount, o_orderpriority AS priority, NULL AS flag FROM orders
UNION ALL SELECT 'line', CAST(l_orderkey AS VARCHAR) || '-' || l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR), NULL, l_returnflag FROM lineitem""")
def _(t):
    orders = t.orders.select(
        F.lit("order").alias("kind"), F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("amount"), F.col("o_orderpriority").alias("priority"))
    lines = t.lineitem.select(
        F.lit("line").alias("kind"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("amount"), F.col("l_returnflag").alias("flag"))
    return conform.union_relations(orders, lines)


@query("union_distinct", "U2 G3", """
SELECT c_nationkey AS nation, 'x' AS side FROM customer UNION SELECT s_nationkey, 'x' FROM supplier UNION SELECT n_nationkey, 'y' FROM nation""")
def _(t):
    return plain(conform.union_distinct(
        t.customer.select(F.col("c_nationkey").alias("nation"), F.lit("x").alias("side")),
        t.supplier.select(F.col("s_nationkey").alias("nation"), F.lit("x").alias("side")),
        t.nation.select(F.col("n_nationkey").alias("nation"), F.lit("y").alias("side"))))


@query("minus", "U4", """
SELECT o_custkey AS id FROM orders WHERE o_orderpriority = '1-URGENT' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'""")
def _(t):
    return conform.minus(t.orders.filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("id")),
                         t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("id")))


@query("inline_values", "A11", f"""
WITH {SQL_ACCOUNTS}, wanted(geo, target) AS (VALUES ('ASIA', 100), ('EUROPE', 200), ('ATLANTIS', 300))
SELECT geo, CAST(target AS BIGINT) AS target, count(c_custkey) AS accounts FROM wanted LEFT JOIN accounts USING (geo) GROUP BY ALL""")
def _(t):
    wanted = t.spark.createDataFrame([("ASIA", 100), ("EUROPE", 200), ("ATLANTIS", 300)], "geo string, target bigint")
    per_geo = accounts(t).groupBy("geo").agg(F.count("c_custkey").alias("accounts"))
    return wanted.join(per_geo, "geo", "left").select("geo", "target", F.coalesce("accounts", F.lit(0)).alias("accounts"))
