"""Landed files, sinks, incremental loads, streams, on files Spark writes from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import fiscal, text
from tidemark.operators import incremental, period
from tidemark.operators.conform import Target
from tidemark.plans import revenue, traffic
from tidemark.queries.output import plain
from tidemark.queries.registry import query
from tidemark.queries.roles import SALES_AS_OF, order_day, sql_from, sql_index, sql_index_label, sql_week
from tidemark.session import fresh_folder
from tidemark.sources import landing, sinks
from tidemark.streaming import increments

A = f"DATE '{SALES_AS_OF}'"
BOM = "\ufeff"

# ---- files -----------------------------------------------------------------


@query("csv_load", "A2", """
SELECT doc_id, text, lang, nullif(source, 'src0') AS source, n_chars FROM documents""")
def _(t):
    folder = fresh_folder(t.spark, "csv")
    rows = t.documents.withColumn("source", F.nullif("source", F.lit("src0")))
    rows.write.options(header=True, quote='"', escape='"', nullValue="", emptyValue="").csv(f"{folder}/posts")
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    return landing.read_csv(t.spark, f"{folder}/posts/*.csv", schema, multi_line=True)


@query("csv_by_header", "A3 B2", """
SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, CAST(c_acctbal AS DOUBLE) AS c_acctbal, CAST(NULL AS VARCHAR) AS phone, 'file' AS origin FROM customer""")
def _(t):
    folder = fresh_folder(t.spark, "csv")
    t.customer.select(F.col("c_mktsegment").alias(f"{BOM}Segment"), F.col("c_name").alias("C_Name"), F.col("c_acctbal").alias("C_ACCTBAL"),
                      F.col("c_custkey").alias("C_CustKey")).write.options(header=True).csv(folder)
    return landing.read_csv_by_header(t.spark, folder, {
        "c_custkey": Target("bigint"), "c_name": Target("string"), "c_acctbal": Target("double"), "phone": Target("string"),
        "origin": Target("string", default="file")})


@query("newest_file", "A4", "SELECT n_nationkey, n_name FROM nation")
def _(t):
    folder = fresh_folder(t.spark, "drop")
    t.region.select(F.col("r_regionkey").alias("n_nationkey"), F.col("r_name").alias("n_name")).coalesce(1).write.parquet(folder)
    t.nation.select("n_nationkey", "n_name").coalesce(1).write.mode("append").parquet(folder)
    path = landing.newest_file(t.spark, folder, "*.parquet").first().path
    return t.spark.read.parquet(path)


@query("unseen_files", "A5", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P'")
def _(t):
    folder = fresh_folder(t.spark, "drop")
    t.orders.filter("o_orderstatus <> 'P'").select("o_orderkey").write.parquet(folder)
    target = landing.with_file(t.spark.read.parquet(folder))
    loaded = t.spark.read.parquet(sinks.replace_table(target, fresh_folder(t.spark, "target")))
    t.orders.filter("o_orderstatus = 'P'").select("o_orderkey").write.mode("append").parquet(folder)
    return landing.unseen_files(t.spark, folder, loaded, "o_orderkey bigint", pattern="*.parquet").select("o_orderkey")


@query("json_new_keys", "A6 F22 I10", """
SELECT event_id, CAST(user_id AS VARCHAR) AS user, event_type AS kind, CASE WHEN event_type = 'purchase' THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS amount, CASE WHEN event_type = 'error' THEN props END AS detail FROM events""")
def _(t):
    is_purchase, is_error = F.col("event_type") == "purchase", F.col("event_type") == "error"
    # absent fields are not written, so objects of different kinds have different keys
    record = F.to_json(F.struct(
        F.col("user_id").alias("user"), F.col("event_type").alias("kind"),
        F.when(is_purchase, F.col("value").cast("decimal(18,2)").cast("string")).alias("amount"), F.when(is_error, F.col("props")).alias("detail")))
    return landing.json_to_columns(t.events.select("event_id", record.alias("record")), "record", ["user", "kind"])


NESTED = ("profile string, metrics struct<`lifetime.likes`: bigint, `lifetime.views`: bigint>, internal struct<tags: array<bigint>, note: string>, "
          "`clickthrough-link` struct<long: string>")


@query("nested_json_flattened", "A7 A14", """
SELECT doc_id, lang AS profile, CAST(n_chars % 19 AS VARCHAR) AS metrics_lifetime_likes, CASE WHEN n_chars % 2 = 0 THEN CAST(n_chars AS VARCHAR) END AS metrics_lifetime_views,
  CASE WHEN n_chars % 3 > 0 THEN array_to_string(list_transform(generate_series(1, n_chars % 3), lambda x: x + n_chars), ',') END AS internal_tags, CASE WHEN n_chars % 5 = 0 THEN source END AS internal_note, 'http://' || source AS clickthrough_link_long FROM documents""")
def _(t):
    n = F.col("n_chars")
    tags = F.when(n % 3 > 0, F.transform(F.sequence(F.lit(1), n % 3), lambda x: x + n)).otherwise(F.array().cast("array<bigint>"))
    record = F.to_json(F.struct(
        F.col("lang").alias("profile"), F.struct((n % 19).alias("lifetime.likes"), F.when(n % 2 == 0, n).alias("lifetime.views")).alias("metrics"),
        F.struct(tags.alias("tags"), F.when(n % 5 == 0, F.col("source")).alias("note")).alias("internal"),
        F.struct(F.concat(F.lit("http://"), "source").alias("long")).alias("clickthrough-link")))
    flat = landing.flatten_json(t.documents.select("doc_id", record.alias("j")), "j", NESTED)
    return flat.withColumn("internal_tags", F.array_join("internal_tags", ","))


@query("exploded_groups", "A8 F21", """
SELECT DISTINCT c_custkey, unnest(CASE c_mktsegment WHEN 'BUILDING' THEN [NULL] WHEN 'MACHINERY' THEN ['g' || c_nationkey] ELSE ['g' || c_nationkey, 'all'] END) AS group_id FROM customer""")
def _(t):
    group = F.concat(F.lit("g"), F.col("c_nationkey").cast("string"))
    groups = F.when(F.col("c_mktsegment") == "BUILDING", F.array().cast("array<string>")).when(
        F.col("c_mktsegment") == "MACHINERY", F.array(group)).otherwise(F.array(group, F.lit("all")))
    delivered = t.customer.select("c_custkey", groups.alias("group_id"))
    return landing.exploded_list(delivered.unionAll(delivered), "group_id")


@query("tag_names", "A9 A10", """
WITH n AS (SELECT n_nationkey, n_name FROM nation WHERE n_regionkey <> 4)
SELECT doc_id, coalesce(a.n_name, CAST(n_chars % 25 AS VARCHAR)) || ',' || coalesce(b.n_name, CAST((n_chars + doc_id) % 25 AS VARCHAR)) AS tags FROM documents LEFT JOIN n a ON a.n_nationkey = n_chars % 25 LEFT JOIN n b ON b.n_nationkey = (n_chars + doc_id) % 25""")
def _(t):
    folder = fresh_folder(t.spark, "seed")
    # a seed file that starts with a byte-order mark
    t.nation.filter("n_regionkey <> 4").select(F.col("n_nationkey").alias(f"{BOM}n_nationkey"), "n_name").coalesce(1).write.options(header=True).csv(folder)
    seed = landing.read_csv_by_header(t.spark, folder, {"n_nationkey": Target("bigint"), "n_name": Target("string")})
    ids = F.array(F.col("n_chars") % 25, (F.col("n_chars") + F.col("doc_id")) % 25)
    named = landing.names_for_ids(t.documents.select("doc_id", ids.alias("ids")), "ids", seed, "n_nationkey", "n_name", "doc_id", "tags")
    return named.select("doc_id", F.array_join("tags", ",").alias("tags"))


# ---- sinks -----------------------------------------------------------------


@query("replaced_table", "A12 I13 I11", """
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderpriority = '1-URGENT'""")
def _(t):
    path = fresh_folder(t.spark, "table")
    columns = ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    sinks.replace_table(t.orders.select(*columns), path, ["o_orderstatus"])
    sinks.replace_table(t.orders.filter("o_orderpriority = '1-URGENT'").select(*columns), path, ["o_orderstatus"])
    clustered = sinks.write_clustered(t.spark.read.parquet(path), fresh_folder(t.spark, "table"), "o_orderkey")
    return t.spark.read.parquet(clustered).select(*columns)


@query("replaced_day", "I7 A12", """
SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-30' THEN value + 1 ELSE value END AS value FROM events""")
def _(t):
    path = fresh_folder(t.spark, "daily")
    day = F.col("ts").cast("date")
    rows = t.events.select("event_id", "value", day.alias("day"))
    sinks.replace_table(rows, path, ["day"])
    yesterday = rows.filter("day = DATE '2024-01-30'").withColumn("value", F.col("value") + 1)
    # twice: reloading a day must not repeat its rows
    sinks.replace_partitions(yesterday, path, ["day"])
    sinks.replace_partitions(yesterday, path, ["day"])
    return plain(t.spark.read.parquet(path), "event_id", "day", "value")


# ---- increments ------------------------------------------------------------


@query("after_high_water", "I1 B19", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate > (SELECT coalesce(max(o_orderdate), TIMESTAMP '1900-01-01') FROM orders WHERE o_orderstatus = 'F' AND o_orderdate < DATE '2000-01-01')""")
def _(t):
    stored = t.orders.filter("o_orderstatus = 'F' AND o_orderdate < DATE '2000-01-01'")
    return incremental.after_high_water(t.orders, stored, "o_orderdate").select("o_orderkey", "o_custkey")


@query("upserted_rows", "I2 I3 I10", """
WITH target AS (SELECT user_id, CAST(ts AS DATE) AS day, max(event_id) AS event_id, 'old' AS state FROM events WHERE event_type <> 'error' GROUP BY 1, 2),
batch AS (SELECT user_id, CAST(ts AS DATE) AS day, event_id, 'new' AS state, value FROM events WHERE event_type = 'error' QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1)
SELECT user_id, CAST(day AS VARCHAR) AS day, event_id, state, value FROM batch UNION ALL SELECT user_id, CAST(day AS VARCHAR), event_id, state, NULL FROM target WHERE (user_id, day) NOT IN (SELECT (user_id, day) FROM batch)""")
def _(t):
    day = F.col("ts").cast("date")
    target = t.events.filter("event_type <> 'error'").groupBy("user_id", day.alias("day")).agg(
        F.max("event_id").alias("event_id"), F.max("ts").alias("ts")).withColumns({"state": F.lit("old"), "value": F.lit(None).cast("double")})
    batch = t.events.filter("event_type = 'error'").select("user_id", day.alias("day"), "event_id", "ts", F.lit("new").alias("state"), "value")
    path = sinks.replace_table(target, fresh_folder(t.spark, "upserted"), ["day"])
    incremental.upsert_partitions(path, batch, ["user_id", "day"], "day", "ts", "event_id")
    return plain(t.spark.read.parquet(path), "user_id", "day", "event_id", "state", "value")


@query("backfilled_attributes", "I4 I5", """
WITH t AS (SELECT o_orderkey, 'order ' || o_custkey || ';' AS details, CASE WHEN o_orderpriority = '1-URGENT' THEN 'kept' END AS tier FROM orders),
s AS (SELECT c_custkey, c_mktsegment AS tier FROM customer WHERE c_acctbal > 2000)
SELECT o_orderkey, coalesce(t.tier, s.tier) AS tier FROM t LEFT JOIN s ON CAST(regexp_extract(details, '[0-9]+') AS BIGINT) = c_custkey""")
def _(t):
    target = t.orders.select("o_orderkey", F.concat(F.lit("order "), F.col("o_custkey").cast("string"), F.lit(";")).alias("details"),
                             F.when(F.col("o_orderpriority") == "1-URGENT", "kept").alias("tier"))
    source = t.customer.filter("c_acctbal > 2000").select("c_custkey", F.col("c_mktsegment").alias("tier"))
    return incremental.backfill(target, source, F.regexp_extract("details", "[0-9]+", 0), "c_custkey", ["tier"]).select("o_orderkey", "tier")


@query("retained_quarters", "I6 I14", f"""
SELECT o_orderkey, o_orderdate >= {A} - INTERVAL 40 DAY AS in_look_back FROM orders WHERE {sql_from('o_orderdate', SALES_AS_OF)} >= -6""")
def _(t):
    kept = incremental.within_retention(t.orders.select("o_orderkey", order_day().alias("day")), "day", SALES_AS_OF, 6)
    recent = incremental.since_days(kept, "day", SALES_AS_OF).select(F.col("o_orderkey").alias("recent"))
    return kept.join(recent, F.col("o_orderkey") == F.col("recent"), "left").select("o_orderkey", F.col("recent").isNotNull().alias("in_look_back"))


@query("replaced_source", "I8", """
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus <> 'P' UNION ALL SELECT l_orderkey, 'P', NULL FROM lineitem WHERE l_returnflag = 'R' AND l_quantity = 1""")
def _(t):
    prepared = t.lineitem.filter("l_returnflag = 'R' AND l_quantity = 1").select(F.col("l_orderkey").alias("o_orderkey"), F.lit("P").alias("o_orderstatus"))
    target = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return incremental.replace_where(target, prepared, F.col("o_orderstatus") == "P")


@query("new_weeks_against_history", "I9 K9 K25", f"""
WITH w AS (SELECT {sql_index('o_orderdate')} AS qi, {sql_week('o_orderdate')} AS fiscal_week, o_orderpriority AS priority, count(*) AS orders FROM orders GROUP BY ALL),
mark AS (SELECT max(qi * 100 + fiscal_week) AS m FROM w WHERE qi < {sql_index(A)})
SELECT {sql_index_label('a.qi')} AS fiscal_quarter, a.fiscal_week, a.priority, a.orders, coalesce(p.orders, a.orders) AS qoq_orders, coalesce(y.orders, a.orders) AS yoy_orders
FROM w a LEFT JOIN w p ON p.qi = a.qi - 1 AND p.fiscal_week = a.fiscal_week AND p.priority = a.priority LEFT JOIN w y ON y.qi = a.qi - 4 AND y.fiscal_week = a.fiscal_week AND y.priority = a.priority
WHERE a.qi * 100 + a.fiscal_week > (SELECT m FROM mark) AND a.qi = {sql_index(A)}""")
def _(t):
    weekly = revenue.with_fiscal_week(t.orders.select(order_day().alias("day"), F.col("o_orderpriority").alias("priority")), "day").groupBy(
        "quarter_index", "fiscal_week", "priority").agg(F.count(F.lit(1)).alias("orders"))
    this = fiscal.quarter_index(fiscal.as_date(SALES_AS_OF))
    history = weekly.filter(F.col("quarter_index") < this)
    new = traffic.weeks_after(history, weekly.filter(F.col("quarter_index") <= this))
    compared = period.cell_comparison(history.unionByName(new), "quarter_index", ["fiscal_week", "priority"], ["orders"], SALES_AS_OF, fallback=True)
    added = traffic.weeks_after(history, compared)
    return plain(added.withColumn("fiscal_quarter", fiscal.label_of_index("quarter_index")), "fiscal_quarter", "fiscal_week", "priority", "orders", "qoq_orders", "yoy_orders")


@query("date_ranges", "I12 F21", """
WITH r AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS s, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 9 AS INT) AS e FROM orders),
d AS (SELECT o_orderkey, CAST(unnest(generate_series(greatest(s, DATE '1996-03-10'), e, INTERVAL 1 DAY)) AS DATE) AS day FROM r)
SELECT o_orderkey, CAST(day AS VARCHAR) AS day, CAST(day - CAST(dayofweek(day) AS INT) AS VARCHAR) AS week_from, CAST(day - CAST(dayofweek(day) AS INT) + 6 AS VARCHAR) AS week_to FROM d""")
def _(t):
    ranges = t.orders.select("o_orderkey", order_day().alias("s"), F.date_add(order_day(), (F.col("o_orderkey") % 9).cast("int")).alias("e"))
    return plain(incremental.date_ranges(ranges, "s", "e", "1996-03-10"), "o_orderkey", "day", "week_from", "week_to")


@query("month_ranges", "I12", """
WITH r AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS s, CAST(o_orderdate AS DATE) + 75 AS e FROM orders),
m AS (SELECT o_orderkey, s, e, CAST(unnest(generate_series(date_trunc('month', s), date_trunc('month', e), INTERVAL 1 MONTH)) AS DATE) AS m FROM r)
SELECT o_orderkey, CAST(greatest(m, s) AS VARCHAR) AS month_from, CAST(least(last_day(m), e) AS VARCHAR) AS month_to FROM m""")
def _(t):
    ranges = t.orders.select("o_orderkey", order_day().alias("s"), F.date_add(order_day(), 75).alias("e"))
    return plain(incremental.month_ranges(ranges, "s", "e"), "o_orderkey", "month_from", "month_to")


# ---- streams ---------------------------------------------------------------


@query("streamed_increments", "A5 I1 I2", """
SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def _(t):
    """Two landings, two catch-up runs, a redelivered file; then the current rows."""
    landed, target, checkpoint = (fresh_folder(t.spark, n) for n in ("landed", "streamed", "progress"))
    rows = t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")

    def catch_up():
        stream = increments.landed_stream(t.spark, landed, rows.schema)
        fresh = increments.without_redelivery(stream, ["event_id"], "ts", "40 days")
        increments.append_available(fresh, target, checkpoint)

    rows.filter("event_type <> 'purchase'").write.parquet(landed)
    catch_up()
    rows.filter("event_type IN ('purchase', 'click')").write.mode("append").parquet(landed)
    catch_up()
    appended = t.spark.read.parquet(target)
    return increments.current_rows(appended, ["user_id", "event_type"], "ts", "event_id").select("user_id", "event_type", "event_id", "value")
