"""Stored tables that are added to, updated, grown and cut, on tables Spark derives from the given ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import fiscal
from tidemark.operators import distinct_state, gated, key_dictionary, stored_updates
from tidemark.operators.period import QUARTERS_BACK
from tidemark.plans import revenue
from tidemark.queries.output import plain
from tidemark.queries.registry import query
from tidemark.queries.roles import SALES_AS_OF, SQL_ACCOUNTS, accounts, money, order_day, sql_from, sql_index, sql_index_label, sql_label, sql_week
from tidemark.session import fresh_folder
from tidemark.sources import clustered, evolving, files, load_ledger, variants
from tidemark.sources.tables import Catalog
from tidemark.streaming import increments, keyed

A = f"DATE '{SALES_AS_OF}'"

# ---- distinct counts that are added to --------------------------------------

PERIOD = ["quarter_index", "fiscal_week"]
DIMS = {"priority": "PRIO", "segment": "SEG"}
VISITORS = ["visitors", "new_visitors", "buyers"]


def weekly_visits(t: Catalog):
    """Orders of the last six quarters as visits: fiscal week, geo, priority, segment, customer."""
    recent = t.orders.filter(order_day() >= fiscal.window_start(SALES_AS_OF, 6)).select(
        "o_custkey", "o_orderstatus", order_day().alias("day"), F.col("o_orderpriority").alias("priority"))
    side = accounts(t).select("c_custkey", "geo", F.nullif("c_mktsegment", F.lit("FURNITURE")).alias("segment"))
    return revenue.with_fiscal_week(recent, "day").join(side, F.col("o_custkey") == F.col("c_custkey"))


def delivered_visits(t: Catalog):
    """Cells published from a state that got three batches, one of them twice and one late row by row; and the last batch's weeks."""
    state, cells = fresh_folder(t.spark, "state"), fresh_folder(t.spark, "cells")
    status = F.col("o_orderstatus")
    counts = {"visitors": ("o_custkey", F.lit(True)), "new_visitors": ("o_custkey", status != "P"), "buyers": ("o_custkey", status == "F")}
    visits = weekly_visits(t)
    this = fiscal.quarter_index(fiscal.as_date(SALES_AS_OF))
    past, now = visits.filter(F.col("quarter_index") < this), visits.filter(F.col("quarter_index") >= this)
    early, late = past.filter("priority = '1-URGENT'"), past.filter("priority <> '1-URGENT'")
    touched = None
    for batch in (late, late.filter("fiscal_week <= 3"), early, now):
        touched = distinct_state.add_to_state(state, batch, PERIOD, ["geo", *DIMS], counts)
        distinct_state.publish_cells(state, cells, touched, PERIOD, ["geo"], DIMS, VISITORS, "WEEK-GEO")
    return cells, touched


SQL_VISITS = f"""{SQL_ACCOUNTS}, visits AS (SELECT o_custkey, o_orderstatus, {sql_index('o_orderdate')} AS qi, {sql_week('o_orderdate')} AS fiscal_week, geo, o_orderpriority AS priority, nullif(c_mktsegment, 'FURNITURE') AS segment
  FROM orders JOIN accounts ON o_custkey = c_custkey WHERE {sql_from('o_orderdate', SALES_AS_OF)} >= -6),
cells AS (SELECT qi, fiscal_week, geo, priority, segment, 'WEEK-GEO' || CASE WHEN grouping(priority) = 0 THEN '-PRIO' ELSE '' END || CASE WHEN grouping(segment) = 0 THEN '-SEG' ELSE '' END AS aggregated_by,
  count(DISTINCT o_custkey) AS visitors, count(DISTINCT CASE WHEN o_orderstatus <> 'P' THEN o_custkey END) AS new_visitors, count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_custkey END) AS buyers
  FROM visits GROUP BY qi, fiscal_week, geo, CUBE (priority, segment))"""


@query("weekly_distinct_state", "K25 I9 G4 G10", f"""
WITH {SQL_VISITS} SELECT {sql_index_label('qi')} AS fiscal_quarter, fiscal_week, geo, priority, segment, aggregated_by, visitors, new_visitors, buyers FROM cells""")
def _(t):
    cells, _ = delivered_visits(t)
    read = t.spark.read.parquet(cells).withColumn("fiscal_quarter", fiscal.label_of_index("quarter_index"))
    return plain(read, "fiscal_quarter", "fiscal_week", "geo", "priority", "segment", "aggregated_by", *VISITORS)


@query("added_weeks_compared", "I9 K9 K25", f"""
WITH {SQL_VISITS}, keyed AS (SELECT *, concat_ws('/', geo, coalesce(priority, '~'), coalesce(segment, '~'), aggregated_by) AS cell FROM cells)
SELECT {sql_index_label('a.qi')} AS fiscal_quarter, a.fiscal_week, a.geo, a.priority, a.segment, a.aggregated_by, a.visitors, coalesce(p.visitors, a.visitors) AS qoq_visitors, coalesce(y.visitors, a.visitors) AS yoy_visitors, a.buyers, coalesce(y.buyers, a.buyers) AS yoy_buyers
FROM keyed a LEFT JOIN keyed p ON p.qi = a.qi - 1 AND p.fiscal_week = a.fiscal_week AND p.cell = a.cell LEFT JOIN keyed y ON y.qi = a.qi - 4 AND y.fiscal_week = a.fiscal_week AND y.cell = a.cell WHERE a.qi >= {sql_index(A)}""")
def _(t):
    cells, touched = delivered_visits(t)
    compared = distinct_state.compared_cells(cells, touched, *PERIOD, ["geo", *DIMS, "aggregated_by"], VISITORS, QUARTERS_BACK)
    compared = compared.withColumn("fiscal_quarter", fiscal.label_of_index("quarter_index"))
    return plain(compared, "fiscal_quarter", "fiscal_week", "geo", "priority", "segment", "aggregated_by", "visitors", "qoq_visitors", "yoy_visitors", "buyers", "yoy_buyers")


# ---- updates and deletes of stored rows --------------------------------------


@query("backfilled_store", "I4 I5", """
WITH t AS (SELECT o_orderkey, o_custkey, year(o_orderdate) AS y, CASE WHEN o_orderpriority = '1-URGENT' OR year(o_orderdate) < 1994 THEN 'kept' END AS tier, CASE WHEN year(o_orderdate) < 1996 THEN 'x' END AS owner FROM orders)
SELECT o_orderkey, CAST(y AS BIGINT) AS order_year, coalesce(t.tier, CASE WHEN c_acctbal > 2000 THEN c_mktsegment END) AS tier, coalesce(t.owner, CASE WHEN c_acctbal > 2000 THEN c_name END) AS owner FROM t LEFT JOIN customer ON c_custkey = o_custkey""")
def _(t):
    """Two runs over the stored table; the key is pulled out of a text, of a customer's rows the newest counts."""
    path = fresh_folder(t.spark, "orders")
    year = F.year("o_orderdate")
    target = t.orders.select(
        "o_orderkey", F.concat(F.lit("customer "), F.col("o_custkey").cast("string"), F.lit(";")).alias("details"), year.alias("order_year"),
        F.when((F.col("o_orderpriority") == "1-URGENT") | (year < 1994), "kept").alias("tier"), F.when(year < 1996, "x").alias("owner"))
    stored_updates.write_with_gaps(target, path, "order_year", ["tier", "owner"])
    rich = t.customer.filter("c_acctbal > 2000")
    source = rich.select("c_custkey", F.col("c_mktsegment").alias("tier"), F.col("c_name").alias("owner"), F.lit(2).alias("version"))
    stale = rich.select("c_custkey", F.lit("stale").alias("tier"), F.lit("stale").alias("owner"), F.lit(1).alias("version"))
    for _ in range(2):
        stored_updates.backfill_stored(t.spark, path, source.unionByName(stale), F.regexp_extract("details", "[0-9]+", 0), "c_custkey", ["tier", "owner"], "order_year", "version")
    return plain(t.spark.read.parquet(path), "o_orderkey", "order_year", "tier", "owner")


@query("retained_store", "I6 I7", f"""
SELECT o_orderkey, {sql_label('o_orderdate')} AS fiscal_quarter, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1996-05-17'""")
def _(t):
    path = fresh_folder(t.spark, "orders")
    rows = t.orders.select("o_orderkey", fiscal.quarter_label(order_day()).alias("fiscal_quarter"), order_day().alias("day"))
    stored_updates.write_dated(rows, path, "fiscal_quarter", "day")
    for cutoff in ("1994-02-01", "1996-05-17", "1996-05-17"):
        stored_updates.drop_before(t.spark, path, "fiscal_quarter", "day", cutoff)
    return plain(t.spark.read.parquet(path), "o_orderkey", "fiscal_quarter", "day")


# ---- schemas that grow -------------------------------------------------------


@query("evolved_table", "I10 A6 A12", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN floor(o_totalprice) WHEN o_orderstatus = 'O' THEN o_totalprice + 0.5 ELSE CAST(o_custkey AS DOUBLE) END AS amount,
  CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS priority, CASE WHEN o_orderstatus = 'P' THEN o_custkey END AS customer, CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS clerk FROM orders""")
def _(t):
    """Three landings: wider numbers, a new column, a record that gets a field, columns in another order and case."""
    path = fresh_folder(t.spark, "grown")
    total = F.col("o_totalprice")
    first = t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", total.cast("int").alias("amount"), F.struct(F.lit(1).alias("n")).alias("origin"))
    second = t.orders.filter("o_orderstatus = 'O'").select(
        F.col("o_orderpriority").alias("priority"), (total + 0.5).alias("AMOUNT"), "o_orderkey", F.struct(F.lit(2).cast("bigint").alias("n"), F.col("o_orderpriority").alias("clerk")).alias("origin"))
    third = t.orders.filter("o_orderstatus = 'P'").select("o_orderkey", F.col("o_custkey").cast("int").alias("amount"), F.col("o_orderpriority").alias("priority"), F.col("o_custkey").alias("customer"))
    for batch in (first, second, third):
        evolving.append(batch, path)
    return plain(evolving.read(t.spark, path).withColumn("clerk", F.col("origin.clerk")), "o_orderkey", "amount", "priority", "customer", "clerk")


def records(t: Catalog):
    """Web events as JSON records whose keys depend on the kind of event."""
    kind = F.col("event_type")
    price = F.when(kind == "purchase", F.col("value").cast("decimal(18,2)"))
    return F.to_json(F.struct(
        F.col("user_id").alias("user"), kind.alias("kind"), price.alias("amount"), F.when(kind == "error", F.col("props")).alias("detail"),
        F.when(kind == "click", F.array((F.col("user_id") % 5).cast("bigint"), F.lit(7).cast("bigint"))).alias("tags"),
        F.when(kind == "signup", F.struct(F.col("event_id").alias("first.seen"), F.struct(F.lit("web").alias("channel-name")).alias("from"))).alias("origin")))


@query("variant_records", "A6 F22 I10", """
SELECT event_id, CAST(user_id AS VARCHAR) AS "user", event_type AS kind, CASE WHEN event_type = 'purchase' THEN CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) END AS amount, CASE WHEN event_type = 'error' THEN props END AS detail, CASE WHEN event_type = 'click' THEN len([user_id % 5, 7]) END AS n_tags FROM events""")
def _(t):
    """Landed once as VARIANT; keys and types come from the same pass, then columns of those types are read."""
    path = fresh_folder(t.spark, "variant")
    kind, _, _ = variants.land_variant(t.events.select("event_id", records(t).alias("j")), "j", path)
    wide = variants.variant_columns(variants.landed(t.spark, path), "record", kind, ["user", "kind"])
    return wide.select("event_id", F.col("user").cast("string").alias("user"), "kind", F.col("amount").cast("double").alias("amount"), "detail", F.size("tags").cast("bigint").alias("n_tags"))


@query("variant_leaves", "A7 A14 F22", """
SELECT event_id, CAST(user_id AS VARCHAR) AS "user", CASE WHEN event_type = 'signup' THEN CAST(event_id AS VARCHAR) END AS origin_first_seen, CASE WHEN event_type = 'signup' THEN 'web' END AS origin_from_channel_name,
  CASE WHEN event_type = 'click' THEN user_id % 5 || ',7' END AS tags FROM events""")
def _(t):
    path = fresh_folder(t.spark, "variant")
    kind, _, _ = variants.land_variant(t.events.select("event_id", records(t).alias("j")), "j", path)
    flat = variants.leaf_columns(variants.landed(t.spark, path), "record", kind)
    return flat.select("event_id", "user", "origin_first_seen", "origin_from_channel_name", F.array_join("tags", ",").alias("tags"))


# ---- loads that count once ---------------------------------------------------


@query("ledger_loads", "A5 I13 A3", """
SELECT o_orderkey, o_orderpriority, CASE o_orderstatus WHEN 'F' THEN 'third' WHEN 'O' THEN 'first' ELSE 'second' END AS load_run FROM orders WHERE o_orderstatus <> 'F' OR o_orderpriority <> '5-LOW'""")
def _(t):
    """Two files, then a third, then the first anew under its old name; one run with nothing to do."""
    landed, target, book = (fresh_folder(t.spark, n) for n in ("drop", "loaded", "ledger"))
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus")
    schema = "o_orderkey bigint, o_orderpriority string, o_orderstatus string"

    def load(run: str) -> int:
        return load_ledger.load_unseen(t.spark, landed, target, book, schema, run, pattern="*.parquet")

    files.place_file(rows.filter("o_orderstatus = 'F'"), landed, "finished.parquet")
    files.place_file(rows.filter("o_orderstatus = 'O'"), landed, "open.parquet")
    load("first")
    files.place_file(rows.filter("o_orderstatus = 'P'"), landed, "pending.parquet")
    load("second")
    files.place_file(rows.filter("o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'"), landed, "finished.parquet")
    load("third")
    load("idle")
    return load_ledger.loaded_rows(t.spark, target, book).select("o_orderkey", "o_orderpriority", "load_run")


@query("streamed_upsert", "I1 I2 I3 A5", """
SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1""")
def _(t):
    """Two landings, in the wrong order of time, merged by key; a batch that dies before its entry is merged again."""
    landed, target, checkpoint = (fresh_folder(t.spark, n) for n in ("landed", "keyed", "progress"))
    rows = t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", F.col("ts").cast("date").alias("day"))

    def catch_up():
        stream = increments.landed_stream(t.spark, landed, rows.schema)
        keyed.upsert_available(stream, target, checkpoint, ["user_id", "day"], "day", "ts", "event_id")

    rows.filter("event_type IN ('purchase', 'error')").write.parquet(landed)
    catch_up()
    rows.filter("event_type NOT IN ('purchase', 'error')").unionByName(rows.filter("event_type = 'error'")).write.mode("append").parquet(landed)
    catch_up()
    keyed.merge_batch(target, rows.filter("event_type = 'error'"), ["user_id", "day"], "day", "ts", "event_id")
    return plain(t.spark.read.parquet(target), "user_id", "day", "event_id", "event_type")


# ---- keys, order, gates ------------------------------------------------------


@query("dictionary_dimension", "K10 F19 U2", """
WITH v AS (SELECT coalesce(nullif(o_orderpriority, '5-LOW'), 'Unknown') AS tier FROM orders UNION SELECT coalesce(c_mktsegment, 'Unknown') FROM customer UNION SELECT coalesce(p_type, 'Unknown') FROM part)
SELECT tier, CAST(('0x' || md5(tier))::UHUGEINT % 10000000 AS BIGINT) AS tier_id, true AS same_next_time FROM v""")
def _(t):
    """Keys of the dictionary are the plain hashes where none clash; a second call gives the same."""
    path = fresh_folder(t.spark, "keys")
    orders = t.orders.select(F.nullif("o_orderpriority", F.lit("5-LOW")).alias("tier"))
    sources = [(orders, "tier"), (t.customer, "c_mktsegment"), (t.part, "p_type")]
    before = key_dictionary.keyed_dimension(t.spark, path, sources, "tier")
    after = key_dictionary.keyed_dimension(t.spark, path, sources, "tier").select(F.col("tier").alias("_tier"), F.col("tier_id").alias("_id"))
    return before.join(after, F.col("tier") == F.col("_tier")).select("tier", "tier_id", (F.col("tier_id") == F.col("_id")).alias("same_next_time"))


@query("small_key_range", "F19 K10", """
SELECT count(DISTINCT c_name) AS names, count(DISTINCT c_name) AS keys, 0 AS changed FROM customer""")
def _(t):
    """Names into a range of keys hardly larger than their number: most clash, all get keys of their own, and keep them."""
    path = fresh_folder(t.spark, "keys")
    room = 4 * t.customer.count() + 64
    small = lambda value: F.pmod(F.xxhash64(value), F.lit(room))
    key_dictionary.add_values(t.spark, path, t.customer.filter("c_custkey % 2 = 0"), "c_name", small)
    before = t.spark.read.schema(key_dictionary.ENTRIES).parquet(path).select(F.col("value").alias("_v"), F.col("key").alias("_k"))
    key_dictionary.add_values(t.spark, path, t.customer, "c_name", small)
    after = key_dictionary.dictionary(t.spark, path)
    changed = F.count(F.when(F.col("_k").isNotNull() & (F.col("_k") != F.col("key")), 1))
    return after.join(before, F.col("value") == F.col("_v"), "left").agg(F.count("value").alias("names"), F.count_distinct("key").alias("keys"), changed.cast("int").alias("changed"))


@query("bucketed_join", "I11 J2 G1", """
SELECT o_orderkey, o_orderpriority, count(*) AS lines, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2""")
def _(t):
    """Both tables stored in buckets of the order: joined and grouped where they lie."""
    heads_path, lines_path = fresh_folder(t.spark, "heads"), fresh_folder(t.spark, "lines")
    name = lambda path: "b_" + path.rsplit("-", 1)[-1]
    buckets = clustered.buckets_for(t.orders, t.lineitem)
    heads = clustered.write_bucketed(t.orders.select("o_orderkey", "o_orderpriority"), name(heads_path), heads_path, ["o_orderkey"], buckets)
    lines = clustered.write_bucketed(t.lineitem.select("l_orderkey", "l_extendedprice"), name(lines_path), lines_path, ["l_orderkey"], buckets)
    joined = heads.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    return plain(joined.groupBy("o_orderkey", "o_orderpriority").agg(F.count(F.lit(1)).alias("lines"), F.sum(money("l_extendedprice")).alias("price")))


@query("interleaved_table", "I11 B13", """
SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day FROM lineitem WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1996-03-31' OR l_partkey BETWEEN 10 AND 40""")
def _(t):
    path = fresh_folder(t.spark, "interleaved")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").cast("date").alias("day"))
    clustered.write_interleaved(rows, path, ["day", "l_partkey"])
    read = t.spark.read.parquet(path)
    return plain(read.filter("day BETWEEN DATE '1996-03-01' AND DATE '1996-03-31' OR l_partkey BETWEEN 10 AND 40"))


@query("published_loads", "Q1 Q2 Q3 Q9 Q9a", """
WITH loads AS (SELECT * FROM (VALUES ('a', 'F'), ('b', 'P'), ('c', 'O')) v(run, state)),
checks AS (SELECT run, 'priority present' AS check_name, count(CASE WHEN o_orderpriority IS NULL THEN 1 END) AS failures, count(*) AS n FROM loads JOIN orders ON o_orderstatus = state GROUP BY 1
  UNION ALL SELECT run, 'not pending', count(CASE WHEN o_orderstatus = 'P' THEN 1 END), count(*) FROM loads JOIN orders ON o_orderstatus = state GROUP BY 1
  UNION ALL SELECT run, 'price in range', count(CASE WHEN o_totalprice NOT BETWEEN 1000 AND 400000 THEN 1 END), count(*) FROM loads JOIN orders ON o_orderstatus = state GROUP BY 1
  UNION ALL SELECT run, 'rows', 0, count(*) FROM loads JOIN orders ON o_orderstatus = state GROUP BY 1)
SELECT run, check_name, CASE WHEN failures = 0 THEN 'pass' WHEN check_name = 'price in range' THEN 'warn' ELSE 'fail' END AS status, failures, n AS "rows", (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') AS visible FROM checks""")
def _(t):
    """Three loads, the second with rows that must not be shown: the log has all checks, readers have the third."""
    path = fresh_folder(t.spark, "gated")
    rules = [
        gated.Rule("priority present", F.col("o_orderpriority").isNotNull()), gated.Rule("not pending", F.col("o_orderstatus") != "P"),
        gated.Rule("price in range", F.col("o_totalprice").between(1000, 400000), warn=True)]
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    for day, (run, state) in enumerate((("a", "F"), ("c", "O"), ("b", "P")), start=1):
        gated.publish(rows.filter(F.col("o_orderstatus") == state), path, rules, run, f"2001-07-0{day} 00:00:00")
    visible = gated.published(t.spark, path).agg(F.count(F.lit(1)).alias("visible")).scalar()
    return gated.run_log(t.spark, path).select("run", "check_name", "status", "failures", "rows", visible.alias("visible"))
