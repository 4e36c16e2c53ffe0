"""Dimensions, data checks, reconciliation, fuzzy match, smoothing."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import fiscal
from tidemark.operators import dimensions, quality, reconcile
from tidemark.operators.conform import union_relations
from tidemark.operators.matching import STOP_WORDS, match_countries
from tidemark.operators.smoothing import smoothed_rate
from tidemark.queries.output import plain
from tidemark.queries.registry import query
from tidemark.queries.roles import SALES_AS_OF, SQL_ACCOUNTS, SQL_NET, accounts, money, net_amount, order_day, sql_label
from tidemark.sources.tables import Catalog


def sql_key(text: str) -> str:
    return f"CAST(('0x' || md5({text}))::UHUGEINT % 10000000 AS BIGINT)"


@query("conformed_dimension", "K10 F19 U2", f"""
WITH v AS (SELECT coalesce(nullif(o_orderpriority, '5-LOW'), 'Unknown') AS tier FROM orders UNION SELECT coalesce(c_mktsegment, 'Unknown') FROM customer UNION SELECT coalesce(p_type, 'Unknown') FROM part),
g AS (SELECT *, CASE WHEN lower(tier) IN ('1-urgent', '2-high') THEN 'Named' WHEN lower(tier) = 'building' THEN 'Territory' ELSE tier END AS tier_group FROM v)
SELECT {sql_key('tier')} AS tier_id, tier, tier_group, {sql_key('tier_group')} AS tier_group_id FROM g""")
def _(t):
    orders = t.orders.select(F.nullif("o_orderpriority", F.lit("5-LOW")).alias("tier"))
    tiers = dimensions.conformed_dimension([(orders, "tier"), (t.customer, "c_mktsegment"), (t.part, "p_type")], "tier")
    low = F.lower("tier")
    group = F.when(low.isin("1-urgent", "2-high"), "Named").when(low == "building", "Territory").otherwise(F.col("tier"))
    return dimensions.with_group(tiers, "tier", group, "tier_group")


@query("standard_country", "K11 J3 B6", """
SELECT c_custkey, n_name AS country, coalesce(CASE WHEN n_regionkey = 3 THEN 'GDPR' END, 'NON-GDPR') AS gdpr_flag FROM customer LEFT JOIN nation ON 'Nation_' || c_nationkey ILIKE n_name AND n_regionkey <> 1""")
def _(t):
    listed = t.nation.filter("n_regionkey <> 1").select(
        F.col("n_name").alias("search"), F.col("n_name").alias("country"), F.when(F.col("n_regionkey") == 3, "GDPR").alias("gdpr_flag"))
    asked = t.customer.select("c_custkey", F.concat(F.lit("Nation_"), F.col("c_nationkey").cast("string")).alias("spelled"))
    return dimensions.standard_country(asked, listed, "spelled", "search", ["country"], "gdpr_flag", "NON-GDPR").select("c_custkey", "country", "gdpr_flag")


@query("fact_with_keys", "K33 A13 F19", f"""
WITH {SQL_ACCOUNTS} SELECT {sql_label('o_orderdate')} AS fiscal_quarter, geo, country, {sql_key('geo')} AS geo_id, {sql_key('country')} AS country_id, count(*) AS orders FROM orders JOIN accounts ON o_custkey = c_custkey GROUP BY ALL""")
def _(t):
    per_account = t.orders.groupBy("o_custkey", fiscal.quarter_label(order_day()).alias("fiscal_quarter")).agg(F.count(F.lit(1)).alias("orders"))
    fact = per_account.join(accounts(t), F.col("o_custkey") == F.col("c_custkey")).groupBy("fiscal_quarter", "geo", "country").agg(F.sum("orders").alias("orders"))
    return dimensions.with_keys(fact, ["geo", "country"])


# ---- checks ----------------------------------------------------------------


def status(name: str, failures: str) -> str:
    return f"SELECT '{name}' AS check_name, CASE WHEN f = 0 THEN 'pass' ELSE 'fail' END AS status, CAST(f AS BIGINT) AS failures FROM (SELECT {failures} AS f"


@query("row_checks", "Q1 Q2 Q3 Q8 Q11", " UNION ALL ".join([
    status("priority present", "count(CASE WHEN o_orderpriority IS NULL THEN 1 END)") + " FROM orders)",
    status("status accepted", "count(CASE WHEN o_orderstatus NOT IN ('O', 'F') THEN 1 END)") + " FROM orders)",
    status("urgent status accepted", "count(CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus NOT IN ('O', 'F') THEN 1 END)") + " FROM orders)",
    status("price in range", "count(CASE WHEN o_totalprice NOT BETWEEN 1000 AND 400000 THEN 1 END)") + " FROM orders)",
    status("open orders are recent", "count(CASE WHEN o_orderstatus = 'O' AND o_orderdate < DATE '1996-01-01' THEN 1 END)") + " FROM orders)",
    status("no slash in priority", "count(CASE WHEN contains(o_orderpriority, '/') THEN 1 END)") + " FROM orders)"]))
def _(t):
    return quality.row_checks(t.orders, {
        "priority present": quality.present("o_orderpriority"), "status accepted": quality.one_of("o_orderstatus", ["O", "F"]),
        "urgent status accepted": quality.one_of("o_orderstatus", ["O", "F"], F.col("o_orderpriority") == "1-URGENT"),
        "price in range": quality.between("o_totalprice", 1000, 400000),
        "open orders are recent": (F.col("o_orderstatus") != "O") | (F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz")),
        "no slash in priority": ~F.contains("o_orderpriority", F.lit("/"))})


@query("table_checks", "Q1 Q4 Q5 Q6 Q7 Q10", " UNION ALL ".join([
    status("order key unique", "count(*)") + " FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1))",
    status("supplier and part unique", "count(*)") + " FROM (SELECT l_suppkey, l_partkey FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1))",
    status("orders not empty", "CASE WHEN count(*) > 0 THEN 0 ELSE 1 END") + " FROM orders)",
    status("orders recent", f"CASE WHEN DATE '{SALES_AS_OF}' - max(CAST(o_orderdate AS DATE)) > 90 THEN 1 ELSE 0 END") + " FROM orders)",
    status("orders loaded today", f"CASE WHEN bool_or(CAST(o_orderdate AS DATE) = DATE '{SALES_AS_OF}') THEN 0 ELSE 1 END") + " FROM orders)",
    status("one status per customer", "count(*)") + " FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderstatus) > 1))",
    status("pending and urgent apart", "count(*)") + " FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' INTERSECT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'))",
    status("orders have customers", "count(*)") + " FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)))"]))
def _(t):
    return quality.suite(
        quality.unique(t.orders, "order key unique", ["o_orderkey"]), quality.unique(t.lineitem, "supplier and part unique", ["l_suppkey", "l_partkey"]),
        quality.not_empty(t.orders, "orders not empty"), quality.recent(t.orders, "orders recent", "o_orderdate", SALES_AS_OF),
        quality.loaded_today(t.orders, "orders loaded today", "o_orderdate", SALES_AS_OF),
        quality.single_value(t.orders, "one status per customer", ["o_custkey"], "o_orderstatus"),
        quality.disjoint(t.orders.filter("o_orderstatus = 'P'"), t.orders.filter("o_orderpriority = '1-URGENT'"), "pending and urgent apart", "o_custkey"),
        quality.related(t.orders, t.customer.filter("c_acctbal > 0"), "orders have customers", "o_custkey", "c_custkey"))


@query("failing_samples_and_log", "Q9 Q9a O3", """
WITH s AS (SELECT '{"s_suppkey":' || s_suppkey || ',"s_name":"' || s_name || '","s_nationkey":' || s_nationkey || '}' AS row_json FROM supplier WHERE s_acctbal < 5000 ORDER BY row_json LIMIT 100)
SELECT 'balance' AS check_name, 'sample' AS kind, row_json AS detail FROM s
UNION ALL SELECT 'balance', 'log', 'supplier/fail/' || count(*) || ' failing/2001-07-15 00:00:00' FROM supplier WHERE s_acctbal < 5000""")
def _(t):
    rule = F.col("s_acctbal") >= 5000
    bad = t.supplier.filter(~rule).select("s_suppkey", "s_name", "s_nationkey")
    samples = quality.failing_rows(bad, "balance", F.lit(False)).select("check_name", F.lit("sample").alias("kind"), F.col("row_json").alias("detail"))
    log = quality.run_log(quality.row_checks(t.supplier, {"balance": rule}), "supplier", "2001-07-15 00:00:00").select(
        "check_name", F.lit("log").alias("kind"), F.concat_ws("/", "model", "status", "message", F.col("run_at").cast("string")).alias("detail"))
    return union_relations(samples, log)


# ---- two sources -----------------------------------------------------------


@query("reconciled_sources", "K44", f"""
WITH a AS (SELECT l_suppkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS price_a, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS quantity_a FROM lineitem GROUP BY 1),
b AS (SELECT l_suppkey, sum(CAST({SQL_NET} AS DECIMAL(18,2))) AS price_b, sum(CAST(l_quantity AS DECIMAL(18,2))) AS quantity_b FROM lineitem WHERE l_returnflag <> 'R' OR l_quantity < 10 GROUP BY 1)
SELECT l_suppkey, round(CAST((coalesce(price_b, 0) - price_a) * 100 AS DOUBLE) / nullif(CAST(price_a AS DOUBLE), 0), 4) AS price_diff_pct, round(CAST((coalesce(quantity_b, 0) - quantity_a) * 100 AS DOUBLE) / nullif(CAST(quantity_a AS DOUBLE), 0), 4) AS quantity_diff_pct,
  CASE WHEN abs(round(CAST((coalesce(price_b, 0) - price_a) * 100 AS DOUBLE) / nullif(CAST(price_a AS DOUBLE), 0), 4)) > 33 THEN 'CHECK' ELSE 'OK' END AS price_flag FROM a LEFT JOIN b USING (l_suppkey)""")
def _(t):
    a = t.lineitem.select("l_suppkey", money("l_extendedprice").alias("price"), money("l_quantity").alias("quantity"))
    b = t.lineitem.filter("l_returnflag <> 'R' OR l_quantity < 10").select(
        "l_suppkey", net_amount().cast("decimal(18,2)").alias("price"), money("l_quantity").alias("quantity"))
    return reconcile.reconcile(a, b, ["l_suppkey"], ["price", "quantity"], 33).select("l_suppkey", "price_diff_pct", "quantity_diff_pct", "price_flag")


@query("both_ways_difference", "U4 K44", """
WITH a AS (SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT'), b AS (SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderpriority = '2-HIGH')
SELECT *, 'dev' AS only_in FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT *, 'prod' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def _(t):
    a = t.orders.filter("o_orderpriority = '1-URGENT'").select("o_custkey", "o_orderstatus")
    b = t.orders.filter("o_orderpriority = '2-HIGH'").select("o_custkey", "o_orderstatus")
    return reconcile.both_ways_difference(a, b, "dev", "prod")


# ---- fuzzy match -----------------------------------------------------------


def country_list(t: Catalog):
    """Nations as countries with a spelled-out name, codes and an official name."""
    k = F.col("n_nationkey")
    syllables = ["bar", "can", "dor", "fen", "gul"]
    part = lambda i, values: F.element_at(F.array(*[F.lit(v) for v in values]), (i % len(values) + 1).cast("int"))
    name = F.concat(part(k, syllables), part(F.floor(k / 5), ["ovia", "istan", "uania", "landia", "ogne"]), F.lit(" "), part(k, ["coast", "hills", "lakes", "plains", "springs"]))
    return t.nation.select(
        F.concat(F.lit("Q"), F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXY"), k + 1, F.lit(1))).alias("alpha_2"),
        F.concat(F.lit("QZ"), F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXY"), k + 1, F.lit(1))).alias("alpha_3"),
        F.initcap(name).alias("name"), F.concat(F.lit("Republic of "), F.initcap(name)).alias("official"), "n_nationkey")


def country_texts(t: Catalog):
    """How customers spell their country, in several ways, or not at all."""
    k = F.col("c_custkey")
    named = t.customer.join(country_list(t), F.col("c_nationkey") == F.col("n_nationkey"))
    n = F.col("name")
    return named.select(
        F.when(k % 9 == 0, F.upper(n)).when(k % 9 == 1, F.concat(F.lit("The "), n, F.lit(", rep."))).when(k % 9 == 2, F.concat(n, F.lit(" (Island)")))
        .when(k % 9 == 3, F.concat(F.substring(n, 1, 4), F.substring(n, 6, 40))).when(k % 9 == 4, F.substring_index(n, " ", 1)).when(k % 9 == 5, F.col("alpha_3"))
        .when(k % 9 == 6, F.concat(F.lit("old "), F.lower(n))).when(k % 9 == 7, F.concat(F.lit("Town "), F.col("c_nationkey").cast("string"))).otherwise(F.col("c_name")).alias("text"))


def towns(t: Catalog):
    return t.nation.join(country_list(t).select("alpha_2", F.col("n_nationkey").alias("nk")), F.col("n_nationkey") == F.col("nk")).select(
        "alpha_2", F.concat(F.lit("Tówn "), F.col("n_nationkey").cast("string"), F.lit(";Plätze")).alias("town"), F.lit("Town").alias("kind"))


SQL_WORDS = "|".join(w.lower() for w in STOP_WORDS)


def sql_clean(text: str) -> str:
    return (f"trim(regexp_replace(regexp_replace(regexp_replace(split_part(lower({text}), ',', 1), '\\(.+?\\)', '', 'g'), "
            f"'[!\"#$%&()*+,\\-./:;<=>?@\\[\\\\\\]^_`{{|}}~]', ' ', 'g'), '\\b({SQL_WORDS})\\b', '', 'g'))")


SQL_COUNTRIES = """listed AS (SELECT 'Q' || substr('ABCDEFGHIJKLMNOPQRSTUVWXY', n_nationkey + 1, 1) AS alpha_2, 'QZ' || substr('ABCDEFGHIJKLMNOPQRSTUVWXY', n_nationkey + 1, 1) AS alpha_3, n_nationkey,
  upper(left(raw, 1)) || substr(raw, 2) || ' ' || upper(left(second, 1)) || substr(second, 2) AS name FROM (SELECT n_nationkey, ['bar', 'can', 'dor', 'fen', 'gul'][n_nationkey % 5 + 1] || ['ovia', 'istan', 'uania', 'landia', 'ogne'][n_nationkey // 5 % 5 + 1] AS raw, ['coast', 'hills', 'lakes', 'plains', 'springs'][n_nationkey % 5 + 1] AS second FROM nation)),
texts AS (SELECT DISTINCT CASE c_custkey % 9 WHEN 0 THEN upper(name) WHEN 1 THEN 'The ' || name || ', rep.' WHEN 2 THEN name || ' (Island)' WHEN 3 THEN left(name, 4) || substr(name, 6) WHEN 4 THEN split_part(name, ' ', 1) WHEN 5 THEN alpha_3
  WHEN 6 THEN 'old ' || lower(name) WHEN 7 THEN 'Town ' || c_nationkey ELSE c_name END AS text FROM customer JOIN listed ON c_nationkey = n_nationkey)"""


@query("fuzzy_country", "K12", f"""
WITH {SQL_COUNTRIES}, q AS (SELECT text, {sql_clean('text')} AS q FROM texts WHERE length(text) > 3),
pairs AS (SELECT text, q, alpha_2, CASE WHEN q IN (lower(alpha_2), lower(alpha_3), lower(name), lower('Republic of ' || name)) THEN 50 ELSE 0 END + CASE WHEN contains(lower(name), q) OR contains(lower('Republic of ' || name), q) THEN 48 ELSE 0 END AS points,
  levenshtein({sql_clean('name')}, q) / CAST(length(q) AS DOUBLE) AS ratio FROM q CROSS JOIN listed WHERE length(q) > 0),
near AS (SELECT text, alpha_2, 45 AS points FROM pairs WHERE ratio < 0.25 QUALIFY row_number() OVER (PARTITION BY text ORDER BY ratio, alpha_2) = 1),
sub AS (SELECT text, alpha_2, 49 AS points FROM q JOIN listed ON q = 'town ' || n_nationkey),
total AS (SELECT text, alpha_2, sum(points) AS score FROM (SELECT text, alpha_2, points FROM pairs WHERE points > 0 UNION ALL SELECT * FROM near UNION ALL SELECT * FROM sub) GROUP BY 1, 2),
best AS (SELECT * FROM total QUALIFY row_number() OVER (PARTITION BY text ORDER BY score DESC, alpha_2) = 1 UNION ALL SELECT text, alpha_2, NULL FROM texts JOIN listed ON upper(text) IN (alpha_2, alpha_3) WHERE length(text) IN (2, 3))
SELECT text, alpha_2 AS matched_code, CAST(score AS BIGINT) AS score FROM texts LEFT JOIN best USING (text)""")
def _(t):
    return plain(match_countries(country_texts(t), "text", country_list(t), "alpha_2", "alpha_3", "name", "official", towns(t), "alpha_2", ("town", "kind")))


@query("smoothed_conversion", "K42", """
WITH b AS (SELECT o_orderpriority AS kind, o_orderstatus AS tier, CAST(o_orderkey % 83 AS BIGINT) AS bin, CAST(sum(CASE WHEN o_totalprice > 200000 THEN 1 ELSE 0 END) AS BIGINT) AS converters, CAST(sum(CASE WHEN o_totalprice > 20000 THEN 1 ELSE 0 END) AS BIGINT) AS accounts FROM orders GROUP BY 1, 2, 3),
r AS (SELECT *, CASE WHEN accounts = 0 THEN 0 ELSE CAST(converters AS DOUBLE) / accounts END AS rate, row_number() OVER (PARTITION BY kind, tier ORDER BY bin) - 1 AS i, count(*) OVER (PARTITION BY kind, tier) AS n FROM b),
k AS (SELECT unnest(generate_series(-40, 40)) AS d),
g AS (SELECT a.kind, a.tier, a.bin, a.converters, a.accounts, a.rate, exp(-0.5 * d * d / 100.0) AS w, s.rate AS other FROM r a CROSS JOIN k JOIN r s ON s.kind = a.kind AND s.tier = a.tier AND s.i = CASE WHEN ((a.i + d) % (2 * a.n) + 2 * a.n) % (2 * a.n) < a.n THEN ((a.i + d) % (2 * a.n) + 2 * a.n) % (2 * a.n) ELSE 2 * a.n - 1 - ((a.i + d) % (2 * a.n) + 2 * a.n) % (2 * a.n) END)
SELECT kind, tier, bin, converters, accounts, rate AS conversion_rate, round(sum(w * other) / sum(w), 9) AS smooth_rate FROM g GROUP BY ALL""")
def _(t):
    bins = t.orders.groupBy(F.col("o_orderpriority").alias("kind"), F.col("o_orderstatus").alias("tier"), (F.col("o_orderkey") % 83).alias("bin")).agg(
        F.sum(F.when(F.col("o_totalprice") > 200000, 1).otherwise(0)).alias("converters"), F.sum(F.when(F.col("o_totalprice") > 20000, 1).otherwise(0)).alias("accounts"))
    return smoothed_rate(bins, ["kind", "tier"], "bin", "converters", "accounts").withColumn("smooth_rate", F.round("smooth_rate", 9))
