"""Leads, contacts, lower and mid funnel, contribution, targets, BI views."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import fiscal, text
from tidemark.operators import joins
from tidemark.operators.attribution import last_touch
from tidemark.operators.dimensions import with_keys
from tidemark.plans import funnel, leads, revenue
from tidemark.queries.output import plain
from tidemark.queries.registry import query
from tidemark.queries.relations import SQL_MERGES, SQL_PHASES, current_accounts, merges, phases
from tidemark.queries.roles import (
    SALES_AS_OF, SQL_ACCOUNTS, SQL_NET, accounts, money, net_amount, order_day, sql_calendar, sql_from,
    sql_index, sql_index_label, sql_label,
)
from tidemark.sources.tables import Catalog

A = f"DATE '{SALES_AS_OF}'"
REASONS = ["error upload", "clean audit", "retired campaign", "aged lead", "not interested", "lead cleanup"]
SQL_REASONS = f"[{', '.join(repr(r) for r in REASONS)}]"


def lead_rows(t: Catalog):
    """Orders as leads: status, closing reason, received, first touch, closed."""
    k = F.col("o_orderkey")
    ships = t.lineitem.groupBy("l_orderkey").agg(
        F.min(F.col("l_shipdate").cast("date")).alias("first_ship"), F.max(F.col("l_shipdate").cast("date")).alias("last_ship"))
    heads = t.orders.select(
        k.alias("lead_id"), "o_custkey", order_day().alias("received"),
        F.when(F.col("o_orderstatus") == "F", "Closed").when(F.col("o_orderstatus") == "P", F.when(k % 2 == 0, "Converted").otherwise("Outreach"))
        .otherwise("New").alias("status"),
        F.when(k % 7 != 0, F.element_at(F.array(*[F.lit(r) for r in REASONS]), (k % 6 + 1).cast("int"))).alias("reason"),
        (k % 50 == 0).alias("deleted"), "o_orderpriority")
    joined = heads.join(ships, F.col("lead_id") == F.col("l_orderkey"), "left").drop("l_orderkey")
    return joined.withColumns({
        "first_touch": F.when(F.col("lead_id") % 4 != 0, F.date_sub("first_ship", 5)),
        "last_activity": F.when(F.col("lead_id") % 3 != 0, F.date_sub("last_ship", 60)),
        "done": F.when(F.col("status").isin("Closed", "Converted"), F.col("last_ship")),
    })


SQL_LEADS = f"""lead_rows AS (SELECT *, CASE WHEN lead_id % 4 <> 0 THEN first_ship - 5 END AS first_touch, CASE WHEN lead_id % 3 <> 0 THEN last_ship - 60 END AS last_activity,
    CASE WHEN status IN ('Closed', 'Converted') THEN last_ship END AS done
  FROM (SELECT o_orderkey AS lead_id, o_custkey, CAST(o_orderdate AS DATE) AS received, CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'P' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'Converted' ELSE 'Outreach' END ELSE 'New' END AS status,
    CASE WHEN o_orderkey % 7 <> 0 THEN {SQL_REASONS}[o_orderkey % 6 + 1] END AS reason, o_orderkey % 50 = 0 AS deleted, o_orderpriority FROM orders)
  LEFT JOIN (SELECT l_orderkey, min(CAST(l_shipdate AS DATE)) AS first_ship, max(CAST(l_shipdate AS DATE)) AS last_ship FROM lineitem GROUP BY 1) ON lead_id = l_orderkey),
statuses(word, class) AS (VALUES ('outreach', 'worked'), ('qualifying', 'worked'), ('qualified', 'worked'), ('converted', 'won'), ('new', 'new'), ('closed', 'closed'), ('close', 'closed')),
reasons(word, kind) AS (VALUES ('error upload', 'upload'), ('error to upload', 'upload'), ('retired campaign', 'retired'), ('lead cleanup', 'cleaning'), ('clean audit', 'cleaning'), ('inactive user', 'inactive'),
  ('aged lead', 'aged'), ('aged leads', 'aged'), ('aging lead', 'aged'), ('expired', 'aged'), ('completed', 'aged')),
judged AS (SELECT l.*, class, coalesce(kind, 'other') AS kind, contains(lower(reason), 'clean') AS cleaned FROM lead_rows l LEFT JOIN statuses s ON lower(status) = s.word LEFT JOIN reasons r ON lower(reason) = r.word),
votes AS (SELECT lead_id, 9 AS place, unnest(['valid', 'touched', 'state', 'completed', 'retired']) AS flag, unnest(['Y', 'N', 'Open', 'N', 'N']) AS vote FROM judged
  UNION ALL SELECT lead_id, 1, unnest(['touched', 'state', 'completed']), unnest(['Y', 'Converted', 'Y']) FROM judged WHERE class = 'won'
  UNION ALL SELECT lead_id, 1, 'touched', CASE class WHEN 'new' THEN 'N' ELSE 'Y' END FROM judged WHERE class IN ('new', 'worked')
  UNION ALL SELECT lead_id, 1, 'state', 'Closed' FROM judged WHERE class = 'closed'
  UNION ALL SELECT lead_id, 2, 'touched', 'Y' FROM judged WHERE class = 'closed' AND NOT cleaned AND kind NOT IN ('upload', 'retired', 'aged')
  UNION ALL SELECT lead_id, 3, 'touched', 'Y' FROM judged WHERE last_activity >= received
  UNION ALL SELECT lead_id, 2, 'completed', 'Y' FROM judged WHERE class = 'closed' AND NOT cleaned AND kind NOT IN ('upload', 'retired', 'cleaning', 'inactive')
  UNION ALL SELECT lead_id, 2, 'retired', 'Y' FROM judged WHERE class = 'closed' AND kind = 'cleaning'
  UNION ALL SELECT lead_id, 1, 'valid', 'N' FROM judged WHERE deleted OR class = 'closed' AND kind = 'upload'),
lead_flags AS (SELECT * FROM lead_rows JOIN (SELECT lead_id, arg_min(vote, place) FILTER (flag = 'valid') AS valid_flag, arg_min(vote, place) FILTER (flag = 'touched') AS touched_flag, arg_min(vote, place) FILTER (flag = 'state') AS state,
  arg_min(vote, place) FILTER (flag = 'completed') AS completed_flag, arg_min(vote, place) FILTER (flag = 'retired') AS retired_flag FROM votes GROUP BY 1) USING (lead_id))"""


def sql_workdays(a, b):
    return f"({b} - {a} - (CAST(date_trunc('week', {b}) AS DATE) - CAST(date_trunc('week', {a}) AS DATE)) // 7 * 2 + CASE WHEN dayofweek({a}) = 0 THEN 1 ELSE 0 END - CASE WHEN dayofweek({b}) = 6 THEN 1 ELSE 0 END)"


def flagged_leads(t: Catalog):
    return leads.lead_flags(lead_rows(t), "status", "reason", "deleted", "received", "last_activity")


@query("lead_flags", "K16", f"WITH {SQL_LEADS} SELECT lead_id, valid_flag, touched_flag, state, completed_flag, retired_flag FROM lead_flags")
def _(t):
    return flagged_leads(t).select("lead_id", "valid_flag", "touched_flag", "state", "completed_flag", "retired_flag")


@query("lead_response_days", "F24 F25 K16", f"""
WITH {SQL_LEADS}, bands(kind, low, high, band) AS (VALUES ('touch', -99999, 2, '< 2 days'), ('touch', 3, 5, '2 to 5 days'), ('touch', 6, 9998, '> 5 days'), ('touch', 9999, 9999, 'UNTOUCHED'), ('touch', 10000, 99999, '> 5 days'),
  ('done', -99999, -1, 'NOT COMPLETE'), ('done', 0, 9, '< 10 days'), ('done', 10, 20, '10 to 20 days'), ('done', 21, 9998, '> 20 days'), ('done', 9999, 9999, 'NOT COMPLETE'), ('done', 10000, 99999, '> 20 days')),
d AS (SELECT lead_id, if(received = first_touch, 0, if(touched_flag = 'N', 9999, if(first_touch > received, {sql_workdays('received', 'first_touch')}, NULL))) AS touch_days,
  if(state = 'Open', 9999, if(done >= received, {sql_workdays('received', 'done')}, NULL)) AS done_days FROM lead_flags)
SELECT lead_id, CAST(touch_days AS BIGINT) AS touch_days, CAST(done_days AS BIGINT) AS done_days, coalesce(x.band, 'N/A') AS touch_band, coalesce(y.band, 'N/A') AS done_band
FROM d LEFT JOIN bands x ON x.kind = 'touch' AND touch_days BETWEEN x.low AND x.high LEFT JOIN bands y ON y.kind = 'done' AND done_days BETWEEN y.low AND y.high""")
def _(t):
    timed = flagged_leads(t).withColumns({
        "touch_days": leads.first_touch_days("touched_flag", "received", "first_touch"),
        "done_days": leads.completion_days("state", "received", "done")})
    return plain(timed.select("lead_id", "touch_days", "done_days", leads.touch_band("touch_days").alias("touch_band"),
                              leads.completion_band("done_days").alias("done_band")))


@query("lead_owner_class", "B10", """
WITH o AS (SELECT o_orderkey, CASE o_orderkey % 9 WHEN 0 THEN 'Lead Partner Reassignment Queue' WHEN 1 THEN 'Opty Admin Queue' ELSE 'Someone' END AS queue,
  CASE o_orderkey % 5 WHEN 0 THEN 'Associate' WHEN 1 THEN 'ISV' END AS pt, CASE o_orderkey % 4 WHEN 0 THEN 'Tele-Vendor' END AS vt, CASE o_orderkey % 6 WHEN 0 THEN 'Distributor' WHEN 1 THEN 'Reseller' END AS ty, CASE WHEN o_orderkey % 7 = 0 THEN 'Northwind Inc' ELSE 'Other' END AS nm,
  CASE o_custkey % 5 WHEN 0 THEN 'Associate' WHEN 1 THEN 'ISV' WHEN 2 THEN 'Distributor' END AS p_pt, CASE o_custkey % 2 WHEN 0 THEN 'Tele-Vendor' END AS p_vt, CASE o_custkey % 6 WHEN 1 THEN 'Master Reseller' END AS p_ty, CASE WHEN o_custkey % 3 = 0 THEN 'Partner' WHEN o_custkey % 11 = 0 THEN 'NORTHWIND' END AS p_nm FROM orders),
rules(place, field, pattern, owner) AS (VALUES (1, 'queue', 'lead partner reassignment queue', 'Partner/reseller'), (13, 'queue', 'opty admin queue', 'Partner/reseller'),
  (2, 'pair', 'associate/tele-vendor', 'Tele Vendor'), (3, 'kind', 'distributor', 'Distributor'), (4, 'name', '%northwind%', 'Northwind'), (5, 'kind', 'reseller', 'Partner/reseller'), (5, 'kind', 'master reseller', 'Partner/reseller'), (6, 'partner', 'isv', 'Partner/ISV'),
  (7, 'up pair', 'associate/tele-vendor', 'Tele Vendor'), (8, 'up kind', 'distributor', 'Distributor'), (9, 'up name', '%northwind%', 'Northwind'), (10, 'up kind', 'reseller', 'Partner/reseller'), (10, 'up kind', 'master reseller', 'Partner/reseller'), (11, 'up partner', 'isv', 'Partner/ISV'), (12, 'up name', '%', 'Partner/reseller')),
said AS (SELECT o_orderkey, unnest(['queue', 'pair', 'kind', 'kind', 'name', 'partner', 'up pair', 'up kind', 'up kind', 'up name', 'up partner']) AS field,
  lower(unnest([queue, pt || '/' || vt, ty, pt, nm, pt, p_pt || '/' || p_vt, p_ty, p_pt, p_nm, p_pt])) AS value FROM o)
SELECT o_orderkey, coalesce(arg_min(owner, place), 'Northwind') AS owner_class FROM said LEFT JOIN rules ON said.field = rules.field AND value LIKE pattern GROUP BY 1""")
def _(t):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    rows = t.orders.select(
        k, F.when(k % 9 == 0, "Lead Partner Reassignment Queue").when(k % 9 == 1, "Opty Admin Queue").otherwise("Someone").alias("queue"),
        F.when(k % 5 == 0, "Associate").when(k % 5 == 1, "ISV").alias("pt"), F.when(k % 4 == 0, "Tele-Vendor").alias("vt"),
        F.when(k % 6 == 0, "Distributor").when(k % 6 == 1, "Reseller").alias("ty"), F.when(k % 7 == 0, "Northwind Inc").otherwise("Other").alias("nm"),
        F.when(c % 5 == 0, "Associate").when(c % 5 == 1, "ISV").when(c % 5 == 2, "Distributor").alias("p_pt"), F.when(c % 2 == 0, "Tele-Vendor").alias("p_vt"),
        F.when(c % 6 == 1, "Master Reseller").alias("p_ty"), F.when(c % 3 == 0, "Partner").when(c % 11 == 0, "NORTHWIND").alias("p_nm"))
    names = lambda p: {"partner_type": f"{p}pt", "vendor_type": f"{p}vt", "type": f"{p}ty", "name": f"{p}nm"}
    return rows.select("o_orderkey", leads.owner_class("Northwind", "queue", names(""), names("p_")).alias("owner_class"))


@query("lead_geography", "K17 J3", f"""
WITH {SQL_ACCOUNTS}, l AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'us' WHEN 1 THEN lower(country) WHEN 2 THEN 'nowhere' WHEN 3 THEN country END AS spelled, CASE WHEN o_orderkey % 3 <> 0 THEN upper(country) END AS account_country,
  CASE o_orderkey % 4 WHEN 0 THEN 'Americas' WHEN 1 THEN 'emea' WHEN 2 THEN 'mars' END AS lead_geo_text,
  CASE o_orderkey % 11 WHEN 0 THEN 'apac' WHEN 1 THEN 'venus' END AS owner_geo_text, CASE o_orderkey % 13 WHEN 2 THEN lower(country) WHEN 3 THEN 'atlantis' END AS owner_country, geo AS account_geo FROM orders JOIN accounts ON o_custkey = c_custkey),
c AS (SELECT n_name AS country, r_name AS geo FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT 'United States', 'AMER'),
f AS (SELECT *, CASE WHEN spelled = 'us' THEN 'United States' WHEN lower(spelled) IN (SELECT lower(country) FROM c) THEN spelled WHEN lower(account_country) IN (SELECT lower(country) FROM c) THEN account_country END AS lead_country FROM l)
SELECT o_orderkey, lead_country, c.country, c.geo AS mapped_geo, coalesce(c.geo, g.geo, og.geo, oc.geo, account_geo) AS geo
FROM f LEFT JOIN c ON lower(f.lead_country) = lower(c.country) LEFT JOIN c oc ON lower(owner_country) = lower(oc.country)
LEFT JOIN (VALUES ('americas', 'AMER'), ('amer', 'AMER'), ('emea', 'EMEA'), ('apac', 'APAC'), ('japan', 'JAPAN')) g(word, geo) ON lower(lead_geo_text) = g.word
LEFT JOIN (VALUES ('americas', 'AMER'), ('amer', 'AMER'), ('emea', 'EMEA'), ('apac', 'APAC'), ('japan', 'JAPAN')) og(word, geo) ON lower(owner_geo_text) = og.word""")
def _(t):
    k = F.col("o_orderkey")
    known = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("search_code"), F.col("n_name").alias("country"), F.col("r_name").alias("geo"))
    listed = known.unionByName(t.spark.createDataFrame([("united states", "United States", "AMER")], known.schema))
    rows = t.orders.select(k, "o_custkey").join(accounts(t), F.col("o_custkey") == F.col("c_custkey")).select(
        k, F.when(k % 5 == 0, "us").when(k % 5 == 1, F.lower("country")).when(k % 5 == 2, "nowhere").when(k % 5 == 3, F.col("country")).alias("spelled"),
        F.when(k % 3 != 0, F.upper("country")).alias("account_country"),
        F.when(k % 4 == 0, "Americas").when(k % 4 == 1, "emea").when(k % 4 == 2, "mars").alias("lead_geo_text"),
        F.when(k % 11 == 0, "apac").when(k % 11 == 1, "venus").alias("owner_geo_text"),
        F.when(k % 13 == 2, F.lower("country")).when(k % 13 == 3, "atlantis").alias("owner_country"), F.col("geo").alias("account_geo"))
    found = leads.country_chain(rows, listed, "spelled", "account_country", {"us": "United States"})
    placed = leads.lead_geo(found, listed, "lead_geo_text", "owner_geo_text", "owner_country", "account_geo")
    return placed.select("o_orderkey", "lead_country", "country", "mapped_geo", "geo")


@query("leads_created", "K19 U2 J2", f"""
WITH {SQL_LEADS}, {sql_calendar(SALES_AS_OF, '1995-01-01')}, both_streams AS (
  SELECT lead_id, received, o_orderpriority AS tier, true AS is_delivered FROM lead_flags WHERE valid_flag = 'Y' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
  UNION SELECT lead_id, received, o_orderpriority, false FROM lead_flags WHERE state = 'Open' AND o_orderpriority = '5-LOW')
SELECT lead_id, tier, is_delivered, CAST(received AS VARCHAR) AS received, {sql_index_label('qi')} AS fiscal_quarter, fiscal_week, {sql_index_label('(qi - 1)')} AS previous_quarter, CAST(qi = {sql_index(A)} AS BIGINT) AS is_current_quarter
FROM both_streams JOIN calendar ON received = date_key WHERE {sql_from('received', SALES_AS_OF)} >= -6""")
def _(t):
    flagged = flagged_leads(t).withColumnRenamed("o_orderpriority", "tier")
    return plain(leads.leads_created(
        flagged.filter("valid_flag = 'Y' AND tier IN ('1-URGENT', '2-HIGH')"), flagged.filter("state = 'Open' AND tier = '5-LOW'"),
        ["lead_id", "received", "tier"], "received", SALES_AS_OF),
        "lead_id", "tier", "is_delivered", "received", "fiscal_quarter", "fiscal_week", "previous_quarter", "is_current_quarter")


@query("new_contacts", "K20 B7", f"""
WITH {SQL_ACCOUNTS}, c AS (SELECT geo, lower(c_mktsegment) AS segment, CASE WHEN c_custkey % 4 = 0 THEN 'SOLUTION_BUYER' WHEN c_custkey % 6 = 1 THEN 'EXECUTIVE' WHEN c_custkey % 5 = 2 THEN 'END_USER' END AS persona,
  CASE WHEN c_acctbal < 5000 THEN 'TRUE' ELSE 'FALSE' END AS expansion, CASE WHEN c_custkey % 3 = 0 THEN 'TRUE' WHEN c_custkey % 3 = 1 THEN 'FALSE' END AS reportable, coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_name END, CASE WHEN c_custkey % 7 <> 0 THEN 'M' || c_custkey END) AS id FROM accounts)
SELECT geo, CASE WHEN segment <> 'furniture' THEN segment END AS segment, persona, expansion, count(CASE WHEN reportable = 'TRUE' THEN id END) AS marketable, count(CASE WHEN reportable = 'FALSE' THEN id END) AS not_marketable, count(id) AS contacts
FROM c GROUP BY ALL""")
def _(t):
    k = F.col("c_custkey")
    flag = lambda c: F.when(c, "TRUE").otherwise("FALSE")
    rows = accounts(t).select(
        "geo", text.null_if_any(F.lower("c_mktsegment"), ["FURNITURE"], ignore_case=True).alias("segment"),
        flag(k % 4 == 0).alias("buyer"), flag(k % 6 == 1).alias("executive"), flag(k % 5 == 2).alias("user"),
        flag(F.col("c_acctbal") < 5000).alias("expansion"), F.when(k % 3 == 0, "TRUE").when(k % 3 == 1, "FALSE").alias("reportable"),
        F.when(k % 2 == 0, F.col("c_name")).alias("sfdc_id"), F.when(k % 7 != 0, F.concat(F.lit("M"), k.cast("string"))).alias("other_id"))
    labelled = rows.withColumn("persona", leads.persona([("buyer", "SOLUTION_BUYER"), ("executive", "EXECUTIVE"), ("user", "END_USER")]))
    return leads.contact_counts(labelled, ["geo", "segment", "persona", "expansion"], "reportable", ["sfdc_id", "other_id"])


@query("cleaned_contacts", "K43", """
WITH c AS (SELECT c_custkey AS account_id, CASE c_custkey % 3 WHEN 0 THEN 'Active' ELSE 'Gone' END AS status, CASE WHEN c_custkey % 4 = 0 THEN 'Change in Email' END AS email_check, CASE WHEN c_custkey % 5 = 0 THEN 'Different Domain' END AS domain_check,
  lower(c_name) || '@A.com' AS email, CASE WHEN c_custkey % 6 = 0 THEN upper(c_name) || '@a.COM' ELSE c_name || '@b.com' END AS email_new, CASE WHEN c_custkey % 2 = 0 THEN 'p' || c_custkey END AS phone_new, 'c' || c_nationkey AS company_phone,
  CASE WHEN c_custkey % 9 = 0 THEN c_mktsegment END AS interest, CASE WHEN c_custkey % 2 = 1 THEN 'Street 1' END AS address_1, 'Town ' || c_nationkey AS address_2, CASE WHEN c_custkey % 7 <> 0 THEN n_name END AS country_new, 'NATION_1' AS country FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT DISTINCT account_id, lower(coalesce(email_new, email)) AS email, coalesce(phone_new, company_phone) AS phone, coalesce(interest, 'Dummy Product') AS interest, concat_ws(' ', address_1, address_2) AS address,
  CASE WHEN contains(coalesce(country_new, country), 'NATION_2') THEN 'N2' WHEN contains(coalesce(country_new, country), 'NATION_1') THEN 'N1' ELSE 'No Match' END AS iso_code, 'DataEnrichment' AS source_system
FROM c WHERE status = 'Active' AND ((email_check = 'Change in Email' AND domain_check IS NULL) OR (email_check IS NULL AND lower(email) <> lower(email_new)))""")
def _(t):
    k = F.col("c_custkey")
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        k.alias("account_id"), F.when(k % 3 == 0, "Active").otherwise("Gone").alias("status"), F.when(k % 4 == 0, "Change in Email").alias("email_check"),
        F.when(k % 5 == 0, "Different Domain").alias("domain_check"), F.concat(F.lower("c_name"), F.lit("@A.com")).alias("email"),
        F.when(k % 6 == 0, F.concat(F.upper("c_name"), F.lit("@a.COM"))).otherwise(F.concat("c_name", F.lit("@b.com"))).alias("email_new"),
        F.when(k % 2 == 0, F.concat(F.lit("p"), k.cast("string"))).alias("phone_new"), F.concat(F.lit("c"), F.col("c_nationkey").cast("string")).alias("company_phone"),
        F.when(k % 9 == 0, F.col("c_mktsegment")).alias("interest"), F.when(k % 2 == 1, "Street 1").alias("address_1"),
        F.concat(F.lit("Town "), F.col("c_nationkey").cast("string")).alias("address_2"), F.when(k % 7 != 0, F.col("n_name")).alias("country_new"), F.lit("NATION_1").alias("country"))
    return leads.cleaned_contacts(rows, "Active", {"NATION_2": "N2", "NATION_1": "N1"})


@query("revenue_stage", "K26 U1 J18 J19", f"""
WITH {SQL_MERGES}, src AS (
  SELECT 'Integrated' AS source, o_orderkey AS order_no, o_orderkey + 7 AS po_no, o_custkey, CAST(o_totalprice AS DECIMAL(24,4)) AS amount, o_orderstatus AS status FROM orders WHERE o_orderpriority <> '5-LOW'
  UNION ALL SELECT 'Core', CASE WHEN l_orderkey % 3 <> 0 THEN l_orderkey END, l_orderkey + 3, l_suppkey, {SQL_NET}, NULL FROM lineitem WHERE l_linenumber = 1
  UNION ALL SELECT 'Unintegrated', NULL, NULL, NULL, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(24,4)), NULL FROM orders WHERE o_orderpriority = '5-LOW' GROUP BY {sql_label('o_orderdate')}),
touch AS (SELECT l_orderkey, l_suppkey, CASE l_returnflag WHEN 'R' THEN 'Organic Search' WHEN 'A' THEN 'email' ELSE 'Referral' END AS channel FROM lineitem WHERE l_quantity > 20
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_suppkey DESC, channel DESC) = 1),
att AS (SELECT src.*, coalesce(a.l_suppkey, b.l_suppkey) AS tactic, coalesce(a.channel, b.channel) AS channel FROM src LEFT JOIN touch a ON order_no = a.l_orderkey LEFT JOIN touch b ON po_no = b.l_orderkey),
fam AS (SELECT att.*, coalesce(survivor, o_custkey) AS survivor_id FROM att LEFT JOIN (SELECT * FROM merges WHERE status = 'COMPLETED') m ON o_custkey = victim)
SELECT source, order_no, po_no, CAST(amount AS DOUBLE) AS amount, fam.status, tactic, channel, coalesce(merges.survivor, parent, survivor_id) AS final_id,
  CASE WHEN upper(channel) LIKE '%ORGANIC%' OR upper(channel) IN ('DIRECT', 'INTERNAL') THEN 'Organic' WHEN upper(channel) LIKE '%PAID%' OR upper(channel) IN ('DISPLAY', 'AFFILIATES', 'EMAIL', 'VIDEO', 'IPM', 'ITM') THEN 'Paid' ELSE 'Other' END AS channel_type
FROM fam LEFT JOIN current_accounts ON survivor_id = account LEFT JOIN merges ON parent = victim""")
def _(t):
    amount = lambda c: c.cast("decimal(24,4)").alias("amount")
    integrated = t.orders.filter("o_orderpriority <> '5-LOW'").select(
        F.lit("Integrated").alias("source"), F.col("o_orderkey").alias("order_no"), (F.col("o_orderkey") + 7).alias("po_no"), "o_custkey",
        amount(F.col("o_totalprice")), F.col("o_orderstatus").alias("order_status"))
    core = t.lineitem.filter("l_linenumber = 1").select(
        F.lit("Core").alias("source"), F.when(F.col("l_orderkey") % 3 != 0, F.col("l_orderkey")).alias("order_no"),
        (F.col("l_orderkey") + 3).alias("po_no"), F.col("l_suppkey").alias("o_custkey"), amount(net_amount()))
    weekly = t.orders.filter("o_orderpriority = '5-LOW'").groupBy(fiscal.quarter_label(order_day()).alias("q")).agg(
        amount(F.sum(money("o_totalprice")))).select(F.lit("Unintegrated").alias("source"), "amount")
    flag = F.col("l_returnflag")
    stack = t.lineitem.filter("l_quantity > 20").select("l_orderkey", F.col("l_suppkey").alias("tactic"), "l_shipdate",
        F.when(flag == "R", "Organic Search").when(flag == "A", "email").otherwise("Referral").alias("channel"))
    touches = last_touch(stack, "l_orderkey", "l_shipdate", ["tactic", "channel"])
    staged = funnel.revenue_stage([integrated, core, weekly], touches, "l_orderkey", ("order_no", "po_no"), ["tactic", "channel"],
                                  "o_custkey", merges(t), current_accounts(t))
    return plain(staged.withColumnRenamed("order_status", "status"),
                 "source", "order_no", "po_no", "amount", "status", "tactic", "channel", "final_id", "channel_type")


@query("currency_validity", "W9 K28", """
WITH changes AS (SELECT 'C' || s_nationkey AS code, 1 + s_suppkey % 9 AS rate, min(TIMESTAMP '2000-01-01' + s_suppkey * INTERVAL 1 DAY) AS since FROM supplier GROUP BY 1, 2),
ranged AS (SELECT code, rate, since, lead(since) OVER (PARTITION BY code ORDER BY since, rate) AS until, row_number() OVER (PARTITION BY code ORDER BY since, rate) AS n FROM changes)
SELECT code, CAST(rate AS BIGINT) AS rate, CAST(CAST(CASE WHEN n = 1 THEN TIMESTAMP '1990-01-01' ELSE since END AS DATE) AS VARCHAR) AS valid_from, CAST(CAST(until AS DATE) AS VARCHAR) AS valid_to FROM ranged""")
def _(t):
    changes = rate_changes(t).groupBy("code", "rate").agg(F.min("since").alias("since"))
    ranged = joins.validity_intervals(changes, "code", "since", "rate")
    return ranged.select("code", "rate", F.col("valid_from").cast("date").cast("string").alias("valid_from"),
                         F.col("valid_to").cast("date").cast("string").alias("valid_to"))


def rate_changes(t: Catalog):
    start = F.lit("2000-01-01").cast("date")
    return t.supplier.select(
        F.concat(F.lit("C"), F.col("s_nationkey").cast("string")).alias("code"), (F.col("s_suppkey") % 9 + 1).alias("rate"),
        F.date_add(start, F.col("s_suppkey").cast("int")).cast("timestamp_ntz").alias("since"))


@query("lower_funnel", "K28 J11 F26 U3", f"""
WITH {SQL_PHASES}, changes AS (SELECT 'C' || s_nationkey AS code, 1 + s_suppkey % 9 AS rate, min(TIMESTAMP '2000-01-01' + s_suppkey * INTERVAL 1 DAY) AS since FROM supplier GROUP BY 1, 2),
rates AS (SELECT code, rate FROM changes QUALIFY lead(since) OVER (PARTITION BY code ORDER BY since, rate) IS NULL),
oppo AS (SELECT o_orderkey AS opportunity, CASE WHEN o_custkey % 8 <> 0 THEN o_custkey END AS account, CASE o_orderstatus WHEN 'O' THEN 'Stage 3' WHEN 'F' THEN 'Closed/Lost' WHEN 'P' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'Won' ELSE 'Dormant' END END AS stage, CASE o_orderkey % 4 WHEN 0 THEN 'Expired' WHEN 1 THEN 'Quoted' WHEN 2 THEN 'Ordered' ELSE 'Parked' END AS quote_status, 'C' || o_custkey % 30 AS currency FROM orders),
lines AS (SELECT l_orderkey AS opportunity, l_linenumber AS line, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, CASE l_linenumber WHEN 1 THEN 'A02' WHEN 2 THEN 'A07' ELSE 'X' END AS term FROM lineitem),
q AS (SELECT opportunity, CASE WHEN opportunity % 5 <> 0 THEN opportunity END AS quote, line, CAST(amount AS DOUBLE) / coalesce(rate, 1) AS converted, CAST(amount AS DOUBLE) / coalesce(rate, 1) * CASE term WHEN 'A07' THEN 365.0 WHEN 'A02' THEN 12.0 ELSE CAST(1 AS DOUBLE) END AS yearly
  FROM lines JOIN oppo USING (opportunity) LEFT JOIN rates ON currency = code WHERE amount > 30000),
u AS (SELECT 'QUOTE' AS record_source, q.*, stage, quote_status, account FROM q LEFT JOIN oppo USING (opportunity)
  UNION ALL SELECT 'OPPORTUNITY', o.opportunity, NULL, l.line, NULL, NULL, stage, quote_status, account FROM oppo o LEFT JOIN lines l USING (opportunity) WHERE o.opportunity NOT IN (SELECT opportunity FROM q)),
fin AS (SELECT l_orderkey + 1 AS quote, l_linenumber AS line, CAST({SQL_NET} AS DOUBLE) AS billed, CASE WHEN l_suppkey % 2 = 0 THEN l_suppkey END AS account FROM lineitem WHERE l_linestatus = 'F'),
meaning(word, state) AS (VALUES ('Expired', 'Not Active'), ('Quoted', 'Open'), ('Ordered', 'Closed'), ('Stage 3', 'Open'), ('Closed/Lost', 'Not Active'), ('Won', 'Closed')),
fact AS (SELECT record_source, opportunity, coalesce(u.quote, fin.quote) AS quote, CAST(coalesce(u.line, fin.line) AS BIGINT) AS line, converted, yearly, stage, coalesce(p.state, stage) AS pipeline, coalesce(q.state, quote_status) AS quote_state, billed,
  coalesce(fin.account, u.account) AS account FROM u FULL JOIN fin ON u.quote = fin.quote AND u.line = fin.line LEFT JOIN meaning p ON stage = p.word LEFT JOIN meaning q ON quote_status = q.word),
now AS (SELECT parent_id, phase FROM phases WHERE phase_end = DATE '9999-12-31')
SELECT fact.* EXCLUDE (account), coalesce(account, parent_id) AS account, phase FROM fact FULL JOIN now ON account = parent_id""")
def _(t):
    k = F.col("o_orderkey")
    opportunities = t.orders.select(
        k.alias("opportunity"), F.when(F.col("o_custkey") % 8 != 0, F.col("o_custkey")).alias("account"),
        F.when(F.col("o_orderstatus") == "O", "Stage 3").when(F.col("o_orderstatus") == "F", "Closed/Lost")
        .when(F.col("o_orderstatus") == "P", F.when(k % 2 == 0, "Won").otherwise("Dormant")).alias("stage"),
        F.when(k % 4 == 0, "Expired").when(k % 4 == 1, "Quoted").when(k % 4 == 2, "Ordered").otherwise("Parked").alias("quote_status"))
    currency = t.orders.select(k.alias("opportunity"), F.concat(F.lit("C"), (F.col("o_custkey") % 30).cast("string")).alias("currency"))
    n = F.col("l_linenumber")
    lines = t.lineitem.select(F.col("l_orderkey").alias("opportunity"), n.alias("line"), money("l_extendedprice").alias("amount"),
                              F.when(n == 1, "A02").when(n == 2, "A07").otherwise("X").alias("term"))
    rates = funnel.current_rates(rate_changes(t), "code", "rate", "since")
    quoted = funnel.converted_lines(lines.filter("amount > 30000").join(currency, "opportunity"), rates, "currency", "amount", "term").select(
        "opportunity", F.when(F.col("opportunity") % 5 != 0, F.col("opportunity")).alias("quote"), "line", "converted", "yearly")
    finance = t.lineitem.filter("l_linestatus = 'F'").select(
        (F.col("l_orderkey") + 1).alias("quote"), n.alias("line"), net_amount().cast("double").alias("billed"),
        F.when(F.col("l_suppkey") % 2 == 0, F.col("l_suppkey")).alias("billed_account"))
    own_lines = lines.select("opportunity", F.lit(None).cast("bigint").alias("quote"), "line")
    fact = funnel.lower_funnel(opportunities, quoted, own_lines, finance, "opportunity", "quote", "line").withColumns({
        "quote_state": funnel.quote_state("quote_status"), "pipeline": funnel.pipeline_state("stage"),
        "account": F.coalesce("billed_account", "account")}).drop("billed_account")
    now = phases(t).filter("phase_end = '9999-12-31'").select(F.col("parent_id").alias("account"), "phase")
    return plain(funnel.with_customers(fact, now, "account"), "record_source", "opportunity", "quote", "line", "converted", "yearly", "stage",
                 "pipeline", "quote_state", "billed", "account", "phase")


@query("mid_funnel", "K29 J11 F21", """
WITH contacts AS (SELECT CASE WHEN c_custkey % 6 <> 0 THEN c_custkey END AS contact, c_mktsegment, c_custkey % 200 AS user_id FROM customer WHERE c_acctbal > 1000),
leads AS (SELECT o_custkey AS contact, count(*) AS leads FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
people AS (SELECT coalesce(c.contact, l.contact) AS contact, c_mktsegment, user_id, leads FROM contacts c FULL JOIN leads l ON c.contact = l.contact),
trials AS (SELECT user_id, count(*) AS trials FROM events WHERE event_type = 'signup' AND value > 60 GROUP BY 1),
ids AS (SELECT s_suppkey AS stack_id, CAST(x AS VARCHAR) AS uid FROM (SELECT s_suppkey, unnest([s_suppkey, s_suppkey + 100]) AS x FROM supplier)),
one AS (SELECT uid, min(stack_id) AS stack_id FROM ids GROUP BY 1)
SELECT contact, c_mktsegment, coalesce(p.user_id, t.user_id) AS user_id, leads, trials, stack_id FROM people p FULL JOIN trials t ON p.user_id = t.user_id LEFT JOIN one ON CAST(coalesce(p.user_id, t.user_id) AS VARCHAR) = uid""")
def _(t):
    contacts = t.customer.filter("c_acctbal > 1000").select(
        F.when(F.col("c_custkey") % 6 != 0, F.col("c_custkey")).alias("contact"), "c_mktsegment", (F.col("c_custkey") % 200).alias("user_id"))
    created = t.orders.filter("o_orderpriority = '1-URGENT'").groupBy(F.col("o_custkey").alias("contact")).agg(F.count(F.lit(1)).alias("leads"))
    tried = t.events.filter("event_type = 'signup' AND value > 60").groupBy("user_id").agg(F.count(F.lit(1)).alias("trials"))
    quoted = lambda c: F.concat(F.lit('"'), c.cast("string"), F.lit('"'))
    s = F.col("s_suppkey")
    stack = t.supplier.select(s.alias("stack_id"), F.array(quoted(s), quoted(s + 100)).alias("ids"))
    return funnel.mid_funnel(contacts, created, tried, stack, "contact", "user_id", "ids").select(
        "contact", "c_mktsegment", "user_id", "leads", "trials", "stack_id")


@query("marketing_funnel", "K30 J8 J11", f"""
WITH {SQL_PHASES}, late AS (SELECT * FROM phases WHERE phase = '5-LOW'),
mid AS (SELECT o_orderkey AS opportunity, o_orderpriority AS lead_type, o_custkey AS mid_account FROM orders WHERE o_orderstatus = 'O'),
low AS (SELECT l_orderkey AS opportunity, count(*) AS lines, min(CAST(l_shipdate AS DATE)) AS first_date, max(CAST(l_shipdate AS DATE)) AS last_date FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1),
f AS (SELECT coalesce(m.opportunity, l.opportunity) AS opportunity, lead_type, coalesce(mid_account, 0) AS account, lines, first_date, last_date FROM mid m FULL JOIN low l ON m.opportunity = l.opportunity)
SELECT opportunity, lead_type, lines, parent_id, CAST(phase_start AS VARCHAR) AS phase_start FROM f FULL JOIN late ON account = parent_id AND (first_date BETWEEN phase_start AND phase_end OR last_date BETWEEN phase_start AND phase_end)""")
def _(t):
    mid = t.orders.filter("o_orderstatus = 'O'").select(
        F.col("o_orderkey").alias("opportunity"), F.col("o_orderpriority").alias("lead_type"), F.col("o_custkey").alias("mid_account"))
    shipped = F.col("l_shipdate").cast("date")
    low = t.lineitem.filter("l_returnflag = 'A'").groupBy(F.col("l_orderkey").alias("opportunity")).agg(
        F.count(F.lit(1)).alias("lines"), F.min(shipped).alias("first_date"), F.max(shipped).alias("last_date"))
    both = joins.full_outer(mid, low, ["opportunity"]).withColumn("account", F.coalesce("mid_account", F.lit(0)))
    late = phases(t).filter("phase = '5-LOW'").withColumn("phase_id", F.concat_ws("|", "parent_id", "phase_start"))
    fact = joins.full_interval_join(both, late, {"account": "parent_id"}, ["first_date", "last_date"], "opportunity", "phase_id",
                                    "phase_start", "phase_end")
    return plain(fact, "opportunity", "lead_type", "lines", "parent_id", "phase_start")


@query("marketing_contribution", "K31 G13 G5", f"""
WITH offers AS (SELECT l_orderkey, list(DISTINCT p_type) AS types FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1),
deals AS (SELECT {sql_label('o_orderdate')} AS fiscal_quarter, CASE WHEN o_custkey % 4 <> 0 THEN 'T' || o_custkey % 3 ELSE 'Named Account Global' END AS tier, CAST(o_totalprice AS DECIMAL(18,2)) AS acv, types,
  CASE o_orderkey % 3 WHEN 0 THEN 'MS' WHEN 1 THEN 'MI' END AS ct, CASE o_orderkey % 5 WHEN 0 THEN 'MS' END AS hist, CASE o_orderkey % 2 WHEN 0 THEN 'New' ELSE 'Renew' END AS ty, CASE o_orderstatus WHEN 'F' THEN 'CLOSED/WON' ELSE 'OPEN' END AS stage,
  CASE o_orderkey % 7 WHEN 0 THEN 'Partner' ELSE 'Own Opportunity' END AS rec, CASE o_orderpriority WHEN '1-URGENT' THEN 'Net New' WHEN '2-HIGH' THEN 'New Again' ELSE 'Retained' END AS phase FROM orders LEFT JOIN offers ON o_orderkey = l_orderkey),
m AS (SELECT fiscal_quarter, tier, sum(CASE WHEN ct IS NOT NULL AND ty = 'Renew' AND stage = 'CLOSED/WON' THEN acv END) AS contributed_renewal, sum(CASE WHEN ct IS NOT NULL AND ty = 'New' AND stage = 'CLOSED/WON' THEN acv END) AS contributed_new,
  sum(CASE WHEN ct = 'MS' AND ty = 'New' AND rec = 'Own Opportunity' AND stage = 'CLOSED/WON' THEN acv END) AS sourced_new, sum(CASE WHEN ct = 'MS' AND ty = 'New' AND rec = 'Own Opportunity' AND phase IN ('Net New', 'New Again') AND stage = 'CLOSED/WON' THEN acv END) AS sourced_new_customer,
  sum(CASE WHEN rec = 'Own Opportunity' AND tier = 'Named Account Global' AND ct = 'MS' THEN acv WHEN rec = 'Own Opportunity' AND coalesce(tier, '') <> 'Named Account Global' AND hist = 'MS' THEN acv ELSE 0 END) AS sourced_created, list_sort(list_distinct(flatten(list(types)))) AS offers FROM deals GROUP BY 1, 2)
SELECT fiscal_quarter, tier, CAST(contributed_renewal AS DOUBLE) AS contributed_renewal, CAST(contributed_new AS DOUBLE) AS contributed_new, CAST(sourced_new AS DOUBLE) AS sourced_new, CAST(sourced_new_customer AS DOUBLE) AS sourced_new_customer, CAST(sourced_created AS DOUBLE) AS sourced_created, array_to_string(offers, ',') AS offers
FROM m WHERE NOT (contributed_renewal = 0 AND contributed_new = 0 AND sourced_new = 0 AND sourced_new_customer = 0 AND sourced_created = 0)""")
def _(t):
    types = t.lineitem.select("l_orderkey", "l_partkey").join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    offers = types.groupBy("l_orderkey").agg(F.collect_set("p_type").alias("types"))
    k = F.col("o_orderkey")
    deals = t.orders.join(offers, k == F.col("l_orderkey"), "left").select(
        fiscal.quarter_label(order_day()).alias("fiscal_quarter"),
        F.when(F.col("o_custkey") % 4 != 0, F.concat(F.lit("T"), (F.col("o_custkey") % 3).cast("string"))).otherwise("Named Account Global").alias("tier"),
        money("o_totalprice").alias("acv"), "types", F.when(k % 3 == 0, "MS").when(k % 3 == 1, "MI").alias("ct"), F.when(k % 5 == 0, "MS").alias("hist"),
        F.when(k % 2 == 0, "New").otherwise("Renew").alias("ty"), F.when(F.col("o_orderstatus") == "F", "CLOSED/WON").otherwise("OPEN").alias("stage"),
        F.when(k % 7 == 0, "Partner").otherwise("Own Opportunity").alias("rec"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Net New").when(F.col("o_orderpriority") == "2-HIGH", "New Again").otherwise("Retained").alias("phase"))
    fact = funnel.contribution(deals, ["fiscal_quarter", "tier"], "acv", "types", "ct", "ty", "stage", "rec", "phase", "tier", "hist", "Own Opportunity")
    return plain(fact.withColumn("offers", F.array_join("offers", ",")))


@query("sales_targets", "K32 K6 F19", f"""
WITH r AS (SELECT {sql_label('o_orderdate')} AS fiscal_quarter, nullif(o_orderpriority, '4-NOT SPECIFIED') AS industry, CASE o_orderkey % 4 WHEN 0 THEN 'leads' WHEN 1 THEN 'pipe' WHEN 2 THEN 'acv' ELSE 'x' END AS metric, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_orderkey % 100 END AS target FROM orders)
SELECT fiscal_quarter, industry, CAST(('0x' || md5(coalesce(industry, 'Unknown')))::UHUGEINT % 10000000 AS BIGINT) AS industry_id, CAST(sum(CASE WHEN metric = 'leads' THEN nullif(target, 0) END) AS BIGINT) AS lead_target, CAST(sum(CASE WHEN metric = 'pipe' THEN nullif(target, 0) END) AS BIGINT) AS pipeline_target, CAST(NULL AS BIGINT) AS revenue_target, 0 AS is_restricted FROM r GROUP BY 1, 2
UNION ALL SELECT fiscal_quarter, industry, CAST(('0x' || md5(coalesce(industry, 'Unknown')))::UHUGEINT % 10000000 AS BIGINT), NULL, NULL, CAST(sum(CASE WHEN metric = 'acv' THEN nullif(target, 0) END) AS BIGINT), CAST(fiscal_quarter IN ('FY02-Q2', 'FY02-Q1') AS BIGINT) FROM r GROUP BY 1, 2""")
def _(t):
    k = F.col("o_orderkey")
    rows = t.orders.select(
        fiscal.quarter_label(order_day()).alias("fiscal_quarter"), F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("industry"),
        F.when(k % 4 == 0, "leads").when(k % 4 == 1, "pipe").when(k % 4 == 2, "acv").otherwise("x").alias("metric"),
        F.when(F.col("o_orderstatus") == "P", 0).otherwise(k % 100).cast("bigint").alias("target"))
    return plain(funnel.targets(rows, ["industry"], "fiscal_quarter", "metric", "target", "leads", "pipe", "acv", "2001-05-20"),
                 "fiscal_quarter", "industry", "industry_id", "lead_target", "pipeline_target", "revenue_target", "is_restricted")


@query("spend_by_week", "K32 K33", f"""
WITH {SQL_ACCOUNTS}, {sql_calendar(SALES_AS_OF, '1995-01-01')}
SELECT {sql_index_label('qi')} AS fiscal_quarter, fiscal_week, CAST(week_start AS VARCHAR) AS week_start, coalesce(upper(nullif(geo, 'ASIA')), 'Unknown') AS geo, CAST(('0x' || md5(coalesce(upper(nullif(geo, 'ASIA')), 'Unknown')))::UHUGEINT % 10000000 AS BIGINT) AS geo_id,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS plan, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS actual
FROM orders JOIN accounts ON o_custkey = c_custkey JOIN calendar ON date_key = CAST(o_orderdate AS DATE) WHERE {sql_from('date_key', SALES_AS_OF)} >= -6 GROUP BY ALL""")
def _(t):
    price = money("o_totalprice")
    rows = t.orders.withColumn("day", order_day())
    weekly = revenue.by_account_week(rows, "o_custkey", "day", SALES_AS_OF, [
        F.sum(price).alias("plan"), F.sum(F.when(F.col("o_orderstatus") == "F", price)).alias("actual")])
    by_geo = weekly.join(accounts(t), F.col("o_custkey") == F.col("c_custkey")).groupBy(
        "quarter_index", "fiscal_week", F.coalesce(F.upper(F.nullif("geo", F.lit("ASIA"))), F.lit("Unknown")).alias("geo")
    ).agg(F.sum("plan").alias("plan"), F.sum("actual").alias("actual"))
    shown = with_keys(revenue.labelled(by_geo), ["geo"]).withColumn("week_start", F.expr("date_add(quarter_begin, (fiscal_week - 1) * 7)"))
    return plain(shown, "fiscal_quarter", "fiscal_week", "week_start", "geo", "geo_id", "plan", "actual")


@query("new_customers_by_phase", "K13 J7", f"""
WITH {SQL_PHASES}, recent AS (SELECT * FROM phases WHERE phase_start BETWEEN DATE '2000-02-01' AND {A}),
sales AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders WHERE o_orderdate BETWEEN DATE '2000-02-01' AND {A})
SELECT {sql_label('phase_start')} AS fiscal_quarter, phase, count(DISTINCT parent_id) AS customers, count(d) AS orders, CAST(sum(price) AS DOUBLE) AS revenue
FROM recent LEFT JOIN sales ON o_custkey = parent_id AND d BETWEEN phase_start AND phase_end GROUP BY 1, 2""")
def _(t):
    first, last = F.lit("2000-02-01").cast("date"), F.lit(SALES_AS_OF).cast("date")
    recent = phases(t).filter(F.col("phase_start").between(first, last)).withColumn("phase_id", F.concat_ws("|", "parent_id", "phase_start"))
    sales = t.orders.filter(order_day().between(first, last)).select(
        F.col("o_orderkey"), "o_custkey", order_day().alias("d"), money("o_totalprice").alias("price"))
    matched = joins.interval_join(sales, recent, {"o_custkey": "parent_id"}, "d", "phase_start", "phase_end", "inner")
    totals = matched.groupBy("phase_id").agg(F.count("d").alias("orders"), F.sum("price").alias("revenue"))
    fact = recent.join(totals, "phase_id", "left").groupBy(fiscal.quarter_label("phase_start").alias("fiscal_quarter"), "phase").agg(
        F.count_distinct("parent_id").alias("customers"), F.sum(F.coalesce("orders", F.lit(0))).alias("orders"), F.sum("revenue").alias("revenue"))
    return plain(fact)
