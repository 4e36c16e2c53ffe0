"""Leads and contacts: flags, owner class, geography, dates, counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fiscal, numbers
from tidemark.operators.conform import union_distinct

# Statuses and closing reasons.
CLOSED = ["closed", "close"]
UPLOAD_ERRORS = ["error upload", "error to upload"]
UNTOUCHED_REASONS = ["retired campaign", "error upload", "error to upload", "aged lead", "aged leads", "aging lead",
                     "expired", "completed"]
UNWORKED_REASONS = ["retired campaign", "error upload", "error to upload", "lead cleanup", "clean audit", "inactive user"]
RETIRED_REASONS = ["retired campaign", "error upload", "error to upload", "lead cleanup", "clean audit"]
GEOS = ["EMEA", "AMER", "APAC", "JAPAN"]
NOT_YET = 9999


def _yes(condition: Column) -> Column:
    return F.when(condition, "Y").otherwise("N")


def lead_flags(leads: DataFrame, status: str, reason: str, deleted: str, received: str, last_activity: str) -> DataFrame:
    """Valid, touched, state, completed-by-sales and retired, one column each."""
    state, why = F.lower(F.col(status)), F.lower(F.col(reason))
    closed = state.isin(CLOSED)
    cleanup = why.like("%clean%")
    invalid = (closed & F.coalesce(why, F.lit("")).isin(UPLOAD_ERRORS)) | F.col(deleted)
    later_activity = F.col(last_activity).isNotNull() & (F.datediff(last_activity, received) >= 0)
    return leads.withColumns({
        "valid_flag": F.when(invalid, "N").otherwise("Y"),
        "touched_flag": (
            F.when(state.isin("outreach", "qualifying", "converted", "qualified"), "Y").when(state == "new", "N")
            .when(closed & ~cleanup & ~why.isin(UNTOUCHED_REASONS), "Y").when(later_activity, "Y").otherwise("N")),
        "state": F.when(closed, "Closed").when(state == "converted", "Converted").otherwise("Open"),
        "completed_flag": F.when(state == "converted", "Y").when(
            closed & ~why.isin(UNWORKED_REASONS) & ~cleanup, "Y").otherwise("N"),
        "retired_flag": _yes(closed & why.isin(RETIRED_REASONS) & cleanup),
    })


def owner_class(own_name: str, queue: str, owner: dict[str, str], partner: dict[str, str]) -> Column:
    """Who works the lead, from the owner's account and then the partner's.

    ``owner`` and ``partner`` name the columns partner_type, vendor_type, type
    and name; the first rule that holds decides.
    """
    low = lambda c: F.lower(F.col(c))
    resale = ["reseller", "master reseller"]

    def rules(a: dict[str, str]) -> list[tuple[Column, str]]:
        kind = low(a["partner_type"])
        return [
            ((kind == "associate") & (low(a["vendor_type"]) == "tele-vendor"), "Tele Vendor"),
            ((low(a["type"]) == "distributor") | (kind == "distributor"), "Distributor"),
            (low(a["name"]).like(f"%{own_name.lower()}%"), own_name),
            (low(a["type"]).isin(resale) | kind.isin(resale), "Partner/reseller"),
            (kind == "isv", "Partner/ISV"),
        ]

    chain = F.when(low(queue) == "lead partner reassignment queue", "Partner/reseller")
    for condition, label in [*rules(owner), *rules(partner)]:
        chain = chain.when(condition, label)
    return (
        chain.when(F.col(partner["name"]).isNotNull(), "Partner/reseller")
        .when(low(queue) == "opty admin queue", "Partner/reseller").otherwise(own_name)
    )


def sales_geo(column: str) -> Column:
    """Known sales regions in capitals, 'Americas' as AMER, anything else NULL."""
    value = F.upper(F.col(column))
    return F.when(value == "AMERICAS", "AMER").when(value.isin(GEOS), value)


def country_chain(leads: DataFrame, countries: DataFrame, spelled: str, fallback: str, aliases: dict[str, str]) -> DataFrame:
    """Lead country: an alias, else itself if listed, else the account's if listed.

    ``countries``: search_code (any case), country, geo. Adds ``lead_country``,
    ``country`` and ``mapped_geo``.
    """
    listed = countries.select(
        F.lower("search_code").alias("_code"), F.col("country").alias("_country"), F.col("geo").alias("_geo")
    ).dropDuplicates(["_code"])
    known = listed.select(F.col("_code").alias("_known"))
    alias = F.lit(None).cast("string")
    for word, name in aliases.items():
        alias = F.when(F.col(spelled) == word, F.lit(name)).otherwise(alias)
    checked = (
        leads.join(known, F.lower(F.col(spelled)) == F.col("_known"), "left").withColumnRenamed("_known", "_k1")
        .join(known, F.lower(F.col(fallback)) == F.col("_known"), "left").withColumnRenamed("_known", "_k2")
        .withColumn("lead_country", F.coalesce(
            alias, F.when(F.col("_k1").isNotNull(), F.col(spelled)), F.when(F.col("_k2").isNotNull(), F.col(fallback))))
    )
    return checked.join(listed, F.lower("lead_country") == F.col("_code"), "left").withColumns(
        {"country": F.col("_country"), "mapped_geo": F.col("_geo")}).drop("_k1", "_k2", "_code", "_country", "_geo")


def lead_geo(leads: DataFrame, countries: DataFrame, lead_text: str, owner_text: str, owner_country: str, account_geo: str) -> DataFrame:
    """Geo of the lead's country, else the lead's own, its owner's, its owner's country's, its account's.

    ``leads`` come from ``country_chain``; ``countries`` as there. Adds ``geo``.
    """
    owners = countries.select(F.lower("search_code").alias("_code"), F.col("geo").alias("_owner_geo")).dropDuplicates(["_code"])
    return leads.join(owners, F.lower(owner_country) == F.col("_code"), "left").withColumn(
        "geo", F.coalesce("mapped_geo", sales_geo(lead_text), sales_geo(owner_text), "_owner_geo", account_geo)).drop("_code", "_owner_geo")


def first_touch_days(touched: str, received: str, first: str) -> Column:
    """Workdays from receipt to first touch; 9999 untouched, NULL when odd."""
    r, f = F.col(received), F.col(first)
    odd = r.isNull() | f.isNull() | (r > f)
    return (
        F.when((F.col(touched) == "Y") & odd, None).when(r == f, 0).when(F.col(touched) == "N", NOT_YET)
        .when(r.isNull() | f.isNull(), None).otherwise(fiscal.workday_distance(received, first))
    )


def completion_days(state: str, received: str, done: str) -> Column:
    r, d = F.col(received), F.col(done)
    finished = F.col(state).isin("Converted", "Closed")
    return F.when(~finished, NOT_YET).when(d.isNull() | r.isNull() | (r > d), None).otherwise(
        fiscal.workday_distance(received, done))


def touch_band(days: str) -> Column:
    return numbers.band(days, [(2, "< 2 days"), (5, "2 to 5 days")], "> 5 days", "N/A", NOT_YET, "UNTOUCHED")


def completion_band(days: str) -> Column:
    c = F.col(days)
    return (
        F.when(c.isNull(), "N/A").when((c >= 0) & (c < 10), "< 10 days").when((c >= 10) & (c <= 20), "10 to 20 days")
        .when((c > 20) & (c != NOT_YET), "> 20 days").otherwise("NOT COMPLETE")
    )


def leads_created(delivered: DataFrame, undelivered: DataFrame, columns: Sequence[str], received: str, as_of: str,
                  quarters_back: int = 6) -> DataFrame:
    """Both lead streams (identical rows once) with their fiscal columns."""
    both = union_distinct(
        delivered.select(*columns).withColumn("is_delivered", F.lit(True)),
        undelivered.select(*columns).withColumn("is_delivered", F.lit(False)))
    d = F.col(received)
    return both.filter(
        (d < fiscal.as_date(as_of)) & (d >= fiscal.window_start(as_of, quarters_back)) & ~fiscal.in_unfinished_week(d, as_of)
    ).withColumns({
        "fiscal_quarter": fiscal.quarter_label(d), "fiscal_week": fiscal.week(d),
        "previous_quarter": fiscal.quarter_label(F.add_months(fiscal.quarter_begin(d), -3)),
        "is_current_quarter": F.when(fiscal.quarters_from(d, as_of) == 0, 1).otherwise(0),
    })


def persona(flags: Sequence[tuple[str, str]]) -> Column:
    """Label of the first flag that is 'TRUE'."""
    chain = F.when(F.col(flags[0][0]) == "TRUE", flags[0][1])
    for column, label in flags[1:]:
        chain = chain.when(F.col(column) == "TRUE", label)
    return chain


def contact_counts(contacts: DataFrame, dims: Sequence[str], reportable: str, ids: Sequence[str]) -> DataFrame:
    """Marketable, other and all contacts; an id may come from either system."""
    any_id = F.coalesce(*ids)
    return contacts.groupBy(*dims).agg(
        F.count(F.when(F.col(reportable) == "TRUE", any_id)).alias("marketable"),
        F.count(F.when(F.col(reportable) == "FALSE", any_id)).alias("not_marketable"),
        F.count(any_id).alias("contacts"))


def cleaned_contacts(contacts: DataFrame, wanted_status: str, countries: dict[str, str]) -> DataFrame:
    """Contacts to create anew: changed address at an unmatched domain, or a
    silently different address; filled fields, country to its code, no repeats."""
    active = contacts.filter(F.col("status") == wanted_status)
    changed = (F.col("email_check") == "Change in Email") & F.col("domain_check").isNull()
    silent = F.col("email_check").isNull() & (F.lower("email") != F.lower("email_new"))
    chosen = active.filter(changed | silent)
    country = F.coalesce("country_new", "country")
    code = F.lit("No Match")
    for name, iso in reversed(list(countries.items())):
        code = F.when(F.contains(country, F.lit(name)), F.lit(iso)).otherwise(code)
    return chosen.select(
        "account_id", F.lower(F.coalesce("email_new", "email")).alias("email"),
        F.coalesce("phone_new", "company_phone").alias("phone"),
        F.coalesce("interest", F.lit("Dummy Product")).alias("interest"),
        F.concat_ws(" ", "address_1", "address_2").alias("address"),
        F.when(country.isNotNull(), code).otherwise("No Match").alias("iso_code"),
        F.lit("DataEnrichment").alias("source_system"),
    ).distinct()
