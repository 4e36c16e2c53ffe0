"""Stages of the funnel joined into one fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fiscal, text
from tidemark.functions.numbers import all_zero, annualised, in_base_currency
from tidemark.operators import joins
from tidemark.operators.conform import union_relations
from tidemark.operators.dimensions import with_keys
from tidemark.operators.latest import one_per_key

# Channel classes of a touch.
ORGANIC_CHANNELS = ["DIRECT", "INTERNAL"]
PAID_CHANNELS = ["DISPLAY", "AFFILIATES", "EMAIL", "VIDEO", "IPM", "ITM"]


def channel_type(channel: str) -> Column:
    name = F.upper(F.col(channel))
    return (
        F.when(name.like("%ORGANIC%") | name.isin(ORGANIC_CHANNELS), "Organic")
        .when(name.like("%PAID%") | name.isin(PAID_CHANNELS), "Paid").otherwise("Other")
    )


def revenue_stage(sources: Sequence[DataFrame], touches: DataFrame, touch_key: str, order_keys: Sequence[str],
                  touch_columns: Sequence[str], account: str, merges: DataFrame, parents: DataFrame) -> DataFrame:
    """Conformed sources unioned, touch by either order number, account family.

    ``touches`` has one row per purchase; columns a source lacks are NULL.
    """
    union = union_relations(*sources)
    first, second = order_keys
    attributed = joins.lookup_twice(union, touches, touch_key, first, second, touch_columns)
    family = joins.resolve_family(
        attributed, account, merges, parents, "victim", "survivor", "status", "account", "parent")
    return family.withColumn("channel_type", channel_type("channel"))


def current_rates(changes: DataFrame, code: str, rate: str, changed_at: str) -> DataFrame:
    """The rate valid now, from the list of changes (one row per code and rate)."""
    firsts = changes.groupBy(code, rate).agg(F.min(changed_at).alias("_since"))
    ranged = joins.validity_intervals(firsts, code, "_since", rate)
    return ranged.filter(F.col("valid_to").isNull()).select(F.col(code).alias("rate_code"), F.col(rate).alias("rate"))


def converted_lines(lines: DataFrame, rates: DataFrame, currency: str, amount: str, term: str) -> DataFrame:
    """Line amounts in the base currency and per year."""
    joined = lines.join(rates, F.col(currency) == F.col("rate_code"), "left")
    return joined.withColumn("converted", in_base_currency(F.col(amount).cast("double"), "rate")).withColumn(
        "yearly", annualised("converted", term)).drop("rate_code", "rate")


def quote_state(status: str) -> Column:
    # What a quote status means for the pipeline.
    states = {"Expired": "Not Active", "Draft": "Not Active", "Cancelled": "Not Active", "T&C Negotiation": "Open",
              "Quoted": "Open", "T&C Approved": "Open", "Order Submitted": "Open", "Under Review": "Open", "Ordered": "Closed"}
    return F.coalesce(text.coded(status, states), F.col(status))


def pipeline_state(stage: str) -> Column:
    # What an opportunity's stage means for the pipeline.
    lost = ["Close/Lost", "Closed", "Closed / Lost", "Closed /Lost", "Closed/Lost", "Rejected", "--None--"]
    open_stages = ["Stage 1", "Stage 2", "Stage 3", "Stage 4", "1-Prospecting", "2-Qualifying", "3-Solution Building", "4-Proposal/Negotiation"]
    won = ["Stage 5", "5-Closed/Won", "Won", "Closed-Won"]
    states = {**dict.fromkeys(lost, "Not Active"), **dict.fromkeys(open_stages, "Open"), **dict.fromkeys(won, "Closed")}
    return F.coalesce(text.coded(stage, states), F.col(stage))


def with_customers(fact: DataFrame, phases: DataFrame, account: str) -> DataFrame:
    """The fact FULL customers with their phase, on the account; both keep what has no match."""
    return joins.full_outer(fact, phases, [account])


def lower_funnel(opportunities: DataFrame, quote_lines: DataFrame, opportunity_lines: DataFrame, finance: DataFrame,
                 opportunity: str, quote: str, line: str) -> DataFrame:
    """Quotes with lines, and opportunities without a quote, against finance.

    Opportunities that have a quote come through their quote lines, the others
    through their own lines; finance joins FULL on (quote, line).
    """
    quoted = quote_lines.join(opportunities, opportunity, "left").withColumn("record_source", F.lit("QUOTE"))
    unquoted = (
        opportunities.join(quote_lines.select(opportunity).distinct(), opportunity, "left_anti")
        .join(opportunity_lines, opportunity, "left").withColumn("record_source", F.lit("OPPORTUNITY"))
    )
    return joins.full_outer(union_relations(quoted, unquoted), finance, [quote, line])


def mid_funnel(contacts: DataFrame, leads: DataFrame, trials: DataFrame, id_stack: DataFrame,
               contact_key: str, user_key: str, ids: str) -> DataFrame:
    """Contacts FULL leads FULL trials, then the id stack's list exploded and joined.

    The list of ids is opened to one row per id (quotes stripped).
    """
    people = joins.full_outer(contacts, leads, [contact_key])
    with_trials = joins.full_outer(people, trials, [user_key])
    opened = id_stack.withColumn("_id", F.explode(ids)).select(
        F.regexp_replace("_id", '"', "").alias("_user"), *[c for c in id_stack.columns if c != ids])
    opened = one_per_key(opened, ["_user"], *[c for c in id_stack.columns if c != ids])
    return with_trials.join(opened, F.col(user_key).cast("string") == F.col("_user"), "left").drop("_user")


def marketing_funnel(mid: DataFrame, lower: DataFrame, phases: DataFrame, opportunity: str, fact_id: str, dates: Sequence[str],
                     account: str) -> DataFrame:
    """Mid FULL lower funnel, then FULL customer phases by any of its dates.

    ``phases``: phase_id, parent_id, phase, phase_start, phase_end.
    """
    both = joins.full_outer(mid, lower, [opportunity])
    return joins.full_interval_join(
        both, phases, {account: "parent_id"}, dates, fact_id, "phase_id", "phase_start", "phase_end")


def contribution(deals: DataFrame, dims: Sequence[str], amount: str, offers: str, contribution_type: str, deal_type: str,
                 stage: str, record_type: str, phase: str, tier: str, historic_type: str, own_record: str,
                 global_tier: str = "Named Account Global", won: str = "CLOSED/WON") -> DataFrame:
    """Marketing-contributed and -sourced revenue per dimensions.

    Distinct offers are the sorted distinct elements of the deals' lists: the
    lists are opened and made distinct, so no group's lists pile up in a task.
    """
    closed = F.col(stage) == won
    sourced = F.col(contribution_type) == "MS"
    own = F.col(record_type) == own_record
    new, renewed = F.col(deal_type) == "New", F.col(deal_type) == "Renew"
    has_type = F.col(contribution_type).isNotNull()
    is_global = F.coalesce(F.col(tier), F.lit("")) == global_tier
    newcomers = F.col(phase).isin("Net New", "New Again")
    value = F.col(amount)
    sums = deals.groupBy(*dims).agg(
        F.sum(F.when(has_type & renewed & closed, value)).alias("contributed_renewal"),
        F.sum(F.when(has_type & new & closed, value)).alias("contributed_new"),
        F.sum(F.when(sourced & new & own & closed, value)).alias("sourced_new"),
        F.sum(F.when(sourced & new & own & newcomers & closed, value)).alias("sourced_new_customer"),
        F.sum(F.when(own & is_global & sourced, value).when(own & ~is_global & (F.col(historic_type) == "MS"), value)
              .otherwise(0)).alias("sourced_created"))
    lists = deals.select(*dims, F.explode(offers).alias("_offer")).distinct().groupBy(*dims).agg(
        F.array_sort(F.collect_set("_offer")).alias("offers"))
    measures = ["contributed_renewal", "contributed_new", "sourced_new", "sourced_new_customer", "sourced_created"]
    joined = joins.text_null_safe(sums, lists, list(dims))
    return joined.filter(~all_zero(*measures))


def targets(rows: DataFrame, dims: Sequence[str], quarter: str, metric: str, target: str, lead_metric: str, pipeline_metric: str,
            revenue_metric: str, as_of: str) -> DataFrame:
    """Target facts: leads and pipeline never restricted, revenue by quarter.

    The dimensions get their hashed ids; a zero target counts as missing.
    """
    def measured(name: str) -> Column:
        return F.sum(F.when(F.col(metric) == name, F.nullif(F.col(target), F.lit(0))))

    this = F.lit(as_of).cast("date")
    previous = F.add_months(fiscal.quarter_begin(this), -3)
    restricted = (F.col(quarter) == fiscal.quarter_label(this)) | (
        (F.col(quarter) == fiscal.quarter_label(previous)) & F.month(this).isin(2, 5, 8, 11))
    open_rows = rows.groupBy(quarter, *dims).agg(
        measured(lead_metric).alias("lead_target"), measured(pipeline_metric).alias("pipeline_target")
    ).withColumn("is_restricted", F.lit(0))
    revenue_rows = rows.groupBy(quarter, *dims).agg(measured(revenue_metric).alias("revenue_target")).withColumn(
        "is_restricted", F.when(restricted, 1).otherwise(0))
    return with_keys(union_relations(open_rows, revenue_rows), list(dims))
