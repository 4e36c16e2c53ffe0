"""Web traffic: exclusion flags, site segments, cart adds, visits, weekly cube."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fiscal, text
from tidemark.operators import joins, period
from tidemark.operators.aggregates import distinct_cube
from tidemark.operators.latest import first_by
from tidemark.plans.revenue import in_calendar, labelled, with_fiscal_week


@dataclass(frozen=True)
class TrafficRules:
    """What counts as support, retired, renewal and interaction."""

    # LIKE patterns of support pages, product pages and their exceptions, interactions.
    support_pages: tuple[str, ...] = (
        "%:support", "%:support:contact-support%", "%:support:technical%",
        "%:support:account%", "%:support:download-install%", "%:support:system-requirements%",
    )
    product_page: str = "%:PRODUCTS:%"
    not_product_pages: tuple[str, ...] = ("%:MANAGE%", "%TRIAL%", "%:404", "%ERROR%")
    interactions: tuple[str, ...] = (
        "form-submit", "add-to-cart", "live-chat-click", "file-download", "pdf-click", "social-share",
        "search-results", "cloud-trial", "trial-download-start-intent", "video-play",
        "trial-download-intent", "link-click",
    )
    navigation_links: tuple[str, ...] = (
        "%sign in%", "%me-menu%", "%privacy banner%", "%uh nav%", "%uh search%", "%uh top-nav%",
        "%uh top bar%", "%uh geolocation%", "%uh lang selection%", "%legalfooter%", "%megafooter%",
        "%utilitynav%", "%cookie preferences%", "%see all products > see all products%", "%aec products%",
        "%pdm products%", "%mini cart%", "%discover%", "%download >%", "%me products%", "%how to buy%",
    )
    cart_page: str = "%cart details%"
    # A page whose hits from one referrer are ignored for a while.
    retired_page: str | None = None
    retired_referrer: str | None = None
    retired_days: tuple[str, str] = ("1900-01-01", "1900-01-01")


def exclusion_flags(hits: DataFrame, rules: TrafficRules, day: str, page: str, referrer: str, origin: str,
                    renewal: str, platform: str, cart_add: str) -> DataFrame:
    """Add the flags later steps filter on; nothing is dropped here."""
    retired = (
        (F.lower(F.col(page)) == F.lit(rules.retired_page)) & (F.col(referrer) == F.lit(rules.retired_referrer))
        & F.col(day).between(*[F.lit(d).cast("date") for d in rules.retired_days])
    )
    renewals = (
        F.lower(F.col(origin)).like("%moe%") | (F.lower(F.coalesce(F.col(renewal), F.lit(""))) == "renew")
        | F.coalesce(F.col(platform), F.lit("")).like("DE:%")
    )
    return hits.withColumns({
        "is_retired": F.coalesce(retired, F.lit(False)),
        "is_renewal": F.coalesce(renewals, F.lit(False)),
        "is_support": F.coalesce(text.like_any(page, rules.support_pages), F.lit(False)),
        "is_cart_add": F.coalesce(F.lower(F.col(page)).like(rules.cart_page) | (F.col(cart_add) == 1), F.lit(False)),
    })


def hit_flags(hits: DataFrame, rules: TrafficRules, page: str, event: str, link: str, attempt: str) -> DataFrame:
    """Prospect, product-page and bounce flags of single hits.

    A hit is an interaction, and no bounce, if its event is one, if its link is
    the empty text (not NULL), or if it is an attempt to submit a form.
    """
    prospect = ~text.like_any(link, rules.navigation_links, ignore_case=True) & (F.col(event) == "link-click")
    product = F.upper(F.col(page)).like(rules.product_page) & ~text.like_any(F.upper(F.col(page)), rules.not_product_pages)
    acted = F.lower(F.col(event)).isin(list(rules.interactions)) | (F.col(link) == "") | (F.col(attempt) == 1)
    return hits.withColumns({
        "is_prospect": F.coalesce(prospect, F.lit(False)).cast("int"),
        "is_product_page": F.coalesce(product, F.lit(False)).cast("int"),
        "bounce_page": F.when(acted, 0).otherwise(1),
    })


def segment_list(sites: DataFrame, columns: dict[str, str], mapping: DataFrame) -> DataFrame:
    """The segment columns of the site list as rows, with each segment's place.

    The lookup is unpivoted once instead of filtering the hits once per column.
    ``mapping``: segment, site_country, site_geo, site_region.
    """
    rows = sites.select(
        "site_name", "page_name", "country_code",
        F.explode(F.array(*[F.struct(F.lit(kind).alias("segment_type"), F.col(c).alias("segment"))
                            for c, kind in columns.items()])).alias("_s"),
    ).select("site_name", "page_name", "country_code", "_s.*").distinct()
    return rows.join(mapping, "segment")


def segmented_hits(hits: DataFrame, segments: DataFrame, site: str, page: str, country: str) -> DataFrame:
    """Hits once per segment they belong to (case-blind site, page, country)."""
    lookup = segments.select(
        F.lower("site_name").alias("_site"), F.lower("page_name").alias("_page"), F.lower("country_code").alias("_country"),
        *[c for c in segments.columns if c not in ("site_name", "page_name", "country_code")]).distinct()
    on = (
        (F.lower(F.col(site)) == F.col("_site")) & (F.lower(F.col(page)) == F.col("_page"))
        & (F.lower(F.col(country)) == F.col("_country"))
    )
    return hits.join(lookup, on).drop("_site", "_page", "_country")


def cart_add_visits(hits: DataFrame, visit: str, quoted: Column, direct: Column, dedup: Sequence[str],
                    newest: str, *tiebreak: str) -> DataFrame:
    """Cart-add hits, flagged when their visit has a quote flow but no direct sale.

    Flags are aggregated to one row per visit; the hits are deduplicated to the
    newest per key.
    """
    odd = joins.yes_never_no(hits, visit, quoted, direct).select(F.col(visit).alias("_visit"))
    adds = hits.filter("is_cart_add").join(odd, F.col(visit) == F.col("_visit"), "left").withColumn(
        "is_quote_only", F.col("_visit").isNotNull()).drop("_visit")
    return first_by(adds, dedup, [F.col(newest).desc_nulls_last(), *[F.col(c).desc() for c in tiebreak]])


def visit_fact(hits: DataFrame, visit: str, dims: Sequence[str], page: str, page_view: str,
               any_flags: Sequence[str]) -> DataFrame:
    """One row per visit and dimensions: any-true flags, page counts, bounce.

    Hits are first reduced to one row per (visit, dims, page), which is all
    that the flags and the distinct page count need.
    """
    pages = hits.groupBy(visit, *dims, page).agg(
        *[F.max(f).alias(f) for f in any_flags], F.min("bounce_page").alias("bounce_page"), F.sum(page_view).alias("_views"))
    by_dims = pages.groupBy(visit, *dims).agg(*[F.max(f).alias(f) for f in any_flags])
    by_visit = pages.groupBy(F.col(visit).alias("_visit")).agg(
        F.min("bounce_page").alias("bounce_page"), F.count_distinct(page).alias("pages_distinct"),
        F.sum("_views").alias("page_views_sum"))
    bounced = F.col("bounce_page") == 1
    page_views = F.when(F.col("pages_distinct") == 0, F.col("page_views_sum")).otherwise(F.col("pages_distinct"))
    return by_dims.join(by_visit, F.col(visit) == F.col("_visit"), "left").drop("_visit").withColumns({
        "page_views": page_views,
        "is_bounce_distinct": (bounced & (F.col("pages_distinct") == 1)).cast("int"),
        "is_bounce_sum": (bounced & (F.col("page_views_sum") == 1)).cast("int"),
        "is_bounce": (bounced & (page_views == 1)).cast("int"),
    })


def weekly_cube(visits: DataFrame, fixed: Sequence[str], dims: dict[str, str],
                counts: dict[str, tuple[str, Column]], orders: DataFrame, order_id: str, as_of: str,
                prefix: str) -> DataFrame:
    """Distinct visit and visitor counts over a labelled cube, orders attached,
    each week beside the same week a quarter and a year ago.

    A missing earlier visit count falls back to the current one, a missing
    earlier order count to 0. Both inputs carry quarter_index and fiscal_week.
    """
    keys = ["quarter_index", "fiscal_week", *fixed]
    cells = distinct_cube(visits, keys, dims, counts, prefix)
    ordered = distinct_cube(orders, keys, dims, {"orders": (order_id, F.lit(True))}, prefix)
    both = joins.text_null_safe(cells, ordered, [*fixed, *dims, "aggregated_by"], exact=keys[:2])
    cell_keys = ["fiscal_week", *fixed, *dims, "aggregated_by"]
    compared = period.cell_comparison(both, "quarter_index", cell_keys, [*counts, "orders"], as_of)
    fallback = {f"{s}_{m}": F.coalesce(f"{s}_{m}", m) for s in period.QUARTERS_BACK for m in counts}
    zero = {f"{s}_orders": F.coalesce(f"{s}_orders", F.lit(0)) for s in period.QUARTERS_BACK}
    return labelled(compared.withColumns({**fallback, **zero}))


def trial_comparison(rows: DataFrame, dims: Sequence[str], counts: dict[str, tuple[str, Column]], day: str, as_of: str,
                     quarters_back: int = 6) -> DataFrame:
    """Distinct trial steps per quarter beside the previous and the year-ago quarter.

    ``counts`` maps a name to (id column, condition). The current quarter compares
    with the weeks of the earlier ones that it has completed itself.
    """
    recent = with_fiscal_week(in_calendar(rows, day, as_of, quarters_back), day)
    last_week = period.weeks_in_quarter(fiscal.quarter_index(fiscal.as_date(as_of)), as_of)
    to_date = F.col("fiscal_week") <= last_week
    cells = recent.groupBy("quarter_index", *dims).agg(
        *[F.count_distinct(F.when(cond, F.col(i))).alias(n) for n, (i, cond) in counts.items()],
        *[F.count_distinct(F.when(cond & to_date, F.col(i))).alias(f"{n}_to_date") for n, (i, cond) in counts.items()])
    return labelled(period.cell_comparison(
        cells, "quarter_index", dims, list(counts), as_of, to_date=[f"{n}_to_date" for n in counts]))


def weeks_after(stored: DataFrame, new: DataFrame) -> DataFrame:
    """New weeks beyond the newest stored one (quarter, then week)."""
    position = F.col("quarter_index") * 100 + F.col("fiscal_week")
    mark = stored.agg(F.coalesce(F.max(position), F.lit(0)).alias("mark")).scalar()
    return new.filter(position > mark)
