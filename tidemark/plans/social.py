"""Social posts and profiles of several networks as one fact each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fiscal
from tidemark.functions.numbers import nvl_sum
from tidemark.functions.text import keyword_class
from tidemark.operators.conform import union_relations

# Which columns make up a measure, per network (posts). A measure
# a network lacks is 0.
COMMON = {"reactions": ["reactions"], "shares": ["shares_count"], "likes": ["likes"],
          "comments": ["comments_count"], "video_views": ["video_views"]}
POST_MEASURES: dict[str, dict[str, list[str]]] = {
    "TWITTER": {
        "clicks": ["post_content_clicks", "post_content_clicks_other", "post_detail_expand_clicks",
                   "post_hashtag_clicks", "post_link_clicks", "post_media_clicks", "post_profile_clicks"],
        **COMMON, "impressions": ["impressions"], "dislikes": [], "saves": []},
    "FACEBOOK": {
        "clicks": ["post_content_clicks", "post_content_clicks_other", "post_link_clicks",
                   "post_other_clicks_unique", "post_photo_view_clicks", "post_video_play_clicks"],
        **COMMON, "impressions": ["impressions"], "dislikes": [], "saves": []},
    "INSTAGRAM": {"clicks": ["link_in_bio_clicks"], **COMMON, "impressions": ["impressions"], "dislikes": [], "saves": ["saves"]},
    "LINKEDIN": {"clicks": ["post_content_clicks"], **COMMON, "impressions": ["impressions"], "dislikes": [], "saves": []},
    "YOUTUBE": {"clicks": ["card_clicks", "card_teaser_clicks"], **COMMON, "impressions": ["card_impressions"],
                "dislikes": ["dislikes"], "saves": []},
    "TIKTOK": {"clicks": ["post_content_clicks"], **COMMON, "impressions": ["video_views"], "dislikes": [], "saves": []},
}
# Fixed value: video views to impressions on the network that reports no impressions.
VIEWS_TO_IMPRESSIONS = 15.45


def network_fact(networks: dict[str, DataFrame], measures: dict[str, dict[str, list[str]]], attributes: Sequence[str],
                 day: str) -> DataFrame:
    """Sum each network's measures by the attributes, with fiscal columns.

    Row measures are conformed first and grouped once for all networks, so the
    union of six grouped facts costs a single shuffle. The network is a grouping
    column: rows of two networks never merge.
    """
    frames = []
    for network, frame in networks.items():
        have = set(frame.columns)
        sums = [
            (nvl_sum(*[c for c in parts if c in have]) if any(c in have for c in parts) else F.lit(0))
            .cast("bigint").alias(name)
            for name, parts in measures[network].items()
        ]
        frames.append(frame.select(F.lit(network).alias("network"), *attributes, *sums))
    names = list(next(iter(measures.values())))
    grouped = union_relations(*frames).groupBy("network", *attributes).agg(*[F.sum(n).alias(n) for n in names])
    d = F.col(day).cast("date")
    return grouped.withColumns({
        "fiscal_week": fiscal.week(d), "fiscal_month": fiscal.month(d),
        "fiscal_quarter": fiscal.quarter_label(d), "fiscal_year": fiscal.year_label(d)})


def customer_dimension(deliveries: DataFrame, attributes: Sequence[str], stamp: str) -> DataFrame:
    """Distinct customer attributes with their latest delivery."""
    return deliveries.groupBy(*attributes).agg(F.max(stamp).alias("latest_delivery"))


def with_customer(fact: DataFrame, customers: DataFrame, key: str, name: str) -> DataFrame:
    return fact.join(customers.select(key, name).distinct(), key, "left")


def with_brand_lookups(branded: DataFrame, activations: DataFrame, countries: DataFrame, profile: str) -> DataFrame:
    """Activation and budget owner of the brand tag, country of the profile; NULL where unknown.

    ``activations``: brand_tag, brand_activation, budget_owner; ``countries``: the profile column and country.
    """
    by_tag = activations.dropDuplicates(["brand_tag"])
    return branded.join(by_tag, "brand_tag", "left").join(countries.dropDuplicates([profile]), profile, "left")


def brand_posts(posts: DataFrame, tags: str, rules: Sequence[tuple[str, str]], other: str = "NON_BRAND_TAGS") -> DataFrame:
    """Posts with a brand tag; engagement is NULL when any part is."""
    tagged = posts.withColumn("brand_tag", keyword_class(tags, rules, other)).filter(F.col("brand_tag") != other)
    parts = F.col("reactions") + F.col("shares") + F.col("comments") + F.col("dislikes") + F.col("saves")
    impressions = F.when(F.col("network") == "YOUTUBE", F.col("video_views") * VIEWS_TO_IMPRESSIONS).otherwise(
        F.col("impressions").cast("double"))
    return tagged.withColumns({"impressions": impressions, "engagements": parts})
