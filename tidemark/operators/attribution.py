"""Which touch gets the credit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import interval_join
from tidemark.operators.latest import first_by, latest_by


def last_touch(stack: DataFrame, purchase: str, touched_at: str, attributes: Sequence[str],
               taxonomy: DataFrame | None = None, taxonomy_key: str | None = None,
               taxonomy_value: str | None = None, remapped: str | None = None, line_items: DataFrame | None = None,
               line_item: str | None = None, industry: str | None = None) -> DataFrame:
    """The latest touch per purchase, its campaign id remapped by the taxonomy.

    With ``line_items`` the (remapped) id is looked up as ``line_item``, and of
    several line items of one id the one with an ``industry``, the first by its
    name, is taken; their columns are added.

    Touches are reduced to one row per (purchase, attributes) first, so that
    repeated touches combine before the shuffle.
    """
    touches = stack.filter(F.col(purchase).isNotNull()).groupBy(purchase, *attributes).agg(
        F.max(touched_at).alias("touched_at"))
    latest = latest_by(touches, [purchase], "touched_at", *attributes)
    if taxonomy is not None:
        mapping = taxonomy.select(F.col(taxonomy_key).alias("_key"), F.col(taxonomy_value).alias("_value"))
        mapping = mapping.groupBy("_key").agg(F.min("_value").alias("_value"))
        latest = (
            latest.join(mapping, F.col(taxonomy_key) == F.col("_key"), "left")
            .withColumn(remapped, F.coalesce(F.col("_value"), F.col(remapped)))
            .drop("_key", "_value")
        )
    if line_items is None:
        return latest
    # one line item per id first: the rule looks at nothing else, and no touch is multiplied
    rest = [c for c in line_items.columns if c not in (line_item, industry)]
    chosen = first_by(line_items, [line_item], [F.col(industry).asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in rest]])
    text = chosen.withColumn("_item", F.col(line_item).cast("string")).drop(line_item)
    return latest.join(text, F.col(remapped).cast("string") == F.col("_item"), "left").drop("_item")


def match_tier(trial_code: str, order_code: str, trial_name: str, order_class: str,
               shared_words: Sequence[str], bundle_word: str = "COLLECTION") -> Column:
    """1 same code, 2 same prefix or a shared word, 3 a bundle, 4 anything else."""
    t, o = F.col(trial_code), F.col(order_code)
    tier = F.when(t == o, 1).when(F.substring(t, 1, 3) == F.substring(o, 1, 3), 2)
    for word in shared_words:
        pattern = f"%{word}%"
        tier = tier.when(F.col(trial_name).ilike(pattern) & F.col(order_class).ilike(pattern), 2)
    return tier.when(F.col(order_class).ilike(f"%{bundle_word}%"), 3).otherwise(4)


def trial_conversions(orders: DataFrame, trials: DataFrame, user: str, trial_user: str, order_id: str,
                      ordered: str, activated: str, entitled: str, trial_id: str, trial_product: str,
                      tier: Column, window_days: int = 90) -> DataFrame:
    """Every trial that an order may have come from, ranked; ``converted`` marks the winner.

    An order may follow a trial from its activation up to ``window_days`` after
    the entitlement start. Per order the best tier ranks first, then the latest
    activation, then the greatest trial id; the others stay with their rank.

    Orders alike in all but their id are matched once and joined to their
    matches afterwards, and the match is split by month as well as user. A rank
    runs over one order's matches only.
    """
    candidates = trials.filter(F.col(activated).isNotNull()).distinct().withColumn("_until", F.date_add(F.col(entitled), window_days))
    kind = [c for c in orders.columns if c != order_id]
    found = [trial_product, activated, entitled, trial_id]
    pairs = interval_join(
        orders.select(*kind).distinct(), candidates, {user: trial_user}, ordered, activated, "_until", "inner")
    tiered = pairs.withColumn("match_tier", tier).groupBy(*kind, *found).agg(F.min("match_tier").alias("match_tier"))
    tiered = tiered.select(*[F.col(c).alias(f"_k_{c}") for c in kind], *found, "match_tier")
    same = F.lit(True)
    for c in kind:
        same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    # an order of several products takes the best tier of a trial
    keys = [order_id, ordered, user]
    matched = orders.distinct().join(tiered, same).groupBy(*keys, *found).agg(F.min("match_tier").alias("match_tier"))
    best = Window.partitionBy(*keys).orderBy(F.col("match_tier").asc(), F.col(activated).desc(), F.col(trial_id).desc())
    return matched.withColumn("match_rank", F.dense_rank().over(best)).withColumn("converted", F.col("match_rank") == 1)


def valid_downloads(downloads: DataFrame, activations: DataFrame, keys: Sequence[str], group: Sequence[str],
                    user: str, entitled: str, ended: str, activated: str, download_id: str) -> DataFrame:
    """Attach activations inside the entitlement and flag the valid download.

    ``keys`` tie an activation to a download; within ``group`` (user, product,
    entitlement) the valid one has an activation by the same user, then the
    earliest activation, then the greatest id. All rows are kept.
    """
    acts = activations.select(
        *[F.col(k).alias(f"_a_{k}") for k in keys], F.col(user).alias("activation_user"), F.col(activated))
    cond = (F.col(activated) >= F.col(entitled)) & (F.col(activated) <= F.col(ended))
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"_a_{k}"))
    joined = downloads.join(acts, cond, "left").drop(*[f"_a_{k}" for k in keys]).withColumn(
        "valid_activation", F.coalesce(F.col(user) == F.col("activation_user"), F.lit(False)))
    decisive = ["valid_activation", activated, download_id]
    winners = first_by(joined.select(*group, *decisive), group, [
        F.col("valid_activation").desc(), F.col(activated).asc_nulls_last(), F.col(download_id).desc()])
    winners = winners.select(*[F.col(c).alias(f"_w_{c}") for c in (*group, *decisive)], F.lit(True).alias("_won"))
    same = F.lit(True)
    for c in (*group, *decisive):
        same = same & F.col(c).eqNullSafe(F.col(f"_w_{c}"))
    return (
        joined.join(winners, same, "left").withColumn("valid_download", F.coalesce("_won", F.lit(False)))
        .drop("_won", *[f"_w_{c}" for c in (*group, *decisive)])
    )


def undelivered(snapshots: DataFrame, delivered: DataFrame, key: str, partition: Sequence[str],
                snapshot: str, score: str, threshold: float, delivered_key: str) -> DataFrame:
    """Latest snapshot per key, score at or above the threshold, not yet delivered."""
    newest = first_by(snapshots, partition, [F.col(snapshot).desc_nulls_last(), F.col(score).desc_nulls_last()])
    gone = delivered.select(F.col(delivered_key).alias("_gone")).distinct()
    return newest.filter(F.col(score) >= threshold).join(gone, F.col(key) == F.col("_gone"), "left_anti")
