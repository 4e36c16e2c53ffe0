"""Gaussian smoothing of a rate over the ordered bins of a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.latest import place_in_group


def smoothed_rate(bins: DataFrame, groups: Sequence[str], bin_column: str, hits: str, total: str,
                  sigma: float = 10.0, truncate: float = 4.0,
                  rate: str = "conversion_rate", smooth: str = "smooth_rate") -> DataFrame:
    """Rate ``hits/total`` (0 when undefined) and its smoothed value.

    ``bins`` has one row per (group, bin). Beyond either end the series is
    mirrored. Every bin gathers the bins within the kernel's radius by an
    equi-join on their position: linear in the bins, never group by group.
    """
    radius = int(truncate * sigma + 0.5)
    sizes = bins.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"))
    quotient = F.col(hits).cast("double") / F.nullif(F.col(total).cast("double"), F.lit(0.0))
    placed = (
        place_in_group(bins, groups, [bin_column], "_at").withColumn(rate, F.coalesce(quotient, F.lit(0.0)))
        .join(sizes, list(groups))
    )
    offset = F.col("_offset")
    mirrored = F.pmod(F.col("_at") + offset, F.col("_n") * 2)
    reach = (
        placed.withColumn("_offset", F.explode(F.sequence(F.lit(-radius), F.lit(radius))))
        .withColumns({
            "_weight": F.exp(-0.5 * offset * offset / F.lit(sigma * sigma)),
            "_from": F.when(mirrored < F.col("_n"), mirrored).otherwise(F.col("_n") * 2 - 1 - mirrored),
        })
        .select(*groups, bin_column, hits, total, rate, "_weight", "_from")
    )
    source = placed.select(*groups, F.col("_at").alias("_from"), F.col(rate).alias("_rate"))
    gathered = reach.join(source, [*groups, "_from"])
    return gathered.groupBy(*groups, bin_column, hits, total, rate).agg(
        (F.sum(F.col("_weight") * F.col("_rate")) / F.sum("_weight")).alias(smooth))
