"""Conformed dimensions and lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import hash_key
from tidemark.operators.conform import union_relations


def conformed_dimension(sources: Sequence[tuple[DataFrame, str]], name: str,
                        unknown: str = "Unknown") -> DataFrame:
    """The distinct values of one attribute over many facts, with a hashed key.

    Each source is made distinct on its own first: what is shuffled for the
    union is the values, not the facts.
    """
    values = [
        df.select(F.coalesce(F.col(c).cast("string"), F.lit(unknown)).alias(name)).distinct()
        for df, c in sources
    ]
    merged = union_relations(*values).distinct()
    return merged.select(hash_key(name).alias(f"{name}_id"), F.col(name))


def with_group(dimension: DataFrame, name: str, group: Column, group_name: str) -> DataFrame:
    """Add a coarser attribute and its own key."""
    return dimension.withColumn(group_name, group).withColumn(f"{group_name}_id", hash_key(group_name))


def standard_country(df: DataFrame, countries: DataFrame, text: str, search: str,
                     values: Sequence[str], flag: str, flag_default: str) -> DataFrame:
    """Case-blind country lookup with a default for the privacy flag."""
    lookup = countries.select(
        F.upper(F.col(search)).alias("_search"), *[F.col(v) for v in values], F.col(flag).alias("_flag")
    ).dropDuplicates(["_search"])
    return (
        df.join(lookup, F.upper(F.col(text)) == F.col("_search"), "left")
        .withColumn(flag, F.coalesce("_flag", F.lit(flag_default)))
        .drop("_search", "_flag")
    )


def with_keys(df: DataFrame, columns: Sequence[str], unknown: str = "Unknown") -> DataFrame:
    """Replace nothing, add ``<column>_id`` for a BI fact."""
    return df.withColumns({f"{c}_id": hash_key(F.coalesce(F.col(c), F.lit(unknown))) for c in columns})


def last_refresh(sources: dict[str, tuple[DataFrame, str]], from_zone: str, to_zone: str) -> DataFrame:
    """Newest timestamp of each source, in another time zone."""
    rows = [
        df.agg(F.max(F.col(c).cast("timestamp_ntz")).alias("_at")).select(
            F.lit(name).alias("source"),
            F.convert_timezone(F.lit(from_zone), F.lit(to_zone), F.col("_at")).alias("refreshed_at"))
        for name, (df, c) in sources.items()
    ]
    return union_relations(*rows)
