"""Add new data to stored data; every function is safe to repeat."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fiscal
from tidemark.operators.latest import latest_by
from tidemark.session import stored
from tidemark.sources.sinks import replace_partitions


def after_high_water(new: DataFrame, target: DataFrame, stamp: str, default: str = "1900-01-01") -> DataFrame:
    """Rows newer than the newest stored one; all of them for an empty target.

    The mark is a scalar subquery: one aggregated value, pushed into the scan.
    """
    kind = dict(new.dtypes)[stamp]
    mark = target.agg(F.coalesce(F.max(stamp), F.lit(default).cast(kind)).alias("mark")).scalar()
    return new.filter(F.col(stamp) > mark)


def upsert(target: DataFrame, new: DataFrame, keys: Sequence[str], newest: str, *tiebreak: str) -> DataFrame:
    """Delete the keys that come anew, then insert them.

    The new batch is reduced to its latest row per key first; columns either
    side lacks are NULL in the result (new columns are appended).
    """
    batch = latest_by(new, keys, newest, *tiebreak)
    kept = target.join(batch.select(*keys), list(keys), "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


def upsert_partitions(path: str, new: DataFrame, keys: Sequence[str], partition: str, newest: str, *tiebreak: str) -> None:
    """Upsert into a stored table, rewriting only the partitions that the batch touches.

    ``partition`` is one of the keys, the folder column of the table. The scan
    reads the touched partitions alone; the merged rows are written to the
    shared folder before the partitions are replaced, as a table can not be
    read while it is overwritten. Run again with the same batch it changes nothing.
    """
    spark = new.sparkSession
    batch = stored(latest_by(new, keys, newest, *tiebreak))
    target = spark.read.parquet(path)
    touched = batch.select(partition).distinct()
    kept = target.join(touched, partition, "left_semi").join(batch.select(*keys), list(keys), "left_anti")
    merged = stored(kept.unionByName(batch, allowMissingColumns=True))
    replace_partitions(merged, path, [partition])


def replace_where(target: DataFrame, new: DataFrame, condition: Column) -> DataFrame:
    """Delete the rows a reload covers (a day, a source code), then insert it."""
    return target.filter(~F.coalesce(condition, F.lit(False))).unionByName(new, allowMissingColumns=True)


def backfill(target: DataFrame, source: DataFrame, target_key: Column, source_key: str,
             columns: Sequence[str]) -> DataFrame:
    """Fill only the NULLs of ``columns`` from the source row with the key.

    ``source`` has one row per key.
    """
    fill = source.select(F.col(source_key).cast("string").alias("_sk"),
                         *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = target.withColumn("_tk", target_key.cast("string")).join(fill, F.col("_tk") == F.col("_sk"), "left")
    filled = joined.withColumns({c: F.coalesce(F.col(c), F.col(f"_new_{c}")) for c in columns})
    return filled.drop("_tk", "_sk", *[f"_new_{c}" for c in columns])


def within_retention(df: DataFrame, day: str, as_of, quarters: int) -> DataFrame:
    """Drop rows older than ``quarters`` fiscal quarters before the current one."""
    return df.filter(F.col(day) >= fiscal.window_start(as_of, quarters))


def since_days(df: DataFrame, day: str, as_of, days: int = 40) -> DataFrame:
    """A fixed look-back."""
    return df.filter(F.col(day) >= F.date_sub(fiscal.as_date(as_of), days))


def date_ranges(df: DataFrame, start: str, end: str, cutover: str | None = None) -> DataFrame:
    """Each [start, end] as its days with their Sunday-to-Saturday week.

    Days before ``cutover`` are clamped away, as old days live in another table.
    """
    first = F.greatest(F.col(start), F.lit(cutover).cast("date")) if cutover else F.col(start)
    days = F.when(first <= F.col(end), F.sequence(first, F.col(end))).otherwise(F.array())
    sunday, saturday = fiscal.sunday_week("day")
    return df.withColumn("day", F.explode(days)).withColumns({"week_from": sunday, "week_to": saturday})


def month_ranges(df: DataFrame, start: str, end: str) -> DataFrame:
    """Each [start, end] cut at month borders."""
    months = F.sequence(F.trunc(F.col(start), "MM"), F.trunc(F.col(end), "MM"), F.expr("interval 1 month"))
    return df.withColumn("_month", F.explode(months)).withColumns({
        "month_from": F.greatest(F.col("_month"), F.col(start)),
        "month_to": F.least(F.last_day("_month"), F.col(end)),
    }).drop("_month")
