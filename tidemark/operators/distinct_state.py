"""Distinct counts that can be added to: exact bitmaps per cell, stored by period.

A distinct count can not be added up, but the set behind it can be merged. For
every period and combination of dimensions the state holds each measure's set of
ids as bitmaps of 64 bits, one row of numbers for each range of ids that occurs, so
sets never take more rows than they have ids, however far these lie apart. Merging is
a bitwise OR, so a batch that is delivered again changes nothing, a late batch
only touches the periods it has rows for, and history is never read again from
the facts. Ids are whole numbers; give ids of another kind dense numbers first
(``operators.key_dictionary``), so that bitmaps are well filled.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.aggregates import grouping_label
from tidemark.session import stored
from tidemark.sources import files
from tidemark.sources.sinks import replace_partitions

ID_BITS = 6  # of an id, that say its place in a bitmap


def bitmaps(rows: DataFrame, keys: Sequence[str], counts: dict[str, tuple[str, Column]]) -> DataFrame:
    """The ids of each measure as bitmaps: ``keys``, bucket, a column for each measure.

    ``counts`` maps a measure to (id column, condition); NULL ids count nowhere.
    """
    columns = dict.fromkeys(column for column, _ in counts.values())
    entries = F.explode(F.array(*[
        F.struct(F.col(c).cast("bigint").alias("_id"), *[(condition if column == c else F.lit(False)).alias(m) for m, (column, condition) in counts.items()])
        for c in columns]))
    counted = F.coalesce(*[F.nullif(F.col(m), F.lit(False)) for m in counts], F.lit(False))
    ids = rows.select(*keys, entries.alias("_e")).select(*keys, "_e.*").filter(F.col("_id").isNotNull() & counted)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_id").bitwiseAND((1 << ID_BITS) - 1).cast("int"))
    return ids.groupBy(*keys, F.shiftright("_id", ID_BITS).alias("bucket")).agg(*[F.bit_or(F.when(F.col(m), bit)).alias(m) for m in counts])


def merged(state: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """States one upon the other: sets are united, whatever they have in common."""
    return state.groupBy(*keys, "bucket").agg(*_united(measures))


def _united(measures: Sequence[str]) -> list[Column]:
    return [F.bit_or(m).alias(m) for m in measures]


def _counted(measures: Sequence[str]) -> list[Column]:
    return [F.coalesce(F.sum(F.bit_count(m)), F.lit(0)).alias(m) for m in measures]


def add_to_state(path: str, rows: DataFrame, period: Sequence[str], dims: Sequence[str],
                 counts: dict[str, tuple[str, Column]]) -> DataFrame:
    """Unite a batch with the state stored at ``path``; returns the periods it touched.

    The state is partitioned by ``period``. The batch is read once; of the state
    only the touched periods are read and replaced, by one commit. Run again with
    the same batch, or with parts of it, it leaves every set as it was.
    """
    spark = rows.sparkSession
    keys = [*period, *dims]
    batch = stored(bitmaps(rows, keys, counts))
    touched = stored(batch.select(*period).distinct())
    old = _stored_state(spark, path, batch)
    if old is not None:
        known = old.join(touched, list(period), "left_semi")
        batch = stored(merged(known.select(*batch.columns).unionByName(batch), keys, list(counts)))
    replace_partitions(batch, path, list(period))
    return touched


def _stored_state(spark: SparkSession, path: str, like: DataFrame) -> DataFrame | None:
    """The state at ``path``; None before its first batch."""
    return spark.read.schema(like.schema).parquet(path) if files.exists(spark, path) else None


def cube_counts(state: DataFrame, fixed: Sequence[str], dims: dict[str, str], measures: Sequence[str], prefix: str,
                label: str = "aggregated_by") -> DataFrame:
    """Distinct counts over the labelled cube of ``dims`` within ``fixed``, from a state.

    Bitmaps are united up the lattice: each cell takes those of the finer cells
    below it, so ids are never expanded to cells. Then bits are counted.
    """
    keys = [*fixed, *dims]
    subsets = [list(c) for size in range(len(dims), -1, -1) for c in combinations(dims, size)]
    sets = [[F.col(c) for c in [*fixed, *kept, "bucket"]] for kept in subsets]
    united = state.groupingSets(sets, *[F.col(c) for c in [*keys, "bucket"]]).agg(*_united(measures), grouping_label(prefix, dims).alias(label))
    return united.groupBy(*keys, label).agg(*_counted(measures))


def counts_by(state: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Distinct counts per ``keys`` (periods or dimensions of the state), one column for each measure."""
    return merged(state, keys, measures).groupBy(*keys).agg(*_counted(measures))


def publish_cells(state_path: str, cells_path: str, touched: DataFrame, period: Sequence[str], fixed: Sequence[str],
                  dims: dict[str, str], measures: Sequence[str], prefix: str) -> None:
    """Replace the published cells of the touched periods by counts from the state; others stay as they are."""
    spark = touched.sparkSession
    state = spark.read.parquet(state_path).join(touched, list(period), "left_semi")
    cells = stored(cube_counts(state, [*period, *fixed], dims, measures, prefix))
    replace_partitions(cells, cells_path, list(period))


def compared_cells(cells_path: str, touched: DataFrame, quarter: str, week: str, keys: Sequence[str], measures: Sequence[str],
                   shifts: dict[str, int]) -> DataFrame:
    """The touched weeks' published cells beside the same week of earlier quarters.

    Only the touched weeks and those they are compared with are read: earlier
    weeks are looked up in the published counts, not counted anew. A missing
    earlier value falls back to the current one.
    """
    spark = touched.sparkSession
    lags = F.array(F.lit(0), *[F.lit(s) for s in shifts.values()])
    wanted = touched.select(F.col(week).alias("_week"), F.col(quarter).alias("_quarter"), F.explode(lags).alias("_lag"))
    wanted = wanted.withColumn("_from", F.col("_quarter") - F.col("_lag"))
    cells = spark.read.parquet(cells_path)
    met = cells.join(wanted, (F.col(quarter) == F.col("_from")) & (F.col(week) == F.col("_week")))
    now = F.col("_lag") == 0
    sums = [F.max(F.when(now, F.col(m))).alias(m) for m in measures]
    for name, lag in shifts.items():
        sums += [F.max(F.when(F.col("_lag") == lag, F.col(m))).alias(f"{name}_{m}") for m in measures]
    side = met.groupBy("_quarter", week, *keys).agg(F.max(now).alias("_here"), *sums).filter("_here").drop("_here")
    filled = {f"{s}_{m}": F.coalesce(f"{s}_{m}", m) for s in shifts for m in measures}
    return side.withColumns(filled).withColumnRenamed("_quarter", quarter)
