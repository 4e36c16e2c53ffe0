"""Streams into a keyed, partitioned table: every batch counts once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.latest import latest_by
from tidemark.session import stored
from tidemark.sources import files
from tidemark.sources.sinks import replace_partitions

BATCHES = "batch bigint, rows bigint, changed bigint"


def batches_path(path: str) -> str:
    return f"{path.rstrip('/')}.batches"


def finished_batches(spark: SparkSession, path: str) -> DataFrame:
    """The ledger of batches that are wholly in the table."""
    if not files.exists(spark, batches_path(path)):
        return spark.createDataFrame([], BATCHES)
    return spark.read.schema(BATCHES).parquet(batches_path(path))


def merge_batch(path: str, batch: DataFrame, keys: Sequence[str], partition: str, newest: str, *tiebreak: str) -> DataFrame:
    """Merge rows into the table, the newest row of each key winning, in the partitions that the batch touches.

    ``partition`` is one of the keys. A row older than the stored one changes
    nothing, so the order in which batches arrive does not matter, and a
    repeated batch leaves every row as it was. Returns the merged batch's rows.
    """
    spark = batch.sparkSession
    mine = stored(latest_by(batch, keys, newest, *tiebreak))
    merged = mine
    if files.exists(spark, path):
        touched = mine.select(partition).distinct()
        held = spark.read.schema(mine.schema).parquet(path).select(*mine.columns).join(touched, partition, "left_semi")
        merged = stored(latest_by(held.unionByName(mine), keys, newest, *tiebreak))
    replace_partitions(merged, path, [partition])
    return mine


def into_table(path: str, keys: Sequence[str], partition: str, newest: str, *tiebreak: str,
               before_commit: Callable[[int], None] | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink: merge a batch, then enter its number in the ledger.

    A batch that the ledger knows is left out. One that died between the merge
    and its entry is merged again, which changes nothing. ``before_commit`` is
    called with the number in between, for what else belongs to the batch.
    """
    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if not finished_batches(spark, path).filter(F.col("batch") == number).isEmpty():
            return
        mine = merge_batch(path, batch, keys, partition, newest, *tiebreak)
        if before_commit:
            before_commit(number)
        entry = mine.agg(F.lit(number).cast("bigint").alias("batch"), F.count(F.lit(1)).alias("rows"), F.count_distinct(partition).alias("changed"))
        entry.coalesce(1).write.mode("append").parquet(batches_path(path))

    return write


def upsert_available(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], partition: str, newest: str, *tiebreak: str,
                     before_commit: Callable[[int], None] | None = None) -> StreamingQuery:
    """Merge all that has landed into the table and stop; run again to go on from there.

    The checkpoint remembers which files belong to which batch, the ledger which
    batches are in the table: together each row counts once, whenever a run dies.
    """
    query = (
        stream.writeStream.foreachBatch(into_table(path, keys, partition, newest, *tiebreak, before_commit=before_commit))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query
