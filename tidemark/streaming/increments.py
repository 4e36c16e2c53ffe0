"""Incremental loading as a stream that stops when it has caught up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.latest import latest_by


def landed_stream(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet",
                  files_per_batch: int | None = None) -> DataFrame:
    """Files of a folder as a stream; the checkpoint remembers the seen ones."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def without_redelivery(stream: DataFrame, keys: Sequence[str], stamp: str, delay: str) -> DataFrame:
    """Drop a key delivered again within ``delay``; older state is released."""
    return stream.withWatermark(stamp, delay).dropDuplicatesWithinWatermark(list(keys))


def append_available(stream: DataFrame, target: str, checkpoint: str,
                     partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Append all that has landed and stop; run again to go on from there."""
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", target).option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def current_rows(appended: DataFrame, keys: Sequence[str], newest: str, *tiebreak: str) -> DataFrame:
    """The up-to-date view of an append-only table: its latest row per key."""
    return latest_by(appended, keys, newest, *tiebreak)
