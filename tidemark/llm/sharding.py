"""Contiguous shards of equal bytes, cut from global prefix sums of document sizes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import offsets, prepare, written


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the partition's number, the bytes and the rows before each row of the partition."""
    part, total, rows = TaskContext.get().partitionId(), 0, 0
    for b in batches:
        n = b.num_rows
        size = b.column("size").to_numpy(zero_copy_only=False)
        after = total + np.cumsum(size)
        yield pa.RecordBatch.from_arrays(
            [b.column("id"), b.column("size"), b.column("crc"), pa.array(np.full(n, part, np.int32)), pa.array(after - size), pa.array(np.arange(rows, rows + n))],
            names=["id", "size", "crc", "part", "bytes", "row"],
        )
        total, rows = int(after[-1]) if n else total, rows + n


def byte_shards(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, size, text_crc32, shard and slot.

    Documents are ordered by id, then by checksum and size; a document's size is
    the UTF-8 bytes of its text plus 1. Each partition of that order sums its
    bytes; the totals of the partitions before it turn these into global sums.
    A document goes to the shard in whose equal share of all bytes its middle
    byte lies, so shards are contiguous runs and each misses its target by less
    than the two documents at its ends. Slots count from 0 without gaps.

    Null texts have size 1 and the checksum of no bytes; null ids come first;
    equal ids, and equal rows, are told apart by a salt drawn per input row, so
    that one id with a third of all rows still spreads over partitions. With
    fewer documents than shards, or one very long text, some shards are empty;
    an empty table gives no rows. Other columns are ignored.
    """
    spark = prepare(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    sized = docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("crc"), F.rand(10).alias("salt"))
    keys = ["id", "crc", "size", "salt"]
    kind = dict(sized.dtypes)["id"]
    run = written(
        sized.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .mapInArrow(_running, f"id {kind}, size long, crc long, part int, bytes long, row long"), "byte-shards")
    before = written(
        offsets(run.groupBy("part").agg(F.sum("size").alias("all_bytes"), F.count("*").alias("all_rows")), "part", "all_bytes", "all_rows"), "byte-shard-offsets")
    total = run.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    place = F.col("bytes") + F.col("all_bytes_before")
    middle = (place * 2 + F.col("size")) * shards
    placed = run.join(before, "part").select(
        "id", "size", F.col("crc").alias("text_crc32"), (F.col("row") + F.col("all_rows_before")).alias("at"),
        F.expr(f"({2 * total}L)").alias("whole"), middle.alias("middle"),
    ).select("id", "size", "text_crc32", "at", F.expr("cast(middle div whole as int)").alias("shard"))
    first = placed.groupBy("shard").agg(F.min("at").alias("first"))
    return placed.join(first, "shard").select(F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("at") - F.col("first")).alias("slot"))
