"""What the operators share: tables, tables written half-way, Arrow batches, offsets."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import fresh_folder

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # whole texts go to Python: few rows a batch, and few bytes where texts are long
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    # hot keys are split also where the join's partitioning would have been reused
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Settings the operators count on; the workers find this package by PYTHONPATH."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    return spark


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """The named columns of ``<folder>/<name>.parquet``; others are never read."""
    return prepare(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet").select(*columns)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder, and read again from there.

    Cuts the lineage: an executor lost later costs a read, not a recomputation.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def offsets(parts: DataFrame, part: str, *amounts: str) -> DataFrame:
    """For each partition number the sum of every amount in all partitions before it.

    ``parts`` has a row for each partition, so its one window task holds as many
    rows as there are partitions, however large the data.
    """
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(part, *(F.coalesce(F.sum(a).over(before), F.lit(0)).alias(f"{a}_before") for a in amounts))


def strings(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column as flat UTF-8 bytes and the n + 1 places where texts begin; null is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, places, data = column.buffers()
    at = np.frombuffer(places, np.int64)[column.offset: column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0]: at[-1]], at - at[0]


def batches_of(rows: Iterator[tuple], schema: pa.Schema, most: int = 1000, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches from row tuples, cut by rows and by the length of texts and lists in them."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, (str, bytes, list, np.ndarray)))
        if len(held) >= most or size >= most_bytes:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x ^= x >> np.uint64(shift)
            x *= np.uint64(factor)
        x ^= x >> np.uint64(31)
    return x
