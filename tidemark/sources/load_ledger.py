"""Loading landed files once, by a ledger of what was loaded.

The ledger has a row per file and load: path, size, modification time, rows,
checksum, state and run. Rows of a load lie in the target in a partition of
their own (``load_run``); a load counts once its ledger rows are there, so one
that died on the way is neither seen nor in the way. Files are matched to the
ledger by a join: no list of names is held by the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import stored
from tidemark.sources import files
from tidemark.sources.sinks import replace_partitions

LEDGER = "path string, size bigint, modified timestamp, rows bigint, checksum bigint, state string, load_run string"
FILE = ["path", "size", "modified"]


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """All entries, of every load."""
    if not files.exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def standing(spark: SparkSession, path: str) -> DataFrame:
    """The last entry of each file: what its rows in the target are."""
    newest = Window.partitionBy("path").orderBy(F.desc("modified"), F.desc("load_run"))
    return ledger(spark, path).withColumn("_at", F.row_number().over(newest)).filter("_at = 1").drop("_at")


def landed_files(spark: SparkSession, folder: str, pattern: str = "*", after: str | None = None) -> DataFrame:
    """Path, size and modification time of the files in a folder; the files stay unopened."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    reader = reader.option("modifiedAfter", after) if after else reader
    meta = {"path": "file_path", "size": "file_size", "modified": "file_modification_time"}
    return reader.load(folder).select(*[F.col(f"_metadata.{m}").alias(c) for c, m in meta.items()])


def unloaded(spark: SparkSession, folder: str, ledger_path: str, pattern: str = "*") -> DataFrame:
    """The files to load, new or changed under their old name: path, size, modified, state ('new' or 'changed')."""
    known = standing(spark, ledger_path)
    same = landed_files(spark, folder, pattern).join(known.select(*FILE), FILE, "left_anti")
    named = known.select(F.col("path").alias("_path")).distinct()
    return same.join(named, F.col("path") == F.col("_path"), "left").select(*FILE, F.when(F.col("_path").isNull(), "new").otherwise("changed").alias("state"))


def load_unseen(spark: SparkSession, folder: str, target: str, ledger_path: str, schema: T.StructType | str, run: str, fmt: str = "parquet", pattern: str = "*") -> int:
    """Load new and changed files of ``folder`` into ``target`` as load ``run``; returns the number of files.

    Rows keep the path, size and time of their file. The scan leaves out files
    older than the oldest one to load, and of the rest takes those that the
    ledger does not know, by a join on what the file is. What is written is
    counted and summed up per file from the target, and these entries make the
    load valid. A run that died before that is repeated under its name or
    another; files that a finished run loaded are no longer there to load.
    """
    # decided once: the entries written below are for the files that were read
    todo = stored(unloaded(spark, folder, ledger_path, pattern))
    after = todo.agg(F.date_format(F.min("modified") - F.expr("interval 2 seconds"), "yyyy-MM-dd'T'HH:mm:ss").alias("t")).first().t
    if after is None:
        return 0
    reader = spark.read.format(fmt).schema(schema).option("pathGlobFilter", pattern).option("modifiedAfter", after).option("timeZone", spark.conf.get("spark.sql.session.timeZone"))
    rows = reader.load(folder)
    columns = rows.columns
    marked = rows.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_size").alias("_size"), F.col("_metadata.file_modification_time").alias("_modified"))
    fresh = marked.join(todo.select(*[F.col(c).alias(f"_{c}") for c in FILE]), [f"_{c}" for c in FILE], "left_semi")
    replace_partitions(fresh.withColumn("load_run", F.lit(run)), target, ["load_run"])

    mine = spark.read.parquet(target).filter(F.col("load_run") == run)
    sums = mine.groupBy(*[F.col(f"_{c}").alias(c) for c in FILE]).agg(F.count(F.lit(1)).alias("rows"), F.bit_xor(F.xxhash64(*columns)).alias("checksum"))
    entries = todo.join(sums, FILE, "left").select(
        *FILE, F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("checksum", F.lit(0)).alias("checksum"), "state", F.lit(run).alias("load_run"))
    entries.write.mode("append").parquet(ledger_path)
    return todo.count()


def loaded_rows(spark: SparkSession, target: str, ledger_path: str) -> DataFrame:
    """The target's valid rows: of each file those of its last load, with ``file_path`` and ``load_run``."""
    rows = spark.read.parquet(target)
    valid = standing(spark, ledger_path).select(F.col("path").alias("_path"), "load_run", F.col("modified").alias("_modified"), F.col("size").alias("_size"))
    return rows.join(valid, ["_path", "load_run", "_modified", "_size"], "left_semi").withColumnRenamed("_path", "file_path").drop("_size", "_modified")
