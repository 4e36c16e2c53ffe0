"""Session settings, the shared work folder and lineage cuts."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources import files

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split hot keys also where the join's partitioning would have been reused
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tidemark")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def sized_settings(input_bytes: int, shuffled_share: float = 0.5, partition_mb: int = 256) -> dict[str, str]:
    """Settings for a job over ``input_bytes``: partitions that fit a task.

    Shuffles start with as many partitions as the shuffled share needs at
    ``partition_mb`` each; adaptive execution merges those that turn out small.
    """
    size = partition_mb * 1024 * 1024
    partitions = max(200, int(input_bytes * shuffled_share / size) + 1)
    return {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(size),
        "spark.sql.files.maxPartitionBytes": str(size),
    }


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings results depend on (zone, adaptive plans)."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local master may fall back to a temporary folder: on a cluster a
    machine-local path would be lost with the machine. What the setting names is
    taken as shared, whatever its scheme: it may be a mounted folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if not folder and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="tidemark-"))
    return (folder or context.getCheckpointDir()).rstrip("/")


#: Folders of the runs that are open, the innermost last.
_RUNS: list[str] = []


@contextlib.contextmanager
def run_folders(spark: SparkSession) -> Iterator[str]:
    """What is written half-way inside this block lies in one folder, which goes when the block ends.

    Take or write results inside: frames that read half-way tables can not be
    read after it. Without such a block the folders stay until the application's
    owner clears the shared folder.
    """
    folder = f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"
    _RUNS.append(folder)
    try:
        yield folder
    finally:
        _RUNS.remove(folder)
        files.remove(spark, folder)


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder, or under that of the run."""
    return f"{_RUNS[-1] if _RUNS else shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and go on from there.

    For a result several branches read: executors may be lost without the
    branches recomputing the whole lineage, and each branch reads only its
    columns and pushes its filters into the scan.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, "stored")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
