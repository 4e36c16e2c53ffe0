"""Folders on whatever file system the path names, by Spark's own access to it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _open(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    system, folder = _open(spark, path)
    return system.exists(folder)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a folder with all it holds; False if there was none."""
    system, folder = _open(spark, path)
    return system.delete(folder, True)


# fixed values: characters that are written as %XX in names of partition folders
ESCAPED = frozenset([*map(chr, range(1, 32)), *"\"#%'*/:=?\\\x7f{[]^"])


def partition_path(path: str, **values) -> str:
    """The folder of one partition of a table, in the order of the given columns."""
    def name(value) -> str:
        text = str(value).lower() if isinstance(value, bool) else "" if value is None else str(value)
        return "".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in text) or "__HIVE_DEFAULT_PARTITION__"

    return "/".join([path.rstrip("/"), *(f"{c}={name(v)}" for c, v in values.items())])


def listing(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Name below ``path``, size and modification time (ms) of every file, data and others, in order."""
    system, folder = _open(spark, path)
    found, pending = [], [folder]
    while pending:
        for status in system.listStatus(pending.pop()):
            if status.isDirectory():
                pending.append(status.getPath())
            else:
                found.append((status.getPath().toString().split(folder.getName(), 1)[-1], status.getLen(), status.getModificationTime()))
    return sorted(found)


def place_file(df: DataFrame, folder: str, name: str, fmt: str = "parquet", **options) -> str:
    """Land ``df`` as one file of a given name, replacing one that is there; for small deliveries."""
    spark = df.sparkSession
    staging = f"{folder.rstrip('/')}.staging-{name}"
    df.coalesce(1).write.mode("overwrite").format(fmt).options(**options).save(staging)
    system, source = _open(spark, staging)
    part = next(s.getPath() for s in system.listStatus(source) if s.getPath().getName().startswith("part-"))
    system.mkdirs(_open(spark, folder)[1])
    target = _open(spark, f"{folder.rstrip('/')}/{name}")[1]
    system.delete(target, False)
    system.rename(part, target)
    system.delete(source, True)
    return f"{folder.rstrip('/')}/{name}"
