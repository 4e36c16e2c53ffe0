"""Landed files: CSV with any header, unseen files, evolving JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.conform import Target, conform

CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "nullValue": "", "emptyValue": "", "encoding": "UTF-8"}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False) -> DataFrame:
    """Quoted CSV with a header and a known schema; empty fields are NULL.

    ``path`` may be a glob on the file name. The schema is given, never inferred.
    ``multi_line`` allows line breaks inside quotes; such files are not split,
    so land them in pieces.
    """
    return spark.read.options(**CSV_OPTIONS, multiLine=multi_line).schema(schema).csv(path)


def read_csv_by_header(spark: SparkSession, path: str, spec: dict[str, Target]) -> DataFrame:
    """CSV whose header decides the column order; unknown columns are dropped,
    missing ones are NULL or the declared default, names match in any case.

    Only the header line is read to learn the columns; a byte-order mark at its
    start is removed.
    """
    raw = spark.read.options(**CSV_OPTIONS).csv(path)
    plain = raw.toDF(*[c.lstrip("\ufeff").strip() for c in raw.columns])
    return conform(plain, spec)


def with_file(df: DataFrame) -> DataFrame:
    """Keep the name and modification time of the file each row came from."""
    return df.withColumns({
        "file_name": F.col("_metadata.file_name"),
        "file_modified_at": F.col("_metadata.file_modification_time"),
    })


def unseen_paths(spark: SparkSession, folder: str, loaded: DataFrame, pattern: str = "*") -> list[str]:
    """Paths of the files in ``folder`` whose name the target does not hold yet.

    Files are listed, not read; the target is asked for its file names alone.
    The list is as long as what has newly landed.
    """
    listing = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path")
    named = listing.withColumn("file_name", F.element_at(F.split("path", "/"), -1))
    new = named.join(loaded.select("file_name").distinct(), "file_name", "left_anti")
    return sorted(row.path for row in new.collect())


def unseen_files(spark: SparkSession, folder: str, loaded: DataFrame, schema: T.StructType | str, fmt: str = "parquet",
                 pattern: str = "*") -> DataFrame:
    """Rows of files whose name the target does not hold yet; seen files stay unopened."""
    paths = unseen_paths(spark, folder, loaded, pattern)
    if not paths:
        return with_file(spark.read.schema(schema).format(fmt).load(folder)).limit(0)
    return with_file(spark.read.schema(schema).format(fmt).load(paths))


def newest_file(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """The most recently written file directly in ``folder`` (one row).

    Only file metadata is read; file contents stay unopened as the content
    column is pruned.
    """
    listing = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return (
        listing.select("path", "modificationTime", "length")
        .agg(F.max_by(F.struct("path", "modificationTime", "length"), F.struct("modificationTime", "path")).alias("f"))
        .select("f.*")
    )


def object_keys(df: DataFrame, json: str, most: int = 2000) -> list[str]:
    """Every top-level key of a JSON object column, sorted.

    Keys are made distinct by the executors; an object with more than ``most``
    is a map with keys of its users' making, not a record, and is refused.
    """
    keys = df.select(F.explode(F.expr(f"json_object_keys({json})")).alias("k")).distinct()
    found = sorted(row.k for row in keys.limit(most + 1).collect())
    if len(found) > most:
        raise ValueError(f"{json} has over {most} keys; read it as a map")
    return found


def json_to_columns(df: DataFrame, json: str, known: Sequence[str] = (), most: int = 2000) -> DataFrame:
    """One text column per key of a JSON object; keys not ``known`` are appended."""
    keys = [*known, *[k for k in object_keys(df, json, most) if k not in known]]
    parsed = df.withColumn("_map", F.from_json(json, T.MapType(T.StringType(), T.StringType())))
    return parsed.select(
        *[c for c in df.columns if c != json], *[F.col("_map")[k].alias(k) for k in keys])


def flat_columns(schema: T.StructType, path: str = "", name: str = "") -> list[Column]:
    """Leaf columns of a nested record: objects opened, arrays kept, scalars as text.

    Names join the levels with '_'; dots, colons and dashes become '_' too.
    """
    columns: list[Column] = []
    for field in schema.fields:
        here = f"{path}`{field.name}`"
        label = name + field.name.translate(str.maketrans(".:-", "___"))
        if isinstance(field.dataType, T.StructType):
            columns += flat_columns(field.dataType, f"{here}.", f"{label}_")
        elif isinstance(field.dataType, T.ArrayType):
            columns.append(F.when(F.size(F.col(here)) > 0, F.col(here)).alias(label))
        else:
            columns.append(F.col(here).cast("string").alias(label))
    return columns


def flatten_record(df: DataFrame, column: str) -> DataFrame:
    """Open a struct column into flat columns; empty lists become NULL."""
    schema = df.schema[column].dataType
    others = [F.col(c) for c in df.columns if c != column]
    return df.select(*others, *flat_columns(schema, f"`{column}`."))


def flatten_json(df: DataFrame, json: str, schema: T.StructType | str) -> DataFrame:
    """Parse a JSON text column with a schema and flatten it."""
    return flatten_record(df.withColumn("_r", F.from_json(json, schema)).drop(json), "_r")


def exploded_list(df: DataFrame, column: str) -> DataFrame:
    """Distinct rows, then one row per list element (NULL for an empty list)."""
    return df.dropDuplicates().withColumn(column, F.explode_outer(column))


def names_for_ids(df: DataFrame, ids: str, lookup: DataFrame, lookup_id: str, lookup_name: str,
                  row_id: str, name: str) -> DataFrame:
    """List of ids to the list of their names, in order; unknown ids stay as they are."""
    positions = df.select(row_id, F.posexplode(ids).alias("_pos", "_id"))
    names = lookup.select(F.col(lookup_id).alias("_lid"), F.col(lookup_name).alias("_name"))
    named = positions.join(names, F.col("_id") == F.col("_lid"), "left")
    lists = named.groupBy(row_id).agg(
        F.array_sort(F.collect_list(F.struct("_pos", F.coalesce("_name", F.col("_id").cast("string")).alias("n")))
                     ).alias("_list"))
    return df.join(lists, row_id, "left").withColumn(name, F.col("_list.n")).drop("_list")
