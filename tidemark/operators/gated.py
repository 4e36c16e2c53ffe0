"""Checks made by the pass that writes, a log of every run, and a gate before readers.

A load is written as a version of its own. While its rows are written, Spark
observes what the rules ask for, so nothing is read twice. Only a version whose
rules hold is entered as published; readers see the last such version, before
and after a failed load alike.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import files

LOG = "run string, model string, check_name string, status string, failures bigint, rows bigint, message string, run_at timestamp_ntz"
VERSIONS = "run string, rows bigint, published_at timestamp_ntz"


@dataclass(frozen=True)
class Rule:
    """What holds for every row; ``warn`` only logs. A NULL result fails."""

    name: str
    holds: Column
    warn: bool = False
    allowed: int = 0  # so many failing rows are let pass


@dataclass(frozen=True)
class Outcome:
    """What a load came to."""

    published: bool
    rows: int
    failures: dict[str, int]



def run_log(spark: SparkSession, path: str) -> DataFrame:
    """Every check of every run of the table at ``path``."""
    log = f"{path.rstrip('/')}.log"
    return spark.read.schema(LOG).parquet(log) if files.exists(spark, log) else spark.createDataFrame([], LOG)


def published_versions(spark: SparkSession, path: str) -> DataFrame:
    kept = f"{path.rstrip('/')}.versions"
    return spark.read.schema(VERSIONS).parquet(kept) if files.exists(spark, kept) else spark.createDataFrame([], VERSIONS)


def publish(df: DataFrame, path: str, rules: list[Rule], run: str, run_at: str, least_rows: int = 1) -> Outcome:
    """Write ``df`` as version ``run`` of the table at ``path``; readers get it if no rule fails.

    All rules are counted while the rows are written, with the number of rows,
    which must be ``least_rows`` or more. Every check is logged under the run,
    passed or failed; a repeated run replaces its version and is logged again.
    The samples of a failed version are there to be looked at (``failing``).
    """
    spark = df.sparkSession
    seen = Observation(f"checks-{run}")
    counts = [F.count(F.when(~F.coalesce(r.holds, F.lit(False)), 1)).alias(f"r{k}") for k, r in enumerate(rules)]
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts).write.mode("overwrite").parquet(f"{path.rstrip('/')}/run={run}")
    found = seen.get
    failures = {r.name: found[f"r{k}"] for k, r in enumerate(rules)}
    rows = found["rows"]
    verdicts = [(r.name, "pass" if failures[r.name] <= r.allowed else "warn" if r.warn else "fail", failures[r.name]) for r in rules]
    verdicts.append(("rows", "pass" if rows >= least_rows else "fail", max(0, least_rows - rows)))
    good = all(status != "fail" for _, status, _ in verdicts)
    at = F.lit(run_at).cast("timestamp_ntz")
    model = path.rstrip("/").rsplit("/", 1)[-1]
    entries = spark.createDataFrame(
        [(run, model, name, status, n, rows, "ok" if status == "pass" else f"{n} failing") for name, status, n in verdicts],
        "run string, model string, check_name string, status string, failures bigint, rows bigint, message string").withColumn("run_at", at)
    entries.coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}.log")
    if good:
        version = spark.createDataFrame([(run, rows)], "run string, rows bigint").withColumn("published_at", at)
        version.coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}.versions")
    return Outcome(good, rows, failures)


def published(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the last published version; an error if there is none yet."""
    last = published_versions(spark, path).orderBy(F.desc("published_at"), F.desc("run")).first()
    if last is None:
        raise ValueError(f"nothing is published at {path}")
    return spark.read.parquet(f"{path.rstrip('/')}/run={last.run}")


def failing(spark: SparkSession, path: str, run: str, rule: Rule, limit: int = 100) -> DataFrame:
    """Up to ``limit`` rows of a version that break a rule, as JSON."""
    rows = spark.read.parquet(f"{path.rstrip('/')}/run={run}")
    bad = rows.filter(~F.coalesce(rule.holds, F.lit(False)))
    return bad.select(F.lit(rule.name).alias("check_name"), F.to_json(F.struct(*rows.columns)).alias("row_json")).orderBy("row_json").limit(limit)
