"""Data checks: one result row per check, and samples of what failed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fiscal
from tidemark.operators.conform import union_relations


def _result(df: DataFrame, name: str, failures: Column | str = "failures") -> DataFrame:
    failures = F.col(failures) if isinstance(failures, str) else failures
    return df.select(
        F.lit(name).alias("check_name"),
        F.when(failures == 0, "pass").otherwise("fail").alias("status"),
        failures.cast("bigint").alias("failures"),
    )


def row_checks(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Any number of per-row rules in one scan.

    A rule says what holds; rows where it is not true (also NULL) fail. Build
    rules with ``present``, ``one_of``, ``between`` or any boolean column.
    """
    names = list(rules)
    counts = df.agg(*[
        F.count(F.when(~F.coalesce(rule, F.lit(False)), 1)).alias(f"_{i}") for i, rule in enumerate(rules.values())])
    entries = F.explode(F.array(*[
        F.struct(F.lit(n).alias("name"), F.col(f"_{i}").alias("failures")) for i, n in enumerate(names)]))
    rows = counts.select(entries.alias("e")).select("e.name", "e.failures")
    return rows.select(
        F.col("name").alias("check_name"),
        F.when(F.col("failures") == 0, "pass").otherwise("fail").alias("status"),
        F.col("failures").cast("bigint").alias("failures"),
    )


def present(column: str) -> Column:
    return F.col(column).isNotNull()


def one_of(column: str, values: Sequence, where: Column | None = None) -> Column:
    """Accepted values; NULL passes, as do rows outside ``where``."""
    ok = F.col(column).isNull() | F.col(column).isin(list(values))
    return ok if where is None else (~F.coalesce(where, F.lit(False)) | ok)


def between(column: str, low, high) -> Column:
    return F.col(column).isNull() | F.col(column).between(low, high)


def unique(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_times")).filter(F.col("_times") > 1)
    return _result(repeated.agg(F.count(F.lit(1)).alias("failures")), name)


def not_empty(df: DataFrame, name: str) -> DataFrame:
    """Fails for an empty table; reads no more than the first row."""
    return _result(df.limit(1).agg((F.lit(1) - F.count(F.lit(1))).alias("failures")), name)


def recent(df: DataFrame, name: str, day: str, as_of, days: int = 90) -> DataFrame:
    newest = df.agg(F.max(F.col(day).cast("date")).alias("newest"))
    late = F.coalesce(F.datediff(fiscal.as_date(as_of), "newest") > days, F.lit(True))
    return _result(newest.select(late.cast("int").alias("failures")), name)


def loaded_today(df: DataFrame, name: str, day: str, as_of) -> DataFrame:
    """The freshness gate: at least one row dated ``as_of``."""
    today = df.agg(F.max((F.col(day).cast("date") == fiscal.as_date(as_of)).cast("int")).alias("hit"))
    return _result(today.select((F.lit(1) - F.coalesce("hit", F.lit(0))).alias("failures")), name)


def single_value(df: DataFrame, name: str, keys: Sequence[str], column: str) -> DataFrame:
    """Groups with more than one distinct value (minimum differs from maximum)."""
    groups = df.groupBy(*keys).agg(F.min(column).alias("_low"), F.max(column).alias("_high"))
    return _result(groups.filter(F.col("_low") != F.col("_high")).agg(F.count(F.lit(1)).alias("failures")), name)


def disjoint(left: DataFrame, right: DataFrame, name: str, key: str) -> DataFrame:
    """Keys two sets share."""
    shared = left.select(key).distinct().join(right.select(key).distinct(), key, "left_semi")
    return _result(shared.agg(F.count(F.lit(1)).alias("failures")), name)


def related(child: DataFrame, parent: DataFrame, name: str, key: str, parent_key: str) -> DataFrame:
    """Child keys the parent lacks."""
    known = parent.select(F.col(parent_key).alias("_parent"))
    orphans = child.select(key).distinct().filter(F.col(key).isNotNull()).join(
        known, F.col(key) == F.col("_parent"), "left_anti")
    return _result(orphans.agg(F.count(F.lit(1)).alias("failures")), name)


def failing_rows(df: DataFrame, name: str, rule: Column, limit: int = 100) -> DataFrame:
    """Up to ``limit`` failing rows as JSON, for the result store."""
    bad = df.filter(~F.coalesce(rule, F.lit(False)))
    row = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    return bad.select(F.lit(name).alias("check_name"), row.alias("row_json")).orderBy("row_json").limit(limit)


def run_log(results: DataFrame, model: str, run_at: str) -> DataFrame:
    """Check results as log entries with a message."""
    return results.select(
        "check_name", F.lit(model).alias("model"), "status",
        F.when(F.col("status") == "pass", "ok").otherwise(
            F.concat(F.col("failures").cast("string"), F.lit(" failing"))).alias("message"),
        F.lit(run_at).cast("timestamp_ntz").alias("run_at"),
    )


def suite(*results: DataFrame) -> DataFrame:
    return union_relations(*results)
