"""Joins the domain needs beyond a plain equi-join.

No broadcast hint is given anywhere: Catalyst broadcasts a side whose measured
size is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles,
where adaptive execution splits the partitions of a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stored


def text_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left",
                   surrogate: str = "", exact: Sequence[str] = ()) -> DataFrame:
    """Join on text keys where NULL equals NULL (and equals ``surrogate``).

    Keys are coalesced before the join, so it stays a hash-partitioned
    equi-join; ``exact`` keys are compared as they are. Right-hand key columns
    are dropped.
    """
    def keyed(df: DataFrame, side: str) -> DataFrame:
        filled = {f"_{side}_{k}": F.coalesce(F.col(k), F.lit(surrogate)) for k in keys}
        return df.withColumns({**filled, **{f"_{side}_{k}": F.col(k) for k in exact}})

    every = [*exact, *keys]
    on = [F.col(f"_l_{k}") == F.col(f"_r_{k}") for k in every]
    joined = keyed(left, "l").join(keyed(right, "r").drop(*every), on, how)
    return joined.drop(*[f"_{side}_{k}" for side in "lr" for k in every])


def normalised(left: DataFrame, right: DataFrame, left_key: Column, right_key: Column,
               how: str = "left") -> DataFrame:
    """Join on computed keys (trimmed, lower-cased, padded …)."""
    a = left.withColumn("_l_key", left_key)
    b = right.withColumn("_r_key", right_key)
    return a.join(b, F.col("_l_key") == F.col("_r_key"), how).drop("_l_key", "_r_key")


def lookup_twice(df: DataFrame, lookup: DataFrame, lookup_key: str, first: str, second: str,
                 values: Sequence[str]) -> DataFrame:
    """Fill ``values`` from the lookup by ``first``, else by ``second``.

    The lookup must have one row per key.
    """
    def side(prefix: str) -> DataFrame:
        return lookup.select(F.col(lookup_key).alias(f"_{prefix}"),
                             *[F.col(v).alias(f"_{prefix}_{v}") for v in values])

    a, b = side("a"), side("b")
    joined = (
        df.join(a, F.col(first) == F.col("_a"), "left")
        .join(b, F.col(second) == F.col("_b"), "left")
    )
    filled = {v: F.coalesce(F.col(f"_a_{v}"), F.col(f"_b_{v}")) for v in values}
    return joined.withColumns(filled).drop("_a", "_b", *[f"_{p}_{v}" for p in "ab" for v in values])


def without(left: DataFrame, right: DataFrame, left_key: Column | str, right_key: Column | str) -> DataFrame:
    """Rows of ``left`` whose key never occurs in ``right`` (NOT EXISTS)."""
    col = lambda c: F.col(c) if isinstance(c, str) else c
    keys = right.select(col(right_key).alias("_gone")).distinct()
    return left.withColumn("_key", col(left_key)).join(keys, F.col("_key") == F.col("_gone"), "left_anti").drop("_key")


def yes_never_no(df: DataFrame, key: str, yes: Column, no: Column) -> DataFrame:
    """Keys with at least one ``yes`` row and no ``no`` row; one aggregation."""
    return (
        df.groupBy(key)
        .agg(F.max(F.when(yes, 1).otherwise(0)).alias("_yes"), F.max(F.when(no, 1).otherwise(0)).alias("_no"))
        .filter((F.col("_yes") == 1) & (F.col("_no") == 0))
        .select(key)
    )


def full_outer(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """FULL JOIN with the key coalesced; NULL keys match nothing.

    Spark cannot split a hot key in a full join, but it can in an inner and in
    an anti join: the matches and the two rests are found separately. Each side
    is written once to the shared folder for that, so its own plan runs once and
    the rests read its keys alone. Rows with a NULL key would all hash to one
    task, so they bypass the joins.
    """
    left, right = stored(left), stored(right)

    def has_key() -> Column:
        cond = F.lit(True)
        for k in keys:
            cond = cond & F.col(k).isNotNull()
        return cond

    names = list(keys)
    a, b = left.filter(has_key()), right.filter(has_key())
    parts = [
        a.join(b.select(*names).distinct(), names, "left_anti"),
        b.join(a.select(*names).distinct(), names, "left_anti"),
        left.filter(~has_key()), right.filter(~has_key()),
    ]
    joined = a.join(b, names)
    for part in parts:
        joined = joined.unionByName(part, allowMissingColumns=True)
    return joined


def interval_join(facts: DataFrame, intervals: DataFrame, on: dict[str, str], when: str,
                  start: str, end: str, how: str = "left") -> DataFrame:
    """Attach the intervals whose [start, end] holds the fact's date.

    Besides the key, both sides are joined on the calendar month: each fact has
    one month, and each interval one row for every month it covers in which its
    key has a fact. A hot key is so spread over its months, a fact meets only
    that month's intervals, and intervals may be as long as they like, as no
    range of dates has to be known. The result is the plain range join's, with
    every match of overlapping intervals. Interval key columns (the values of
    ``on``) stay in the result.
    """
    months = facts.filter(F.col(when).isNotNull()).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(on)], F.trunc(F.col(when), "MM").alias("_month")).distinct()
    covered = (F.col("_month") >= F.trunc(F.col(start), "MM")) & (F.col("_month") <= F.col(end))
    for i, right_key in enumerate(on.values()):
        covered = covered & (F.col(right_key) == F.col(f"_k{i}"))
    bucketed = intervals.join(months, covered).drop(*[f"_k{i}" for i in range(len(on))])
    bucketed_facts = facts.withColumn("_fact_month", F.trunc(F.col(when), "MM"))
    cond = (
        (F.col("_fact_month") == F.col("_month"))
        & (F.col(when) >= F.col(start)) & (F.col(when) <= F.col(end))
    )
    for left_key, right_key in on.items():
        cond = cond & (F.col(left_key) == F.col(right_key))
    return bucketed_facts.join(bucketed, cond, how).drop("_fact_month", "_month")


def full_interval_join(facts: DataFrame, intervals: DataFrame, on: dict[str, str], dates: Sequence[str],
                       fact_id: str, interval_id: str, start: str, end: str) -> DataFrame:
    """FULL JOIN where any of several fact dates may fall into the interval.

    An OR over dates cannot be partitioned; one row per (fact, date) can. The
    pairs found are made distinct, then the unmatched rows of both sides added.
    """
    probes = facts.withColumn("_date", F.explode(F.array_distinct(F.array_compact(F.array(*dates)))))
    pairs = interval_join(probes, intervals, on, "_date", start, end, "inner").drop("_date")
    pairs = pairs.dropDuplicates([fact_id, interval_id])
    lonely_facts = facts.join(pairs.select(fact_id).distinct(), fact_id, "left_anti")
    lonely_intervals = intervals.join(pairs.select(interval_id).distinct(), interval_id, "left_anti")
    return (
        pairs.unionByName(lonely_facts, allowMissingColumns=True)
        .unionByName(lonely_intervals, allowMissingColumns=True)
    )


def asof_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str,
              values: Sequence[str]) -> DataFrame:
    """Attach to each left row the latest right row at or before its time.

    ``values`` are right-hand columns (none named as a left column); ties in
    time go to the greatest values. Rows are sorted by key and time into pieces of
    about equal size, wherever the busy keys and hours are: inside a piece a
    window runs over a key's rows; between pieces only one row per key and piece
    is carried forward, so a key's history never meets in one task.
    """
    touch = F.struct(F.col(right_time).alias("_at"), *[F.col(v) for v in values])
    touches = right.filter(F.col(key).isNotNull() & F.col(right_time).isNotNull()).select(
        F.col(key), F.col(right_time).alias("_t"), touch.alias("_touch"), F.lit(0).alias("_side"))
    probes = left.withColumns({"_t": F.col(left_time), "_side": F.lit(1)})
    rows = probes.unionByName(touches, allowMissingColumns=True)
    rows = stored(rows.repartitionByRange(key, "_t", "_side").withColumn("_bucket", F.spark_partition_id()))

    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        rows.filter(F.col(key).isNotNull())
        .groupBy(key, "_bucket").agg(F.max("_touch").alias("_top"))
        .withColumn("_carry", F.max("_top").over(before))
        .filter(F.col("_carry").isNotNull())
        .select(F.col(key).alias("_ckey"), F.col("_bucket").alias("_cbucket"), "_carry")
    )
    inside = Window.partitionBy(key, "_bucket").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    found = (
        rows.withColumn("_own", F.max("_touch").over(inside))
        .filter(F.col("_side") == 1)
        .join(carried, (F.col(key) == F.col("_ckey")) & (F.col("_bucket") == F.col("_cbucket")), "left")
        .withColumn("_hit", F.coalesce("_own", "_carry"))
    )
    return found.select(
        *[F.col(c) for c in left.columns],
        F.col("_hit._at").alias(f"matched_{right_time}"),
        *[F.col(f"_hit.{v}").alias(v) for v in values],
    )


def resolve_survivor(df: DataFrame, key: str, merges: DataFrame, master: DataFrame,
                     victim: str, survivor: str, account: str, name: str) -> DataFrame:
    """An id stays if it is current, else becomes its surviving id if that is.

    Which ids change is worked out on the merge table; the facts then need a
    single join against those few, instead of three against the master.
    """
    current = master.select(F.col(account).alias("_id")).distinct()
    pairs = merges.select(F.col(victim).alias("_from"), F.col(survivor).alias("_to")).distinct()
    changed = (
        pairs.join(current, F.col("_from") == F.col("_id"), "left_anti")
        .join(current, F.col("_to") == F.col("_id"), "left_semi")
    )
    return (
        df.join(changed, F.col(key) == F.col("_from"), "left")
        .withColumn(name, F.coalesce(F.col("_to"), F.col(key)))
        .drop("_from", "_to")
    )


def resolve_family(df: DataFrame, key: str, merges: DataFrame, parents: DataFrame,
                   victim: str, survivor: str, status: str, account: str, parent: str) -> DataFrame:
    """Survivor of an id (completed merges), its parent, and the parent's survivor.

    Adds ``survivor_id``, ``parent_id``, ``parent_survivor_id`` and ``final_id``
    (the last of the three that exists). Hops are chained on the account
    tables, so the facts are joined twice at most.
    """
    completed = merges.filter(F.col(status) == "COMPLETED").select(
        F.col(victim).alias("_victim"), F.col(survivor).alias("_survivor")).distinct()
    any_merge = merges.select(F.col(victim).alias("_pv"), F.col(survivor).alias("parent_survivor_id")).distinct()
    family = (
        parents.select(F.col(account).alias("_account"), F.col(parent).alias("parent_id"))
        .join(any_merge, F.col("parent_id") == F.col("_pv"), "left")
        .drop("_pv")
    )
    return (
        df.join(completed, F.col(key) == F.col("_victim"), "left")
        .withColumn("survivor_id", F.coalesce("_survivor", key))
        .join(family, F.col("survivor_id") == F.col("_account"), "left")
        .withColumn("final_id", F.coalesce("parent_survivor_id", "parent_id", "survivor_id"))
        .drop("_victim", "_survivor", "_account")
    )


def densify(df: DataFrame, dims: Sequence[str], periods: Column, period: str) -> DataFrame:
    """Every distinct dimension combination, once per period.

    ``periods`` is an array expression (a rule such as ``sequence``), so the
    combinations are multiplied row by row where they are; nothing is joined.
    """
    return df.select(*dims).distinct().withColumn(period, F.explode(periods))


def validity_intervals(changes: DataFrame, key: str, changed_at: str, opened: str,
                       first_from: str = "1990-01-01", valid_from: str = "valid_from",
                       valid_to: str = "valid_to") -> DataFrame:
    """Change times to intervals: each valid until the next, the first since 1990.

    ``changes`` holds one row per (key, change), e.g. an aggregated rate list.
    """
    window = Window.partitionBy(key).orderBy(F.col(changed_at), F.col(opened))
    return changes.withColumns({
        valid_to: F.lead(changed_at).over(window),
        valid_from: F.when(F.row_number().over(window) == 1, F.lit(first_from).cast("timestamp_ntz"))
        .otherwise(F.col(changed_at).cast("timestamp_ntz")),
    })
