"""Plans: what is pushed into scans, what is split, what is never joined."""

import contextlib

import pytest
from pyspark.sql import functions as F

from tests.conftest import FOLDER
from tidemark.operators import joins, latest, period
from tidemark.queries import funds
from tidemark.queries.all import REGISTRY
from tidemark.session import SETTINGS, sized_settings


@contextlib.contextmanager
def settings(spark, **changes):
    names = {k.replace("__", "."): str(v) for k, v in changes.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hot_table(spark, rows=60000):
    """A third of the rows have key 0."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000)
    return spark.range(0, rows, 1, 8).select(key.alias("k"), F.col("id").alias("v"), F.sha2(F.col("id").cast("string"), 512).alias("pad"))


SKEW = {
    "spark__sql__autoBroadcastJoinThreshold": -1,
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "100KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": 2,
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "100KB",
    "spark__sql__shuffle__partitions": 16,
}


def test_hot_key_is_split_although_the_result_is_grouped_by_it(spark):
    with settings(spark, **{**SKEW, **{k.replace(".", "__"): v for k, v in SETTINGS.items()}}):
        facts = hot_table(spark)
        accounts = spark.range(5000).select(F.col("id").alias("account"), F.lit("x").alias("name"))
        out = facts.join(accounts, F.col("k") == F.col("account"), "left").groupBy("k").agg(F.count("pad").alias("n"))
        assert out.agg(F.sum("n")).first()[0] == 60000
        out.collect()
        assert "skew=true" in plan_of(out)


def test_full_outer_has_no_full_join(spark):
    with settings(spark, **SKEW):
        a = hot_table(spark, 6000).select("k", "v")
        b = spark.range(2500, 7500).select(F.col("id").alias("k"), F.lit(1).alias("w"))
        out = joins.full_outer(a, b, ["k"])
        assert "FullOuter" not in plan_of(out)
        direct = a.join(b, "k", "full")
        assert out.exceptAll(direct).count() == 0 and direct.exceptAll(out).count() == 0


def test_hot_key_latest_is_limited_in_the_map_tasks(spark):
    out = latest.latest_by(hot_table(spark), ["k"], "v")
    plan = plan_of(out)
    assert plan.count("WindowGroupLimit") == 2 and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert out.filter("k = 0").first().v == 59997


def test_windows_never_see_raw_groups(spark):
    # after the map-side limit a key has at most one row per task; ordinals run over distinct days
    daily = hot_table(spark).select("k", (F.col("v") % 30).alias("day"))
    plan = plan_of(latest.day_ordinal(daily, ["k"], "day", "n"))
    assert plan.index("Window ") < plan.rindex("HashAggregate")


@pytest.mark.parametrize("name, column, table", [
    ("weekly_revenue_by_region", "o_orderdate", "orders"), ("spend_by_week", "o_orderdate", "orders"), ("retained_quarters", "o_orderdate", "orders")])
def test_date_windows_reach_the_scan(spark, name, column, table):
    plan = plan_of(REGISTRY[name].run(spark, FOLDER))
    scan = next(line for line in plan.splitlines() if f"{table}.parquet" in line and "PushedFilters" in line)
    pushed = scan.split("PushedFilters: [", 1)[1].split("]", 1)[0]
    assert any(column in f for f in pushed.split(", ") if "Than" in f)


def test_scans_read_only_what_is_used(spark):
    plan = plan_of(REGISTRY["weekly_revenue_by_region"].run(spark, FOLDER))
    scan = next(line for line in plan.splitlines() if "lineitem.parquet" in line)
    assert "l_extendedprice" in scan and "l_shipdate" not in scan and "l_partkey" not in scan


def test_period_comparison_joins_nothing(spark):
    base = spark.createDataFrame([(8000, 1, "x", 1)], "qi int, week int, d string, m int")
    plan = plan_of(period.weekly_comparison(base, "qi", "week", ["d"], ["m"], "2024-03-20"))
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_sized_settings_scale_with_the_input():
    assert int(sized_settings(10**9)["spark.sql.shuffle.partitions"]) == 200
    assert int(sized_settings(100 * 10**12)["spark.sql.shuffle.partitions"]) > 100_000


def test_raw_claims_are_grouped_where_they_were_joined(spark):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1):
        plan = plan_of(REGISTRY["fund_raw_claims"].run(spark, FOLDER))
    # both sides of four joins; the groups need none of their own
    assert plan.count("Exchange hashpartitioning") == 8


def test_staged_rows_move_once(spark, tables):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1):
        lines = plan_of(funds.staged(tables, [], ["csn", "funded", "partner_type", "engagement_complete", "submission_gate_compliant"])).splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and "funded#" in line)
    above, joined = depth[at], []
    for i in reversed(range(at)):
        if depth[i] < above:
            above, joined = depth[i], [*joined, lines[i]] if "Join" in lines[i] else joined
    # deadline, gate and partner come in one join
    assert len(joined) == 1
