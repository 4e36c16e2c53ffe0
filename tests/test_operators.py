"""Operators on small hand-made tables: NULLs, ties, overlaps, hot keys."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import fiscal, keys, numbers, text
from tidemark.operators import aggregates, conform, incremental, joins, latest, period, quality
from tidemark.operators.attribution import last_touch, trial_conversions
from tidemark.operators.conform import Target
from tidemark.operators.matching import match_countries
from tidemark.operators.smoothing import smoothed_rate
from tidemark.plans import calendar, lifecycle, partner_funds, revenue, traffic
from tidemark.queries import funds
from tidemark.queries.all import REGISTRY
from tidemark.sources import landing


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def day(text_value):
    return dt.date.fromisoformat(text_value)


# ---- scalar functions ------------------------------------------------------

def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def lit_day(value):
    return F.lit(value).cast("date")


def test_fiscal_borders(spark):
    r = one(spark, last=fiscal.quarter_label(lit_day("2024-01-31")), first=fiscal.quarter_label(lit_day("2024-02-01")),
            leap=fiscal.week(lit_day("2024-02-29")), begin=fiscal.quarter_begin(lit_day("2024-01-31")),
            back=fiscal.begin_of_index(fiscal.quarter_index(lit_day("2024-04-30"))), label=fiscal.label_of_index(fiscal.quarter_index(lit_day("2023-11-05"))))
    assert (r.last, r.first, r.leap) == ("FY24-Q4", "FY25-Q1", 5)
    assert (r.begin, r.back, r.label) == (day("2023-11-01"), day("2024-02-01"), "FY24-Q4")


def test_calendar_drops_the_unfinished_week(spark):
    table = calendar.fiscal_calendar(calendar.days(spark, "2023-01-01", "2024-12-31"), "2024-02-18")
    current = [r.date_key for r in table.filter("is_current_quarter = 1").collect()]
    assert max(current) == day("2024-02-14") and len(current) == 14
    assert table.filter("date_key >= DATE '2024-02-18'").count() == 0


def test_workdays(spark):
    r = one(spark, friday_to_monday=fiscal.workdays(lit_day("2024-03-01"), lit_day("2024-03-04")),
            weekend=fiscal.workdays(lit_day("2024-03-02"), lit_day("2024-03-03")), same=fiscal.workdays(lit_day("2024-03-04"), lit_day("2024-03-04")))
    assert tuple(r) == (1, 0, 0)


def test_text_and_numbers(spark):
    r = one(spark, n=numbers.whole_number(F.lit("1,234.5")), bad=numbers.whole_number(F.lit("n/a")), pct=numbers.percent(F.lit("40%")),
            pad=text.padded_id(F.lit(" 123.0")), long=text.padded_id(F.lit("123456789012")), cut=text.cut_suffix(F.lit("EMEA-GEO")), whole=text.cut_suffix(F.lit("EMEA")),
            parent=text.parent_name(F.lit("A_B_C_D")), alone=text.parent_name(F.lit("AB")), gone=text.null_if_any(F.lit("unknown"), ["UNKNOWN"], ignore_case=True),
            key=keys.hash_key(F.lit("Unknown")), none=text.strict_concat(F.lit("a"), F.lit(None)))
    assert (int(r.n), r.bad, int(r.pct)) == (1235, None, 40)
    assert (r.pad, r.long, r.cut, r.whole) == ("0000000123", "1234567890", "EMEA", "EMEA")
    assert (r.parent, r.alone, r.gone, r.key, r.none) == ("A_B", "AB", None, 433534, None)


def test_ratio_guards(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 3.0), (None, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(numbers.ratio("a", "b")).collect()] == [None, 0.3333, None]
    assert [r[0] for r in df.select(numbers.ratio("a", "b", null_on_zero=False)).collect()][0] == 0.0


def test_gate_and_fund_quarters(spark):
    gates = {"2021-03-01": "2022Q2", "2021-03-02": "2022Q2", "2021-03-03": "2022Q3", "2021-08-31": "2022Q4", "2021-09-01": "2023Q1",
             "2021-12-01": "2023Q2", "2021-01-15": "2022Q2"}
    for d, expected in gates.items():
        assert one(spark, g=fiscal.gate_quarter(lit_day(d))).g == expected
    assert one(spark, a=fiscal.fund_quarter(F.lit("1Q FY22 x"))).a == one(spark, a=fiscal.fund_quarter(F.lit("1QFY22 x"))).a == "2022Q1"


# ---- conform ---------------------------------------------------------------

def test_conform_defaults_and_case(spark):
    df = spark.createDataFrame([("7", "x")], "ID string, Name string")
    out = conform.conform(df, {"id": Target("bigint"), "label": Target("string", source="NAME"), "flag": Target("boolean", default=True), "gone": Target("date")})
    assert tuple(out.first()) == (7, "x", True, None)


# ---- latest ----------------------------------------------------------------

def test_latest_by_null_times_last(spark):
    df = spark.createDataFrame([(1, None, 9), (1, 5, 1), (1, 5, 2), (2, None, 3)], "k int, t int, v int")
    assert rows(latest.latest_by(df, ["k"], "t", "v")) == [(1, 5, 2), (2, None, 3)]


def test_latest_ties_and_null_keys(spark):
    df = spark.createDataFrame([(1, 5, 1), (1, 5, 2), (1, 4, 3), (None, None, 4), (None, None, 5)], "k int, t int, v int")
    assert [r[2] for r in rows(latest.latest_ties(df, ["k"], "t"))] == [1, 2, 4, 5]


def test_rank_filters_are_limited_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 1, 1)], "k int, t int, v int")
    plan = latest.latest_by(df, ["k"], "t", "v")._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_day_ordinal(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 3), ("b", 2)], "k string, d int")
    assert rows(latest.day_ordinal(df, ["k"], "d", "n")) == [("a", 1, 1), ("a", 1, 1), ("a", 3, 2), ("b", 2, 1)]


# ---- joins -----------------------------------------------------------------

def hot(seed, n=900):
    """Keys of which one holds a third of the rows."""
    rnd = random.Random(seed)
    return [("hot" if rnd.random() < 1 / 3 else f"k{rnd.randrange(40)}", rnd) for _ in range(n)]


def test_interval_join_equals_brute_force_with_a_hot_key(spark):
    start = day("2020-01-01")
    facts = [(k, start + dt.timedelta(days=r.randrange(400)), i) for i, (k, r) in enumerate(hot(1))]
    phases = []
    for i, (k, r) in enumerate(hot(2, 200)):
        a = start + dt.timedelta(days=r.randrange(-50, 400))
        phases.append((k, a, a + dt.timedelta(days=r.randrange(-2, 120)), f"p{i}"))
    f = spark.createDataFrame(facts, "k string, d date, id int")
    p = spark.createDataFrame(phases, "pk string, s date, e date, name string")
    got = rows(joins.interval_join(f, p, {"k": "pk"}, "d", "s", "e").select("id", "name"))
    expected = []
    for k, d, i in facts:
        matched = [n for pk, s, e, n in phases if pk == k and s <= d <= e]
        expected += [(i, n) for n in matched] or [(i, None)]
    assert got == sorted(expected, key=repr)


def test_full_interval_join(spark):
    f = spark.createDataFrame([(1, "a", day("2020-01-05"), day("2020-06-01")), (2, "a", None, None), (3, "c", day("2020-01-05"), None)],
                              "id int, k string, d1 date, d2 date")
    p = spark.createDataFrame([(10, "a", day("2020-01-01"), day("2020-12-31")), (11, "b", day("2020-01-01"), day("2020-12-31"))],
                              "pid int, pk string, s date, e date")
    out = joins.full_interval_join(f, p, {"k": "pk"}, ["d1", "d2"], "id", "pid", "s", "e").select("id", "pid")
    assert rows(out) == sorted([(1, 10), (2, None), (3, None), (None, 11)], key=repr)


def test_asof_join_equals_brute_force_with_a_hot_key(spark):
    base = dt.datetime(2024, 1, 1)
    left = [(k, base + dt.timedelta(minutes=r.randrange(3000)), i) for i, (k, r) in enumerate(hot(3))]
    right = [(k, base + dt.timedelta(minutes=r.randrange(3000)), i) for i, (k, r) in enumerate(hot(4, 300))]
    left.append((None, base, 99999))
    a = spark.createDataFrame(left, "k string, at timestamp_ntz, id int")
    b = spark.createDataFrame(right, "k string, t timestamp_ntz, touch int")
    got = rows(joins.asof_join(a, b, "k", "at", "t", ["touch"]).select("id", "touch"))
    expected = []
    for k, at, i in left:
        earlier = [(t, touch) for rk, t, touch in right if rk == k and t <= at]
        expected.append((i, max(earlier)[1] if earlier else None))
    assert got == sorted(expected, key=repr)


def test_full_outer_keeps_null_keys_apart(spark):
    a = spark.createDataFrame([(1, "x"), (None, "y")], "k int, a string")
    b = spark.createDataFrame([(1, "p"), (None, "q")], "k int, b string")
    assert rows(joins.full_outer(a, b, ["k"])) == sorted([(1, "x", "p"), (None, "y", None), (None, None, "q")], key=repr)


def test_survivors(spark):
    facts = spark.createDataFrame([(1,), (2,), (3,), (4,)], "id int")
    merges = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "victim int, survivor int")
    master = spark.createDataFrame([(1,), (20,), (4,)], "account int")  # 1 is current itself, 30 is not current
    out = joins.resolve_survivor(facts, "id", merges, master, "victim", "survivor", "account", "now")
    assert rows(out) == [(1, 1), (2, 20), (3, 3), (4, 4)]


def test_family_takes_completed_merges_first(spark):
    facts = spark.createDataFrame([(1,), (2,)], "id int")
    merges = spark.createDataFrame([(1, 5, "COMPLETED"), (2, 6, "PENDING"), (50, 51, "PENDING")], "victim int, survivor int, status string")
    parents = spark.createDataFrame([(5, 50), (2, 70)], "account int, parent int")
    out = joins.resolve_family(facts, "id", merges, parents, "victim", "survivor", "status", "account", "parent")
    assert rows(out.select("id", "survivor_id", "parent_id", "parent_survivor_id", "final_id")) == [(1, 5, 50, 51, 51), (2, 2, 70, None, 70)]


def test_yes_never_no(spark):
    df = spark.createDataFrame([(1, "Y"), (1, "N"), (2, "Y"), (3, "N"), (4, None)], "k int, f string")
    assert rows(joins.yes_never_no(df, "k", F.col("f") == "Y", F.col("f") == "N")) == [(2,)]


def test_text_null_safe(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, a int")
    b = spark.createDataFrame([("", 7), ("y", 8)], "k string, b int")
    assert rows(joins.text_null_safe(a, b, ["k"])) == sorted([(None, 1, 7), ("x", 2, None)], key=repr)


def test_validity_intervals_are_opened(spark):
    df = spark.createDataFrame([("EUR", dt.datetime(2020, 1, 1), 1), ("EUR", dt.datetime(2021, 1, 1), 2)], "c string, at timestamp_ntz, rate int")
    out = joins.validity_intervals(df, "c", "at", "rate").orderBy("at").collect()
    assert (out[0].valid_from, out[0].valid_to, out[1].valid_to) == (dt.datetime(1990, 1, 1), dt.datetime(2021, 1, 1), None)


# ---- aggregates ------------------------------------------------------------

def test_labelled_cube_tells_data_nulls_from_totals(spark):
    df = spark.createDataFrame([("g", None, 1), ("g", "x", 2)], "g string, d string, v int")
    out = aggregates.labeled_cube(df, ["g"], {"d": "D"}, [F.sum("v").alias("v")], "G")
    assert rows(out.select("d", "v", "aggregated_by")) == sorted([(None, 1, "G-D"), ("x", 2, "G-D"), (None, 3, "G")], key=repr)


def test_distinct_cube_equals_brute_force_with_a_hot_key(spark):
    data = [(k, f"d{r.randrange(3)}" if r.random() < 0.9 else None, r.randrange(60), r.random() < 0.5) for k, r in hot(5)]
    df = spark.createDataFrame(data, "k string, d string, id int, flag boolean")
    got = rows(aggregates.distinct_cube(df, [], {"k": "K", "d": "D"}, {"ids": ("id", F.lit(True)), "flagged": ("id", F.col("flag"))}, "ALL"))
    expected = []
    for use_k in (True, False):
        for use_d in (True, False):
            cells = {}
            for k, d, i, flag in data:
                ids, flagged = cells.setdefault((k if use_k else None, d if use_d else None), (set(), set()))
                ids.add(i)
                if flag:
                    flagged.add(i)
            label = "ALL" + ("-K" if use_k else "") + ("-D" if use_d else "")
            expected += [(k, d, label, len(a), len(b)) for (k, d), (a, b) in cells.items()]
    assert got == sorted(expected, key=repr)


def test_cube_total_equals_base_total(spark, tables):
    base = tables.orders.select("o_orderstatus", "o_orderpriority", F.lit(1).alias("n"))
    out = aggregates.labeled_cube(base, [], {"o_orderstatus": "S", "o_orderpriority": "P"}, [F.sum("n").alias("n")], "T")
    for label in ("T", "T-S", "T-P", "T-S-P"):
        assert out.filter(F.col("aggregated_by") == label).agg(F.sum("n")).first()[0] == base.count()


def test_equal_allocation_adds_up(spark):
    parts = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    totals = spark.createDataFrame([("a", 9), ("b", 4)], "k string, t int")
    out = aggregates.allocate_equally(parts, totals, ["k"], "t", "share")
    assert rows(out) == [("a", 4.5), ("a", 4.5), ("b", 4.0)]


# ---- periods ---------------------------------------------------------------

def test_weekly_comparison_equals_dense_grid(spark):
    as_of = "2024-03-20"  # FY25-Q1, 6 finished weeks
    this = 2025 * 4 + 1
    data = [(this, 1, "x", 5), (this - 1, 1, "x", 3), (this - 4, 1, "y", 2), (this - 1, 9, "x", 1), (this, 2, "z", 0)]
    base = spark.createDataFrame(data, "qi int, week int, d string, m int")
    out = period.weekly_comparison(base, "qi", "week", ["d"], ["m"], as_of)
    current = rows(out.filter(F.col("qi") == this).select("week", "d", "m", "qoq_m", "yoy_m"))
    # week 9 of this quarter is not finished, and z carries nothing but a zero
    assert current == sorted([(1, "x", 5, 3, None), (1, "y", None, None, 2)], key=repr)


def test_quarter_to_date_uses_equal_weeks(spark):
    as_of = "2024-03-20"
    this = 2025 * 4 + 1
    data = [(this, 1, "x", 5), (this - 1, 2, "x", 3), (this - 1, 9, "x", 4), (this - 2, 9, "x", 7)]
    base = spark.createDataFrame(data, "qi int, week int, d string, m int")
    out = period.quarterly_comparison(base, "qi", "week", ["d"], ["m"], as_of, F.lit(6))
    got = {r.qi: (r.m, r.qoq_m) for r in out.collect()}
    assert got[this] == (5, 3) and got[this - 1] == (7, 7)


def test_year_ratio(spark):
    df = spark.createDataFrame([(1, 2000, 10.0), (1, 2001, None), (1, 2002, 15.0)], "k int, y int, v double")
    assert [r.r for r in period.year_ratio(df, "k", "y", "v", "r").orderBy("y").collect()] == [0.0, None, 150.0]


# ---- increments ------------------------------------------------------------

def test_upsert_is_repeatable_and_equals_a_full_load(spark):
    old = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "k int, t int, v string")
    new = spark.createDataFrame([(2, 2, "c"), (2, 3, "d"), (3, 1, "e")], "k int, t int, v string")
    once = incremental.upsert(old, new, ["k"], "t")
    twice = incremental.upsert(once, new, ["k"], "t")
    assert rows(once) == rows(twice) == rows(latest.latest_by(old.union(new), ["k"], "t"))


def test_high_water_of_an_empty_target(spark):
    new = spark.createDataFrame([(1, day("2020-01-01"))], "k int, d date")
    assert incremental.after_high_water(new, new.limit(0), "d").count() == 1
    assert incremental.after_high_water(new, new, "d").count() == 0


def test_backfill_keeps_what_is_there(spark):
    target = spark.createDataFrame([("o 7", "old"), ("o 7", None), ("none", None)], "ref string, tier string")
    source = spark.createDataFrame([(7, "new")], "id int, tier string")
    out = incremental.backfill(target, source, F.regexp_extract("ref", "[0-9]+", 0), "id", ["tier"])
    assert rows(out) == sorted([("o 7", "old"), ("o 7", "new"), ("none", None)], key=repr)


# ---- quality ---------------------------------------------------------------

def test_checks_count_null_as_failure_where_it_should(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "n int, s string")
    out = {r.check_name: r.failures for r in quality.row_checks(df, {
        "n present": quality.present("n"), "s accepted": quality.one_of("s", ["a"]), "n positive": F.col("n") > 0}).collect()}
    assert out == {"n present": 1, "s accepted": 1, "n positive": 1}
    assert quality.not_empty(df.limit(0), "x").first().status == "fail"
    assert quality.unique(df.union(df), "u", ["n", "s"]).first().failures == 3


# ---- matching and smoothing ------------------------------------------------

COUNTRIES = [("AA", "AAA", "Albania", "Republic of Albania"), ("AD", "AND", "Andorra", "Principality of Andorra"),
             ("AE", "ARE", "United Arab Emirates", None), ("US", "USA", "United States", "United States of America"), ("GB", "GBR", "United Kingdom", None)]


def test_countries(spark):
    c = spark.createDataFrame(COUNTRIES, "a2 string, a3 string, name string, official string")
    asked = ["albania", "The Republic of Albania", "Andora", "UK", "ANDORRA (old)", "united", "zzzz", "USA", "us", "St. ", None]
    t = spark.createDataFrame([(a,) for a in asked], "t string")
    got = {r.t: (r.matched_code, r.score) for r in match_countries(t, "t", c, "a2", "a3", "name", "official").collect()}
    assert got["albania"] == ("AA", 143)  # equal, contained and nearest
    assert got["The Republic of Albania"] == ("AA", 143)
    assert got["Andora"] == ("AD", 45)
    assert got["united"] == ("AE", 48)    # a tie goes to the smallest code
    assert got["ANDORRA (old)"] == ("AD", 143)
    assert got["UK"] == (None, None)      # two letters are looked up as a code only
    assert (got["USA"], got["us"]) == (("US", None), ("US", None))
    assert got["zzzz"] == (None, None) and got["St. "] == (None, None) and None not in got


def test_countries_by_other_names(spark):
    rows_ = [("CI", "CIV", "Côte d'Ivoire", "Republic of Côte d'Ivoire", None, "384"), ("VN", "VNM", "Viet Nam", "Socialist Republic of Viet Nam", "Vietnam", "704"), ("VE", "VEN", "Venezuela, Bolivarian Republic of", None, "Venezuela", "862")]
    c = spark.createDataFrame(rows_, "a2 string, a3 string, name string, official string, common string, n string")
    subs = spark.createDataFrame([("VE", "VE-J", "Guárico;Guarico State", "State"), ("VE", "VE-A", "Distrito Capital", "District"), ("CI", "CI-AB", "Abidjan", None)], "c string, k string, name string, kind string")
    asked = ["Cote d'Ivoire", "Vietnam", "guarico", "Guarico State", "0704", "704x", "Venezuela", "Abidjan", "District"]
    t = spark.createDataFrame([(a,) for a in asked], "t string")
    out = match_countries(t, "t", c, "a2", "a3", "name", "official", subs, "c", ("k", "name", "kind"), "common", "n")
    got = {r.t: (r.matched_code, r.score) for r in out.collect()}
    assert got["Cote d'Ivoire"] == ("CI", 93) and got["Vietnam"] == ("VN", 95)  # without accents; a common name, and one edit from the name
    assert got["guarico"] == ("VE", 49) and got["Guarico State"] == ("VE", 49) and got["District"] == ("VE", 49)
    assert got["0704"][0] is None and got["704x"][0] is None and got["Abidjan"] == ("CI", 49) and got["Venezuela"] == ("VE", 143)


def test_smoothing_equals_brute_force(spark):
    rnd = random.Random(7)
    bins = [(g, b, rnd.randrange(5), rnd.randrange(6)) for g, n in (("a", 60), ("b", 3), ("c", 1)) for b in range(n)]
    df = spark.createDataFrame(bins, "g string, bin int, hits int, total int")
    got = {(r.g, r.bin): r.smooth_rate for r in smoothed_rate(df, ["g"], "bin", "hits", "total").collect()}
    for g in "abc":
        rates = [(h / t if t else 0.0) for gg, _, h, t in bins if gg == g]
        n = len(rates)
        for i in range(n):
            total = weight = 0.0
            for d in range(-40, 41):
                m = (i + d) % (2 * n)
                w = math.exp(-0.5 * d * d / 100.0)
                total += w * rates[m if m < n else 2 * n - 1 - m]
                weight += w
            assert got[(g, i)] == pytest.approx(total / weight, rel=1e-9)


# ---- rules that only show on the odd row -----------------------------------

def test_interval_join_far_outside_any_range(spark):
    facts = spark.createDataFrame([(1, "k", day("1901-05-05")), (2, "k", day("2024-01-31")), (3, "k", day("2099-12-31")), (4, "k", None), (5, None, day("2024-01-31"))], "id int, k string, d date")
    spans = spark.createDataFrame([("k", "open", day("2024-01-31"), day("9999-12-31")), ("k", "old", day("0001-01-01"), day("1999-01-01")), ("k", "none", day("2030-01-01"), None)], "pk string, name string, s date, e date")
    got = joins.interval_join(facts, spans, {"k": "pk"}, "d", "s", "e")
    assert sorted((r.id, r.name or "-") for r in got.collect()) == [(1, "old"), (2, "open"), (3, "open"), (4, "-"), (5, "-")]


def test_seat_days_are_numbered_before_days_without_seats_go(spark):
    rows_ = [("2024-01-01", 5), ("2024-01-02", 0), ("2024-01-03", 5), ("2024-01-04", 5)]
    seats = spark.createDataFrame([(day(d), "t", n, n) for d, n in rows_], "d date, t string, bought int, assigned int")
    used = spark.createDataFrame([(day("2024-01-04"), "t", 1)], "d date, t string, u int")
    out = lifecycle.seat_rate(seats, used, ["t"], ["t"], "d", "bought", "assigned", "u", every=2)
    assert [(str(r.d), r.day_bucket, r.seats_used) for r in out.collect()] == [("2024-01-04", 4, 1.0)]


def test_renewals_start_with_a_whole_quarter(spark):
    assert spark.range(1).select(lifecycle.renewal_window_start("2001-07-15")).first()[0] == day("2000-02-01")


def test_net_new_counts_as_new_customers(spark):
    sales = spark.createDataFrame([("Core", None, None, 10.0, 1.0, 2.0, 4.0)], "source string, kind string, phase string, amount double, new double, expansion double, net_new double")
    out = revenue.source_measures(sales, ["source"], "amount", "source", "kind", "phase", "new", "expansion", "net_new").first()
    assert (float(out.new_business), float(out.new_customer)) == (3.0, 5.0)


def test_form_attempts_and_empty_links_are_interactions(spark):
    hits = spark.createDataFrame([(1, "view", "x", None), (2, "view", "", None), (3, "view", None, 1), (4, "view", None, 0), (5, "pdf-click", "x", None)], "id int, e string, l string, a int")
    out = traffic.hit_flags(hits.withColumn("p", F.lit("page")), traffic.TrafficRules(), "p", "e", "l", "a")
    assert [r.bounce_page for r in out.orderBy("id").collect()] == [1, 0, 0, 1, 0]


def test_a_parents_active_contract_steps_in_for_an_untyped_one(spark):
    accounts = spark.createDataFrame([("a", "p", "1", "A", "x"), ("b", "p", "2", "B", "x"), ("c", "q", "3", "C", "x")], "account_id string, parent_account_id string, customer_csn string, partner_name string, account_country string")
    contracts = spark.createDataFrame([
        ("a", False, 1, 1, 1, None, "Tier 9", "Active"), ("b", False, 1, 1, 1, "VAR", "Tier 2", "Expired"),
        ("p", False, 1, 1, 1, "VAR one", "Tier 1", "Active"), ("p", False, 2, 1, 1, "VAD", "Tier 3", "Expired"), ("q", False, 1, 1, 1, "VAR", "Tier 1", "Expired")],
        "contract_account string, is_deleted boolean, modified_at int, start_date int, end_date int, contract_type string, partner_tier string, status string")
    tiers = spark.createDataFrame([("x", "A")], "country string, gtm_tier string")
    out = partner_funds.partner_accounts(accounts, contracts, tiers)
    assert rows(out.select("customer_csn", "tier", "partner_type")) == [("1", "Tier 1", "VAR"), ("2", "Tier 2", "VAR"), ("3", None, None)]


def test_a_supplied_calendar_counts_weeks_its_own_way(spark):
    days_ = spark.createDataFrame([(day("2024-02-01"), "Q1", 7), (day("2024-02-02"), "Q1", 8)], "date_key date, q string, w int")
    facts = spark.createDataFrame([(1, day("2024-02-01")), (2, day("2024-02-03"))], "id int, d date")
    assert rows(calendar.by_day(facts, "d", days_, ["q", "w"]).select("id", "q", "w")) == [(1, "Q1", 7), (2, None, None)]
    weekly = spark.createDataFrame([("Q1", 8, 5), ("Q1", 9, 6)], "q string, w int, n int")
    assert rows(calendar.by_week(weekly, days_, "q", "w").select("n", "week_start")) == [(5, day("2024-02-02")), (6, None)]


def test_a_line_item_with_an_industry_is_taken(spark):
    stack = spark.createDataFrame([("p", 1, "k", "7")], "p string, t int, key string, id string")
    taxonomy = spark.createDataFrame([("k", "8")], "key string, v string")
    items = spark.createDataFrame([("8", None, "first"), ("8", "Media", "second"), ("7", "Other", "third")], "item string, industry string, name string")
    out = last_touch(stack, "p", "t", ["key", "id"], taxonomy, "key", "v", "id", items, "item", "industry")
    assert [(r.id, r.industry, r.name) for r in out.collect()] == [("8", "Media", "second")]


def test_seen_files_stay_unopened_and_untouched_partitions_unchanged(spark, tmp_path):
    landed = str(tmp_path / "landed")
    spark.range(3).coalesce(1).write.parquet(landed)
    landing.with_file(spark.read.parquet(landed)).write.parquet(str(tmp_path / "loaded"))
    loaded = spark.read.parquet(str(tmp_path / "loaded"))
    spark.range(3, 5).coalesce(1).write.mode("append").parquet(landed)
    new = landing.unseen_files(spark, landed, loaded, "id bigint", pattern="*.parquet")
    assert sorted(r.id for r in new.collect()) == [3, 4] and len(new.inputFiles()) == 1
    again = landing.unseen_files(spark, landed, loaded.unionByName(new), "id bigint", pattern="*.parquet")
    assert again.count() == 0
    table = str(tmp_path / "table")
    spark.createDataFrame([(1, "a", 1, "x"), (2, "b", 1, "x")], "k int, d string, t int, v string").write.partitionBy("d").parquet(table)
    before = sorted(p.name for p in (tmp_path / "table" / "d=a").iterdir())
    batch = spark.createDataFrame([(2, "b", 2, "y"), (3, "b", 2, "z")], "k int, d string, t int, v string")
    for _ in range(2):
        incremental.upsert_partitions(table, batch, ["k", "d"], "d", "t")
        assert rows(spark.read.parquet(table).select("k", "d", "v")) == [(1, "a", "x"), (2, "b", "y"), (3, "b", "z")]
    assert sorted(p.name for p in (tmp_path / "table" / "d=a").iterdir()) == before


def test_a_map_is_no_record(spark):
    df = spark.createDataFrame([(f'{{"k{i}": 1}}',) for i in range(9)], "j string")
    assert len(landing.object_keys(df, "j", 9)) == 9
    with pytest.raises(ValueError):
        landing.object_keys(df, "j", 8)


# ---- trials ----------------------------------------------------------------

def test_conversion_window_of_ninety_days(spark):
    trials = spark.createDataFrame([("u", "AAX", day("2024-01-01"), day("2024-01-02"), "s1"), ("u", "BBX", day("2024-01-01"), day("2024-01-05"), "s2")],
                                   "tu string, product string, entitled date, activated date, sub string")
    orders = spark.createDataFrame([("o1", "u", day("2024-03-31"), "AAX"), ("o2", "u", day("2024-04-01"), "AAX"), ("o3", "u", day("2024-01-03"), "ZZZ")],
                                   "o string, u string, d date, p string")
    tier = F.when(F.col("product") == F.col("p"), 1).otherwise(4)
    out = trial_conversions(orders, trials, "u", "tu", "o", "d", "activated", "entitled", "sub", "product", tier)
    assert rows(out.filter("converted").select("o", "sub", "match_tier")) == [("o1", "s1", 1), ("o3", "s1", 4)]  # day 90 counts, day 91 does not
    assert rows(out.select("o", "sub", "match_rank", "converted")) == [("o1", "s1", 1, True), ("o1", "s2", 2, False), ("o3", "s1", 1, True)]


def test_an_order_of_several_products_takes_its_best_trial(spark):
    trials = spark.createDataFrame([("u", "AAX", day("2024-01-01"), day("2024-01-02"), "s1"), ("u", "BBX", day("2024-01-01"), day("2024-01-05"), "s2")],
                                   "tu string, product string, entitled date, activated date, sub string")
    orders = spark.createDataFrame([("o1", "u", day("2024-01-20"), "AAX"), ("o1", "u", day("2024-01-20"), "ZZZ"), ("o2", "u", day("2024-01-20"), "ZZZ")],
                                   "o string, u string, d date, p string")
    tier = F.when(F.col("product") == F.col("p"), 1).otherwise(4)
    out = trial_conversions(orders, trials, "u", "tu", "o", "d", "activated", "entitled", "sub", "product", tier)
    assert rows(out.filter("converted").select("o", "sub", "match_tier")) == [("o1", "s1", 1), ("o2", "s2", 4)]
    assert out.count() == 4 and out.filter("NOT converted").count() == 2


# ---- partner funds ---------------------------------------------------------

def test_claim_status_choice(spark):
    columns = "plan_id string, fund_name string, activity string, publication_name string, plan_status string, claim_status string, claim_submitted_date string, id int"
    claims = spark.createDataFrame([
        ("p1", "f", "a", "x", "Paid", "Cancelled", "09/01/2021", 1), ("p1", "f", "a", "x", "Paid", "Approved Claim", "01/01/2021", 2),
        ("p2", "f", "a", "x", "Paid", "Voided", None, 3), ("p3", "f", "a", None, "Paid", "Voided", None, 4),
        ("p4", "f", "a", "x", "Paid", "Voided", None, 5), ("p4", "g", "a", "x", "Paid", "Voided", None, 6)], columns)
    loose = [r.id for r in partner_funds.one_claim_status(claims).orderBy("id").collect()]
    strict = [r.id for r in partner_funds.one_claim_status(claims, strict=True).orderBy("id").collect()]
    assert loose == [2, 3, 5, 5, 6, 6]  # no publication drops out, two funds repeat each other's rows
    assert strict == [2, 3, 4, 5, 6]


def test_known_fiscal_years(spark):
    df = spark.createDataFrame([("1Q FY22 x",), ("1Q FY23 x",)], "fund_name string")
    every = [r[0] for r in df.select(partner_funds._fund_deadline(partner_funds.FundRules())).collect()]
    known = [r[0] for r in df.select(partner_funds._fund_deadline(partner_funds.FundRules(known_years=(2020, 2021, 2022)))).collect()]
    assert every == [day("2021-01-31"), day("2022-01-31")] and known == [day("2021-01-31"), None]


def test_answers_of_raw_claims(spark):
    keys = "plan_id string, plan_detail_id string, claim_number string, claim_detail_id string"
    heads = spark.createDataFrame([("P", "D", "1", "x"), ("P", "D", None, None), ("Q", "E", "2", None)], keys)
    shares = spark.createDataFrame([("P", "D", "1", "x", "A", "40%"), ("P", "D", "1", "x", "B", "60%"), ("P", "D", None, None, "C", "5%")], f"{keys}, campaign_name string, campaign_percentage string")
    given = [("5", "1,000"), ("5", "1000"), ("5", "-7"), ("1", "x"), ("2", "n/a"), ("2", "3"), ("12", "4"), ("99", "8"), (None, "8"), ("5:1", "9")]
    asked = spark.createDataFrame([("P", "D", "1", "x", q, a) for q, a in given] + [("Q", "E", "2", None, "8", None), ("Q", "E", "2", None, "3", "1")], f"{keys}, question_id string, answer string")
    out = partner_funds.raw_claims(heads, shares, asked)
    assert out.columns == [*heads.columns, "claim_link", "claim_detail_link", "campaign_name", "campaign_percentage", *partner_funds.MEASURES]
    assert {out.schema[m].dataType.simpleString() for m in partner_funds.MEASURES} == {"decimal(38,0)"}
    names = ["plan_id", "claim_number", "campaign_name", "mqls_actual", "mqls_expected", "clicks_expected", "clicks_actual"]
    got = sorted((tuple(None if v is None else str(v) for v in r) for r in out.select(*names).collect()), key=repr)
    assert got == sorted([("P", "1", "A", "993", "3", None, "4"), ("P", "1", "B", "993", "3", None, "4"), ("P", None, "C", None, "3", None, None), ("Q", "2", None, None, None, None, None)], key=repr)


def test_counted_raw_claims(spark):
    keys = "plan_id string, plan_detail_id string, claim_number string, claim_detail_id string"
    heads = spark.createDataFrame([("P", "D", None, None), ("Q", "E", None, None), ("Q", "E", "1", "x"), ("R", None, "2", "y")], keys)
    shares = spark.createDataFrame([("P", "D", None, None, "A", "40%"), ("P", "D", None, None, "B", "60%")], f"{keys}, campaign_name string, campaign_percentage string")
    given = [("P", "D", None, None, "12"), ("Q", "E", None, None, "14"), ("S", "F", None, None, "17"), ("Q", "E", "1", "x", "2"), ("Q", "E", None, None, "2"), ("Q", "E", None, None, "1")]
    asked = spark.createDataFrame([(*g, "7") for g in given], f"{keys}, question_id string, answer string")
    group = ["plan_id", "claim_number", "campaign_name"]
    plain = partner_funds.raw_claims(heads, shares, asked).groupBy(*group).count()
    counted = partner_funds.raw_claims(heads, shares, asked, counted="n")
    assert counted.columns == [*heads.columns, "claim_link", "claim_detail_link", "campaign_name", "campaign_percentage", "n"]
    expected = {("P", None, "A", 3), ("P", None, "B", 3), ("Q", None, None, 6), ("Q", "1", None, 2), ("R", "2", None, 1)}
    assert {tuple(r) for r in counted.select(*group, "n").collect()} == {tuple(r) for r in plain.collect()} == expected


def test_claims_meet_all_answers_without_a_claim(spark, tmp_path):
    at = dt.datetime(2000, 6, 1)
    tables = {
        "region": (["r_regionkey", "r_name"], [(0, "ASIA")]), "nation": (["n_nationkey", "n_name", "n_regionkey"], [(0, "JAPAN", 0)]),
        "customer": (["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"], [(c, "n", 0, 1.0, "x") for c in (0, 5, 10)]),
        "orders": (["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"], [(k, c, 9.0, at) for k, c in ((10, 0), (20, 5), (40, 10))]),
        "lineitem": (["l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity"], [(k, n, 9.0, 1.0) for k in (10, 20, 40) for n in range(1, 6)])}
    for name, (columns, rows) in tables.items():
        spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/{name}.parquet")
    out = REGISTRY["fund_claim_status"].run(spark, str(tmp_path))
    # two campaigns each; the answers of all three
    assert {r.k: r.copies for r in out.collect()} == {10: 6, 20: 6, 40: 6}


def test_headers_are_staged_before_they_are_repeated(spark, tables):
    names = partner_funds.STAGED
    account, contract, tier = funds.partner_tables(tables)
    last = partner_funds.stage(partner_funds.one_claim_status(funds.broken(tables)), partner_funds.partner_accounts(account, contract, tier), tier, funds.RULES)
    first = funds.staged(tables, partner_funds.MEASURES, names)
    assert first.columns == last.columns == names and first.dtypes == last.dtypes
    assert first.exceptAll(last).isEmpty() and last.exceptAll(first).isEmpty()
    few = ["partner_type", "csn", "funded", "quarter_link"]
    assert sorted(map(repr, funds.staged(tables, [], few).collect())) == sorted(map(repr, last.select(*few).collect()))


def test_stage_without_plan_customer_or_fund(spark):
    by, late = "01/31/2000 12:00:00 AM", "02/28/2000 12:00:00 AM"
    texts = ["plan_id", "customer_id", "fund_name", "claim_submitted_date", "claim_number"]
    given = [("P", "1", "1QFY00 MDF", by, "a"), ("P", "1", "1QFY00 MDF", late, "b"), (None, "1", "1QFY00 MDF", by, "c"), ("Q", None, "1QFY00 MDF", by, "d"),
             ("Q", "1", None, by, "e"), ("Q", "1", "1QFY00 MDF", by, "f")]
    claims = spark.createDataFrame(given, ", ".join(f"{c} string" for c in texts)).selectExpr(
        "*", "'Paid' AS plan_status", "'10' AS approved_amount", "CAST(40 AS DECIMAL(38,0)) AS campaign_percentage", "'Pending Claim' AS claim_audit_status",
        f"'{by}' AS claim_by_date", "'01/01/1999 x' AS plan_submission_date", "CAST(NULL AS STRING) AS target_country", "'d' AS plan_detail_id", "'x' AS claim_detail_id")
    partners = spark.createDataFrame([("0000000001", "A", "T", "VAR", "B"), ("0000000001", "Z", "T", "VAR", "B")], "customer_csn string, partner_name string, tier string, partner_type string, gtm_tier string")
    tiers = spark.createDataFrame([], "country string, gtm_tier string")
    names = ["fund_request", "csn", "partner_name", "gtm_tier", "funded", "engagement_complete", "submission_gate_compliant"]
    out = [tuple(r) for r in partner_funds.stage(claims, partners, tiers, funds.RULES, names).collect()]
    expected = []
    for plan, customer, fund, _, _ in given:
        for partner in ("A", "Z") if customer else (None,):
            complete = {"P": "No", "Q": "Yes"}.get(plan)  # P's newest claim is late
            expected.append((plan, customer, partner, "B" if customer else None, "4", complete, "Y" if customer and fund else None))
    assert sorted(((*r[:4], f"{r[4]:.0f}", *r[5:]) for r in out), key=repr) == sorted(expected, key=repr)
