"""Stored tables: what is written, what is left alone, what happens when a run is repeated or dies."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import distinct_state, gated, key_dictionary, stored_updates
from tidemark.operators.numbering import numbered
from tidemark.session import fresh_folder, run_folders, stored
from tidemark.sources import clustered, evolving, files, load_ledger, sinks, variants
from tidemark.streaming import increments, keyed


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def folder(spark):
    return fresh_folder(spark, "test")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- folders of a run ----------------------------------------------------------

def test_a_run_leaves_nothing_behind(spark):
    with run_folders(spark) as outer:
        kept = stored(spark.range(5))
        with run_folders(spark) as inner:
            assert fresh_folder(spark, "x").startswith(inner) and stored(spark.range(3)).count() == 3
        assert not files.exists(spark, inner) and files.exists(spark, outer) and kept.count() == 5
    assert not files.exists(spark, outer) and not fresh_folder(spark, "x").startswith(outer)
    with pytest.raises(ZeroDivisionError):
        with run_folders(spark) as folder:
            stored(spark.range(1))
            1 / 0
    assert not files.exists(spark, folder)


# ---- numbers -----------------------------------------------------------------

def test_numbered(spark):
    values = [(k % 7, k) for k in range(1000)]
    got = numbered(spark.createDataFrame(values, "a long, b long").repartition(5), "a", "b").collect()
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r["at"])] == sorted(values) and sorted(r["at"] for r in got) == list(range(1000))
    assert numbered(spark.createDataFrame([], "a long"), "a").count() == 0


# ---- distinct counts ---------------------------------------------------------

def counts():
    return {"all": ("id", F.lit(True)), "big": ("id", F.col("id") > 100_000)}


def visits(spark, data):
    return spark.createDataFrame(data, "week int, geo string, tier string, id long")


def test_state_equals_plain_counts_after_batches(spark, folder):
    import random
    rng = random.Random(3)
    data = [(rng.randrange(4), rng.choice("AB"), rng.choice(["x", "y", None]), rng.choice([rng.randrange(50), 100_000 + rng.randrange(80_000), None])) for _ in range(900)]
    state, cells = f"{folder}/state", f"{folder}/cells"
    for batch in (data[:300], data[300:600], data[200:500], data[600:], data[600:]):
        touched = distinct_state.add_to_state(state, visits(spark, batch), ["week"], ["geo", "tier"], counts())
        distinct_state.publish_cells(state, cells, touched, ["week"], ["geo"], {"tier": "T"}, list(counts()), "W")
    want = set()
    for w, g in {(w, g) for w, g, *_ in data}:
        for tier in {t for a, b, t, _ in data if (a, b) == (w, g)}:
            ids = {i for a, b, t, i in data if (a, b, t) == (w, g, tier) and i is not None}
            if ids:
                want.add((w, g, tier, "W-T", len(ids), sum(i > 100_000 for i in ids)))
        ids = {i for a, b, _, i in data if (a, b) == (w, g) and i is not None}
        if ids:
            want.add((w, g, None, "W", len(ids), sum(i > 100_000 for i in ids)))
    got = {(r.week, r.geo, r.tier, r.aggregated_by, r["all"], r.big) for r in spark.read.parquet(cells).collect()}
    assert got == want
    whole = distinct_state.counts_by(spark.read.parquet(state), ["geo"], ["all"])
    assert {(r.geo, r["all"]) for r in whole.collect()} == {(g, len({i for _, b, _, i in data if b == g and i is not None})) for g in "AB"}


def test_state_leaves_other_weeks_alone(spark, folder):
    state = f"{folder}/state"
    distinct_state.add_to_state(state, visits(spark, [(w, "A", "x", w) for w in range(5)]), ["week"], ["geo", "tier"], counts())
    before = files.listing(spark, state)
    distinct_state.add_to_state(state, visits(spark, [(3, "A", "x", 9), (7, "A", "x", 1)]), ["week"], ["geo", "tier"], counts())
    after = files.listing(spark, state)
    kept = [f for f in before if "week=" in f[0] and "week=3" not in f[0]]
    assert kept and all(f in after for f in kept) and any("week=7" in f[0] for f in after)
    distinct_state.add_to_state(state, visits(spark, []), ["week"], ["geo", "tier"], counts())
    assert spark.read.parquet(state).select("week").distinct().count() == 6


def test_state_of_ids_far_apart_is_no_larger_than_they_are(spark, folder):
    ids = [(k * 65_536 * (-1) ** k, k) for k in range(1, 400)] + [(63, 1), (64, 1), (-1, 2), (2**62, 2), (None, 3)]
    rows_ = visits(spark, [(0, "A", "x", i) for i, _ in ids] * 2)
    distinct_state.add_to_state(f"{folder}/state", rows_, ["week"], ["geo", "tier"], counts())
    state = spark.read.parquet(f"{folder}/state")
    size = sum(len(v) if isinstance(v, (bytes, bytearray, str)) else 8 for r in state.collect() for v in r)
    assert size <= 100 * len(ids)
    got = distinct_state.counts_by(state, ["week"], ["all", "big"]).first()
    assert got["all"] == len({i for i, _ in ids} - {None}) and got.big == sum(i is not None and i > 100_000 for i, _ in ids)


def test_measures_of_several_id_columns(spark):
    df = spark.createDataFrame([("a", 1, 70), ("a", 1, 71), ("a", 2, None), ("b", None, 70), ("c", 5, None)], "g string, x int, y long")
    state = distinct_state.bitmaps(df, ["g"], {"n": ("x", F.col("y").isNotNull()), "m": ("y", F.lit(True)), "u": ("x", F.col("y") == 0)})
    assert rows(distinct_state.counts_by(state, ["g"], ["n", "m", "u"])) == [("a", 1, 2, 0), ("b", 0, 1, 0)]


# ---- updates -----------------------------------------------------------------

def test_backfill_writes_only_what_it_fills(spark, folder):
    path = f"{folder}/t"
    data = [(1, "n 1", "p", None, "o"), (2, "n 2", "p", "kept", "o"), (3, "n 3", "q", None, None), (4, "none", "q", None, "o"), (5, "n 9", "r", None, "o"), (6, "n 1", "s", "kept", "o"), (7, "n 2", None, None, None)]
    schema = "id int, details string, part string, tier string, owner string"
    stored_updates.write_with_gaps(spark.createDataFrame(data, schema), path, "part", ["tier", "owner"])
    source = spark.createDataFrame([(1, "gold", None, 1), (3, "old", "x", 1), (3, "new", None, 2), (2, "two", "you", 1), (None, "none", "none", 1)], "k int, tier string, owner string, at int")
    before = files.listing(spark, path)

    def run():
        return stored_updates.backfill_stored(spark, path, source, F.nullif(F.regexp_extract("details", "[0-9]+", 0), F.lit("")), "k", ["tier", "owner"], "part", "at")

    assert run() == ["p", "q", None]
    got = {r.id: (r.tier, r.owner) for r in spark.read.parquet(path).collect()}
    assert got == {1: ("gold", "o"), 2: ("kept", "o"), 3: ("new", None), 4: (None, "o"), 5: (None, "o"), 6: ("kept", "o"), 7: ("two", "you")}
    after = files.listing(spark, path)
    same = [f for f in before if "part=r" in f[0] or "part=s" in f[0]]
    assert len(same) >= 2 and all(f in after for f in same)
    assert run() == [] and files.listing(spark, path) == after
    # only partitions that the manifest lists with NULLs are looked at
    gaps = {r.part: (r.tier, r.owner) for r in spark.read.parquet(stored_updates.gaps_path(path)).collect()}
    assert gaps == {"p": (0, 0), "q": (1, 1), "r": (1, 0), "s": (0, 0), None: (0, 0)}


def test_retention_deletes_partitions_and_cuts_one(spark, folder):
    path = f"{folder}/t"
    data = [(k, f"Q{k // 10}", None if k == 25 else f"2024-0{1 + k // 10}-{10 + k % 10}") for k in range(50)]
    df = spark.createDataFrame(data, "id int, q string, d string").withColumn("d", F.to_date("d"))
    stored_updates.write_dated(df, path, "q", "d")
    before = files.listing(spark, path)
    assert stored_updates.drop_before(spark, path, "q", "d", "2024-04-15") == (["Q0", "Q1"], ["Q2", "Q3"])
    after = files.listing(spark, path)
    assert not any("q=Q0" in f[0] or "q=Q1" in f[0] for f in after)
    assert [f for f in before if "q=Q4" in f[0]] == [f for f in after if "q=Q4" in f[0]]
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [25, *range(35, 50)]
    assert stored_updates.drop_before(spark, path, "q", "d", "2024-04-15") == ([], []) and files.listing(spark, path) == after


def test_partitions_of_any_name_are_found(spark, folder):
    names = ["a b/c:d", "é&+(1)", "x=y%20'z'", "[#]^{}", "plain-1.5_~"]
    df = spark.createDataFrame([(k, n) for k, n in enumerate(names)], "id int, q string").withColumn("d", F.to_date(F.lit("2024-01-01")))
    stored_updates.write_dated(df, f"{folder}/t", "q", "d")
    assert all(files.exists(spark, files.partition_path(f"{folder}/t", q=n)) for n in names)
    assert stored_updates.drop_before(spark, f"{folder}/t", "q", "d", "2024-02-01")[0] == sorted(names)
    assert not any("q=" in f[0] for f in files.listing(spark, f"{folder}/t"))


# ---- schemas -----------------------------------------------------------------

def test_new_columns_and_wider_types_leave_old_files(spark, folder):
    path = f"{folder}/t"
    evolving.append(spark.createDataFrame([(1, 2, 1.5, (1,))], "id int, n int, f float, s struct<a:int>"), path)
    first = [f for f in files.listing(spark, path) if "/part-" in f[0]]
    evolving.append(spark.createDataFrame([("x", 2**40, 7, (5, "y"), [1])], "extra string, ID long, n short, s struct<a:int,b:string>, l array<int>"), path)
    evolving.append(spark.createDataFrame([(3, 0.25, None)], "id int, n double, gone void"), path)
    assert [f for f in files.listing(spark, path) if f in first] == first
    got = {r.id: r for r in evolving.read(spark, path).collect()}
    assert [(got[i].n, got[i].f, got[i].extra, got[i].l) for i in (1, 2**40, 3)] == [(2.0, 1.5, None, None), (7.0, None, "x", [1]), (0.25, None, None, None)]
    assert got[1].s.b is None and got[2**40].s.b == "y" and "gone" in got[1]
    assert [v for v, _ in evolving.versions(spark, path)] == [1, 2, 3]
    evolving.append(spark.createDataFrame([(4, 1)], "id int, n int"), path)
    assert len(evolving.versions(spark, path)) == 3
    assert evolving.read(spark, path, 1).columns == ["id", "n", "f", "s"]


@pytest.mark.parametrize("old, new", [("n string", "n int"), ("n long", "n double"), ("n int", "n date"), ("n decimal(38,2)", "n decimal(38,10)"), ("n array<int>", "n array<string>"), ("n int", "n int, N int")])
def test_changes_that_lose_values_are_refused(spark, folder, old, new):
    path = f"{folder}/t"
    evolving.append(spark.createDataFrame([], old), path)
    before = files.listing(spark, path), evolving.versions(spark, path)
    with pytest.raises(evolving.SchemaChange):
        evolving.append(spark.createDataFrame([], T.StructType([f for part in new.split(", ") for f in T.StructType.fromDDL(part).fields])), path)
    assert (files.listing(spark, path), evolving.versions(spark, path)) == before


# ---- semi-structured records ---------------------------------------------------

def test_variant_landing(spark, folder):
    texts = [{"a": 1, "b": {"c.d": "x", "e": [1, 2]}}, {"a": 2.5, "z'q": True, "both'\"": "b"}, {"b": {"c.d": "y", "e": []}}, {"a": "text", "when": None}]
    df = spark.createDataFrame([(k, json.dumps(x)) for k, x in enumerate(texts)] + [(8, "no json"), (9, None)], "id int, j string")
    kind, n, bad = variants.land_variant(df, "j", f"{folder}/v")
    assert (n, bad) == (6, 1) and set(kind.names) == {"a", "b", "z'q", "when", "both'\""}
    landed = variants.landed(spark, f"{folder}/v")
    text = {r.id: r for r in variants.variant_columns(landed, "record", kind, ["z'q", "new"], as_text=True).collect()}
    assert landed.columns == ["id", "record"] and list(text[0].asDict()) == ["id", "z'q", "new", "a", "b", "both'\"", "when"]
    assert [text[k].a for k in (0, 1, 2, 3, 8, 9)] == ["1", "2.5", None, "text", None, None] and text[1]["z'q"] == "true" and text[1]["both'\""] == "b"
    assert json.loads(text[0].b) == texts[0]["b"]
    leaves = {r.id: r for r in variants.leaf_columns(landed, "record", kind).collect()}
    assert leaves[0].b_c_d == "x" and leaves[0].b_e == [1, 2] and leaves[2].b_e is None and leaves[3].a == "text"


def test_keys_are_found_in_the_pass_that_lands(spark, folder):
    spark.createDataFrame([(k, json.dumps({f"k{k % 9}": k})) for k in range(200)], "id int, j string").write.parquet(f"{folder}/in")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("landing", "landing")
    kind, n, _ = variants.land_variant(spark.read.schema("id int, j string").parquet(f"{folder}/in"), "j", f"{folder}/v")
    jobs = tracker.getJobIdsForGroup("landing")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert n == 200 and len(kind.names) == 9 and len(jobs) == 1


# ---- loads -------------------------------------------------------------------

SCHEMA = "id long, name string"


def landing(spark, path, name, data):
    return files.place_file(spark.createDataFrame(data, SCHEMA), path, name)


def test_ledger_notices_changed_files_and_survives_dead_loads(spark, folder, monkeypatch):
    drop, target, book = f"{folder}/drop", f"{folder}/target", f"{folder}/book"

    def load(run):
        return load_ledger.load_unseen(spark, drop, target, book, SCHEMA, run, pattern="*.parquet")

    def seen():
        return sorted((r.id, r.name, r.load_run) for r in load_ledger.loaded_rows(spark, target, book).collect())

    landing(spark, drop, "a.parquet", [(1, "x"), (2, "x")])
    landing(spark, drop, "empty.parquet", [])
    assert load("r1") == 2 and load("r2") == 0 and seen() == [(1, "x", "r1"), (2, "x", "r1")]
    # a load that dies after its rows were written and before its entries were
    landing(spark, drop, "b.parquet", [(3, "y")])
    write = load_ledger.replace_partitions

    def dies(*args):
        write(*args)
        raise RuntimeError("killed")
    monkeypatch.setattr(load_ledger, "replace_partitions", dies)
    with pytest.raises(RuntimeError):
        load("r3")
    monkeypatch.setattr(load_ledger, "replace_partitions", write)
    assert seen() == [(1, "x", "r1"), (2, "x", "r1")]
    # the file changes under its old name meanwhile
    landing(spark, drop, "a.parquet", [(1, "z"), (7, "z"), (8, "z")])
    states = {os.path.basename(r.path): r.state for r in load_ledger.unloaded(spark, drop, book, "*.parquet").collect()}
    assert states == {"a.parquet": "changed", "b.parquet": "new"}
    assert load("r4") == 2
    assert seen() == [(1, "z", "r4"), (3, "y", "r4"), (7, "z", "r4"), (8, "z", "r4")]
    entries = {(os.path.basename(r.path), r.load_run): r for r in load_ledger.ledger(spark, book).collect()}
    assert {k: r.rows for k, r in entries.items()} == {("a.parquet", "r1"): 2, ("empty.parquet", "r1"): 0, ("b.parquet", "r4"): 1, ("a.parquet", "r4"): 3}
    assert entries["a.parquet", "r1"].checksum != entries["a.parquet", "r4"].checksum


def test_files_are_matched_by_joins(spark, folder):
    landing(spark, f"{folder}/drop", "a.parquet", [(1, "x")])
    plan = plan_of(load_ledger.unloaded(spark, f"{folder}/drop", f"{folder}/book", "*.parquet"))
    assert "LeftAnti" in plan and "content" not in plan


def test_a_killed_batch_is_merged_again(spark, folder):
    landed, target, checkpoint = f"{folder}/landed", f"{folder}/keyed", f"{folder}/progress"
    schema = T.StructType.fromDDL("k int, day string, at int, v string")

    def land(data):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(landed)

    def run(before_commit=None):
        keyed.upsert_available(increments.landed_stream(spark, landed, schema), target, checkpoint, ["k", "day"], "day", "at", "v", before_commit=before_commit)

    def now():
        return sorted(tuple(r) for r in spark.read.parquet(target).select("k", "day", "at", "v").collect())

    land([(1, "a", 1, "x"), (2, "a", 5, "x"), (3, "b", 1, "x")])
    run()
    assert now() == [(1, "a", 1, "x"), (2, "a", 5, "x"), (3, "b", 1, "x")]
    untouched = [f for f in files.listing(spark, target) if "day=b" in f[0]]
    land([(1, "a", 3, "y"), (2, "a", 4, "late"), (4, "c", 1, "y")])

    def dies(number):
        raise RuntimeError("killed")
    with pytest.raises(Exception, match="killed"):
        run(dies)
    assert keyed.finished_batches(spark, target).count() == 1
    run()
    want = [(1, "a", 3, "y"), (2, "a", 5, "x"), (3, "b", 1, "x"), (4, "c", 1, "y")]
    assert now() == want and [f for f in files.listing(spark, target) if "day=b" in f[0]] == untouched
    assert rows(keyed.finished_batches(spark, target)) == [(0, 3, 2), (1, 3, 2)]
    # the same batch delivered with its old number is left out
    before = files.listing(spark, target)
    keyed.into_table(target, ["k", "day"], "day", "at", "v")(spark.createDataFrame([(1, "a", 9, "again")], schema), 1)
    assert files.listing(spark, target) == before and now() == want


# ---- keys --------------------------------------------------------------------

def test_clashing_values_get_keys_of_their_own(spark, folder):
    path = f"{folder}/keys"
    clash = lambda value: F.when(value.isin("a", "b", "c"), 5).otherwise(F.pmod(F.xxhash64(value), F.lit(1000)))
    values = lambda *v: spark.createDataFrame([(x,) for x in v], "v string")
    assert key_dictionary.add_values(spark, path, values("b", "x", "b", None), "v", clash) == 2
    first = {r.value: r.key for r in key_dictionary.dictionary(spark, path).collect()}
    assert first["b"] == 5
    assert key_dictionary.add_values(spark, path, values("c", "a", "b", "y"), "v", clash) == 3
    assert key_dictionary.add_values(spark, path, values("a", "c"), "v", clash) == 0
    now = {r.value: r.key for r in key_dictionary.dictionary(spark, path).collect()}
    assert len(set(now.values())) == len(now) == 5 and all(now[v] == k for v, k in first.items())
    keyed_rows = key_dictionary.with_dictionary_keys(values("a", "b", "unheard"), path, ["v"])
    assert {r.v: r.v_id for r in keyed_rows.collect()} == {"a": now["a"], "b": 5, "unheard": None}


def test_dense_keys(spark, folder):
    path = f"{folder}/keys"
    values = lambda *v: spark.createDataFrame([(x,) for x in v], "v string")
    assert key_dictionary.add_dense(spark, path, values("m", "c", "m", None), "v") == 2
    assert key_dictionary.add_dense(spark, path, values("a", "m", "z"), "v") == 2
    assert {r.value: r.key for r in key_dictionary.dictionary(spark, path).collect()} == {"c": 0, "m": 1, "a": 2, "z": 3}


# ---- clustering --------------------------------------------------------------

def test_buckets_join_and_group_without_exchange(spark, folder):
    a = spark.range(5000).select((F.col("id") % 700).alias("k"), F.col("id").alias("v"))
    b = spark.range(700).select(F.col("id").alias("bk"), F.lit("x").alias("w"))
    name = "t" + os.path.basename(folder).replace("-", "_")
    left = clustered.write_bucketed(a, f"{name}_a", f"{folder}/a", ["k"], 4)
    right = clustered.write_bucketed(b, f"{name}_b", f"{folder}/b", ["bk"], 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = left.join(right, F.col("k") == F.col("bk")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        assert "Exchange" not in plan_of(out) and out.count() == 700
        spark.sql(f"DROP TABLE {name}_a")
        again = clustered.open_bucketed(spark, f"{name}_again", f"{folder}/a", "k bigint, v bigint", ["k"], 4)
        regrouped = again.groupBy("k").agg(F.sum("v").alias("s"))
        assert "Exchange" not in plan_of(regrouped) and regrouped.count() == 700 and again.count() == 5000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for t in ("a", "b", "again"):
            spark.sql(f"DROP TABLE IF EXISTS {name}_{t}")


def test_buckets_follow_the_rows(spark):
    assert clustered.buckets_for(spark.range(10), spark.range(7)) == 8
    assert clustered.buckets_for(spark.range(900), spark.range(1600), rows=100) == 16
    assert clustered.buckets_for(spark.range(1601), rows=100) == 32 and clustered.buckets_for(spark.range(0)) == 8


def test_stored_buckets_grow_with_the_tables(spark, folder, monkeypatch):
    from tests.conftest import FOLDER
    from tidemark.queries.all import REGISTRY
    made = []
    monkeypatch.setattr(clustered.buckets_for, "__kwdefaults__", {"rows": 500, "least": 8})
    write = clustered.write_bucketed
    monkeypatch.setattr(clustered, "write_bucketed", lambda df, table, path, keys, n: made.append((n, df.count())) or write(df, table, path, keys, n))
    assert REGISTRY["bucketed_join"].run(spark, FOLDER).count() > 0
    assert made[0][0] == made[1][0] and all(count <= 500 * n for n, count in made)


def row_groups_met(path, column, low, high):
    import glob

    import pyarrow.parquet as pq
    met = total = 0
    for f in glob.glob(f"{path.removeprefix('file:')}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        place = [c.path_in_schema for c in (meta.row_group(0).column(i) for i in range(meta.num_columns))].index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(place).statistics
            total += 1
            met += stats.min <= high and stats.max >= low
    return met, total


def test_interleaved_order_serves_every_column(spark, folder):
    df = spark.range(40_000).select((F.xxhash64("id", F.lit(1)) % 10_000).alias("a"), F.exp((F.xxhash64("id", F.lit(2)) % 1000) / 50).alias("b"), F.concat(F.lit("n"), F.col("id") % 97).alias("c"))
    clustered.write_interleaved(df, f"{folder}/z", ["a", "b"], 6, files=64)
    sinks_path = sinks.write_clustered(df.repartition(64), f"{folder}/s", "a", "b", "c")
    for column, low, high in (("a", 100, 300), ("b", 0.9, 1.1)):
        met, total = row_groups_met(f"{folder}/z", column, low, high)
        assert total >= 50 and met <= total / 2
    plain_met, plain_total = row_groups_met(sinks_path, "b", 0.9, 1.1)
    assert plain_met == plain_total
    assert spark.read.parquet(f"{folder}/z").count() == 40_000 and df.exceptAll(spark.read.parquet(f"{folder}/z")).isEmpty()


def test_interleaved_key_of_odd_columns(spark, folder):
    df = spark.createDataFrame([(None, None, 1), (None, "", 1), (3.0, "b", 1), (float("nan"), "ü", 1)], "a double, b string, one int")
    clustered.write_interleaved(df, f"{folder}/z", ["a", "b", "one"], 3)
    assert spark.read.parquet(f"{folder}/z").count() == 4
    clustered.write_interleaved(df.limit(0), f"{folder}/e", ["a", "b"], 3)
    assert spark.read.schema(df.schema).parquet(f"{folder}/e").count() == 0


def test_places_among_borders_are_found_by_halving(spark):
    from bisect import bisect_left
    rng = __import__("random").Random(4)
    for n in (0, 1, 2, 3, 7, 8, 255):
        borders = sorted({rng.choice([-1, 1]) * rng.random() * 9 for _ in range(n)}) if n < 8 else [float(k) for k in range(n)]
        values = [*borders, *[b + 0.01 for b in borders], -1e9, 1e9, float("inf"), -0.0]
        df = spark.createDataFrame([(v,) for v in values], "v double")
        place = clustered._borders_below(borders, F.col("v"))
        assert {(r.v, r.p) for r in df.select("v", place.alias("p")).collect()} == {(v, bisect_left(borders, v)) for v in values}
    # eight steps for 255 borders, not 255
    steps = plan_of(df.select(place)).split("aggregate(", 1)[1].split("]", 1)[0]
    assert steps.count(",") == 7
    nan = spark.createDataFrame([(float("nan"),)], "v double")
    assert nan.select(place.alias("p")).first().p == 255


# ---- gates -------------------------------------------------------------------

def test_failed_load_is_logged_and_not_seen(spark, folder):
    path = f"{folder}/model"
    rules = [gated.Rule("id present", F.col("id").isNotNull()), gated.Rule("small", F.col("v") < 10, warn=True), gated.Rule("few odd", F.col("v") >= 0, allowed=1)]
    data = lambda *x: spark.createDataFrame(list(x), "id int, v int")
    with pytest.raises(ValueError):
        gated.published(spark, path)
    assert gated.publish(data((1, 1), (2, -1)), path, rules, "r1", "2024-01-01 00:00:00") == gated.Outcome(True, 2, {"id present": 0, "small": 0, "few odd": 1})
    assert not gated.publish(data((None, 50), (3, 1)), path, rules, "r2", "2024-01-02 00:00:00").published
    assert not gated.publish(data(), path, rules, "r3", "2024-01-03 00:00:00").published
    assert rows(gated.published(spark, path)) == [(1, 1), (2, -1)]
    assert [json.loads(r.row_json) for r in gated.failing(spark, path, "r2", rules[0]).collect()] == [{"v": 50}]
    gated.publish(data((9, 90)), path, rules, "r4", "2024-01-04 00:00:00")
    assert rows(gated.published(spark, path)) == [(9, 90)]
    log = {(r.run, r.check_name): (r.status, r.failures) for r in gated.run_log(spark, path).collect()}
    assert len(log) == 16 and log["r2", "id present"] == ("fail", 1) and log["r2", "small"] == ("warn", 1) and log["r3", "rows"] == ("fail", 1) and log["r4", "small"] == ("warn", 1)


def test_checks_read_nothing_twice(spark, folder):
    tracker = spark.sparkContext.statusTracker()
    df = spark.range(1000).withColumn("v", F.col("id") * 2)
    spark.sparkContext.setJobGroup("gate", "gate")
    seen = []
    original = gated.SparkSession.createDataFrame

    def watch(self, *args, **kwargs):
        seen.append(len(tracker.getJobIdsForGroup("gate")))
        return original(self, *args, **kwargs)
    gated.SparkSession.createDataFrame = watch
    try:
        assert gated.publish(df, f"{folder}/m", [gated.Rule("even", F.col("v") % 2 == 0)], "r", "2024-01-01 00:00:00").published
    finally:
        gated.SparkSession.createDataFrame = original
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert seen[0] == 1  # rows written and every rule counted by one job, before anything is logged
