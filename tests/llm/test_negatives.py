"""Hard negatives and the packed tree against brute force."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.conftest import FOLDER
from tidemark.llm import negatives
from tidemark.llm.queries import QUERIES

NAMES = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def brute(rows, positives=5, most=10, low=30, high=90, every=100, relabel=True):
    """Every anchor against every row; rows are (id, vector, label)."""
    sound = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * float(x)) for x in v]
        if all(abs(256 * x) < 2 ** 31 / math.sqrt(len(v)) for x in v):
            sound.append((i, (label + 1) % 10 if relabel and i % 7 == 0 else label, q))
    sound.sort()
    out = []
    for k, (a, label, q) in enumerate(sound):
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(q, p)), j, other) for j, (_, other, p) in enumerate(sound) if j != k and len(p) == len(q)]
        for score, j, _ in sorted(x for x in scored if x[2] == label)[:positives]:
            fit = sorted(x for x in scored if x[2] != label and low * -score <= 100 * -x[0] <= high * -score)[:most]
            out += [(a, sound[j][0], r, sound[n][0], -score, -s) for r, (s, n, _) in enumerate(fit, 1)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r[c] for c in NAMES) for r in df.collect())


def test_negatives_query(spark, duck):
    rows = duck.execute(f"SELECT vec_id, embedding, label FROM '{FOLDER}/embeddings.parquet'").fetchall()
    assert rows_of(QUERIES["op11_rtree_negatives"](spark, FOLDER)) == brute(rows)


def table_of(spark, rows, extra=True):
    more = ", key int, dim string, query long, rank int" if extra else ""
    return spark.createDataFrame([(i, v, label, *([1, "x", 2, 3] if extra else [])) for i, v, label in rows], f"vec_id long, embedding array<double>, label int{more}")


def test_negatives_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(negatives, "QUERIES_A_GROUP", 9)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    rows = [(k, (centres[rng.integers(6)] + 0.3 * rng.normal(size=8)).tolist(), int(rng.integers(4))) for k in range(700)]
    copy = rng.normal(size=8).tolist()
    rows += [(1000 + k, copy, k % 2) for k in range(350)]  # a third of the rows are equal
    rows += [(2000, [0.0] * 8, 1), (2000, [0.0] * 8, 2), (2001, [1.0, 2.0], 1), (2100, [1.0, 2.0], 1), (2002, [0.5, 1.0], 2), (2200, [], 1), (2201, [], 1), (2202, [], 2)]
    for block in (40, 5000):
        df = negatives.hard_negatives(table_of(spark, rows).repartition(5), F.col("vec_id") % 20 == 0, block=block)
        assert rows_of(df) == brute(rows, every=20, relabel=False)


def test_directories_of_several_levels(spark):
    rng = np.random.default_rng(4)
    rows = [(k, rng.normal(size=3).tolist(), int(rng.integers(3))) for k in range(600)]
    flat = table_of(spark, rows, False).select(F.col("vec_id").alias("key"), F.lit(False).alias("anchor"), F.col("label").cast("long").alias("label"),
                                               negatives._quantised(F.col("embedding"), 256.0).cast("array<int>").alias("q"))
    flat = flat.mapInArrow(negatives._as_bytes([0, 1]), "key long, anchor boolean, label long, dim int, vec binary, c1 int, c2 int").drop("anchor")
    tree = negatives.pack_tree(flat, block=16, fan=4)
    assert [level.count() for level in tree.levels] == [10, 3, 1] and tree.leaves.count() == 38
    keys = sorted(k for r in tree.leaves.collect() for k in np.frombuffer(r["keys"], np.int64).tolist())
    assert keys == list(range(600))
    window = F.array(F.struct(F.lit(0).alias("window"), F.lit(-10**6).cast("long").alias("low"), F.lit(20_000).cast("long").alias("high"), F.lit(-negatives.FAR).cast("long").alias("kth")))
    asked = flat.filter("key % 10 = 0").select(F.col("key").alias("query"), "dim", "label", "vec", window.alias("windows"))
    got = sorted((r.query, r["rank"], r["key"], r.score) for r in negatives.search(tree, asked, 3, same=False).collect())
    q = [[math.floor(256 * x) for x in v] for _, v, _ in rows]
    want = []
    for a in range(0, 600, 10):
        scored = sorted((-sum(x * y for x, y in zip(q[a], q[k])), k) for k in range(600) if rows[k][2] != rows[a][2])
        want += [(a, r, k, -s) for r, (s, k) in enumerate([x for x in scored if -10**6 <= -x[0] <= 20_000][:3], 1)]
    assert got == want


def test_boxes_bound_every_product():
    rng = np.random.default_rng(5)
    for size in (3, 2**20, 2**27):
        points, asked = rng.integers(-size, size, (200, 6)), rng.integers(-size, size, (30, 6)).astype(np.int32)
        one = [{"query": k, "label": 0, "vec": a.tobytes(), "windows": [{"window": 0, "low": -negatives.FAR, "high": negatives.FAR, "kth": -negatives.FAR}]} for k, a in enumerate(asked)]
        q = negatives.Asked(pa.array(one), 6, False)
        exact = asked.astype(object) @ points.T.astype(object)
        assert (q.products(points) == exact).all()
        best = q.reach(points.min(0)[None], points.max(0)[None], np.array([1]), np.array([1]))
        assert all(int(best[k, 0]) >= max(exact[k]) for k in range(30))


def test_negatives_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (1, [1.0, 1.0], 1), (2, [0.5, 0.5], 2), (2, [0.5, 0.5], 2), (3, None, 1), (4, [None, 1.0], 1), (5, [nan, 1.0], 2), (6, [inf, 0.0], 2), (None, [1.0, 1.0], 1),
            (8, [1.0, 1.0], None), (9, [-1.0, -1.0], 1), (10, [1e300, 1.0], 2), (11, [0.4, 0.4], 3), (100, [1.0, 2.0], 1), (100, [1.0, 2.0], 1), (200, [2.0], 5), (300, [float("-inf"), 1.0], 1)]
    got = negatives.hard_negatives(table_of(spark, rows), F.col("vec_id") % 100 == 0)
    assert rows_of(got) == brute(rows, relabel=False)
    assert negatives.hard_negatives(table_of(spark, []), F.col("vec_id") % 100 == 0).count() == 0
    named = spark.createDataFrame([("a", [1.0, 1.0], "x"), ("b", [1.0, 0.9], "x"), ("c", [0.5, 0.5], "y")], "vec_id string, embedding array<float>, label string")
    assert [tuple(r) for r in negatives.hard_negatives(named, F.col("vec_id") == "a").collect()] == [("a", "b", 1, "c", 256 * 256 + 256 * 230, 2 * 256 * 128)]
