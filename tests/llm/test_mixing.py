"""Mixes by entropy balancing against a plain solution."""

import math
import re
from collections import defaultdict

import numpy as np

from tests.conftest import FOLDER
from tidemark.llm import mixing
from tidemark.llm.places import placed
from tidemark.llm.queries import QUERIES


def shares(sizes, weights, most=3.0):
    """Targets by pouring out again what is over."""
    full = set()
    while True:
        rest = sum(sizes) - most * sum(sizes[k] for k in full)
        total = sum(w for k, w in enumerate(weights) if k not in full)
        target = [most * sizes[k] if k in full else rest * weights[k] / total for k in range(len(sizes))]
        over = {k for k in range(len(sizes)) if target[k] > most * sizes[k] and k not in full}
        if not over:
            return target
        full |= over


def plain_rates(sizes, target, most=3.0):
    """Bisection for the tilt of one source."""
    low, high = -1e4, 1e4
    unit = np.mean(sizes)
    for _ in range(300):
        tilt = (low + high) / 2
        rate = np.minimum(most, np.exp(np.minimum(tilt * sizes / unit, 50)))
        low, high = (tilt, high) if (rate * sizes).sum() < target else (low, tilt)
    return rate


def by_source(rows, sources):
    out = defaultdict(list)
    for r in rows:
        out[sources[r.doc_id]].append(r)
    return out


def checked(rows, sources, weights=(5, 2, 1), most=3):
    groups = by_source(rows, sources)
    names = sorted((s for s in groups if s is not None), key=lambda s: s.encode()) + [None] * (None in groups)
    sizes = [sum(r.size for r in groups[s]) for s in names]
    want = shares(sizes, [weights[k % len(weights)] for k in range(len(names))], most)
    for s, size, target in zip(names, sizes, want):
        g = groups[s]
        assert all(r.source_size == size and math.isclose(r.target, target, rel_tol=1e-12) for r in g)
        assert all(r.taken == r.size * r.copies and 0 <= r.copies <= most for r in g)
        lengths = np.array([r.size for r in g if r.size], float)
        if len(lengths):
            rates = plain_rates(lengths, target, most)
            assert np.allclose([r.rate for r in g if r.size], rates, atol=2e-3, rtol=2e-3)
            assert abs(sum(r.taken for r in g) - target) <= lengths.max()
            assert all(abs(r.copies - x) < 1.01 for r, x in zip((r for r in g if r.size), rates))
        # documents of one size differ by one copy at most
        for n in {r.size for r in g}:
            copies = [r.copies for r in g if r.size == n]
            assert max(copies) - min(copies) <= 1


def test_mix_query(spark, duck):
    sources = dict(duck.execute(f"SELECT doc_id, source FROM '{FOLDER}/documents.parquet'").fetchall())
    texts = dict(duck.execute(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall())
    rows = QUERIES["op12_entropy_mix"](spark, FOLDER).collect()
    assert len(rows) == len(texts) and all(r.size == len(re.findall("[^\x20\x09-\x0D]+", texts[r.doc_id] or "")) for r in rows)
    checked(rows, sources)
    again = QUERIES["op12_entropy_mix"](spark, FOLDER).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_targets_stop_at_thrice_the_size(spark):
    rng = np.random.default_rng(5)
    for n in (1, 2, 7, 30):
        sizes = [int(x) for x in np.exp(rng.normal(4, 3, n))]
        weights = [float((5, 2, 1)[k % 3]) for k in range(n)]
        got = mixing.source_targets(spark.createDataFrame(list(zip(range(n), sizes, weights)), "s long, size long, weight double")).collect()
        assert np.allclose([r.target for r in sorted(got)], shares(sizes, weights), rtol=1e-12)


def test_mix_of_odd_rows(spark):
    rng = np.random.default_rng(6)
    rows, sources = [], {}
    for k in range(900):  # a hot source of equal short texts, small sources, a null one, an empty one
        source = "big" if k % 3 else (None, "a", "Z", "é", "none")[k // 3 % 5]
        n = 0 if source == "none" else 7 if source == "big" and k % 2 else int(np.exp(rng.normal(3, 1.5)))
        rows.append((k, "\x0bw x \n" * n if k % 5 else ("ü " * n), source, 1, "x", 2.0, 3))
        sources[k] = source
    rows += [(2000, None, "a", 1, "x", 2.0, 3), (2001, "", "Z", 1, "x", 2.0, 3), (2002, "long " * 50_000, "a", 1, "x", 2.0, 3)]
    sources |= {2000: "a", 2001: "Z", 2002: "a"}
    schema = "doc_id long, text string, source string, size int, target string, rate double, at int"
    got = mixing.mix(spark.createDataFrame(rows, schema)).collect()
    assert sorted(r.doc_id for r in got) == sorted(sources)
    checked(got, sources)
    assert mixing.mix(spark.createDataFrame([], schema)).count() == 0
    empty = mixing.mix(spark.createDataFrame([(1, None, "a", 1, "x", 2.0, 3), (1, " ", None, 1, "x", 2.0, 3)], schema)).collect()
    assert [(r.size, r.taken, r.target) for r in empty] == [(0, 0, 0.0)] * 2
    # repeated rows are documents of their own; ids of any type
    twice = mixing.mix(spark.createDataFrame([("i", "a b", "s")] * 500 + [(None, "a b c", "t")], "doc_id string, text string, source string")).collect()
    assert len(twice) == 501 and sum(r.taken for r in twice if r.doc_id is None) == 9 and abs(sum(r.taken for r in twice if r.doc_id) - (1003 - 9)) <= 2


def test_given_weights(spark):
    docs = spark.createDataFrame([(k, "a b c d e" * (1 + k % 9), ("x", "y", "z")[k % 3]) for k in range(300)], "doc_id long, text string, source string")
    weights = spark.createDataFrame([("x", 3.0), ("y", 1.0)], "source string, weight double")
    got = mixing.mix(docs, weights, most=2).collect()
    groups = by_source(got, {k: ("x", "y", "z")[k % 3] for k in range(300)})
    assert {r.taken for r in groups["z"]} == {0} and {r.copies for r in groups["x"]} == {2}
    assert abs(sum(r.taken for r in groups["y"]) - groups["y"][0].target) < 50


def test_places(spark):
    rows = [(k % 7, k) for k in range(1000)]
    got = placed(spark.createDataFrame(rows, "a long, b long").repartition(5), "a", "b").collect()
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r["at"])] == sorted(rows) and sorted(r["at"] for r in got) == list(range(1000))
    assert placed(spark.createDataFrame([], "a long"), "a").count() == 0
