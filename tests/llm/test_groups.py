"""Near-duplicate texts and vectors, and their grouping, against brute force."""

import math
import re

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tests.conftest import FOLDER
from tidemark.llm import near_dups, vectors
from tidemark.llm.components import components
from tidemark.llm.queries import QUERIES

FOLD = str.maketrans({chr(k): chr(k + 32) for k in range(65, 91)})


def shingles(text):
    w = [x.translate(FOLD) for x in re.findall("[^\x20\x09-\x0D]+", text or "")]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def grouped(ids, linked):
    """Least id reachable for each id."""
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def brute(rows, percent=85):
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    by = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    root = grouped(ids, by)
    return sorted((i, len(sets[i]), root[i], root[i] == i) for i in ids)


def rows_of(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect())


def edited(rng, words, share):
    return " ".join(f"x{rng.integers(10**9)}" if rng.random() < share else w for w in words)


def test_signatures_estimate_the_overlap():
    rng = np.random.default_rng(3)
    errors = []
    for m in (3, 30, 300):
        for _ in range(60):
            a = rng.integers(0, 2**63, m, dtype=np.uint64)
            b = np.concatenate((a[: m * 2 // 3], rng.integers(0, 2**63, m - m * 2 // 3, dtype=np.uint64)))
            s = near_dups.super_minhash([np.unique(a), np.unique(b), np.zeros(0, np.uint64)], 64)
            assert np.isinf(s[2]).all() and np.isfinite(s[:2]).all()
            errors.append((s[0] == s[1]).mean() - 0.5)
            assert s[:2].max() <= 64
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < math.sqrt(0.25 / 64)


def test_sets_equal_plain_ones(corpus):
    texts = [t for _, t in corpus] + [None, "", " \t\x0b", "One", "one two", "a b c d", "A\nB\rC\x0cD e", "é é É " * 9]
    sets = [s for _, d, at in near_dups.slices(pa.array(texts)) for s in near_dups.shingle_sets(d, at)]
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]


def test_near_duplicates(docs_of, corpus):
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in rng.integers(0, 5000, 300)]
    rows = list(corpus)
    # a group in which copies resemble the original more than each other, the original coming last
    rows += [(1000 + k, edited(rng, words, 0.012)) for k in range(60)] + [(1100, " ".join(words))]
    # a chain, short texts, copies that differ in capitals and white space, texts without words
    rows += [(1200 + k, " ".join([f"c{j}" for j in range(k * 12, 300 + k * 12)])) for k in range(12)]
    rows += [(1300, None), (1301, ""), (1302, " \n"), (1303, "one two"), (1304, "One\ntwo"), (1305, "one"), (1306, "ONE"), (1307, "a " * 5000), (1308, "a a a a a"), (1309, "Z " * 9)]
    rows += [(1400 + k, "the same text again and again in many copies") for k in range(150)]
    assert rows_of(near_dups.near_duplicates(docs_of(rows))) == brute(rows)


def test_near_duplicates_of_few_rows(docs_of):
    assert rows_of(near_dups.near_duplicates(docs_of([]))) == []
    assert rows_of(near_dups.near_duplicates(docs_of([(7, None), (8, "")]))) == brute([(7, None), (8, "")])
    got = near_dups.near_duplicates(docs_of([(None, "a b"), (3, "a b"), (3, "a b"), (5, "A b")])).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in got) == [(0, 0, False), (3, 3, True), (3, 3, True), (5, 3, False)]


def test_near_duplicates_query(spark, corpus):
    assert rows_of(QUERIES["op3_super_minhash"](spark, FOLDER)) == brute(corpus)


@pytest.mark.parametrize("links", [[], [(1, 1)], [(1, 2), (2, 3), (3, 4), (9, 8), (5, 5)], [(k, k + 1) for k in range(40)], [(0, k) for k in range(1, 50)] + [(k, 100 + k) for k in range(50)]])
def test_components(spark, links):
    got = components(spark.createDataFrame(links, "a long, b long"))
    want = grouped({x for e in links for x in e}, links)
    assert sorted((r.node, r.root) for r in got.collect()) == sorted(want.items())


def cosine_links(rows):
    sound = [(i, label, np.array(v, float)) for i, v, label in rows if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for k, (a, la, x) in enumerate(sound):
        for b, lb, y in sound[k + 1:]:
            if la == lb and len(x) == len(y) and math.fsum(x * y) / math.sqrt(math.fsum(x * x) * math.fsum(y * y)) >= 0.98:
                out.append((a, b))
    return out


def check_vectors(df, rows):
    links = cosine_links(rows)
    ids = [i for i, _, _ in rows]
    root = grouped(ids, links)
    n = {i: sum(i in e for e in links) for i in ids}
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()) == sorted((i, n[i], root[i], root[i] == i) for i in ids)


def test_vector_query(spark, duck):
    rows = duck.execute(f"SELECT vec_id, embedding, label FROM '{FOLDER}/embeddings.parquet'").fetchall()
    check_vectors(QUERIES["op7_vector_links"](spark, FOLDER), rows)


@pytest.mark.parametrize("cell, pivots", [(8, 6), (40, 4096), (512, 4096)])
def test_vectors(spark, cell, pivots):
    rng = np.random.default_rng(cell)
    rows = []
    for label in (0, 1, None):
        centres = rng.normal(size=(12, 16))
        for _ in range(150):
            c = centres[rng.integers(12)]
            rows.append((len(rows), (c + rng.normal(size=16) * rng.choice([0, 0.05, 0.1, 0.2, 2])).tolist(), label))
    rows += [(900 + k, rows[0][1], 0) for k in range(30)] + [(950, None, 0), (951, [], 0), (952, [0.0] * 16, 0), (953, [math.nan] + [1.0] * 15, 0), (954, [math.inf] + [1.0] * 15, 0), (955, [None] + [1.0] * 15, 0), (956, [1e100] * 16, 1), (957, [1e-100] * 16, 1), (958, [1.0, 1.0], 1)]
    df = spark.createDataFrame([(i, v, label, 1, 2, 3) for i, v, label in rows], "vec_id long, embedding array<double>, label int, cell int, rep long, n int")
    check_vectors(vectors.vector_groups(df, cell=cell, pivots=pivots), rows)


def test_no_vectors(spark):
    assert vectors.vector_groups(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_the_stage_links_from_four_fifths_on(spark, docs_of):
    words = [f"w{k}" for k in range(400)]
    rows = [(1, " ".join(words))]
    for i, gap in ((2, 55), (3, 47), (4, 39), (5, 25)):  # one changed word in so many: overlaps of about 0.83, 0.81, 0.77 and 0.67
        rows.append((i, " ".join(f"x{i}" if k % gap == gap - 1 else w for k, w in enumerate(words))))
    sets = {i: shingles(t) for i, t in rows}
    share = {i: len(sets[1] & sets[i]) / len(sets[1] | sets[i]) for i in (2, 3, 4, 5)}
    assert 0.8 <= share[3] <= share[2] < 0.85 and share[4] < 0.8
    left = {r.doc_id for r in corpus_pipeline.keep_one_of_each_group(spark, docs_of(rows), FOLDER).collect()}
    linked = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert left == {i for i, root in grouped(list(sets), linked).items() if i == root}


def test_crowded_cells_are_split_level_by_level(spark, monkeypatch):
    rng = np.random.default_rng(21)
    centres = rng.normal(size=(12, 6))
    rows = []
    for k in range(1500):  # one label, clusters of very different density, chains across cells
        c = centres[rng.integers(12)] if k % 3 else centres[0]
        rows.append((k, (c + 0.12 * rng.normal(size=6)).tolist(), 1))
    rows += [(2000 + k, rows[k][1], 1) for k in range(40)] + [(3000 + k, (centres[1] + 1e-9 * rng.normal(size=6)).tolist(), 1) for k in range(80)]
    seen = []
    monkeypatch.setattr(vectors, "written", lambda df, label, write=vectors.written: (seen.append(label), write(df, label))[1])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    got = sorted(tuple(r) for r in vectors.vector_groups(df, cell=16, pivots=3).collect())
    assert seen.count("vector-cells") >= 3
    x = np.array([v for _, v, _ in rows])
    x = x / np.sqrt((x * x).sum(1, keepdims=True))
    ids = [i for i, _, _ in rows]
    close = x @ x.T >= 0.98
    np.fill_diagonal(close, False)
    root = grouped(ids, [(ids[i], ids[j]) for i, j in zip(*np.nonzero(close)) if i < j])
    assert got == sorted((i, int(n), root[i], root[i] == i) for i, n in zip(ids, close.sum(1)))
