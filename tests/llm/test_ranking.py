"""Ranked search against a plain sum over all documents."""

import math
import re
from collections import Counter

import numpy as np

from tests.conftest import FOLDER
from tidemark.llm import ranking
from tidemark.llm.queries import QUERIES

FOLD = str.maketrans({chr(k): chr(k + 32) for k in range(65, 91)})
TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [t.translate(FOLD) for t in TERM.findall(text or "")]


def brute(docs, items, top=20):
    """(item, rank, doc, score), every document for every item; rows are told apart by their place."""
    counts = [Counter(terms(t)) for _, t in docs]
    lengths = [sum(c.values()) for c in counts]
    n, total = sum(x > 0 for x in lengths), sum(lengths)
    df = Counter(t for c in counts for t in c)
    out = []
    for name, text in items:
        asked = Counter(terms(text))
        scored = []
        for (i, _), c, length in zip(docs, counts, lengths):
            score = 0
            for t, times in asked.items():
                if c[t]:
                    m = 75 + 25 * length * n // total
                    score += times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
            if score:
                scored.append((-score, i is None, i or 0))
        out += [(name, rank, None if gone else i, -s) for rank, (s, gone, i) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def test_search_query(spark, duck):
    docs = duck.execute(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()
    items = duck.execute(f"SELECT item_id, text FROM '{FOLDER}/benchmark.parquet'").fetchall()
    assert rows_of(QUERIES["op13_term_pipeline"](spark, FOLDER)) == brute(docs, items)


def test_terms():
    for text in ("", "A1 b_c\x00d é日本 É-x\x7fy{z}", "Straße ÀB 'tis 3.14"):
        assert ranking.term_counts(text.encode()) == Counter(t.encode() for t in terms(text))
    long = ("word%d, Ünï " * 200_000) % tuple(range(200_000))
    assert ranking.term_counts(long.encode()) == Counter(t.encode() for t in terms(long))


def test_search_over_many_blocks_and_ties(spark, docs_of, monkeypatch):
    monkeypatch.setattr(ranking, "BLOCK_DOCS", 50)
    monkeypatch.setattr(ranking, "ITEMS_A_BUNDLE", 7)
    rng = np.random.default_rng(8)
    words = [f"w{k}" for k in range(60)]
    chance = 1 / np.arange(1, 61)
    chance /= chance.sum()
    text = lambda n: " ".join(rng.choice(words, n, p=chance))
    docs = [(k, text(rng.integers(1, 60))) for k in range(900)]
    copy = text(30)
    docs += [(5000 - k, copy) for k in range(300)]  # a third of the table ties
    docs += [(None, copy), (None, copy), (7, copy), (7, copy), (8, None), (9, ""), (10, "...")]
    items = [(k, text(rng.integers(1, 12))) for k in range(20)] + [(90, copy), (90, copy), (91, None), (92, ""), (93, "unheard of"), (None, "w3 w3 w50")]
    bench = spark.createDataFrame([(i, t, 1, 2.0) for i, t in items], "item_id long, text string, score int, rank double")
    got = rows_of(ranking.rank_documents(docs_of(docs).repartition(6), bench, shares=(0.02, 0.1, 0.3)))
    assert got == brute(docs, items)
    assert rows_of(ranking.rank_documents(docs_of(docs).repartition(3), bench, top=3, shares=())) == brute(docs, items, 3)


def test_search_of_odd_tables(spark, docs_of):
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert ranking.rank_documents(docs_of([]), bench).count() == 0
    assert ranking.rank_documents(docs_of([(1, "a b")]), bench.limit(0)).count() == 0
    assert ranking.rank_documents(docs_of([(1, None), (2, "...")]), bench).count() == 0
    long = [(1, "a " * 400_000 + "b"), (2, "a b c"), (3, "c " * 10)]
    assert rows_of(ranking.rank_documents(docs_of(long), bench)) == brute(long, [(1, "a b c")])
    named = spark.createDataFrame([("x", "a b"), ("y", "a")], "doc_id string, text string")
    assert [r.doc_id for r in ranking.rank_documents(named, bench).sort("rank").collect()][0] == "x"
