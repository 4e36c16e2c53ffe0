"""Repeated bytes against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import FOLDER
from tidemark.llm import suffixes
from tidemark.llm.queries import QUERIES


def starts(texts, length):
    seen = Counter(t[i: i + length] for t in texts for i in range(len(t) - length + 1))
    return [[seen[t[i: i + length]] > 1 for i in range(len(t) - length + 1)] for t in texts]


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    out = []
    for (i, _), t, flags in zip(rows, texts, starts(texts, length)):
        gone = np.zeros(len(t), bool)
        for k in np.flatnonzero(flags):
            gone[k: k + length] = True
        spans = suffixes._ranges(gone)
        out.append((i, len(t), int(gone.sum()), len(spans), hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is not None, r))


def rows_of(df):
    got = [(r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in df.collect()]
    return sorted(got, key=lambda r: (r[0] is not None, r))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.binary(max_size=60) | st.text(alphabet="ab", max_size=60).map(str.encode) | st.text(alphabet="a", max_size=40).map(str.encode), max_size=7), st.integers(1, 12))
def test_suffix_sorting(texts, length):
    assert [g.tolist() for g in suffixes.repeated_starts(texts, length)] == starts(texts, length)


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=150) | st.text(alphabet="ab", max_size=150).map(str.encode))
def test_order_and_common_prefixes(data):
    text = np.append(np.frombuffer(data, np.uint8).astype(np.uint16) + np.uint16(2), np.uint16(0))
    parts = list(suffixes.sorted_suffixes(text, 258, 200))[::-1]
    order = [k for s, _ in parts for k in s.tolist()]
    assert order == sorted(range(len(data)), key=lambda i: data[i:])
    shared = [c for _, part in parts for c in part.tolist()]
    for k in range(1, len(order)):
        a, b = data[order[k - 1]:], data[order[k]:]
        assert shared[k] == next((j for j, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_spilled_queues(monkeypatch):
    monkeypatch.setattr(suffixes.Buckets.__init__, "__defaults__", (500,))
    rng = np.random.default_rng(2)
    texts = [bytes(rng.choice(list(b"abc"), 400).tolist()) for _ in range(6)]
    texts += [texts[0][100:300] + texts[1][:90]]
    assert [g.tolist() for g in suffixes.repeated_starts(texts, 20)] == starts(texts, 20)


def test_runs_cover_every_start_once():
    rng = np.random.default_rng(8)
    texts = [rng.integers(97, 99, n, dtype=np.uint8).tobytes() for n in (0, 199, 200, 201, 1000, 5)] + [b"a" * 700]
    data, at = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts])
    text, first, last, _, _ = suffixes.anchored_runs(data, at, 200)
    seen = [(t, k - at[t]) for t, a, b in zip(text, first, last) for k in range(a, b + 1)]
    assert seen == [(t, k) for t, x in enumerate(texts) for k in range(len(x) - 199)]


def odd_rows(corpus):
    rng = np.random.default_rng(9)
    line = "".join(rng.choice(list("abcdefgh "), 260))
    rows = list(corpus[:60])
    rows += [(2000 + k, "".join(rng.choice(list("ijklmnop "), 150)) + line + "".join(rng.choice(list("qrstuv "), 130))) for k in range(40)]
    rows += [(3000, None), (3001, ""), (3002, "a" * 5000), (3003, "é" * 300), (3004, "abcdefg" * 100), (3005, "x" * 199), (3006, line[:200]), (3007, line[:199]), (None, line[5:240])]
    return rows + [(3010 + k, corpus[0][1]) for k in range(5)] + [corpus[3]] * 3


@pytest.mark.parametrize("crowd, shard_bytes", [(200, 4 << 20), (3, 3000)])
def test_repeats(docs_of, corpus, crowd, shard_bytes):
    rows = odd_rows(corpus)
    got = suffixes.without_repeats(docs_of(rows), crowd=crowd, shard_bytes=shard_bytes)
    assert rows_of(got) == brute(rows, 200)


def test_long_text_in_pieces(docs_of, monkeypatch):
    assert rows_of(suffixes.without_repeats(docs_of([]))) == []
    rng = np.random.default_rng(1)
    long = "".join(rng.choice(list("abcdefgh "), 9_000_000 // 9 * 9))
    data = np.frombuffer(long.encode(), np.uint8)
    table = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([long])], names=["row", "text"])
    parts = list(suffixes._runs_of(200)(iter([table])))
    covered = sum(int((p.column("hi").to_numpy() - p.column("lo").to_numpy() + 1).sum()) for p in parts)
    assert len(parts) > 1 and covered == len(data) - 199


def test_query(spark, corpus):
    got = QUERIES["op1_suffix_dedup"](spark, FOLDER).collect()
    assert sorted(tuple(r) for r in got) == brute(corpus, 200)
