"""Sharding, token files and pieces against the libraries and plain Python."""

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import FOLDER
from tidemark.llm import pieces, sharding, tokens
from tidemark.llm.queries import QUERIES, vocabulary
from tidemark.session import fresh_folder

ODD = [(1, None), (2, ""), (3, "a"), (3, "a"), (None, "b"), (7, "  two  spaces \n\n x\t y "), (8, "ü" * 50_000), (9, "no▁mark <|endoftext|> </s>\r\n é\U0001f600\x00"), (10, "a" * 3000), (11, " lead"), (12, "trail "), (13, "x\n"), (14, "\n"), (15, " ")]


def sizes(rows):
    return sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in rows)


def check_shards(rows, placed, n):
    assert sorted((r["size"], r.text_crc32) for r in placed) == sizes(rows)
    order = sorted(placed, key=lambda r: (r.shard, r.slot))
    assert [(r.doc_id is not None, r.doc_id or 0) for r in order] == sorted((r.doc_id is not None, r.doc_id or 0) for r in order)
    for s in range(n):
        assert [r.slot for r in order if r.shard == s] == list(range(sum(r.shard == s for r in order)))
    total, before = sum(r["size"] for r in placed), 0
    for r in order:
        assert r.shard == (2 * before + r["size"]) * n // (2 * total)
        before += r["size"]


def test_byte_shards(corpus, docs_of):
    for rows in (corpus, ODD, [(5, "x")] * 40, []):
        check_shards(rows, sharding.byte_shards(docs_of(rows), 16).collect(), 16)


def test_byte_shards_query(spark, corpus):
    got = QUERIES["op10_byte_shards"](spark, FOLDER).collect()
    check_shards(corpus, got, 16)
    by = [sum(r["size"] for r in got if r.shard == s) for s in range(16)]
    assert max(by) - min(by) <= 2 * max(r["size"] for r in got)


@pytest.fixture(scope="module")
def bpe():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [2]


def expected_tokens(rows, bpe):
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = bpe(t)
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_query(spark, corpus, bpe):
    got = QUERIES["op4_wavelet_tokens"](spark, FOLDER).collect()
    assert sorted(tuple(r) for r in got) == expected_tokens(corpus, bpe)


def test_token_files_of_odd_rows(spark, docs_of, bpe):
    path = fresh_folder(spark, "t")
    tokens.write_token_shards(docs_of(ODD), path, vocabulary("byte_bpe_50k.json"), 2, shard_ids=40)
    got = {(r.doc_id, r.start): r.ids for r in tokens.read_token_shards(spark, path).collect()}
    assert sorted((i is not None, i or 0, s, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for (i, s), x in got.items()) \
        == sorted((i is not None, i or 0, s, n, c) for i, s, n, c in expected_tokens(ODD, bpe))
    empty = fresh_folder(spark, "t")
    tokens.write_token_shards(docs_of([]), empty, vocabulary("byte_bpe_50k.json"), 2)
    assert tokens.token_checksums(spark, empty).collect() == []


def test_token_query_gives_the_ids_of_the_unmodified_library(spark, docs_of, corpus, tmp_path):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    rows = corpus[:40] + [(9000, "a <|endoftext|> next"), (9001, "<|endoftext|>"), (9002, "x<|endoftext|><|endoftext|>y\n z"), (9003, "<|endoftext |>"), (9004, corpus[0][1] + "<|endoftext|>" + corpus[1][1]), (9005, None), (9006, "after")]
    docs_of(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op4_wavelet_tokens"](spark, str(tmp_path)).collect()
    ids = lambda t: plain.encode(t or "", add_special_tokens=False).ids + [2]
    assert 50256 in ids(rows[40][1])
    assert sorted(tuple(r) for r in got) == expected_tokens(rows, ids)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([0, 1, 2, 5, 9, 300, 50256, 70_000]), max_size=1500))
def test_wavelet_matrix(ids):
    array = np.array(ids, np.uint32)
    m = tokens.WaveletMatrix.from_bytes(tokens.WaveletMatrix.build(array).to_bytes())
    assert m.ids().tolist() == ids
    for at in range(0, len(ids), 97):
        assert m.access(at) == ids[at]
        assert m.count(ids[at], at // 2, at) == ids[at // 2: at].count(ids[at])
    for token in {*ids[:4], 4}:
        places = [k for k, x in enumerate(ids) if x == token]
        assert m.count(token) == len(places)
        for nth in {0, len(places) // 2, len(places) - 1, len(places)} - {-1}:
            assert m.occurrence(token, nth) == (places[nth] if nth < len(places) else -1)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\tçß.▁0" + " 漢", max_size=40) | st.text(max_size=30), max_size=4))
def test_encoders_equal_the_libraries(texts):
    sp, mine, bpe, byte = ENCODERS()
    got = [np.frombuffer(x, "<i4") for x in mine.batch(texts)]
    assert [x.tolist() for x in got] == [sp.encode(t) for t in texts]
    assert mine.model.decode(np.concatenate([*got, np.zeros(0, np.int32)]), np.cumsum([len(x) for x in got])) == [sp.decode(x.tolist()) for x in got]
    assert [np.frombuffer(x, "<u4").tolist() for x in byte.batch(texts)] == [bpe.encode(t, add_special_tokens=False).ids for t in texts]


def ENCODERS(held=[]):
    if not held:
        from sentencepiece import SentencePieceProcessor

        model, path = vocabulary("piece_bpe_32k.model"), vocabulary("byte_bpe_50k.json")
        byte = tokens.CachedEncoder(path)
        held.append((SentencePieceProcessor(model_file=model), pieces.PieceEncoder(model), byte.tokenizer, byte))
    return held[0]


def test_repeats_in_one_word():
    sp, mine, _, _ = ENCODERS()
    for t in ("a" * 999, "abab" * 300, " " * 77, "aaaa  aaa   b", "ééé" * 100, "ingingingin" * 40, "000000111", "thethethe" * 50):
        assert np.frombuffer(mine.batch([t])[0], "<i4").tolist() == sp.encode(t)


def test_piece_query(spark, corpus, docs_of):
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    digest = lambda t: (len(i := sp.encode(t or "")), hashlib.sha256(",".join(map(str, i)).encode()).hexdigest(), hashlib.sha256(sp.decode(i).encode()).hexdigest())
    got = QUERIES["op8_sentence_pieces"](spark, FOLDER).collect()
    assert sorted(tuple(r) for r in got) == [(i, *digest(t)) for i, t in corpus]
    got = pieces.encode_decode(docs_of(ODD), vocabulary("piece_bpe_32k.model")).collect()
    assert sorted((r.doc_id or 0, r.ids, r.decoded) for r in got) == sorted((i or 0, sp.encode(t or ""), sp.decode(sp.encode(t or ""))) for i, t in ODD)
    assert pieces.encode_decode(docs_of([]), vocabulary("piece_bpe_32k.model")).count() == 0
    assert got[0].__fields__ == ["doc_id", "ids", "decoded"] and F is not None


def test_long_words_cost_their_merges():
    import base64
    import random
    import time

    from sentencepiece import SentencePieceProcessor

    path = vocabulary("piece_bpe_32k.model")
    library, encoder = SentencePieceProcessor(model_file=path), pieces.PieceEncoder(path)
    rng = random.Random(1)
    some = ["the", "ing", "and", "tion", "über", "straße", "日本", "ment"]
    texts = [base64.b64encode(rng.randbytes(750_000)).decode(), "".join(rng.choice(some) for _ in range(30_000)), "a" * 50_001, "ab" * 20_000 + " " * 3_000 + "x",
             " ".join("".join(rng.choice("etaoinshr") for _ in range(rng.randrange(300, 900))) for _ in range(20))]
    began = time.perf_counter()
    got = [np.frombuffer(x, "<i4").tolist() for x in encoder.batch(texts)]
    assert time.perf_counter() - began < 30
    assert got == [library.encode(t) for t in texts]


def test_rounds_by_rank_equal_single_merges():
    path = vocabulary("piece_bpe_32k.model")
    model = pieces.PieceModel(path)
    rng = np.random.default_rng(2)
    for alphabet in ("ab", "the ing", "etaoinshrdlu", "日本éa"):
        for _ in range(40):
            symbols = model._symbols("▁" + "".join(rng.choice(list(alphabet.replace(" ", "▁")), rng.integers(1, 60))))
            assert model.by_ranks(symbols).tolist() == model.one_by_one(symbols).tolist()


def test_marks_in_a_text_are_text():
    *_, bpe, byte = ENCODERS()
    for t in ("a \x01b", "\x01", "a \x02b", "\x02 a", " \x01\n\x02", "a\x01 b\x02"):
        assert np.frombuffer(byte.batch([t])[0], "<u4").tolist() == bpe.encode(t, add_special_tokens=False).ids


def test_new_words_skip_the_steps_that_only_part_them():
    class Counted:
        def __init__(self, tokenizer):
            self.tokenizer, self.seen = tokenizer, []

        def encode(self, text, **more):
            self.seen.append(text)
            return self.tokenizer.encode(text, **more)

    byte = tokens.CachedEncoder(vocabulary("byte_bpe_50k.json"), added=True)
    library, byte.tokenizer = byte.tokenizer, Counted(byte.tokenizer)
    t = "Gmorble, gmorble gmorble... élan\nGmorble! straße's\nдом, δομή\nдом; слово' 日本 (x) a1 don't ǅx $$$ y"
    for _ in range(2):
        assert np.frombuffer(byte.batch([t])[0], "<u4").tolist() == library.encode(t, add_special_tokens=False).ids
    assert byte.tokenizer.seen == [" straße's", " (x)", " a1", " don't", " $$$"]


def test_letters_of_words_are_letters_to_the_library():
    *_, bpe, _ = ENCODERS()
    letters = [c for c in map(chr, range(0x30000)) if tokens.WORD.fullmatch(c)]
    assert len(letters) > 30_000
    assert len(bpe.pre_tokenizer.pre_tokenize_str("".join(letters))) == 1
    signs = [c for c in map(chr, range(0x250)) if tokens.WORD.fullmatch("a" + c) and not tokens.WORD.fullmatch(c)]
    assert len(signs) == 32 and [len(bpe.pre_tokenizer.pre_tokenize_str(f"a{''.join(signs)}")), len(bpe.pre_tokenizer.pre_tokenize_str("a'"))] == [2, 2]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="abGé'.,!$s \n\x01\x02日д1²ǅ ", max_size=60), max_size=4))
def test_later_pieces_are_held_for_a_while(texts):
    *_, bpe, _ = ENCODERS()
    few = ENCODERS.__dict__.setdefault("few", tokens.CachedEncoder(vocabulary("byte_bpe_50k.json"), most=24))
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in few.batch(texts)] == [bpe.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(few.cache) <= 24 and len(few.cache.young) <= 4
