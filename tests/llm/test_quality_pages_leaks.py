"""Quality scores, page text, benchmark search and the whole pipeline."""

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import FOLDER
from tests.llm.test_groups import brute as near_brute
from tests.llm.test_secrets import base
from tidemark.llm import latent, pages, quality
from tidemark.llm.common import table
from tidemark.llm.queries import QUERIES

MORE = "/root/testdata/sf0.01"


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


# ---- quality ---------------------------------------------------------------

def test_prior_of_a_known_mixture():
    rng = np.random.default_rng(1)
    positive = rng.normal(2, 1, 20_000)
    for share in (0.3, 0.7, 0.9):
        mixed = np.concatenate((rng.normal(2, 1, int(20_000 * share)), rng.normal(-4, 1, int(20_000 * (1 - share)))))
        assert abs(quality.class_prior(positive, mixed) - share) < 0.03


def test_quality_of_held_out_rows(spark, duck):
    got = {r.doc_id: r for r in QUERIES["op2_pu_quality"](spark, MORE).collect()}
    labels = dict(duck.execute(f"SELECT doc_id, quality FROM '{MORE}/labels.parquet'").fetchall())
    assert len(got) == 1000 and all(r.held_out == held(i) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    out = [i for i in labels if held(i) and i in got]
    assert np.mean([got[i].predicted == labels[i] for i in out]) > 0.95
    assert np.mean([got[i].predicted == 0 for i in out if labels[i] == 0]) > 0.85


def test_held_out_labels_are_not_learned_from(spark):
    docs, labels = table(spark, FOLDER, "documents", "doc_id", "text"), table(spark, FOLDER, "labels", "doc_id", "quality")
    turned = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.train(docs, labels), quality.train(docs, turned)
    assert (a.weights == b.weights).all() and a.bias == b.bias


def test_quality_of_odd_rows(spark, docs_of, corpus):
    odd = [(None, None), (1, None), (2, ""), (3, "x" * 300_000), (4, "\n\n"), (4, "\n\n")]
    labels = spark.createDataFrame([(i, 1 if i % 4 else 0, 0) for i, _ in corpus] + [(None, 1, 0), (1, None, 0), (2, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(docs_of(list(corpus) + odd), labels)
    scores = [r.score for r in quality.score(docs_of(odd), model).collect()]
    assert len(scores) == 6 and all(0 <= s <= 1 for s in scores) and scores[4] == scores[5]
    nothing = quality.train(docs_of(odd), labels.limit(0))
    assert [r.score for r in quality.score(docs_of(odd), nothing).collect()] == [0.5] * 6
    assert quality.score(docs_of([]), quality.train(docs_of([]), labels)).count() == 0


def test_an_id_with_a_third_of_the_rows_is_one_positive(spark, corpus, monkeypatch):
    hot = [(0, f"word {k} of a text that is there again and again") for k in range(3000)]
    docs = spark.createDataFrame(list(corpus) + hot, "doc_id int, text string")
    labels = spark.createDataFrame([(i, 1 if i % 4 else 0) for i, _ in corpus] + [(0, 1)] * 50, "doc_id int, quality int").filter("doc_id <> 0 OR quality = 1")
    kept = quality.trusted_rows(docs, labels, 40, "doc_id", "text", "quality").collect()
    assert len(kept) <= 40 and sum("again and again" in r.text for r in kept) <= 1
    assert 0 <= quality.train(docs, labels, 40).prior <= 1


def test_prior_is_the_same_on_a_table_of_twenty_copies(spark, corpus):
    one = spark.createDataFrame([(str(i), t) for i, t in corpus], "name string, body string")
    many = one.selectExpr("name", "body", "explode(sequence(1, 20)) AS copy")
    labels = spark.createDataFrame([(str(i), 1 if i % 4 else 0) for i, _ in corpus], "name string, good int")
    names = {"id_col": "name", "text_col": "body", "label_col": "good"}
    a, b = quality.train(one, labels, **names), quality.train(many, labels, **names)
    assert abs(a.prior - b.prior) < 1e-6 and np.abs(a.weights - b.weights).max() < 0.1 * np.abs(a.weights).max()


def test_risk_of_moments_equals_the_risk_of_rows():
    rng = np.random.default_rng(8)
    p, u = (np.hstack((rng.normal(m, 1, (n, quality.WIDTH)), np.ones((n, 1)))) for m, n in ((0.3, 400), (0, 900)))
    for prior in (0.2, 0.9):
        w = rng.normal(0, 0.02, quality.WIDTH + 1)

        def risk(w):
            loss = lambda f, y: ((1 - y * f) ** 2 / 4).mean()
            second = loss(u @ w, -1) - prior * loss(p @ w, -1)
            return (prior * loss(p @ w, 1) + second if second >= 0 else -second) + 5e-4 * (w[:-1] ** 2).sum()
        g = quality._risk_gradient(quality._moments(p), quality._moments(u), prior, 1e-3)(w)
        for k in (0, 7, quality.WIDTH):
            step = np.zeros_like(w)
            step[k] = 1e-5
            assert abs((risk(w + step) - risk(w - step)) / 2e-5 - g[k]) < 1e-5


# ---- pages -----------------------------------------------------------------

def article(html):
    inner = re.search("<article>(.*)</article>", html, re.S).group(1)
    from html import unescape
    parts = re.split("</?(?:h1|p)>", inner)
    return "\n".join(x for x in (" ".join(unescape(re.sub("<[^>]*>", " ", p)).split()) for p in parts) if x)


def test_pages_query(spark, duck):
    want = {i: article(h) for i, h in duck.execute(f"SELECT page_id, html FROM '{MORE}/pages.parquet'").fetchall()}
    got = QUERIES["op5_main_text"](spark, MORE).collect()
    assert {r.page_id: r.text for r in got} == want and all(r.n_chars == len(r.text) for r in got)


LONG = "This is the text of an article that goes on for some time, as the words in it are many and it is about a thing."


@pytest.mark.parametrize("html, want", [
    (None, ""), ("", ""), ("no markup at all", ""), (LONG, LONG), (f"<p>{LONG}<p>{LONG}", f"{LONG}\n{LONG}"),
    (f"<header><h2>Site</h2></header><nav><a href=x>Home</a></nav><h1>A title</h1><p>{LONG}</p><aside><p>{LONG}</p></aside><footer>{LONG}</footer>", f"A title\n{LONG}"),
    (f"<div class='cookie-notice'>{LONG}</div><div id=main><p>{LONG}</p><p>Short one.</p><p>{LONG}</p></div><div class='comments'><p>{LONG}</p></div>", f"{LONG}\nShort one.\n{LONG}"),
    (f"<article><header><h1>T &amp; U</h1></header><p>a&nbsp;b\n\t c</p><script>x='<p>{LONG}</p>'</script><form><p>{LONG}</p></form><p>{LONG}</p></article>", f"T & U\na b c\n{LONG}"),
    (f"<article><p>Only this.</p></article><p>{LONG}</p>", "Only this."),
    (f"<p>{LONG}</p><ul>{''.join(f'<li><a href=/{k}>link number {k} of many</a></li>' for k in range(9))}</ul>", LONG),
    (f"<p>{LONG}<!-- <p>{LONG}</p> --></p><div role='navigation'>{LONG}</div><style>p{{}}</style>", LONG),
    (f"<p title='a > b'>{LONG}</p>", LONG),
    ("<" * 20_000 + "a '" * 20_000, None),
])
def test_rules_of_pages(html, want):
    got = pages.main_text(html)
    assert want is None or got == want


@pytest.mark.parametrize("html, want", [
    (f'<div class="site-content has-sidebar"><article><p>{LONG}</p></article></div>', LONG),
    (f'<div class="page no-sidebar"><p>{LONG}</p></div><div class="sidebar-right">{LONG}</div>', LONG),
    (f'<div class="sidebar-layout"><div id="nav-open"><article><p>{LONG}</p><div class="ad">{LONG}</div><p>{LONG}</p></article></div><aside>{LONG}</aside></div>', f"{LONG}\n{LONG}"),
    (f'<div id="overlay"><main><h1>Title</h1><p>{LONG}</p></main><div class="comments">{LONG}</div></div>', f"Title\n{LONG}"),
    (f'<article><h2 id="the-search-for-life">The search</h2><section id="social-effects"><p>{LONG}</p></section><div class="legal-form">{LONG}</div></article>', f"The search\n{LONG}\n{LONG}"),
    (f'<article><section id="search"><h3 id="tags">Tags</h3><p>{LONG}</p></section></article>', f"Tags\n{LONG}"),
    (f'<div data-class="nav" title="id=menu class=ad"><p>{LONG}</p></div>', LONG),
    (f'<p>{LONG}</p><h2 id="search-engines">Engines</h2><p>{LONG}</p>', f"{LONG}\nEngines\n{LONG}"),
    # what is set apart stays so
    (f'<article><p>{LONG}</p><div class="ad-slot">{LONG}</div><div class="share">{LONG}</div><ul id="breadcrumbs"><li>{LONG}</li></ul></article>', LONG),
    (f'<p>{LONG}</p><p>{LONG}</p><div class="related"><article><p>{LONG}</p></article></div>', f"{LONG}\n{LONG}"),
    (f'<article><p>{LONG}</p></article><div class="comments-area"><article><p>{LONG} {LONG}</p></article></div>', LONG),
    (f'<p>{LONG}</p><aside><article><p>{LONG} {LONG}</p></article></aside><div role="complementary"><article>{LONG} {LONG}</article></div>', LONG),
])
def test_hints_of_pages(html, want):
    assert pages.main_text(html) == want


def references(text):
    return "".join(f"&#{ord(c)};" for c in text)


def test_links_are_measured_as_the_reader_sees_them():
    words = "Это длинный абзац статьи о реках и озёрах северного края и о людях которые живут на их берегах уже много веков"
    for shown in (str, references):
        for linked in (words[:12], words[:24] + "  \n  "):
            assert pages.main_text(f"<article><p><a href=x>{shown(linked)}</a>{shown(words)}</p></article>") == " ".join((linked + words).split())
        # most of the text in links: no article text, however it is written
        assert pages.main_text(f"<div><p><a href=x>{shown(words)}</a>{shown(words[:20])}</p></div><p>{LONG}</p>") == LONG
    assert pages.main_text(f"<article><p>{LONG} <math><mi>x</mi>=<mn>2</mn></math> <object data=f>a drawing</object></p></article>") == f"{LONG} x=2 a drawing"


def test_pages_of_odd_tables(spark):
    schema = "page_id long, url string, html string, text string, n_chars int, _html int"
    rows = [(1, None, None, "x", 1, 1), (None, "u", f"<p>{LONG}</p>", "x", 1, 1), (2, "u", "<p>" + LONG * 3000, None, None, None), (2, "u", "<p>" + LONG * 3000, None, None, None)]
    got = pages.extract_pages(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.page_id or 0, r.url or "", r.n_chars) for r in got) == [(0, "u", len(LONG)), (1, "", 0), (2, "u", len(LONG) * 3000), (2, "u", len(LONG) * 3000)]
    assert pages.extract_pages(spark.createDataFrame([], schema)).count() == 0


# ---- benchmark passages ----------------------------------------------------

def plain(text):
    return " " + " ".join(re.findall(r"[^\W_]+", (text or "").lower())) + " "


def exact_leaks(docs, items):
    known = [(k, plain(t)) for k, t in items if plain(t).strip()]
    return {(i, k) for i, t in docs for k, x in known if x in plain(t)}


def found(df):
    return {(r.doc_id, k) for r in df.collect() for k in r["items"]}


def test_leaks_query(spark, duck):
    docs = duck.execute(f"SELECT doc_id, text FROM '{MORE}/documents.parquet'").fetchall()
    items = duck.execute(f"SELECT item_id, text FROM '{MORE}/benchmark.parquet'").fetchall()
    df = QUERIES["op6_latent_leaks"](spark, MORE)
    assert df.count() == len(docs) and found(df) == exact_leaks(docs, items)


def test_leaks_in_odd_rows(spark, docs_of, duck, corpus):
    items = duck.execute(f"SELECT item_id, text FROM '{FOLDER}/benchmark.parquet' ORDER BY item_id").fetchall()
    rng = np.random.default_rng(4)
    words = items[3][1].split()
    swapped = [w if k % 8 else f"other{k}" for k, w in enumerate(words)]
    rows = list(corpus) + [(9000, None), (9001, ""), (9002, "one"), (9003, " ".join(swapped)), (9004, " ".join(rng.permutation(words))), (9005, "so " * 20_000 + items[5][1].upper() + " so" * 20_000), (9005, "so " * 20_000 + items[5][1].upper() + " so" * 20_000), (None, items[6][1])]
    bench = spark.createDataFrame([*items, (None, "a b c"), (70, None), (71, ""), (3, items[3][1])], "item_id long, text string")
    got = found(latent.contaminated(docs_of(rows), bench, items_a_pass=15))
    assert {g for g in got if g[0] is not None and g[0] >= 9000} == {(9003, 3), (9005, 5)}
    assert {g for g in got if g[0] is not None and g[0] < 9000} == exact_leaks(corpus, items)
    assert latent.contaminated(docs_of([]), bench).count() == 0
    assert not any(r.contaminated for r in latent.contaminated(docs_of(rows[:20]), bench.limit(0)).collect())


def test_short_items_inside_foreign_text(spark, docs_of, duck):
    texts = [plain(t).split() for _, t in duck.execute(f"SELECT doc_id, text FROM '{MORE}/documents.parquet' ORDER BY doc_id LIMIT 400").fetchall()]
    texts = [w for w in texts if len(w) > 250]
    rng = np.random.default_rng(9)
    items, rows, want = [], [], set()
    for n in range(240):
        size = (6, 8, 10, 12, 16, 20)[n % 6]
        source, host = texts[n % len(texts)], texts[(n + 7) % len(texts)][:200]
        words = source[30: 30 + size]
        changed = rng.permutation(size)[: size // 5] if n % 2 and size > 14 else []
        items.append((n, " ".join(words)))
        rows.append((n, " ".join(host[:90] + [f"other{n}" if k in changed else w for k, w in enumerate(words)] + host[90:])))
        want.add((n, n))
    df = latent.contaminated(docs_of(rows), spark.createDataFrame(items, "item_id long, text string"))
    assert want <= found(df)
    # and by the latent search alone: nine in ten of every size
    led = {(r.doc_id, k) for r in df.collect() for k in r.latent_items}
    for size in (6, 8, 10, 12, 16, 20):
        mine = {(n, n) for n in range(240) if (6, 8, 10, 12, 16, 20)[n % 6] == size}
        assert len(mine & led) >= 0.9 * len(mine)


def test_moved_parts_count_where_the_latent_search_led(spark, docs_of, duck):
    texts = [plain(t).split() for _, t in duck.execute(f"SELECT doc_id, text FROM '{MORE}/documents.parquet' ORDER BY doc_id LIMIT 400").fetchall()]
    texts = [w for w in texts if len(w) > 250]
    rng = np.random.default_rng(15)
    items, rows = [], []
    for n in range(60):
        words, host = texts[n % len(texts)][30: 30 + 24], texts[(n + 7) % len(texts)][:200]
        items.append((n, " ".join(words)))
        for k, body in enumerate((words[16:] + words[8:16] + words[:8], rng.permutation(words).tolist())):
            rows.append((2 * n + k, " ".join(host[:90] + body + host[90:])))
    bench = spark.createDataFrame(items, "item_id long, text string")
    own = lambda df: {(i, k) for i, k in found(df) if i // 2 == k}
    got = own(latent.contaminated(docs_of(rows), bench))
    assert len({i for i, _ in got if i % 2 == 0}) >= 54 and not any(i % 2 for i, _ in got)
    # without its candidates none is: what the search finds decides
    assert not own(latent.contaminated(docs_of(rows), bench, cosine=9.0))


def test_moved_share():
    def plainly(words, item, order):
        m, best = len(item), 0
        for a in range(len(words)):
            part = words[a: a + 2 * m]
            met = [i for i in range(len(part) - 2) if any(part[i: i + 3] == item[k: k + 3] for k in range(m - 2))]
            held = {k + x for i in met for k in range(m - 2) for x in range(3) if part[i: i + 3] == item[k: k + 3]}
            best = max(best, min(len(held), len({i + x for i in met for x in range(3)})))
        return best / m if best and best >= order * m else 0.0

    rng = np.random.default_rng(16)
    hits = 0
    for _ in range(500):
        item, text = rng.integers(0, 9, rng.integers(1, 14)).tolist(), rng.integers(0, 12, rng.integers(0, 40)).tolist()
        for _ in range(rng.integers(0, 5)):
            a = rng.integers(0, len(item))
            text[len(text) // 2: len(text) // 2] = item[a: a + 5]
        want = plainly(text, item, 0.75)
        hits += want > 0
        assert latent.moved_share(text, latent._run_places(item), len(item), 0.75) == want
    assert 50 < hits < 450


def test_places_hold_every_passing_stretch():
    rng = np.random.default_rng(11)
    for _ in range(60):
        items = [rng.integers(1, 40, rng.integers(1, 14)).tolist() for _ in range(6)]
        ends = np.cumsum([0, *rng.integers(0, 60, 5)])
        words = rng.integers(1, 40, ends[-1]).astype(np.uint64)
        got = list(latent.RareWords(items, rng.random(1 << latent.FREQUENCY_BITS), 0.55).places(words, ends))
        for k, item in enumerate(items):
            m = len(item)
            for t, (low, high) in enumerate(zip(ends, ends[1:])):
                for a in range(low, high):
                    b = min(high, a + 2 * m)
                    hit = [i for i in range(a, b) if words[i] in item]
                    if hit and latent.common_subsequence(latent._places(item), words[a:b].tolist()) >= 0.55 * m:
                        assert any(x[:2] == (t, k) and x[2] <= hit[0] and hit[-1] < x[3] for x in got)


def plainly_best(words, item, order, loose):
    """Every stretch of twice the item's length, one after another."""
    m, tail, best = len(item), item[-max(3, len(item) // 4):], 0
    bits, answer = latent._places(item), latent._places(tail)
    for a in range(len(words)):
        part = words[a: a + 2 * m]
        share = latent.common_subsequence(bits, part)
        if share >= order * m or share >= loose * m and latent.common_subsequence(answer, part) >= order * len(tail):
            best = max(best, share)
    return best / m


def test_both_rules_at_every_place():
    rng = np.random.default_rng(12)
    hits = 0
    for n in range(600):
        item = rng.integers(1, 60, rng.integers(3, 16)).tolist()
        text = []
        for w in item:  # the item's words in order, some left out, others between
            text += [w] * int(rng.random() < 0.8) + rng.integers(1, 80, rng.integers(0, 4)).tolist()
        text = rng.integers(1, 80, rng.integers(0, 40)).tolist() + text + rng.integers(1, 80, rng.integers(0, 40)).tolist()
        want = plainly_best(text, item, 0.75, 0.55)
        hits += want > 0
        assert latent.best_share(text, latent._places(item), latent._places(item[-max(3, len(item) // 4):]), len(item), 0.75, 0.55) == want
    assert 100 < hits < 550


def test_words_spread_over_twice_the_length(spark, docs_of):
    rng = np.random.default_rng(13)
    item = [f"item{k}" for k in range(40)]
    rows = []
    for n in range(40):
        kept = sorted(rng.permutation(40)[:30])
        at = np.sort(np.append(rng.permutation(np.arange(1, 77))[:28], (0, 77)))  # 30 places within 78 words
        body = [f"other{n}x{k}" for k in range(78)]
        for k, x in zip(at, kept):
            body[k] = item[x]
        rows.append((n, " ".join([f"before{n}"] * n + body + [f"after{n}"] * 50)))
    got = latent.contaminated(docs_of(rows), spark.createDataFrame([(1, " ".join(item))], "item_id long, text string"))
    assert sorted(r.doc_id for r in got.collect() if r.contaminated) == list(range(40))


def test_common_subsequence():
    rng = np.random.default_rng(7)
    for _ in range(200):
        a, b = rng.integers(0, 5, rng.integers(0, 30)).tolist(), rng.integers(0, 5, rng.integers(0, 30)).tolist()
        table_ = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table_[i + 1][j + 1] = table_[i][j] + 1 if x == y else max(table_[i][j + 1], table_[i + 1][j])
        assert latent.common_subsequence(latent._places(a), b) == table_[-1][-1]


# ---- pipeline --------------------------------------------------------------

def test_pipeline_equals_its_stages_done_plainly(spark, duck):
    from sentencepiece import SentencePieceProcessor

    from tidemark.llm.queries import vocabulary

    docs = dict(duck.execute(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall())
    items = duck.execute(f"SELECT item_id, text FROM '{FOLDER}/benchmark.parquet'").fetchall()
    frame = table(spark, FOLDER, "documents", "doc_id", "text")
    model = quality.train(frame, table(spark, FOLDER, "labels", "doc_id", "quality"))
    good = [(i, t) for i, t in docs.items() if model.scores(np.array([quality.features(t)]))[0] >= 0.5]
    single = {i for i, _, root, _ in near_brute(good, percent=80) if i == root}
    kept = [(i, t) for i, t in good if i in single]
    leaks = {i for i, _ in exact_leaks(kept, items)}
    sp = SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    want = []
    for i, t in kept:
        if i not in leaks:
            clean, at = "", 0
            for s, _, e in base(t):
                if s >= at:
                    clean += t[at:s] + "[SECRET]"
                at = max(at, e)
            want.append((i, sp.encode(clean + t[at:]), sp.decode(sp.encode(clean + t[at:]))))
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted((r.doc_id, r.ids, r.decoded) for r in got) == sorted(want)


def test_stages_keep_the_columns_and_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, size int, spans int"
    rows = [(1, None, None, None, None, 1, 1), (2, "", "en", "s", 0, 1, 1), (None, "the words of a text and the end", "en", "s", None, 1, 1), (3, "token = abcdefgh1234", "en", "s", 20, 1, 1)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for _, stage in corpus_pipeline.STAGES[1:-1]:
            out = stage(spark, docs, FOLDER)
            assert out.columns == corpus_pipeline.COLUMNS and out.count() == len(data)
        assert corpus_pipeline.keep_good(spark, docs, FOLDER).columns == corpus_pipeline.COLUMNS
    clean = corpus_pipeline.redact_secrets(spark, spark.createDataFrame(rows, schema), FOLDER)
    assert [(r.text, r.n_chars) for r in clean.filter("doc_id = 3").collect()] == [("[SECRET]", 8)]
