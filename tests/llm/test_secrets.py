"""Secret scans against a plain Python version."""

import hashlib
import re

from tests.conftest import FOLDER
from tidemark.llm import secrets
from tidemark.llm.queries import QUERIES

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
RANDOM = "q7Zx9LmP2vRt8KwY4bNc6JhD3sFg5TaQ"
ODD = [
    (1, None), (2, ""), (3, "password: token: abcdefgh1"), (4, 'é\U0001f600 API_KEY="abc" apikey = \'12345678\' AKIAAAAABBBBCCCC1 AKIA12'),
    (5, "0" * 31 + " " + "a1" * 16 + "g" + "f" * 70_000), (5, "secret=" + "0123456789abcdef" * 2), (None, "x " + RANDOM + " y"),
    (6, "an_ordinary_identifier_of_some_length internationalisation_of_the_organisation"), (7, "token=" + "ab" * 20 + " " + "token = deadbeef1 " * 300)]


def base(text):
    text, out = text or "", []
    out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    return sorted(out)


def joined(spans):
    return ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def test_base_spans(docs_of, corpus):
    # ordinary strings are learned from the table itself, so the odd rows stand among 200 others
    ids = {i for i, _ in ODD}
    got = [r for r in secrets.find_secrets(docs_of(ODD + [(i + 1000, t) for i, t in corpus])).collect() if r.doc_id in ids]
    key = lambda r: (r[0] or 0, str(r[1]))
    mine = sorted(((r.doc_id, [(s.start, s.kind, s.end) for s in r.spans if s.kind < 3]) for r in got), key=key)
    assert mine == sorted(((i, base(t)) for i, t in ODD), key=key)
    markov = {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind == 3] for r in got}
    assert markov[None] == [(2, 2 + len(RANDOM))] and markov[6] == []
    assert secrets.find_secrets(docs_of([])).count() == 0


def test_query(spark, corpus):
    got = {r.doc_id: r for r in QUERIES["op9_secrets"](spark, FOLDER).collect()}
    assert len(got) == len(corpus)
    for i, t in corpus:
        spans = base(t)
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(sum(k == n for _, k, _ in spans) for n in range(3))
        assert got[i].base_sha256 == hashlib.sha256(joined(spans).encode()).hexdigest()
        assert [x for x in got[i].spans.split(",") if x and "markov" not in x] == [x for x in joined(spans).split(",") if x]
    assert not any("markov" in r.spans for r in got.values())


def test_redaction(spark, docs_of):
    from pyspark.sql import functions as F

    df = secrets.find_secrets(docs_of(ODD), keep=("text",))
    for r in df.select("text", "spans", secrets.redacted(F.col("text"), F.col("spans")).alias("clean")).collect():
        want, at = "", 0
        for s in r.spans:
            if s.start >= at:
                want += (r.text or "")[at:s.start] + "[SECRET]"
            at = max(at, s.end)
        assert r.clean == (r.text if not r.spans else want + r.text[at:])


def test_scores_do_not_depend_on_the_size_of_the_table(docs_of, corpus):
    ordinary = ["state-of-the-art-technology", "user_profile_settings_v2", "long-term-follow-up-studies", "src/main/java/org/apache/Utils", "release-notes-2024-01-15-final", "-" * 30, "=" * 30]
    probe = [(-1, " , ".join(ordinary)), (-2, RANDOM), (-3, "api " + RANDOM[::-1] + " end")]
    for times in (1, 40):
        found = secrets.find_secrets(docs_of(probe + [(i + 1000 * k, t) for k in range(times) for i, t in corpus]))
        got = {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind == 3] for r in found.filter("doc_id < 0").collect()}
        assert got == {-1: [], -2: [(0, len(RANDOM))], -3: [(4, 4 + len(RANDOM))]}, times


def test_odds_tend_to_a_limit(spark, docs_of, corpus):
    def odds(text, times):
        strings = spark.createDataFrame([(w,) for _, t in corpus for w in re.findall("[A-Za-z0-9+/_=-]{8,}", t or "")], "s string")
        many = strings.crossJoin(spark.range(times)).select("s")
        table = secrets._log_odds(secrets.random_strings(spark), spark.createDataFrame([], "s string"), many)
        at = [secrets.ALPHABET.index(c) for c in text]
        return sum(table[a * len(secrets.ALPHABET) + b] for a, b in zip(at, at[1:])) / (len(at) - 1)

    for text in ("state-of-the-art-technology", "src/main/java/org/apache/Utils", RANDOM):
        assert abs(odds(text, 20) - odds(text, 200)) < 0.05
