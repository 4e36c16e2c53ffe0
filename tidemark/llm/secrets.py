"""Secrets: fixed patterns, and character Markov models of random against ordinary strings.

Everything here is DataFrame functions; no Python runs on the executors.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import prepare

# fixed values: the base kinds, in the order in which spans at one place are listed
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGNED = ASSIGN.removesuffix("+)") + "{8,})"  # only values that are long enough
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
RUN = r"[A-Za-z0-9+/_=-]{%d,}"
BLOCK = 64


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0), lambda s, x: s + x)


def _before(lengths: Column) -> Column:
    """For each element of an int array the sum of all before it.

    Sums blocks first, so a text with many matches costs far less than the square.
    """
    blocks = F.sequence(F.lit(0), F.greatest(F.lit(0), F.expr("0") + ((F.size(lengths) - 1) / BLOCK).cast("int")))
    totals = F.transform(blocks, lambda b: _sum(F.slice(lengths, b * BLOCK + 1, BLOCK)))

    def block(b: Column) -> Column:
        base = _sum(F.slice(totals, F.lit(1), b))
        part = F.slice(lengths, b * BLOCK + 1, BLOCK)
        return F.transform(part, lambda _, i: base + _sum(F.slice(part, F.lit(1), i)))

    return F.flatten(F.transform(blocks, block))


def _spans(df: DataFrame, text: str, pattern: str, kind: str, least: int, out: str, group: int = 0, quick: str | None = None, value: str | None = None) -> DataFrame:
    """Adds ``out``: the leftmost non-overlapping matches whose ``group`` has ``least`` characters.

    A span is (start, kind number, end). Splitting by the pattern gives the texts
    between the matches, so running lengths give the places.
    """
    number = KINDS.index(kind)
    hit = F.col(text).rlike(quick or pattern)
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    judged = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(group)) if group else found
    none = F.array().cast("array<string>")
    df = df.withColumn("_found", F.when(hit, found).otherwise(none))
    df = df.withColumn("_judged", F.when(F.size("_found") > 0, judged).otherwise(none) if group else F.col("_found"))
    df = df.withColumn("_between", F.when(F.size("_found") > 0, F.split(F.col(text), pattern, -1)).otherwise(none))
    steps = F.zip_with(F.slice("_between", F.lit(1), F.size("_found")), "_found", lambda p, m: F.length(p) + F.length(m))
    df = df.withColumn("_steps", steps).withColumn("_at", _before(F.col("_steps")))
    ends = F.transform("_steps", lambda x, i: F.get("_at", i) + x)
    spans = F.transform("_found", lambda m, i: F.struct(
        (F.get(F.col("_ends"), i) - F.length(m)).alias("start"), F.lit(number).alias("kind"), F.get(F.col("_ends"), i).alias("end"),
        F.length(F.get("_judged", i)).alias("n"), m.alias("value")))
    df = df.withColumn("_ends", ends)
    kept = F.filter(spans, lambda s: s["n"] >= least)
    df = df.withColumn(out, F.transform(kept, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    if value:
        df = df.withColumn(value, F.transform(kept, lambda s: s["value"]))
    return df.drop("_found", "_judged", "_between", "_steps", "_at", "_ends")


def base_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``assign``, ``access`` and ``hex``: arrays of (start, kind, end) in code points."""
    df = docs.withColumn("_text", F.coalesce(F.col(text_col), F.lit("")))
    df = _spans(df, "_text", ASSIGN, "assign", 8, "assign", group=2)
    df = _spans(df, "_text", ACCESS, "access", 16, "access")
    # a run of 32 or more is the whole of a run found by the shorter pattern
    df = _spans(df, "_text", "[0-9a-f]{32,}", "hex", 32, "hex")
    return df.drop("_text")


def _log_odds(sample: DataFrame, found: DataFrame, ordinary: DataFrame, share: float = 0.1) -> list[float]:
    """For each pair of characters, how much likelier the second follows the first in random strings.

    Each input has a column ``s``; a pair counts once for each string that has it.
    The random model is the even mixture of two, one learned from the sample and
    one from what was found, so neither drowns the other. Pairs are counted where
    they lie: at most alphabet-squared rows leave a task or reach the driver.

    A character's counts are smoothed by ``share`` of their sum, and by one count
    in all, so ratios tend to a limit as the input grows. That is spread evenly,
    in the ordinary model half of it on the character itself, as rules are drawn
    by one repeated character.
    """
    n = len(ALPHABET)
    models = {"sample": sample, "found": found, "ordinary": ordinary}

    def pairs(name: str) -> DataFrame:
        all_pairs = F.transform(F.sequence(F.lit(1), F.length("s") - 1), lambda i: F.col("s").substr(i, F.lit(2)))
        two = models[name].filter(F.length("s") > 1).select(F.explode(F.array_distinct(all_pairs)).alias("two"))
        return two.groupBy("two").agg(F.count("*").alias("n")).select("two", "n", F.lit(name).alias("model"))

    counts = {m: [0.0] * (n * n) for m in models}
    for r in pairs("sample").unionByName(pairs("found")).unionByName(pairs("ordinary")).collect():
        counts[r.model][ALPHABET.index(r.two[0]) * n + ALPHABET.index(r.two[1])] += r.n
    even = [1 / n] * (n * n)
    spread = {"sample": even, "found": even, "ordinary": [(1 / n + (k // n == k % n)) / 2 for k in range(n * n)]}
    total = {m: [sum(c[k: k + n]) for k in range(0, n * n, n)] for m, c in counts.items()}
    chance = {m: [(c[k] + (share * total[m][k // n] + 1) * spread[m][k]) / ((1 + share) * total[m][k // n] + 1) for k in range(n * n)] for m, c in counts.items()}
    return [math.log((a + b) / 2 / c) for a, b, c in zip(chance["sample"], chance["found"], chance["ordinary"])]


def random_strings(spark, count: int = 3000) -> DataFrame:
    """A labelled sample of random strings: base-64 and hexadecimal digests of numbers."""
    digest = F.sha2(F.col("id").cast("string"), 256)
    return spark.range(count).select(F.explode(F.array(F.regexp_replace(F.base64(F.unhex(digest)), "=", ""), F.substring(digest, 1, 40))).alias("s"))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), random: DataFrame | None = None, least: int = 20, odds: float = 0.5) -> DataFrame:
    """One row per document: ``id_col``, the columns to ``keep``, and ``spans``.

    ``spans`` is an array of (start, kind, end), ordered, in code points, end
    exclusive; kinds are numbered as in ``KINDS``. The three base kinds are
    patterns. The fourth is a run of ``least`` or more characters of the base-64
    alphabet that overlaps no base span and is random rather than ordinary: the
    mean log-likelihood ratio a character of two first-order Markov models is
    ``odds`` or more. The random model learns from ``random`` (column ``s``;
    digests by default) and from the hexadecimal strings and access keys found by
    pattern in all documents; the ordinary model from all other runs of 8 or more
    characters of that alphabet in all documents, each run once a text, but for
    those with digits between letters, among which random strings are that no
    pattern finds.

    Null texts are empty and have no spans; rows are scanned one by one, in any
    number, equal or not, without a shuffle; other columns are ignored unless
    kept. Without documents or hits the models rest on the sample and on the
    smoothing.
    """
    spark = prepare(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    plain = F.when(text.rlike(ASSIGNED), F.regexp_replace(text, ASSIGNED, " ")).otherwise(text)
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(plain, F.lit(RUN % 8), F.lit(0)))).alias("s")).filter(~F.col("s").rlike("[0-9a-f]{32,}|AKIA[A-Z0-9]{12,}|[A-Za-z][0-9]+[A-Za-z]"))
    hits = docs.select(F.explode(F.concat(
        F.when(text.rlike("[0-9a-f]{32,}"), F.regexp_extract_all(text, F.lit("[0-9a-f]{32,}"), F.lit(0))).otherwise(F.array().cast("array<string>")),
        F.when(text.contains("AKIA"), F.regexp_extract_all(text, F.lit("AKIA[A-Z0-9]{12,}"), F.lit(0))).otherwise(F.array().cast("array<string>")))).alias("s"))
    table = _log_odds(random if random is not None else random_strings(spark), hits, words)

    n = len(ALPHABET)
    weights = F.split(F.lit(",".join(f"{x:.6f}" for x in table)), ",").cast("array<double>")
    row = docs.select(F.col(id_col), *keep, text.alias("_t"))
    row = base_spans(row, "_t").withColumn("_base", F.array_sort(F.concat("assign", "access", "hex")))
    row = _spans(row, "_t", RUN % least, "markov", least, "_runs", value="_values")

    def score(s: Column) -> Column:
        def step(total: Column, i: Column) -> Column:
            a, b = F.instr(F.lit(ALPHABET), s.substr(i, F.lit(1))), F.instr(F.lit(ALPHABET), s.substr(i + 1, F.lit(1)))
            return total + F.get(weights, (a - 1) * n + b - 1)
        return F.aggregate(F.sequence(F.lit(1), F.length(s) - 1), F.lit(0.0), step) / (F.length(s) - 1)

    free = F.filter(F.arrays_zip("_runs", "_values"), lambda r: ~F.exists("_base", lambda b: (b["start"] < r["_runs"]["end"]) & (b["end"] > r["_runs"]["start"])))
    likely = F.filter(free, lambda r: score(r["_values"]) >= odds)
    more = F.transform(likely, lambda r: r["_runs"])
    return row.select(F.col(id_col), *keep, F.array_sort(F.concat("_base", more)).alias("spans"))


def span_text(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each span, or run of overlapping spans, replaced by a mark."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a: Column, s: Column) -> Column:
        gap = F.substring(text, a["at"] + 1, s["start"] - a["at"])
        return F.when(s["start"] >= a["at"], F.struct(s["end"].alias("at"), F.concat(a["out"], gap, F.lit(mark)).alias("out"))) \
            .otherwise(F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out")))

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, start, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text)))))
