"""Benchmark passages in documents, found in a latent semantic space and checked word by word."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import prepare, written
from tidemark.llm.near_dups import slices, word_hashes

#: White space and ASCII punctuation part words here.
BREAKS = np.zeros(256, bool)
BREAKS[[k for k in range(128) if not chr(k).isalnum()]] = True
FREQUENCY_BITS, FEATURES, RANK, EXTRA = 16, 1024, 128, 16
CHUNK, PASSAGE, SHORT = 16, 64, 12
RUN = 3  # words that stand together when an item's parts are moved
PIECE = 1 << 17  # bytes at a time: the arrays then stay in the processor's caches


def _features(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word: its frequency bucket, its feature, and the feature's sign."""
    feature = (hashes & np.uint64(FEATURES - 1)).astype(np.int64)
    sign = 1.0 - 2.0 * ((hashes >> np.uint64(20)) & np.uint64(1)).astype(np.float32)
    return (hashes >> np.uint64(64 - FREQUENCY_BITS)).astype(np.int64), feature, sign.astype(np.float32)


def _runs(ends: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of ``width`` words begin, none of them across texts, and the text of each."""
    counts = np.diff(ends)
    runs = -(-counts // width)
    text = np.repeat(np.arange(len(counts)), runs)
    place = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
    return ends[:-1][text] + place * width, text


def _summed(docs: DataFrame, text_col: str, partial, size: int) -> np.ndarray:
    """Adds up one array of ``size`` numbers per task; entries are summed by Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            for _, data, at in slices(b.column("text"), PIECE):
                partial(total, *word_hashes(data, at, BREAKS))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["k", "x"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "k long, x double").groupBy("k").agg(F.sum("x").alias("x")).toArrow()
    out = np.zeros(size)
    out[rows.column("k").to_numpy()] = rows.column("x").to_numpy()
    return out


def inverse_frequencies(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Inverse document frequency by word bucket, over all documents."""
    size = 1 << FREQUENCY_BITS

    def count(total: np.ndarray, hashes: np.ndarray, ends: np.ndarray) -> None:
        # pieces hold less than 2^16 texts or one, so text and bucket fit 32 bits, which sort faster
        bucket = (hashes >> np.uint64(64 - FREQUENCY_BITS)).astype(np.uint32)
        for a in range(0, len(ends) - 1, 1 << 16):
            cut = ends[a: a + (1 << 16) + 1]
            text = np.repeat(np.arange(len(cut) - 1, dtype=np.uint32), np.diff(cut))
            seen = np.unique(text << np.uint32(FREQUENCY_BITS) | bucket[cut[0]: cut[-1]])
            total += np.bincount(seen & np.uint32(size - 1), minlength=size)

    found = _summed(docs, text_col, count, size)
    return np.log((1 + found.max()) / (1 + found)) + 0.05


def latent_space(docs: DataFrame, idf: np.ndarray, text_col: str = "text") -> np.ndarray:
    """Word features to ``RANK`` latent dimensions of equal variance, from all passages.

    Randomised SVD in one pass: every task multiplies its TF-IDF passages (rows of
    length 1) to a random matrix and back, the products are summed, and the
    Nystroem formula gives the leading right singular vectors and values. These
    are divided by the values, so that dimensions common to a whole language do
    not make all its passages alike.
    """
    width = RANK + EXTRA
    random = np.random.default_rng(6).normal(size=(FEATURES, width)).astype(np.float32)
    weight = idf.astype(np.float32)

    def multiply(total: np.ndarray, hashes: np.ndarray, ends: np.ndarray) -> None:
        bucket, feature, sign = _features(hashes)
        begins, _ = _runs(ends, PASSAGE)
        if not len(begins):
            return
        row = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(hashes))))
        a = np.bincount(row * FEATURES + feature, weights=weight[bucket] * sign, minlength=len(begins) * FEATURES).astype(np.float32).reshape(-1, FEATURES)
        a /= np.maximum(np.sqrt((a * a).sum(1, keepdims=True)), 1e-6)
        total += (a.T @ (a @ random)).astype(np.float64).reshape(-1)

    y = _summed(docs, text_col, multiply, FEATURES * width).reshape(FEATURES, width)
    shift = 1e-7 * np.linalg.norm(y) + 1e-12
    y = y + shift * random
    core = random.T.astype(np.float64) @ y
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    keep = values > values.max() * 1e-10
    u, s, _ = np.linalg.svd(y @ vectors[:, keep] / np.sqrt(values[keep]), full_matrices=False)
    u, s = u[:, :RANK], np.maximum(s[:RANK], s[0] * 1e-4)
    return (u / s * s[-1]).astype(np.float32)


def common_subsequence(item: dict[int, int], text: list[int]) -> int:
    """Length of the longest common subsequence; ``item`` maps each word to the bits of its places."""
    row = 0
    for w in text:
        found = item.get(w)
        if found is not None:
            x = row | found
            row = x & ~(x - ((row << 1) | 1))
    return row.bit_count()


def _places(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for k, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << k
    return out


def met_words(words: list[int], item: dict[int, int], least: int) -> tuple[list[int], list[int], int]:
    """Places of an item's words, the bits of each, and how many of the item's words they can stand for; 0 if under ``least``."""
    spots, bits = [], []
    for i, w in enumerate(words):
        found = item.get(w)
        if found is not None:
            spots.append(i)
            bits.append(found)
    # a word counts as often as the item has it at most: frequent words alone are not enough
    held = sum(min(n, x.bit_count()) for x, n in Counter(bits).items()) if len(spots) >= least else 0
    return spots, bits, held if held >= least else 0


def best_share(words: list[int], item: dict[int, int], answer: dict[int, int], m: int, order: float, loose: float) -> float:
    """The largest share of an item of ``m`` words that passes in some stretch of 2 m words; 0 if none does."""
    spots, bits, held = met_words(words, item, _least(m, loose))
    return share_in_order(words, spots, bits, answer, m, order, loose) if held else 0.0


def _least(m: int, loose: float) -> int:
    return max(1, int(np.ceil(loose * m - 1e-9)))


def share_in_order(words: list[int], spots: list[int], bits: list[int], answer: dict[int, int], m: int, order: float, loose: float) -> float:
    """``best_share`` from the places of the item's words.

    A stretch may as well begin at a word of the item, so those are tried in turn.
    A later stretch can only gain the words that come in at its end: stretches
    that can not reach the least share, or the best so far, are passed over.
    """
    least, i, best = _least(m, loose), 0, 0
    last = sum(x.bit_count() for x in answer.values())
    while i < len(spots):
        end = bisect_left(spots, spots[i] + 2 * m, i)
        seen = end - i
        if seen >= max(least, best + 1):
            row = 0
            for found in bits[i:end]:
                x = row | found
                row = x & ~(x - ((row << 1) | 1))
            seen = row.bit_count()
            if seen >= max(least, best + 1) and (seen >= order * m or common_subsequence(answer, [words[k] for k in spots[i:end]]) >= order * last):
                best = seen
        # the next stretch that can hold enough: as many words must have come in as are lacking
        lacking = max(least, best + 1) - seen
        i = i + 1 if lacking <= 0 else max(i + 1, bisect_left(spots, spots[end + lacking - 1] - 2 * m + 1) if end + lacking <= len(spots) else len(spots))
    return best / m


def _run_places(words: list[int]) -> dict[tuple[int, ...], list[int]]:
    """Each run of ``RUN`` words of an item, with the places of the words that it covers."""
    out: dict[tuple[int, ...], set[int]] = {}
    for k in range(len(words) - RUN + 1):
        out.setdefault(tuple(words[k: k + RUN]), set()).update(range(k, k + RUN))
    return {run: sorted(places) for run, places in out.items()}


def moved_share(words: list[int], runs: dict[tuple[int, ...], list[int]], m: int, order: float) -> float:
    """The largest share of an item of ``m`` words that stands in runs of ``RUN`` words or more within 2 m words, in any order of the runs; 0 below ``order``.

    A word of the text stands for one of the item's at most.
    """
    met = [(i, runs[run]) for i, run in enumerate(zip(*(words[k:] for k in range(RUN)))) if run in runs]
    count, held, covered, first, best = [0] * m, 0, 0, 0, 0
    for n, (i, places) in enumerate(met):
        covered += min(RUN, i - met[n - 1][0]) if n > first else RUN
        for p in places:
            held += count[p] == 0
            count[p] += 1
        while met[first][0] + 2 * m < i + RUN:
            covered -= min(RUN, met[first + 1][0] - met[first][0])
            for p in met[first][1]:
                count[p] -= 1
                held -= count[p] == 0
            first += 1
        best = max(best, min(held, covered))
    return best / m if best and best >= order * m else 0.0


class RareWords:
    """Finds the places of texts where the check may pass, all of them, by the items' rarest words.

    An item of m words passes only where ``need`` of its words stand within 2 m.
    As all but ``need`` - r of its words are kept, the rarest ones, at least r of
    those stand there.
    """

    def __init__(self, items: list[list[int]], idf: np.ndarray, loose: float, meet: int = 5):
        self.reach = np.array([2 * len(w) for w in items], np.int64)
        need = [_least(len(w), loose) for w in items]
        self.meet = np.minimum(need, meet)
        pairs = set()
        for k, (words, n, r) in enumerate(zip(items, need, self.meet.tolist())):
            weight = idf[_features(np.array(words, np.uint64))[0]]
            # the words themselves break ties, so that an item's repeated word is kept or left as one
            rare = sorted(zip((-weight).tolist(), words))[: len(words) - n + r]
            pairs.update((w, k) for _, w in rare)
        flat = sorted(pairs)
        self.words, begins = np.unique(np.array([w for w, _ in flat], np.uint64), return_index=True)
        self.at = np.append(begins, len(flat))
        self.items = np.array([k for _, k in flat], np.int64)
        self.known = np.zeros(1 << 20, bool)
        self.known[self.words & np.uint64((1 << 20) - 1)] = True

    def places(self, hashes: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, begin, end): stretches of words in which every passing stretch of 2 m lies."""
        at = np.flatnonzero(self.known[hashes & np.uint64((1 << 20) - 1)])
        word = np.minimum(np.searchsorted(self.words, hashes[at]), len(self.words) - 1)
        same = self.words[word] == hashes[at]
        at, word = at[same], word[same]
        count = self.at[word + 1] - self.at[word]
        place = np.repeat(at, count)
        item = self.items[np.arange(count.sum()) + np.repeat(self.at[word] - np.cumsum(count) + count, count)]
        order = np.lexsort((place, item))
        place, item = place[order], item[order]
        last = np.arange(len(place)) + self.meet[item] - 1
        inside = np.flatnonzero(last < len(place))
        last = last[inside]
        text = np.searchsorted(ends, place[inside], "right") - 1
        met = (item[inside] == item[last]) & (place[last] - place[inside] < self.reach[item[inside]]) & (place[last] < ends[text + 1])
        first, last, text = inside[met], last[met], text[met]
        k = item[first]
        begin = np.maximum(ends[text], place[last] - self.reach[k] + 1)
        end = np.minimum(ends[text + 1], place[first] + self.reach[k])
        held: list[int] = []
        for row in zip(text.tolist(), k.tolist(), begin.tolist(), end.tolist()):
            if held and held[:2] == [*row[:2]] and row[2] <= held[3]:
                held[3] = max(held[3], row[3])
                continue
            if held:
                yield tuple(held)
            held = [*row]
        if held:
            yield tuple(held)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", cosine: float = 0.35, order: float = 0.75, loose: float = 0.55, items_a_pass: int = 4000) -> DataFrame:
    """One row per document: ``id_col``, contaminated, items (ascending ids), overlap and latent_items (those that the latent search led to).

    Words are runs of letters, digits and other non-ASCII characters, in small
    letters. 1. Words get inverse document frequencies, and a randomised SVD of all TF-IDF
       passages a latent space; both are sums over all documents.
    2. Windows of 32 and 64 words (16 too, for items of up to 12), beginning at
       every 16th word of every text, and the items are compared there; a cosine
       of ``cosine`` or more is a candidate.
    3. A stretch of text is compared with an item word by word: the longest common
       subsequence must hold ``order`` of the item's words, or ``loose`` of them
       together with ``order`` of its answer, the words of its last quarter; it
       must lie within twice the item's length. No stretch can pass without
       enough of the item's rarest words close together, so candidates are
       compared where those stand.
    4. A candidate's stretch also counts where the item's parts were moved, so
       that few words are in order: ``order`` of its words must stand there in
       runs of three or more. Words out of their order alone say little, so
       this rule holds only where the latent search led.
    5. So that no passage in the item's order is lost in the latent space, stretches
       with enough of the rarest words are compared in order even where no window
       was a candidate.

    ``overlap`` is the largest share found (0 without any). Items go to all tasks
    ``items_a_pass`` at a time, which bounds what is sent; more items take more
    passes over the documents. Null or wordless texts and items match nothing;
    an item with several rows, or a repeated document, is compared row by row; a
    text of any length is compared whole. Rows with one id share what is found;
    a null id has nothing.
    """
    spark = prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.lower(text_col).alias("text"))
    kind = dict(rows.dtypes)["id"]
    idf = inverse_frequencies(rows)
    space = latent_space(rows, idf)
    weight = idf.astype(np.float32)

    def embedded(hashes: np.ndarray, begins: np.ndarray) -> np.ndarray:
        bucket, feature, sign = _features(hashes)
        rows_ = space[feature]
        rows_ *= (weight[bucket] * sign)[:, None]
        return np.add.reduceat(rows_, begins, axis=0)

    def search(known: list[tuple[int, list[int]]]):
        flat = np.array([w for _, words in known for w in words], np.uint64)
        begins = np.cumsum([0] + [len(w) for _, w in known])[:-1]
        vectors = embedded(flat, begins)
        vectors /= np.maximum(np.sqrt((vectors * vectors).sum(1, keepdims=True)), 1e-12)
        bits = [_places(words) for _, words in known]
        rare = RareWords([words for _, words in known], idf, loose)
        answers = [_places(words[-max(3, len(words) // 4):]) for _, words in known]
        runs = [_run_places(words) for _, words in known]

        least = [_least(len(words), loose) for _, words in known]

        def check(words: list[int], k: int, led) -> float:
            """The share of item k's words that the text has in their order, or in moved runs where the latent search ``led``; 0 if too few."""
            m = len(known[k][1])
            spots, met, held = met_words(words, bits[k], least[k])
            best = share_in_order(words, spots, met, answers[k], m, order, loose) if held else 0.0
            return moved_share(words, runs[k], m, order) if not best and held >= order * m and led() else best

        short = np.flatnonzero([len(words) <= SHORT for _, words in known])

        def found_in(hashes: np.ndarray, ends: np.ndarray) -> dict[int, dict[int, tuple[float, bool]]]:
            """Per text and item the best share, and whether the latent search led to it."""
            out: dict[int, dict[int, tuple[float, bool]]] = {}
            begins, text = _runs(ends, CHUNK)
            if not len(begins):
                return out
            one = embedded(hashes, begins)

            def wider(z: np.ndarray, by: int) -> np.ndarray:
                z = z.copy()
                if len(z) > by:
                    z[:-by][text[:-by] == text[by:]] += z[by:][text[:-by] == text[by:]]
                return z

            two = wider(one, 1)
            hits: dict[tuple[int, int], list[tuple[int, int]]] = {}
            for z, width, which in ((one, 1, short), (two, 2, None), (wider(two, 2), 4, None)):
                if which is not None and not len(which):
                    continue
                least = np.maximum(np.sqrt(np.einsum("ij,ij->i", z, z)), 1e-12) * np.float32(cosine)
                near = z @ (vectors if which is None else vectors[which]).T >= least[:, None]
                for c, k in zip(*(x.tolist() for x in np.nonzero(near))):
                    hits.setdefault((int(text[c]), k if which is None else int(which[k])), []).append((int(begins[c]), int(begins[c]) + width * CHUNK))
            # a candidate passes only where enough of its item's rarest words stand, so those stretches are compared, once each
            for t, k, a, b in rare.places(hashes, ends):
                led = lambda: any(low < b and a < high for low, high in hits.get((t, k), ()))  # noqa: B023, E731
                best = check(hashes[a:b].tolist(), k, led)
                if best:
                    near_by = led()
                    before = out.setdefault(t, {}).get(known[k][0], (0.0, False))
                    out[t][known[k][0]] = (max(best, before[0]), near_by or before[1])
            return out

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                names, ids, items, shares, latent = b.column("id"), [], [], [], []
                for i, data, at in slices(b.column("text"), PIECE):
                    for t, best in found_in(*word_hashes(data, at, BREAKS)).items():
                        ids += [i + t] * len(best)
                        items += list(best)
                        shares += [share for share, _ in best.values()]
                        latent += [by for _, by in best.values()]
                yield pa.RecordBatch.from_arrays([names.take(pa.array(ids, pa.int64())), pa.array(items, pa.int64()), pa.array(shares, pa.float64()), pa.array(latent, pa.bool_())], names=["id", "item", "share", "latent"])

        return run

    parts = benchmark.select(F.col(item_col).cast("long").alias("item"), F.lower("text").alias("text")).filter("item is not null and text is not null")
    count = parts.count()
    found = spark.createDataFrame([], f"id {kind}, item long, share double, latent boolean")
    for k in range(-(-count // items_a_pass)):
        passes = -(-count // items_a_pass)
        block = parts.filter(F.pmod(F.xxhash64("item", "text"), F.lit(passes)) == k).collect()
        known = []
        for r in sorted(block, key=lambda r: (r.item, r.text)):
            data = np.frombuffer(r.text.encode(), np.uint8)
            words = word_hashes(data, np.array([0, len(data)]), BREAKS)[0].tolist()
            if words:
                known.append((r.item, words))
        if known:
            found = found.unionByName(rows.mapInArrow(search(known), f"id {kind}, item long, share double, latent boolean"))
    hits = written(found, "leaks").groupBy("id").agg(F.sort_array(F.collect_set("item")).alias("items"), F.max("share").alias("overlap"), F.sort_array(F.collect_set(F.when(F.col("latent"), F.col("item")))).alias("latent_items"))
    out = docs.select(F.col(id_col).alias("id")).join(hits, "id", "left")
    return out.select(F.col("id").alias(id_col), F.col("items").isNotNull().alias("contaminated"), F.coalesce("items", F.array().cast("array<long>")).alias("items"), F.coalesce("overlap", F.lit(0.0)).alias("overlap"),
                      F.coalesce("latent_items", F.array().cast("array<long>")).alias("latent_items"))
