"""Bytes that repeat across documents, by induced suffix sorting of shards of repeated text."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches_of, mix, prepare, strings, written

GRAM = 40  # bytes of an anchor
SLICE = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
BYTE = mix(np.arange(7, 263, dtype=np.uint64))
SECOND = mix(np.arange(7007, 7263, dtype=np.uint64))


# ---------------------------------------------------------------- suffix sorting


class Buckets:
    """A priority queue of (suffix, common prefix) tuples, keyed by a suffix's first symbol.

    Tuples of one symbol leave in the order in which they came, which induced
    sorting makes their order as suffixes. When over ``most`` bytes are held, all
    go to an unnamed scratch file of the task, which vanishes with the task.
    """

    def __init__(self, symbols: int, most: int = 64 << 20):
        self.parts: list[list] = [[] for _ in range(symbols)]
        self.held, self.most, self.file = 0, most, None

    def push(self, symbol: int, suffix: np.ndarray, common: np.ndarray) -> None:
        self.parts[symbol].append((suffix, common))
        self.held += suffix.nbytes + common.nbytes
        if self.held > self.most:
            self.spill()

    def spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for parts in self.parts:
            for k, (suffix, common) in enumerate(parts):
                if not isinstance(suffix, int):
                    parts[k] = (self.file.tell(), len(suffix))
                    self.file.write(suffix.astype(np.int32).tobytes() + common.tobytes())
        self.held = 0

    def take(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        parts, self.parts[symbol] = self.parts[symbol], []
        suffixes, commons = [np.zeros(0, np.int32)], [np.zeros(0, np.uint8)]
        for a, b in parts:
            if isinstance(a, int):
                self.file.seek(a)
                a, b = np.frombuffer(self.file.read(4 * b), np.int32), np.frombuffer(self.file.read(b), np.uint8)
            else:
                self.held -= a.nbytes + b.nbytes
            suffixes.append(a), commons.append(b)
        return np.concatenate(suffixes), np.concatenate(commons)


class Inducer:
    """Induces the order of suffixes from their successors, with common prefixes up to ``cap``.

    ``down`` False: larger-type suffixes, symbols ascending; True: smaller-type
    suffixes, symbols descending. ``since`` holds, for each symbol, the least
    common prefix among the suffixes taken since the last push to that symbol.
    """

    def __init__(self, text: np.ndarray, wanted: np.ndarray, symbols: int, cap: int):
        self.text, self.wanted, self.cap = text, wanted, cap
        self.queue = Buckets(symbols)
        self.since = np.full(symbols, cap, np.uint8)
        self.fresh = np.ones(symbols, bool)

    def feed(self, suffix: np.ndarray, common: np.ndarray) -> None:
        """Takes sorted suffixes, and pushes those before them in the text that are wanted."""
        for i in range(0, len(suffix), 1 << 18):
            self._block(suffix[i: i + (1 << 18)], common[i: i + (1 << 18)])

    def _block(self, suffix: np.ndarray, common: np.ndarray) -> None:
        n = len(suffix)
        at = np.flatnonzero((suffix > 0) & self.wanted[suffix - 1])
        after = np.append(np.minimum.accumulate(common[::-1])[::-1], np.uint8(self.cap))
        if not len(at):
            np.minimum(self.since, after[0], out=self.since)
            return
        before = suffix[at] - 1
        symbol = self.text[before]
        order = np.argsort(symbol, kind="stable")
        at, before, symbol = at[order], before[order], symbol[order]
        first = np.append(True, symbol[1:] != symbol[:-1])
        # least common prefix between one source of a symbol and the next: a table of minima of spans of 2^k
        table = [common]
        while 2 << len(table) - 1 <= n:
            half = 1 << len(table) - 1
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        low = np.append(0, at[:-1] + 1)
        low[first] = 0
        level = np.frexp(at - low + 1)[1] - 1
        least = np.empty(len(at), np.uint8)
        for k in np.unique(level).tolist():
            rows = np.flatnonzero(level == k)
            least[rows] = np.minimum(table[k][low[rows]], table[k][at[rows] - (1 << k) + 1])
        least[first] = np.minimum(least[first], self.since[symbol[first]])
        new = np.minimum(least, self.cap - 1) + 1
        heads = np.flatnonzero(first)
        mine = symbol[heads]
        new[heads[self.fresh[mine]]] = 0
        ends = np.append(heads[1:], len(at))
        np.minimum(self.since, after[0], out=self.since)
        self.since[mine] = after[at[ends - 1] + 1]
        self.fresh[mine] = False
        for s, a, b in zip(mine.tolist(), heads.tolist(), ends.tolist()):
            self.queue.push(s, before[a:b], new[a:b])

    def rounds(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        """Takes all of a symbol, and what taking them adds to the same symbol."""
        suffixes, commons = [], []
        while True:
            suffix, common = self.queue.take(symbol)
            if not len(suffix):
                break
            suffixes.append(suffix), commons.append(common)
            self.feed(suffix, common)
        if not suffixes:
            return np.zeros(0, np.int32), np.zeros(0, np.uint8)
        return np.concatenate(suffixes), np.concatenate(commons)


def _types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one after it; the last one, alone with symbol 0, is."""
    n = len(text)
    change = np.append(text[:-1] != text[1:], True)
    nearest = np.minimum.accumulate(np.where(change, np.arange(n), n)[::-1])[::-1]
    less = np.append(text[:-1] < text[1:], True)
    return less[nearest]


def _runs(text: np.ndarray, cap: int) -> np.ndarray:
    """How often the symbol at each place repeats from there on, up to ``cap``."""
    n = len(text)
    change = np.append(text[:-1] != text[1:], True)
    nearest = np.minimum.accumulate(np.where(change, np.arange(n), n)[::-1])[::-1]
    return np.minimum(nearest - np.arange(n) + 1, cap).astype(np.uint8)


def _induce(text: np.ndarray, small: np.ndarray, seeds: np.ndarray, seed_common: np.ndarray, symbols: int, cap: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes, by symbol descending, each symbol's in ascending order with the common prefix with the one before.

    ``seeds`` are the leftmost smaller-type suffixes in order. The first pass
    induces the larger-type suffixes from them, the second the smaller-type ones
    from those.
    """
    runs = _runs(text, cap)
    up = Inducer(text, ~small, symbols, cap)
    larger = Buckets(symbols)
    cuts = np.searchsorted(text[seeds], np.arange(symbols + 1))
    for s in range(symbols):
        suffix, common = up.rounds(s)
        seed, shared = seeds[cuts[s]: cuts[s + 1]], seed_common[cuts[s]: cuts[s + 1]].copy()
        if len(seed):
            shared[0] = min(runs[suffix[-1]], runs[seed[0]]) if len(suffix) else 0
            up.feed(seed, shared)
        if len(suffix):
            larger.push(s, suffix, common)
    down = Inducer(text, small, symbols, cap)
    for s in reversed(range(symbols)):
        smaller, shared = down.rounds(s)  # descending
        suffix, common = larger.take(s)
        seam = min(runs[suffix[-1]], runs[smaller[-1]]) if len(suffix) and len(smaller) else 0
        if len(suffix):
            # taken from the largest down: each shares with the one taken before it what the order above it says
            down.feed(suffix[::-1], np.append(np.uint8(seam), common[:0:-1]))
        if len(smaller):
            common = np.concatenate((common, [np.uint8(seam)], shared[:0:-1])) if len(suffix) else np.append(np.uint8(0), shared[:0:-1])
            suffix = np.concatenate((suffix, smaller[::-1]))
        if len(suffix):
            yield suffix, common


def _shared(text: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Common prefixes of suffix pairs, four symbols at a time."""
    padded = np.concatenate((text, np.zeros(cap + 8, text.dtype)))
    words = np.ndarray(len(padded) - 4, "<u8", padded, 0, (2,))
    out = np.full(len(a), cap, np.int64)
    going = np.arange(len(a))
    for k in range(0, cap, 4):
        differ = words[a[going] + k] ^ words[b[going] + k]
        stop = differ != 0
        if stop.any():
            x = differ[stop]
            out[going[stop]] = k + (np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)) >> 4)
            going = going[~stop]
        if not len(going):
            break
    return np.minimum(out, cap).astype(np.uint8)


def sorted_suffixes(text: np.ndarray, symbols: int, cap: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Suffixes in the order of their first ``cap`` (under 255) symbols, with common prefixes, by symbol descending.

    ``text`` (16-bit) ends with its only 0. The leftmost smaller-type suffixes
    are first put in order by their first symbol alone, and induction sorts the
    stretches from each to the next. These get names; the names' own suffixes are
    sorted, which orders the seeds, and induction is run once more, with common
    prefixes. The string of names has an alphabet as large as itself, so it is
    sorted by doubling rather than by a queue per name, up to ``cap`` symbols.
    """
    if len(text) < 2:
        return
    small = _types(text)
    seeds = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    rough = seeds[np.argsort(text[seeds], kind="stable")].astype(np.int32)
    is_seed = np.zeros(len(text), bool)
    is_seed[seeds] = True
    blocks = [s[is_seed[s]] for s, _ in _induce(text, small, rough, np.zeros(len(rough), np.uint8), symbols, cap)]
    order = np.concatenate([np.array([len(text) - 1]), *blocks[::-1]])
    # names: stretches are equal if their lengths and hashes are
    following = np.append(seeds[1:], len(text) - 1)
    with np.errstate(over="ignore"):
        powers = np.multiply.accumulate(np.full(len(text), BASE, np.uint64))
        inverse = np.multiply.accumulate(np.full(len(text), INVERSE, np.uint64))
        sums = np.append(np.uint64(0), np.cumsum(mix(text + np.uint64(1)) * powers, dtype=np.uint64))
        stretch = (sums[following + 1] - sums[seeds]) * inverse[seeds]
    place = np.empty(len(text), np.int64)
    place[seeds] = np.arange(len(seeds))
    ranked = place[order]
    size = following - seeds
    new = np.append(True, (stretch[ranked[1:]] != stretch[ranked[:-1]]) | (size[ranked[1:]] != size[ranked[:-1]]))
    names = np.empty(len(seeds), np.int64)
    names[ranked] = np.cumsum(new)
    step = 1
    while step * 2 <= cap and names.max() < len(names):
        key = names * (len(names) + 1) + np.concatenate((names[step:], np.zeros(min(step, len(names)), np.int64)))[: len(names)]
        ranked = np.argsort(key, kind="stable")
        names = np.empty(len(seeds), np.int64)
        names[ranked] = np.cumsum(np.append(True, key[ranked[1:]] != key[ranked[:-1]]))
        step *= 2
    sorted_seeds = seeds[np.argsort(names, kind="stable")].astype(np.int32)
    common = np.append(np.uint8(0), _shared(text, sorted_seeds[:-1], sorted_seeds[1:], cap))
    yield from _induce(text, small, sorted_seeds, common, symbols, cap)


def repeated_starts(texts: list[bytes], length: int) -> list[np.ndarray]:
    """For each text, which places begin a stretch of ``length`` bytes that also begins elsewhere."""
    size = np.array([len(t) + 1 for t in texts])
    text = np.ones(int(size.sum()) + 1, np.uint16)  # 1 parts the texts
    begins = np.cumsum(size) - size
    for t, b in zip(texts, begins.tolist()):
        text[b: b + len(t)] = np.frombuffer(t, np.uint8)
        text[b: b + len(t)] += 2
    text[-1] = 0
    again = np.zeros(len(text), bool)
    for suffix, common in sorted_suffixes(text, 258, length):
        full = common >= length
        again[suffix[full]] = True
        again[suffix[:-1][full[1:]]] = True
    return [again[b: b + max(0, len(t) - length + 1)] for t, b in zip(texts, begins.tolist())]


# ---------------------------------------------------------------- anchors


def _grams(data: np.ndarray, width: int, table: np.ndarray = BYTE) -> np.ndarray:
    """A hash of the ``width`` bytes from each place on."""
    n = len(data)
    if n < width:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        powers = np.multiply.accumulate(np.full(n, BASE, np.uint64))
        inverse = np.multiply.accumulate(np.full(n - width + 1, INVERSE, np.uint64))
        sums = np.append(np.uint64(0), np.cumsum(table[data] * powers, dtype=np.uint64))
        return mix((sums[width:] - sums[:-width]) * inverse)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbouring values, by running minima of blocks from both ends."""
    n = len(values)
    whole = -(-n // width) * width
    padded = np.concatenate((values, np.full(whole - n, np.iinfo(np.uint64).max, np.uint64))).reshape(-1, width)
    left = np.minimum.accumulate(padded, axis=1).reshape(-1)
    right = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(right[: n - width + 1], left[width - 1: n])


def anchored_runs(data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of starts whose ``length`` bytes have the same least gram, their anchor.

    Per run: the text, first and last start, the anchor's hash, and a hash of the
    bytes that the run covers. Which gram is least depends on the bytes alone, so
    equal stretches have equal anchors at equal places, and every start is in one
    run.
    """
    grams = _grams(data, GRAM)
    span = length - GRAM + 1
    if len(grams) < span:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    low = np.uint64((1 << 24) - 1)
    least = _least((grams & ~low) | np.arange(len(grams), dtype=np.uint64), span)
    anchor = (least & low).astype(np.int64)
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))[: len(anchor)]
    inside = np.arange(len(anchor)) + length <= at[1:][text]
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])) | np.append(True, ~inside[:-1])
    first = np.flatnonzero(new & inside)
    breaks = np.flatnonzero(new | ~inside)
    last = np.append(breaks, len(anchor))[np.searchsorted(breaks, first, "right")] - 1
    with np.errstate(over="ignore"):
        powers = np.multiply.accumulate(np.full(len(data) + 1, BASE, np.uint64))
        inverse = np.multiply.accumulate(np.full(len(data) + 1, INVERSE, np.uint64))
        sums = np.append(np.uint64(0), np.cumsum(SECOND[data] * powers[:-1], dtype=np.uint64))
        body = mix(mix((sums[last + length] - sums[first]) * inverse[first]) + (last - first).astype(np.uint64) * BASE + (anchor[first] - first).astype(np.uint64))
    return text[first], first, last, grams[anchor[first]], body


def _runs_of(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [c for c in b.schema.names if c != "text"]
            rows = [b.column(c).to_numpy() for c in ids]
            data, at = strings(b.column("text"))
            i, n = 0, len(at) - 1
            while i < n:
                j = max(i + 1, int(np.searchsorted(at, at[i] + SLICE, "right")) - 1)
                base, end = int(at[i]), int(at[j])
                for begin in range(base, max(end - length + 1, base + 1), 8 << 20):  # a very long text in pieces that share length - 1 starts' bytes
                    stop = min(end, begin + (8 << 20) + length - 1) if j == i + 1 else end
                    local = np.clip(at[i: j + 1], begin, stop) - begin
                    text, first, last, key, body = anchored_runs(data[begin:stop], local, length)
                    shift = (begin - at[i:j])[text]
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(r[i:j][text]) for r in rows), pa.array((first + shift).astype(np.int32)), pa.array((last + shift).astype(np.int32)), pa.array(key.view(np.int64)), pa.array(body.view(np.int64))],
                        names=[*ids, "lo", "hi", "key", "body"])
                    if j > i + 1:
                        break
                i = j

    return run


def _payloads(length: int):
    """The bytes of each wanted run of a text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.int64()), ("body", pa.int64()), ("n", pa.int64()), ("crowd", pa.int64()), ("bytes", pa.binary())])
        for b in batches:
            data, at = strings(b.column("text"))

            def rows(b=b, data=data, at=at):
                for k, runs in enumerate(b.column("runs").to_pylist()):
                    for r in runs:
                        yield r["key"], r["body"], r["n"], r["crowd"], data[at[k] + r["lo"]: at[k] + r["hi"] + length].tobytes()

            yield from batches_of(rows(), schema, most=20_000)

    return run


RANGES = "key long, body long, a int, b int"


def _ranges(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and last of every run of set flags."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist()))


def _sort_shard(length: int):
    def run(shard: pa.Table) -> pa.Table:
        texts = shard.column("bytes").to_pylist()
        flags = repeated_starts(texts, length)
        rows = [(k, b, x, y) for k, b, f in zip(shard.column("key").to_pylist(), shard.column("body").to_pylist(), flags) for x, y in _ranges(f)]
        columns = list(zip(*rows)) or [[], [], [], []]
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=["key", "body", "a", "b"])

    return run


def _anchor_in(data: np.ndarray, key: int) -> int:
    """Where the anchor begins in a run's bytes: the first gram with its hash."""
    return int(np.flatnonzero(_grams(data, GRAM).view(np.int64) == key)[0])


def _block_hashes(length: int, width: int):
    """Per run and block of ``width`` neighbouring starts, counted from the anchor: two 128-bit hashes.

    One of the bytes that all stretches of the block share, one of all bytes that
    they cover; the second is null where the run does not hold the whole block.
    """
    def rows(b: pa.RecordBatch) -> Iterator[tuple]:
        for key, body, raw in zip(b.column("key").to_pylist(), b.column("body").to_pylist(), b.column("bytes").to_pylist()):
            data, last = np.frombuffer(raw, np.uint8), len(raw) - length
            at = _anchor_in(data, key)
            sums = []
            with np.errstate(over="ignore"):
                powers = np.multiply.accumulate(np.full(len(data), BASE, np.uint64))
                inverse = np.multiply.accumulate(np.full(len(data), INVERSE, np.uint64))
                for table in (BYTE, SECOND):
                    sums.append(np.append(np.uint64(0), np.cumsum(table[data] * powers, dtype=np.uint64)))
                for block in range((at - last) // width, at // width + 1):
                    high, low = at - block * width, at - block * width - width + 1
                    common = [int(((x[low + length] - x[high]) * inverse[high]).view(np.int64)) for x in sums]
                    whole = [int(((x[high + length] - x[low]) * inverse[low]).view(np.int64)) for x in sums] if low >= 0 and high <= last else [None, None]
                    yield key, body, block, max(0, low), min(last, high), *common, *whole

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c, pa.int32() if c in ("block", "a", "b") else pa.int64()) for c in ("key", "body", "block", "a", "b", "c1", "c2", "w1", "w2")])
        for b in batches:
            yield from batches_of(rows(b), schema, most=20_000)

    return run


def _window_hashes(length: int):
    """128-bit hashes of the stretches at the wanted starts of each run."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, bodies, starts, hashes = [], [], [], ([], [])
            for key, body, raw, ranges in zip(b.column("key").to_pylist(), b.column("body").to_pylist(), b.column("bytes").to_pylist(), b.column("ranges").to_pylist()):
                at = np.concatenate([np.arange(r["a"], r["b"] + 1) for r in ranges])
                keys += [key] * len(at)
                bodies += [body] * len(at)
                starts.append(at.astype(np.int32))
                for out, table in zip(hashes, (BYTE, SECOND)):
                    out.append(_grams(np.frombuffer(raw, np.uint8), length, table).view(np.int64)[at])
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(bodies, pa.int64()), pa.array(np.concatenate(starts)), *(pa.array(np.concatenate(h)) for h in hashes)], names=["key", "body", "w", "h1", "h2"])

    return run


def _crowded_ranges(crowded: DataFrame, length: int, width: int = 8) -> DataFrame:
    """Repeated ranges of runs whose anchor has very many different runs, by hashes that Spark counts.

    Starts are judged in blocks first. A block whose shared bytes no other run has
    holds no repeat; one whose bytes another run has altogether repeats altogether.
    Only of the rest, and of one block of each such kind to compare with, single
    starts are hashed: few, as runs differ from one place on to each side.
    """
    blocks = written(crowded.mapInArrow(_block_hashes(length, width), "key long, body long, block int, a int, b int, c1 long, c2 long, w1 long, w2 long"), "crowd-blocks")
    alive = blocks.groupBy("key", "block", "c1", "c2").agg(F.count("*").alias("m")).filter("m > 1").select("key", "block", "c1", "c2")
    live = written(blocks.join(alive, ["key", "block", "c1", "c2"], "left_semi"), "crowd-live")
    kinds = ["key", "block", "w1", "w2"]
    alike = live.filter("w1 is not null").groupBy(*kinds).agg(F.count("*").alias("m"), F.min(F.struct("body", "a", "b")).alias("one")).filter("m > 1")
    settled = live.join(alike.select(*kinds), kinds, "left_semi")
    open_ = live.join(alike.select(*kinds), kinds, "left_anti").select("key", "body", "a", "b")
    asked = open_.unionByName(alike.select("key", "one.body", "one.a", "one.b"))
    lists = asked.groupBy("key", "body").agg(F.collect_list(F.struct("a", "b")).alias("ranges"))
    starts = written(crowded.join(lists, ["key", "body"]).select("key", "body", "bytes", "ranges").mapInArrow(_window_hashes(length), "key long, body long, w int, h1 long, h2 long"), "crowd-starts")
    often = starts.groupBy("h1", "h2").agg(F.count("*").alias("m")).filter("m > 1").select("h1", "h2")
    single = starts.join(often, ["h1", "h2"], "left_semi").select("key", "body", F.col("w").alias("a"), F.col("w").alias("b"))
    return settled.select("key", "body", "a", "b").unionByName(single)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merges a text's spans and leaves them out."""
    for b in batches:
        data, at = strings(b.column("text"))
        schema = pa.schema([b.schema.field("id"), ("n_bytes", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("kept", pa.binary())])

        def rows(b=b, data=data, at=at):
            for k, (name, spans) in enumerate(zip(b.column("id").to_pylist(), b.column("spans").to_pylist())):
                text, merged = data[at[k]: at[k + 1]], []
                if spans:
                    flag = np.zeros(len(text) + 1, np.int32)
                    np.add.at(flag, [s["start"] for s in spans], 1)
                    np.add.at(flag, [s["end"] for s in spans], -1)
                    gone = np.cumsum(flag[:-1]) > 0
                    merged = [{"start": x, "end": y + 1} for x, y in _ranges(gone)]
                    text = text[~gone]
                yield name, int(at[k + 1] - at[k]), merged, text.tobytes()

        yield from batches_of(rows(), schema)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, shard_bytes: int = 4 << 20, crowd: int = 200) -> DataFrame:
    """One row per document: ``id_col``, n_bytes, spans (start, end; what repeats) and kept (the other bytes).

    A byte repeats if a stretch of ``length`` bytes covers it that begins at
    another place too, in the same text or another, none crossing texts.

    1. Each start is in one run of neighbouring starts with the same anchor, the
       least 40-byte gram of its stretch; equal stretches have equal anchors, so
       runs whose anchor is found once hold no repeat and go no further.
    2. Runs with equal bytes (by 128 bits of hash) are one class. A class of
       several runs repeats as a whole; it stays in the sort as one text, so
       copies are sorted once, however many they are.
    3. Classes that share their anchor with another class go to shards of
       ``shard_bytes`` at most on average, two a task at least, by anchor, and each shard is suffix-sorted by induction with
       common prefixes; a start repeats if it shares ``length`` bytes with a
       neighbour in that order. An anchor with over ``crowd`` classes, as a line
       has that stands in very many texts, would fill a shard by itself: its
       starts are compared by 128-bit hashes instead, of blocks of starts and
       then of single ones where blocks do not decide, which Spark counts in any
       number of tasks.
    4. Ranges go back to the runs and are merged in each text.

    Null texts are empty; texts under ``length`` bytes have no repeats; equal
    rows repeat each other; null ids stay. Bytes, not characters, are removed, so
    ``kept`` is binary.
    """
    spark = prepare(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    kind = dict(docs.dtypes)[id_col]
    named = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(F.col(id_col), text).alias("row"), F.xxhash64(text, F.lit(1), F.col(id_col)).alias("row2"))
    runs = written(named.filter(F.octet_length("text") >= length).select("row", "row2", "text").mapInArrow(_runs_of(length), "row long, row2 long, lo int, hi int, key long, body long"), "runs")
    # written first, so that the runs of a frequent key can be split where they meet it
    shared = written(runs.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1").select("key"), "shared-keys")
    some = written(runs.join(shared, "key", "left_semi"), "shared-runs")
    classes = written(some.groupBy("key", "body").agg(F.count("*").alias("n"), F.min(F.struct("row", "row2", "lo", "hi")).alias("one")), "run-classes")
    crowds = classes.groupBy("key").agg(F.count("*").alias("crowd")).filter("crowd > 1")
    wanted = classes.join(crowds, "key").select("one.row", "one.row2", F.struct("key", "body", "n", "crowd", "one.lo", "one.hi").alias("r")) \
        .groupBy("row", "row2").agg(F.collect_list("r").alias("runs"))
    payloads = written(named.select("row", "row2", "text").join(wanted, ["row", "row2"]).select("text", "runs").mapInArrow(_payloads(length), "key long, body long, n long, crowd long, bytes binary"), "run-bytes")
    total = payloads.agg(F.coalesce(F.sum(F.octet_length("bytes")), F.lit(0))).first()[0]
    shards = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // shard_bytes))
    by_sort = payloads.filter(F.col("crowd") <= crowd).withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards))) \
        .groupBy("shard").applyInArrow(_sort_shard(length), RANGES)
    by_hash = _crowded_ranges(payloads.filter(F.col("crowd") > crowd).select("key", "body", "bytes"), length)
    copies = classes.filter("n > 1").select("key", "body", F.lit(0).alias("a"), (F.col("one.hi") - F.col("one.lo")).cast("int").alias("b"))
    ranges = written(by_sort.unionByName(by_hash).unionByName(copies), "repeat-ranges")
    spans = some.join(ranges, ["key", "body"]).select("row", "row2", F.struct((F.col("lo") + F.col("a")).alias("start"), (F.col("lo") + F.col("b") + length).alias("end")).alias("s")) \
        .groupBy("row", "row2").agg(F.collect_set("s").alias("spans"))
    out = named.join(spans, ["row", "row2"], "left").select("id", "text", "spans")
    return out.mapInArrow(_cut, f"id {kind}, n_bytes long, spans array<struct<start:int,end:int>>, kept binary").withColumnRenamed("id", id_col)
