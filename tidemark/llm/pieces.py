"""SentencePiece BPE in vectorised merge rounds, and its decoding."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches_of, prepare

SPACE = "▁"
NEVER = np.iinfo(np.int32).max
LONG = 400  # characters


class PieceModel:
    """Pieces of a BPE model file with byte fallback and identity normalisation.

    ``merged`` maps a pair of neighbouring pieces to the piece they join to; its
    rank is the place of that piece's score. Characters without a piece of their
    own are carried as negative numbers and never join.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        ids = {pieces[i]: i for i in plain}
        scores = np.array([sp.get_score(i) for i in range(n)])
        order = np.unique(-scores)
        self.rank = np.searchsorted(order, -scores).astype(np.int32)
        self.bytes = np.zeros(256, np.int32)
        surface = []
        for i in range(n):
            if sp.is_byte(i):
                self.bytes[int(pieces[i][3:5], 16)] = i
                surface.append(bytes([int(pieces[i][3:5], 16)]))
            else:
                surface.append(b"" if sp.is_control(i) else b" \xe2\x81\x87 " if sp.is_unknown(i) else pieces[i].replace(SPACE, " ").encode())
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.width = np.array([len(s) for s in surface], np.int64)
        self.place = np.concatenate(([0], np.cumsum(self.width)))[:-1]
        single = sorted((ord(p), i) for p, i in ids.items() if len(p) == 1)
        self.points = np.array([c for c, _ in single], np.int64)
        self.point_ids = np.array([i for _, i in single], np.int64)
        pairs = {(ids[p[:k]] << 32 | ids[p[k:]]): i for p, i in ids.items() for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids}
        self.pairs = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in self.pairs.tolist()], np.int64)
        self.table = {k: (int(self.rank[i]), i) for k, i in pairs.items()}
        self.feed = self._spelled(np.array([-1 - ord("\n")]))[0] if "\n" not in ids else np.array([ids["\n"]], np.int32)

    def _joined(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For neighbours: the piece they join to and its rank, ``NEVER`` if none."""
        key = np.where((left >= 0) & (right >= 0), left << 32 | right, -1)
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        found = self.pairs[at] == key
        piece = self.merged[at]
        return piece, np.where(found, self.rank[piece], NEVER)

    def _symbols(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        at = np.minimum(np.searchsorted(self.points, points), len(self.points) - 1)
        return np.where(self.points[at] == points, self.point_ids[at], -1 - points)

    def _spelled(self, symbols: np.ndarray) -> list[np.ndarray]:
        """Final ids of one word; characters without a piece become their bytes."""
        if len(symbols) and symbols.min() < 0:
            symbols = np.array([i for s in symbols.tolist() for i in ([s] if s >= 0 else self.bytes[list(chr(-1 - s).encode())].tolist())])
        return [symbols.astype(np.int32)]

    def one_by_one(self, symbols: np.ndarray) -> np.ndarray:
        """The same merges in the library's order, one at a time, from a heap."""
        sym = symbols.tolist()
        after, before = list(range(1, len(sym) + 1)), list(range(-1, len(sym) - 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def push(i: int) -> None:
            j = after[i] if 0 <= i else len(sym)
            if i >= 0 and j < len(sym) and sym[i] >= 0 and sym[j] >= 0:
                found = self.table.get(sym[i] << 32 | sym[j])
                if found:
                    heapq.heappush(heap, (found[0], i, sym[i], sym[j], found[1]))

        for i in range(len(sym) - 1):
            push(i)
        while heap:
            _, i, left, right, piece = heapq.heappop(heap)
            j = after[i]
            if sym[i] != left or j >= len(sym) or sym[j] != right:
                continue
            sym[i], sym[j], after[i] = piece, None, after[j]
            if after[i] < len(sym):
                before[after[i]] = i
            push(before[i])
            push(i)
        return np.array([s for s in sym if s is not None], np.int64)

    def by_ranks(self, symbols: np.ndarray) -> np.ndarray:
        """The same rounds for one long word, each at the cost of its merges.

        Places of pairs wait under their rank. A round takes the least rank, joins
        its pairs from the left, and looks up anew only the pairs beside a merge.
        The array is not compacted but linked. A word in which joining several
        pairs makes one of no higher rank is done again one merge at a time.
        """
        n = len(symbols)
        sym, alive = symbols.copy(), np.ones(n, bool)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        into, rank = np.zeros(n, np.int64), np.full(n, NEVER, np.int32)
        waiting: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []

        def wait(places: np.ndarray) -> None:
            places = places[rank[places] < NEVER]
            if not len(places):
                return
            places = places[np.argsort(rank[places], kind="stable")]
            kinds = rank[places]
            cuts = np.flatnonzero(kinds[1:] != kinds[:-1]) + 1
            for r, part in zip(kinds[np.append(0, cuts)].tolist(), np.split(places, cuts) if len(cuts) else [places]):
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(ranks, r)
                waiting[r].append(part)

        into[:-1], rank[:-1] = self._joined(sym[:-1], sym[1:])
        wait(np.arange(n - 1))
        while ranks:
            r = heapq.heappop(ranks)
            parts = waiting.pop(r)
            at = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
            at = at[alive[at] & (rank[at] == r)]
            if not len(at):
                continue
            touch = after[at[:-1]] == at[1:]
            if touch.any():  # of overlapping pairs every other one
                each = np.arange(len(at))
                at = at[(each - np.maximum.accumulate(np.where(np.append(True, ~touch), each, 0))) % 2 == 0]
            gone = after[at]
            sym[at], alive[gone], rank[gone] = into[at], False, NEVER
            beyond = after[gone]
            after[at] = beyond
            inside = beyond < n
            before[beyond[inside]] = at[inside]
            left = before[at]
            changed = np.unique(np.concatenate((at, left[left >= 0])))
            rank[changed] = NEVER
            changed = changed[after[changed] < n]
            into[changed], rank[changed] = self._joined(sym[changed], sym[after[changed]])
            if len(at) > 1 and len(changed) and rank[changed].min() <= r:
                return self.one_by_one(symbols)
            wait(changed)
        return sym[alive]

    def merge(self, words: list[str]) -> list[np.ndarray]:
        """Ids of every word, by rounds over one flat array of all words' symbols.

        In a round each word's least pair rank is found, all its pairs of that
        rank are joined from the left (of overlapping pairs every other one), and
        the array is compacted; words without a pair leave it. If joining several
        pairs at once makes a pair of no higher rank, the library might have taken
        that one first: such a word is done again one merge at a time. Long words
        have their rounds by themselves (``by_ranks``), as a round over all would
        cost their whole length.
        """
        out: list[np.ndarray | None] = [None] * len(words)
        lengths = np.array([len(w) for w in words], np.int64)
        for i in np.flatnonzero(lengths > LONG).tolist():
            out[i] = self._spelled(self.by_ranks(self._symbols(words[i])))[0]
        if (lengths > LONG).any():
            words = ["" if n > LONG else w for w, n in zip(words, lengths.tolist())]
            lengths = np.where(lengths > LONG, 0, lengths)
        for i in np.flatnonzero(lengths == 0).tolist():
            out[i] = np.zeros(0, np.int32) if out[i] is None else out[i]
        sym, word = self._symbols("".join(words)), np.repeat(np.arange(len(words)), lengths)
        whole, whole_at = sym, np.concatenate(([0], np.cumsum(lengths)))
        last = np.full(len(words), -1, np.int64)  # rank of the round before, where it joined several pairs
        while len(sym):
            piece, rank = self._joined(sym[:-1], sym[1:])
            rank = np.append(np.where(word[:-1] == word[1:], rank, NEVER), NEVER)
            begins = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            least = np.minimum.reduceat(rank, begins)
            which = word[begins]
            odd = least <= last[which]
            done = (least == NEVER) | odd
            ends = np.append(begins[1:], len(sym))
            for k in np.flatnonzero(done).tolist():
                w = int(which[k])
                symbols = self.one_by_one(whole[whole_at[w]: whole_at[w + 1]]) if odd[k] else sym[begins[k]: ends[k]]
                out[w] = self._spelled(symbols)[0]
            sizes = ends - begins
            going = np.repeat(~done, sizes)
            join = (rank == np.repeat(least, sizes)) & going
            first = join & ~np.append(False, join[:-1])
            places = np.arange(len(sym))
            run = np.maximum.accumulate(np.where(first, places, 0))
            join &= (places - run) % 2 == 0
            last[which] = np.where(np.add.reduceat(join, begins, dtype=np.int64) > 1, least, -1)
            sym = np.where(join, np.append(piece, 0), sym)
            keep = going & ~np.append(False, join[:-1])
            sym, word = sym[keep], word[keep]
        return out

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """Texts from flat ids; ``ends`` tells where each text's ids end.

        Pieces' bytes are laid out by one gather; the space that stands before a
        text is taken off; bytes that are no UTF-8 become replacement characters.
        """
        width = self.width[ids]
        after = np.concatenate(([0], np.cumsum(width)))
        data = self.surface[np.repeat(self.place[ids] - after[:-1], width) + np.arange(after[-1])].tobytes()
        cuts = after[np.concatenate(([0], ends)).astype(np.int64)].tolist()
        out = []
        for a, b in zip(cuts, cuts[1:]):
            out.append(data[a + (data[a:a + 1] == b" "): b].decode("utf-8", "replace"))
        return out


class PieceEncoder:
    """Encodes texts by words; each new word goes through the merge rounds once.

    No piece has a space mark after another character, nor a line feed, so a text
    falls into words at line feeds and before each run of spaces, and words are
    encoded alike everywhere. The cache is emptied when it holds ``most`` words.
    """

    def __init__(self, path: str, most: int = 400_000):
        self.model = PieceModel(path)
        self.most = most
        self.bare: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}
        self.feed = self.model.feed.astype("<i4").tobytes()

    def _learn(self, cache: dict[str, bytes], words: list[str], prefix: str) -> None:
        unique = set(words)
        new = [w for w in unique if w not in cache]
        if len(cache) + len(new) > self.most:
            cache.clear()
            new = list(unique)
        for i in range(0, len(new), 20_000):
            part = new[i: i + 20_000]
            for w, ids in zip(part, self.model.merge([prefix + w for w in part])):
                cache[w] = ids.astype("<i4").tobytes()

    def _by_runs(self, text: str) -> bytes:
        """A text with runs of spaces, which must stay whole."""
        words = re.findall(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n", SPACE + text.replace(" ", SPACE))
        plain = [w for w in words if w != "\n"]
        ids = iter(self.model.merge(plain))
        return b"".join(self.feed if w == "\n" else next(ids).astype("<i4").tobytes() for w in words)

    def batch(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        whole = [t.replace(SPACE, " ") if t and SPACE in t else t or "" for t in texts]
        runs = ["  " in t or t.startswith(" ") for t in whole]
        split = [[line.split(" ") for line in t.split("\n")] if t and not r else [] for t, r in zip(whole, runs)]
        self._learn(self.bare, [line[0] for lines in split for line in lines[1:]], "")
        self._learn(self.spaced, [lines[0][0] for lines in split if lines] + [w for lines in split for line in lines for w in line[1:]], SPACE)
        bare, spaced, out = self.bare.__getitem__, self.spaced.__getitem__, []
        for t, r, lines in zip(whole, runs, split):
            if r:
                out.append(self._by_runs(t))
            else:
                out.append(self.feed.join([b"".join([(bare if k else spaced)(line[0]), *map(spaced, line[1:])]) for k, line in enumerate(lines)]))
        return out


def encode_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, its ids (no begin or end ids) and the text decoded from them.

    Null and empty texts have no ids and decode to the empty text; the space mark
    in a text counts as a space, as in the library. Each text is encoded whole, by
    itself: no shuffle, no state beyond a bounded cache of words, so equal rows
    and hot sources cost nothing extra. Other columns are ignored; an empty
    table gives no rows.
    """
    prepare(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(model_path)
        for b in batches:
            names = b.column("id")
            schema = pa.schema([(id_col, names.type), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

            def rows(names=names.to_pylist(), texts=b.column("text").to_pylist()):
                for i in range(0, len(texts), 200):
                    held = [np.frombuffer(x, "<i4") for x in encoder.batch(texts[i: i + 200])]
                    flat = np.concatenate(held) if held else np.zeros(0, np.int32)
                    yield from zip(names[i: i + 200], held, encoder.model.decode(flat, np.cumsum([len(x) for x in held])))

            yield from batches_of(rows(), schema)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"{id_col} {kind}, ids array<int>, decoded string")
