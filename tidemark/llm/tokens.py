"""Token ids in wavelet-matrix files: encode, write, look up, read back."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import offsets, prepare

MAGIC = b"TWM1"
BLOCK = 512  # bits a rank sample covers


class WaveletMatrix:
    """A sequence of ids as bit planes, the highest bit first.

    Each plane holds one bit of every id, in the order that the planes before it
    leave: ids with a 0 there go to the front, ids with a 1 behind them, both in
    their order. Rank samples every ``BLOCK`` bits make a look-up a walk down the
    planes.
    """

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int]):
        self.n, self.planes, self.zeros = n, planes, zeros

    @cached_property
    def samples(self) -> list[np.ndarray]:
        return [np.concatenate(([0], np.cumsum(np.add.reduceat(np.bitwise_count(p), np.arange(0, len(p), BLOCK // 8), dtype=np.int64)))) if len(p) else np.zeros(1, np.int64) for p in self.planes]

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        planes, zeros = [], []
        for bit in reversed(range(int(ids.max()).bit_length() if len(ids) else 0)):
            ones = (ids & ids.dtype.type(1 << bit)) != 0
            planes.append(np.packbits(ones, bitorder="little"))
            low = np.compress(~ones, ids)  # by places, which is faster than by a mask
            zeros.append(len(low))
            ids = np.concatenate((low, np.compress(ones, ids)))
        return cls(len(ids), planes, zeros)

    def to_bytes(self) -> bytes:
        return struct.pack("<qi", self.n, len(self.planes)) + np.array(self.zeros, "<i8").tobytes() + b"".join(p.tobytes() for p in self.planes)

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        n, count = struct.unpack_from("<qi", data)
        zeros = np.frombuffer(data, "<i8", count, 12)
        width = -(-n // 8)
        begin = 12 + 8 * count
        return cls(n, [np.frombuffer(data, np.uint8, width, begin + width * k) for k in range(count)], [int(z) for z in zeros])

    def ids(self) -> np.ndarray:
        """All ids, by undoing the planes from the last to the first."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        out = np.zeros(self.n, kind)
        for bit, (plane, z) in enumerate(zip(reversed(self.planes), reversed(self.zeros))):
            ones = np.unpackbits(plane, count=self.n, bitorder="little").view(bool)
            before = np.empty(self.n, kind)
            before[np.flatnonzero(~ones)] = out[:z]
            before[np.flatnonzero(ones)] = out[z:] | kind(1 << bit)
            out = before
        return out

    def _rank(self, plane: int, at: int) -> int:
        """Ones before bit ``at`` of a plane."""
        block, rest = divmod(at, BLOCK)
        tail = self.planes[plane][block * BLOCK // 8: -(-at // 8)]
        bits = np.unpackbits(tail, bitorder="little")[:rest]
        return int(self.samples[plane][block]) + int(bits.sum())

    def access(self, at: int) -> int:
        """The id at a place."""
        out = 0
        for k in range(len(self.planes)):
            one = self.planes[k][at >> 3] >> (at & 7) & 1
            rank = self._rank(k, at)
            at = self.zeros[k] + rank if one else at - rank
            out = out << 1 | int(one)
        return out

    def _range(self, token: int, begin: int, end: int) -> tuple[int, int]:
        if token < 0 or token >> len(self.planes):
            return 0, 0
        for k in range(len(self.planes)):
            a, b = self._rank(k, begin), self._rank(k, end)
            one = token >> (len(self.planes) - 1 - k) & 1
            begin, end = (self.zeros[k] + a, self.zeros[k] + b) if one else (begin - a, end - b)
        return begin, end

    def count(self, token: int, begin: int = 0, end: int | None = None) -> int:
        """How often an id occurs in [begin, end)."""
        a, b = self._range(token, begin, self.n if end is None else end)
        return b - a

    def _select(self, plane: int, one: int, nth: int) -> int:
        """Place of the nth (from 0) bit ``one`` of a plane."""
        low, high = 0, self.n
        while low < high:
            half = (low + high) // 2
            ones = self._rank(plane, half + 1)
            if (ones if one else half + 1 - ones) > nth:
                high = half
            else:
                low = half + 1
        return low

    def occurrence(self, token: int, nth: int) -> int:
        """Place of the nth (from 0) occurrence of an id; -1 if there are fewer."""
        a, b = self._range(token, 0, self.n)
        if not 0 <= nth < b - a:
            return -1
        at = a + nth
        for k in reversed(range(len(self.planes))):
            one = token >> (len(self.planes) - 1 - k) & 1
            at = self._select(k, one, at - (self.zeros[k] if one else 0))
        return at


#: Letters in every version of Unicode, then signs: two words to the library wherever they stand.
WORD = re.compile(r"([\x01\x02]?)([A-Za-zÀ-ÖØ-öø-ɏΑ-ΡΣ-ώА-ҁҊ-ԧא-תؠ-يぁ-ゖ一-龥가-힣]+)([!-/:-@\[-`{-~]*)")
#: Characters that byte-level vocabularies hold instead of bytes, where they are not the byte's own.
SHOWN = dict(zip([*range(33), *range(127, 161), 173], map(chr, range(256, 324))))


class NotAlone(Exception):
    """A piece that may encode otherwise in its text."""


class Pieces(dict):
    """Ids by piece; a piece that is not there is encoded when it is asked for.

    The first ``most`` pieces stay, among which the frequent ones come early; the
    later ones are held until an eighth as many have come.
    """

    def __init__(self, encode: Callable[[str], bytes], most: int):
        super().__init__()
        self.encode, self.most, self.young = encode, most, {}

    def __missing__(self, piece: str) -> bytes:
        if len(self) < self.most:
            ids = self[piece] = self.encode(piece)
            return ids
        ids = self.young.get(piece)
        if ids is None:
            ids = self.encode(piece)
            if len(self.young) > self.most // 8:
                self.young.clear()
            self.young[piece] = ids
        return ids


class CachedEncoder:
    """Encodes texts by the tokenizers library, each new piece of text once.

    A piece goes from a single space (or line feed) to the next. As byte-level
    BPE never joins across the start of white space, pieces encode alike in and
    out of their text, if white space comes only one character at a time; other
    texts are encoded whole. So are texts that hold an added token, such as an
    end mark, if ``added`` says that these get their own ids, as the library
    gives by default; without it they are text like any other. A piece of letters
    and signs goes to the library's model without the steps before it, which only
    part the two. A worker process keeps its pieces from task to task (``of``).

    A piece is looked up with a mark for what stands before it: nothing for a
    space, ``FEED`` for a line feed, ``START`` for the start of the text. Texts
    that hold a mark themselves are encoded whole.
    """

    FEED, START = "\x01", "\x02"
    held: dict[tuple[str, bool], CachedEncoder] = {}

    @classmethod
    def of(cls, path: str, added: bool = False) -> CachedEncoder:
        if (path, added) not in cls.held:
            cls.held[path, added] = cls(path, added=added)
        return cls.held[path, added]

    def __init__(self, path: str, most: int = 1_500_000, added: bool = False):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        self.marks = [self.FEED, self.START, *(t.content for t in self.tokenizer.get_added_tokens_decoder().values() if added)]
        before = self.tokenizer.pre_tokenizer
        self.by_words = self.tokenizer.normalizer is None and isinstance(before, ByteLevel) and before.use_regex and not before.add_prefix_space
        self.model = self.tokenizer.model
        self.cache = Pieces(self._piece, most)
        self.feed = self._whole("\n")

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(word)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _piece(self, piece: str) -> bytes:
        found = WORD.fullmatch(piece) if self.by_words else None
        if found:
            mark, letters, signs = found.groups()
            ids = self.cache.get(mark + letters) if signs else None
            if ids is None:
                shown = letters if letters.isascii() else letters.encode().decode("latin-1").translate(SHOWN)
                ids = self._word(shown if mark else "Ġ" + shown)
                if mark == self.FEED:
                    ids = self.feed + ids
            return ids + self._word(signs) if signs else ids
        if piece == self.START:
            return b""
        mark = piece[:1] if piece[:1] in (self.FEED, self.START) else ""
        body = piece[len(mark):]
        if not body or body[0].isspace() or body[-1].isspace():
            raise NotAlone
        ids = self._whole(body if mark else " " + body)
        return self.feed + ids if mark == self.FEED else ids

    def batch(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        ids, out = self.cache.__getitem__, []
        for t in texts:
            if not t:
                out.append(b"")
            elif any(m in t for m in self.marks):
                out.append(self._whole(t))
            else:
                try:
                    out.append(b"".join(map(ids, (self.START + t.replace("\n", " " + self.FEED)).split(" "))))
                except NotAlone:
                    out.append(self._whole(t))
        return out


def _writer(path: str, end_id: int, shard_ids: int, added: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        encoder = CachedEncoder.of(path, added)
        end = np.array([end_id], "<u4").tobytes()
        held: list[bytes] = []
        names: list[int | None] = []
        size = 0

        def shard() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), "<u4")
            ids = ids.astype(np.uint16) if len(ids) and ids.max() < 1 << 16 else ids
            ends = np.cumsum([len(x) // 4 for x in held]).astype("<i8")
            known = np.array([x is not None for x in names], np.uint8)
            head = MAGIC + struct.pack("<q", len(names)) + np.array([x or 0 for x in names], "<i8").tobytes() + known.tobytes() + ends.tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([before], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([head + WaveletMatrix.build(ids).to_bytes()], pa.binary())],
                names=["part", "seq", "before", "n", "file"])

        for b in batches:
            texts = b.column("text").to_pylist()
            encoded = (ids for i in range(0, len(texts), 250) for ids in encoder.batch(texts[i: i + 250]))
            for name, ids in zip(b.column("id").to_pylist(), encoded):
                held.append(ids + end)
                names.append(name)
                size += len(ids) // 4 + 1
                if size >= shard_ids:
                    yield shard()
                    held, names, seq, before, size = [], [], seq + 1, before + size, 0
        if held:
            yield shard()

    return write


def write_token_shards(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", shard_ids: int = 1 << 20, added: bool = False) -> None:
    """Encodes every text and writes the ids, in ascending id order, as wavelet-matrix files.

    The folder holds one row per shard: partition, number in it, ids before it in
    the partition, its ids, and the file (header with document ids and ends, then
    the matrix) as bytes. Spark writes it, so any store will do. A shard closes
    when it has ``shard_ids`` ids; it holds whole documents. ``end_id`` is
    appended to each document. Strings that look like special tokens are text,
    unless ``added`` asks for the ids that the library gives them by default.

    Null texts are empty and have the end id alone; null ids come first and stay
    null; rows with equal ids are ordered by text hash and length, and a salt
    spreads equal rows. An empty table writes no shard.
    """
    prepare(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("h"), F.rand(4).alias("salt"))
    (rows.repartitionByRange("id", "h", "salt").sortWithinPartitions("id", "h", "salt").select("id", "text")
     .mapInArrow(_writer(tokenizer_path, end_id, shard_ids, added), "part int, seq int, before long, n long, file binary")
     .write.parquet(path))


def open_shard(data: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """Document ids, the end of each document, and the matrix of a shard file."""
    assert data[:4] == MAGIC, "not a token shard"
    (count,) = struct.unpack_from("<q", data, 4)
    names = np.frombuffer(data, "<i8", count, 12)
    known = np.frombuffer(data, np.uint8, count, 12 + 8 * count)
    ends = np.frombuffer(data, "<i8", count, 12 + 9 * count)
    return [int(x) if k else None for x, k in zip(names, known)], ends, WaveletMatrix.from_bytes(memoryview(data)[12 + 17 * count:])


def _documents(data: bytes, before: int) -> Iterator[tuple[int | None, int, np.ndarray]]:
    names, ends, matrix = open_shard(data)
    ids, begin = matrix.ids(), 0
    for name, end in zip(names, ends.tolist()):
        yield name, before + begin, ids[begin:end]
        begin = end


def _shards(spark: SparkSession, path: str) -> DataFrame:
    files = prepare(spark).read.schema("part int, seq int, before long, n long, file binary").parquet(path)
    start = offsets(files.groupBy("part").agg(F.sum("n").alias("n")), "part", "n")
    return files.join(F.broadcast(start), "part").select("file", (F.col("before") + F.col("n_before")).alias("before"))


def read_token_shards(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """Documents from the files: ``id_col``, start (ids before it) and its ids."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data, before in zip(b.column("file"), b.column("before").to_pylist()):
                rows = list(_documents(memoryview(data.as_buffer()), before))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2].astype(np.int32) for r in rows], pa.list_(pa.int32()))],
                    names=[id_col, "start", "ids"])

    return _shards(spark, path).mapInArrow(read, f"{id_col} long, start long, ids array<int>")


def token_checksums(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """Documents from the files, digested: ``id_col``, start, n_tokens, ids_crc32."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data, before in zip(b.column("file"), b.column("before").to_pylist()):
                rows = [(name, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for name, start, ids in _documents(memoryview(data.as_buffer()), before)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=[id_col, "start", "n_tokens", "ids_crc32"])

    return _shards(spark, path).mapInArrow(read, f"{id_col} long, start long, n_tokens long, ids_crc32 long")
