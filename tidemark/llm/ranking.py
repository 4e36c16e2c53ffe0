"""Ranked lexical search: bundles of items visit the owners of their terms, one stage after another."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import batches_of, prepare, written
from tidemark.llm.places import placed

#: Terms are runs of ASCII letters and digits and of all other characters beyond ASCII, here as UTF-8.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
BREAK = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
PIECE = 1 << 20
FILTER_BITS = 22
#: A block ends with the document that fills either; places in it fit 16 bits.
BLOCK_DOCS, BLOCK_BYTES = 16_384, 16 << 20
ITEMS_A_BUNDLE = 512
#: An occurrence count is worth less than this, whatever the length of the document.
MOST = 1_000_000


def term_counts(text: bytes | None) -> Counter:
    """Occurrences of each term of a whole text, A-Z in small letters; long texts are read in pieces."""
    found: Counter = Counter()
    if text:
        at, text = 0, text.lower()
        while at < len(text):
            stop = BREAK.search(text, at + PIECE) if len(text) - at > PIECE else None
            end = stop.start() if stop else len(text)
            found.update(TERM.findall(text, at, end))
            at = end
    return found


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = pa.schema([("item", pa.int64()), ("term", pa.binary()), ("times", pa.int64())])
    for b in batches:
        texts = zip(b.column("item").to_pylist(), b.column("text").to_pylist())
        yield from batches_of(((i, t, n) for i, x in texts for t, n in term_counts(x).items()), out)


def _bitmap(terms: DataFrame) -> bytes:
    """Which of 2^22 buckets the terms fall into: half a megabyte at most, whatever their number."""
    bucket = F.pmod(F.crc32("term"), F.lit(1 << FILTER_BITS))
    words = terms.select(F.shiftright(bucket, 5).alias("word"), bucket.bitwiseAND(31).cast("int").alias("bit")).groupBy("word") \
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).collect()
    out = np.zeros(1 << (FILTER_BITS - 5), "<u4")
    for r in words:
        out[r.word] = r.bits
    return out.tobytes()


def _index(bitmap: bytes, ids: pa.Field, most_docs: int, most_bytes: int):
    """Blocks of documents: one row with their ids and lengths, and one for each wanted term with places and counts."""
    mask = (1 << FILTER_BITS) - 1
    schema = pa.schema([("block", pa.int64()), ("term", pa.binary()), ("places", pa.binary()), ("counts", pa.binary()), ("lengths", pa.binary()),
                        ("docs", pa.int64()), ("words", pa.int64()), ("ids", pa.list_(ids.type))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        held: list[pa.Array] = []
        lengths: list[int] = []
        postings: dict[bytes, tuple[list[int], list[int]]] = {}
        size = 0

        def close() -> Iterator[pa.RecordBatch]:
            block = part << 32 | number
            n = np.array(lengths, np.int64)
            named = [pa.concat_arrays(held).to_pylist()]
            head = (block, None, None, None, None, int((n > 0).sum()), int(n.sum()), *named)
            yield from batches_of(iter([head]), schema)

            def rows():
                for term, (places, counts) in postings.items():
                    at = np.array(places, np.uint16)
                    yield block, term, at.tobytes(), np.array(counts, np.int64).tobytes(), n[at].tobytes(), 0, 0, None
            yield from batches_of(rows(), schema)

        for b in batches:
            texts, first = b.column("text"), 0
            for k in range(len(texts)):
                text = texts[k].as_py() or b""
                counts = term_counts(text)
                place = len(lengths)
                for term, n in counts.items():
                    found = postings.get(term)
                    if found is None:
                        bucket = crc32(term) & mask
                        if not bitmap[bucket >> 3] >> (bucket & 7) & 1:
                            continue
                        found = postings[term] = ([], [])
                    found[0].append(place)
                    found[1].append(n)
                lengths.append(counts.total())
                size += len(text)
                if len(lengths) >= most_docs or size >= most_bytes:
                    held.append(b.column("id").slice(first, k + 1 - first))
                    yield from close()
                    first, size, number = k + 1, 0, number + 1
                    held, lengths, postings = [], [], {}
            if first < len(texts):
                held.append(b.column("id").slice(first))
        if lengths:
            yield from close()

    return run


def _impacts(batches: Iterator[pa.RecordBatch], docs: int, words: int) -> Iterator[pa.RecordBatch]:
    """Counts and lengths become what one occurrence in an item is worth, before the term's weight."""
    for b in batches:
        impacts = []
        for counts, lengths in zip(b.column("counts").to_pylist(), b.column("lengths").to_pylist()):
            tf, n = np.frombuffer(counts, np.int64), np.frombuffer(lengths, np.int64)
            m = 75 + 25 * n * docs // words
            impacts.append((1_000_000_000 * tf // (1000 * tf + 12 * m)).astype(np.int32).tobytes())
        kept = ("block", "chunk", "owner", "weight", "items", "times", "places")
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(impacts, pa.binary())], names=[*kept, "impacts"])


BUNDLE = "block long, chunk long, items array<long>, rests array<array<long>>, sizes binary, places binary, scores binary"
_BUNDLE = pa.schema([("block", pa.int64()), ("chunk", pa.int64()), ("items", pa.list_(pa.int64())), ("rests", pa.list_(pa.list_(pa.int64()))),
                     ("sizes", pa.binary()), ("places", pa.binary()), ("scores", pa.binary())])


def _visit(stage: int, top: int):
    """One owner adds its terms' contributions to the accumulators of a bundle and hands it on.

    Of a block's documents the ``top`` best so far can only get better. A document
    that stays below them even with all that later owners may add goes.
    """
    def run(bundle: pa.Table, terms: pa.Table) -> pa.Table:
        if not bundle.num_rows or not terms.num_rows:
            return bundle.cast(_BUNDLE) if bundle.num_rows else _BUNDLE.empty_table()
        items, rests = bundle.column("items")[0].as_py(), bundle.column("rests")[0].as_py()
        old_sizes, old_places, old_scores = (np.frombuffer(bundle.column(c)[0].as_py() or b"", t) for c, t in (("sizes", np.int64), ("places", np.uint16), ("scores", np.int64)))
        ends = np.cumsum(old_sizes) if len(old_sizes) else np.zeros(len(items), np.int64)
        places = [np.frombuffer(x, np.uint16) for x in terms.column("places").to_pylist()]
        impacts = [np.frombuffer(x, np.int32) for x in terms.column("impacts").to_pylist()]
        wanted: dict[int, list[tuple[int, int]]] = {}
        for k, (weight, which, times) in enumerate(zip(*(terms.column(c).to_pylist() for c in ("weight", "items", "times")))):
            for i, t in zip(which, times):
                wanted.setdefault(i, []).append((k, weight * t))
        width = 1 + max([0, *(int(p[-1]) for p in places if len(p)), *([int(old_places.max())] if len(old_places) else [])])
        sizes, new_places, new_scores = np.zeros(len(items), np.int64), [], []
        for i, (item, rest) in enumerate(zip(items, rests)):
            begin, end = (int(ends[i - 1]) if i else 0), int(ends[i])
            scores = np.zeros(width, np.int64)
            scores[old_places[begin:end]] = old_scores[begin:end]
            for k, weight in wanted.get(item, ()):
                scores[places[k]] += weight * impacts[k].astype(np.int64)
            at = np.flatnonzero(scores)
            scores = scores[at]
            if len(at) > top:
                keep = scores + rest[stage] >= np.partition(scores, -top)[-top]
                at, scores = at[keep], scores[keep]
            sizes[i] = len(at)
            new_places.append(at.astype(np.uint16))
            new_scores.append(scores)
        out = [bundle.column("block"), bundle.column("chunk"), bundle.column("items"), bundle.column("rests"),
               *(pa.array([x.tobytes()], pa.binary()) for x in (sizes, np.concatenate(new_places), np.concatenate(new_scores)))]
        return pa.Table.from_arrays(out, schema=_BUNDLE)
    return run


def _best(top: int, ids: pa.Field):
    """The ``top`` documents of each item in a block, equal scores by id."""
    schema = pa.schema([("item", pa.int64()), ("id", ids.type), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                names = b.column("ids")[r].values
                sizes, places, scores = (np.frombuffer(b.column(c)[r].as_py() or b"", t) for c, t in (("sizes", np.int64), ("places", np.uint16), ("scores", np.int64)))
                if not len(places):
                    continue
                items = np.repeat(np.array(b.column("items")[r].as_py(), np.int64), sizes)
                found = pa.table([pa.array(items), names.take(pa.array(places.astype(np.int64))), pa.array(scores)], schema=schema)
                order = pc.sort_indices(found, [("item", "ascending"), ("score", "descending"), ("id", "ascending")], null_placement="at_end")
                found = found.take(order)
                sorted_items = found.column("item").to_numpy()
                first = np.searchsorted(sorted_items, sorted_items)
                yield from found.filter(pa.array(np.arange(len(first)) - first < top)).combine_chunks().to_batches()
    return run


def rank_documents(docs: DataFrame, items: DataFrame, top: int = 20, shares: Sequence[float] = (0.005, 0.05, 0.25), id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """For each item its ``top`` documents: ``item_col``, rank (from 1), ``id_col`` and score (above 0).

    The score is a sum of whole numbers over the item's terms, repeats included:
    the term's weight floor(1000 ln((2 N + 2) / (2 df + 1))) times
    (10^9 tf) div (1000 tf + 12 m), m = 75 + (25 n N) div L; n is the document's
    number of terms, N the documents with any, L all their terms. N, L and df are
    counted over all documents. Equal scores go by the smaller id, null ids last.

    Documents are indexed in blocks, bounded in documents and bytes, whole texts
    each; a block keeps places and counts for the items' terms only (found by a
    bitmap of fixed size, then exactly by the join). Terms belong to owners by
    the share of documents that hold them, those in at most ``shares[0]`` to the
    first. Bundles of up to 512 items visit the owners in turn, rare terms first,
    and carry an accumulator for each document of a block that may yet be among
    the best; each visit is a cogroup of bundles and postings by block. So no
    task holds more than a block's postings for one owner, however common a term
    is. The last selection sees ``top`` rows per item and block, which Spark cuts
    to ``top`` per task before the shuffle.

    Null, empty and wordless texts have no terms and are no result; items without
    terms, or without a term that any document holds, have no rows. Repeated rows
    are documents (or items) of their own, with results of their own. Other
    columns are ignored; empty tables give no rows.
    """
    spark = prepare(docs.sparkSession)
    asked = written(placed(items.select(F.col(item_col).alias("name"), F.col(item_text).cast("binary").alias("text")), "name", "text", name="item"), "items")
    terms = written(asked.select("item", "text").mapInArrow(_item_terms, "item long, term binary, times long"), "item-terms")

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    kind = rows.schema["id"].dataType
    ids = pa.field("id", spark.createDataFrame([], rows.select("id").schema).toArrow().schema.field("id").type)
    index = written(rows.mapInArrow(
        _index(_bitmap(terms.select("term").distinct()), ids, BLOCK_DOCS, BLOCK_BYTES),
        f"block long, term binary, places binary, counts binary, lengths binary, docs long, words long, ids array<{kind.simpleString()}>"), "term-index")
    blocks, postings = index.filter("term is null"), index.filter("term is not null")
    total = blocks.agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("docs"), F.coalesce(F.sum("words"), F.lit(0)).alias("words")).first()

    # weights, owners, and what the owners after each can add at most
    held = postings.groupBy("term").agg(F.sum(F.octet_length("places") / 2).cast("long").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * total.docs + 2) / (2 * F.col("df") + 1).cast("double")))
    owner = sum(((F.col("df") > share * total.docs).cast("int") for share in shares), F.lit(0))
    known = terms.join(held, "term").select("item", "term", "times", weight.alias("weight"), owner.alias("owner")).filter("weight > 0")
    known = written(known.withColumn("chunk", F.floor(F.col("item") / ITEMS_A_BUNDLE)), "item-weights")
    stages = len(shares) + 1
    later = [F.sum(F.when(F.col("owner") > k, F.col("weight") * F.col("times") * MOST).otherwise(0)).alias(f"r{k}") for k in range(stages)]
    rests = known.groupBy("chunk", "item").agg(*later).select("chunk", F.struct("item", F.array(*[f"r{k}" for k in range(stages)]).alias("rests")).alias("x"))
    chunks = rests.groupBy("chunk").agg(F.array_sort(F.collect_list("x")).alias("x")).select("chunk", F.col("x.item").alias("items"), F.col("x.rests").alias("rests"))
    chunks = written(chunks, "item-bundles")
    most = asked.agg(F.coalesce(F.max("item"), F.lit(-1))).first()[0]

    of_term = known.groupBy("term", "chunk", "owner", "weight").agg(F.sort_array(F.collect_list(F.struct("item", "times"))).alias("x")) \
        .select("term", "chunk", "owner", "weight", F.col("x.item").alias("items"), F.col("x.times").alias("times"))
    docs_n, words_n = int(total.docs), max(1, int(total.words))
    routed = postings.select("block", "term", "places", "counts", "lengths").join(written(of_term, "term-items"), "term").drop("term").mapInArrow(
        lambda batches: _impacts(batches, docs_n, words_n), "block long, chunk long, owner int, weight long, items array<long>, times array<long>, places binary, impacts binary")
    routed = written(routed, "term-impacts")

    empty = F.lit(None).cast("binary")
    bundles = blocks.select("block", F.explode(F.sequence(F.lit(0), F.lit(max(0, most // ITEMS_A_BUNDLE))).cast("array<long>")).alias("chunk")).join(chunks, "chunk") \
        .select("block", "chunk", "items", "rests", empty.alias("sizes"), empty.alias("places"), empty.alias("scores"))
    for k in range(stages):
        visited = routed.filter(F.col("owner") == k)
        bundles = bundles.groupBy("block", "chunk").cogroup(visited.groupBy("block", "chunk")).applyInArrow(_visit(k, top), BUNDLE)
    ready = written(bundles.select("block", "items", "sizes", "places", "scores").filter(F.octet_length("places") > 0), "accumulators")
    best = ready.join(blocks.select("block", "ids"), "block").mapInArrow(_best(top, ids), f"item long, id {kind.simpleString()}, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(asked.select("item", "name"), "item").select(F.col("name").alias(item_col), "rank", F.col("id").alias(id_col), "score")
