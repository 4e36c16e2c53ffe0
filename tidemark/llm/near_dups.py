"""Near-duplicate documents by SuperMinHash, banding, verification and grouping."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mix, prepare, strings, written
from tidemark.llm.components import components

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BASE = np.uint64(0x9E3779B97F4A7C15)
BYTE = mix(np.arange(1, 257, dtype=np.uint64))
GRAM = 5
PLACE = mix(np.arange(1000, 1000 + GRAM, dtype=np.uint64)) | np.uint64(1)
SLICE = 1 << 21


def word_hashes(data: np.ndarray, at: np.ndarray, space: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of flat texts, and the n + 1 places where texts' words begin.

    A word is a run of bytes not marked in ``space`` (by itself space and 0x09 to
    0x0D), A-Z in small letters; words never cross the border of a text.
    """
    solid = ~space[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    borders = at[:-1][at[:-1] < len(data)]
    first[borders] = solid[borders]
    begins = np.flatnonzero(first)
    if not len(begins):
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
    with np.errstate(over="ignore"):
        # a word's bytes run to the next word; the spaces after it count nothing
        place = np.arange(len(data)) - np.repeat(np.append(0, begins), np.diff(np.concatenate(([0], begins, [len(data)]))))
        powers = np.multiply.accumulate(np.full(int(place[begins[0]:].max()) + 1, BASE, np.uint64))
        value = np.where(solid, BYTE[LOWER[data]], np.uint64(0))
        value[begins[0]:] *= powers[place[begins[0]:]]
        hashes = mix(np.add.reduceat(value, begins))
    return hashes, np.searchsorted(begins, at)


def shingle_sets(data: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its five-word shingles.

    A text of one to four words has its whole sequence as its one shingle; one
    without words has none.
    """
    words, ends = word_hashes(data, at)
    out = []
    with np.errstate(over="ignore"):
        terms = [words * p for p in PLACE]
        if len(words) >= GRAM:
            grams = mix(sum((terms[k][k: len(words) - GRAM + 1 + k] for k in range(1, GRAM)), terms[0][: len(words) - GRAM + 1]))
        for a, b in zip(ends.tolist(), ends[1:].tolist()):
            if b - a >= GRAM:
                out.append(np.unique(grams[a: b - GRAM + 1]))
            elif b > a:
                out.append(mix(np.array([sum((terms[k][a + k] for k in range(b - a)), np.uint64(b - a))], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def super_minhash(sets: list[np.ndarray], size: int) -> np.ndarray:
    """A SuperMinHash signature for every set, ``size`` values each.

    Every element walks through its own random permutation of the ``size`` places
    and offers to the j-th place it comes to the value j + r, r random below 1; a
    place keeps the least offer. As an element's ranks are a permutation, its
    places are not independent, which lowers the variance of the estimate. An
    element stops when j exceeds the largest value of its set's signature, since
    no later offer can be less; after a set of many elements has filled all its
    places, that is at once. All elements of all sets step together, one round
    for each j.
    """
    out = np.full((len(sets), size), np.inf)
    lengths = np.array([len(s) for s in sets])
    if not lengths.sum():
        return out
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), lengths)
    for begin in range(0, len(flat), 1 << 17):  # a chunk of elements: minima of chunks are minima of sets
        element, row = flat[begin: begin + (1 << 17)], owner[begin: begin + (1 << 17)]
        order = None
        for j in range(size):
            with np.errstate(over="ignore"):
                draw = mix(element + np.uint64(j + 1) * BASE)
            pick = j + ((draw & np.uint64(0xFFFFFFFF)) * np.uint64(size - j) >> np.uint64(32)).astype(np.int64)
            value = j + (draw >> np.uint64(32)) / 2.0 ** 32
            # the shuffle's j-th step swaps places j and pick
            if order is None:
                place = pick
            else:
                each = np.arange(len(element))
                place = order[each, pick].astype(np.int64)
                order[each, pick] = order[:, j]
            np.minimum.at(out.reshape(-1), row * size + place, value)
            going = j + 1 <= out.max(1)[row]
            if j + 1 == size or not going.any():
                break
            element, row = element[going], row[going]
            if order is None:
                order = np.tile(np.arange(size, dtype=np.uint8), (len(element), 1))
                order[np.arange(len(element)), pick[going]] = 0
            else:
                order = order[going]
    return out


def slices(column: pa.Array, most: int = SLICE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``most`` bytes: first text, bytes, places."""
    data, at = strings(column)
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
        yield i, data[at[i]: at[j]], at[i: j + 1] - at[i]
        i = j


def sketches(docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int) -> DataFrame:
    """Per document: id, set size n, a 128-bit digest (d1, d2) of the set, and its band keys."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, data, at in slices(b.column("text")):
                sets = shingle_sets(data, at)
                signature = super_minhash(sets, bands * rows)
                with np.errstate(over="ignore"):
                    bits = np.where(np.isinf(signature), 0, signature).view(np.uint64).reshape(len(sets), bands, rows)
                    keys = mix((mix(bits) * mix(np.arange(1, rows + 1, dtype=np.uint64))).sum(2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64) * BASE)
                    digests = [(s.sum(dtype=np.uint64), mix(s + BASE).sum(dtype=np.uint64)) for s in sets]
                flat = pa.array(keys.reshape(-1).view(np.int64))
                yield pa.RecordBatch.from_arrays([
                    b.column("id").slice(i, len(sets)), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(np.array([d[0] for d in digests], np.uint64).view(np.int64)), pa.array(np.array([d[1] for d in digests], np.uint64).view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * bands), flat)],
                    names=["id", "n", "d1", "d2", "bands"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, n long, d1 long, d2 long, bands array<long>")


def _linked(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets overlap by ``percent`` of their union or more.

    Texts are joined to both ends, so no pair waits for a group; the hub's set is
    made once for a run of rows that share it.
    """
    full = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a") \
        .join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for batch in batches:
            a, b, ok = batch.column("a"), batch.column("b"), []
            ends = b.to_pylist()
            for i, data, at in slices(batch.column("ta")):
                for k, one in enumerate(shingle_sets(data, at), start=i):
                    if last is None or ends[k] != last:
                        last = ends[k]
                        held = shingle_sets(*strings(batch.column("tb").slice(k, 1)))[0]
                    shared = len(np.intersect1d(one, held, assume_unique=True))
                    ok.append(100 * shared >= percent * (len(one) + len(held) - shared))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], names=["a", "b"])

    kind = dict(pairs.dtypes)["a"]
    return full.select("a", "b", "ta", "tb").mapInArrow(run, f"a {kind}, b {kind}")


def _across(rest: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that may be linked: all that are, and few others.

    Each set's shingles are put in one order, the rarest first. Two sets that
    share m shingles have the first of these at most m places from the end in
    both; as ``percent`` asks for a certain m, a pair must meet in a shingle among
    the first of both. The edits of a copy are its rarest shingles, so copies with
    too many edits meet nobody there.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, data, at in slices(b.column("text")):
                sets = shingle_sets(data, at)
                yield pa.RecordBatch.from_arrays([*(b.column(c).slice(i, len(sets)) for c in ("rep", "n", "root")), pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))], names=["rep", "n", "root", "grams"])

    kind = dict(rest.dtypes)["rep"]
    sets = written(rest.join(texts.withColumnRenamed("id", "rep"), "rep").select("rep", "n", "root", "text").mapInArrow(run, f"rep {kind}, n long, root {kind}, grams array<long>"), "rest")
    grams = sets.select("rep", "n", "root", F.explode("grams").alias("g"))
    shared = grams.groupBy("g").agg(F.count("*").alias("c")).filter("c > 1")
    ranked = grams.join(shared, "g").groupBy("rep", "n", "root").agg(F.sort_array(F.collect_list(F.struct("c", "g"))).alias("l"))
    # shingles that no other set has come first, so shared ones start after them
    placed = ranked.select("rep", "n", "root", F.size("l").alias("held"), F.posexplode("l").alias("k", "s")) \
        .select("rep", "n", "root", "s.g", (F.col("n") - F.col("held") + F.col("k")).alias("place"))
    need = lambda x, y: F.ceil((x + y) * percent / (100 + percent) - 1e-9)
    front = written(placed.filter(F.col("place") <= F.col("n") - need(F.col("n"), F.ceil(F.col("n") * percent / 100 - 1e-9))), "fronts")
    x, y = front.alias("x"), front.alias("y")
    m = need(F.col("x.n"), F.col("y.n"))
    meet = (F.col("x.g") == F.col("y.g")) & (F.col("x.rep") > F.col("y.rep")) & (F.col("x.root") != F.col("y.root")) \
        & (F.col("x.place") <= F.col("x.n") - m) & (F.col("y.place") <= F.col("y.n") - m)
    return x.join(y, meet).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct()


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Components (node, root) after more links: those of the links' roots, carried over to their nodes."""
    of = lambda end: roots.select(F.col("node").alias(end), F.col("root").alias(f"r{end}"))
    above = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).distinct()
    step = written(components(above), "roots")
    carried = roots.join(step.select(F.col("node").alias("root"), F.col("root").alias("next")), "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return carried.unionByName(step.join(roots.select("node"), "node", "left_anti").select("node", "root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85, bands: int = 20, rows: int = 4) -> DataFrame:
    """One row per document: ``id_col``, n_shingles, component_id and kept.

    Documents are linked if their sets of five-word shingles overlap by
    ``percent`` of the union or more; ``component_id`` is the least id reachable
    by links, and a document is kept if that is its own.

    1. Each text gets a SuperMinHash signature, cut into ``bands`` keys of
       ``rows`` values: a pair at 0.85 shares none with a chance of 4 in 10 million.
    2. Documents with equal sets form one class, which its least id stands for;
       copies go no further.
    3. In each bucket (equal band key) every member is compared with the hub, the
       least id, on the full sets; links make components. So a bucket of copies
       of one text takes one comparison a member, however many they are.
    4. Where a bucket of three or more still holds several components, its
       members are compared across components too. An exact rule names the pairs
       (``_across``), so no link within a bucket is lost, and copies of one text
       that differ too much from each other are not compared pair by pair.

    Null, empty and wordless texts have no shingles and are linked with nothing.
    Null ids form no links; they have no component and are not kept. Rows with
    one id should hold one text; if they do not, any of their texts links the id.
    """
    spark = prepare(docs.sparkSession)
    base = written(sketches(docs, id_col, text_col, bands, rows), "sketches")
    sets = base.filter("n > 0 and id is not null")
    # written, so that a class with most of the documents can be split where they are joined to it
    classes = written(sets.groupBy("n", "d1", "d2").agg(F.min("id").alias("rep"), F.first("bands").alias("bands")), "classes")
    keyed = classes.select("rep", "n", F.explode("bands").alias("key"))
    crowded = keyed.groupBy("key").agg(F.count("*").alias("members"), F.min("rep").alias("hub")).filter("members > 1")
    buckets = written(keyed.join(crowded, "key").select("key", "rep", "n", "hub"), "buckets")
    sizes = classes.select(F.col("rep").alias("hub"), F.col("n").alias("hub_n"))
    able = F.col("n") * 100 >= F.col("hub_n") * percent
    able = able & (F.col("hub_n") * 100 >= F.col("n") * percent)
    first = buckets.filter("rep <> hub").select("rep", "n", "hub").distinct().join(sizes, "hub").filter(able)
    pairs = written(first.select(F.col("rep").alias("a"), F.col("hub").alias("b")), "pairs")
    texts_of = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    wanted = buckets.select(F.col("rep").alias("id")).distinct()
    texts = written(texts_of.join(wanted, "id", "left_semi"), "texts")
    links = written(_linked(pairs, texts, percent), "near-links")
    roots = written(components(links), "roots")

    # members of buckets in which more than one component is left
    labelled = buckets.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select("key", "rep", "n", F.coalesce("root", "rep").alias("root"))
    mixed = labelled.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count("*").alias("members")).filter("r0 <> r1 and members > 2").select("key")
    rest = labelled.join(mixed, "key", "left_semi").select("rep", "n", "root").distinct()
    more = written(_linked(written(_across(rest, texts, percent), "pairs"), texts, percent), "near-links")
    if not more.isEmpty():
        roots = written(_merged(roots, more), "roots")

    # a class whose members differ in id: all link to the one that stands for it
    member = sets.select("id", "n", "d1", "d2").join(classes.select("n", "d1", "d2", "rep"), ["n", "d1", "d2"]).select("id", "rep")
    found = member.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select("id", F.coalesce("root", "rep").alias("root"))
    found = found.groupBy("id").agg(F.min("root").alias("root"))
    out = base.select("id", "n").join(found, "id", "left").withColumn("component_id", F.coalesce("root", "id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
