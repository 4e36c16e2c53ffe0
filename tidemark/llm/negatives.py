"""Hard negatives by inner product, searched in an R-tree packed by sort-tile-recursive."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import prepare, written
from tidemark.llm.places import placed

LEAF, FAN = 64, 8
FAR = 1 << 62  # beyond any score
#: Rows that travel to one node at a time.
QUERIES_A_GROUP = 1024


class Tree:
    """A packed R-tree: ``leaves`` (blocks of vectors) and ``levels`` of directories, the root last.

    A leaf row holds the vectors of one block, a directory row the boxes of up to
    ``fan`` nodes of the level below. Vectors of different length have trees of
    their own. ``rows`` has the vectors by themselves: key, dim, label, vec.
    """

    def __init__(self, rows: DataFrame, leaves: DataFrame, levels: list[DataFrame]):
        self.rows, self.leaves, self.levels = rows, leaves, levels


# ---- packing -----------------------------------------------------------------

def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per coordinate the number, sum and sum of squares of a task's vectors."""
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for dim, points, _ in _by_length(b.column("q")):
            s = total.setdefault(dim, np.zeros((3, dim)))
            s += (np.full(dim, len(points)), points.sum(0, dtype=np.float64), (points.astype(np.float64) ** 2).sum(0))
    for s in total.values():
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(s.shape[1])), *(pa.array(x) for x in s)], names=["axis", "n", "s", "ss"])


def _by_length(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The lists of each length as a matrix, and where they stand."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    for dim in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == dim)
        yield dim, column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.int32).reshape(len(at), dim), at


def _as_bytes(axes: list[int]):
    """Vectors as bytes, with the two coordinates by which tiles are cut (0 where a vector is shorter)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for dim, points, at in _by_length(b.column("q")):
                cut = [points[:, c] if c < dim else np.zeros(len(at), np.int32) for c in axes]
                rest = [b.column(c).take(pa.array(at)) for c in ("key", "anchor", "label")]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(np.full(len(at), dim, np.int32)), pa.array([x.tobytes() for x in points], pa.binary()), *(pa.array(x) for x in cut)],
                                                 names=["key", "anchor", "label", "dim", "vec", "c1", "c2"])
    return run


def _tiles(points: np.ndarray, labels: np.ndarray, leaf: int) -> np.ndarray:
    """Order of the points by sort-tile-recursive: by label, then in slabs by the axes of most variance."""
    axes = np.argsort(-points.var(0), kind="stable")[:3].tolist() if points.shape[1] else []

    def tile(at: np.ndarray, axes: list[int]) -> np.ndarray:
        if not axes or len(at) <= leaf:
            return at
        at = at[np.argsort(points[at, axes[0]], kind="stable")]
        pages = -(-len(at) // leaf)
        slabs = int(np.ceil(pages ** (1 / len(axes))))
        step = -(-pages // slabs) * leaf
        return np.concatenate([tile(at[k: k + step], axes[1:]) for k in range(0, len(at), step)])

    by_label = np.argsort(labels, kind="stable")
    cuts = np.flatnonzero(np.diff(labels[by_label])) + 1
    return np.concatenate([tile(part, axes) for part in np.split(by_label, cuts)])


def _pack(group: pa.Table) -> pa.Table:
    """One leaf row: the block's vectors in tiles, and the block's box."""
    labels, keys = group.column("label").to_numpy(), group.column("key").to_numpy()
    first = np.argsort(keys, kind="stable")
    dim = group.column("dim")[0].as_py()
    points = np.frombuffer(b"".join(group.column("vec").to_pylist()), np.int32).reshape(len(keys), dim)[first]
    labels, keys = labels[first], keys[first]
    order = _tiles(points, labels, LEAF)
    points, labels, keys = points[order], labels[order], keys[order]
    return pa.table({
        "dim": pa.array([dim], pa.int32()), "node": pa.array([group.column("node")[0].as_py()], pa.int64()),
        "keys": pa.array([keys.tobytes()], pa.binary()), "labels": pa.array([labels.tobytes()], pa.binary()), "points": pa.array([points.tobytes()], pa.binary()),
        "low": pa.array([points.min(0).tobytes()], pa.binary()), "high": pa.array([points.max(0).tobytes()], pa.binary()),
        "label_low": pa.array([labels.min()], pa.int64()), "label_high": pa.array([labels.max()], pa.int64())})


def _gather(group: pa.Table) -> pa.Table:
    """One directory row from the boxes of its children."""
    order = np.argsort(group.column("child").to_numpy(), kind="stable")
    group = group.take(pa.array(order))
    dim = group.column("dim")[0].as_py()
    low, high = (np.frombuffer(b"".join(group.column(c).to_pylist()), np.int32).reshape(len(group), dim) for c in ("low", "high"))
    label_low, label_high = (group.column(c).to_numpy() for c in ("label_low", "label_high"))
    return pa.table({
        "dim": pa.array([dim], pa.int32()), "node": pa.array([group.column("node")[0].as_py()], pa.int64()),
        "children": pa.array([group.column("child").to_numpy().tobytes()], pa.binary()),
        "lows": pa.array([low.tobytes()], pa.binary()), "highs": pa.array([high.tobytes()], pa.binary()),
        "label_lows": pa.array([label_low.tobytes()], pa.binary()), "label_highs": pa.array([label_high.tobytes()], pa.binary()),
        "low": pa.array([low.min(0).tobytes()], pa.binary()), "high": pa.array([high.max(0).tobytes()], pa.binary()),
        "label_low": pa.array([label_low.min()], pa.int64()), "label_high": pa.array([label_high.max()], pa.int64())})


def pack_tree(rows: DataFrame, block: int = 2048, fan: int = 128) -> Tree:
    """The tree over ``rows`` (key, dim, label: long codes, vec: int32 bytes, and the coordinates ``c1``, ``c2``).

    Blocks are tiles of about ``block`` vectors: all rows are sorted by length,
    label and first coordinate, cut into slabs, and each slab by the second; both
    sorts run over ranges, so equal vectors in any number fill block after block.
    A block's task tiles its vectors again, into leaves of 64. Directories
    gather ``fan`` neighbours each until one row per length is left.
    """
    count = rows.count()
    pages = max(1, -(-count // block))
    slab = -(-pages // max(1, int(np.ceil(sqrt(pages))))) * block
    sliced = placed(rows, "dim", "label", "c1", "key").withColumn("slab", F.floor(F.col("at") / slab)).drop("at")
    tiled = placed(sliced, "slab", "dim", "label", "c2", "key").withColumn("node", F.floor(F.col("at") / block))
    box = "low binary, high binary, label_low long, label_high long"
    leaves = written(tiled.select("dim", "node", "key", "label", "vec").groupBy("dim", "node").applyInArrow(
        _pack, f"dim int, node long, keys binary, labels binary, points binary, {box}"), "tree-leaves")
    levels: list[DataFrame] = []
    below, width = leaves, pages
    while not levels or width > 1:
        width = -(-width // fan)
        boxes = below.select("dim", F.floor(F.col("node") / fan).alias("node"), F.col("node").alias("child"), "low", "high", "label_low", "label_high")
        below = written(boxes.groupBy("dim", "node").applyInArrow(
            _gather, f"dim int, node long, children binary, lows binary, highs binary, label_lows binary, label_highs binary, {box}"), "tree-directory")
        levels.append(below)
    return Tree(rows, leaves, levels)


# ---- search ------------------------------------------------------------------

class Asked:
    """The queries of one group, and the windows each looks into, as flat arrays."""

    def __init__(self, group: pa.StructArray, dim: int, same: bool):
        self.ids = group.field("query").to_numpy(zero_copy_only=False)
        self.labels = group.field("label").to_numpy(zero_copy_only=False)
        self.points = np.frombuffer(b"".join(group.field("vec").to_pylist()), np.int32).reshape(len(self.ids), dim).astype(np.float64)
        sizes = np.array([len(x) for x in group.field("windows").to_pylist()], np.int64)
        flat = group.field("windows").flatten()
        self.of = np.repeat(np.arange(len(sizes)), sizes)
        self.window, self.low, self.high, self.kth = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("window", "low", "high", "kth"))
        self.kth = self.kth.copy()
        self.same = same
        self.up, self.down = np.maximum(self.points, 0), np.minimum(self.points, 0)

    def products(self, points: np.ndarray, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Inner products as whole numbers: in doubles where these are exact, else in 64 bits."""
        mine = self.points[at]
        if mine.size and points.size and np.abs(mine).max() * np.abs(points).max() * points.shape[1] >= 2.0 ** 53:
            return mine.astype(np.int64) @ points.astype(np.int64).T
        return (mine @ points.astype(np.float64).T).astype(np.int64)

    def reach(self, low: np.ndarray, high: np.ndarray, label_low: np.ndarray, label_high: np.ndarray) -> np.ndarray:
        """Per window and box the best score that the box may hold for it; -FAR where it holds none.

        Coordinate by coordinate a box gives an interval of products; their sums
        bound the score. A box is out if that misses the window, if it holds no
        vector of the labels asked for, or if its best is strictly below the kth.
        """
        low, high = low.astype(np.float64), high.astype(np.float64)
        slack = 1 + np.abs(self.points).max(initial=0) * max(np.abs(low).max(initial=0), np.abs(high).max(initial=0)) * max(1, low.shape[1]) * 2.0 ** -50
        limit = lambda x: np.clip(x, -2.0 ** 61, 2.0 ** 61)
        most = limit(np.floor(self.up @ high.T + self.down @ low.T + slack)).astype(np.int64)
        least = limit(np.ceil(self.up @ low.T + self.down @ high.T - slack)).astype(np.int64)
        mine = self.labels[:, None]
        fits = (label_low <= mine) & (mine <= label_high) if self.same else ~((label_low == mine) & (label_high == mine))
        best = np.minimum(most[self.of], self.high[:, None])
        out = fits[self.of] & (best >= self.low[:, None]) & (least[self.of] <= self.high[:, None]) & (best >= self.kth[:, None])
        return np.where(out, best, -FAR)


def _walk(asked: Asked, keys: np.ndarray, labels: np.ndarray, points: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, key, score) of the ``k`` best of each window in one block, best box first.

    The queue holds nodes of the block's own tree by the best score they may
    give to any window. A node is looked at only for the windows that it may
    still serve, and left when there are none.
    """
    begins = np.arange(0, len(keys), LEAF)
    spans = [(begins, np.append(begins[1:], len(keys)))]
    boxes = [(np.minimum.reduceat(points, begins), np.maximum.reduceat(points, begins), np.minimum.reduceat(labels, begins), np.maximum.reduceat(labels, begins))]
    while len(boxes[-1][0]) > 1:
        at = np.arange(0, len(boxes[-1][0]), FAN)
        spans.append((at, np.append(at[1:], len(boxes[-1][0]))))
        low, high, label_low, label_high = boxes[-1]
        boxes.append((np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.minimum.reduceat(label_low, at), np.maximum.reduceat(label_high, at)))
    reach = [asked.reach(*b) for b in boxes]
    held_w, held_k, held_s = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    queue = [(-int(reach[-1][:, 0].max(initial=-FAR)), len(boxes) - 1, 0)]
    while queue:
        _, level, node = heapq.heappop(queue)
        useful = (reach[level][:, node] > -FAR) & (reach[level][:, node] >= asked.kth)
        if not useful.any():
            continue
        a, b = int(spans[level][0][node]), int(spans[level][1][node])
        if level:
            for child in range(a, b):
                best = int(reach[level - 1][useful, child].max())
                if best > -FAR:
                    heapq.heappush(queue, (-best, level - 1, child))
            continue
        windows = np.flatnonzero(useful)
        who, back = np.unique(asked.of[windows], return_inverse=True)
        scores = asked.products(points[a:b], who)[back]
        mine = asked.labels[asked.of[windows]][:, None]
        right = (labels[a:b] == mine) & (keys[a:b] != asked.ids[asked.of[windows]][:, None]) if asked.same else labels[a:b] != mine
        right &= (scores >= np.maximum(asked.low, asked.kth)[windows][:, None]) & (scores <= asked.high[windows][:, None])
        i, j = np.nonzero(right)
        if not len(i):
            continue
        held_w, held_k, held_s = np.append(held_w, windows[i]), np.append(held_k, keys[a:b][j]), np.append(held_s, scores[i, j])
        order = np.lexsort((held_k, -held_s, held_w))
        held_w, held_k, held_s = held_w[order], held_k[order], held_s[order]
        place = np.arange(len(held_w)) - np.searchsorted(held_w, held_w)
        keep = place < k
        last = place == k - 1
        asked.kth[held_w[last]] = np.maximum(asked.kth[held_w[last]], held_s[last])
        held_w, held_k, held_s = held_w[keep], held_k[keep], held_s[keep]
    return held_w, held_k, held_s


def _search(k: int, same: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                dim = b.column("dim")[r].as_py()
                asked = Asked(b.column("asked")[r].values, dim, same)
                keys, labels = (np.frombuffer(b.column(c)[r].as_py(), np.int64) for c in ("keys", "labels"))
                points = np.frombuffer(b.column("points")[r].as_py(), np.int32).reshape(len(keys), dim)
                w, found, scores = _walk(asked, keys, labels, points, k)
                for a in range(0, len(w), 100_000):
                    part = slice(a, a + 100_000)
                    yield pa.RecordBatch.from_arrays([pa.array(asked.ids[asked.of[w[part]]]), pa.array(asked.window[w[part]]), pa.array(found[part]), pa.array(scores[part])],
                                                     names=["query", "window", "key", "score"])
    return run


def _descend(same: bool, best_only: bool):
    """Which children each query goes on to: all that may serve it, or the one with the best reach over its windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                dim = b.column("dim")[r].as_py()
                asked = Asked(b.column("asked")[r].values, dim, same)
                children, label_lows, label_highs = (np.frombuffer(b.column(c)[r].as_py(), np.int64) for c in ("children", "label_lows", "label_highs"))
                lows, highs = (np.frombuffer(b.column(c)[r].as_py(), np.int32).reshape(len(children), dim) for c in ("lows", "highs"))
                reach = asked.reach(lows, highs, label_lows, label_highs)
                if not len(reach):
                    continue
                starts = np.flatnonzero(np.append(True, np.diff(asked.of) > 0))
                best = np.maximum.reduceat(reach, starts)
                who = asked.of[starts]
                if best_only:
                    child = best.argmax(1)
                    i = np.flatnonzero(best[np.arange(len(best)), child] > -FAR)
                    j = child[i]
                else:
                    i, j = np.nonzero(best > -FAR)
                yield pa.RecordBatch.from_arrays([pa.array(asked.ids[who[i]]), pa.array(np.full(len(i), dim, np.int32)), pa.array(children[j])], names=["query", "dim", "node"])
    return run


def _meet(visits: DataFrame, queries: DataFrame, nodes: DataFrame, groups: int, *columns: str) -> DataFrame:
    """Each node's payload once for every group of queries that visit it."""
    one = F.struct("query", "label", "vec", "windows")
    met = visits.join(queries.drop("dim"), "query").groupBy("dim", "node", F.pmod(F.xxhash64("query"), F.lit(groups)).alias("part")).agg(F.collect_list(one).alias("asked"))
    return met.join(nodes.select("dim", "node", *columns), ["dim", "node"]).drop("part")


def search(tree: Tree, queries: DataFrame, k: int, same: bool) -> DataFrame:
    """(query, window, key, score, rank): the first ``k`` rows of each window by score, then by key.

    ``queries`` has query (its own key), dim, label, vec and windows, an array of
    (window, low, high, kth): scores from low to high count, and none strictly
    below kth is needed. ``same`` asks for rows with the query's label, itself
    left out, else for rows with any other label. A first walk follows the best
    box down to one block for each query; what it finds there bounds the second
    walk, which visits every block that the bounds leave.
    """
    queries = written(queries, "tree-queries")
    groups = max(1, -(-queries.count() // QUERIES_A_GROUP))
    order = Window.partitionBy("query", "window").orderBy(F.desc("score"), "key")
    found = None
    for best_only in (True, False):
        visits = queries.select("query", "dim", F.lit(0).cast("long").alias("node"))
        for level in reversed(tree.levels):
            met = _meet(visits, queries, level, groups, "children", "lows", "highs", "label_lows", "label_highs")
            visits = written(met.mapInArrow(_descend(same, best_only), "query long, dim int, node long"), "tree-visits")
        met = _meet(visits, queries, tree.leaves, groups, "keys", "labels", "points")
        hits = met.mapInArrow(_search(k, same), "query long, window int, key long, score long")
        found = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        if best_only:
            last = written(found.filter(F.col("rank") == k).groupBy("query").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("last")), "tree-bounds")
            bound = lambda w: F.struct(w["window"].alias("window"), w["low"].alias("low"), w["high"].alias("high"),
                                       F.greatest(w["kth"], F.coalesce(F.try_element_at("last", w["window"]), F.lit(-FAR))).alias("kth"))
            queries = written(queries.join(last, "query", "left").withColumn("windows", F.transform("windows", bound)).drop("last"), "tree-queries")
    return written(found, "tree-found")


def _quantised(vec: Column, scale: float) -> Column:
    return F.transform(vec.cast("array<double>"), lambda x: F.floor(x * scale))


def hard_negatives(vectors: DataFrame, anchors: Column, label: Column | str = "label", positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256,
                   id_col: str = "vec_id", vec_col: str = "embedding", block: int = 2048) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Components x become floor(scale * x); a score is the whole-number inner
    product with the anchor, higher first, ties by the smaller id. Rows where
    ``anchors`` is true are anchors; an anchor's positives are its first
    ``positives`` other rows of the same ``label``, and each positive's negatives
    the first ``negatives`` rows of another label with low * positive score <=
    100 * score <= high * positive score (0 <= low <= high). Both come from one packed R-tree
    (``pack_tree``, ``search``): positives with one window, negatives with one
    window per positive.

    Rows with a null id, label or vector, with a null or non-finite component, or
    with one of 2^31 / sqrt(length) or more after scaling (whose scores might not
    fit 64 bits) take no part. Vectors of different length have no product: they
    are not compared. Rows with one id are rows of their own, ordered by label
    and vector. Ids and labels may be of any type that can be sorted. Fewer rows
    than asked for give all there are; an empty table gives none. Other columns
    are ignored. Anchors meet a block of ``block`` vectors in groups of about
    1,024, so no task holds more, however many vectors are equal.
    """
    spark = prepare(vectors.sparkSession)
    label = F.col(label) if isinstance(label, str) else label
    raw = vectors.select(F.col(id_col).alias("id"), label.alias("label"), F.coalesce(anchors, F.lit(False)).alias("anchor"), F.col(vec_col).cast("array<double>").alias("v"))
    fits = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) * scale < F.lit(2.0 ** 31) / F.sqrt(F.size("v").cast("double"))))
    sound = raw.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).filter(fits & ~F.exists("v", F.isnan))
    rows = sound.select("id", "label", "anchor", _quantised(F.col("v"), float(scale)).cast("array<int>").alias("q"))
    rows = placed(rows, "id", "label", "q", "anchor", name="key")
    if not isinstance(rows.schema["label"].dataType, T.IntegralType):
        codes = written(placed(rows.select("label").distinct(), "label", name="code"), "label-codes")
        rows = rows.join(codes, "label").drop("label").withColumnRenamed("code", "label")
    rows = written(rows.select("key", "id", "anchor", F.col("label").cast("long").alias("label"), "q"), "vectors")
    spread = (F.sum("ss") - F.sum("s") * F.sum("s") / F.sum("n")).alias("spread")
    axes = [r.axis for r in rows.select("q").mapInArrow(_moments, "axis long, n double, s double, ss double").groupBy("axis").agg(spread).orderBy(F.desc("spread"), "axis").limit(2).collect()]
    flat = written(rows.drop("id").mapInArrow(_as_bytes([*axes, 0, 0][:2]), "key long, anchor boolean, label long, dim int, vec binary, c1 int, c2 int"), "tree-rows")
    tree = pack_tree(flat.drop("anchor"), block)

    window = lambda n, a, b: F.struct(n.cast("int").alias("window"), a.cast("long").alias("low"), b.cast("long").alias("high"), F.lit(-FAR).cast("long").alias("kth"))
    base = flat.filter("anchor").select(F.col("key").alias("query"), "dim", "label", "vec")
    found = search(tree, base.withColumn("windows", F.array(window(F.lit(0), F.lit(-FAR), F.lit(FAR)))), positives, same=True)
    good = found.select("query", F.col("rank").alias("window"), F.col("key").alias("positive"), F.col("score").alias("positive_score"))
    lowest, highest = F.expr(f"({low} * positive_score + 99) div 100"), F.expr(f"({high} * positive_score) div 100")
    windows = good.filter("positive_score >= 0").select("query", window(F.col("window"), lowest, highest).alias("w")).filter("w.low <= w.high") \
        .groupBy("query").agg(F.sort_array(F.collect_list("w")).alias("windows"))
    bad = search(tree, base.join(windows, "query"), negatives, same=False)
    names = rows.select("key", "id")
    return bad.join(good, ["query", "window"]) \
        .join(names.select(F.col("key").alias("query"), F.col("id").alias("anchor_id")), "query") \
        .join(names.select(F.col("key").alias("positive"), F.col("id").alias("positive_id")), "positive") \
        .join(names.withColumnRenamed("id", "negative_id"), "key") \
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", F.col("score").alias("negative_score"))
