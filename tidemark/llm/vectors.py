"""Near-duplicate vectors by an exact metric range join over pivot cells."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import prepare, written
from tidemark.llm.components import components


def _unit(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of one length as a matrix, and the same scaled to length 1."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    raw = flat.reshape(len(column), -1)
    raw = raw / np.abs(raw).max(1, keepdims=True)  # so that squares neither overflow nor vanish
    return raw, raw / np.sqrt((raw * raw).sum(1, keepdims=True))


def _cosines(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], least: float) -> np.ndarray:
    """Which pairs have a cosine of ``least`` or more; those at the edge are computed again singly."""
    dots = a[1] @ b[1].T
    out = dots >= least
    for i, j in zip(*np.nonzero(np.abs(dots - least) < 1e-12)):
        x, y = a[0][i], b[0][j]
        out[i, j] = math.fsum(x * y) / math.sqrt(math.fsum(x * x) * math.fsum(y * y)) >= least
    return out


def _pivots(classes: DataFrame, cell: int, most: int) -> dict[tuple[int, int], np.ndarray]:
    """Pivots for each label (and vector length) with over ``cell`` vectors, ``most`` altogether.

    Only the largest labels are counted at the driver, ``most`` at most; each gets
    its share of the pivots, the vectors least by hash.
    """
    big = classes.groupBy("label", "dim").agg(F.count("*").alias("n")).filter(F.col("n") > cell).orderBy(F.desc("n"), "label", "dim").limit(most).collect()
    total = sum(r.n for r in big)
    share = [(r.label, r.dim, min(-(-r.n // cell), max(1, most * r.n // total))) for r in big]
    share = [s for s in share if s[2] > 1]
    if not share:
        return {}
    spark = classes.sparkSession
    wanted = spark.createDataFrame(share, "label long, dim int, want long")
    ranked = classes.select("label", "dim", "h1", "h2", "vec").withColumn("at", F.row_number().over(Window.partitionBy("label", "dim").orderBy("h1", "h2"))).filter(F.col("at") <= most)
    rows = ranked.join(F.broadcast(wanted), ["label", "dim"]).filter("at <= want").select("label", "dim", "vec").collect()
    out: dict[tuple[int, int], list] = {}
    for r in rows:
        out.setdefault((r.label, r.dim), []).append(r.vec)
    return {k: _unit(pa.array(sorted(v), pa.list_(pa.float64())))[1] for k, v in out.items()}


def _assign(pivots: dict[tuple[int, int], np.ndarray], reach: float):
    """Each vector goes to the cell of its nearest pivot, and as a guest to lower cells it may reach.

    By the triangle inequality a vector within ``reach`` of some member of cell j
    is at most 2 * reach farther from pivot j than from its own. Both lie in flat
    space, so it is also within ``reach`` of the plane halfway between the two
    pivots, which rules out more cells. Of two cells that a pair lies across, the
    lower one finds it.
    """
    def run(batches):
        for b in batches:
            labels, dims = b.column("label").to_pylist(), b.column("dim").to_pylist()
            rows, cells, guest = [], [], []
            for key in set(zip(labels, dims)):
                at = np.array([k for k, x in enumerate(zip(labels, dims)) if x == key])
                centres = pivots.get(key)
                if centres is None:
                    rows.append(at), cells.append(np.zeros(len(at), int)), guest.append(np.zeros(len(at), bool))
                    continue
                unit = _unit(b.column("vec").take(pa.array(at)))[1]
                square = np.maximum(0, 2 - 2 * unit @ centres.T)
                home = square.argmin(1)
                near = _near(square, centres, home, reach) & (np.arange(len(centres)) < home[:, None])
                i, j = np.nonzero(near)
                rows += [at, at[i]]
                cells += [home, j]
                guest += [np.zeros(len(at), bool), np.ones(len(i), bool)]
            if rows:
                take = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays([*(b.column(c).take(take) for c in ("rep", "n", "label", "dim", "vec")), pa.array(np.concatenate(cells), pa.int64()), pa.array(np.concatenate(guest))],
                                                 names=["rep", "n", "label", "dim", "vec", "cell", "guest"])

    return run


def _near(square: np.ndarray, centres: np.ndarray, home: np.ndarray, reach: float) -> np.ndarray:
    """Which cells hold vectors that may lie within ``reach`` of each vector, by its distances to all pivots."""
    own = square[np.arange(len(home)), home]
    # pivots that nearly coincide lose their distance to rounding, so it is taken a little larger
    between = np.sqrt(np.maximum(0, 2 - 2 * centres @ centres.T))[home] + 1e-7
    near = np.sqrt(square) - np.sqrt(own)[:, None] <= 2 * reach + 1e-9
    return near & (square - own[:, None] <= 2 * between * (reach + 1e-9) + 1e-12)


def _split(reach: float, fan: int):
    """One part of a cell dealt to the cell's own pivots: members as in ``_assign``, guests to every cell they may reach."""
    def run(rows: pa.Table, pivots: pa.Table) -> pa.Table:
        if not rows.num_rows or not pivots.num_rows:
            return PLACED.empty_table()
        centres = _unit(pivots.column("pivots").combine_chunks().flatten())[1]
        square = np.maximum(0, 2 - 2 * _unit(rows.column("vec"))[1] @ centres.T)
        home = square.argmin(1)
        guest = rows.column("guest").to_numpy(zero_copy_only=False)
        near = _near(square, centres, home, reach) & (guest[:, None] | (np.arange(len(centres)) < home[:, None]))
        mine = np.flatnonzero(~guest)
        i, j = np.nonzero(near)
        rows_, cells = np.append(mine, i), np.append(home[mine], j)
        taken = rows.select(["rep", "n", "label", "dim", "vec", "cell"]).take(pa.array(rows_))
        cell = taken.column("cell").to_numpy() * fan + cells
        return pa.Table.from_arrays([*(taken.column(c) for c in ("rep", "n", "label", "dim", "vec")), pa.array(cell), pa.array(np.arange(len(rows_)) >= len(mine))], schema=PLACED)

    return run


PLACED = pa.schema([("rep", pa.int64()), ("n", pa.int64()), ("label", pa.int64()), ("dim", pa.int32()), ("vec", pa.list_(pa.float64())), ("cell", pa.int64()), ("guest", pa.bool_())])
FAN, PART, LEVELS = 64, 8192, 8


def _refined(placed: DataFrame, reach: float, cell: int) -> DataFrame:
    """Cells with over two blocks of members split by pivots of their own, again and again, until none is left.

    A cell takes up to 64 pivots at a time, the members least by hash, so the
    number of rounds is the logarithm of the cell's size. Its rows meet their
    pivots in parts of 8,192. Vectors too near each other to part, if any, stay
    after the last round in a cell that is joined in blocks.
    """
    key = ["label", "dim", "cell"]
    done, level = None, 0
    while level < LEVELS:
        counts = placed.groupBy(*key).agg(F.count(F.when(~F.col("guest"), 1)).alias("own"), F.count(F.lit(1)).alias("all"))
        over = written(counts.filter(F.col("own") > 2 * cell), "crowded-cells")
        if over.isEmpty():
            break
        rest = placed.join(over.select(*key), key, "left_anti").withColumn("level", F.lit(level))
        done = rest if done is None else done.unionByName(rest)
        crowded = placed.join(over, key)
        first = Window.partitionBy(*key).orderBy(F.xxhash64("rep", F.lit(level)), "rep")
        chosen = crowded.filter(~F.col("guest")).withColumn("at", F.row_number().over(first)).filter(F.col("at") <= FAN).filter(F.col("at") <= F.ceil(F.col("own") / cell))
        parts = F.ceil(F.col("all") / PART).cast("int")
        pivots = chosen.groupBy(*key, "all").agg(F.collect_list("vec").alias("pivots")).withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("all")
        pivots = written(pivots, "cell-pivots")
        dealt = crowded.withColumn("part", F.pmod(F.xxhash64("rep", F.lit(7)), parts).cast("int")).drop("own", "all")
        split = dealt.groupBy(*key, "part").cogroup(pivots.groupBy(*key, "part")).applyInArrow(
            _split(reach, FAN), "rep long, n long, label long, dim int, vec array<double>, cell long, guest boolean")
        placed = written(split, "vector-cells")
        level += 1
    last = placed.withColumn("level", F.lit(level))
    return last if done is None else written(done.unionByName(last), "vector-cells")


def _join(least: float):
    """Links between two blocks of a cell: per vector the copies linked to it, and a star for each local group."""
    def run(group: pa.Table) -> pa.Table:
        side = group.column("side").to_numpy()
        rep, n = group.column("rep").to_numpy(), group.column("n").to_numpy()
        vectors = _unit(group.column("vec"))
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        alone = not len(right) and bool(group.column("b1")[0].as_py() == group.column("b2")[0].as_py())
        right = left if alone else right
        found = _cosines((vectors[0][left], vectors[1][left]), (vectors[0][right], vectors[1][right]), least) if len(left) and len(right) else np.zeros((len(left), len(right)), bool)
        if alone:
            np.fill_diagonal(found, False)
        count = np.zeros(len(rep), np.int64)
        count[left] += found @ n[right]
        if not alone:
            count[right] += n[left] @ found
        # groups within the two blocks, by the least id reached, until nothing changes
        root = rep.copy()
        touched = np.zeros(len(rep), bool)
        i, j = np.nonzero(found)
        i, j = left[i], right[j]
        touched[i] = touched[j] = True
        while len(i):
            before = root.copy()
            np.minimum.at(root, i, root[j])
            np.minimum.at(root, j, root[i])
            if (root == before).all():
                break
        keep = pa.array(touched)
        return pa.table({"rep": pa.array(rep), "root": pa.array(root), "linked": pa.array(count)}).filter(keep)

    return run


def vector_groups(vectors: DataFrame, least: float = 0.98, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", cell: int = 512, pivots: int = 4096) -> DataFrame:
    """One row per vector: ``id_col``, n_links, component_id and kept.

    Vectors of equal label and length are linked if their cosine is ``least`` or
    more, computed in double precision. For vectors of length 1 that is a
    distance of sqrt(2 - 2 * least) or less, a metric: pivots cut each label into
    cells, guests come over the borders, and cells are joined independently, in
    blocks of ``cell`` vectors, so that no task holds more than two blocks,
    however many vectors lie together. Equal vectors (by a 128-bit hash) are one
    class and compared once, with their number. A block pair returns one row per
    vector, not one per link. The pivots sent to all tasks are ``pivots`` at
    most; cells that are still too full have pivots of their own, level by level
    (``_refined``), so labels and vectors may be any number.

    Vectors that are null, empty, zero or hold a null or a value that is not
    finite, and those without label or id, are linked with nothing. Rows with
    one id count as different vectors, but share links and component.
    """
    spark = prepare(vectors.sparkSession)
    vec = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), vec.alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & ~F.coalesce(bad, F.lit(False)) & F.coalesce(F.exists("vec", lambda x: x != 0), F.lit(False))
    marked = rows.select("id", "label", F.size("vec").alias("dim"), F.xxhash64(F.lit(1), "vec").alias("h1"), F.xxhash64(F.lit(2), "vec").alias("h2"), "vec").filter(sound)
    classes = written(marked.groupBy("label", "dim", "h1", "h2").agg(F.min("id").alias("rep"), F.count("*").alias("n"), F.first("vec").alias("vec")), "vector-classes")

    centres = _pivots(classes, cell, pivots)
    reach = math.sqrt(max(0.0, 2 - 2 * least))
    placed = written(classes.select("rep", "n", "label", "dim", "vec").mapInArrow(_assign(centres, reach), "rep long, n long, label long, dim int, vec array<double>, cell long, guest boolean"), "vector-cells")
    placed = _refined(placed, reach, cell)
    # blocks: members of a cell among themselves, and each block of members with each block of guests
    key = ["label", "dim", "level", "cell"]
    sizes = placed.groupBy(*key).agg(F.sum(F.when(~F.col("guest"), 1).otherwise(0)).alias("own"), F.sum(F.when(F.col("guest"), 1).otherwise(0)).alias("guests"))
    blocks = sizes.filter("own > 0").select(*key, F.ceil(F.col("own") / cell).cast("int").alias("nb"), F.ceil(F.col("guests") / cell).cast("int").alias("ng"))
    slot = placed.join(blocks, key).withColumn("blk", F.pmod(F.xxhash64("rep", F.lit(3)), F.when(F.col("guest"), F.col("ng")).otherwise(F.col("nb"))).cast("int"))
    all_own, all_guests = F.sequence(F.lit(0), F.col("nb") - 1), F.when(F.col("ng") > 0, F.sequence(F.lit(0), F.col("ng") - 1)).otherwise(F.array().cast("array<int>"))
    pair = lambda b1, b2, mixed, side: F.struct(b1.cast("int").alias("b1"), b2.cast("int").alias("b2"), F.lit(mixed).alias("mixed"), side.cast("int").alias("side"))
    among = F.transform(all_own, lambda o: pair(F.least("blk", o), F.greatest("blk", o), False, (F.col("blk") > o)))
    toward = F.transform(all_guests, lambda g: pair(F.col("blk"), -1 - g, True, F.lit(0)))
    hosts = F.transform(all_own, lambda o: pair(o, -1 - F.col("blk"), True, F.lit(1)))
    dealt = slot.withColumn("p", F.explode(F.when(F.col("guest"), hosts).otherwise(F.concat(among, toward)))).select("rep", "n", *key, "vec", "p.*")
    found = written(dealt.groupBy(*key, "b1", "b2").applyInArrow(_join(least), "rep long, root long, linked long"), "vector-links")

    roots = components(found.filter("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("rep").agg(F.sum("linked").alias("linked"))
    of_class = classes.select("label", "dim", "h1", "h2", "rep", "n").join(counts, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left") \
        .select("label", "dim", "h1", "h2", (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("root", "rep").alias("root"))
    mine = marked.select("id", "label", "dim", "h1", "h2").join(of_class, ["label", "dim", "h1", "h2"]).groupBy("id").agg(F.max("links").alias("links"), F.min("root").alias("root"))
    out = rows.select("id").join(mine, "id", "left").select("id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("root", "id").alias("component_id"))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
