"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import prepare, written
from tidemark.llm.places import placed

WORDS = r"[^\x20\x09-\x0D]+"
STEPS = 200
#: Rates are counted in billionths, so that sums of them are exact in any order and reruns agree.
UNIT = 1_000_000_000


def word_count(text: Column) -> Column:
    """Number of runs of anything but white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, most: float = 3.0) -> DataFrame:
    """``sources`` (size and weight per row) with the ``target`` of each: its share of all sizes by weight.

    No target is above ``most`` times its source's size: what is over is shared
    out again by weight, until none is above. Each round is two sums over the
    sources; sizes are whole numbers, so rounds and reruns agree. Sources of
    weight 0 get 0, and so do all if nothing has a size or a weight.
    """
    def sums(df: DataFrame):
        return df.agg(
            F.sum("size").cast("decimal(38,0)").alias("all"), F.sum(F.when(F.col("full"), F.col("size"))).cast("decimal(38,0)").alias("held"),
            F.sum(F.when(~F.col("full"), F.col("weight"))).alias("weight"), F.count(F.when(F.col("full"), 1)).alias("n")).first()

    kept = written(sources.withColumn("full", F.lit(False)), "mix-targets")
    before = -1
    while True:
        x = sums(kept)
        rest = max(0.0, float(x["all"] or 0) - most * float(x.held or 0))
        weight = float(x.weight or 0)
        open_share = F.lit(rest) * F.col("weight") / weight if weight else F.lit(0.0)
        target = F.when(F.col("full"), F.col("size") * float(most)).otherwise(open_share)
        if x.n == before:
            return kept.withColumn("target", target.cast("double")).drop("full")
        before = x.n
        kept = written(kept.withColumn("full", F.col("full") | (open_share > F.col("size") * float(most))), "mix-targets")


def dual_tilts(cells: DataFrame, targets: DataFrame, most: float, tolerance: float = 1e-7) -> DataFrame:
    """The tilt of each source ``s``: its documents' rates are least(``most``, exp(tilt * size / unit)).

    These rates have the least relative entropy to taking every document once,
    among all that meet the source's word target and stay between 0 and ``most``.
    The tilts minimise the convex dual; each is found by Newton steps from 0, all
    sources at once: one grouped sum over the ``cells`` (s, size, n: documents of
    one size) gives gradient and curvature, a step that would leave the known
    bracket is halved into it. The state is one row per source, written at each
    step, and sources drop out as they are done.
    """
    least = cells.filter("size > 0").groupBy("s").agg(F.min("size").alias("least"), F.sum("n").alias("docs"))
    ratio = F.col("target") / F.col("size")
    smallest = F.col("least") / F.col("unit")
    start = targets.join(least, "s").withColumn("unit", F.col("size") / F.col("docs").cast("double"))
    full, none = ratio >= most * (1 - 1e-12), F.col("target") <= 0
    top = F.lit(float(np.log(most))) / smallest
    state = start.select(
        "s", "unit", "target",
        F.when(none, F.lit(-1e9) / smallest).when(full, top).otherwise(0.0).alias("tilt"),
        F.when(ratio < 1, F.log(ratio) / smallest).otherwise(0.0).alias("low"), F.when(ratio < 1, 0.0).otherwise(top).alias("high"),
        (none | full).alias("done"))
    found = written(state, "mix-dual")
    parts = [found.filter("done").select("s", "unit", "tilt")]
    for _ in range(STEPS):
        found = found.filter(~F.col("done"))
        if found.isEmpty():
            break
        power = F.col("tilt") * F.col("size") / F.col("unit")
        rate = F.round(F.least(F.exp(power), F.lit(float(most))) * UNIT).cast("decimal(12,0)")
        words = (F.col("n") * F.col("size")).cast("decimal(20,0)")
        free = F.when(F.exp(power) < most, F.col("size")).otherwise(0).cast("decimal(12,0)")
        sums = cells.filter("size > 0").join(found, "s").groupBy("s").agg(
            F.sum(words * rate).cast("double").alias("got"), F.sum(words * rate * free).cast("double").alias("bend"))
        over = F.col("got") / UNIT - F.col("target")
        low, high = F.when(over < 0, F.col("tilt")).otherwise(F.col("low")), F.when(over > 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - over * F.col("unit") * UNIT / F.col("bend")
        step = found.join(sums, "s").withColumns({"over": over, "newton": newton, "l": low, "h": high})
        inside = F.col("newton").isNotNull() & (F.col("newton") > F.col("l")) & (F.col("newton") < F.col("h"))
        done = (F.abs("over") <= tolerance * F.col("target")) | (F.col("h") - F.col("l") <= 1e-13 * (1 + F.abs("tilt")))
        found = written(step.select(
            "s", "unit", "target", F.when(done, F.col("tilt")).when(inside, F.col("newton")).otherwise((F.col("l") + F.col("h")) / 2).alias("tilt"),
            F.col("l").alias("low"), F.col("h").alias("high"), done.alias("done")), "mix-dual")
        parts.append(found.filter("done").select("s", "unit", "tilt"))
    parts.append(found.filter(~F.col("done")).select("s", "unit", "tilt"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return written(out, "mix-tilts")


def _whole_copies(most: int):
    """Copies for the cells of one source, the longest documents first; what rounding leaves goes on to the next cell."""
    def run(group: pa.Table) -> pa.Table:
        size, n = group.column("size").to_numpy(), group.column("n").to_numpy()
        order = np.argsort(-size, kind="stable")
        rate = group.column("rate").to_numpy()
        copies = np.zeros(len(size), np.int64)
        carry = 0.0
        for k in order.tolist():
            due = float(n[k]) * float(rate[k])
            low = int(np.floor(due))
            high = min(low + (due > low), most * int(n[k]))
            goal = due * float(size[k]) + carry
            copies[k] = min(max(low, round(goal / float(size[k]))), high)
            carry = goal - float(copies[k]) * float(size[k])
        return pa.table({"s": group.column("s"), "size": group.column("size"), "copies": pa.array(copies)})
    return run


def mix(docs: DataFrame, weights: Sequence[float] | DataFrame = (5, 2, 1), most: int = 3, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: ``id_col``, size (words), source_size, target, rate, copies and taken (size * copies).

    Sources get ``weights`` in turn by the code points of their names, null last,
    or those of a table (source, weight), each source once; a source that is not
    there gets 0. Targets share all words by weight, none above ``most`` times
    its source (``source_targets``). Within a source, rates are tilted
    exponentially in the documents' sizes so that the words taken meet the target
    (``dual_tilts``). Rates become copies by size, the longest first: a cell's
    documents (one source, one size) together get what is due to them rounded
    down or up, whichever leaves less, and what is left is carried to the next
    shorter cell, so a source ends near its target: within its longest document
    always, and commonly within its shortest. No document is taken more than
    ``most`` times, nor a copy more or less than its rate. Which documents of a
    cell get one copy more goes by a hash of the id.

    Cells are counted before anything is joined. A source's cells meet in one
    task: with D different sizes it holds at least D * (D + 1) / 2 words, so
    10^12 words make 1.4 million cells at most, however many documents.

    Null and wordless texts have size 0, are taken once and count for nothing;
    rows with one id are documents of their own; a null id is an id like another;
    an empty table gives no rows. Other columns are ignored.
    """
    spark = prepare(docs.sparkSession)
    sized = written(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")), "mix-sizes")
    sums = sized.groupBy("source").agg(F.sum("size").alias("size"))
    sums = placed(sums.withColumn("last", F.col("source").isNull()), "last", "source", name="s").drop("last")
    if isinstance(weights, DataFrame):
        given = weights.select(F.col("source").alias("_source"), F.col("weight").cast("double").alias("weight"))
        sums = sums.join(given, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    else:
        turn = F.array(*[F.lit(float(w)) for w in weights])
        sums = sums.withColumn("weight", F.get(turn, F.pmod("s", F.lit(len(weights))).cast("int")))
    targets = written(source_targets(sums, most), "mix-sources")

    names = targets.select(F.col("source").alias("_source"), "s")
    numbered = sized.join(names, F.col("source").eqNullSafe(F.col("_source"))).select("id", "s", "size", F.xxhash64("id").alias("h"), F.rand(12).alias("salt"))
    # the salt only parts rows that are alike in all that is returned
    rows = placed(numbered, "s", "size", "h", "id", "salt").select("id", "s", "size", "at")
    cells = written(rows.groupBy("s", "size").agg(F.count("*").alias("n"), F.min("at").alias("first")), "mix-cells")
    tilts = dual_tilts(cells, targets.select("s", "size", "target"), float(most))
    rate = F.round(F.least(F.exp(F.col("tilt") * F.col("size") / F.col("unit")), F.lit(float(most))) * UNIT) / UNIT
    rated = cells.filter("size > 0").join(tilts, "s").select("s", "size", "n", "first", rate.alias("rate"))
    whole = rated.select("s", "size", "n", "rate").groupBy("s").applyInArrow(_whole_copies(most), "s long, size long, copies long")
    decided = written(rated.join(whole, ["s", "size"]).join(targets.select("s", F.col("size").alias("source_size"), "target"), "s"), "mix-copies")
    zero = cells.filter("size = 0").join(targets.select("s", F.col("size").alias("source_size"), "target"), "s") \
        .select("s", "size", "n", "first", F.lit(1.0).alias("rate"), F.col("n").alias("copies"), "source_size", "target")
    decided = written(decided.select(*zero.columns).unionByName(zero), "mix-cells")
    extra = (F.col("at") - F.col("first") < F.col("copies") % F.col("n")).cast("long")
    out = rows.join(decided, ["s", "size"]).withColumn("mine", F.floor(F.col("copies") / F.col("n")) + extra)
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * F.col("mine")).alias("taken"), F.col("mine").alias("copies"), "rate")
