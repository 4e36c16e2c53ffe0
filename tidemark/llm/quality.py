"""Quality scores learned from trusted positives and unlabelled text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import prepare

#: Kinds of bytes: white space, line feed, digit, capital, small letter, other UTF-8, and punctuation by itself or in groups.
KINDS = 16


def _kinds() -> np.ndarray:
    table = np.full(256, 15, np.uint8)
    table[128:] = 5
    for kind, chars in enumerate((b" \t\r\x0b\x0c", b"\n", b"0123456789", bytes(range(65, 91)), bytes(range(97, 123)))):
        table[list(chars)] = kind
    for kind, chars in enumerate((b".", b",", b"!?", b"|", b"#*", b"$%&", b"\"'`", b"()[]{}<>", b":;"), start=6):
        table[list(chars)] = kind
    return table


TABLE = _kinds()
WIDTH = KINDS * KINDS + 8


def features(text: str | None) -> np.ndarray:
    """Shares of neighbouring byte kinds, and how varied the words and lines are; the whole text counts."""
    out = np.zeros(WIDTH, np.float32)
    if not text:
        return out
    kind = TABLE[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)].astype(np.int64)
    if len(kind) > 1:
        out[: KINDS * KINDS] = np.sqrt(np.bincount(kind[:-1] * KINDS + kind[1:], minlength=KINDS * KINDS) / (len(kind) - 1))
    words, lines = text.split(), text.split("\n")
    n = max(1, len(words))
    unique = len(set(words))
    out[KINDS * KINDS:] = (
        np.log1p(len(kind)) / 10, unique / n, np.log1p(n) / 10 - np.log1p(unique) / 10, len(set(lines)) / len(lines),
        sum(a == b for a, b in zip(words, words[1:])) / n, min(1.0, max(map(len, words), default=0) / 50),
        len("".join(words)) / n / 20, len(lines) / n)
    return out


def standardised(x: np.ndarray, mean: np.ndarray, scale: np.ndarray, short: float = 30.0) -> np.ndarray:
    """Features by their mean and deviation; those of a text with few bytes count little, as they say little."""
    size = np.expm1(10.0 * x[:, KINDS * KINDS].astype(np.float64))
    return ((x - mean) / scale).clip(-6, 6) * (size / (size + short))[:, None]


class PuModel:
    """A linear model on standardised features; scores are probabilities of the positive class."""

    def __init__(self, weights: np.ndarray, bias: float, mean: np.ndarray, scale: np.ndarray, prior: float):
        self.weights, self.bias, self.mean, self.scale, self.prior = weights, bias, mean, scale, prior

    def scores(self, x: np.ndarray) -> np.ndarray:
        # the fit's target is 2 * probability - 1
        margin = np.clip(4 * (standardised(x, self.mean, self.scale) @ self.weights + self.bias), -30, 30)
        return 1 / (1 + np.exp(-margin))


@dataclass
class Moments:
    """Number, sum and sum of products of a group's standardised features, the last feature being 1."""

    count: float
    mean: np.ndarray
    square: np.ndarray


def _moments(rows: np.ndarray) -> Moments:
    if not len(rows):
        return Moments(0.0, np.zeros(WIDTH + 1), np.zeros((WIDTH + 1, WIDTH + 1)))
    x = rows.astype(np.float64)
    return Moments(float(len(x)), x.mean(0), x.T @ x / len(x))


def _together(parts: list[Moments]) -> Moments:
    n = sum(m.count for m in parts)
    if not n:
        return parts[0]
    return Moments(n, sum(m.mean * m.count for m in parts) / n, sum(m.square * m.count for m in parts) / n)


def _descend(gradient, width: int, steps: int, rate: float) -> np.ndarray:
    """Adam from zero; the last entry is the bias."""
    w, m, v = np.zeros(width), np.zeros(width), np.zeros(width)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (1 - t / (steps + 1)) * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def _separating(p: Moments, u: Moments, decay: float = 1e-2) -> np.ndarray:
    """Least squares of +1 for the one group and -1 for the other, each counting as much."""
    return np.linalg.solve((p.square + u.square) / 2 + decay * np.eye(WIDTH + 1), (p.mean - u.mean) / 2)


def _risk_gradient(p: Moments, u: Moments, prior: float, decay: float):
    """Gradient of the non-negative unbiased risk with squared loss, loss(f, y) = (1 - y f)^2 / 4.

    The risk is prior * E_p[loss(f, +)] + max(0, E_u[loss(f, -)] - prior * E_p[loss(f, -)]).
    Where the second part is below zero the step goes against it. With squared
    loss all three expectations are quadratic in the weights, so the groups'
    moments are all that is asked of their rows.
    """
    def gradient(w: np.ndarray) -> np.ndarray:
        square_p, square_u = p.square @ w, u.square @ w
        loss = lambda m, sq, y: (1 - 2 * y * (m.mean @ w) + w @ sq) / 4
        second = loss(u, square_u, -1) - prior * loss(p, square_p, -1)
        slope = (u.mean + square_u) / 2 - prior * (p.mean + square_p) / 2
        g = prior * (square_p - p.mean) / 2 + slope if second >= 0 else -slope
        g = g + decay * w
        g[-1] -= decay * w[-1]
        return g
    return gradient


def prior_from_counts(above_p: np.ndarray, above_u: np.ndarray) -> float:
    """The share of positives in unlabelled rows, from the shares of both that score at least so much.

    In any region the unlabelled rows hold at least the positives' share times
    the prior, so the least quotient over the regions {score >= t} estimates it.
    Regions with under half of the positives are left out, as their quotient is
    noisy.
    """
    use = above_p >= 0.5
    return float(np.clip((above_u[use] / above_p[use]).min() if use.any() else 0.5, 0.05, 0.99))


CUTS = 201


def _cuts(positive: np.ndarray) -> np.ndarray:
    """Scores at which regions begin: quantiles of the positives' scores, the upper half of them above the last."""
    return np.quantile(positive, np.linspace(0, 0.5, CUTS))


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """``prior_from_counts`` of scores at hand."""
    cuts = _cuts(positive)
    above = lambda x: 1 - np.searchsorted(np.sort(x), cuts) / len(x)
    return prior_from_counts(above(positive), above(unlabelled))


def held_out(id_col: str = "doc_id"):
    """Rows whose labels are never learned from."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


#: Sums are counted in 2^-20, as whole numbers, so that they do not depend on the order of tasks.
UNIT = float(1 << 20)


def _summed(rows: DataFrame, partial, size: int) -> np.ndarray:
    """One array of ``size`` numbers per task, added up by Spark; ``partial`` adds a batch's texts and halves to it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            if b.num_rows:
                partial(total, np.array([features(t) for t in b.column("text").to_pylist()]), b.column("half").to_numpy(zero_copy_only=False))
        whole = np.rint(total * UNIT).astype(np.int64)
        at = np.flatnonzero(whole)
        for k in range(0, len(at), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(at[k: k + 50_000]), pa.array(whole[at[k: k + 50_000]])], names=["k", "x"])

    # sums of whole numbers; as decimals beyond the range of a long
    sums = rows.mapInArrow(run, "k long, x long").groupBy("k").agg(F.sum(F.col("x").cast("decimal(38,0)")).cast("double").alias("x")).toArrow()
    out = np.zeros(size)
    out[sums.column("k").to_numpy()] = sums.column("x").to_numpy() / UNIT
    return out


UPPER = np.triu_indices(WIDTH + 1)


def _with_one(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.hstack((standardised(x, mean, scale), np.ones((len(x), 1))))


def _half(id_col: str):
    return F.pmod(F.xxhash64(F.col(id_col), F.lit(2)), F.lit(2)).cast("int").alias("half")


def trusted_rows(docs: DataFrame, labels: DataFrame, sample: int, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """At most ``sample`` documents (half, text) whose every label is 1: those least by a hash of the id, of an id's rows the one with the least text."""
    usable = F.col(id_col).isNotNull() & ~held_out(id_col)
    good = labels.filter(F.col(label_col).isNotNull() & usable).groupBy(id_col).agg(F.min(label_col).alias("worst")).filter("worst = 1")
    kept = good.select(id_col, F.xxhash64(F.col(id_col), F.lit(2)).alias("h")).orderBy("h", id_col).limit(sample).select(id_col)
    texts = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(kept), id_col)
    return texts.groupBy(id_col).agg(F.min("text").alias("text")).select(_half(id_col), "text")


def _as_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [features(t).tobytes() for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("half"), pa.array(rows, pa.binary())], names=["half", "x"])


def train(docs: DataFrame, labels: DataFrame, sample: int = 15_000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", steps: int = 1500, decay: float = 1e-3) -> PuModel:
    """A model from at most ``sample`` trusted positives and all unlabelled text.

    Positives are documents whose every label is 1, one row per id
    (``trusted_rows``); they are the only rows that are bounded, and the only
    ones that come to the driver, as features. Unlabelled text is every document,
    whatever its label, none of which is looked at. Rows that are held out serve
    as neither, nor do rows without an id; null labels teach nothing. A document
    that is there several times counts as often among the unlabelled.

    The unlabelled rows are asked three times, each answer a sum that Spark adds
    up: mean and deviation of the features, their products by halves of the ids,
    and how many score at least so much under the model that separates the other
    half's positives from its unlabelled rows. The last gives the class prior,
    the products the risk. Without positives or unlabelled rows every score is 1/2.
    """
    prepare(docs.sparkSession)
    nothing = PuModel(np.zeros(WIDTH), 0.0, np.zeros(WIDTH), np.ones(WIDTH), 0.5)
    good = trusted_rows(docs, labels, sample, id_col, text_col, label_col).mapInArrow(_as_features, "half int, x binary").collect()
    rows = docs.filter(F.col(id_col).isNotNull() & ~held_out(id_col)).select(_half(id_col), F.col(text_col).alias("text"))
    if not good:
        return nothing
    good.sort(key=lambda r: (r.half, bytes(r.x)))
    half_p, x = np.array([r.half for r in good]), np.frombuffer(b"".join(r.x for r in good), np.float32).reshape(len(good), WIDTH)

    def first(total: np.ndarray, x: np.ndarray, _) -> None:
        x = x.astype(np.float64)
        total[0] += len(x)
        total[1: WIDTH + 1] += x.sum(0)
        total[WIDTH + 1:] += (x * x).sum(0)

    sums = _summed(rows, first, 2 * WIDTH + 1)
    if not sums[0]:
        return nothing
    mean = sums[1: WIDTH + 1] / sums[0]
    scale = np.maximum(np.sqrt(np.maximum(sums[WIDTH + 1:] / sums[0] - mean * mean, 0)), 1e-3)

    width = len(UPPER[0])

    def second(total: np.ndarray, x: np.ndarray, half: np.ndarray) -> None:
        for k in (0, 1):
            z = _with_one(x[half == k], mean, scale)
            total[k * width: (k + 1) * width] += (z.T @ z)[UPPER]

    found = _summed(rows, second, 2 * width)
    unlabelled = []
    for k in (0, 1):
        square = np.zeros((WIDTH + 1, WIDTH + 1))
        square[UPPER] = found[k * width: (k + 1) * width]
        square = square + square.T - np.diag(np.diag(square))
        n = square[-1, -1]
        unlabelled.append(Moments(n, square[-1] / max(n, 1), square / max(n, 1)))
    p = np.concatenate([_with_one(x[k: k + 2000], mean, scale) for k in range(0, len(x), 2000)])
    positive = [_moments(p[half_p == k]) for k in (0, 1)]

    prior = 0.5
    if all(m.count for m in positive + unlabelled):
        # each half is scored by the other half's model
        models = [_separating(positive[1 - k], unlabelled[1 - k]) for k in (0, 1)]
        cuts = [_cuts(p[half_p == k] @ models[k]) for k in (0, 1)]

        def third(total: np.ndarray, x: np.ndarray, half: np.ndarray) -> None:
            for k in (0, 1):
                scores = np.sort(_with_one(x[half == k], mean, scale) @ models[k])
                total[k * CUTS: (k + 1) * CUTS] += len(scores) - np.searchsorted(scores, cuts[k])

        above = _summed(rows, third, 2 * CUTS)
        priors = []
        for k in (0, 1):
            mine = np.sort(p[half_p == k] @ models[k])
            priors.append(prior_from_counts(1 - np.searchsorted(mine, cuts[k]) / len(mine), above[k * CUTS: (k + 1) * CUTS] / unlabelled[k].count))
        prior = float(np.mean(priors))
    w = _descend(_risk_gradient(_together(positive), _together(unlabelled), prior, decay), WIDTH + 1, steps, 0.02)
    return PuModel(w[:-1], float(w[-1]), mean, scale, prior)


def score(docs: DataFrame, model: PuModel, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """One row per document: the kept columns and its score between 0 and 1.

    Only the text is looked at. Null and empty texts are scored by features of
    zero; long texts are read whole; equal texts get equal scores.
    """
    prepare(docs.sparkSession)
    rows = docs.select(*keep, F.col(text_col).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                s = model.scores(np.array([features(t) for t in b.column("_text").to_pylist()]))
                yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keep), pa.array(s)], names=[*keep, "score"])

    return rows.mapInArrow(run, f"{schema}, score double")
