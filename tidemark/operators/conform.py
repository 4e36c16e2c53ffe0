"""Projection of a source onto a declared target schema."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Target:
    """One column of a declared target.

    ``source`` names the input column when it differs; ``default`` fills a
    column the source lacks (NULL when not given). With ``agg`` the column is
    a measure, otherwise a dimension. ``shape`` is applied after the cast.
    """

    type: str
    source: str | None = None
    default: Any = None
    agg: str | None = None
    shape: Callable[[Column], Column] | None = None


def _by_lower_name(df: DataFrame) -> dict[str, str]:
    return {c.lower(): c for c in df.columns}


def _projected(df: DataFrame, name: str, target: Target, shaped: bool = True) -> Column:
    found = _by_lower_name(df).get((target.source or name).lower())
    column = F.col(f"`{found}`") if found is not None else F.lit(target.default)
    column = column.cast(target.type)
    return target.shape(column) if target.shape is not None and shaped else column


def conform(df: DataFrame, spec: dict[str, Target]) -> DataFrame:
    """Cast, rename and default the columns of ``df`` to ``spec``, in its order.

    Columns are matched case-insensitively, so the header of a landed file may
    be spelled in any case.
    """
    return df.select(*[_projected(df, n, t).alias(n) for n, t in spec.items()])


def conform_agg(df: DataFrame, spec: dict[str, Target], where: Column | str | None = None) -> DataFrame:
    """``conform`` and aggregate: dimensions grouped, measures ``agg``-ed."""
    if where is not None:
        df = df.filter(where)
    dims = {n: t for n, t in spec.items() if t.agg is None}
    measures = {n: t for n, t in spec.items() if t.agg is not None}
    shaped = df.select(
        *[_projected(df, n, t).alias(n) for n, t in dims.items()],
        *[_projected(df, n, t, shaped=False).alias(n) for n, t in measures.items()],
    )
    aggregated = [
        (t.shape or (lambda c: c))(getattr(F, t.agg)(F.col(n))).alias(n) for n, t in measures.items()
    ]
    return shaped.groupBy(*dims).agg(*aggregated).select(*spec)


def columns_except(df: DataFrame, skip: Sequence[str], rename: dict[str, str] | None = None) -> DataFrame:
    """All columns but ``skip`` (any case), some renamed."""
    dropped = {s.lower() for s in skip}
    new_name = {k.lower(): v for k, v in (rename or {}).items()}
    kept = [c for c in df.columns if c.lower() not in dropped]
    return df.select(*[F.col(f"`{c}`").alias(new_name.get(c.lower(), c)) for c in kept])


def union_relations(*frames: DataFrame) -> DataFrame:
    """UNION ALL by name; a column some frames lack is NULL there."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def union_distinct(*frames: DataFrame) -> DataFrame:
    """UNION: identical rows appear once."""
    return union_relations(*frames).distinct()


def minus(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` not in ``right``, each once."""
    return left.subtract(right.select(*left.columns))
