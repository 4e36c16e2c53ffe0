"""Compare a period with earlier ones.

Instead of joining the aggregate to itself once per comparison, every base row
is emitted into each later period it is compared in (itself, one quarter on,
four on) and one grouped sum collects them: one shuffle, with map-side combine,
no join to skew. Combinations present in only one of the periods come out too,
so the result equals calendar x dimensions LEFT JOIN current, previous and
year-ago, with the empty rows removed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import fiscal
from tidemark.functions.numbers import all_zero

QUARTERS_BACK = {"qoq": 1, "yoy": 4}


def _shifted(df: DataFrame, index: str, shifts: dict[str, int]) -> DataFrame:
    lags = F.array(F.lit(0), *[F.lit(s) for s in shifts.values()])
    return df.withColumn("_lag", F.explode(lags)).withColumn(index, F.col(index) + F.col("_lag"))


def _collected(shifted: DataFrame, keys: Sequence[str], measures: Sequence[str],
               shifts: dict[str, int], current: Column | None = None) -> DataFrame:
    here = F.col("_lag") == 0
    sums = [F.sum(F.when(here, F.col(m))).alias(m) for m in measures]
    for name, lag in shifts.items():
        sums += [F.sum(F.when(F.col("_lag") == lag, F.col(m))).alias(f"{name}_{m}") for m in measures]
    return shifted.groupBy(*keys).agg(F.max(here.cast("int")).alias("_has_current"), *sums)


def weeks_in_quarter(index: str | Column, as_of) -> Column:
    """Weeks the calendar lists: all of a past quarter, the finished ones of this."""
    index = F.col(index) if isinstance(index, str) else index
    this = fiscal.quarter_index(fiscal.as_date(as_of))
    begin = fiscal.begin_of_index(index)
    length = F.datediff(F.add_months(begin, 3), begin)
    elapsed = F.datediff(fiscal.as_date(as_of), begin)
    return F.when(index == this, F.floor(elapsed / 7)).otherwise(F.ceil(length / 7)).cast("int")


def weekly_comparison(base: DataFrame, index: str, week: str, dims: Sequence[str], measures: Sequence[str],
                      as_of, shifts: dict[str, int] | None = None) -> DataFrame:
    """Same week of the previous and the year-ago quarter beside each week.

    ``base`` is aggregated by (index, week, dims). Rows without any non-zero
    measure are removed.
    """
    shifts = shifts or QUARTERS_BACK
    this = fiscal.quarter_index(fiscal.as_date(as_of))
    merged = _collected(_shifted(base, index, shifts), [index, week, *dims], measures, shifts)
    names = [*measures, *[f"{s}_{m}" for s in shifts for m in measures]]
    return (
        merged.filter((F.col(index) <= this) & (F.col(week) <= weeks_in_quarter(index, as_of)))
        .filter(~all_zero(*names))
        .drop("_has_current")
    )


def quarterly_comparison(base: DataFrame, index: str, week: str, dims: Sequence[str], measures: Sequence[str],
                         as_of, last_week: Column, densified: bool = True,
                         shifts: dict[str, int] | None = None) -> DataFrame:
    """Quarter totals with the earlier quarters beside them.

    Closed quarters compare with whole quarters; the current one compares with
    the same weeks (up to ``last_week``) of the earlier quarters. With
    ``densified`` a combination only an earlier quarter has is kept (its
    current measures NULL); otherwise only combinations of the quarter itself.
    """
    shifts = shifts or QUARTERS_BACK
    this = fiscal.quarter_index(fiscal.as_date(as_of))
    shifted = _shifted(base, index, shifts).filter(F.col(index) <= this)
    comparable = (F.col("_lag") == 0) | (F.col(index) < this) | (F.col(week) <= last_week)
    merged = _collected(shifted.filter(comparable), [index, *dims], measures, shifts)
    names = [*measures, *[f"{s}_{m}" for s in shifts for m in measures]]
    merged = merged.filter(~all_zero(*names)) if densified else merged.filter(F.col("_has_current") == 1)
    return merged.drop("_has_current")


def monthly_to_date(base: DataFrame, index: str, month: str, week: str, dims: Sequence[str], measures: Sequence[str],
                    as_of, last_week: Column, shifts: dict[str, int] | None = None) -> DataFrame:
    """Month totals, those of the current quarter beside the same month of earlier quarters so far.

    ``base`` is aggregated by (index, month, week, dims); ``month`` is its first
    day. An earlier quarter's weeks count up to ``last_week``, the last one that
    the current quarter has; months of past quarters have no comparison. Rows
    without any non-zero measure are removed.
    """
    shifts = shifts or QUARTERS_BACK
    this = fiscal.quarter_index(fiscal.as_date(as_of))
    target = lambda lag: F.struct(F.lit(lag).alias("lag"), (F.col(index) + lag).alias("index"), F.add_months(month, 3 * lag).alias("month"))
    later = [F.when((F.col(index) + lag == this) & (F.col(week) <= last_week), target(lag)) for lag in shifts.values()]
    shown = base.filter(F.col(index) <= this).withColumn("_to", F.explode(F.array_compact(F.array(target(0), *later))))
    shown = shown.withColumns({"_lag": F.col("_to.lag"), index: F.col("_to.index"), month: F.col("_to.month")}).filter(F.col(month) <= fiscal.as_date(as_of))
    merged = _collected(shown, [index, month, *dims], measures, shifts)
    return merged.filter(~all_zero(*measures, *[f"{s}_{m}" for s in shifts for m in measures])).drop("_has_current")


def cell_comparison(cells: DataFrame, index: str, keys: Sequence[str], measures: Sequence[str],
                    as_of, to_date: Sequence[str] | None = None, fallback: bool = False,
                    shifts: dict[str, int] | None = None) -> DataFrame:
    """The same for finished cells (cube cells, distinct counts).

    ``to_date`` names, per measure, the column with its value for the weeks
    the current quarter has completed; it stands in when the comparison is made
    from the current quarter. With ``fallback`` a missing earlier value is
    replaced by the current one. Only cells of the quarter itself are kept.
    """
    shifts = shifts or QUARTERS_BACK
    this = fiscal.quarter_index(fiscal.as_date(as_of))
    shifted = _shifted(cells, index, shifts).filter(F.col(index) <= this)
    if to_date:
        from_current = (F.col(index) == this) & (F.col("_lag") > 0)
        shifted = shifted.withColumns(
            {m: F.when(from_current, F.nullif(F.col(t), F.lit(0))).otherwise(F.col(m)) for m, t in zip(measures, to_date)})
    merged = _collected(shifted, [index, *keys], measures, shifts).filter(F.col("_has_current") == 1)
    if fallback:
        merged = merged.withColumns(
            {f"{s}_{m}": F.coalesce(f"{s}_{m}", m) for s in shifts for m in measures})
    return merged.drop("_has_current")


def year_ratio(df: DataFrame, key: str, year: str, value: str, name: str) -> DataFrame:
    """Value as a percentage of the last earlier non-NULL year, 0 for the first.

    ``df`` holds one row per (key, year).
    """
    earlier = F.expr(f"lag({value}, 1, 0) ignore nulls over (partition by {key} order by {year})")
    ranked = df.withColumn("_earlier", earlier)
    quotient = F.col(value).cast("double") / F.nullif(F.col("_earlier").cast("double"), F.lit(0.0))
    return ranked.withColumn(
        name, F.when(F.col("_earlier") == 0, F.lit(0.0)).otherwise(quotient * 100)).drop("_earlier")


def ranked_quarters(labels: DataFrame, label: str, positions: Sequence[int] = (1, 2, 5)) -> DataFrame:
    """The newest quarter, the one before and the year-ago one, by position.

    The quarters are distinct before they are ranked, so the single-partition
    window holds a handful of rows.
    """
    newest = labels.select(label).distinct().orderBy(F.col(label).desc()).limit(max(positions))
    return (
        newest.withColumn("position", F.row_number().over(Window.orderBy(F.col(label).desc())))
        .filter(F.col("position").isin(list(positions)))
    )
