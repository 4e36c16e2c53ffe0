"""Numbers that arrive as text, ratios, bands, money."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def whole_number(value) -> Column:
    """'1,234.5' to 1235; NULL for text that is no number."""
    return F.replace(_col(value), F.lit(","), F.lit("")).try_cast("decimal(38,0)")


def percent(value) -> Column:
    """'40%' to 40 as a whole number."""
    return F.replace(_col(value), F.lit("%"), F.lit("")).try_cast("decimal(38,0)")


def ratio(top, bottom, digits: int = 4, null_on_zero: bool = True) -> Column:
    """``top/bottom`` rounded; a zero divisor gives NULL, or 0 when asked."""
    top, bottom = _col(top).cast("double"), _col(bottom).cast("double")
    quotient = F.round(top / F.nullif(bottom, F.lit(0.0)), digits)
    if null_on_zero:
        return quotient
    return F.when(bottom == 0, F.lit(0.0)).otherwise(quotient)


def nvl_sum(*parts) -> Column:
    """Row-wise sum with NULL parts as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(_col(p), F.lit(0)) for p in parts])


def all_zero(*parts) -> Column:
    """True where every measure is NULL or 0: such rows carry nothing."""
    return reduce(lambda a, b: a & b, [F.coalesce(_col(p), F.lit(0)) == 0 for p in parts])


def capped(value, limit) -> Column:
    return F.least(_col(value), _col(limit))


def band(value, steps: Sequence[tuple[float, str]], above: str, missing: str,
         sentinel: float | None = None, sentinel_label: str | None = None) -> Column:
    """Label of the first step whose upper bound (inclusive) holds the value."""
    value = _col(value)
    result = F.when(value.isNull(), missing)
    if sentinel is not None:
        result = result.when(value == sentinel, sentinel_label)
    for upper, label in steps:
        result = result.when(value <= upper, label)
    return result.otherwise(above)


def in_base_currency(amount, rate) -> Column:
    """Divide by the rate; a missing rate counts as 1."""
    return _col(amount) / F.coalesce(_col(rate), F.lit(1))


def annualised(amount, term) -> Column:
    """Scale a price to a year by its billing-term code."""
    # Factor per term code.
    factors = {"A07": 365.0, "A02": 12.0, "A01": 1.0, "A06": 1.0 / 3.0}
    term = _col(term)
    factor = reduce(
        lambda chain, item: chain.when(term == item[0], item[1]),
        list(factors.items())[1:],
        F.when(term == "A07", factors["A07"]),
    ).otherwise(1.0)
    return _col(amount) * factor


def split_share(value, percent_value) -> Column:
    """A campaign's share of a metric that covers several campaigns."""
    return F.coalesce(_col(value), F.lit(0)) * (_col(percent_value) / 100)
