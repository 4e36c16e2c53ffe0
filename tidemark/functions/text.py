"""Text clean-up: sentinels, ids, classification, patterns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def null_if_any(value, sentinels: Iterable[str], ignore_case: bool = False) -> Column:
    """NULL where the text is one of the sentinels ('*', 'UNKNOWN', 'N/A', '')."""
    value = _col(value)
    probe = F.upper(value) if ignore_case else value
    words = [s.upper() if ignore_case else s for s in sentinels]
    return F.when(~probe.isin(words), value)


def padded_id(value, width: int = 10) -> Column:
    """'1234.0' and ' 1234' to '0000001234'."""
    cleaned = F.trim(F.replace(_col(value).cast("string"), F.lit(".0"), F.lit("")))
    return F.lpad(cleaned, width, "0")


def join_key(value) -> Column:
    """Case- and blank-insensitive form of a join key."""
    return F.lower(F.trim(_col(value)))


def cut_suffix(value, mark: str = "-") -> Column:
    """Everything before the first mark; the whole text when there is none."""
    return F.substring_index(_col(value), mark, 1)


def before_space(value) -> Column:
    """Text before the first blank ('' when there is none, as LOCATE gives 0)."""
    value = _col(value)
    return F.substring(value, F.lit(1), F.greatest(F.locate(" ", value) - 1, F.lit(0)))


def parent_name(value, mark: str = "_") -> Column:
    """'A_B_C_D' to 'A_B': the part before the second mark."""
    return F.substring_index(_col(value), mark, 2)


def keyword_class(value, rules: Sequence[tuple[str, str]], default: str | None = None) -> Column:
    """Label of the first rule whose (case-blind) LIKE pattern matches."""
    value = _col(value)
    result = None
    for pattern, label in rules:
        hit = value.ilike(pattern)
        result = F.when(hit, F.lit(label)) if result is None else result.when(hit, F.lit(label))
    return result.otherwise(F.lit(default)) if result is not None else F.lit(default)


def coded(value, mapping: dict[str, str], default: str | None = None) -> Column:
    """CASE map of a coded value."""
    value = _col(value)
    result = None
    for code, label in mapping.items():
        hit = value == code
        result = F.when(hit, F.lit(label)) if result is None else result.when(hit, F.lit(label))
    return result.otherwise(F.lit(default))


def like_any(value, patterns: Sequence[str], ignore_case: bool = False) -> Column:
    value = _col(value)
    hits = [value.ilike(p) if ignore_case else value.like(p) for p in patterns]
    result = hits[0]
    for hit in hits[1:]:
        result = result | hit
    return result


def matches_whole(value, pattern: str) -> Column:
    """Whole-string regular-expression match."""
    return _col(value).rlike(f"^(?:{pattern})$")


def digits(value) -> Column:
    """Only the digits, with everything else as single blanks trimmed away."""
    return F.trim(F.regexp_replace(_col(value), "[^0-9]", " "))


def tactic_key(value) -> Column:
    """Ten-digit task ids give their first seven digits; 6 or 7 digits stay."""
    value = _col(value)
    return (
        F.when(matches_whole(value, "[0-9]{10}"), F.substring(value, 1, 7))
        .when(matches_whole(value, "[0-9]{6,7}"), value)
    )


def strict_concat(*parts) -> Column:
    """Concatenation that is NULL when any part is (unlike ``concat_ws``)."""
    return F.concat(*[_col(p).cast("string") for p in parts])


def not_null_label(columns: Sequence[str]) -> Column:
    """Names the non-NULL columns of a row: 'a, b Not Null' or the two ends."""
    named = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.lit(c)) for c in columns]))
    return (
        F.when(F.size(named) == len(columns), "ALL_NOT_NULL")
        .when(F.size(named) == 0, "ALL_NULL")
        .otherwise(F.concat(F.array_join(named, ", "), F.lit(" Not Null")))
    )
