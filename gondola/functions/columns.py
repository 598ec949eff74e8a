"""Small column helpers used by several operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def contains_text(column: str, text: str) -> Column:
    """Case-insensitive substring match; ``%`` and ``_`` in the text stay wildcards.

    A backslash is an ordinary character for the caller, while Spark's LIKE uses it as the escape
    character, so it is doubled.
    """
    return F.col(column).ilike("%" + text.strip().replace("\\", "\\\\") + "%")


def filled(column: str) -> Column:
    """Neither NULL nor the empty string (the rule of every facet list)."""
    return F.col(column).isNotNull() & (F.col(column) != "")


def mean(total: str | Column, count: str | Column) -> Column:
    """Average from an already aggregated sum and count; NULL when nothing was counted."""
    return F.try_divide(total, count)


def percent_change(new: Column, old: Column) -> Column:
    """Change in percent, defined for a positive base only."""
    return F.when(old > 0, (new - old) / old * 100)


def nulls_last(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def first_rows(frame: DataFrame, limit: int | None) -> DataFrame:
    """All rows, or the first ``limit`` of an ordered frame."""
    return frame if limit is None else frame.limit(limit)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which NULL keys meet each other; the key columns come from the left side."""
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    condition = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"__{k}"]) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"__{k}" for k in keys])
