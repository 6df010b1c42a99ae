"""Small building blocks for work that stays inside one row.

A document is one row, so everything that looks at a single document (lines,
paragraphs, runs of words, its word graph) can be written with array functions
and needs no shuffle at all.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``.

    Written as a one-element ``transform``, because the optimizer may copy a
    projected expression into a lambda, where it would run once per element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def positions(arr: Column) -> Column:
    """Zero-based positions of an array; empty for an empty array."""
    return F.when(F.size(arr) > 0, F.sequence(F.lit(0), F.size(arr) - 1)).otherwise(
        F.array().cast("array<int>")
    )


def group_starts(arr: Column, same: Callable[[Column, Column], Column]) -> Column:
    """Positions at which a new group begins in an array sorted by group."""
    return F.filter(
        positions(arr),
        lambda i: (i == 0) | ~same(F.get(arr, i), F.get(arr, i - 1)),
    )


def per_group(
    starts: Column, total: Column, body: Callable[[Column, Column, Column], Column]
) -> Column:
    """Map every group to ``body(start, length, group number)``."""
    return let(
        starts,
        lambda bound: F.transform(
            bound,
            lambda s, k: body(s, F.coalesce(F.get(bound, k + 1), total) - s, k),
        ),
    )


def long_sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0).cast("long"), lambda acc, x: acc + x)
