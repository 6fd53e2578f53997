"""Trailing weekly windows as columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderline.functions.dates import trailing_weeks
from tenderline.operators.joins import null_safe_join


def week_numbers(at: Column, as_of: date, weeks: int) -> Column:
    """The windows an instant falls into, 1 for the oldest: one, or two at the midnight between neighbours."""
    days = F.datediff(at, F.lit(trailing_weeks(as_of, weeks)[0][0]))
    own = F.floor(days / 7) + 1
    border = (days % 7 == 0) & (at == F.date_trunc("day", at))
    inside = lambda n: F.when((n >= 1) & (n <= weeks), n)
    return F.array_compact(F.array(inside(own), F.when(border, inside(own - 1))))


def weekly_matrix(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    as_of: date,
    counts: Sequence[str] = (),
    sums: Mapping[str, Column] | None = None,
    weeks: int = 4,
    all_keys: DataFrame | None = None,
) -> DataFrame:
    """``<count>_w1..`` and ``<sum>_w1..`` per key, oldest week first.

    Both ends of a window are inclusive, so a midnight on the border counts in two windows.
    A count without rows is 0, a sum without rows is null. Rows outside all windows are dropped by
    bounds that reach the scan; ``all_keys`` names the keys that are shown (default: those of ``df``),
    so ``df`` may hold the rows of the windows alone.
    """
    sums = sums or {}
    windows = trailing_weeks(as_of, weeks)
    shown = df.select(*keys).distinct() if all_keys is None else all_keys.select(*keys).distinct()
    inside = df.where((F.col(at) >= F.lit(windows[0][0])) & (F.col(at) <= F.lit(windows[-1][1])))
    per_week = (
        inside.select(
            *keys,
            *[value.alias(name) for name, value in sums.items()],
            F.explode(week_numbers(F.col(at), as_of, weeks)).alias("week__"),
        )
        .groupBy(*keys, "week__")
        .agg(F.count(F.lit(1)).alias("n__"), *[F.sum(name).alias(name) for name in sums])
    )
    of = lambda i, name: F.max(F.when(F.col("week__") == i, F.col(name)))
    numbers = range(1, weeks + 1)
    wide = per_week.groupBy(*keys).agg(
        *[of(i, "n__").alias(f"{name}_w{i}") for name in counts for i in numbers],
        *[of(i, name).alias(f"{name}_w{i}") for name in sums for i in numbers],
    )
    quiet = {f"{name}_w{i}": F.coalesce(f"{name}_w{i}", F.lit(0)) for name in counts for i in numbers}
    return null_safe_join(shown, wide, [], keys, "left").withColumns(quiet)
