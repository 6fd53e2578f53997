"""Join shapes that need care: existence, null-safe keys, either-of-two keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def semi(df: DataFrame, other: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key exists in ``other``; multiplicities of ``df`` stay."""
    keys = [on] if isinstance(on, str) else list(on)
    return df.join(other.select(*keys), keys, "left_semi")


def null_safe_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    null_safe: Sequence[str] = (),
    how: str = "inner",
) -> DataFrame:
    """Equi-join where a missing value in a ``null_safe`` column matches a missing value.

    The right side must not share other column names with the left.
    """
    renamed = right.withColumnsRenamed({k: f"{k}__r" for k in [*keys, *null_safe]})
    tests = [left[k] == renamed[f"{k}__r"] for k in keys]
    tests += [left[k].eqNullSafe(renamed[f"{k}__r"]) for k in null_safe]
    joined = left.join(renamed, reduce(lambda a, b: a & b, tests), how)
    return joined.drop(*[f"{k}__r" for k in [*keys, *null_safe]])


def left_join_spread(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join whose rows without a key are dealt over all tasks instead of meeting in one.

    A hash of the whole row is a second join column where the key is missing, zero elsewhere; the right side has zero
    everywhere, written so that the optimizer can't fold it into a constant and take the column out of the
    hash. One scan of each side, and no row moves that a plain join would not move.
    """
    spread = F.when(F.col(key).isNull(), F.xxhash64(*left.columns)).otherwise(F.lit(0))
    one = left.withColumn("spread__", spread)
    two = right.withColumn("spread__", F.pmod(F.xxhash64(key), F.lit(1)))
    return one.join(two, [key, "spread__"], "left").drop("spread__")


def either_key_join(
    left: DataFrame,
    right: DataFrame,
    first: tuple[str, str],
    second: tuple[str, str],
    how: str = "inner",
) -> DataFrame:
    """``left.a = right.a OR left.b = right.b`` as two hash joins that cannot match twice.

    The second join leaves out the pairs the first one has; with ``how='left'`` the rows that
    matched neither key follow with nulls. Column names of the two sides must differ.
    """
    (left_a, right_a), (left_b, right_b) = first, second
    same_a = F.col(left_a) == F.col(right_a)
    same_b = F.col(left_b) == F.col(right_b)
    matched = left.join(right, same_a).unionByName(
        left.join(right, same_b & ~F.coalesce(same_a, F.lit(False)))
    )
    if how == "inner":
        return matched
    if how != "left":
        raise ValueError(f"unsupported join type {how!r}")
    alone = left.join(right.select(right_a), same_a, "left_anti").join(
        right.select(right_b), same_b, "left_anti"
    )
    return matched.unionByName(alone, allowMissingColumns=True)
