"""Grouping operators: shared keys, joined texts, cycle lengths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderline.functions.dates import seconds_between


def members_of_groups(df: DataFrame, key: str, ident: str, low: int, high: int) -> DataFrame:
    """Rows whose key is shared by ``low`` to ``high`` distinct ids, with that number."""
    sizes = (
        df.groupBy(key)
        .agg(F.countDistinct(ident).alias("group_size"))
        .where(F.col("group_size").between(low, high))
    )
    return df.join(sizes, key)


def concat_sorted(value: Column, separator: str = " / ") -> Column:
    """Aggregate: the distinct values sorted, joined; null when there is none."""
    values = F.array_sort(F.collect_set(value))
    return F.when(F.size(values) > 0, F.array_join(values, separator))


def concat_repeated(df: DataFrame, keys: Sequence[str], value: str, times: str, separator: str = " / ") -> DataFrame:
    """Like a plain text aggregate over rows that occur ``times`` times, sorted.

    Equal values are counted first, so the buffer of a group holds each distinct value once.
    """
    counted = df.groupBy(*keys, value).agg(F.sum(times).cast("int").alias("times"))
    run = F.array_join(F.array_repeat(F.col(value), F.col("times")), separator)
    entries = F.array_sort(
        F.collect_list(F.when(F.col(value).isNotNull(), F.struct(F.col(value).alias("v"), run.alias("run"))))
    )
    texts = F.transform(entries, lambda e: e["run"])
    return counted.groupBy(*keys).agg(
        F.when(F.size(texts) > 0, F.array_join(texts, separator)).alias(value)
    )


def cycle_seconds(
    df: DataFrame, keys: Sequence[str], at: str, ident: str, min_count: int = 2
) -> DataFrame:
    """Mean time between occurrences: (last - first) / distinct ids, for groups large enough."""
    return (
        df.groupBy(*keys)
        .agg(
            F.min(at).alias("first_at"),
            F.max(at).alias("last_at"),
            F.countDistinct(ident).alias("occurrences"),
        )
        .where(F.col("occurrences") >= min_count)
        .withColumn("cycle_seconds", seconds_between(F.col("first_at"), F.col("last_at")) / F.col("occurrences"))
    )
