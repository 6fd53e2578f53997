"""Status buckets in one conditional aggregation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bucket_hits(latest_rows: DataFrame, ident: str, buckets: Mapping[str, Column]) -> DataFrame:
    """Per id, how many of its latest rows fall into each bucket (ties count)."""
    return latest_rows.groupBy(ident).agg(
        *[F.sum(test.cast("int")).alias(f"{name}_hits") for name, test in buckets.items()]
    )


def bucket_measures(buckets: Iterable[str], amount: str) -> list[Column]:
    """Aggregates over facts with one row per id: distinct ids, tied rows and amount per bucket.

    Amounts count once per tied row. Missing hits (an id without events) count as none.
    """
    measures = []
    for name in buckets:
        hits = F.coalesce(F.col(f"{name}_hits"), F.lit(0))
        measures += [
            F.sum((hits > 0).cast("int")).alias(f"{name}_orders"),
            F.sum(hits).alias(f"{name}_rows"),
            F.sum(F.when(hits > 0, F.col(amount) * hits)).alias(f"{name}_amount"),
        ]
    return measures


def bucket_counts(facts: DataFrame, keys: Sequence[str], buckets: Iterable[str], amount: str = "amount") -> DataFrame:
    return facts.groupBy(*keys).agg(*bucket_measures(buckets, amount))
