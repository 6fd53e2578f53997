"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The smallest row per key by ``by`` (missing values first), then by all other columns.

    A minimum over a struct is combined on the map side, so a key reaches its task with one row
    from each map task. Rows are sorted by key on both sides of the exchange (a minimum over a
    struct cannot be hash-aggregated), but a key's rows are never gathered.
    """
    rest = [c for c in df.columns if c not in keys and c not in by]
    ranked = F.struct(*[F.col(c) for c in [*by, *rest] if c not in keys])
    best = df.groupBy(*keys).agg(F.min(ranked).alias("best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"best.{c}") for c in df.columns])
