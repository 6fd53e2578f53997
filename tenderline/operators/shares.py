"""Shares of totals at coarser grains."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderline.functions.numbers import percent
from tenderline.operators.joins import null_safe_join


def read_whole(df: DataFrame) -> DataFrame:
    """The same rows, computed once for all consumers of one query.

    Column pruning and filters of a consumer would otherwise move below this point and give two
    consumers of one aggregate two slightly different plans, each with its own scan and shuffle.
    The test holds for every row, reads all columns and is not deterministic, so neither moves
    past it: the plans below stay equal and the second one becomes a reused exchange.
    """
    return df.where(F.rand() + F.lit(2) > F.signum(F.xxhash64(*df.columns)))


def with_grand_total(totals: DataFrame, total: str, name: str) -> DataFrame:
    """Add the sum of all totals as ``name``, read as a scalar."""
    return totals.withColumn(name, totals.agg(F.sum(total)).scalar())


def share(
    df: DataFrame,
    value: str,
    within: Mapping[str, Sequence[str]],
    null_safe: Sequence[str] = (),
) -> DataFrame:
    """Add ``<name>_total`` and ``<name>_pct`` per entry of ``within`` (name -> coarser keys).

    ``df`` is aggregated already, so the totals are sums of few rows and join back on their
    keys; no window gathers the rows of one key. An empty key list is the grand total, read as
    a scalar.
    """
    whole = read_whole(df)
    shared = whole
    for name, keys in within.items():
        total = f"{name}_total"
        if keys:
            shared = join_totals(shared, whole.groupBy(*keys).agg(F.sum(value).alias(total)), keys, null_safe)
        else:
            shared = shared.withColumn(total, whole.agg(F.sum(value)).scalar())
    return with_percents(shared, value, within)


def join_totals(df: DataFrame, totals: DataFrame, keys: Sequence[str], null_safe: Sequence[str]) -> DataFrame:
    return null_safe_join(df, totals, [k for k in keys if k not in null_safe], [k for k in keys if k in null_safe])


def with_percents(df: DataFrame, value: str, names: Iterable[str]) -> DataFrame:
    return df.withColumns({f"{name}_pct": percent(F.col(value), F.col(f"{name}_total")) for name in names})
