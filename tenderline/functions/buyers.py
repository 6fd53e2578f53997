"""Which customers a report covers, and whether it is split by customer."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderline.operators.joins import semi


@dataclass(frozen=True)
class Buyers:
    """Id lists are tuples or frames of one column; a frame may have any length."""

    excluded: tuple[int, ...] | DataFrame = ()
    only: tuple[int, ...] | DataFrame | None = None
    split: bool = False

    def keep(self, df: DataFrame, column: str = "customer_id") -> DataFrame:
        """Rows of the covered customers; a missing id never passes an id list."""
        if isinstance(self.excluded, DataFrame) or self.excluded:
            df = drop_ids(df, column, self.excluded)
        if self.only is not None:
            df = keep_ids(df, column, self.only)
        return df

    @property
    def keys(self) -> list[str]:
        return ["customer_id"] if self.split else []


def _ids(df: DataFrame, column: str, ids: Iterable[int] | DataFrame) -> DataFrame:
    """The ids as a frame whose size Spark knows: a list becomes a local relation."""
    if isinstance(ids, DataFrame):
        return ids.toDF(column)
    return df.sparkSession.createDataFrame(pa.table({column: pa.array(sorted({int(i) for i in ids}), pa.int64())}))


def drop_ids(df: DataFrame, column: str, ids: Iterable[int] | DataFrame) -> DataFrame:
    """Rows whose id is not among ``ids`` (a list or a frame of one column), whatever their number; a missing id goes."""
    return df.where(F.col(column).isNotNull()).join(_ids(df, column, ids), column, "left_anti")


def keep_ids(df: DataFrame, column: str, ids: Iterable[int] | DataFrame) -> DataFrame:
    """Rows whose id is among ``ids``."""
    return semi(df, _ids(df, column, ids), column)


def not_in(value: Column, listed: Iterable) -> Column:
    """NOT IN with its null rule: a missing value does not pass, except through an empty list."""
    listed = list(listed)
    return ~value.isin(listed) if listed else F.lit(True)
