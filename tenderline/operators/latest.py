"""Latest event per entity with ties kept.

The newest timestamps come from a map-side combined aggregate. The join back uses entity and
timestamp together, so the events of one very active entity spread over all partitions instead
of meeting in one window group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest(events: DataFrame, entity: str, at: str = "at", where=None) -> DataFrame:
    """All rows that carry the newest ``at`` of their entity, among the rows passing ``where``."""
    rows = events if where is None else events.where(where)
    newest = rows.groupBy(entity).agg(F.max(at).alias(at))
    return rows.join(newest, [entity, at])


def latest_typed(
    activity: DataFrame, entity: str, at: str = "at", typed: str = "state"
) -> DataFrame:
    """Latest typed rows per entity, flagged when nothing of another type came later.

    ``activity`` holds events of every type, ``typed`` is null on those of another type, unless
    ``is_typed`` tells the type and ``has_detail`` whether a typed event has its details: one
    without them counts for the newest time but is no result. One aggregate finds both maxima: a typed row at the typed maximum belongs to the overall latest
    events exactly when the two maxima are equal.
    """
    told = "is_typed" in activity.columns
    is_typed = F.col("is_typed") if told else F.col(typed).isNotNull()
    newest = activity.groupBy(entity).agg(
        F.max(F.when(is_typed, F.col(at))).alias(at), F.max(at).alias("newest_of_any")
    )
    return (
        activity.where(is_typed & F.col("has_detail") if told else is_typed)
        .join(newest, [entity, at])
        .withColumn("is_newest", F.col(at) == F.col("newest_of_any"))
        .drop("newest_of_any", "is_typed", "has_detail")
    )
