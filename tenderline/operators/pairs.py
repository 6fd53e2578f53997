"""Event pairs per entity without building them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _first_two_days(events: DataFrame, entity: str, at: str, prefix: str) -> DataFrame:
    """Earliest moment on the first and on the second day with events, each with its multiplicity."""
    per_moment = events.groupBy(entity, at).agg(F.count(F.lit(1)).alias("n"))
    per_day = per_moment.groupBy(entity, F.to_date(at).alias("day")).agg(
        F.min(F.struct(F.col(at).alias("at"), "n")).alias("m"), F.sum("n").alias("n_day")
    )
    # At most one row per calendar day reaches the window, and the rank limit prunes before the shuffle.
    by_day = Window.partitionBy(entity).orderBy("day")
    two = per_day.withColumn("k", F.row_number().over(by_day)).where(F.col("k") <= 2)
    return two.groupBy(entity).agg(
        *[
            F.max(F.when(F.col("k") == k, F.col(f"m.{field}"))).alias(f"{prefix}{k}_{field}")
            for k in (1, 2)
            for field in ("at", "n")
        ]
    )


def _chosen(gap: str) -> Column:
    """The earliest pair off the agreed gap, from the first two days of each side (columns s1_at .. e2_n)."""

    def off(start: Column, end: Column) -> Column:
        return F.datediff(end, start) != F.col(gap)

    def pair(a: int, b: int) -> Column:
        return F.struct(
            F.col(f"s{a}_at").alias("start_at"),
            F.col(f"e{b}_at").alias("end_at"),
            F.datediff(F.col(f"e{b}_at"), F.col(f"s{a}_at")).alias("gap_days"),
            (F.col(f"s{a}_n") * F.col(f"e{b}_n")).alias("weight"),
        )

    return F.coalesce(
        *[F.when(off(F.col(f"s{a}_at"), F.col(f"e{b}_at")), pair(a, b)) for a, b in ((1, 1), (1, 2), (2, 1))]
    )


def first_pair_off_gap(starts: DataFrame, ends: DataFrame, gaps: DataFrame, entity: str, gap: str, at: str = "at") -> DataFrame:
    """Earliest (start, end) pair per entity whose distance in days is not the agreed gap.

    Earliest means smallest start, then smallest end. ``gaps`` holds the agreed days per entity;
    entities without a value, or whose pairs all keep to it, are dropped. Only the first two days
    of each side can decide: the first start pairs with the first end, or with the first end of a
    later day; when every end lies on the agreed day, the first start of a later day decides.
    ``weight`` is the number of pairs at exactly these two moments.
    """
    s = _first_two_days(starts, entity, at, "s")
    e = _first_two_days(ends, entity, at, "e")
    return (
        gaps.join(s, entity)
        .join(e, entity)
        .select(entity, gap, _chosen(gap).alias("pair"))
        .where(F.col("pair").isNotNull())
        .select(entity, gap, "pair.*")
    )


def first_pair_and_latest(
    events: DataFrame, keys: Sequence[str], gap: str, starts: Column, ends: Column, detail: Column, at: str = "at"
) -> DataFrame:
    """``first_pair_off_gap`` and the newest events, from one pass over one frame of events.

    ``events`` carries the entity (first of ``keys``) and what depends on it. An event is a start, an end, both or neither,
    and always a candidate for the newest; each role is a side with a rank by day, from the first day on or from the last
    day back, and two days of a side are enough. ``newest`` holds ``detail`` of all events at the newest moment.
    """
    day = F.datediff(F.col(at), F.lit("1970-01-01"))
    roles = ((F.lit("s"), starts, day), (F.lit("e"), ends, day), (F.lit("l"), F.lit(True), -day))
    sides = F.array_compact(F.array(*[F.when(test, F.struct(s.alias("side"), r.alias("rank"))) for s, test, r in roles]))
    rows = events.select(*keys, at, detail.alias("detail"), F.explode(sides).alias("role")).select("*", "role.*")
    last = F.col("side") == "l"
    per_moment = rows.groupBy(*keys, "side", "rank", at).agg(
        F.count(F.lit(1)).alias("n"), F.collect_list(F.when(last, F.struct("detail"))).alias("details")
    )
    # Of a day the first moment with its multiplicity, or the last one with its details.
    per_day = per_moment.groupBy(*keys, "side", "rank").agg(
        F.min(F.struct(F.col(at).alias("at"), "n")).alias("first"), F.max_by("details", at).alias("details")
    )
    by_day = Window.partitionBy(keys[0], "side").orderBy("rank")
    two = per_day.withColumn("k", F.row_number().over(by_day)).where(F.col("k") <= 2)
    of = lambda side, k, column: F.max_by(column, F.when((F.col("side") == side) & (F.col("k") == k), F.lit(1)))
    found = two.groupBy(*keys).agg(
        *[of(side, k, F.col(f"first.{f}")).alias(f"{side}{k}_{f}") for side in "se" for k in (1, 2) for f in ("at", "n")],
        of("l", 1, F.col("details")).alias("details"),
    )
    newest = F.transform("details", lambda d: d["detail"]).alias("newest")
    return found.select(*keys, _chosen(gap).alias("pair"), newest).where("pair IS NOT NULL").select(*keys, "newest", "pair.*")


def pair_totals(starts: DataFrame, ends: DataFrame, gaps: DataFrame, entity: str, gap: str, at: str = "at") -> DataFrame:
    """How many (start, end) pairs each entity has and how many keep to the agreed gap.

    Pairs are counted from day totals: all pairs as a product, kept ones by an equality join of
    the start day plus the gap with the end day.
    """

    def per_day(events: DataFrame, n: str) -> DataFrame:
        return events.groupBy(entity, F.to_date(at).alias("day")).agg(F.count(F.lit(1)).alias(n))

    start_days, end_days = per_day(starts, "n_start"), per_day(ends, "n_end")
    kept = (
        start_days.join(gaps, entity)
        .withColumn("day", F.date_add("day", F.col(gap)))
        .join(end_days, [entity, "day"])
        .groupBy(entity)
        .agg(F.sum(F.col("n_start") * F.col("n_end")).alias("kept"))
    )
    totals = start_days.groupBy(entity).agg(F.sum("n_start").alias("starts")).join(
        end_days.groupBy(entity).agg(F.sum("n_end").alias("ends")), entity
    )
    return (
        gaps.join(totals, entity)
        .join(kept, entity, "left")
        .withColumn("pairs", F.col("starts") * F.col("ends"))
        .withColumn("kept", F.coalesce("kept", F.lit(0).cast("bigint")))
        .select(entity, gap, "starts", "ends", "pairs", "kept")
    )
