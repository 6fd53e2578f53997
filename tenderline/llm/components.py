"""Connected components by alternating stars; every round is a table in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderline.llm.common import written


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """node and its component, the smallest node it reaches; for all nodes that have a link.

    A round hangs the larger neighbours of every node on its smallest neighbour, then the smaller ones. Rows stay about
    as many as the links were, and a node with very many links is only ever the key of a minimum and of a plain join,
    which Spark can split.
    """
    pairs = links.select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low")).where("high <> low").distinct()
    state, mark = written(pairs, "links"), None
    while True:
        both = state.unionByName(state.select(F.col("low").alias("high"), F.col("high").alias("low")))
        least = both.groupBy("high").agg(F.min("low").alias("m")).select(F.col("high").alias("u"), F.least("high", "m").alias("m"))
        large = (
            both.join(least, both.high == least.u)
            .where("low > high")
            .select(F.col("low").alias("high"), F.col("m").alias("low"))
            .where("high <> low")
            .distinct()
        )
        large = written(large, "links")
        low = large.groupBy("high").agg(F.min("low").alias("m"))
        joined = large.join(low, "high")
        hung = joined.select(F.explode(F.array(F.struct("high", F.col("m").alias("low")), F.struct(F.col("low").alias("high"), F.col("m").alias("low")))).alias("x")).select("x.*")
        state = written(hung.where("high <> low").distinct(), "links")
        now = state.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("high", "low"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    roots = state.select(F.col("low").alias("node")).distinct().withColumn("component", F.col("node"))
    return state.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(roots)
