"""The whole report pack: frames written once, then every report written out.

A single report is one lazy plan. A pack of 32 would find the latest states and purchase amounts
32 times; ``share_frames`` writes them once as tables bucketed by purchase, so the joins of all
reports on the purchase id read them side by side without a shuffle. The small product dimension
is written as well, which gives the optimizer its true size.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tenderline.plans.catalog import BY_CUSTOMER, QUERIES, REPORTS, Params
from tenderline.plans.frames import (
    latest_states_flagged,
    purchase_amounts,
    product_categories,
    purchases,
)
from tenderline.session import scratch_folder
from tenderline.sources.sinks import with_name, write_by, write_report
from tenderline.sources.tables import Tables


def share_frames(spark: SparkSession, t: Tables, buckets: int = 200, folder: str | None = None) -> Tables:
    """The tables plus the shared frames, stored under ``folder`` (default: the scratch folder)."""
    folder = folder or scratch_folder(spark)
    prefix = "tenderline_" + folder.rstrip("/").rsplit("/", 1)[-1].replace("-", "_")

    def bucketed(name: str, df: DataFrame) -> DataFrame:
        # One row, or a few tied rows, per purchase: no bucket can be dominated by one key.
        table = f"{prefix}_{name}"
        (
            df.repartition(buckets, "order_id")
            .write.mode("overwrite")
            .bucketBy(buckets, "order_id")
            .sortBy("order_id")
            .option("path", f"{folder}/{name}")
            .saveAsTable(table)
        )
        return spark.table(table)

    categories = f"{folder}/categories"
    product_categories(t).write.mode("overwrite").parquet(categories)
    return t.replace(
        shared_purchases=bucketed("purchases", purchases(t)),
        shared_amounts=bucketed("amounts", purchase_amounts(t, count_items=True)),
        shared_states=bucketed("states", latest_states_flagged(t)),
        shared_categories=spark.read.schema("entry_id bigint, tax_percent int, category string").parquet(categories),
    )


def write_pack(
    t: Tables, params: Params, out: str, names: Iterable[str] | None = None, fmt: str = "parquet"
) -> list[str]:
    """Write reports below ``out``: by-customer ones and the directorate report in one part per key."""
    written = []
    for name in names or [*REPORTS, *BY_CUSTOMER]:
        df, path = QUERIES[name](t, params), f"{out}/{name}"
        if name in BY_CUSTOMER:
            write_by(with_name(df, t.agent), "customer_id", path, fmt)
        elif name == "r08_lines_by_directorate":
            write_by(df, "directorate", path, fmt)
        else:
            write_report(df, path, fmt)
        written.append(path)
    return written
