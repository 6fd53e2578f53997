"""Time the reports and print one JSON line.

``--shapes`` times the loop shapes some reports replace instead: one query per directorate, one
query per customer, one query per status bucket.
"""

from __future__ import annotations

import json
import os
import sys
import time
from dataclasses import replace

from pyspark.sql import functions as F

from tenderline.functions.buyers import Buyers
from tenderline.plans import totals
from tenderline.plans.catalog import BY_CUSTOMER, QUERIES, REPORTS, SAMPLE
from tenderline.plans.frames import WHOLE
from tenderline.session import local_session
from tenderline.sources import derive


def timed(make) -> float:
    start = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def shapes(tables) -> dict[str, float]:
    """Seconds of loop shapes next to the single jobs."""
    found = {}
    parts = [f"D{i:02d}" for i in range(16)]

    def one_directorate(name):
        mapped = tables.directorate.where(F.col("directorate") == name)
        return QUERIES["r08_lines_by_directorate"](tables.replace(directorate=mapped), SAMPLE)

    found["r08_loop_of_16"] = round(sum(timed(lambda p=p: one_directorate(p)) for p in parts), 3)
    found["r08_one_job"] = timed(lambda: QUERIES["r08_lines_by_directorate"](tables, SAMPLE))
    listed = tuple(range(16))
    found["r16_1_loop_of_16_customers"] = round(
        sum(timed(lambda c=c: QUERIES["r16_1_by_customer"](tables, replace(SAMPLE, listed=(c,)))) for c in listed), 3
    )
    found["r16_1_one_job_16_customers"] = timed(
        lambda: QUERIES["r16_1_by_customer"](tables, replace(SAMPLE, listed=listed))
    )
    found["r16_1_one_job_all_customers"] = timed(lambda: QUERIES["r16_1_by_customer"](tables, SAMPLE))

    def one_bucket(name):
        bucket = {name: totals.DASHBOARD_BUCKETS[name]}
        return totals.per_pair(
            tables,
            totals.purchase_facts(tables, bucket, WHOLE, need_items=True),
            bucket,
            Buyers(excluded=SAMPLE.excluded),
        )

    found["r12_one_query_per_bucket"] = round(
        sum(timed(lambda n=n: one_bucket(n)) for n in totals.DASHBOARD_BUCKETS), 3
    )
    found["r12_one_pass"] = timed(
        lambda: totals.per_pair(
            tables,
            totals.purchase_facts(tables, totals.DASHBOARD_BUCKETS, WHOLE, need_items=True),
            totals.DASHBOARD_BUCKETS,
            Buyers(excluded=SAMPLE.excluded),
        )
    )
    return found


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "bench")
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    cold = timed(lambda: QUERIES["r04_stale_orders"](derive(spark, folder), SAMPLE))
    if "--shapes" in sys.argv:
        print(json.dumps({"shapes": shapes(derive(spark, folder)), "unit": "sec", "sf": sf}))
        return
    names = [*REPORTS, *BY_CUSTOMER]
    seconds = {name: timed(lambda n=name: QUERIES[n](derive(spark, folder), SAMPLE)) for name in names}
    result = {
        "metric": "total seconds of all reports",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf,
        "cold_first_query": cold,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
