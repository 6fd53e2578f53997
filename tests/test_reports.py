"""Properties of the reports: by-customer parts, shared frames, stored tables, outputs."""

from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from tenderline.__main__ import params_for
from tenderline.functions.buyers import Buyers
from tenderline.plans import contracts, lines, orders, shares, suppliers, totals
from tenderline.plans.catalog import QUERIES, SAMPLE
from tenderline.plans.pack import share_frames, write_pack
from tenderline.sources import read_parquet
from tenderline.sources.sinks import with_name, write_by, write_report
from tenderline.sources.tables import SCHEMAS
from tests.conftest import rows

ONE = 12

PAIRS = {
    "r06_by_customer": lambda t, b: totals.customer_totals(t, b),
    "r14_by_customer": lambda t, b: shares.supplier_share_by_customer(t, b),
    "r15_by_customer": lambda t, b: contracts.advance_contracts(t, SAMPLE.as_of, b),
    "r15_1_by_customer": lambda t, b: contracts.advance_contract_detail(t, SAMPLE.as_of, b),
    "r16_by_customer": lambda t, b: totals.unclosed_summary(t, b),
    "r16_1_by_customer": lambda t, b: orders.unclosed_orders(t, b),
    "r17_by_customer": lambda t, b: contracts.long_contracts(t, SAMPLE.as_of, b),
    "r18_by_customer": lambda t, b: shares.supply_cycles(t, SAMPLE.cycles_since, b),
}


@pytest.mark.parametrize("name", list(PAIRS))
def test_a_customers_part_equals_the_report_on_that_customer(small, name):
    part = QUERIES[name](small, SAMPLE).where(F.col("customer_id") == ONE).drop("customer_id")
    alone = PAIRS[name](small, Buyers(only=(ONE,)))
    assert rows(part) == rows(alone)


def test_monthly_parts_equal_the_reports_on_their_customers(small):
    for split, base in (
        (lines.zero_vat_lines(small, SAMPLE.month_as_of, SAMPLE.each), lines.zero_vat_lines(small, SAMPLE.month_as_of)),
        (
            suppliers.orders_of_duplicate_suppliers(small, SAMPLE.month_as_of, SAMPLE.each),
            suppliers.orders_of_duplicate_suppliers(small, SAMPLE.month_as_of),
        ),
    ):
        assert rows(split.drop("customer_id")) == rows(base)


def test_excluded_customer_has_a_part_only_where_the_list_does_not_apply(small):
    shares_part = QUERIES["r14_by_customer"](small, SAMPLE).where("customer_id = 77")
    totals_part = QUERIES["r06_by_customer"](small, SAMPLE).where("customer_id = 77")
    network_part = QUERIES["r19_by_customer"](small, SAMPLE).where("customer_id = 77")
    assert shares_part.count() == 0 and totals_part.count() == 1 and network_part.count() > 0


def test_same_named_customers_merge_only_with_equal_blocks(spark, small):
    """Two customers of one name without any block merge, a third with a closed purchase does not."""
    agents = small.agent.where("fk_customer_id is null").unionByName(
        spark.createDataFrame(
            [(i, "Same", str(i), None, i, None, None, "user0") for i in (1, 2, 3)], SCHEMAS["agent"]
        )
    )
    deal = spark.createDataFrame(
        [(11, "a", 1, 900, "FULL", None, None, None, None), (12, "b", 2, 900, "FULL", None, None, None, None),
         (13, "c", 3, 901, "FULL", None, None, None, None)],
        SCHEMAS["contract"],
    )
    bought = spark.createDataFrame([(i, str(i), None, "user0", 10 + i, None) for i in (1, 2, 3)], SCHEMAS["order_s"])
    item = spark.sql("select id, id as fk_order_id, cast(2 as decimal(18,2)) as price, cast(3 as decimal(10,0)) as quantity,"
                     " 'x' as product_name, id as fk_supplier_product_id from values (1L), (2L), (3L) as v(id)")
    activity = spark.sql("select 3L as order_id, timestamp_ntz'2001-01-01' as at, 'ORDER_CLOSED' as state")
    tables = small.replace(agent=agents, contract=deal, order_s=bought, order_item=item, order_activity=activity)
    got = [(r["orders"], r["amount"], r["closed_orders"], r["suppliers"]) for r in totals.customer_totals(tables).collect()]
    assert sorted(got, key=str) == [(1, 6, 1, 1), (2, 12, None, 1)]


def test_dashboard_buckets_equal_direct_filters(small):
    period_orders = orders.purchases(small, orders.Scope(SAMPLE.payments))
    got = totals.status_dashboard(small, date(2001, 7, 15)).agg(F.sum("new_orders"), F.sum("execution_orders")).first()
    june = orders.latest_states(small).join(
        orders.purchases(small).where("created_when >= '2001-06-01' and created_when < '2001-07-01'"), "order_id"
    ).join(small.order_item.select(F.col("fk_order_id").alias("order_id")).distinct(), "order_id")
    # A customer with two entities appears once per name, so purchases are not doubled here.
    want = [june.where(F.col("state") == s).select("order_id").distinct().count() for s in ("NEW", "EXECUTION")]
    assert [got[0] or 0, got[1] or 0] == want and period_orders.columns[0] == "order_id"


SHARED = [
    "r01_full_prepay_orders", "r02_partial_prepay_orders", "r04_stale_orders", "r06_customer_totals",
    "r12_status_dashboard", "r14_supplier_share_by_customer", "r18_supply_cycles",
]


@pytest.fixture(scope="module")
def shared(spark, small):
    return share_frames(spark, small, buckets=4)


@pytest.mark.parametrize("name", SHARED)
def test_shared_frames_change_nothing(small, shared, name):
    assert rows(QUERIES[name](shared, SAMPLE)) == rows(QUERIES[name](small, SAMPLE))


def test_bucketed_frames_join_without_a_shuffle(spark, shared):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = orders.purchases(shared).join(shared.shared_amounts, "order_id").join(shared.shared_states, "order_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan


@pytest.fixture(scope="module")
def stored(spark, small, tmp_path_factory):
    """The tables written one Parquet folder each, events and their typed children apart."""
    root = str(tmp_path_factory.mktemp("stored"))
    log = small.event_log
    children = {
        "order_state_event": ("ORDER_STATE", ["order_state"]),
        "supplier_state_event": ("SUPPLIER_STATE", ["supplier_state"]),
        "register_stages": ("REGISTRATION", ["registry_stage"]),
        "order_param_change_event": ("ORDER_PARAM_CHANGE", ["parameter_name", "new_value"]),
    }
    frames = {name: getattr(small, name) for name in SCHEMAS if small.holds(name)}
    frames["events"] = log.select("id", "event_driven_id", "event_type", "created_when")
    for name, (kind, columns) in children.items():
        frames[name] = log.where(F.col("event_type") == kind).select(F.col("id").alias("event_id"), *columns)
    for name in SCHEMAS:
        write_report(frames[name], f"{root}/{name}")
    return read_parquet(spark, root)


@pytest.mark.parametrize("name", ["r02_partial_prepay_orders", "r04_stale_orders", "r09_duplicate_suppliers", "r12_status_dashboard"])
def test_stored_tables_give_the_same_reports(small, stored, name):
    assert rows(QUERIES[name](stored, SAMPLE)) == rows(QUERIES[name](small, SAMPLE))


def test_newest_change_without_details_hides_older_ones(spark):
    from datetime import datetime

    from tenderline.plans.frames import latest_states, latest_states_flagged, latest_supplier_states
    from tenderline.sources.tables import EVENT_VIEWS, Tables

    at = [datetime(2001, 1, d) for d in range(1, 6)]
    log = [
        (1, 10, "ORDER_STATE", at[0]), (2, 10, "ORDER_STATE", at[1]),  # 2 has no details
        (3, 11, "ORDER_STATE", at[0]), (4, 11, "OTHER", at[2]), (5, 12, "ORDER_STATE", at[1]),  # 5: details, no state
        (6, 20, "SUPPLIER_STATE", at[0]), (7, 20, "SUPPLIER_STATE", at[3]), (8, 21, "SUPPLIER_STATE", at[0]),
    ]
    frames = {
        "events": spark.createDataFrame(log, "id bigint, event_driven_id bigint, event_type string, created_when timestamp"),
        "order_state_event": spark.createDataFrame([(1, "NEW"), (3, "NEW"), (5, None)], "event_id bigint, order_state string"),
        "supplier_state_event": spark.createDataFrame([(6, "NEW"), (8, "NEW")], "event_id bigint, supplier_state string"),
    }
    t = Tables(EVENT_VIEWS).replace(**frames)
    assert [(r[0], r[2]) for r in rows(latest_states(t))] == [(11, "NEW"), (12, None)]
    assert [(r[0], r[2], r[3]) for r in rows(latest_states_flagged(t))] == [(11, "NEW", False), (12, None, True)]
    assert rows(latest_supplier_states(t)) == [(21, "NEW")]


def test_csv_parts_have_a_header(spark, small, tmp_path):
    from tenderline.sources.sinks import write_by

    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    write_by(df, "k", str(tmp_path / "out"), "csv")
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert rows(back.select("k", "v")) == [(1, "a"), (2, "b")]


def test_pack_writes_parts_that_add_up(spark, small, tmp_path):
    names = ["r08_lines_by_directorate", "r16_by_customer", "r04_stale_orders"]
    paths = write_pack(small, replace(SAMPLE, excluded=()), str(tmp_path), names)
    for name, path in zip(names, paths):
        want = QUERIES[name](small, replace(SAMPLE, excluded=()))
        back = spark.read.schema(want.schema).parquet(path)
        assert rows(back.select(*want.columns)) == rows(want)
    assert (tmp_path / "r08_lines_by_directorate" / "directorate=D05").exists()


def test_csv_has_a_header(spark, small, tmp_path):
    write_report(QUERIES["op_group_concat"](small, SAMPLE), str(tmp_path / "c"), "csv")
    back = spark.read.option("header", True).csv(str(tmp_path / "c"))
    assert back.columns == ["supplier_id", "categories"] and back.count() == 9


def test_parts_of_a_dominant_key_are_split(spark, tmp_path):
    df = spark.range(0, 90_000, 1, 8).selectExpr("if(id % 3 = 0, 1, id) as k", "id", "repeat('x', 200) as pad")
    write_by(df.where("k = 1 or k < 50"), "k", str(tmp_path / "w"), rows_per_file=4_000)
    assert spark.read.parquet(str(tmp_path / "w")).count() == df.where("k = 1 or k < 50").count()
    assert len(list((tmp_path / "w" / "k=1").glob("*.parquet"))) > 1


def test_every_part_gets_one_name(small):
    named = with_name(small.customer.withColumnRenamed("id", "customer_id"), small.agent)
    assert named.count() == small.customer.count() and named.where("part_name is null").count() == 0


def test_params_from_one_day():
    got = params_for(date(2001, 7, 15), [7], None, [])
    assert got.payments.first == date(2001, 6, 1) and got.cycles_since == date(2001, 6, 1) and got.each.split
