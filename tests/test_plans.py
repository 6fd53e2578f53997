"""What the plans must not contain, and what skewed keys do to them."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tenderline.plans import orders
from tenderline.plans.catalog import QUERIES, SAMPLE
from tenderline.plans.frames import Scope, latest_states, purchase_amounts
from tenderline.plans.shares import category_purchases, supplier_share_by_customer
from tenderline.functions.buyers import Buyers
from tests.conftest import rows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conf(spark):
    """Settings for one test, undone afterwards."""
    touched = {}

    def set_all(**values):
        for key, value in values.items():
            key = "spark.sql." + key.replace("__", ".")
            touched.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_all
    for key, value in touched.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


LAZY = [n for n in QUERIES if n != "op_partitioned_export"]


@pytest.mark.parametrize("name", LAZY)
def test_no_nested_loops_and_no_forced_broadcasts(conf, small, name):
    conf(autoBroadcastJoinThreshold="-1")
    plan = plan_of(QUERIES[name](small, SAMPLE))
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert "BroadcastHashJoin" not in plan, "a broadcast without a size check"
    # Windows: two days per purchase, cut before the shuffle.
    if name in ("r03_payment_vs_delay", "op_event_pairs"):
        assert "WindowGroupLimit" in plan
    else:
        assert not re.search(r"\bWindow\b", plan)


def test_period_reaches_the_scan(small, capsys):
    df = orders.purchases(small, Scope(SAMPLE.payments))
    df.explain("formatted")
    plan = capsys.readouterr().out
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan).group(1)
    assert "GreaterThanOrEqual(o_orderdate,2001-01-01" in pushed and "LessThan(o_orderdate,2001-07-01" in pushed
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_amounts_read_only_their_columns(small):
    plan = plan_of(purchase_amounts(small))
    assert "l_quantity" in plan and "p_name" not in plan and "p_type" not in plan


def test_one_aggregate_serves_rows_and_totals(small):
    df = supplier_share_by_customer(small, SAMPLE.network)
    df.collect()
    final = plan_of(df).split("+- == Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet \[l_orderkey", final)) == 1
    assert "ReusedExchange" in final


@pytest.fixture(scope="module")
def skewed(spark, small):
    """A third of all lines and events in one purchase, a third of the purchases in one contract."""
    n = 3000
    deal = spark.range(n).selectExpr(
        "id", "cast(id as string) as order_number", "timestamp_ntz'2001-06-01' as created_when",
        "'user1' as created_by", "if(id % 3 = 0, 200000000L, 200000000L + id % 400) as fk_contract_id",
        "cast(null as decimal(18,2)) as customer_payment_sum",
    )
    item = spark.range(6 * n).selectExpr(
        "id", f"if(id % 3 = 0, 5L, id % {n}) as fk_order_id", "cast(id % 90 + 1 as decimal(18,2)) as price",
        "cast(id % 7 as decimal(10,0)) as quantity", "'p' as product_name",
        "if(id % 3 = 1, null, id % 50) as fk_supplier_product_id",
    )
    states = spark.range(6 * n).selectExpr(
        f"if(id % 3 = 0, 7L, id % {n}) as order_id",
        "timestampadd(HOUR, cast(pmod(id * 37, 1000) as int), timestamp_ntz'2001-06-01') as at",
        "element_at(array('NEW', 'EXECUTION', 'ORDER_CANCELED'), cast(id % 3 + 1 as int)) as state",
    )
    return small.replace(order_s=deal, order_item=item, order_states=states)


SMALL_PARTS = dict(
    autoBroadcastJoinThreshold="-1",
    adaptive__skewJoin__skewedPartitionThresholdInBytes="2KB",
    adaptive__skewJoin__skewedPartitionFactor="1.5",
    adaptive__advisoryPartitionSizeInBytes="2KB",
    adaptive__coalescePartitions__enabled="false",
    shuffle__partitions="8",
)


def test_latest_states_of_a_dominant_purchase(conf, skewed):
    conf(**SMALL_PARTS)
    newest = {}
    events = [tuple(r) for r in skewed.order_states.collect()]
    for deal, moment, _ in events:
        newest[deal] = max(moment, newest.get(deal, moment))
    want = Counter(e for e in events if e[1] == newest[e[0]])
    assert Counter(tuple(r) for r in latest_states(skewed).collect()) == want


def test_shares_with_a_dominant_purchase_contract_and_missing_product(conf, skewed):
    conf(**SMALL_PARTS)
    got = category_purchases(skewed, Buyers())
    result = {tuple(r)[:3]: (r["orders"], r["amount"]) for r in got.collect()}
    contract = {r["id"]: (r["fk_customer_id"], r["fk_supplier_id"]) for r in skewed.contract.collect()}
    group = {r["entry_id"]: r["category"] for r in orders_categories(skewed)}
    ties = Counter(r["order_id"] for r in latest_states(skewed).collect() if r["state"] != "ORDER_CANCELED")
    owner = {r["id"]: contract.get(r["fk_contract_id"]) for r in skewed.order_s.collect()}
    seen, total = defaultdict(set), Counter()
    for r in skewed.order_item.collect():
        deal = r["fk_order_id"]
        if not ties[deal] or owner[deal] is None or (r["price"] == 0 and r["quantity"] == 0):
            continue
        customer, supplier = owner[deal]
        key = (customer, group.get(r["fk_supplier_product_id"]), supplier)
        seen[key].add(deal)
        total[key] += r["price"] * r["quantity"] * ties[deal]
    assert result == {k: (len(v), total[k]) for k, v in seen.items()}
    assert "skew=true" in plan_of(got)


def orders_categories(tables):
    from tenderline.plans.frames import product_categories

    return product_categories(tables).collect()


def test_amounts_are_combined_before_the_shuffle(skewed):
    plan = plan_of(purchase_amounts(skewed))
    assert plan.index("HashAggregate") < plan.index("Exchange") < plan.rindex("partial_sum")
    assert rows(purchase_amounts(skewed).where("order_id = 5").select("lines"))[0][0] >= 6000
    assert purchase_amounts(skewed).agg(F.sum("lines")).first()[0] == 18000
