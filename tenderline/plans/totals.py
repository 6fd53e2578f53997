"""Customer totals: purchases, amounts, suppliers and status blocks per customer.

All blocks come from one pass. Purchases carry their bucket hits, are summed per
(customer, supplier), take the supplier's multiplicities there, and are summed per customer.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderline.functions.buyers import Buyers
from tenderline.functions.dates import Period, trailing_weeks
from tenderline.functions.numbers import none_if_zero, percent
from tenderline.operators.buckets import bucket_hits, bucket_measures
from tenderline.operators.joins import semi
from tenderline.operators.shares import read_whole
from tenderline.operators.weekly import weekly_matrix
from tenderline.plans.frames import (
    Scope,
    contracts,
    customer_names,
    items,
    latest_states_flagged,
    latest_supplier_states,
    purchase_amounts,
    purchases,
    supplier_agents,
)
from tenderline.sources.tables import Tables

POSTFACTUM_OPEN = ("DOCUMENTS_POSTFACTUM", "PAYMENT_POSTFACTUM", "ORDER_RESULTS_POSTFACTUM")
POSTFACTUM = (*POSTFACTUM_OPEN, "ORDER_CLOSED_POSTFACTUM")


@dataclass(frozen=True)
class Bucket:
    """Latest rows in one of the states (or, with ``other``, in none of them).

    ``newest`` asks that no event of another type came after the state change.
    """

    states: tuple[str, ...]
    newest: bool = False
    other: bool = False

    def test(self) -> Column:
        state = F.col("state")
        inside = ~state.isin(*self.states) if self.other else state.isin(*self.states)
        inside = F.coalesce(inside, F.lit(False))
        return inside & F.col("is_newest") if self.newest else inside


FINISHED_BUCKETS = {
    "closed": Bucket(("ORDER_CLOSED",), newest=True),
    "canceled": Bucket(("ORDER_CANCELED",), newest=True),
}
DASHBOARD_BUCKETS = {
    "pf": Bucket(POSTFACTUM),
    **FINISHED_BUCKETS,
    "payment": Bucket(("PAYMENT", "PARTIAL_POST_PAYMENT", "PARTIAL_PRE_PAYMENT")),
    "execution": Bucket(("EXECUTION",)),
    "new": Bucket(("NEW",)),
    "received": Bucket(("PAYMENT_RECEIVED", "PARTIAL_POST_PAYMENT_RECEIVED", "PARTIAL_PRE_PAYMENT_RECEIVED")),
    "reception": Bucket(("RECEPTION",)),
    "editing": Bucket(("ORDER_RESULTS",)),
    "agreeing": Bucket(("AGREED_BY_SUPPLIER",)),
}
UNCLOSED_BUCKETS = {
    "pf": Bucket(POSTFACTUM),
    "open": Bucket(("ORDER_CLOSED", "ORDER_CANCELED"), newest=True, other=True),
    "pf_open": Bucket(POSTFACTUM_OPEN),
}


def purchase_facts(t: Tables, buckets: Mapping[str, Bucket], scope: Scope, need_items: bool) -> DataFrame:
    """One row per purchase: amount, lines and bucket hits, all co-partitioned by purchase."""
    tests = {name: bucket.test() for name, bucket in buckets.items()}
    hits = bucket_hits(latest_states_flagged(t, scope), "order_id", tests)
    return (
        purchases(t, scope)
        .select("order_id", "contract_id")
        .join(purchase_amounts(t, scope), "order_id", "inner" if need_items else "left")
        .join(hits, "order_id", "left")
    )


def per_pair(t: Tables, facts: DataFrame, buckets: Mapping[str, Bucket], buyers: Buyers) -> DataFrame:
    """Sums per (customer, supplier); ``orders`` and ``amount`` count purchases with items."""
    sides = contracts(t, buyers).select("contract_id", "customer_id", "supplier_id")
    return (
        facts.join(sides, "contract_id")
        .groupBy("customer_id", "supplier_id")
        .agg(
            F.count("lines").alias("orders"),
            F.sum("amount").alias("amount"),
            F.sum("lines").alias("lines"),
            *bucket_measures(buckets, "amount"),
        )
    )


def _suppliers(orders: str) -> Column:
    """Suppliers of a customer with at least one purchase counted in ``orders``."""
    return F.sum(((F.col(orders) > 0) & F.col("supplier_id").isNotNull()).cast("int"))


def supplier_weights(t: Tables) -> DataFrame:
    """Per supplier: sole-trader entities, and entities times latest post-factum states."""
    entities = supplier_agents(t).groupBy("supplier_id").agg(
        F.count(F.lit(1)).alias("entities"),
        F.sum((F.length("supplier_inn") == 12).cast("int")).alias("sole"),
    )
    states = latest_supplier_states(t).groupBy("supplier_id").agg(
        F.sum((F.col("supplier_state") == "POSTFACTUM").cast("int")).alias("pf_states")
    )
    known = t.supplier.select(F.col("id").alias("supplier_id"))
    states = states.join(known, "supplier_id")
    return entities.join(states, "supplier_id", "left").select(
        "supplier_id",
        F.coalesce("sole", F.lit(0)).alias("sole"),
        F.coalesce(F.col("entities") * F.col("pf_states"), F.lit(0)).alias("pf"),
    )


def _weighted_blocks(distinct: bool) -> list[Column]:
    """Blocks of a customer from its (customer, supplier) sums; an empty block is null."""
    finished = "orders" if distinct else "rows"
    blocks = [none_if_zero(F.sum(f"{b}_{finished}")).alias(f"{b}_orders") for b in ("closed", "canceled")]
    for name in ("pf", "sole"):
        weight = F.col(name)
        counted = F.col("lines") * weight if name == "sole" and not distinct else F.col("orders")
        hit = (weight > 0) & (F.col("orders") > 0)
        blocks += [
            F.sum(F.when(hit, counted)).alias(f"{name}_orders"),
            F.sum(F.when(hit, F.col("amount") * weight)).alias(f"{name}_amount"),
            none_if_zero(F.sum((hit & F.col("supplier_id").isNotNull()).cast("int"))).alias(f"{name}_suppliers"),
        ]
    return blocks


CUSTOMER_BLOCKS = [
    "closed_orders", "canceled_orders", "pf_orders", "pf_amount", "pf_suppliers",
    "sole_orders", "sole_amount", "sole_suppliers",
]


def customer_totals(
    t: Tables, buyers: Buyers = Buyers(), period: Period | None = None, distinct: bool = True
) -> DataFrame:
    """Totals per customer name with closed, cancelled, post-factum and sole-trader blocks.

    Customers of one name merge when all their blocks agree. ``distinct=False`` counts closed and
    cancelled purchases per tied event, and sole-trader purchases per line.
    """
    facts = purchase_facts(t, FINISHED_BUCKETS, Scope(period, buyers.only), need_items=False)
    pairs = per_pair(t, facts, FINISHED_BUCKETS, buyers)
    weights = supplier_weights(t)
    names = customer_names(t).select("customer_id", "customer_name")
    keys = [*buyers.keys, "customer_name", *CUSTOMER_BLOCKS]
    if buyers.split:
        # Nothing merges across customers, so one pass per customer is enough.
        totals = pairs.join(weights, "supplier_id", "left").groupBy("customer_id").agg(
            F.sum("orders").alias("orders"),
            F.sum("amount").alias("amount"),
            _suppliers("orders").alias("suppliers"),
            *_weighted_blocks(distinct),
        )
        rows = totals.where(F.col("orders") > 0).join(names, "customer_id").groupBy(*keys).agg(
            F.sum("amount").alias("amount"), F.sum("orders").alias("orders"), F.max("suppliers").alias("suppliers")
        )
    else:
        whole = read_whole(pairs)
        blocks = whole.join(weights, "supplier_id", "left").groupBy("customer_id").agg(*_weighted_blocks(distinct))
        base = whole.where(F.col("orders") > 0).select("customer_id", "supplier_id", "orders", "amount")
        rows = base.join(blocks, "customer_id").join(names, "customer_id").groupBy(*keys).agg(
            F.sum("amount").alias("amount"),
            F.sum("orders").alias("orders"),
            F.countDistinct("supplier_id").alias("suppliers"),
        )
    return rows.select(
        *buyers.keys, "customer_name", "amount", "orders", "closed_orders", "canceled_orders", "suppliers",
        "pf_orders", "pf_amount", "pf_suppliers", "sole_orders", "sole_amount", "sole_suppliers",
    ).orderBy(*[F.asc_nulls_last(c) for c in (*buyers.keys, "customer_name", "orders", "amount")])


def customer_totals_period(t: Tables, as_of: date, buyers: Buyers = Buyers()) -> DataFrame:
    """The same for the previous month, with plain counts."""
    return customer_totals(t, buyers, Period.previous_month(as_of), distinct=False)


def _bucket_totals(
    t: Tables, buckets: Mapping[str, Bucket], buyers: Buyers, period: Period | None
) -> DataFrame:
    """Per customer and name: totals and bucket blocks. Same-named entities of a customer add up."""
    facts = purchase_facts(t, buckets, Scope(period, buyers.only), need_items=True)
    pairs = per_pair(t, facts, buckets, buyers)
    measures = []
    for name in buckets:
        measures += [
            none_if_zero(F.sum(f"{name}_orders")).alias(f"{name}_orders"),
            F.sum(f"{name}_amount").alias(f"{name}_amount"),
        ]
    totals = pairs.groupBy("customer_id").agg(
        F.sum("orders").alias("own_orders"),
        F.sum("amount").alias("own_amount"),
        _suppliers("orders").alias("suppliers"),
        none_if_zero(_suppliers("pf_orders")).alias("pf_suppliers"),
        *measures,
    )
    names = customer_names(t).groupBy("customer_id", "customer_name").agg(F.count(F.lit(1)).alias("entities"))
    return totals.join(names, "customer_id").withColumns(
        {"orders": F.col("own_orders") * F.col("entities"), "amount": F.col("own_amount") * F.col("entities")}
    )


def status_dashboard(t: Tables, as_of: date, buyers: Buyers = Buyers()) -> DataFrame:
    """Previous month per customer: totals and count plus amount of ten status buckets."""
    totals = _bucket_totals(t, DASHBOARD_BUCKETS, buyers, Period.previous_month(as_of))
    columns = ["customer_name", "orders", "amount", "suppliers", "pf_orders", "pf_amount", "pf_suppliers"]
    for name in DASHBOARD_BUCKETS:
        if name != "pf":
            columns += [f"{name}_orders", f"{name}_amount"]
    return (
        totals.select(*buyers.keys, *columns)
        .fillna(0)
        .orderBy(F.asc_nulls_last("orders"), F.asc_nulls_last("customer_name"))
    )


def unclosed_summary(t: Tables, buyers: Buyers = Buyers()) -> DataFrame:
    """Per customer: totals, post-factum and not closed purchases with their shares."""
    totals = _bucket_totals(t, UNCLOSED_BUCKETS, buyers, None)
    return totals.select(
        *buyers.keys,
        "customer_name",
        "orders",
        F.round("amount", 2).alias("amount"),
        "suppliers",
        "pf_orders",
        F.round("pf_amount", 2).alias("pf_amount"),
        "pf_suppliers",
        "open_orders",
        percent(F.col("open_orders"), F.col("orders")).alias("open_pct"),
        F.round("open_amount", 2).alias("open_amount"),
        "pf_open_orders",
        percent(F.col("pf_open_orders"), F.col("pf_orders")).alias("pf_open_pct"),
        F.round("pf_open_amount", 2).alias("pf_open_amount"),
    ).orderBy(F.desc_nulls_first("orders"), *[F.asc_nulls_last(c) for c in (*buyers.keys, "customer_name")])


def weekly_facts(
    t: Tables, as_of: date, buyers: Buyers = Buyers(), weeks: int = 4
) -> tuple[DataFrame, DataFrame]:
    """Purchases with amounts of the trailing weeks alone, and the contracts that ever had one, by their keys only."""
    recent = Scope(Period(trailing_weeks(as_of, weeks)[0][0], as_of), buyers.only)
    facts = purchases(t, recent).join(purchase_amounts(t, recent), "order_id")
    ever = Scope(customers=buyers.only)
    filled = items(t, ever).select("order_id").distinct()
    bought = semi(purchases(t, ever).select("order_id", "contract_id"), filled, "order_id")
    return facts, bought.select("contract_id").distinct()


def weekly_activity(t: Tables, as_of: date, buyers: Buyers = Buyers(), weeks: int = 4) -> DataFrame:
    """Four trailing weeks per customer name: purchases and amounts, all and post factum.

    Every purchase counts once per state event of its supplier, and in the post-factum measures
    once per latest post-factum state of its supplier.
    """
    facts, bought = weekly_facts(t, as_of, buyers, weeks)
    sides = contracts(t, buyers).select("contract_id", "customer_id", "supplier_id")
    pairs = weekly_matrix(
        facts.join(sides, "contract_id"),
        ["customer_id", "supplier_id"],
        "created_when",
        as_of,
        counts=["orders"],
        sums={"amount": F.col("amount")},
        weeks=weeks,
        all_keys=bought.join(sides, "contract_id"),
    )
    events = t.supplier_states.groupBy("supplier_id").agg(F.count(F.lit(1)).alias("n_events"))
    postfactum = latest_supplier_states(t).groupBy("supplier_id").agg(
        F.sum((F.col("supplier_state") == "POSTFACTUM").cast("int")).alias("n_pf")
    )
    weights = events.join(postfactum, "supplier_id", "left")
    rows = pairs.join(weights, "supplier_id").join(
        customer_names(t).select("customer_id", "customer_name"), "customer_id"
    )
    numbers = range(1, weeks + 1)
    pf = F.coalesce("n_pf", F.lit(0))
    measures = [F.sum(F.col(f"orders_w{i}") * F.col("n_events")).alias(f"orders_w{i}") for i in numbers]
    measures += [F.sum(F.col(f"amount_w{i}") * F.col("n_events")).alias(f"amount_w{i}") for i in numbers]
    measures += [F.sum(F.col(f"orders_w{i}") * pf).alias(f"pf_orders_w{i}") for i in numbers]
    measures += [F.sum(F.when(pf > 0, F.col(f"amount_w{i}") * pf)).alias(f"pf_amount_w{i}") for i in numbers]
    return rows.groupBy(*buyers.keys, "customer_name").agg(*measures)
