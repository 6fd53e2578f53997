"""Frames the reports share: purchase amounts, latest states, contract parties, people, products.

Large tables are reduced to purchase grain before anything is joined to them. Dimension chains
(contract with its parties, user with employee, product with group) are joined first among
themselves, so a purchase or line is shuffled once per chain instead of once per table.
Join strategies are left to the optimizer, which only broadcasts a side of known small size.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderline.functions.buyers import Buyers
from tenderline.functions.dates import Period
from tenderline.functions.numbers import line_amount
from tenderline.operators.joins import semi
from tenderline.operators.latest import latest, latest_typed
from tenderline.sources.tables import KINDS, Tables, event_details

PERSON = ["surname", "first_name", "mail"]


@dataclass(frozen=True)
class Scope:
    """The purchases a report looks at: a period, listed customers, both, or all."""

    period: Period | None = None
    customers: tuple[int, ...] | None = None

    @property
    def is_whole(self) -> bool:
        return self.period is None and self.customers is None


WHOLE = Scope()


def purchases(t: Tables, scope: Scope = WHOLE) -> DataFrame:
    if t.holds("shared_purchases"):
        rows = t.shared_purchases
    else:
        rows = t.order_s.withColumnsRenamed({"id": "order_id", "fk_contract_id": "contract_id"})
    if scope.period is not None:
        rows = rows.where(scope.period.covers(F.col("created_when")))
    if scope.customers is not None:
        rows = semi(rows, contracts(t, Buyers(only=scope.customers)), "contract_id")
    return rows.select(
        "order_id", "order_number", "created_when", "created_by", "contract_id", "customer_payment_sum"
    )


def within(df: DataFrame, t: Tables, scope: Scope) -> DataFrame:
    """Only rows of purchases in scope, dropped before they are shuffled for anything else."""
    return df if scope.is_whole else semi(df, purchases(t, scope), "order_id")


def items(t: Tables, scope: Scope = WHOLE) -> DataFrame:
    return within(t.order_item.withColumnRenamed("fk_order_id", "order_id"), t, scope)


def purchase_amounts(t: Tables, scope: Scope = WHOLE, count_items: bool = False) -> DataFrame:
    """order_id, amount, lines and, on request, the number of distinct item ids."""
    if t.holds("shared_amounts"):
        return within(t.shared_amounts, t, scope)
    lines = items(t, scope)
    if not count_items:
        return lines.groupBy("order_id").agg(
            F.sum(line_amount()).alias("amount"), F.count(F.lit(1)).alias("lines")
        )
    per_item = lines.groupBy("order_id", "id").agg(
        F.sum(line_amount()).alias("amount"), F.count(F.lit(1)).alias("lines")
    )
    return per_item.groupBy("order_id").agg(
        F.sum("amount").alias("amount"), F.sum("lines").alias("lines"), F.count("id").alias("item_count")
    )


def newest_events(t: Tables, view: str, scope: Scope = WHOLE, flagged: bool = False) -> DataFrame:
    """Details of the newest events of one type, from the log: entity, ``at``, the details, on request ``is_newest``.

    The newest time per entity comes from the log alone, in one combined aggregate, after the scope has dropped other
    entities; only the events at that time go on to the child table. An event without details hides the older
    ones of its entity. ``is_newest`` tells that no event of another type came later.
    """
    kind = KINDS[view]
    is_typed = F.col("event_type") == kind.event_type
    log = t.events.select("id", F.col("event_driven_id").alias(kind.entity), F.col("created_when").alias("at"), "event_type")
    if not flagged:
        log = log.where(is_typed)
    if kind.entity == "order_id":
        log = within(log, t, scope)
    newest = log.groupBy(kind.entity).agg(
        F.max(F.when(is_typed, F.col("at"))).alias("at"), *([F.max("at").alias("newest_of_any")] if flagged else [])
    )
    survivors = log.where(is_typed).join(newest, [kind.entity, "at"])
    details = event_details(t, kind).withColumnRenamed("event_id", "id")
    found = survivors.join(details, "id").drop("id", "event_type")
    return found.withColumn("is_newest", F.col("at") == F.col("newest_of_any")).drop("newest_of_any") if flagged else found


def state_events(t: Tables, rows: DataFrame) -> DataFrame:
    """All state changes of the purchases in ``rows`` (order_id and more): ``at``, ``state``, and whether its details are told."""
    if not t.reads_log("order_states"):
        return rows.join(t.order_states, "order_id").withColumn("is_told", F.lit(True))
    kind = KINDS["order_states"]
    log = t.events.where(F.col("event_type") == kind.event_type).select(
        "id", F.col("event_driven_id").alias("order_id"), F.col("created_when").alias("at")
    )
    details = event_details(t, kind).withColumnRenamed("event_id", "id").withColumn("is_told", F.lit(True))
    found = rows.join(log, "order_id").join(details, "id", "left").drop("id")
    return found.withColumn("is_told", F.coalesce("is_told", F.lit(False)))


def latest_states(t: Tables, scope: Scope = WHOLE) -> DataFrame:
    """order_id, state_at, state: all rows at the newest state change."""
    if t.holds("shared_states"):
        return within(t.shared_states, t, scope).select("order_id", "state_at", "state")
    if t.reads_log("order_states"):
        rows = newest_events(t, "order_states", scope)
    else:
        rows = latest(within(t.order_states, t, scope), "order_id")
    return rows.select("order_id", F.col("at").alias("state_at"), "state")


def latest_states_flagged(t: Tables, scope: Scope = WHOLE) -> DataFrame:
    """Latest states with ``is_newest``: no event of another type came later."""
    if t.holds("shared_states"):
        return within(t.shared_states, t, scope)
    if t.reads_log("order_activity"):
        rows = newest_events(t, "order_states", scope, flagged=True)
    else:
        rows = latest_typed(within(t.order_activity, t, scope), "order_id")
    return rows.select("order_id", F.col("at").alias("state_at"), "state", "is_newest")


def latest_supplier_states(t: Tables) -> DataFrame:
    from_log = t.reads_log("supplier_states")
    rows = newest_events(t, "supplier_states") if from_log else latest(t.supplier_states, "supplier_id")
    return rows.select("supplier_id", F.col("state").alias("supplier_state"))


def latest_registrations(t: Tables) -> DataFrame:
    from_log = t.reads_log("registrations")
    rows = newest_events(t, "registrations") if from_log else latest(t.registrations, "supplier_id")
    return rows.select("supplier_id", "stage")


def contracts(t: Tables, buyers: Buyers = Buyers()) -> DataFrame:
    rows = t.contract.withColumnsRenamed(
        {"id": "contract_id", "fk_customer_id": "customer_id", "fk_supplier_id": "supplier_id"}
    )
    return buyers.keep(rows)


def customer_names(t: Tables) -> DataFrame:
    return t.agent.where(F.col("fk_customer_id").isNotNull()).select(
        F.col("fk_customer_id").alias("customer_id"),
        F.col("name").alias("customer_name"),
        F.col("inn").alias("customer_inn"),
    )


def supplier_agents(t: Tables) -> DataFrame:
    return t.agent.where(F.col("fk_supplier_id").isNotNull()).select(
        F.col("id").alias("supplier_agent_id"),
        F.col("fk_supplier_id").alias("supplier_id"),
        F.col("name").alias("supplier_name"),
        F.col("inn").alias("supplier_inn"),
        F.col("kpp").alias("supplier_kpp"),
    )


def parties(t: Tables, buyers: Buyers, suppliers: DataFrame | None = None) -> DataFrame:
    """Contracts with both parties, for reports that ask for existing customer and supplier rows.

    A party with several legal entities yields several rows, as the joins of the report do.
    """
    sellers = supplier_agents(t) if suppliers is None else suppliers
    rows = contracts(t, buyers)
    rows = semi(rows, t.customer.withColumnRenamed("id", "customer_id"), "customer_id")
    rows = semi(rows, t.supplier.withColumnRenamed("id", "supplier_id"), "supplier_id")
    return rows.join(customer_names(t), "customer_id").join(sellers, "supplier_id")


def creators(t: Tables, how: str = "inner") -> DataFrame:
    users = t.user_s.select(F.col("id").alias("user_id"), F.col("user_name").alias("created_by"))
    staff = t.employee.select(F.col("fk_user_id").alias("user_id"), *PERSON)
    return users.join(staff, "user_id", how).select("created_by", *PERSON)


def purchase_rows(
    t: Tables,
    buyers: Buyers,
    period: Period | None = None,
    *,
    states: DataFrame | None = None,
    terms: Column | None = None,
    suppliers: DataFrame | None = None,
    people: str | None = "inner",
    amounts: bool = True,
    count_items: bool = False,
) -> DataFrame:
    """Purchases with amount, latest state, contract, parties and creator, one row per combination.

    ``terms`` filters contracts, ``suppliers`` replaces the supplier side, ``people`` is the
    join type towards the creator (None: no creator).
    """
    scope = Scope(period, buyers.only)
    rows = purchases(t, scope)
    if amounts:
        rows = rows.join(purchase_amounts(t, scope, count_items), "order_id")
    rows = rows.join(latest_states(t, scope) if states is None else states, "order_id")
    sides = parties(t, buyers, suppliers)
    rows = rows.join(sides if terms is None else sides.where(terms), "contract_id")
    if people is not None:
        rows = rows.join(creators(t, people), "created_by")
    return rows


def grouped(rows: DataFrame, keys: Sequence[str], **measures: Column) -> DataFrame:
    return rows.groupBy(*keys).agg(*[m.alias(name) for name, m in measures.items()])


def product_categories(t: Tables) -> DataFrame:
    """Catalogue entry with VAT rate and category reached through its product name."""
    if t.holds("shared_categories"):
        return t.shared_categories
    names = t.product_name.select(F.col("id").alias("name_id"), F.col("fk_product_id").alias("product_id"))
    return (
        t.suppliers_product.select(
            F.col("id").alias("entry_id"), "tax_percent", F.col("fk_product_name_id").alias("name_id")
        )
        .join(names, "name_id", "left")
        .join(_product_groups(t), "product_id", "left")
        .select("entry_id", "tax_percent", "category")
    )


def product_categories_direct(t: Tables) -> DataFrame:
    """The same with the category reached by the entry's own product id."""
    return (
        t.suppliers_product.select(
            F.col("id").alias("entry_id"), "tax_percent", F.col("fk_product_id").alias("product_id")
        )
        .join(_product_groups(t), "product_id", "left")
        .select("entry_id", "tax_percent", "category")
    )


def _product_groups(t: Tables) -> DataFrame:
    groups = t.product_group.select(F.col("id").alias("fk_product_group_id"), F.col("name").alias("category"))
    return (
        t.product.join(groups, "fk_product_group_id", "left")
        .select(F.col("id").alias("product_id"), "category")
    )


def supplier_categories(t: Tables) -> DataFrame:
    """supplier_id, category: the declared categories, without repeats."""
    groups = t.product_group.select(F.col("id").alias("fk_product_group_id"), F.col("name").alias("category"))
    return (
        t.supplier_product_groups.join(groups, "fk_product_group_id", "left")
        .select(F.col("fk_supplier_id").alias("supplier_id"), "category")
        .distinct()
    )
