"""Supplier shares and supply cycles."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderline.functions.buyers import Buyers
from tenderline.functions.dates import Period, seconds_between
from tenderline.functions.numbers import line_amount, mean
from tenderline.operators.joins import left_join_spread
from tenderline.operators.shares import join_totals, read_whole, share, with_grand_total, with_percents
from tenderline.plans.frames import (
    Scope,
    contracts,
    customer_names,
    items,
    latest_states,
    product_categories,
    purchases,
    supplier_agents,
)
from tenderline.sources.tables import Tables


PAIR = ("customer_id", "category", "supplier_id")


def category_purchases(t: Tables, buyers: Buyers, keys: Sequence[str] = PAIR) -> DataFrame:
    """Purchases and amount per key and category, cancelled purchases and empty lines left out.

    A purchase counts its amount once per tied latest state.
    """
    scope = Scope(customers=buyers.only)
    live = (
        latest_states(t, scope)
        .where(F.col("state") != "ORDER_CANCELED")
        .groupBy("order_id")
        .agg(F.count(F.lit(1)).alias("ties"))
    )
    lines = (
        items(t, scope)
        .where((F.col("price") != 0) | (F.col("quantity") != 0))
        .select("order_id", "price", "quantity", F.col("fk_supplier_product_id").alias("entry_id"))
    )
    per_category = (
        lines.join(product_categories(t).select("entry_id", "category"), "entry_id", "left")
        .groupBy("order_id", "category")
        .agg(F.sum(line_amount()).alias("amount"))
    )
    sides = contracts(t, buyers).select("contract_id", "customer_id", "supplier_id")
    return (
        per_category.join(live, "order_id")
        .join(purchases(t, scope).select("order_id", "contract_id"), "order_id")
        .join(sides, "contract_id")
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("orders"), F.sum(F.col("amount") * F.col("ties")).alias("amount"))
    )


def supplier_share_by_customer(t: Tables, buyers: Buyers = Buyers()) -> DataFrame:
    """Each supplier's part of a customer's spending, per category and in all."""
    shares = share(
        category_purchases(t, buyers),
        "amount",
        {"category": ["customer_id", "category"], "customer": ["customer_id"]},
        null_safe=["category"],
    )
    named = shares.join(customer_names(t), "customer_id").join(supplier_agents(t), "supplier_id")
    rows = named.select(
        *buyers.keys, "category", "customer_name", "supplier_name", "supplier_inn", "supplier_kpp", "orders",
        "amount", "category_total", "customer_total", "category_pct", "customer_pct",
    ).distinct()
    return rows.orderBy(
        *[F.asc_nulls_last(c) for c in (*buyers.keys, "customer_name", "category")],
        F.desc_nulls_first("category_pct"),
        F.asc_nulls_last("supplier_name"),
    ).select(
        *buyers.keys, "category", "customer_name", "supplier_name", "supplier_inn", "supplier_kpp", "orders",
        F.round("amount", 2).alias("amount"),
        F.col("category_pct").alias("pct_of_category"),
        F.col("customer_pct").alias("pct_of_customer"),
    )


def _share_report(rows: DataFrame, t: Tables, keys: list[str]) -> DataFrame:
    named = rows.join(supplier_agents(t), "supplier_id").select(
        *keys, "category", "supplier_name", "supplier_inn", "supplier_kpp", "orders", "amount",
        "category_total", "category_pct", "network_pct",
    ).distinct()
    return named.orderBy(
        *[F.asc_nulls_last(c) for c in (*keys, "category")],
        F.desc_nulls_first("category_pct"),
        F.asc_nulls_last("supplier_name"),
    ).select(
        *keys, "category", "supplier_name", "supplier_inn", "supplier_kpp", "orders", "amount",
        F.col("category_pct").alias("pct_of_category"),
        F.col("network_pct").alias("pct_of_total"),
    )


def supplier_share_network(t: Tables, buyers: Buyers = Buyers()) -> DataFrame:
    """Each supplier's part of the network's spending, per category and in all."""
    per_supplier = read_whole(category_purchases(t, buyers, ["category", "supplier_id"]))
    return _share_report(_with_network_totals(per_supplier, per_supplier), t, [])


def _with_network_totals(rows: DataFrame, network: DataFrame) -> DataFrame:
    """Shares of the category and of everything; the totals have one row per category."""
    categories = network.groupBy("category").agg(F.sum("amount").alias("category_total"))
    totals = with_grand_total(categories, "category_total", "network_total")
    return with_percents(join_totals(rows, totals, ["category"], ["category"]), "amount", ["category", "network"])


def supplier_share_of_network_by_customer(
    t: Tables, excluded: tuple[int, ...] = (), only: tuple[int, ...] | None = None
) -> DataFrame:
    """One customer's spending against network-wide totals; only the totals leave customers out."""
    per_customer = read_whole(category_purchases(t, Buyers(split=True)))
    network = Buyers(excluded=excluded).keep(per_customer)
    own = Buyers(only=only).keep(per_customer)
    return _share_report(_with_network_totals(own, network), t, ["customer_id"])


def supply_cycles(t: Tables, since: date, buyers: Buyers = Buyers()) -> DataFrame:
    """How often and at what prices a customer buys a product from a supplier.

    Lines are reduced per (purchase, product, category) first; their sums are then weighted with
    the number of tied latest states of the purchase.
    """
    scope = Scope(Period(since), buyers.only)
    ties = latest_states(t, scope).groupBy("order_id").agg(F.count(F.lit(1)).alias("ties"))
    lines = items(t, scope).where((F.col("quantity") != 0) & (F.col("price") != 0)).select(
        "order_id", "product_name", "price", "quantity", line_amount().alias("amount"),
        F.col("fk_supplier_product_id").alias("entry_id"),
    )
    values = ["price", "quantity", "amount"]
    reduced = (
        left_join_spread(lines, product_categories(t).select("entry_id", "category"), "entry_id")
        .groupBy("order_id", "product_name", "category")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[f(v).alias(f"{name}_{v}") for v in values for name, f in (("sum", F.sum), ("max", F.max), ("min", F.min))],
        )
    )
    sides = contracts(t, buyers).select("contract_id", "customer_id", "supplier_id")
    named = (
        sides.join(customer_names(t).select("customer_id", "customer_name"), "customer_id")
        .join(supplier_agents(t).select("supplier_id", "supplier_name"), "supplier_id")
    )
    rows = (
        reduced.join(ties, "order_id")
        .join(purchases(t, scope).select("order_id", "contract_id", "created_when"), "order_id")
        .join(named, "contract_id")
    )
    keys = [*buyers.keys, "product_name", "customer_name", "supplier_name", "category"]
    weight = F.col("ties")
    totals = rows.groupBy(*keys).agg(
        F.min("created_when").alias("first_order_at"),
        F.max("created_when").alias("last_order_at"),
        F.countDistinct("order_id").alias("orders"),
        F.sum(F.col("n") * weight).alias("n"),
        *[F.sum(F.col(f"sum_{v}") * weight).alias(f"sum_{v}") for v in values],
        *[F.max(f"max_{v}").alias(f"max_{v}") for v in values],
        *[F.min(f"min_{v}").alias(f"min_{v}") for v in values],
    ).where(F.col("orders") > 1)
    cycle = seconds_between(F.col("first_order_at"), F.col("last_order_at")) / F.col("orders")
    return (
        totals.withColumn("cycle_seconds", cycle)
        .orderBy(
            *[F.asc_nulls_last(c) for c in (*buyers.keys, "customer_name")],
            F.desc_nulls_first("cycle_seconds"),
            F.asc_nulls_last("supplier_name"),
            F.asc_nulls_last("product_name"),
        )
        .select(
            *buyers.keys, "customer_name", "supplier_name", "product_name", "category", "first_order_at",
            "last_order_at", "orders", "cycle_seconds",
            *[mean(F.col(f"sum_{v}"), F.col("n")).alias(f"avg_{v}") for v in values],
            F.col("sum_quantity").alias("total_quantity"),
            F.round("sum_amount", 2).alias("total_amount"),
            *[F.round(f"{end}_{v}", 2).alias(f"{end}_{v}") for end in ("max", "min") for v in values],
        )
    )
