"""Supplier reports: duplicate registrations and purchases from them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderline.functions.buyers import Buyers, not_in
from tenderline.functions.dates import Period
from tenderline.functions.labels import ORDER_STATES, REGISTRY_STAGES, label
from tenderline.operators.groups import members_of_groups
from tenderline.operators.joins import either_key_join, semi
from tenderline.plans.frames import (
    PERSON,
    contracts,
    grouped,
    latest_registrations,
    latest_supplier_states,
    purchase_rows,
    supplier_agents,
)
from tenderline.sources.tables import Tables


def duplicate_agents(t: Tables) -> DataFrame:
    """Supplier entities whose INN is shared by 2 to 9 of them."""
    return members_of_groups(supplier_agents(t), "supplier_inn", "supplier_agent_id", 2, 9).drop("group_size")


def creator_companies(t: Tables, people: DataFrame, how: str) -> DataFrame:
    """People with every entity that shares their customer or their supplier id."""
    companies = t.agent.select(
        F.col("fk_customer_id").alias("company_customer_id"),
        F.col("fk_supplier_id").alias("company_supplier_id"),
        F.col("name").alias("company"),
    )
    return either_key_join(
        people,
        companies,
        ("fk_customer_id", "company_customer_id"),
        ("fk_supplier_id", "company_supplier_id"),
        how,
    )


def user_staff(t: Tables) -> DataFrame:
    users = t.user_s.select(F.col("id").alias("user_id"), F.col("user_name").alias("created_by"))
    staff = t.employee.select(F.col("fk_user_id").alias("user_id"), *PERSON, "fk_customer_id", "fk_supplier_id")
    return users.join(staff, "user_id").drop("user_id")


def supplier_activity(t: Tables, suppliers: DataFrame) -> DataFrame:
    """Contracts, purchases and last purchase per supplier, purchases reduced per contract first."""
    per_contract = t.order_s.groupBy(F.col("fk_contract_id").alias("contract_id")).agg(
        F.count(F.lit(1)).alias("orders"), F.max("created_when").alias("last_order_at")
    )
    return (
        semi(contracts(t), suppliers, "supplier_id")
        .join(per_contract, "contract_id", "left")
        .groupBy("supplier_id")
        .agg(
            F.count(F.lit(1)).alias("contracts"),
            F.sum("orders").alias("orders"),
            F.max("last_order_at").alias("last_order_at"),
        )
    )


def duplicate_suppliers(t: Tables, excluded_mails: Sequence[str] = ()) -> DataFrame:
    """Suppliers registered more than once, with who registered them and what they sell."""
    people = user_staff(t).where(F.col("mail").isNotNull() & not_in(F.col("mail"), excluded_mails))
    who = creator_companies(t, people, "left").select("created_by", *PERSON, F.col("company").alias("creator_company"))
    registered = t.supplier.select(
        F.col("id").alias("supplier_id"), F.col("created_when").alias("registered_at"), "created_by"
    )
    stages = latest_registrations(t)
    doubles = duplicate_agents(t)
    rows = (
        doubles.join(latest_supplier_states(t), "supplier_id")
        .join(stages, "supplier_id")
        .join(registered, "supplier_id")
        .join(who, "created_by")
    )
    keys = [
        "supplier_name", "registered_at", "supplier_inn", "supplier_kpp", "supplier_state", *PERSON,
        "creator_company", "stage",
    ]
    # Repeats of a supplier come from the joins only; a contract belongs to one supplier, so the
    # distinct counts are sums over distinct suppliers.
    once = rows.select("supplier_id", *keys).distinct()
    totals = once.join(supplier_activity(t, doubles), "supplier_id", "left").groupBy(*keys).agg(
        F.coalesce(F.sum("orders"), F.lit(0)).alias("orders"),
        F.coalesce(F.sum("contracts"), F.lit(0)).alias("contracts"),
        F.max("last_order_at").alias("last_order_at"),
    )
    return totals.withColumn("stage", label(F.col("stage"), REGISTRY_STAGES)).orderBy(
        *[F.asc_nulls_last(c) for c in ("supplier_inn", "supplier_name", "mail", "creator_company")]
    )


def orders_of_duplicate_suppliers(t: Tables, as_of: date, buyers: Buyers = Buyers()) -> DataFrame:
    """Last month's purchases from suppliers registered more than once."""
    stated = semi(duplicate_agents(t), t.supplier_states, "supplier_id").distinct()
    rows = purchase_rows(t, buyers, Period.previous_month(as_of), suppliers=stated)
    keys = [
        *buyers.keys, "order_number", "created_when", "customer_name", *PERSON, "supplier_name",
        "supplier_inn", "supplier_kpp", "state", "state_at",
    ]
    return (
        grouped(rows, keys, amount=F.sum("amount"))
        .orderBy(*[F.asc_nulls_last(c) for c in (*buyers.keys, "supplier_name", "order_number", "state_at")])
        .select(
            *buyers.keys, "order_number", F.to_date("created_when").alias("order_date"), "customer_name",
            *PERSON, "supplier_name", "supplier_inn", "supplier_kpp", "amount",
            label(F.col("state"), ORDER_STATES).alias("state"), "state_at",
        )
    )
