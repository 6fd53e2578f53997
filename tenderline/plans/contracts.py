"""Contract reports: advance payment and long terms."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderline.functions.buyers import Buyers
from tenderline.functions.dates import Period, moment
from tenderline.functions.labels import ADVANCE_PAYMENT_TYPES, CONTRACT_STATES, SUPPLIER_STATES, label
from tenderline.operators.groups import concat_repeated, concat_sorted
from tenderline.operators.joins import null_safe_join
from tenderline.operators.latest import latest
from tenderline.plans.frames import (
    contracts,
    customer_names,
    latest_supplier_states,
    supplier_agents,
    supplier_categories,
)
from tenderline.plans.suppliers import PERSON, creator_companies, user_staff
from tenderline.sources.tables import Tables


def payment_text() -> Column:
    return label(F.col("payment_type"), ADVANCE_PAYMENT_TYPES).alias("payment_type")


def is_active(as_of: date | datetime) -> Column:
    """Open-ended, or not ended before the day or instant; a contract ends at the midnight its last day begins with."""
    return F.col("to_date").isNull() | (F.col("to_date") >= moment(as_of))


def advance_contracts(t: Tables, as_of: date, buyers: Buyers = Buyers()) -> DataFrame:
    """Partial-prepayment contracts per customer, percent and number of active contracts.

    The active number is taken per category, so categories with different numbers give
    different rows.
    """
    partial = contracts(t, buyers).where(F.col("payment_type") == "PARTIAL")
    rows = partial.join(supplier_categories(t), "supplier_id", "left").select(
        "contract_id", "customer_id", "payment_type", "pre_payment_percent", "category", "to_date"
    )
    active = (
        rows.where(is_active(as_of))
        .groupBy("customer_id", "pre_payment_percent", "category")
        .agg(F.countDistinct("contract_id").alias("active_contracts"))
    )
    joined = null_safe_join(rows, active, ["customer_id", "pre_payment_percent"], ["category"])
    named = joined.join(customer_names(t).select("customer_id", "customer_name"), "customer_id")
    return (
        named.groupBy("customer_id", "customer_name", "payment_type", "pre_payment_percent", "active_contracts")
        .agg(F.countDistinct("contract_id").alias("contracts"), concat_sorted(F.col("category")).alias("categories"))
        .orderBy(
            *[F.asc_nulls_last(c) for c in (*buyers.keys, "customer_name")],
            F.desc_nulls_first("pre_payment_percent"),
            F.asc_nulls_last("active_contracts"),
        )
        .select(
            *buyers.keys, "customer_name", "contracts", "active_contracts", payment_text(),
            "pre_payment_percent", "categories",
        )
    )


def advance_contract_detail(t: Tables, as_of: date, buyers: Buyers = Buyers()) -> DataFrame:
    """Active partial-prepayment contracts with supplier and its categories."""
    rows = (
        contracts(t, buyers)
        .where((F.col("payment_type") == "PARTIAL") & is_active(as_of))
        .join(customer_names(t).select("customer_id", "customer_name"), "customer_id")
        .join(supplier_agents(t).select("supplier_id", "supplier_name"), "supplier_id")
        .join(_declared_categories(t), "supplier_id")
    )
    keys = [
        *buyers.keys, "customer_name", "supplier_name", "contract_number", "from_date", "to_date",
        "payment_type", "pre_payment_percent",
    ]
    return (
        rows.groupBy(*keys)
        .agg(concat_sorted(F.col("category")).alias("categories"))
        .withColumn("payment_type", payment_text())
        .orderBy(
            *[F.asc_nulls_last(c) for c in (*buyers.keys, "customer_name")],
            F.desc_nulls_first("pre_payment_percent"),
            F.asc_nulls_last("contract_number"),
        )
    )


def _declared_categories(t: Tables) -> DataFrame:
    """Categories of suppliers whose group exists."""
    groups = t.product_group.select(F.col("id").alias("fk_product_group_id"), F.col("name").alias("category"))
    return (
        t.supplier_product_groups.join(groups, "fk_product_group_id")
        .select(F.col("fk_supplier_id").alias("supplier_id"), "category")
        .distinct()
    )


SUPPLIER = ["supplier_id", "supplier_name", "supplier_inn", "supplier_kpp", "registered_at", "supplier_state"]


def created_suppliers(t: Tables) -> DataFrame:
    """Suppliers with latest state and category; ``times`` counts the creators and companies found."""
    entities = t.agent.where(F.col("fk_supplier_id").isNotNull()).select(
        F.col("fk_supplier_id").alias("supplier_id"),
        F.col("name").alias("supplier_name"),
        F.col("inn").alias("supplier_inn"),
        F.col("kpp").alias("supplier_kpp"),
        F.col("created_when").alias("registered_at"),
        "created_by",
    )
    people = creator_companies(t, user_staff(t), "inner").select("created_by", *PERSON, "company").distinct()
    known = t.supplier.select(F.col("id").alias("supplier_id"))
    rows = (
        entities.join(known, "supplier_id")
        .join(latest_supplier_states(t), "supplier_id")
        .join(people, "created_by")
        .select(*SUPPLIER, *PERSON, "company")
        .distinct()
        .groupBy(*SUPPLIER)
        .agg(F.count(F.lit(1)).alias("times"))
    )
    return rows.join(supplier_categories(t), "supplier_id", "left")


def long_contracts(t: Tables, as_of: date, buyers: Buyers = Buyers()) -> DataFrame:
    """Contracts not deleted that run over a year and end after last month began, or have no end."""
    start = Period.previous_month(as_of).first
    long_term = F.datediff("to_date", "from_date") > 366
    kept = contracts(t, buyers).where(
        (long_term & (F.to_date("to_date") > F.lit(start))) | F.col("to_date").isNull()
    )
    states = latest(t.contract_event, "fk_contract_id", "created_when").select(
        F.col("fk_contract_id").alias("contract_id"), "contract_state"
    )
    rows = (
        kept.join(states.where(F.col("contract_state") != "DELETED"), "contract_id")
        .join(customer_names(t).select("customer_id", "customer_name"), "customer_id")
        .join(created_suppliers(t), "supplier_id")
    )
    keys = [
        *buyers.keys, "customer_name", "contract_number", "from_date", "to_date", "contract_state",
        *SUPPLIER[1:],
    ]
    texts = concat_repeated(rows, keys, "category", "times").withColumnRenamed("category", "categories")
    return texts.withColumns(
        {
            "contract_state": label(F.col("contract_state"), CONTRACT_STATES),
            "supplier_state": label(F.col("supplier_state"), SUPPLIER_STATES),
        }
    ).orderBy(*[F.asc_nulls_last(c) for c in (*buyers.keys, "customer_name", "contract_number", "supplier_name")])
