"""The shared operators on their own, each over whole tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderline.functions.buyers import Buyers
from tenderline.functions.dates import in_previous_month
from tenderline.functions.labels import ORDER_STATES, label, tax_label
from tenderline.operators.buckets import bucket_counts
from tenderline.operators.dedup import first_per
from tenderline.operators.groups import concat_sorted, cycle_seconds, members_of_groups
from tenderline.operators.joins import null_safe_join, semi
from tenderline.operators.pairs import first_pair_off_gap, pair_totals
from tenderline.operators.shares import read_whole, share
from tenderline.operators.weekly import weekly_matrix
from tenderline.plans.frames import (
    WHOLE,
    contracts,
    latest_states,
    latest_states_flagged,
    purchase_amounts,
    purchases,
    supplier_agents,
    supplier_categories,
)
from tenderline.plans.orders import payment_changes, payment_events
from tenderline.plans.shares import category_purchases
from tenderline.plans.suppliers import creator_companies, user_staff
from tenderline.plans.totals import DASHBOARD_BUCKETS, purchase_facts, weekly_facts
from tenderline.session import scratch_folder
from tenderline.sources.sinks import with_name, write_by
from tenderline.sources.tables import Tables


def latest_state(t: Tables) -> DataFrame:
    return latest_states(t)


def without_some_details(t: Tables) -> Tables:
    """The same log with a seventh of the state changes left without their details."""
    return t.replace(order_state_event=t.order_state_event.where("event_id % 7 <> 3"))


def latest_any_type(t: Tables) -> DataFrame:
    """Newest events of any type that are state changes."""
    newest = latest_states_flagged(t).where("is_newest")
    return newest.select("order_id", F.col("state_at").alias("at"), "state")


def dedup_first(t: Tables) -> DataFrame:
    return first_per(t.order_item, ["id"], ["price", "quantity"])


def previous_month(t: Tables, as_of: date) -> DataFrame:
    return in_previous_month(purchases(t), "created_when", as_of).select("order_id", "order_number", "created_when")


def _with_customer(t: Tables, rows: DataFrame) -> DataFrame:
    return rows.join(contracts(t).select("contract_id", "customer_id", "supplier_id"), "contract_id")


def weekly(t: Tables, as_of: date) -> DataFrame:
    facts, bought = weekly_facts(t, as_of)
    return weekly_matrix(
        _with_customer(t, facts), ["customer_id"], "created_when", as_of, counts=["orders"],
        sums={"amount": F.col("amount")}, all_keys=_with_customer(t, bought),
    )


def status_buckets(t: Tables) -> DataFrame:
    facts = _with_customer(t, purchase_facts(t, DASHBOARD_BUCKETS, WHOLE, need_items=True))
    return bucket_counts(facts, ["customer_id"], list(DASHBOARD_BUCKETS))


def share_of_total(t: Tables) -> DataFrame:
    within = {"category": ["customer_id", "category"], "customer": ["customer_id"], "network": []}
    return share(category_purchases(t, Buyers()), "amount", within, null_safe=["category"])


def duplicate_groups(t: Tables) -> DataFrame:
    members = members_of_groups(supplier_agents(t), "supplier_inn", "supplier_agent_id", 2, 9)
    return members.select("supplier_agent_id", "supplier_inn", "group_size")


def shared_key_semi(t: Tables) -> DataFrame:
    inns = t.agent.where(F.col("fk_customer_id").isNotNull()).select(F.col("inn").alias("supplier_inn"))
    return semi(supplier_agents(t), inns, "supplier_inn")


def either_key(t: Tables) -> DataFrame:
    return creator_companies(t, user_staff(t), "left").select(
        "created_by", "mail", "company_customer_id", "company_supplier_id", "company"
    )


def null_safe(t: Tables) -> DataFrame:
    rows = read_whole(category_purchases(t, Buyers(), ["category", "supplier_id"]).select("category", "supplier_id", "amount"))
    sizes = rows.groupBy("category").agg(F.count(F.lit(1)).alias("category_suppliers"))
    return null_safe_join(rows, sizes, [], ["category"])


def event_pairs(t: Tables) -> DataFrame:
    asked, received = payment_events(t)
    agreed = (
        purchases(t)
        .join(t.contract.select(F.col("id").alias("contract_id"), "pay_delay_days"), "contract_id")
        .where(F.col("pay_delay_days").isNotNull())
        .select("order_id", "pay_delay_days")
    )
    totals = pair_totals(asked, received, agreed, "order_id", "pay_delay_days")
    first = first_pair_off_gap(asked, received, agreed, "order_id", "pay_delay_days").drop("pay_delay_days")
    return totals.join(first, "order_id", "left")


def parse_amounts(t: Tables) -> DataFrame:
    return payment_changes(t)


def group_concat(t: Tables) -> DataFrame:
    return supplier_categories(t).groupBy("supplier_id").agg(concat_sorted(F.col("category")).alias("categories"))


def cycle_length(t: Tables) -> DataFrame:
    return cycle_seconds(_with_customer(t, purchases(t)), ["customer_id", "supplier_id"], "created_when", "order_id")


def code_labels(t: Tables) -> DataFrame:
    states = t.order_states.select(
        F.col("order_id").alias("id"), label(F.col("state"), ORDER_STATES).alias("text")
    )
    rates = t.suppliers_product.select("id", tax_label(F.col("tax_percent")).alias("text"))
    return states.unionByName(rates)


def partitioned_export(t: Tables) -> DataFrame:
    """Purchases of mapped customers written one folder per directorate, then read back."""
    rows = _with_customer(t, purchases(t).join(purchase_amounts(t), "order_id"))
    mapped = rows.join(t.directorate.distinct(), "customer_id").select(
        "directorate", "customer_id", "order_id", "amount"
    )
    spark = mapped.sparkSession
    path = scratch_folder(spark)
    write_by(with_name(mapped, t.agent), "directorate", path)
    return spark.read.parquet(path)
