"""Purchase-grain reports: prepayment control, payment delay, stale and unclosed purchases."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderline.functions.buyers import Buyers
from tenderline.functions.dates import Period, age_in_days
from tenderline.functions.labels import ORDER_STATES, PAYMENT_TYPES, label
from tenderline.functions.numbers import parse_localised
from tenderline.operators.dedup import first_per
from tenderline.operators.joins import semi
from tenderline.operators.pairs import first_pair_and_latest
from tenderline.plans.frames import (
    PERSON,
    WHOLE,
    Scope,
    creators,
    grouped,
    latest_states,
    purchase_amounts,
    purchase_rows,
    parties,
    purchases,
    state_events,
    supplier_agents,
    within,
)
from tenderline.sources.tables import Tables

PURCHASE = ["order_number", "created_when", "customer_name", *PERSON, "supplier_name", "supplier_inn"]


def purchase_day() -> Column:
    return F.to_date("created_when").alias("order_date")


def state_text() -> Column:
    return label(F.col("state"), ORDER_STATES).alias("state")


def full_prepay_orders(t: Tables, as_of: date, buyers: Buyers = Buyers()) -> DataFrame:
    """Last month's purchases under contracts with full prepayment and no payment delay."""
    percent = F.col("pre_payment_percent")
    terms = (percent.isNull() | (percent == 100)) & F.col("pay_delay_days").isNull()
    rows = purchase_rows(t, buyers, Period.previous_month(as_of), terms=terms)
    keys = [*PURCHASE, "state", "pre_payment_percent"]
    totals = grouped(rows, keys, amount=F.sum("amount")).select(
        "order_number", purchase_day(), "customer_name", *PERSON, "supplier_name", "supplier_inn",
        "amount", "state", "pre_payment_percent",
    )
    picked = first_per(totals, ["order_number", "customer_name"], ["order_date"])
    return picked.withColumn("state", state_text())


def payment_changes(t: Tables, scope: Scope = WHOLE) -> DataFrame:
    """Per purchase: sum of the entered payments and the time of the last entry."""
    return (
        within(t.param_changes, t, scope)
        .where(F.col("parameter_name") == "customerPaymentSum")
        .groupBy("order_id")
        .agg(
            F.sum(parse_localised(F.col("new_value"))).alias("paid_sum"),
            F.max("at").alias("paid_changed_at"),
        )
    )


def partial_prepay_orders(t: Tables, as_of: date, buyers: Buyers = Buyers()) -> DataFrame:
    """Last month's purchases under partial prepayment, with what was paid so far."""
    period = Period.previous_month(as_of)
    terms = (F.col("payment_type") == "PARTIAL") & F.col("pre_payment_percent").isNotNull()
    paid = payment_changes(t, Scope(period, buyers.only))
    rows = purchase_rows(t, buyers, period, terms=terms, people=None, count_items=True).join(paid, "order_id", "left")
    keys = [
        "order_number", "created_when", "customer_name", "customer_inn", "supplier_name", "supplier_inn",
        "contract_number", "payment_type", "paid_sum", "paid_changed_at", "state", "state_at",
        "pre_payment_percent", "pay_delay_days", "customer_payment_sum",
    ]
    # An item belongs to one purchase, so its count may be taken per purchase and then added up.
    per_order = grouped(
        rows, [*keys, "order_id"], amount=F.sum("amount"), item_count=F.max("item_count")
    )
    totals = grouped(per_order, keys, amount=F.sum("amount"), item_count=F.sum("item_count")).select(
        purchase_day(), "customer_name", "customer_inn", "supplier_name", "supplier_inn", "order_number",
        "contract_number", "item_count", "payment_type", "amount", "paid_sum", "paid_changed_at",
        "state", "state_at", "pre_payment_percent", "pay_delay_days",
    )
    picked = first_per(totals, ["order_number", "customer_name"], ["order_date"])
    return picked.withColumns(
        {"state": state_text(), "payment_type": label(F.col("payment_type"), PAYMENT_TYPES)}
    ).orderBy(F.asc_nulls_last("order_number"), F.asc_nulls_last("customer_name"))


AGREED = ["order_id", "order_number", "created_when", "created_by", "contract_id", "pay_delay_days"]
PAYMENT_REQUESTED = ["PAYMENT", "PAYMENT_POSTFACTUM", "PARTIAL_POST_PAYMENT"]


def payment_events(t: Tables, scope: Scope = WHOLE) -> tuple[DataFrame, DataFrame]:
    """Events that ask for payment and events that record received money."""
    states = within(t.order_states, t, scope)
    asked = states.where(F.col("state").isin(PAYMENT_REQUESTED))
    received = states.where(F.col("state").like("%PAYMENT_RECEIVED%"))
    return asked, received


def payment_vs_delay(t: Tables, period: Period, buyers: Buyers = Buyers()) -> DataFrame:
    """Purchases where the money came a different number of days after the request than agreed.

    Of the differing pairs a purchase has, the earliest is shown.
    """
    scope = Scope(period, buyers.only)
    delays = t.contract.where(F.col("pay_delay_days").isNotNull())
    agreed = purchases(t, scope).join(delays.select(F.col("id").alias("contract_id"), "pay_delay_days"), "contract_id")
    agreed = agreed.select(*AGREED)
    state = F.col("state")
    off = first_pair_and_latest(
        state_events(t, agreed), AGREED, "pay_delay_days",
        starts=state.isin(PAYMENT_REQUESTED), ends=state.like("%PAYMENT_RECEIVED%"), detail=F.struct("state", "is_told"),
    )
    states = off.withColumn("newest", F.explode("newest")).where("newest.is_told").withColumn("state", F.col("newest.state"))
    rows = (
        states.join(purchase_amounts(t, scope), "order_id")
        .join(parties(t, buyers).drop("pay_delay_days"), "contract_id")
        .join(creators(t), "created_by")
    )
    keys = [*PURCHASE, "contract_number", "state", "pay_delay_days", "start_at", "end_at", "gap_days"]
    totals = grouped(rows, keys, amount=F.sum(F.col("amount") * F.col("weight"))).select(
        "order_number", "contract_number", purchase_day(), "customer_name", *PERSON, "supplier_name",
        "supplier_inn", "amount", "state", "pay_delay_days", "gap_days", "start_at", "end_at",
    )
    picked = first_per(totals, ["order_number", "customer_name"], ["start_at", "end_at", "contract_number"])
    return (
        picked.drop("start_at", "end_at")
        .withColumn("state", state_text())
        .orderBy(F.asc_nulls_last("customer_name"), F.asc_nulls_last("order_number"))
    )


def stale_orders(t: Tables, as_of: date, buyers: Buyers = Buyers(), min_days: int = 90) -> DataFrame:
    """Purchases neither closed nor cancelled whose latest state is at least ``min_days`` old."""
    states = latest_states(t, Scope(customers=buyers.only)).where(
        ~F.col("state").isin("ORDER_CLOSED", "ORDER_CANCELED")
        & (age_in_days(F.col("state_at"), as_of) >= min_days)
    )
    rows = purchase_rows(t, buyers, states=states)
    totals = grouped(rows, [*PURCHASE, "state", "state_at"], amount=F.sum("amount"))
    return totals.orderBy(
        F.asc_nulls_last("order_number"), F.asc_nulls_last("state_at"), F.asc_nulls_last("customer_name")
    ).select(
        "order_number", purchase_day(), "customer_name", *PERSON, "supplier_name", "supplier_inn",
        "amount", state_text(), "state_at",
    )


def unclosed_orders(t: Tables, buyers: Buyers = Buyers()) -> DataFrame:
    """Purchases whose latest state is not cancelled, closed or closed post factum."""
    finished = ["ORDER_CANCELED", "ORDER_CLOSED", "ORDER_CLOSED_POSTFACTUM"]
    states = latest_states(t, Scope(customers=buyers.only)).where(~F.col("state").isin(finished))
    rows = purchase_rows(t, buyers, states=states, people="left")
    keys = [*buyers.keys, *PURCHASE, "contract_number", "state", "state_at"]
    return (
        grouped(rows, keys, amount=F.sum("amount"))
        .orderBy(
            *[F.asc_nulls_last(c) for c in (*buyers.keys, "customer_name", "order_number", "state_at")]
        )
        .select(
            *buyers.keys, "order_number", "contract_number", purchase_day(), "customer_name", *PERSON,
            "supplier_name", "supplier_inn", "amount", state_text(), "state_at",
        )
    )


def dual_role_agents(t: Tables, as_of: date, buyers: Buyers = Buyers()) -> DataFrame:
    """Last month's purchases from suppliers whose INN also belongs to a customer."""
    customer_inns = t.agent.where(F.col("fk_customer_id").isNotNull()).select(F.col("inn").alias("supplier_inn"))
    both = semi(supplier_agents(t), customer_inns, "supplier_inn")
    rows = purchase_rows(t, buyers, Period.previous_month(as_of), suppliers=both)
    totals = grouped(rows, [*PURCHASE, "state", "state_at"], amount=F.sum("amount"))
    return totals.orderBy(
        F.asc_nulls_last("order_number"), F.asc_nulls_last("state_at"), F.asc_nulls_last("customer_name")
    ).select(
        "order_number", purchase_day(), "customer_name", *PERSON, "supplier_name", "supplier_inn",
        "amount", "state", "state_at",
    )
