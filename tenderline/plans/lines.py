"""Line-grain reports: zero-VAT lines and lines by directorate."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderline.functions.buyers import Buyers
from tenderline.functions.dates import Period
from tenderline.functions.labels import ORDER_STATES, label, tax_label
from tenderline.functions.numbers import line_amount
from tenderline.operators.joins import left_join_spread
from tenderline.plans.frames import (
    PERSON,
    Scope,
    grouped,
    items,
    purchase_rows,
    product_categories,
    product_categories_direct,
)
from tenderline.sources.tables import Tables

LINE = [
    "order_number", "contract_number", "contract_id", "created_when", "customer_name", *PERSON,
    "supplier_name", "supplier_inn", "price", "quantity", "tax_percent", "product_name", "category", "state",
]


def _lines(t: Tables, scope: Scope) -> DataFrame:
    return items(t, scope).select(
        "order_id", "price", "quantity", "product_name", F.col("fk_supplier_product_id").alias("entry_id")
    )


def _report(rows: DataFrame, extra: list[str], order_number, with_contract_id: bool) -> DataFrame:
    totals = grouped(rows, [*extra, *LINE], amount=F.sum(line_amount()))
    shown = totals.select(
        *extra,
        order_number.alias("order_number"),
        "contract_number",
        *(["contract_id"] if with_contract_id else []),
        F.to_date("created_when").alias("order_date"),
        "customer_name", *PERSON, "supplier_name", "supplier_inn", "price", "quantity", "amount",
        tax_label(F.col("tax_percent")).alias("tax_percent"),
        "product_name", "category",
        label(F.col("state"), ORDER_STATES).alias("state"),
    )
    keys = [*extra, "order_number", "customer_name", "product_name", "price", "quantity"]
    return shown.orderBy(*[F.asc_nulls_last(k) for k in keys])


def zero_vat_lines(t: Tables, as_of: date, buyers: Buyers = Buyers()) -> DataFrame:
    """Last month's lines with a VAT rate of zero."""
    period = Period.previous_month(as_of)
    untaxed = product_categories(t).where(F.col("tax_percent") == 0)
    lines = _lines(t, Scope(period, buyers.only)).join(untaxed, "entry_id")
    rows = purchase_rows(t, buyers, period, amounts=False).join(lines, "order_id")
    return _report(rows, buyers.keys, F.col("order_number"), with_contract_id=False)


def lines_by_directorate(t: Tables, as_of: date) -> DataFrame:
    """Last month's lines of every mapped customer, one directorate value per output part."""
    period = Period.previous_month(as_of)
    mapped = t.directorate.select("customer_id", "directorate").distinct()
    lines = left_join_spread(_lines(t, Scope(period)), product_categories_direct(t), "entry_id")
    rows = purchase_rows(t, Buyers(), period, amounts=False).join(mapped, "customer_id").join(lines, "order_id")
    return _report(rows, ["directorate"], F.col("order_number").cast("bigint"), with_contract_id=True)
