"""Every report and stand-alone operator by name, as a function of the tables and parameters."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderline.functions.buyers import Buyers
from tenderline.functions.dates import Period
from tenderline.plans import contracts, lines, operator_queries, orders, shares, suppliers, totals
from tenderline.sources.tables import Tables


@dataclass(frozen=True)
class Params:
    """What a run of the report pack is asked for."""

    month_as_of: date
    as_of: date
    weeks_as_of: date
    payments: Period
    cycles_since: date
    excluded: tuple[int, ...] = ()
    listed: tuple[int, ...] | None = None
    excluded_mails: tuple[str, ...] = ()
    # Lists of single reports: rows of (report, role, customer_id) with the roles "excluded" and "listed".
    lists: DataFrame | None = None

    @property
    def network(self) -> Buyers:
        return Buyers(excluded=self.excluded)

    @property
    def each(self) -> Buyers:
        """The by-customer jobs cover the listed customers (all when None), without exclusions."""
        return Buyers(only=self.listed, split=True)

    def of(self, report: str, declared: frozenset[str]) -> Params:
        """The parameters as ``report`` takes them: the lists it declares come from the table of lists."""
        if self.lists is None:
            return self
        own = lambda role: self.lists.where((F.col("report") == report) & (F.col("role") == role)).select("customer_id")
        return replace(self, **{role: own(role) for role in declared})


Query = Callable[[Tables, Params], DataFrame]

REPORTS: dict[str, Query] = {
    "r01_full_prepay_orders": lambda t, p: orders.full_prepay_orders(t, p.month_as_of, p.network),
    "r02_partial_prepay_orders": lambda t, p: orders.partial_prepay_orders(t, p.month_as_of, p.network),
    "r03_payment_vs_delay": lambda t, p: orders.payment_vs_delay(t, p.payments, p.network),
    "r04_stale_orders": lambda t, p: orders.stale_orders(t, p.as_of, p.network),
    "r05_zero_vat_lines": lambda t, p: lines.zero_vat_lines(t, p.month_as_of, p.network),
    "r06_customer_totals": lambda t, p: totals.customer_totals(t, p.network),
    "r07_customer_totals_period": lambda t, p: totals.customer_totals_period(t, p.month_as_of, p.network),
    "r08_lines_by_directorate": lambda t, p: lines.lines_by_directorate(t, p.month_as_of),
    "r09_duplicate_suppliers": lambda t, p: suppliers.duplicate_suppliers(t, p.excluded_mails),
    "r09_orders_duplicate_suppliers": lambda t, p: suppliers.orders_of_duplicate_suppliers(
        t, p.month_as_of, p.network
    ),
    "r10_weekly_matrix": lambda t, p: totals.weekly_activity(t, p.weeks_as_of, Buyers(only=p.listed)),
    "r11_dual_role_agents": lambda t, p: orders.dual_role_agents(t, p.month_as_of, p.network),
    "r12_status_dashboard": lambda t, p: totals.status_dashboard(t, p.month_as_of, p.network),
    "r14_supplier_share_by_customer": lambda t, p: shares.supplier_share_by_customer(t, p.network),
    "r15_advance_contracts": lambda t, p: contracts.advance_contracts(t, p.as_of, p.network),
    "r15_1_advance_contract_detail": lambda t, p: contracts.advance_contract_detail(t, p.as_of, p.network),
    "r16_unclosed_summary": lambda t, p: totals.unclosed_summary(t, p.network),
    "r16_1_unclosed_detail": lambda t, p: orders.unclosed_orders(t, p.network),
    "r17_long_contracts": lambda t, p: contracts.long_contracts(t, p.as_of, p.network),
    "r18_supply_cycles": lambda t, p: shares.supply_cycles(t, p.cycles_since, p.network),
    "r19_supplier_share_network": lambda t, p: shares.supplier_share_network(t, p.network),
}

BY_CUSTOMER: dict[str, Query] = {
    "r05_by_customer": lambda t, p: lines.zero_vat_lines(t, p.month_as_of, p.each),
    "r06_by_customer": lambda t, p: totals.customer_totals(t, p.each),
    "r09_orders_by_customer": lambda t, p: suppliers.orders_of_duplicate_suppliers(t, p.month_as_of, p.each),
    # Only this one keeps the exclusion list, so an excluded customer has no part.
    "r14_by_customer": lambda t, p: shares.supplier_share_by_customer(t, replace(p.each, excluded=p.excluded)),
    "r15_by_customer": lambda t, p: contracts.advance_contracts(t, p.as_of, p.each),
    "r15_1_by_customer": lambda t, p: contracts.advance_contract_detail(t, p.as_of, p.each),
    "r16_by_customer": lambda t, p: totals.unclosed_summary(t, p.each),
    "r16_1_by_customer": lambda t, p: orders.unclosed_orders(t, p.each),
    "r17_by_customer": lambda t, p: contracts.long_contracts(t, p.as_of, p.each),
    "r18_by_customer": lambda t, p: shares.supply_cycles(t, p.cycles_since, p.each),
    "r19_by_customer": lambda t, p: shares.supplier_share_of_network_by_customer(t, p.excluded, p.listed),
}

OPERATORS: dict[str, Query] = {
    "op_latest_state": lambda t, p: operator_queries.latest_state(t),
    "op_latest_any_type": lambda t, p: operator_queries.latest_any_type(t),
    "op_dedup_first": lambda t, p: operator_queries.dedup_first(t),
    "op_previous_month": lambda t, p: operator_queries.previous_month(t, p.month_as_of),
    "op_weekly_matrix": lambda t, p: operator_queries.weekly(t, p.weeks_as_of),
    "op_status_buckets": lambda t, p: operator_queries.status_buckets(t),
    "op_share_of_total": lambda t, p: operator_queries.share_of_total(t),
    "op_duplicate_groups": lambda t, p: operator_queries.duplicate_groups(t),
    "op_shared_key_semi": lambda t, p: operator_queries.shared_key_semi(t),
    "op_either_key_join": lambda t, p: operator_queries.either_key(t),
    "op_null_safe_join": lambda t, p: operator_queries.null_safe(t),
    "op_event_pairs": lambda t, p: operator_queries.event_pairs(t),
    "op_parse_amounts": lambda t, p: operator_queries.parse_amounts(t),
    "op_group_concat": lambda t, p: operator_queries.group_concat(t),
    "op_cycle_length": lambda t, p: operator_queries.cycle_length(t),
    "op_code_labels": lambda t, p: operator_queries.code_labels(t),
    "op_partitioned_export": lambda t, p: operator_queries.partitioned_export(t),
}

QUERIES: dict[str, Query] = {**REPORTS, **BY_CUSTOMER, **OPERATORS}

EXCLUDED, LISTED = frozenset({"excluded"}), frozenset({"listed"})
# Which lists a report takes from a table of lists; all others keep the common parameters.
LISTS: dict[str, frozenset[str]] = {
    **{name: EXCLUDED for name in REPORTS if name not in ("r08_lines_by_directorate", "r09_duplicate_suppliers", "r10_weekly_matrix")},
    "r10_weekly_matrix": LISTED,
    **{name: LISTED for name in BY_CUSTOMER},
    "r14_by_customer": LISTED | EXCLUDED,
    "r19_by_customer": LISTED | EXCLUDED,
}


def run_report(name: str, t: Tables, params: Params) -> DataFrame:
    """A report with its own lists."""
    return QUERIES[name](t, params.of(name, LISTS.get(name, frozenset())))


def _half_of_the_customers(t: Tables, report: str) -> DataFrame:
    """A list derived from the customers, above 500 ids from 1,000 customers on; nobody is excluded but the common three."""
    some = t.customer.where(F.col("id") % 10 < 5).select(F.lit("listed").alias("role"), F.col("id").alias("customer_id"))
    none = t.customer.where(F.col("id").isin(7, 77, 777)).select(F.lit("excluded").alias("role"), F.col("id").alias("customer_id"))
    return some.unionByName(none).withColumn("report", F.lit(report))


def _listed(name: str) -> Query:
    return lambda t, p: run_report(name, t, replace(p, lists=_half_of_the_customers(t, name)))


# Reports with lists of their own, and newest events where details are missing.
MORE: dict[str, Query] = {
    **{f"{name}_listed": _listed(name) for name in ("r10_weekly_matrix", *BY_CUSTOMER)},
    "op_latest_state_log": lambda t, p: operator_queries.latest_state(operator_queries.without_some_details(t)),
    "op_latest_any_type_log": lambda t, p: operator_queries.latest_any_type(operator_queries.without_some_details(t)),
}

# The parameters of the registered queries.
SAMPLE = Params(
    month_as_of=date(2001, 7, 15),
    as_of=date(2001, 8, 2),
    weeks_as_of=date(2001, 8, 1),
    payments=Period(date(2001, 1, 1), date(2001, 6, 30)),
    cycles_since=date(1999, 1, 1),
    excluded=(7, 77, 777),
    excluded_mails=("user3@example.org", "user41@example.org"),
)
