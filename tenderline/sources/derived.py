"""The procurement tables derived from the star-schema test tables by fixed formulas.

Every row comes from the given Parquet files, so the work grows with them. Events are laid as they
are stored: a log of all types and one child table of details per type. Both come from ``event_log``,
which has the details beside the log; a filter on ``event_type`` lets the optimizer drop the branches
a report does not read.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderline.functions.labels import CONTRACT_STATES, ORDER_STATES, REGISTRY_STAGES
from tenderline.sources.tables import EVENT_VIEWS, KINDS, Kind, Tables

STAR = {
    "customer": "c_custkey bigint, c_name string",
    "supplier": "s_suppkey bigint, s_name string",
    "part": "p_partkey bigint, p_name string, p_type string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double",
}

# Offsets that keep the id spaces of the derived entities apart.
SUPPLIER_IDS = 100_000_000
CONTRACT_IDS = 200_000_000
SECOND_AGENT_IDS = 300_000_000
SUPPLIER_STATE_IDS = 5_000_000_000
REGISTRATION_IDS = 6_000_000_000


def _pick(words: Iterable[str], index: str) -> str:
    listed = ", ".join(f"'{w}'" for w in words)
    return f"element_at(array({listed}), cast(({index}) + 1 as int))"


def _later(start: str, days: str) -> str:
    return f"timestampadd(DAY, cast({days} as int), {start})"


def _shared_inn(group: str) -> str:
    return f"concat('7', lpad(cast({group} as string), if({group} % 4 = 0, 11, 9), '0'))"


def derive(spark: SparkSession, sf_dir: str) -> Tables:
    def star(name: str) -> DataFrame:
        return spark.read.schema(STAR[name]).parquet(f"{sf_dir}/{name}.parquet")

    def supplier_count() -> DataFrame:
        return star("supplier").agg(F.count(F.lit(1)))

    def order_s(_: Tables) -> DataFrame:
        return star("orders").selectExpr(
            "o_orderkey as id",
            "cast(o_orderkey as string) as order_number",
            "o_orderdate as created_when",
            "concat('user', cast(o_orderkey % 50 as string)) as created_by",
            f"{CONTRACT_IDS} + o_custkey * 3 + o_orderkey % 3 as fk_contract_id",
            "cast(null as decimal(18,2)) as customer_payment_sum",
        )

    def order_item(_: Tables) -> DataFrame:
        lines = star("lineitem").join(star("part"), F.col("l_partkey") == F.col("p_partkey"))
        return lines.selectExpr(
            "l_orderkey * 10 + l_linenumber as id",
            "l_orderkey as fk_order_id",
            "cast(if(l_orderkey % 20 = 0 and l_linenumber = 7, 0, l_extendedprice) as decimal(18,2)) as price",
            "cast(l_quantity as decimal(10,0)) as quantity",
            "p_name as product_name",
            "if(l_partkey % 97 <> 0, l_partkey, null) as fk_supplier_product_id",
        )

    def contract(_: Tables) -> DataFrame:
        start = "date_add(date'2000-01-01', cast(c % 300 as int))"
        return (
            star("customer")
            .selectExpr("c_custkey as c", "explode(array(0, 1, 2)) as i")
            .withColumn("n_suppliers", supplier_count().scalar())
            .selectExpr(
                f"{CONTRACT_IDS} + c * 3 + i as id",
                "concat('C-', cast(c * 3 + i as string)) as contract_number",
                "c as fk_customer_id",
                f"{SUPPLIER_IDS} + (c * 7 + i * 31) % n_suppliers as fk_supplier_id",
                f"{_pick(('FULL', 'PARTIAL', 'POSTPAY'), '(c + i) % 3')} as payment_type",
                "case (c + i) % 3 when 0 then if(c % 2 = 0, 100, null)"
                " when 1 then element_at(array(30, 50, 70, null), cast(c % 4 + 1 as int)) end as pre_payment_percent",
                "case (c + i) % 3 when 1 then if(c % 5 = 0, 10, null)"
                " when 2 then if(c % 2 = 0, 14, 30) end as pay_delay_days",
                f"{start} as from_date",
                f"case (c + i) % 5 when 0 then null when 1 then date_add({start}, 730)"
                f" else date_add({start}, 365) end as to_date",
            )
        )

    def contract_event(_: Tables) -> DataFrame:
        return (
            star("customer")
            .selectExpr("c_custkey as c", "explode(array(0, 1, 2)) as i")
            .selectExpr("c", "c * 3 + i as x", "explode(sequence(0L, (c * 3 + i) % 2)) as r")
            .selectExpr(
                f"{CONTRACT_IDS} + x as fk_contract_id",
                f"{_pick(CONTRACT_STATES, '(x + 2 * r) % 6')} as contract_state",
                f"{_later('timestamp_ntz' + repr('2000-01-01'), '(c % 300 + 15 * r)')} as created_when",
            )
        )

    def customer(_: Tables) -> DataFrame:
        return star("customer").selectExpr("c_custkey as id")

    def supplier(_: Tables) -> DataFrame:
        return star("supplier").selectExpr(
            f"{SUPPLIER_IDS} + s_suppkey as id",
            f"{_later('timestamp_ntz' + repr('1993-01-01'), '(s_suppkey % 365)')} as created_when",
            "concat('user', cast(s_suppkey % 50 as string)) as created_by",
        )

    def agent(_: Tables) -> DataFrame:
        def of_customer(ident: str, inn: str) -> list[str]:
            return [
                f"{ident} as id",
                "c_name as name",
                f"{inn} as inn",
                "cast(null as string) as kpp",
                "c_custkey as fk_customer_id",
                "cast(null as bigint) as fk_supplier_id",
                "timestamp_ntz'1993-01-01' as created_when",
                "'user0' as created_by",
            ]

        own_inn = "concat('9', lpad(cast(c_custkey as string), 9, '0'))"
        group = "(c_custkey div 50)"
        buyers = star("customer").selectExpr(
            *of_customer("c_custkey", f"if(c_custkey % 50 = 0, {_shared_inn(group)}, {own_inn})")
        )
        seconds = (
            star("customer")
            .where("c_custkey % 200 = 1")
            .selectExpr(
                *of_customer(
                    f"{SECOND_AGENT_IDS} + c_custkey", "concat('8', lpad(cast(c_custkey as string), 9, '0'))"
                )
            )
        )
        sellers = (
            star("supplier")
            .selectExpr(
                "s_suppkey as s",
                "s_name",
                "case when s_suppkey % 50 >= 38 then s_suppkey - (s_suppkey % 50 - 38)"
                " when s_suppkey % 10 < 6 then s_suppkey - (s_suppkey % 10) % 3 else s_suppkey end as g",
            )
            .selectExpr(
                f"{SUPPLIER_IDS} + s as id",
                "s_name as name",
                f"{_shared_inn('g')} as inn",
                "if(s % 7 = 0, null, lpad(cast(s as string), 9, '0')) as kpp",
                "cast(null as bigint) as fk_customer_id",
                f"{SUPPLIER_IDS} + s as fk_supplier_id",
                f"{_later('timestamp_ntz' + repr('1993-01-01'), '(s % 365)')} as created_when",
                "concat('user', cast(s % 50 as string)) as created_by",
            )
        )
        return buyers.unionByName(seconds).unionByName(sellers)

    def _people(most: int) -> DataFrame:
        """Numbers of users as purchases and suppliers name them, below ``most``: two combined aggregates of the given tables."""
        named = star("orders").selectExpr("o_orderkey % 50 as id").distinct()
        registered = star("supplier").selectExpr("s_suppkey % 50 as id").distinct()
        first = star("customer").selectExpr("0L as id").distinct()
        return named.unionByName(registered).unionByName(first).distinct().where(F.col("id") < most)

    def user_s(_: Tables) -> DataFrame:
        return _people(50).selectExpr("id", "concat('user', cast(id as string)) as user_name")

    def employee(_: Tables) -> DataFrame:
        return (
            _people(48)
            .withColumn("n_suppliers", supplier_count().scalar())
            .selectExpr(
                "id as fk_user_id",
                "concat('Surname', cast(id as string)) as surname",
                "concat('Name', cast(id % 7 as string)) as first_name",
                "concat('user', cast(id as string), '@example.org') as mail",
                "if(id % 2 = 0, id, null) as fk_customer_id",
                f"if(id % 2 = 1 or id % 10 = 0, {SUPPLIER_IDS} + id % n_suppliers, null) as fk_supplier_id",
            )
        )

    def event_log(_: Tables) -> DataFrame:
        details = ("order_state", "supplier_state", "registry_stage", "parameter_name", "new_value")

        def wide(df: DataFrame, kind: str, ident: str, entity: str, moment: str, **typed: str) -> DataFrame:
            return df.selectExpr(
                f"{ident} as id",
                f"{entity} as event_driven_id",
                f"'{kind}' as event_type",
                f"{moment} as created_when",
                *[f"{typed.get(name, 'cast(null as string)')} as {name}" for name in details],
            )

        orders = star("orders").selectExpr("o_orderkey as o", "o_orderdate as day0")
        last = "i = o % 5 and i <> 0"
        states = wide(
            orders.selectExpr("o", "day0", "explode(sequence(0L, o % 5)) as i"),
            "ORDER_STATE",
            "o * 10 + i",
            "o",
            _later("day0", f"((i - if(o % 101 = 0 and {last}, 1, 0)) * 17)"),
            order_state=_pick(ORDER_STATES, f"(3 * o + 5 * (i - if(o % 202 = 0 and {last}, 1, 0))) % 17"),
        )
        changes = wide(
            orders.where("o % 4 = 0").selectExpr("o", "day0", "explode(sequence(0L, if(o % 8 = 0, 1L, 0L))) as i"),
            "ORDER_PARAM_CHANGE",
            "o * 10 + 7 + i",
            "o",
            _later("day0", "(20 + (o % 3) * 40 + 5 * i)"),
            parameter_name="'customerPaymentSum'",
            new_value="concat(cast(1 + o % 9 as string), char(160), lpad(cast(o % 1000 as string), 3, '0'),"
            " ',', lpad(cast(o % 100 as string), 2, '0'))",
        )
        suppliers = star("supplier").selectExpr("s_suppkey as s")
        supplier_states = wide(
            suppliers.selectExpr("s", "explode(sequence(0L, s % 3)) as i"),
            "SUPPLIER_STATE",
            f"{SUPPLIER_STATE_IDS} + s * 10 + i",
            f"{SUPPLIER_IDS} + s",
            _later("timestamp_ntz'1994-01-01'", "(30 * i + s % 20)"),
            supplier_state="if((s + i) % 3 = 0, 'POSTFACTUM', 'OPERATIVE')",
        )
        registrations = wide(
            suppliers.selectExpr("s", "explode(sequence(0L, s % 2)) as i"),
            "REGISTRATION",
            f"{REGISTRATION_IDS} + s * 10 + i",
            f"{SUPPLIER_IDS} + s",
            _later("timestamp_ntz'1994-01-01'", "(10 * i + s % 10)"),
            registry_stage=_pick(REGISTRY_STAGES, "(s + i) % 6"),
        )
        return states.unionByName(changes).unionByName(supplier_states).unionByName(registrations)

    def events(t: Tables) -> DataFrame:
        return t.event_log.select("id", "event_driven_id", "event_type", "created_when")

    def child(kind: Kind):
        columns = [a for a, _ in kind.details]
        return lambda t: t.event_log.where(F.col("event_type") == kind.event_type).select(
            F.col("id").alias("event_id"), *columns
        )

    def product_group(_: Tables) -> DataFrame:
        # The type names are a short vocabulary, so one sorted array numbers them without a global window.
        names = star("part").agg(F.array_sort(F.collect_set("p_type")).alias("names"))
        return names.selectExpr("posexplode(names) as (pos, name)").selectExpr("cast(pos + 1 as bigint) as id", "name")

    def suppliers_product(_: Tables) -> DataFrame:
        return star("part").selectExpr(
            "p_partkey as id",
            "element_at(array(0, 10, 20, -1), cast(p_partkey % 4 + 1 as int)) as tax_percent",
            "p_partkey as fk_product_name_id",
            "p_partkey as fk_product_id",
            "1L as fk_unit_id",
        )

    def product_name(_: Tables) -> DataFrame:
        return star("part").selectExpr("p_partkey as id", "p_partkey as fk_product_id")

    def product(t: Tables) -> DataFrame:
        groups = t.product_group.selectExpr("id as fk_product_group_id", "name as p_type")
        return star("part").join(groups, "p_type").selectExpr("p_partkey as id", "fk_product_group_id")

    def supplier_product_groups(_: Tables) -> DataFrame:
        return (
            star("supplier")
            .where("s_suppkey % 11 <> 0")
            .selectExpr(
                f"{SUPPLIER_IDS} + s_suppkey as fk_supplier_id",
                "explode(array_distinct(array(s_suppkey % 6 + 1, (5 * s_suppkey + 2) % 6 + 1))) as fk_product_group_id",
            )
        )

    def hb_unit(_: Tables) -> DataFrame:
        return star("part").selectExpr("1L as id").distinct()

    def directorate(_: Tables) -> DataFrame:
        return (
            star("customer")
            .where("c_custkey % 17 <> 0")
            .selectExpr(
                "c_custkey as customer_id", "concat('D', lpad(cast(c_custkey % 16 as string), 2, '0')) as directorate"
            )
        )

    return Tables(
        {
            "order_s": order_s,
            "order_item": order_item,
            "contract": contract,
            "contract_event": contract_event,
            "customer": customer,
            "supplier": supplier,
            "agent": agent,
            "user_s": user_s,
            "employee": employee,
            "event_log": event_log,
            "events": events,
            **{kind.child: child(kind) for kind in KINDS.values()},
            **EVENT_VIEWS,
            "suppliers_product": suppliers_product,
            "product_name": product_name,
            "product": product,
            "product_group": product_group,
            "supplier_product_groups": supplier_product_groups,
            "hb_unit": hb_unit,
            "directorate": directorate,
        }
    )
