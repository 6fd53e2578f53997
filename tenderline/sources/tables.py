"""The procurement schema and its readers.

``Tables`` holds one lazy DataFrame per table, built on first use, so a report only touches
the files it needs. Besides the stored tables it offers the typed views of the event log:

* ``order_states``    order_id, at, state
* ``order_activity``  order_id, at, state  (events of any type, state null when not a state event)
* ``supplier_states`` supplier_id, at, state
* ``registrations``   supplier_id, at, stage
* ``param_changes``   order_id, at, parameter_name, new_value
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = "decimal(18,2)"

SCHEMAS: dict[str, str] = {
    "order_s": "id bigint, order_number string, created_when timestamp_ntz, created_by string,"
    f" fk_contract_id bigint, customer_payment_sum {MONEY}",
    "order_item": f"id bigint, fk_order_id bigint, price {MONEY}, quantity decimal(10,0),"
    " product_name string, fk_supplier_product_id bigint",
    "contract": "id bigint, contract_number string, fk_customer_id bigint, fk_supplier_id bigint,"
    " payment_type string, pre_payment_percent int, pay_delay_days int, from_date date, to_date date",
    "contract_event": "fk_contract_id bigint, contract_state string, created_when timestamp_ntz",
    "customer": "id bigint",
    "supplier": "id bigint, created_when timestamp_ntz, created_by string",
    "agent": "id bigint, name string, inn string, kpp string, fk_customer_id bigint,"
    " fk_supplier_id bigint, created_when timestamp_ntz, created_by string",
    "user_s": "id bigint, user_name string",
    "employee": "fk_user_id bigint, surname string, first_name string, mail string,"
    " fk_customer_id bigint, fk_supplier_id bigint",
    "events": "id bigint, event_driven_id bigint, event_type string, created_when timestamp_ntz",
    "order_state_event": "event_id bigint, order_state string",
    "supplier_state_event": "event_id bigint, supplier_state string",
    "order_param_change_event": "event_id bigint, parameter_name string, new_value string",
    "register_stages": "event_id bigint, registry_stage string",
    "suppliers_product": "id bigint, tax_percent int, fk_product_name_id bigint,"
    " fk_product_id bigint, fk_unit_id bigint",
    "product_name": "id bigint, fk_product_id bigint",
    "product": "id bigint, fk_product_group_id bigint",
    "product_group": "id bigint, name string",
    "supplier_product_groups": "fk_supplier_id bigint, fk_product_group_id bigint",
    "hb_unit": "id bigint",
    "directorate": "customer_id bigint, directorate string",
}


class Tables:
    """Lazy, memoised access to the tables by name."""

    def __init__(self, makers: Mapping[str, Callable[[Tables], DataFrame]]):
        self._makers = dict(makers)
        self._made: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._made:
            if name not in self._makers:
                raise AttributeError(f"no table {name!r}")
            self._made[name] = self._makers[name](self)
        return self._made[name]

    def holds(self, name: str) -> bool:
        return name in self._makers

    def reads_log(self, view: str) -> bool:
        """Whether ``view`` is read from the stored log and its child table, not from a frame of its own."""
        return self.holds("events") and self._makers.get(view) is EVENT_VIEWS[view]

    def replace(self, **frames: DataFrame) -> Tables:
        """The same tables with some frames swapped, e.g. for one written earlier."""
        makers = dict(self._makers)
        makers.update({name: (lambda _, df=df: df) for name, df in frames.items()})
        return Tables(makers)


@dataclass(frozen=True)
class Kind:
    """One type of event: the child table with its details, the entity it happens to, what the details are called."""

    event_type: str
    child: str
    entity: str
    details: tuple[tuple[str, str], ...]


KINDS = {
    "order_states": Kind("ORDER_STATE", "order_state_event", "order_id", (("order_state", "state"),)),
    "supplier_states": Kind("SUPPLIER_STATE", "supplier_state_event", "supplier_id", (("supplier_state", "state"),)),
    "registrations": Kind("REGISTRATION", "register_stages", "supplier_id", (("registry_stage", "stage"),)),
    "param_changes": Kind(
        "ORDER_PARAM_CHANGE", "order_param_change_event", "order_id",
        (("parameter_name", "parameter_name"), ("new_value", "new_value")),
    ),
}


def event_details(t: Tables, kind: Kind) -> DataFrame:
    """event_id and the details of one type of event."""
    return getattr(t, kind.child).select("event_id", *[F.col(a).alias(b) for a, b in kind.details])


def _view(name: str) -> Callable[[Tables], DataFrame]:
    kind = KINDS[name]

    def make(t: Tables) -> DataFrame:
        log = t.events.where(F.col("event_type") == kind.event_type)
        return log.join(event_details(t, kind), log["id"] == F.col("event_id")).select(
            F.col("event_driven_id").alias(kind.entity),
            F.col("created_when").alias("at"),
            *[b for _, b in kind.details],
        )

    return make


def _order_activity(t: Tables) -> DataFrame:
    detail = t.order_state_event
    return t.events.join(detail, t.events["id"] == detail["event_id"], "left").select(
        F.col("event_driven_id").alias("order_id"),
        F.col("created_when").alias("at"),
        F.col("order_state").alias("state"),
        (F.col("event_type") == "ORDER_STATE").alias("is_typed"),
        F.col("event_id").isNotNull().alias("has_detail"),
    )


EVENT_VIEWS: dict[str, Callable[[Tables], DataFrame]] = {
    **{name: _view(name) for name in KINDS},
    "order_activity": _order_activity,
}


def read_parquet(spark: SparkSession, root: str) -> Tables:
    """One Parquet folder per table under ``root``; explicit schemas, so nothing is inferred."""
    makers: dict[str, Callable[[Tables], DataFrame]] = {
        name: (lambda _, n=name, s=schema: spark.read.schema(s).parquet(f"{root}/{n}"))
        for name, schema in SCHEMAS.items()
    }
    return Tables({**makers, **EVENT_VIEWS})


# Columns the large tables are split on when they are read over JDBC; details share the ids of the event log.
SPLIT_COLUMNS = {
    "order_s": "id", "order_item": "id", "contract": "id", "events": "id",
    **{kind.child: "event_id" for kind in KINDS.values()},
}


def bounds_query() -> str:
    """One statement for the lowest and highest id of every id space that large tables are split on."""
    own = [name for name, column in SPLIT_COLUMNS.items() if column == "id"]
    return " UNION ALL ".join(f"SELECT '{name}' AS name, min(id) AS low, max(id) AS high FROM {name}" for name in own)


def split_plan(rows: Iterable[tuple[str, int | None, int | None]]) -> dict[str, tuple[int, int]]:
    """(lowest, highest) id by table, from the rows of ``bounds_query``; an empty table is not split."""
    known = {name: (int(low), int(high)) for name, low, high in rows if low is not None}
    if "events" in known:
        known |= {kind.child: known["events"] for kind in KINDS.values()}
    return known


def jdbc_options(
    name: str, url: str, properties: Mapping[str, str], bounds: Mapping[str, tuple[int, int]], partitions: int
) -> dict[str, str]:
    """Reader options of one table: in parallel id ranges where its bounds are known, else in one read."""
    options = {**properties, "url": url, "dbtable": name}
    if name in SPLIT_COLUMNS and name in bounds:
        low, high = bounds[name]
        options |= {
            "partitionColumn": SPLIT_COLUMNS[name], "lowerBound": str(low), "upperBound": str(high),
            "numPartitions": str(max(1, min(partitions, high - low + 1))),
        }
    return options


def cast_to(df: DataFrame, schema: str) -> DataFrame:
    """The columns of ``schema`` in its types and sequence, whatever types the database hands over."""
    fields = T.StructType.fromDDL(schema).fields
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def read_jdbc(
    spark: SparkSession,
    url: str,
    properties: Mapping[str, str],
    bounds: Mapping[str, tuple[int, int]] | None = None,
    partitions: int = 64,
) -> Tables:
    """Read from the operational database, the large tables in parallel id ranges.

    ``bounds`` gives (lowest, highest) id per split table; without it one query asks for all of them. Every
    table has the columns and types of ``SCHEMAS``. Credentials belong in ``properties`` and are never stored here.
    """
    if bounds is None:
        asked = spark.read.format("jdbc").options(**properties, url=url, query=bounds_query()).load()
        bounds = split_plan(tuple(r) for r in asked.collect())

    def reader(name: str) -> Callable[[Tables], DataFrame]:
        options = jdbc_options(name, url, properties, bounds, partitions)
        return lambda _: cast_to(spark.read.format("jdbc").options(**options).load(), SCHEMAS[name])

    return Tables({**{name: reader(name) for name in SCHEMAS}, **EVENT_VIEWS})
