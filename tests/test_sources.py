"""Reading in parallel ranges, outputs that are put in place whole, instants, lists of single reports."""

from dataclasses import replace
from datetime import date, datetime, timedelta, timezone

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from tenderline.functions.dates import age_in_days, moment
from tenderline.plans.catalog import MORE, QUERIES, SAMPLE, run_report
from tenderline.plans.contracts import advance_contract_detail, is_active
from tenderline.session import scratch_folder
from tenderline.sources.sinks import replace_parts, write_by, write_report
from tenderline.sources.tables import KINDS, SCHEMAS, SPLIT_COLUMNS, bounds_query, cast_to, jdbc_options, split_plan
from tests.conftest import SMALL, rows
from tests.test_oracle import STAR, plain


def test_one_statement_gives_all_bounds():
    db = duckdb.connect()
    for name in ("order_s", "order_item", "contract", "events"):
        db.execute(f"CREATE TABLE {name} (id BIGINT)")
    db.execute("INSERT INTO events VALUES (5), (900)")
    db.execute("INSERT INTO order_s VALUES (7)")
    plan = split_plan(db.execute(bounds_query()).fetchall())
    children = {kind.child for kind in KINDS.values()}
    assert plan == {"order_s": (7, 7), "events": (5, 900), **{name: (5, 900) for name in children}}
    assert children <= set(SPLIT_COLUMNS)


def test_reader_options():
    bounds = {"events": (5, 900), "order_state_event": (5, 900), "order_s": (7, 7)}
    got = jdbc_options("order_state_event", "u", {"user": "x"}, bounds, 64)
    assert got == {
        "user": "x", "url": "u", "dbtable": "order_state_event", "partitionColumn": "event_id", "lowerBound": "5",
        "upperBound": "900", "numPartitions": "64",
    }
    assert jdbc_options("order_s", "u", {}, bounds, 64)["numPartitions"] == "1"
    assert "partitionColumn" not in jdbc_options("agent", "u", {}, bounds, 64)
    assert "partitionColumn" not in jdbc_options("contract", "u", {}, bounds, 64)


def test_columns_get_their_types(spark):
    raw = spark.sql("select 1 as ID, 'n' as order_number, timestamp'2001-01-01 03:04:05' as created_when, null as created_by,"
                    " cast(4 as decimal(20,0)) as fk_contract_id, 2.5D as customer_payment_sum, 'x' as more")
    got = cast_to(raw, SCHEMAS["order_s"])
    assert got.schema.simpleString() == spark.createDataFrame([], SCHEMAS["order_s"]).schema.simpleString()
    assert str(got.first()["created_when"]) == "2001-01-01 03:04:05"


def failing(spark, columns):
    return spark.range(4).selectExpr(*columns).withColumn("v", F.when(F.col("v") >= 0, F.raise_error(F.lit("lost"))).cast("string"))


def test_a_failed_run_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (3, 5):
        write_report(spark.range(n), path)
        assert spark.read.parquet(path).count() == n
    with pytest.raises(Exception, match="lost"):
        write_report(failing(spark, ["id as v"]), path)
    assert spark.read.parquet(path).count() == 5
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["t"]
    by = str(tmp_path / "b")
    write_by(spark.range(9).selectExpr("id % 3 as k", "id as v"), "k", by)
    write_by(spark.range(4).selectExpr("id % 2 as k", "id as v"), "k", by)
    assert sorted(p.name for p in (tmp_path / "b").glob("k=*")) == ["k=0", "k=1"]
    with pytest.raises(Exception, match="lost"):
        write_by(failing(spark, ["id % 2 as k", "id as v"]), "k", by)
    assert spark.read.parquet(by).count() == 4


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_run_replaces_only_its_keys(spark, tmp_path, fmt):
    path = str(tmp_path / "p")
    read = lambda: sorted((str(r["k"]), str(r["v"])) for r in spark.read.option("header", True).format(fmt).load(path).collect())
    first = spark.range(9).selectExpr("id % 3 as k", "id as v")
    assert rows(replace_parts(first, "k", path, "one", fmt)) == [(0, 3), (1, 3), (2, 3)]
    second = spark.range(2).selectExpr("1L as k", "100 + id as v")
    for _ in range(2):
        assert rows(replace_parts(second, "k", path, "two", fmt)) == [(1, 2)]
    want = sorted([("0", "0"), ("0", "3"), ("0", "6"), ("1", "100"), ("1", "101"), ("2", "2"), ("2", "5"), ("2", "8")])
    assert read() == want
    with pytest.raises(Exception, match="lost"):
        replace_parts(failing(spark, ["1L as k", "id as v"]).selectExpr("k", "cast(v as bigint) as v"), "k", path, "three", fmt)
    assert read() == want


def test_scratch_is_shared_on_a_cluster(spark):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="checkpoint"):
        scratch_folder(Session())


def test_a_contract_ends_with_the_midnight_of_its_last_day(spark):
    df = spark.sql("select * from values (date'2001-08-01'), (date'2001-08-02'), (date'2001-08-03'), (null) as v(to_date)")
    active = lambda at: sorted(str(r[0]) for r in df.where(is_active(at)).collect())
    day = date(2001, 8, 2)
    assert active(day) == active(datetime(2001, 8, 2)) == ["2001-08-02", "2001-08-03", "None"]
    assert active(datetime(2001, 8, 2, 0, 0, 1)) == ["2001-08-03", "None"]
    # 22:30 in a zone three hours behind is half past one of the next day.
    late = datetime(2001, 8, 1, 22, 30, tzinfo=timezone(-timedelta(hours=3)))
    assert active(late) == ["2001-08-03", "None"]
    told = spark.range(1).select(moment(late, "America/Sao_Paulo").cast("string"), age_in_days(F.lit(date(2001, 7, 31)), late)).first()
    assert tuple(told) == ("2001-08-01 22:30:00", 2)


def test_reports_take_instants(small):
    at_midnight = rows(advance_contract_detail(small, date(2001, 8, 2)))
    assert rows(advance_contract_detail(small, datetime(2001, 8, 2))) == at_midnight
    ending = small.contract.withColumn("to_date", F.lit(date(2001, 8, 2)))
    assert rows(advance_contract_detail(small.replace(contract=ending), datetime(2001, 8, 2, 9))) == []
    assert rows(advance_contract_detail(small.replace(contract=ending), date(2001, 8, 2)))


def test_each_report_has_its_own_lists(spark, small):
    lists = spark.createDataFrame(
        [("r04_stale_orders", "excluded", i) for i in range(600)] + [("r06_by_customer", "listed", 12)],
        "report string, role string, customer_id bigint",
    )
    params = replace(SAMPLE, lists=lists)
    known = small.agent.where("fk_customer_id < 600").select("name")
    stale = run_report("r04_stale_orders", small, params)
    assert stale.join(known, stale["customer_name"] == known["name"], "left_semi").count() == 0
    assert [r["customer_id"] for r in run_report("r06_by_customer", small, params).select("customer_id").distinct().collect()] == [12]
    assert run_report("r05_by_customer", small, params).count() == 0
    assert rows(run_report("r09_duplicate_suppliers", small, params)) == rows(QUERIES["r09_duplicate_suppliers"](small, SAMPLE))


@pytest.mark.parametrize("name", list(MORE))
def test_further_queries_equal_their_statements(spark, name):
    duck = duckdb.connect()
    for table in STAR:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    df = entry_module.queries()[name](spark, SMALL)
    cursor = duck.execute(entry_module.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    want = sorted((tuple(map(plain, r)) for r in cursor.fetchall()), key=str)
    assert got == want and want
