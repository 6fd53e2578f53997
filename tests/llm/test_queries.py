"""Queries with a statement against DuckDB; the registry."""

import pytest

import __spark_entry__ as entry_module
from tenderline.llm.queries import QUERIES, SQL
from tests.llm.conftest import SMALL


def test_registry():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry_module.queries())
    assert set(SQL) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_statement(spark, duck, name):
    got = QUERIES[name](spark, SMALL)
    cursor = duck.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in got.collect()))) == sorted(map(str, cursor.fetchall()))


@pytest.mark.parametrize("name", ["op3_quality", "op6_toxicity"])
def test_classifiers_on_held_out_rows(spark, name):
    label = {"op3_quality": "quality", "op6_toxicity": "toxic"}[name]
    folder = "/root/testdata/sf0.01"
    found = QUERIES[name](spark, folder)
    rows = found.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r[label] for r in rows) / len(rows)
    assert right >= 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert found.count() == spark.read.parquet(f"{folder}/documents.parquet").count()


def test_url_rules_and_model(spark):
    rows = {r["page_id"]: r for r in QUERIES["op7_url_filter"](spark, "/root/testdata/sf0.01").collect()}
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    assert rows.keys() == urls.keys()
    rules = [("org/", True), ("example.org/es/", False), ("example.org/en/1", False), ("com/fr/", True), ("com/de/", False)]
    for page, url in urls.items():
        rest = url.partition("://")[2].split("?")[0].split("#")[0]
        host, slash, path = rest.partition("/")
        fits = [(len(r), r, ok) for r, ok in rules if ("." + host).endswith("." + r.split("/")[0]) and (slash + path).startswith("/" + r.partition("/")[2])]
        assert (rows[page]["host"], rows[page]["path"]) == (host.lower(), slash + path)
        assert rows[page]["rule"] == (max(fits)[1] if fits else None)
        if fits:
            assert rows[page]["verdict"] == ("allow" if max(fits)[2] else "block")
