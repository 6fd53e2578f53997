"""Stages keep all columns of the documents, also those with the names that operators use inside."""

import pytest

from tenderline.llm.decontaminate import drop_contaminated
from tenderline.llm.exact import drop_copies
from tenderline.llm.jaccard import one_of_each
from tenderline.llm.toxicity import Model, drop_toxic, scored
from tests.llm.conftest import SMALL

NAMES = "_key _bad _sha _kept_id _kept_sha _nth own id sha key kept_id kept_sha nth bad_id bad_key _row score doc text_sha256 unit name".split()
LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"
ROWS = [(1, "one two three four five six"), (2, "one two three four five six"), (3, LONG), (4, None), (None, "seven")]


@pytest.fixture
def marked(spark):
    rows = [(i, t, *[f"{n}-{k}" for n in NAMES]) for k, (i, t) in enumerate(ROWS)]
    return spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in NAMES))


def stages(spark):
    bench = spark.createDataFrame([(1, LONG)], "item_id long, text string")
    labels = spark.createDataFrame([(1, 0), (3, 1)], "doc_id long, toxic int")
    return {
        "copies": (drop_copies, {1, 3, 4, None}),
        "groups": (one_of_each, {1, 3, 4, None}),
        "leaks": (lambda d: drop_contaminated(d, bench), {1, 2, 4, None}),
        "toxic": (lambda d: drop_toxic(d, labels.limit(0)), {1, 2, 3, 4, None}),
    }


@pytest.mark.parametrize("name", ["copies", "groups", "leaks", "toxic"])
def test_columns_stay(spark, marked, name):
    stage, want = stages(spark)[name]
    found = stage(marked)
    assert found.columns == marked.columns
    before = {r["doc_id"]: r for r in marked.collect()}
    after = {r["doc_id"]: r for r in found.collect()}
    assert set(after) == want and all(before[i] == r for i, r in after.items())


def test_patterns_are_evaluated_once(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    plan = drop_toxic(docs, labels)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and plan.count("RLIKE") <= 3


def test_evidence_counts_each_voter_once(spark):
    model = Model(["ab", "abc", "x"], ["!{3,}"], __import__("numpy").array([1.0, 2.0, 4.0, 8.0, -16.0]), 0.5)
    rows = [("abcd abce", 3.5), ("abx Abz", 1.5), ("zz", -15.5), ("x !!!! x", 12.5), ("", -15.5), ("?!!!", 8.5)]
    found = scored(spark.createDataFrame(rows, "text string, want double"), model).collect()
    import math

    assert all(math.isclose(r["score"], 1 / (1 + math.exp(-r["want"]))) for r in found)
