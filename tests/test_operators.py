"""Each shared operator on tiny frames, one case per trap."""

import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tenderline.functions import buyers as b
from tenderline.functions.buyers import Buyers
from tenderline.functions.dates import Period, age_in_days, in_previous_month, trailing_weeks
from tenderline.functions.labels import ORDER_STATES, label, tax_label
from tenderline.functions.numbers import mean, none_if_zero, parse_localised, percent
from tenderline.operators.buckets import bucket_counts, bucket_hits
from tenderline.operators.dedup import first_per
from tenderline.operators.groups import concat_repeated, concat_sorted, cycle_seconds, members_of_groups
from tenderline.operators.joins import either_key_join, left_join_spread, null_safe_join, semi
from tenderline.operators.latest import latest, latest_typed
from tenderline.operators.pairs import first_pair_and_latest, first_pair_off_gap, pair_totals
from tenderline.operators.shares import share
from tenderline.operators.weekly import weekly_matrix
from tests.conftest import rows


def at(day, hour=0):
    return datetime(2001, 1, day, hour)


def test_latest_keeps_ties_and_drops_null_keys(spark):
    df = spark.createDataFrame(
        [(1, at(1), "a"), (1, at(2), "b"), (1, at(2), "c"), (2, at(5), "d"), (None, at(9), "x"), (3, None, "y")],
        "e bigint, at timestamp_ntz, state string",
    )
    assert [r[2] for r in rows(latest(df, "e"))] == ["b", "c", "d"]
    assert [r[2] for r in rows(latest(df, "e", where=F.col("state") != "b"))] == ["c", "d"]


def test_latest_typed_flags_later_events_of_another_type(spark):
    df = spark.createDataFrame(
        [(1, at(1), "a"), (1, at(3), None), (2, at(1), "b"), (2, at(2), "c"), (2, at(2), None), (3, at(1), None)],
        "e bigint, at timestamp_ntz, state string",
    )
    got = {(r["e"], r["state"], r["is_newest"]) for r in latest_typed(df, "e").collect()}
    assert got == {(1, "a", False), (2, "c", True)}


def test_first_per_orders_nulls_first_and_is_total(spark):
    df = spark.createDataFrame(
        [("k", 2, "a", 1), ("k", 1, "b", 9), ("k", 1, None, 3), ("k", 1, None, 2), (None, 1, "z", 1)],
        "k string, v int, s string, w int",
    )
    assert rows(first_per(df, ["k"], ["v"])) == [("k", 1, None, 2), (None, 1, "z", 1)]
    assert first_per(df, ["k"], ["v"]).columns == ["k", "v", "s", "w"]


def test_previous_month_is_half_open_over_year_border(spark):
    df = spark.createDataFrame(
        [(datetime(2000, 11, 30, 23),), (datetime(2000, 12, 1),), (datetime(2000, 12, 31, 23, 59),), (datetime(2001, 1, 1),)],
        "at timestamp_ntz",
    )
    assert len(rows(in_previous_month(df, "at", date(2001, 1, 15)))) == 2
    assert Period.previous_month(date(2001, 3, 31)) == Period(date(2001, 2, 1), date(2001, 2, 28))


def test_age_in_days_ignores_the_time_of_day(spark):
    df = spark.createDataFrame([(at(1, 23),)], "at timestamp_ntz")
    assert rows(df.select(age_in_days(F.col("at"), date(2001, 1, 3)))) == [(2,)]


def test_weeks_share_their_border(spark):
    assert trailing_weeks(date(2001, 1, 29))[-1] == (date(2001, 1, 22), date(2001, 1, 29))
    df = spark.createDataFrame(
        [("a", at(22), 5), ("a", at(29), 1), ("a", at(29, 1), 7), ("b", at(31), 3)], "k string, at timestamp_ntz, v int"
    )
    got = weekly_matrix(df, ["k"], "at", date(2001, 1, 29), counts=["n"], sums={"v": F.col("v")})
    assert rows(got.select("k", "n_w3", "n_w4", "v_w3", "v_w4")) == [("a", 1, 2, 5, 6), ("b", 0, 0, None, None)]


def test_buckets_double_amounts_of_tied_rows(spark):
    states = spark.createDataFrame(
        [(1, "X"), (1, "X"), (2, "X"), (2, "Y"), (3, "Y")], "id bigint, state string"
    )
    hits = bucket_hits(states, "id", {"x": F.col("state") == "X", "y": F.col("state") == "Y"})
    facts = spark.createDataFrame([(1, "c", 10), (2, "c", 5), (3, "c", 1), (4, "d", 7)], "id bigint, c string, amount int")
    got = bucket_counts(facts.join(hits, "id", "left"), ["c"], ["x", "y"])
    assert rows(got) == [("c", 2, 3, 25, 2, 2, 6), ("d", 0, 0, None, 0, 0, None)]


def test_share_with_missing_category_and_zero_total(spark):
    df = spark.createDataFrame(
        [("c", None, "s", Decimal(1)), ("c", None, "t", Decimal(2)), ("c", "g", "s", Decimal(0)), ("d", "g", "s", Decimal(6))],
        "c string, g string, s string, v decimal(18,2)",
    )
    got = share(df, "v", {"cat": ["c", "g"], "all": []}, null_safe=["g"])
    assert {(r["c"], r["g"], r["s"]): (r["cat_pct"], r["all_pct"]) for r in got.collect()} == {
        ("c", None, "s"): (Decimal("33.33"), Decimal("11.11")),
        ("c", None, "t"): (Decimal("66.67"), Decimal("22.22")),
        ("c", "g", "s"): (None, Decimal("0.00")),
        ("d", "g", "s"): (Decimal("100.00"), Decimal("66.67")),
    }


def test_percent_and_mean_round_half_away_from_zero(spark):
    df = spark.createDataFrame([(Decimal("0.5"), Decimal(1000), 8)], "a decimal(18,2), b decimal(18,2), n int")
    got = df.select(
        percent(F.col("a"), F.col("b")),
        percent(-F.col("a"), F.col("b")),
        percent(F.col("a"), F.lit(0)),
        mean(F.lit(Decimal("1.00")), F.col("n")),
        none_if_zero(F.lit(0)),
        none_if_zero(F.lit(3)),
    ).first()
    assert tuple(got) == (Decimal("0.05"), Decimal("-0.05"), None, Decimal("0.13"), None, 3)


def test_group_sizes_are_bounded_on_both_sides(spark):
    df = spark.createDataFrame(
        [("a", 1), ("b", 2), ("b", 3), ("b", 3)] + [("c", i) for i in range(10, 20)], "inn string, id int"
    )
    assert rows(members_of_groups(df, "inn", "id", 2, 9)) == [("b", 2, 2), ("b", 3, 2), ("b", 3, 2)]


def test_semi_keeps_multiplicity(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(semi(left, right, "k")) == [(1,), (1,)]


LEFT = [(1, 10, 100), (2, 11, None), (3, None, 102), (4, None, None), (5, 12, 103), (5, 12, 103), (6, 99, 999)]
RIGHT = [(10, None, "A"), (10, 100, "both"), (11, 100, "C"), (None, 102, "D"), (12, 7, "E"), (None, None, "none")]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_either_key_join_equals_the_or_join(spark, how):
    left = spark.createDataFrame(LEFT, "id int, a int, b int")
    right = spark.createDataFrame(RIGHT, "x int, y int, name string")
    got = either_key_join(left, right, ("a", "x"), ("b", "y"), how)
    plain = left.join(right, (left["a"] == right["x"]) | (left["b"] == right["y"]), how)
    assert rows(got) == rows(plain)


def test_null_safe_join(spark):
    left = spark.createDataFrame([(1, None), (1, "g"), (None, "g")], "k int, g string")
    right = spark.createDataFrame([(1, None, "n"), (1, "g", "m"), (None, "g", "z")], "k int, g string, v string")
    assert rows(null_safe_join(left, right, ["k"], ["g"])) == [(1, "g", "m"), (1, None, "n")]


def test_pairs_match_the_enumerated_ones(spark):
    rng = random.Random(5)
    starts, ends, gaps = [], [], []
    for e in range(120):
        gaps.append((e, rng.choice([0, 1, 2, None])))
        starts += [(e, at(rng.randint(1, 3), rng.randint(0, 2))) for _ in range(rng.randint(0, 4))]
        ends += [(e, at(rng.randint(1, 4), rng.randint(0, 2))) for _ in range(rng.randint(0, 4))]
    want_first, want_totals = {}, {}
    for e, gap in gaps:
        if gap is None:
            continue
        s, t = [m for x, m in starts if x == e], [m for x, m in ends if x == e]
        pairs = sorted((a, z) for a in s for z in t)
        off = [p for p in pairs if (p[1].date() - p[0].date()).days != gap]
        if pairs:
            want_totals[e] = (len(s), len(t), len(pairs), len(pairs) - len(off))
        if off:
            want_first[e] = (*off[0], (off[0][1].date() - off[0][0].date()).days, off.count(off[0]))
    sdf = spark.createDataFrame(starts, "e int, at timestamp_ntz")
    edf = spark.createDataFrame(ends, "e int, at timestamp_ntz")
    gdf = spark.createDataFrame(gaps, "e int, gap int").where("gap is not null")
    first = first_pair_off_gap(sdf, edf, gdf, "e", "gap")
    assert {r["e"]: (r["start_at"], r["end_at"], r["gap_days"], r["weight"]) for r in first.collect()} == want_first
    totals = pair_totals(sdf, edf, gdf, "e", "gap")
    assert {r["e"]: (r["starts"], r["ends"], r["pairs"], r["kept"]) for r in totals.collect()} == want_totals


def test_localised_numbers(spark):
    df = spark.createDataFrame([("12 345,67",), ("8",), (None,)], "s string")
    assert [r[0] for r in df.select(parse_localised(F.col("s"))).collect()] == [Decimal("12345.67"), Decimal("8.00"), None]
    bad = spark.createDataFrame([("abc",)], "s string").select(parse_localised(F.col("s")))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        bad.collect()


def test_text_aggregates(spark):
    df = spark.createDataFrame(
        [("k", "b", 2), ("k", "a", 1), ("k", None, 5), ("k", "b", 1), ("n", None, 1)], "k string, v string, n int"
    )
    assert rows(df.groupBy("k").agg(concat_sorted(F.col("v")))) == [("k", "a / b"), ("n", None)]
    assert rows(concat_repeated(df, ["k"], "v", "n")) == [("k", "a / b / b / b"), ("n", None)]


def test_cycles_need_two_distinct_ids(spark):
    df = spark.createDataFrame([("k", at(1), 1), ("k", at(3), 2), ("k", at(3), 2), ("s", at(1), 1)], "k string, at timestamp_ntz, id int")
    assert [(r["k"], r["occurrences"], r["cycle_seconds"]) for r in cycle_seconds(df, ["k"], "at", "id").collect()] == [
        ("k", 2, 86400.0)
    ]


def test_labels_keep_unknown_codes(spark):
    df = spark.createDataFrame([("NEW", -1), ("ODD", 10), (None, None)], "c string, r int")
    assert rows(df.select(label(F.col("c"), ORDER_STATES), tax_label(F.col("r")))) == [
        ("ODD", "10"), ("Новый", "Без НДС"), (None, None),
    ]
    assert len(ORDER_STATES) == 17


def test_buyers_lists_drop_missing_ids(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "customer_id bigint")
    assert rows(Buyers(excluded=(2,)).keep(df)) == [(1,), (3,)]
    assert rows(Buyers(only=(2, 3), excluded=(3,)).keep(df)) == [(2,)]
    assert len(rows(Buyers().keep(df))) == 4
    assert rows(b.keep_ids(df, "customer_id", df.where("customer_id > 2"))) == [(3,)]


def test_id_lists_have_one_plan_whatever_their_length(spark):
    df = spark.range(10).withColumnRenamed("id", "customer_id")
    shapes = []
    for n in (3, 5000):
        plan = Buyers(excluded=tuple(range(n))).keep(df)._jdf.queryExecution().optimizedPlan().toString()
        shapes.append([line.split("[")[0].split("(")[0].strip(" +-:") for line in plan.splitlines()])
    assert shapes[0] == shapes[1] and any("LeftAnti" in x for x in shapes[0])


def test_not_in_drops_missing_values(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "m string")
    assert rows(df.where(b.not_in(F.col("m"), ["a"]))) == [("b",)]
    assert len(rows(df.where(b.not_in(F.col("m"), [])))) == 3


def test_pairs_and_latest_from_one_frame_equal_the_separate_operators(spark):
    rng = random.Random(11)
    events, gaps = [], {e: rng.choice([0, 1, 2]) for e in range(150)}
    for e in gaps:
        events += [(e, at(rng.randint(1, 4), rng.randint(0, 2)), rng.choice(["ask", "got", "both", "x", None])) for _ in range(rng.randint(0, 8))]
    frame = spark.createDataFrame([(e, gaps[e], m, s) for e, m, s in events], "e int, gap int, at timestamp_ntz, state string")
    starts, ends = F.col("state").isin("ask", "both"), F.col("state").isin("got", "both")
    found = first_pair_and_latest(frame, ["e", "gap"], "gap", starts, ends, F.col("state"))
    agreed = frame.select("e", "gap").distinct()
    want = {r["e"]: r for r in first_pair_off_gap(frame.where(starts), frame.where(ends), agreed, "e", "gap").collect()}
    got = {r["e"]: r for r in found.collect()}
    assert set(got) == set(want) and len(got) > 20
    for e, row in got.items():
        assert all(row[c] == want[e][c] for c in ("start_at", "end_at", "gap_days", "weight"))
        newest = max(m for x, m, _ in events if x == e)
        assert sorted(map(str, row["newest"])) == sorted(str(s) for x, m, s in events if x == e and m == newest)


def test_weeks_show_all_keys_and_count_borders_twice(spark):
    rng = random.Random(12)
    moments = [(rng.choice("abc"), at(rng.randint(1, 31), rng.choice([0, 0, 1])), rng.randint(1, 9)) for _ in range(200)]
    df = spark.createDataFrame(moments + [(None, at(15), 4)], "k string, at timestamp_ntz, v int")
    keys = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "k string")
    got = {r["k"]: r for r in weekly_matrix(df, ["k"], "at", date(2001, 1, 29), ["n"], {"v": F.col("v")}, 3, keys).collect()}
    assert set(got) == {"a", "b", "z", None} and got["z"]["n_w1"] == 0 and got["z"]["v_w2"] is None
    for i, (first, last) in enumerate(trailing_weeks(date(2001, 1, 29), 3), 1):
        low, high = at(first.day), at(last.day)
        for k in ("a", "b"):
            own = [v for x, m, v in moments if x == k and low <= m <= high]
            assert (got[k][f"n_w{i}"], got[k][f"v_w{i}"]) == (len(own), sum(own) if own else None)


def test_missing_keys_are_dealt_over_all_tasks(spark):
    left = spark.range(20_000).selectExpr("id", "if(id % 10 = 0, id % 50, null) as k")
    right = spark.range(40).selectExpr("id as k", "concat('v', id) as name")
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled"]
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n, value in zip(names, ("-1", "16", "false")):
            spark.conf.set(n, value)
        joined = left_join_spread(left, right, "k")
        parts = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        got = rows(joined.select("id", "k", "name"))
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)
    assert len(parts) == 16 and max(parts) < 2 * 20_000 / 16
    assert got == rows(left.join(right, "k", "left").select("id", "k", "name"))
