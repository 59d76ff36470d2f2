import datetime as dt

import pytest
from pyspark.sql import functions as F

from voltspan.operators import quality as Q


def test_instances():
    checks = Q.standard_checks()
    assert len(checks) == 68
    kinds = {}
    for c in checks:
        kinds[c.spec[0]] = kinds.get(c.spec[0], 0) + 1
    assert kinds == {"not_null": 33, "unique": 7, "values": 4, "relationship": 11,
                     "combination": 9, "range": 4}
    price = {"seed_region", "stg_price_demand", "dim_region", "fct_price_demand",
             "fct_region_daily"}
    assert len(Q.selectable(checks, dict.fromkeys(price))) == 22


def test_each_check(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 40000.0), (None, 40000.01), (None, -1000.0), ("b", None)],
        "k string, v double")
    assert [tuple(r) for r in Q.not_null(df, "k").collect()] == [(2,)]
    assert Q.not_null(df.filter("k = 'a'"), "k").count() == 0
    assert [tuple(r) for r in Q.unique(df, "k").collect()] == [("a", 2)]
    assert [tuple(r) for r in Q.accepted_values(df, "k", ["a"]).collect()] == [("b", 1)]
    parent = spark.createDataFrame([("a",)], "id string")
    assert [tuple(r) for r in Q.relationships(df, "k", parent, "id").collect()] == [("b", 1)]
    assert [tuple(r) for r in Q.accepted_range(df, "v", -1000, 40000).collect()] == [(40000.01, 1)]
    twice = df.unionAll(df)
    assert Q.unique_combination(twice, ["k", "v"]).count() == 5
    assert Q.unique_combination(df, ["k", "v"]).count() == 0


def test_gate_and_summary(spark):
    good = spark.createDataFrame([("NSW1", "New South Wales", "NSW", "z")],
                                 "region_id string, region_name string, state string, timezone string")
    checks = Q.standard_checks()
    summary = Q.run_checks(checks, {"dim_region": good})
    assert [r.failures for r in Q.gate(summary).collect()] == [0, 0]
    with pytest.raises(AssertionError, match="dim_region.unique_region_id=2"):
        Q.gate(Q.run_checks(checks, {"dim_region": good.unionAll(good)}))


def test_mart_difference(spark):
    day = dt.date(2024, 1, 1)
    a = spark.createDataFrame([("x", day, 1), ("x", day, 1), ("y", day, 2)], "r string, d date, n int")
    b = spark.createDataFrame([("x", day, 1), ("y", day, 3)], "r string, d date, n int")
    got = sorted(tuple(r) for r in Q.mart_difference(a, b).collect())
    assert got == [("x", day, 1, "left"), ("y", day, 2, "left"), ("y", day, 3, "right")]
    assert Q.mart_difference(a, a).count() == 0
    sums = {"rows": F.count("*"), "total": F.sum("n")}
    diff = Q.aggregate_difference(a, b, ["r"], sums).collect()
    assert {(r.r, r.side, r.rows, r.total) for r in diff} == {
        ("x", "left", 2, 2), ("x", "right", 1, 1), ("y", "left", 1, 2), ("y", "right", 1, 3)}
    assert Q.aggregate_difference(a, a.repartition(3), ["r"], sums).count() == 0


def test_only_groups_that_differ_are_compared(spark):
    rows = [(r, dt.date(2024, m, d), float(m * d), None if d == 3 else "t") for r in "xy" for m in range(1, 7) for d in range(1, 20)]
    a = spark.createDataFrame(rows, "r string, d date, v double, n string")
    b = rows + [rows[0]]  # a row more in January
    b[30] = (*b[30][:2], -1.0, b[30][3])  # another value in February
    b = spark.createDataFrame([*b, (None, None, None, None)], a.schema)
    levels = [{"month": F.date_trunc("month", "d")}, {"r": F.col("r"), "d": F.col("d")}]
    want = sorted(map(str, Q.mart_difference(a, b).collect()))
    assert len(want) == 4
    for n in (1, 2):
        assert sorted(map(str, Q.mart_difference(a, b.repartition(3), levels[:n]).collect())) == want
    left, right = Q.differing_parts(a, b, levels)
    assert (left.count(), right.count()) == (2, 4)
    months, _ = Q.differing_parts(a, b, levels[:1])
    assert {r.d.month for r in months.select("d").collect()} == {1, 2}
    same, other = Q.differing_parts(a, a.repartition(5), levels)
    assert same.count() == other.count() == 0
    assert Q.mart_difference(a.limit(0), a, levels).count() == len(rows)
