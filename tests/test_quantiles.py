"""The narrowing median against the definition."""

import math
import random
import statistics

import pytest

from voltspan.functions import quantiles
from voltspan.functions.quantiles import exact_median


def data():
    rnd = random.Random(7)
    groups = {
        "odd": [3.0, -1.0, 7.5],
        "even": [1.0, 2.0, 10.0, 400.0],
        "one": [5.0],
        "ties": [2.0] * 7 + [3.0] * 7,
        "negative": [-rnd.random() * 1000 for _ in range(101)],
        "wide": [rnd.choice([-1, 1]) * 10 ** rnd.uniform(-6, 9) for _ in range(500)],
        "zeroish": [0.0, -0.0, 1e-12, -1e-12],
        None: [4.0, 8.0],
    }
    # one group with most of the rows
    groups["hot"] = [rnd.gauss(50, 200) for _ in range(4000)]
    return groups


@pytest.mark.parametrize("rank_rows", [quantiles.RANK_ROWS, 1])
def test_median_per_group(spark, rank_rows, monkeypatch):
    monkeypatch.setattr(quantiles, "SLICES", 8)
    groups = data()
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("odd", None), ("void", None)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    got = {r.k: r.m for r in exact_median(df, ["k"], "v", "m", rank_rows).collect()}
    want = {k: statistics.median(vs) for k, vs in groups.items()}
    assert got == want


def test_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "BROADCAST_MAX_ROWS", 0)
    groups = data()
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs],
                               "k string, v double")
    got = {r.k: r.m for r in exact_median(df, ["k"], "v", "m", 1).collect()}
    assert got == {k: statistics.median(vs) for k, vs in groups.items()}


def test_nan_and_infinity_sort_high(spark):
    rows = [("a", 1.0), ("a", math.inf), ("a", math.nan), ("b", math.inf), ("b", -math.inf),
            ("b", 2.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    for rank_rows in (10, 0):
        got = {r.k: r.m for r in exact_median(df, ["k"], "v", "m", rank_rows).collect()}
        assert got == {"a": math.inf, "b": 2.0}
