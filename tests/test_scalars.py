"""Hand-computed edge cases of the column functions."""

import datetime as dt
import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from voltspan.functions import scalars as X
from voltspan.functions.dates import lagged_months, look_back, recent_months


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def column(spark, values, kind, expr):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}").orderBy("i")
    return [r[0] for r in df.select(expr.alias("r")).collect()]


def test_round_half_away(spark):
    values = [1.005, 2.5, -2.5, 0.125, -0.125, 1e300, None, 5e15, 0.0]
    assert column(spark, values, "double", X.round_half_away("v", 2)) == [
        1.0, 2.5, -2.5, 0.13, -0.13, 1e300, None, 5e15, 0.0,
    ]
    assert column(spark, [2.5, -2.5, 0.4], "double", X.round_half_away("v", 0)) == [3.0, -3.0, 0.0]


@settings(max_examples=20, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=50))
def test_rounding_stays_within_half_a_unit(spark, values):
    for v, r in zip(values, column(spark, values, "double", X.round_half_away("v", 2))):
        assert abs(v - r) <= 0.005 + 1e-9 * abs(v)


def test_surrogate_key_keeps_null_positions(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", "b")], "x string, y string")
    keys = [r[0] for r in df.select(X.surrogate_key("x", "y")).collect()]
    assert len(set(keys)) == 3
    assert keys[2] == hashlib.md5(b"a-b").hexdigest()
    assert keys[0] == hashlib.md5(f"a-{X.NULL_KEY_PART}".encode()).hexdigest()


def test_settlement_era_is_strict(spark):
    stamps = [dt.datetime(2021, 10, 1), dt.datetime(2021, 10, 1, 0, 5), None]
    assert column(spark, stamps, "timestamp_ntz", X.resolution_minutes("v")) == [30, 5, 30]


def test_midnight_belongs_to_the_new_day(spark):
    stamps = [dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 1, 23, 55)]
    assert column(spark, stamps, "timestamp_ntz", X.settlement_day("v")) == [
        dt.date(2024, 1, 2), dt.date(2024, 1, 1),
    ]
    assert column(spark, stamps, "timestamp_ntz", X.half_hour("v")) == [
        dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 1, 23, 30),
    ]


def test_positive_part_and_energy(spark):
    values = [-5.0, 0.0, 12.0, None]
    assert column(spark, values, "double", X.positive_part("v")) == [0.0, 0.0, 12.0, 0.0]
    assert column(spark, [12.0], "double", X.mwh_from_mw("v")) == [1.0]


def test_ratios_and_errors(spark):
    assert one(spark, X.safe_ratio(F.lit(1.0), F.lit(0.0))) == (None,)
    assert one(spark, X.percent_error(F.lit(-10.0), F.lit(-9.0))) == (-10.0,)
    assert one(spark, X.percent_error(F.lit(0.0), F.lit(1.0))) == (None,)


def test_strict_stamp_raises(spark):
    assert one(spark, X.strict_stamp(F.lit("2021/10/01 00:05:00"))) == (
        dt.datetime(2021, 10, 1, 0, 5),
    )
    with pytest.raises(PySparkException):
        one(spark, X.strict_stamp(F.lit("01.10.2021")))


def test_names(spark):
    assert one(spark, X.unquote(F.lit('"NSW1"'))) == ("NSW1",)
    assert one(spark, X.file_month(F.lit("/x/DISPATCH_UNIT_SCADA_202407.zip"),
                                   "DISPATCH_UNIT_SCADA")) == ("202407",)
    assert one(spark, X.file_month(F.lit("/x/other.zip"), "DISPATCH_UNIT_SCADA")) == ("",)


CLASSIFIED = [
    ("Brown Coal", None, "coal_brown"),
    ("Black Coal", "Steam", "coal_black"),
    ("Waste coal", "", "coal_black"),
    ("Grid", "Battery", "battery"),
    ("Water", "Run of river", "hydro"),
    ("Waste water", None, "hydro"),
    (None, "Hydro - Gravity", "hydro"),
    ("Wind", "Onshore", "wind"),
    ("Solar", None, "solar"),
    (None, "Photovoltaic panel", "solar"),
    ("Biogas", "Gas engine", "bioenergy"),
    ("Bagasse", "Steam", "bioenergy"),
    ("Natural Gas", "Combined Cycle", "gas_ccgt"),
    ("Natural Gas", "OCGT", "gas_ocgt"),
    ("Natural Gas", "Steam Turbine", "gas_steam"),
    ("Natural Gas", "Reciprocating", "gas_recip"),
    ("Natural Gas", None, "gas_other"),
    ("Fuel oil", None, "gas_other"),
    ("Fuel oil", "Steam", "gas_steam"),
    ("Diesel", "Reciprocating", "distillate"),
    ("Kerosene", None, "distillate"),
    ("Oil", None, "distillate"),
    ("Ethane", "Unknown", "other"),
    (None, None, "other"),
]


def test_classify_fueltech(spark):
    df = spark.createDataFrame(CLASSIFIED, "f string, t string, want string")
    bad = df.withColumn("got", X.classify_fueltech("f", "t")).filter("got <> want").collect()
    assert bad == []
    assert {w for _, _, w in CLASSIFIED} == {r for r in {w for _, _, w in CLASSIFIED}}
    assert len({w for _, _, w in CLASSIFIED}) == 14


def test_months_cross_the_year(spark):
    jan = F.lit("2024-01-15").cast("date")
    assert one(spark, recent_months(jan, 3)) == (["202310", "202311", "202312"],)
    assert one(spark, lagged_months(jan, 2)) == (["202310", "202311"],)


def test_look_back_includes_the_boundary(spark):
    days = spark.sql(
        "select explode(sequence(date'2024-01-01', date'2024-03-01', interval 1 day)) as d"
    )
    kept = [r.d for r in look_back(days, "d", 30).orderBy("d").collect()]
    assert len(kept) == 31 and kept[0] == dt.date(2024, 1, 31)
