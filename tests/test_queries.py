"""Registered queries against their SQL on the smallest data set, and the driver contract."""

import importlib.util
from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from voltspan.plans.catalog import ORACLES, QUERIES

_spec = importlib.util.spec_from_file_location(
    "compare", Path(__file__).resolve().parent.parent / "tools" / "compare.py")
compare = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(compare)

# one of each family; tools/compare.py runs them all
SAMPLE = [
    "a1_price_csv_scan", "a7_tolerant_number", "a18_landing_coverage", "b2_append_by_month",
    "c5_month_trim", "d12_round", "d18_classify_fueltech", "e8_orphans", "f1_region_daily",
    "f2_exact_median", "f5_generation_half_hour", "f5_generation_half_hour_shuffled",
    "f7_region_energy_daily", "f22_last_wins", "g2_share_of_total", "j2_rolling_backtest",
    "j4_smoothing_backtest", "j5_decomposition_backtest", "j8_engine_benchmark", "j10_price_anomalies", "k5_unique_combination", "l1_nem_latest",
    "l14_actual_and_forecast", "m2_stream_half_hour_energy",
]


@pytest.mark.parametrize("name", SAMPLE)
def test_against_sql(spark, sf_dir, name):
    con = compare.connect(sf_dir)
    state, _, rows, note = compare.compare(spark, con, sf_dir, name, QUERIES[name], ORACLES[name])
    assert state == "ok", note
    assert rows > 0


def test_contract(spark):
    assert entry_point.queries().keys() >= entry_point.oracle_sql().keys()
    df = entry_point.entry(spark)
    assert df.columns == ["region_name", "month", "avg_rrp"]
    assert df.count() > 0


def test_every_query_has_its_sql():
    assert sorted(set(QUERIES) - set(ORACLES)) == []
