"""Edge rows of staging, dimensions and marts."""

import datetime as dt

from pyspark.sql import functions as F

from voltspan.operators import dims, marts, staging, summaries
from voltspan.sources import reference, schemas

T = dt.datetime


def price_rows(spark, rows):
    full = [(r, ts, d, p, "TRADE", ts.strftime("%Y%m"), "f.csv") for r, ts, d, p in rows]
    return spark.createDataFrame(full, schemas.PRICE_DEMAND)


def scada_rows(spark, rows):
    return spark.createDataFrame(
        [(ts, u, mw, ts.strftime("%Y%m")) for ts, u, mw in rows], schemas.DISPATCH_SCADA
    )


def daily(spark, rows):
    fact = marts.fct_price_demand(staging.stg_price_demand(price_rows(spark, rows)))
    return {(r.region, r.settlement_day): r for r in marts.fct_region_daily(fact).collect()}


def test_region_daily(spark):
    got = daily(spark, [
        ("SA1", T(2024, 1, 1, 0, 5), 10.0, 0.0),
        ("SA1", T(2024, 1, 1, 12), 20.0, -0.01),
        ("SA1", T(2024, 1, 1, 18), 60.0, None),
        ("SA1", T(2024, 1, 2), 5.0, 100.0),
        ("VIC1", T(2024, 1, 1, 1), None, 7.0),
        ("VIC1", T(2024, 1, 1, 2), 3.0, 9.0),
        ("VIC1", T(2024, 1, 1, 3), 4.0, 50.0),
        ("TAS1", T(2024, 1, 1, 3), 4.0, None),
    ])
    a = got["SA1", dt.date(2024, 1, 1)]
    assert (a.interval_count, a.negative_price_intervals, a.negative_price_pct) == (3, 1, 33.33)
    assert (a.avg_rrp, a.min_rrp, a.max_rrp, a.median_rrp) == (-0.01, -0.01, 0.0, -0.01)
    assert (a.avg_demand_mw, a.peak_demand_mw, a.min_demand_mw) == (30.0, 60.0, 10.0)
    assert got["SA1", dt.date(2024, 1, 2)].interval_count == 1
    v = got["VIC1", dt.date(2024, 1, 1)]
    assert (v.median_rrp, v.avg_demand_mw) == (9.0, 3.5)
    t = got["TAS1", dt.date(2024, 1, 1)]
    assert (t.avg_rrp, t.median_rrp, t.interval_count) == (None, None, 1)


def test_mean_rounds_on_the_binary_value(spark):
    got = daily(spark, [("SA1", T(2024, 1, 1, 1), 1.0, 1.0), ("SA1", T(2024, 1, 1, 2), 1.0, 1.01)])
    assert got["SA1", dt.date(2024, 1, 1)].avg_rrp == 1.0


def test_month_trim(spark):
    spill = [(T(2024, 1, 31, 23, 55), "A", 1.0), (T(2024, 2, 1), "A", 1.0)]
    kept = staging.stg_dispatch_scada(scada_rows(spark, spill)).collect()
    assert [r.settlement_date for r in kept] == [T(2024, 1, 31, 23, 55)]
    half = [(T(2024, 1, 10), "A", 1.0), (T(2024, 2, 14), "A", 1.0)]
    assert staging.stg_dispatch_scada(scada_rows(spark, half)).count() == 1
    # the newest stamp counts even when its value is missing
    null_end = [(T(2024, 1, 10), "A", 1.0), (T(2024, 2, 1), "A", None)]
    assert staging.stg_dispatch_scada(scada_rows(spark, null_end)).count() == 1


REGISTRY = [
    (1, "U1", " Old ", "SA1", "Generating", "Wind", "Onshore", "5"),
    (2, " U1 ", "New", "SA1", "Generating", "Solar", None, "n/a"),
    (3, "U2", None, "VIC1", None, "Water", None, ""),
    (4, "  ", "Blank", "VIC1", None, "Water", None, "1"),
    (5, None, "Null", "VIC1", None, "Water", None, "1"),
    (6, "U3", "Far", "WEM1", None, "Wind", None, "7.5"),
    (7, "U4", "Nowhere", None, None, "Grid", "Battery", "8"),
    (8, "U5", "Cell", "TAS1", None, "Grid", "Battery", "8"),
]


def units(spark):
    rows = spark.createDataFrame(
        REGISTRY, "ordinal long, " + ", ".join(f"`{c}` string" for c in schemas.REGISTRY_COLUMNS)
    )
    return dims.unit_seed(rows)


def test_unit_seed_last_wins(spark):
    got = {r.duid: r for r in units(spark).collect()}
    assert set(got) == {"U1", "U2", "U3", "U4", "U5"}
    assert (got["U1"].station_name, got["U1"].fueltech) == ("New", "solar")
    assert got["U2"].station_name == "" and got["U4"].region == ""


def test_dim_duid(spark):
    got = {r.duid: r.reg_cap_mw for r in dims.dim_duid(units(spark)).collect()}
    assert got == {"U1": None, "U2": None, "U5": 8.0}


READINGS = [
    (T(2024, 1, 1, 0, 0), "U1", 12.0),
    (T(2024, 1, 1, 0, 25), "U1", 24.0),
    (T(2024, 1, 1, 0, 30), "U1", -6.0),
    (T(2024, 1, 1, 0, 5), "U5", -3.0),
    (T(2024, 1, 1, 0, 5), "U3", 50.0),
    (T(2024, 1, 1, 0, 5), "U9", 50.0),
    (T(2024, 2, 1, 0, 0), "U1", 12.0),
]


def test_generation(spark):
    scada = staging.stg_dispatch_scada(scada_rows(spark, READINGS))
    dim = dims.dim_duid(units(spark))
    want = {
        ("SA1", "solar", T(2024, 1, 1, 0, 0), 3.0, 6.0),
        ("SA1", "solar", T(2024, 1, 1, 0, 30), 0.0, 0.0),
        ("TAS1", "battery", T(2024, 1, 1, 0, 0), 0.0, 0.0),
    }
    for broadcast in (None, False):
        rows = marts.fct_generation(scada, dim, broadcast).collect()
        assert {tuple(r) for r in rows} == want
    energy = marts.fct_region_energy_daily(
        marts.fct_generation_daily(marts.fct_generation(scada, dim)),
        dims.dim_fueltech(reference.fueltech_seed(spark)),
    )
    got = {r.region: r for r in energy.collect()}
    assert got["SA1"].renewable_share_pct == 100.0
    assert got["SA1"].est_carbon_intensity_kg_per_mwh == 0.0
    # no generation at all on the day: both ratios are null
    assert got["TAS1"].total_generation_mwh == 0.0
    assert got["TAS1"].renewable_share_pct is None
    assert got["TAS1"].est_carbon_intensity_kg_per_mwh is None


def test_battery_counts_in_the_denominator(spark):
    rows = [("SA1", "battery", dt.date(2024, 1, 1), 5.0), ("SA1", "wind", dt.date(2024, 1, 1), 5.0),
            ("VIC1", "battery", dt.date(2024, 1, 1), 5.0)]
    df = spark.createDataFrame(
        rows, "region string, fueltech string, settlement_day date, generation_mwh double"
    )
    got = {
        r.region: (r.renewable_share_pct, r.est_carbon_intensity_kg_per_mwh)
        for r in marts.fct_region_energy_daily(
            df, dims.dim_fueltech(reference.fueltech_seed(spark))
        ).collect()
    }
    assert got == {"SA1": (50.0, 0.0), "VIC1": (0.0, 0.0)}


def test_top_fueltechs_keeps_unmapped(spark):
    readings = [(T(2024, 1, 1), "U1", 12000.0), (T(2024, 1, 1), "U9", 24000.0),
                (T(2024, 1, 1), "U3", 36000.0), (T(2024, 1, 1), "U1", -5000.0)]
    got = summaries.top_fueltechs(scada_rows(spark, readings), units(spark)).collect()
    assert [tuple(r) for r in got] == [("wind", 3.0), ("UNMAPPED", 2.0), ("solar", 1.0)]


def test_daily_energy_is_the_sum_of_half_hours(spark):
    readings = [(T(2024, 1, 1 + i % 3, i % 24, 5 * (i % 12)), "U1", float(i % 40 - 5))
                for i in range(400)] + [(T(2024, 2, 1), "U1", 1.0)]
    half = marts.fct_generation(
        staging.stg_dispatch_scada(scada_rows(spark, readings)), dims.dim_duid(units(spark))
    )
    a = half.agg(F.sum("generation_mwh")).first()[0]
    b = marts.fct_generation_daily(half).agg(F.sum("generation_mwh")).first()[0]
    assert abs(a - b) < 1e-9
    scada = staging.stg_dispatch_scada(scada_rows(spark, readings))
    for broadcast in (True, False):
        direct = marts.generation_daily_from_readings(scada, dims.dim_duid(units(spark)), broadcast)
        c = direct.agg(F.sum("generation_mwh"), F.count("*")).first()
        assert abs(a - c[0]) < 1e-9 and c[1] == 3
    assert abs(a - sum(max(mw, 0) for _, _, mw in readings[:-1]) / 12) < 1e-6
