"""The whole batch pipeline into tables, gated by its checks; shared-folder rules."""

import datetime as dt
import zipfile

import pytest

from voltspan import session
from voltspan.plans import build
from voltspan.plans.registry import Tables
from voltspan.sources import landing, reference


@pytest.fixture
def schemas(spark, tmp_path):
    for name in ("raw", "staging", "marts", "forecast"):
        spark.sql(f"create database {name} location '{tmp_path}/{name}'")
    yield
    for name in ("raw", "staging", "marts", "forecast"):
        spark.sql(f"drop database {name} cascade")


def test_full_build(spark, sf_dir, schemas):
    t = Tables(spark, sf_dir)
    build.build_price(spark, t.raw_price, reference.region_seed(spark))
    build.build_generation(spark, t.raw_scada, t.unit_seed, reference.fueltech_seed(spark))
    build.build_forecast(spark, ["SeasonalNaive", "AutoETS"], min_intervals=1)
    build.build_anomalies(spark, "2024-01-20")
    names = [r.tableName for r in spark.sql("show tables in marts").collect() if not r.isTemporary]
    assert set(names) == {
        "dim_region", "fct_price_demand", "fct_region_daily", "dim_duid", "dim_fueltech",
        "fct_generation", "fct_generation_daily", "fct_region_energy_daily",
        "fct_forecast_accuracy", "fct_demand_forecast", "fct_price_anomalies",
    }
    tables = {n: spark.table(f"marts.{n}") for n in names}
    tables["stg_price_demand"] = spark.table("stg_price_demand")
    tables["stg_dispatch_scada"] = spark.table("stg_dispatch_scada")
    # accuracy in percent is unbounded for the tiny daily series of this data set
    tables.pop("fct_forecast_accuracy")
    summary = build.check_build(spark, tables)
    assert summary.count() > 45
    assert spark.table("marts.fct_price_demand").count() == t.raw_price.count()
    again = build.build_price(spark, t.raw_price, reference.region_seed(spark))
    assert again is None and spark.table("marts.fct_region_daily").count() > 0


def test_refresh_from_landed_files(spark, tmp_path, schemas):
    """Sixty days (1 January to 1 March 00:00) of hourly readings for two regions and two units, as files."""
    price, records = tmp_path / "price", tmp_path / "records"
    price.mkdir(), records.mkdir()
    start = dt.datetime(2024, 1, 1, 1)
    stamps = [start + dt.timedelta(hours=h) for h in range(60 * 24)]
    for region, base in (("SA1", 1500), ("VIC1", 5000)):
        for month in ("202401", "202402", "202403"):
            rows = [f"{region},{t:%Y/%m/%d %H:%M:%S},{base + 10 * t.hour + 50 * (t.weekday() > 4)},"
                    f"{t.hour * 5 - 20},TRADE" for t in stamps if f"{t:%Y%m}" == month]
            (price / f"PRICE_AND_DEMAND_{month}_{region}.csv").write_text(
                "REGION,SETTLEMENTDATE,TOTALDEMAND,RRP,PERIODTYPE\n" + "\n".join(rows) + "\n")
    for month in ("202401", "202402", "202403"):
        lines = [f'D,DISPATCH,UNIT_SCADA,1,"{t:%Y/%m/%d %H:%M:%S}",{u},{mw},"x"'
                 for t in stamps if f"{t:%Y%m}" == month for u, mw in (("W1", 60), ("C1", 120))]
        with zipfile.ZipFile(records / f"DISPATCH_UNIT_SCADA_{month}.zip", "w") as z:
            z.writestr("a.CSV", "C,x\n" + "\n".join(lines) + "\n")
    registry = landing.with_registry_columns(spark.createDataFrame(
        [("1", "W1", "SA1", "Wind"), ("2", "C1", "SA1", "Brown coal")],
        "ordinal string, DUID string, Region string, `Fuel Source - Descriptor` string"))
    summary = build.refresh(
        spark, str(price), str(records), registry, min_intervals=20, train_end="2024-02-10")
    got = {(r.table_name, r.check_name): r.failures for r in summary.collect()}
    assert len(got) == 68 and set(got.values()) == {0}
    assert spark.table("raw.price_demand").count() == 2 * len(stamps)
    assert spark.table("raw.dispatch_unit_scada").count() == 2 * len(stamps)
    # the data ends on 1 March 00:00, which the trim removes
    energy = spark.table("marts.fct_region_energy_daily").orderBy("settlement_day").collect()
    assert len(energy) == 60 and energy[5].renewable_share_pct == 33.33
    assert energy[5].est_carbon_intensity_kg_per_mwh == 800.0
    daily = spark.table("marts.fct_region_daily")
    first = daily.orderBy("settlement_day").first()
    last = daily.orderBy(daily.settlement_day.desc()).first()
    # interval-ending stamps: the first day is one short, the last holds the 00:00 reading only
    assert (first.interval_count, last.interval_count) == (23, 1)
    models = {r.model for r in spark.table("marts.fct_demand_forecast").collect()}
    # two months are too short for a yearly season
    assert models == {"SeasonalNaive", "AutoETS"}
    bench = spark.table("marts.fct_engine_benchmark")
    assert bench.count() == 4 and bench.filter("mape > 5").count() == 0


class FakeSession:
    """Only what the folder rule looks at."""

    def __init__(self, master, folder):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda k, d=None: folder or d)})


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_dir(FakeSession("spark://host:7077", "s3a://bucket/x/")) == "s3a://bucket/x"
    assert session.shared_dir(FakeSession("local[2]", "/shared")) == "/shared"
    with pytest.raises(RuntimeError):
        session.shared_dir(FakeSession("yarn", None))
    assert session.shared_dir(FakeSession("local[2]", None)) == session.shared_dir(
        FakeSession("local[2]", None))
    assert session.stage(spark.range(5), "numbers").count() == 5


def test_size_check(spark):
    assert session.fits_broadcast(spark.range(10), 10)
    assert not session.fits_broadcast(spark.range(11), 10)
