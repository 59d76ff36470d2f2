import datetime as dt

import pytest
from pyspark.sql import functions as F

from voltspan.functions.quantiles import value_bucket
from voltspan.operators import dims, marts, staging
from voltspan.sources import schemas
from voltspan.streaming import incremental

T = dt.datetime
LINE = 'D,DISPATCH,UNIT_SCADA,1,"{ts}",{unit},{mw},"{ts}"\n'


def test_second_run_adds_nothing(spark, tmp_path):
    src, out, chk = (str(tmp_path / n) for n in ("in", "out", "chk"))
    (tmp_path / "in").mkdir()

    def write(month, n):
        text = "C,x\n" + "".join(
            LINE.format(ts=f"2024/{month}/01 00:{5 * i:02d}:00", unit="U1", mw=i) for i in range(n))
        (tmp_path / "in" / f"DISPATCH_UNIT_SCADA_2024{month}.csv").write_text(text)

    write("07", 3)
    assert incremental.land_new_records(spark, src, out, chk).count() == 3
    assert incremental.land_new_records(spark, src, out, chk).count() == 3
    write("08", 4)
    got = incremental.land_new_records(spark, src, out, chk)
    assert {r["source_month"]: r["count"] for r in got.groupBy("source_month").count().collect()} == {
        "202407": 3, "202408": 4}


def readings():
    rows = []
    for i in range(200):
        ts = T(2024, 1, 1) + dt.timedelta(minutes=5 * i)
        rows += [(ts, "A", float(i % 30 - 3), "202401"), (ts, "B", float(i % 7), "202401"),
                 (ts, "Z", 9.0, "202401")]
    return rows


def test_stream_equals_batch_on_closed_buckets(spark, tmp_path):
    rows = readings()
    df = spark.createDataFrame(rows, schemas.DISPATCH_SCADA)
    df.orderBy("settlement_date").coalesce(1).write.parquet(str(tmp_path / "src"))
    units = spark.createDataFrame([("A", "SA1", "wind"), ("B", "SA1", "wind")],
                                  "duid string, region string, fueltech string")
    feed = incremental.file_stream(spark, str(tmp_path / "src"), schemas.DISPATCH_SCADA)
    out = incremental.stream_to_parquet(
        incremental.half_hour_energy(feed, units, "1 hour"),
        str(tmp_path / "out"), str(tmp_path / "chk"))
    closed = max(r[0] for r in rows) - dt.timedelta(hours=1, minutes=30)
    batch = marts.fct_generation(df, units).filter(F.col("interval_start") <= F.lit(closed))
    key = ["region", "fueltech", "interval_start", "generation_mwh"]
    assert sorted(map(tuple, out.select(key).collect())) == sorted(map(tuple, batch.select(key).collect()))
    assert out.count() > 25


def test_stream_and_ledger_equal_the_batch(spark, tmp_path):
    rows = readings()
    late = [(T(2024, 1, 1, 1, 5), "A", 50.0, "202401"), (T(2023, 12, 31, 1, 5), "B", 70.0, "202312"), (T(2024, 1, 1, 2, 5), "Z", 1.0, "202401")]
    units = spark.createDataFrame([("A", "SA1", "wind"), ("B", "SA1", "wind")], "duid string, region string, fueltech string")
    args = units, "1 hour"
    for part in (rows, late, [(T(2024, 1, 2, 12), "A", 1.0, "202401")]):
        spark.createDataFrame(part, schemas.DISPATCH_SCADA).coalesce(1).write.mode("append").parquet(str(tmp_path / "src"))
        feed = incremental.file_stream(spark, str(tmp_path / "src"), schemas.DISPATCH_SCADA)
        out = incremental.stream_to_parquet(incremental.half_hour_energy(feed, *args), str(tmp_path / "out"), str(tmp_path / "chk"))
    raw = spark.read.parquet(str(tmp_path / "src"))
    batch = marts.fct_generation(raw, units)
    ledger = incremental.late_ledger(out, raw, units)
    reasons = {(r.interval_start, r.reason): r.generation_mwh for r in ledger.collect()}
    # one bucket closed without a late reading, one was never given, one is still open
    assert reasons == pytest.approx({
        (T(2024, 1, 1, 1), "late"): 50.0 * 5 / 60, (T(2023, 12, 31, 1), "missing"): 70.0 * 5 / 60, (T(2024, 1, 2, 12), "missing"): 5 / 60
    })
    key = ["region", "fueltech", "interval_start"]
    got = {tuple(r)[:3]: (r.generation_mwh, r.generation_avg_mw) for r in incremental.with_ledger(out, ledger).collect()}
    want = {tuple(r[k] for k in key): (r.generation_mwh, r.generation_avg_mw) for r in batch.collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    recent = incremental.late_ledger(out, raw, units, "2024-01-02")
    assert [r.reason for r in recent.collect()] == ["missing"]


def test_daily_refresh_merges_batches_with_late_rows(spark, tmp_path):
    def price(day, minute, p):
        ts = T(2024, 1, day) + dt.timedelta(minutes=minute)
        return ("SA1", ts, 100.0 + (p or 0), p, "TRADE", "202401", "f")

    src = tmp_path / "src"
    batches = [
        [price(1, h, float(h)) for h in range(60, 100)] + [price(2, 1, 5.0)],
        [price(2, 2, -7.0), price(3, 4, 1.0), price(4, 5, None)],
        # late rows move the median of the first day to another bucket; the third has one more reading
        [price(1, h, 900.0 + h) for h in range(100, 180)] + [price(3, 5, 2.0)],
        [price(5, 1, float("nan")), price(5, 2, 3.0), price(5, 3, 4.0)],
    ]
    state, daily, chk = (str(tmp_path / n) for n in ("state", "daily", "chk"))
    total, files = [], []
    for part in batches:
        spark.createDataFrame(part, schemas.PRICE_DEMAND).coalesce(1).write.mode("append").parquet(str(src))
        total += part
        feed = incremental.file_stream(spark, str(src), schemas.PRICE_DEMAND)
        incremental.refresh_region_daily(feed, state, daily, chk)
        want = marts.fct_region_daily(marts.fct_price_demand(staging.stg_price_demand(
            spark.createDataFrame(total, schemas.PRICE_DEMAND))))
        got = incremental.read_daily(spark, daily)
        assert got.schema.simpleString() == want.schema.simpleString()
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        files.append({p.name for p in (tmp_path / "daily").glob("batch=*/*.parquet")})
    # a batch adds rows of the days it touches and leaves earlier files as they are
    assert all(a < b for a, b in zip(files, files[1:]))
    days = [{r.settlement_day.day for r in spark.read.parquet(f"{daily}/batch={i}").collect()} for i in range(4)]
    assert days == [{1, 2}, {2, 3, 4}, {1, 3}, {5}]
    assert dims.last_per_key(got, "settlement_day", "interval_count").count() == 5


def test_only_middle_buckets_are_read_again(spark, tmp_path):
    rows = [("SA1", T(2024, 1, 1) + dt.timedelta(minutes=i), 1.0, float(i), "TRADE", "202401", "f") for i in range(1, 1000)]
    fact = marts.fct_price_demand(staging.stg_price_demand(spark.createDataFrame(rows, schemas.PRICE_DEMAND)))
    prices = fact.select(*marts.REGION_DAY, value_bucket("rrp_aud_mwh").alias("_bucket"), "rrp_aud_mwh")
    prices.write.parquet(str(tmp_path / "prices"))
    stored = spark.read.parquet(str(tmp_path / "prices"))
    few = incremental.prices_in_middle(stored, marts.region_day_buckets(fact))
    assert 0 < few.count() < 100
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = few._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(_bucket" in pushed and "LessThanOrEqual(settlement_day" in pushed


def test_bucket_states_merge_in_any_order(spark):
    rows = [("SA1", T(2024, 1, 1 + i % 3) + dt.timedelta(minutes=i), float(i % 7), float(i % 11) - 3 if i % 5 else None, "TRADE", "202401", "f")
            for i in range(1, 200)]
    fact = marts.fct_price_demand(staging.stg_price_demand(spark.createDataFrame(rows, schemas.PRICE_DEMAND)))
    parts = [marts.region_day_buckets(fact.filter(f"pmod(hash(settlement_date), 3) = {i}")) for i in range(3)]
    whole = sorted(map(str, marts.region_day_buckets(fact).select(*sorted(parts[0].columns)).collect()))
    for a, b, c in (parts, parts[::-1]):
        merged = marts.merged_buckets(marts.merged_buckets(a.unionByName(b)).unionByName(c))
        assert sorted(map(str, merged.select(*sorted(parts[0].columns)).collect())) == whole


def test_stream_reads_a_table_of_part_files(spark, sf_dir, tmp_path):
    from voltspan.plans.catalog import QUERIES

    spark.read.parquet(f"{sf_dir}/events.parquet").repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    (tmp_path / "region.parquet").symlink_to(f"{sf_dir}/region.parquet")
    one = QUERIES["m2_stream_half_hour_energy"](spark, sf_dir)
    parts = QUERIES["m2_stream_half_hour_energy"](spark, str(tmp_path))
    assert one.count() > 0 and sorted(map(tuple, one.collect())) == sorted(map(tuple, parts.collect()))
