"""Incremental jobs run to the end of the available input (inventory M)."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltspan.plans.oracle import sql
from voltspan.plans.registry import q6, query
from voltspan.plans.scan_queries import land_record_files
from voltspan.session import fresh_path
from voltspan.sources import adapters
from voltspan.streaming import incremental


@query("m1_incremental_landing", sql("""select source_month, count(*) as n, count(scada_mw) as
    with_value from scada group by 1""", "scada"))
def _(t):
    source, target = land_record_files(t), fresh_path(t.spark, "landed")
    checkpoint = fresh_path(t.spark, "landing-checkpoint")
    for _run in range(2):  # the second run finds no new file
        landed = incremental.land_new_records(t.spark, source, target, checkpoint)
    return landed.groupBy("source_month").agg(
        F.count(F.lit(1)).alias("n"), F.count("scada_mw").alias("with_value")
    )


def price_stream(t):
    """The events as a stream of price readings."""
    events = incremental.file_stream(t.spark, f"{t.sf_dir}/events.parquet", t.table("events").schema)
    return adapters.price_demand_from(events)


def unit_output(price):
    """Price readings as output of one unit per region."""
    return price.select(
        "settlement_date", F.col("region").alias("duid"),
        F.col("total_demand_mw").alias("scada_mw"), "source_month",
    )


def region_units(t):
    return t.dim_region.select(
        F.col("region_id").alias("duid"), F.col("region_id").alias("region"),
        F.lit("solar").alias("fueltech"),
    )


def streamed_energy(t):
    energy = incremental.half_hour_energy(unit_output(price_stream(t)), region_units(t), "2 hours")
    return incremental.stream_to_parquet(
        energy, fresh_path(t.spark, "energy"), fresh_path(t.spark, "energy-checkpoint")
    )


@query("m2_stream_half_hour_energy", sql("""select region, 'solar' as fueltech,
    time_bucket(interval '30 minutes', settlement_date) as interval_start,
    round(sum(greatest(total_demand_mw, 0)) * (5.0::double / 60.0::double), 6) as generation_mwh,
    round(sum(greatest(total_demand_mw, 0)) * (5.0::double / 60.0::double) * 2.0::double, 6)
    as generation_avg_mw
    from price_demand group by 1, 2, 3 having time_bucket(interval '30 minutes',
    settlement_date) + interval '30 minutes' <= (select max(settlement_date) from price_demand)
    - interval '2 hours'""".replace("having time_bucket(interval '30 minutes',\n    settlement_date)",
    "having interval_start"), "price_demand"))
def _(t):
    """Event readings as a stream of unit output; buckets the watermark has closed."""
    return q6(streamed_energy(t), "generation_mwh", "generation_avg_mw")


@query("m2_reconciled_half_hour_energy", sql("""select region, 'solar' as fueltech,
    time_bucket(interval '30 minutes', settlement_date) as interval_start,
    round(sum(greatest(total_demand_mw, 0)) * (5.0::double / 60.0::double), 6) as generation_mwh,
    round(sum(greatest(total_demand_mw, 0)) * (5.0::double / 60.0::double) * 2.0::double, 6)
    as generation_avg_mw from price_demand group by 1, 2, 3""", "price_demand"))
def _(t):
    """The stream's buckets and the ledger of what it lacks: every bucket, as in a batch."""
    streamed, units = streamed_energy(t), region_units(t)
    ledger = incremental.late_ledger(streamed, unit_output(t.raw_price), units)
    return q6(incremental.with_ledger(streamed, ledger), "generation_mwh", "generation_avg_mw")


@query("m3_incremental_region_daily", sql("select * from region_daily", "region_daily"))
def _(t):
    """Raw price rows arriving file by file; the daily mart after the last batch."""
    state, daily = fresh_path(t.spark, "daily-state"), fresh_path(t.spark, "daily")
    incremental.refresh_region_daily(price_stream(t), state, daily, fresh_path(t.spark, "daily-checkpoint"))
    return incremental.read_daily(t.spark, daily)
