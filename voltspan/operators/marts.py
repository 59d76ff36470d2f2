"""Facts and daily marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltspan.functions import scalars as X
from voltspan.functions.quantiles import median_from_buckets, value_bucket
from voltspan.session import fits_broadcast, stage


def fct_price_demand(stg: DataFrame) -> DataFrame:
    """Atomic fact, one row per region and settlement interval."""
    return stg.select(
        X.surrogate_key("region", "settlement_date").alias("price_demand_id"),
        "region",
        "settlement_date",
        X.settlement_day("settlement_date").alias("settlement_day"),
        "rrp_aud_mwh",
        "total_demand_mw",
        "resolution_min",
        (F.col("rrp_aud_mwh") < 0).alias("is_negative_price"),
    )


REGION_DAY = ["region", "settlement_day"]


def region_day_buckets(fact: DataFrame) -> DataFrame:
    """First pass of the daily rollup: totals per (region, day, price bucket).

    All totals combine before the shuffle, so the shuffle carries bucket rows, not readings,
    and a day with a third of all readings spreads over its buckets.
    """
    price, demand = F.col("rrp_aud_mwh"), F.col("total_demand_mw")
    return fact.groupBy(*REGION_DAY, value_bucket(price).alias("_bucket")).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count(price).alias("_n"),
        F.sum(price).alias("_sum"),
        F.min(price).alias("_lo"),
        F.max(price).alias("_hi"),
        F.count_if("is_negative_price").alias("_negative"),
        F.sum(demand).alias("_demand"),
        F.count(demand).alias("_demand_n"),
        F.min(demand).alias("_demand_lo"),
        F.max(demand).alias("_demand_hi"),
    )


def merged_buckets(buckets: DataFrame) -> DataFrame:
    """Bucket rows of several loads as one row per (region, day, price bucket): counts and sums add up, bounds widen.

    The table of a load and the table of many have the same columns, so states merge in any order.
    """
    add = ["_rows", "_n", "_sum", "_negative", "_demand", "_demand_n"]
    bounds = {"_lo": F.min, "_hi": F.max, "_demand_lo": F.min, "_demand_hi": F.max}
    return buckets.groupBy(*REGION_DAY, "_bucket").agg(
        *[F.sum(c).alias(c) for c in add], *[how(c).alias(c) for c, how in bounds.items()]
    )


def region_day_totals(buckets: DataFrame) -> DataFrame:
    """Everything of the daily rollup but the median."""
    return buckets.groupBy(*REGION_DAY).agg(
        F.sum("_rows").alias("interval_count"),
        X.settle("try_divide(sum(_sum), sum(_n))", 2).alias("avg_rrp"),
        X.round_half_away("min(_lo)", 2).alias("min_rrp"),
        X.round_half_away("max(_hi)", 2).alias("max_rrp"),
        F.sum("_negative").alias("negative_price_intervals"),
        X.settle("100d * sum(_negative) / sum(_rows)", 2).alias("negative_price_pct"),
        X.settle("try_divide(sum(_demand), sum(_demand_n))", 1).alias("avg_demand_mw"),
        X.round_half_away("max(_demand_hi)", 1).alias("peak_demand_mw"),
        X.round_half_away("min(_demand_lo)", 1).alias("min_demand_mw"),
    )


REGION_DAILY_COLUMNS = [
    "region", "settlement_day", "interval_count", "avg_rrp", "min_rrp", "max_rrp", "median_rrp",
    "negative_price_intervals", "negative_price_pct", "avg_demand_mw", "peak_demand_mw",
    "min_demand_mw",
]


def region_daily_schema() -> T.StructType:
    """The stored columns of the daily rollup."""
    kinds = {"region": "string", "settlement_day": "date", "interval_count": "bigint", "negative_price_intervals": "bigint"}
    return T.StructType.fromDDL(", ".join(f"{c} {kinds.get(c, 'double')}" for c in REGION_DAILY_COLUMNS))


def fct_region_daily(fact: DataFrame) -> DataFrame:
    """Daily price and demand statistics per region, exact median included.

    Two column-pruned reads of the fact and no shuffle of its rows: the first leaves the
    bucket table, the second only touches prices in the bucket that holds the median.
    """
    buckets = stage(region_day_buckets(fact), "region-day-buckets")
    return region_daily_from(buckets, fact)


def region_daily_from(buckets: DataFrame, prices: DataFrame) -> DataFrame:
    """The daily rollup from its stored buckets; ``prices`` are only read for the buckets in the middle."""
    median = median_from_buckets(
        prices,
        buckets.filter(F.col("_bucket").isNotNull()).select(
            *REGION_DAY, "_bucket", "_n", "_lo", "_hi"
        ),
        REGION_DAY,
        "rrp_aud_mwh",
        "_median",
    ).select(F.col("region").alias("_r"), F.col("settlement_day").alias("_d"), "_median")
    totals = region_day_totals(buckets)
    on = F.col("region").eqNullSafe(F.col("_r")) & F.col("settlement_day").eqNullSafe(F.col("_d"))
    return (
        totals.join(median, on, "left")
        .withColumn("median_rrp", X.settle("_median", 2))
        .select(*REGION_DAILY_COLUMNS)
    )


def _energy(mw: Column) -> list[Column]:
    mwh = mw * F.lit(5.0 / 60.0)
    return [mwh.alias("generation_mwh"), (mwh * F.lit(2.0)).alias("generation_avg_mw")]


def _output_by(
    scada: DataFrame, units: DataFrame, period: Column, name: str, broadcast_units: bool | None
) -> DataFrame:
    """Positive output summed by region, fuel-tech and period.

    While the unit table passes the size check it is broadcast: one map-side-combined
    shuffle. Beyond that the readings are first summed per (unit, period), which spreads a
    hot unit over its periods and shrinks the rows that take part in the shuffle join; sums
    of sums are the same totals.
    """
    readings = scada.select(
        "duid", period.alias(name), X.positive_part("scada_mw").alias("mw")
    )
    labels = units.select("duid", "region", "fueltech")
    if broadcast_units is None:
        broadcast_units = fits_broadcast(labels)
    if broadcast_units:
        joined = readings.join(F.broadcast(labels), "duid")
    else:
        joined = readings.groupBy("duid", name).agg(F.sum("mw").alias("mw")).join(labels, "duid")
    return joined.groupBy("region", "fueltech", name).agg(F.sum("mw").alias("mw"))


def fct_generation(
    scada: DataFrame, units: DataFrame, broadcast_units: bool | None = None
) -> DataFrame:
    """Energy by region, fuel-tech and 30 minutes; charging counts as zero.

    ``broadcast_units`` states the result of a size check made by the caller; None checks here.
    """
    name = "interval_start"
    totals = _output_by(scada, units, X.half_hour("settlement_date"), name, broadcast_units)
    return totals.select("region", "fueltech", name, *_energy(F.col("mw")))


def fct_generation_daily(generation: DataFrame) -> DataFrame:
    """Daily energy from the stored 30-minute fact."""
    return generation.groupBy(
        "region", "fueltech", F.to_date("interval_start").alias("settlement_day")
    ).agg(F.sum("generation_mwh").alias("generation_mwh"))


def generation_daily_from_readings(
    scada: DataFrame, units: DataFrame, broadcast_units: bool | None = None
) -> DataFrame:
    """The same daily energy straight from the readings, for when the 30-minute fact is not
    kept: a reading and its bucket share the calendar day, so the 30-minute level, and the
    shuffle of its many rows, can be left out."""
    name = "settlement_day"
    totals = _output_by(scada, units, X.settlement_day("settlement_date"), name, broadcast_units)
    return totals.select(
        "region", "fueltech", name, X.mwh_from_mw("mw").alias("generation_mwh")
    )


def fct_region_energy_daily(daily: DataFrame, fueltechs: DataFrame) -> DataFrame:
    """Renewable share, emissions and carbon intensity per region and day.

    Both ratios are null on a day without generation. The fuel-tech table carries its size
    (an inline or stored table), so the planner broadcasts it without a hint.
    """
    facts = fueltechs.select("fueltech", "is_renewable", "emission_factor_t_co2_per_mwh")
    mwh = F.col("generation_mwh")
    totals = daily.join(facts, "fueltech").groupBy("region", "settlement_day").agg(
        F.sum(mwh).alias("_total"),
        F.sum(F.when(F.col("is_renewable"), mwh).otherwise(0.0)).alias("_renewable"),
        F.sum(mwh * F.col("emission_factor_t_co2_per_mwh")).alias("_emissions"),
    )
    return totals.select(
        "region",
        "settlement_day",
        X.settle("_total", 1).alias("total_generation_mwh"),
        X.settle("_renewable", 1).alias("renewable_mwh"),
        X.settle("100d * _renewable / nullif(_total, 0d)", 2).alias("renewable_share_pct"),
        X.settle("_emissions", 1).alias("est_emissions_tco2"),
        X.settle("1000d * _emissions / nullif(_total, 0d)", 1).alias(
            "est_carbon_intensity_kg_per_mwh"
        ),
    )


def fct_demand_forecast(forecast: DataFrame) -> DataFrame:
    return forecast.select(
        "region",
        "model",
        F.col("forecast_date").cast("date").alias("forecast_date"),
        X.settle("predicted_demand_mw", 1).alias("predicted_demand_mw"),
        X.settle("lo_90", 1).alias("lo_90"),
        X.settle("hi_90", 1).alias("hi_90"),
        "generated_at",
    )


def fct_forecast_accuracy(accuracy: DataFrame) -> DataFrame:
    return accuracy.select("region", "model", "mae", "rmse", "mape", "n_windows", "horizon")


def fct_engine_benchmark(rows: DataFrame) -> DataFrame:
    doubles = ["mae", "rmse", "mape"]
    return rows.select(
        "region",
        "engine",
        "model",
        *[F.col(c).cast("double").alias(c) for c in doubles],
        F.col("holdout_start").cast("date").alias("holdout_start"),
        F.col("holdout_end").cast("date").alias("holdout_end"),
    )


def fct_price_anomalies(rows: DataFrame) -> DataFrame:
    def number(c: str) -> Column:
        return F.col(c).cast("double")

    return rows.select(
        "region",
        F.col("settlement_day").cast("date").alias("settlement_day"),
        *[number(c).alias(c) for c in ["avg_rrp", "expected_rrp", "lower_bound", "upper_bound"]],
        F.col("is_anomaly").cast("boolean").alias("is_anomaly"),
        number("distance").alias("distance"),
        (number("avg_rrp") - number("expected_rrp")).alias("surprise_aud_mwh"),
    )


def generation_labelled(
    daily: DataFrame, fueltechs: DataFrame, regions: DataFrame
) -> DataFrame:
    """Daily generation with both of its small dimensions."""
    fuel = fueltechs.select("fueltech", "fueltech_label", "fuel_group", "is_renewable")
    region = regions.select(F.col("region_id").alias("region"), "region_name")
    return (
        daily.join(fuel, "fueltech")
        .join(region, "region")
        .select(
            "region", "region_name", "settlement_day", "fueltech", "fueltech_label", "fuel_group",
            "is_renewable", "generation_mwh",
        )
    )
