"""Report queries. Each takes marts (stored tables) and returns a small result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltspan.functions import scalars as X
from voltspan.functions.dates import look_back


def _share(num: str, den: str, factor: float = 1.0) -> Column:
    """Ratio of sums, null when the denominator is zero."""
    return X.safe_ratio(F.lit(factor) * F.sum(num), F.sum(den))


def _month() -> Column:
    return X.month_of("settlement_day").alias("month")


# -------------------------------------------------------------------- overview page
def nem_latest(energy: DataFrame) -> DataFrame:
    """Renewable share and carbon intensity of the latest month, all regions together."""
    return (
        energy.groupBy(_month())
        .agg(
            _share("renewable_mwh", "total_generation_mwh").alias("renewable_share_pct"),
            _share("est_emissions_tco2", "total_generation_mwh", 1000.0).alias("carbon_intensity"),
        )
        .orderBy(F.col("month").desc())
        .limit(1)
    )


def price_latest(daily: DataFrame, days: int = 30) -> DataFrame:
    return look_back(daily, "settlement_day", days).agg(
        F.avg("avg_rrp").alias("avg_price"), F.avg("avg_demand_mw").alias("avg_demand")
    )


def nem_ren_trend(energy: DataFrame) -> DataFrame:
    return (
        energy.groupBy(_month())
        .agg(_share("renewable_mwh", "total_generation_mwh").alias("renewable_share_pct"))
        .orderBy("month")
    )


def _gwh() -> Column:
    return (F.sum("generation_mwh") / F.lit(1000.0)).alias("gwh")


def fuel_mix_recent(generation: DataFrame, days: int = 30) -> DataFrame:
    return (
        look_back(generation, "settlement_day", days)
        .groupBy("fuel_group")
        .agg(_gwh())
        .orderBy(F.col("gwh").desc(), "fuel_group")
    )


# ---------------------------------------------------------------------- prices page
def _monthly_mean(daily: DataFrame, col: str, alias: str, divide: float = 1.0) -> DataFrame:
    """Unweighted mean of the daily values."""
    return (
        daily.groupBy("region_name", _month())
        .agg((F.avg(col) / F.lit(divide)).alias(alias))
        .orderBy("month", "region_name")
    )


def price_trend(daily: DataFrame) -> DataFrame:
    return _monthly_mean(daily, "avg_rrp", "avg_rrp")


def demand_trend(daily: DataFrame) -> DataFrame:
    return _monthly_mean(daily, "avg_demand_mw", "avg_demand")


def neg_price(daily: DataFrame) -> DataFrame:
    """Mean daily share of negative intervals as a fraction."""
    return _monthly_mean(daily, "negative_price_pct", "negative_price_pct", 100.0)


# ------------------------------------------------------------------ renewables page
def ren_by_region(energy: DataFrame) -> DataFrame:
    return (
        energy.groupBy("region_name", _month())
        .agg(_share("renewable_mwh", "total_generation_mwh").alias("renewable_share_pct"))
        .orderBy("month", "region_name")
    )


def mix_over_time(generation: DataFrame) -> DataFrame:
    return (
        generation.groupBy(_month(), "fuel_group").agg(_gwh()).orderBy("month", "fuel_group")
    )


def mix_by_region(generation: DataFrame, days: int = 90) -> DataFrame:
    return (
        look_back(generation, "settlement_day", days)
        .groupBy("region_name", "fueltech_label")
        .agg(_gwh())
    )


def with_region_share(mix: DataFrame) -> DataFrame:
    """Share of the region's total; a region has at most 14 rows, one per fuel-tech."""
    total = F.sum("gwh").over(Window.partitionBy("region_name"))
    return mix.withColumn("share", X.safe_ratio(F.col("gwh"), total))


# ---------------------------------------------------------------------- carbon page
def ci_trend(energy: DataFrame) -> DataFrame:
    return (
        energy.groupBy("region_name", _month())
        .agg(_share("est_emissions_tco2", "total_generation_mwh", 1000.0).alias("carbon_intensity"))
        .orderBy("month", "region_name")
    )


def ci_latest(energy: DataFrame, days: int = 30) -> DataFrame:
    return (
        look_back(energy, "settlement_day", days)
        .groupBy("region_name")
        .agg(_share("est_emissions_tco2", "total_generation_mwh", 1000.0).alias("carbon_intensity"))
        .orderBy(F.col("carbon_intensity").desc(), "region_name")
    )


# -------------------------------------------------------------------- forecast page
def regions(daily: DataFrame) -> DataFrame:
    return daily.select("region_name").distinct().orderBy("region_name")


def actual_vs_fc(
    daily: DataFrame,
    forecast: DataFrame,
    region_name: str,
    model: str = "AutoETS",
    days: int = 60,
    min_intervals: int = 40,
) -> DataFrame:
    """Recent actual demand followed by the forecast, tagged by series, for one region."""
    wanted = F.col("region_name") == F.lit(region_name)
    actual = (
        look_back(daily, "settlement_day", days)
        .filter((F.col("interval_count") >= min_intervals) & wanted)
        .select(
            F.col("settlement_day").alias("date"),
            F.col("avg_demand_mw").alias("demand"),
            F.lit("actual").alias("series"),
        )
    )
    future = forecast.filter((F.col("model") == model) & wanted).select(
        F.col("forecast_date").alias("date"),
        F.col("predicted_demand_mw").alias("demand"),
        F.lit("forecast").alias("series"),
    )
    return actual.unionByName(future).orderBy("date", "series")


def fc_table(forecast: DataFrame, region_name: str, model: str = "AutoETS") -> DataFrame:
    return (
        forecast.filter((F.col("model") == model) & (F.col("region_name") == region_name))
        .select("forecast_date", "predicted_demand_mw", "lo_90", "hi_90")
        .orderBy("forecast_date")
    )


def acc(accuracy: DataFrame) -> DataFrame:
    return accuracy.select("region_name", "model", "mape").orderBy("region_name", "mape", "model")


# ------------------------------------------------------------------- benchmark page
def bench(benchmark: DataFrame) -> DataFrame:
    return benchmark.select("region_name", "model", "engine", "mape").orderBy(
        "region_name", "mape", "model"
    )


def bench_avg(benchmark: DataFrame) -> DataFrame:
    return (
        benchmark.groupBy("model", "engine")
        .agg(X.settle("avg(mape)", 2).alias("avg_mape"))
        .orderBy("avg_mape", "model", "engine")
    )


def anom_by_region(anomalies: DataFrame) -> DataFrame:
    return (
        anomalies.groupBy("region_name")
        .agg(F.count_if("is_anomaly").alias("anomalies"))
        .orderBy(F.col("anomalies").desc(), "region_name")
    )


def top_anom(anomalies: DataFrame, n: int = 10) -> DataFrame:
    return (
        anomalies.filter("is_anomaly")
        .orderBy(F.col("distance").desc(), "settlement_day", "region_name")
        .limit(n)
        .select("settlement_day", "region_name", "avg_rrp", "expected_rrp", "surprise_aud_mwh")
    )


# ------------------------------------------------------------------ stated analyses
def negative_share_by_year(fact: DataFrame, by_region: bool = False) -> DataFrame:
    """Share of intervals below zero, weighted by interval, from the atomic fact."""
    keys = [F.year("settlement_day").alias("year")] + ([F.col("region")] if by_region else [])
    return fact.groupBy(*keys).agg(
        X.settle("100d * count_if(is_negative_price) / count(1)", 2).alias("negative_pct")
    )


def transition_ranking(energy: DataFrame, daily: DataFrame) -> DataFrame:
    """Regions by renewable share next to their rank by negative-interval share.

    Ranks are over one row per region.
    """
    renewable = energy.groupBy("region").agg(
        X.round_half_away(
            "sum(renewable_mwh) / nullif(sum(total_generation_mwh), 0d)", 6
        ).alias("renewable_share")
    )
    negative = daily.groupBy("region").agg(
        X.round_half_away(
            "sum(negative_price_intervals) / nullif(sum(interval_count), 0)", 6
        ).alias("negative_share")
    )

    def rank(col: str) -> Column:
        return F.rank().over(Window.orderBy(F.col(col).desc()))

    return renewable.join(negative, "region").select(
        "*",
        rank("renewable_share").alias("renewable_rank"),
        rank("negative_share").alias("negative_rank"),
    )


def price_cap_by_year(fact: DataFrame) -> DataFrame:
    """Highest price per year with the first interval and region that reached it."""
    priced = fact.filter(F.col("rrp_aud_mwh").isNotNull()).select(
        F.year("settlement_day").alias("year"), "rrp_aud_mwh", "settlement_date", "region"
    )
    # a hash aggregate over the fact first; one row per year joins back, and few rows equal it
    top = priced.groupBy("year").agg(F.max("rrp_aud_mwh").alias("max_rrp"))
    at_top = priced.join(F.broadcast(top), "year").filter("rrp_aud_mwh = max_rrp")
    return (
        at_top.groupBy("year", "max_rrp")
        .agg(F.min(F.struct("settlement_date", "region")).alias("m"))
        .select(
            "year",
            "max_rrp",
            F.col("m.settlement_date").alias("settlement_date"),
            F.col("m.region").alias("region"),
        )
    )

