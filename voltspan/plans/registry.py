"""Named queries over the supplied tables, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltspan.functions import scalars as X
from voltspan.operators import anomalies, dims, forecast, marts, series, staging
from voltspan.session import fits_broadcast, stage
from voltspan.sources import adapters, reference

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

ANOMALY_TRAIN_END = "1999-12-31"
SERIES_MIN_INTERVALS = 2
NAIVE = ["SeasonalNaive"]


class Tables:
    """The tables of one data folder, built on first use.

    The ``*_stored`` marts are written once (as the batch pipeline writes them) for reports
    that read them more than once; everything else stays a lazy plan.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return adapters.table(self.spark, self.sf_dir, name)

    # price and demand
    @cached_property
    def raw_price(self) -> DataFrame:
        return adapters.price_demand(self.spark, self.sf_dir)

    @cached_property
    def stg_price(self) -> DataFrame:
        return staging.stg_price_demand(self.raw_price)

    @cached_property
    def fct_price(self) -> DataFrame:
        return marts.fct_price_demand(self.stg_price)

    @cached_property
    def region_daily(self) -> DataFrame:
        return marts.fct_region_daily(self.fct_price)

    @cached_property
    def region_totals(self) -> DataFrame:
        """The daily rollup without the median, as a plain plan, for what doesn't read it."""
        return marts.region_day_totals(marts.region_day_buckets(self.fct_price))

    @cached_property
    def region_totals_named(self) -> DataFrame:
        return self.named(self.region_totals)

    @cached_property
    def region_totals_stored(self) -> DataFrame:
        return stage(self.region_totals_named, "region-totals")

    @cached_property
    def region_daily_named(self) -> DataFrame:
        return self.named(self.region_daily)

    @cached_property
    def region_daily_stored(self) -> DataFrame:
        return stage(self.region_daily_named, "region-daily")

    # generation
    @cached_property
    def registry(self) -> DataFrame:
        return adapters.unit_registry(self.spark, self.sf_dir)

    @cached_property
    def few_units(self) -> bool:
        """Size check of the registry itself, which bounds the unit table; the count comes
        from file footers."""
        return fits_broadcast(self.registry)

    @cached_property
    def unit_seed(self) -> DataFrame:
        units = dims.unit_seed(self.registry)
        return units if self.few_units else stage(units, "units")

    @cached_property
    def dim_duid(self) -> DataFrame:
        return dims.dim_duid(self.unit_seed)

    @cached_property
    def dim_region(self) -> DataFrame:
        return dims.dim_region(adapters.region_rows(self.spark, self.sf_dir))

    @cached_property
    def dim_fueltech(self) -> DataFrame:
        return dims.dim_fueltech(reference.fueltech_seed(self.spark))

    @cached_property
    def raw_scada(self) -> DataFrame:
        return adapters.dispatch_scada(self.spark, self.sf_dir)

    @cached_property
    def stg_scada(self) -> DataFrame:
        return staging.stg_dispatch_scada(self.raw_scada)

    @cached_property
    def generation(self) -> DataFrame:
        return marts.fct_generation(self.stg_scada, self.dim_duid, self.few_units or None)

    @cached_property
    def generation_half_hour_stored(self) -> DataFrame:
        return stage(self.generation, "generation-half-hour")

    @cached_property
    def generation_daily(self) -> DataFrame:
        return marts.generation_daily_from_readings(
            self.stg_scada, self.dim_duid, self.few_units or None
        )

    @cached_property
    def generation_named(self) -> DataFrame:
        return marts.generation_labelled(
            self.generation_daily, self.dim_fueltech, self.dim_region
        )

    @cached_property
    def generation_stored(self) -> DataFrame:
        return stage(self.generation_named, "generation-daily")

    @cached_property
    def energy_daily(self) -> DataFrame:
        return marts.fct_region_energy_daily(self.generation_daily, self.dim_fueltech)

    @cached_property
    def energy_named(self) -> DataFrame:
        return self.named(self.energy_daily)

    @cached_property
    def energy_stored(self) -> DataFrame:
        return stage(self.energy_named, "energy-daily")

    # long daily history, for series and anomalies
    @cached_property
    def history(self) -> DataFrame:
        return stage(adapters.daily_history(self.spark, self.sf_dir), "history")

    @cached_property
    def series(self) -> DataFrame:
        return series.daily_series(self.history, SERIES_MIN_INTERVALS)

    @cached_property
    def filled(self) -> DataFrame:
        return series.fill_days(self.series)

    @cached_property
    def naive_backtest(self) -> DataFrame:
        return forecast.backtest(self.series, NAIVE)

    @cached_property
    def accuracy(self) -> DataFrame:
        return marts.fct_forecast_accuracy(series.accuracy_table(self.naive_backtest))

    @cached_property
    def naive_forecast(self) -> DataFrame:
        return forecast.demand_forecast(self.series, NAIVE)

    @cached_property
    def forecast_mart(self) -> DataFrame:
        return marts.fct_demand_forecast(self.naive_forecast)

    @cached_property
    def external(self) -> DataFrame:
        """The prediction set of an outside engine, for the comparison."""
        ext = self.history.select(
            F.concat(F.lit('"'), F.col("region"), F.lit('"')).alias("series"),
            F.date_add("settlement_day", 1).cast("timestamp_ntz").alias("ts"),
            F.col("avg_demand_mw").alias("forecast"),
        )
        return forecast.external_predictions(ext, "Hosted", "DayBefore")

    @cached_property
    def benchmark(self) -> DataFrame:
        train, holdout = series.holdout_split(self.series)
        sets = self.external.unionByName(forecast.benchmark_predictions(train, NAIVE))
        return marts.fct_engine_benchmark(series.engine_benchmark(holdout, sets))

    @cached_property
    def scored_prices(self) -> DataFrame:
        return anomalies.score_prices(self.history, ANOMALY_TRAIN_END)

    @cached_property
    def price_anomalies(self) -> DataFrame:
        return marts.fct_price_anomalies(self.scored_prices)

    def named(self, df: DataFrame) -> DataFrame:
        return dims.with_region_name(df, self.dim_region)


def query(name: str, oracle: str | None = None):
    """Register ``fn(Tables) -> DataFrame`` under ``name``."""

    def add(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


def q6(df: DataFrame, *cols: str) -> DataFrame:
    """Un-rounded doubles to six digits, so that summation order does not show."""
    return df.withColumns({c: X.round_half_away(c, 6) for c in cols})
