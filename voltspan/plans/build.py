"""The batch pipeline: raw -> staging views -> mart tables -> model tables -> exports."""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from voltspan.operators import anomalies, dims, forecast, marts, quality, series, staging
from voltspan.sinks import tables as sinks
from voltspan.sources import landing, reference, schemas


def export_frames(t) -> dict[str, Callable[[], DataFrame]]:
    """The seven exported frames of a set of tables, each built when asked for."""
    return {
        "region_daily": lambda: t.region_daily,
        "region_energy_daily": lambda: t.energy_daily,
        "generation_daily": lambda: t.generation_named,
        "demand_forecast": lambda: t.forecast_mart,
        "forecast_accuracy": lambda: t.accuracy,
        "dim_region": lambda: t.dim_region,
        "raw_price_demand": lambda: t.raw_price,
    }


def load_raw(spark: SparkSession, price_paths, scada_paths, archived: bool = True) -> None:
    """Landed files -> raw tables partitioned by load month. ``archived`` says whether the
    unit output lies in monthly archives or in plain record files."""
    sinks.ensure_schemas(spark)
    price = landing.price_csv(spark, price_paths)
    sinks.replace_table(price, "raw.price_demand", ["source_month"])
    sinks.declare_table(
        spark, "raw.dispatch_unit_scada", schemas.DISPATCH_SCADA, ["source_month"]
    )
    read = landing.scada_zip if archived else landing.scada_csv
    sinks.append_rows(read(spark, scada_paths), "raw.dispatch_unit_scada")


def build_price(spark: SparkSession, raw_price: DataFrame, region_seed: DataFrame) -> None:
    """Price vertical: one staging view, the atomic fact, the daily mart."""
    sinks.ensure_schemas(spark)
    sinks.replace_table(dims.dim_region(region_seed), "marts.dim_region")
    stg = sinks.staging_view(staging.stg_price_demand(raw_price), "stg_price_demand")
    fact = sinks.replace_table(
        marts.fct_price_demand(stg), "marts.fct_price_demand", ["settlement_day"]
    )
    sinks.replace_table(marts.fct_region_daily(fact), "marts.fct_region_daily")


def build_generation(
    spark: SparkSession, raw_scada: DataFrame, unit_seed: DataFrame, fueltech_seed: DataFrame
) -> None:
    """Generation vertical: dimensions, 30-minute energy, daily energy, daily headline marts."""
    sinks.ensure_schemas(spark)
    units = sinks.replace_table(dims.dim_duid(unit_seed), "marts.dim_duid")
    fuel = sinks.replace_table(dims.dim_fueltech(fueltech_seed), "marts.dim_fueltech")
    stg = sinks.staging_view(staging.stg_dispatch_scada(raw_scada), "stg_dispatch_scada")
    half_hours = sinks.replace_table(marts.fct_generation(stg, units), "marts.fct_generation")
    daily = sinks.replace_table(
        marts.fct_generation_daily(half_hours), "marts.fct_generation_daily"
    )
    sinks.replace_table(
        marts.fct_region_energy_daily(daily, fuel), "marts.fct_region_energy_daily"
    )


def build_forecast(
    spark: SparkSession,
    models: list[str] = forecast.MODELS,
    min_intervals: int = series.MIN_INTERVALS,
) -> None:
    """Backtest and forecast from the stored daily mart, written back and served as marts."""
    sinks.ensure_schemas(spark)
    observed = series.daily_series(spark.table("marts.fct_region_daily"), min_intervals)
    scores = series.accuracy_table(forecast.backtest(observed, models))
    accuracy = sinks.replace_table(scores, "forecast.forecast_accuracy")
    ahead = sinks.replace_table(
        forecast.demand_forecast(observed, models), "forecast.demand_forecast"
    )
    sinks.replace_table(marts.fct_forecast_accuracy(accuracy), "marts.fct_forecast_accuracy")
    sinks.replace_table(marts.fct_demand_forecast(ahead), "marts.fct_demand_forecast")


def build_anomalies(spark: SparkSession, train_end: str = anomalies.TRAIN_END) -> None:
    scored = anomalies.score_prices(spark.table("marts.fct_region_daily"), train_end)
    sinks.replace_table(marts.fct_price_anomalies(scored), "marts.fct_price_anomalies")


def build_benchmark(
    spark: SparkSession,
    external: DataFrame | None = None,
    models: list[str] = forecast.MODELS,
    min_intervals: int = series.MIN_INTERVALS,
) -> None:
    """All models, and any outside prediction set, on one train and holdout split.

    Holdout days without an outside prediction aren't scored; a warning tells how many.
    """
    observed = series.daily_series(spark.table("marts.fct_region_daily"), min_intervals)
    train, holdout = series.holdout_split(observed)
    sets = forecast.benchmark_predictions(train, models)
    if external is not None:
        found = external.withColumnRenamed("region", "unique_id")
        match = series.match_completeness(holdout, found, ["unique_id", "ds"]).first()
        if match["unmatched"]:
            warnings.warn(f"outside predictions match {match['matched']} of {match['expected']} holdout days")
        sets = sets.unionByName(external)
    scores = series.engine_benchmark(holdout, sets)
    sinks.replace_table(marts.fct_engine_benchmark(scores), "marts.fct_engine_benchmark")


def refresh(
    spark: SparkSession,
    price_paths,
    scada_paths,
    registry: DataFrame,
    archived: bool = True,
    min_intervals: int = series.MIN_INTERVALS,
    train_end: str = anomalies.TRAIN_END,
) -> DataFrame:
    """The whole run from landed files to checked marts; returns the check summary."""
    load_raw(spark, price_paths, scada_paths, archived)
    build_price(spark, spark.table("raw.price_demand"), reference.region_seed(spark))
    units = dims.unit_seed(registry)
    build_generation(
        spark, spark.table("raw.dispatch_unit_scada"), units, reference.fueltech_seed(spark)
    )
    build_forecast(spark, min_intervals=min_intervals)
    build_anomalies(spark, train_end)
    build_benchmark(spark, min_intervals=min_intervals)
    names = spark.catalog.listTables("marts")
    tables = {t.name: spark.table(f"marts.{t.name}") for t in names if not t.isTemporary}
    for view in ("stg_price_demand", "stg_dispatch_scada"):
        tables[view] = spark.table(view)
    tables |= {
        "seed_region": reference.region_seed(spark),
        "seed_fueltech": reference.fueltech_seed(spark),
        "seed_duid_fueltech": units,
    }
    missing = quality.skipped(quality.standard_checks(), tables)
    if missing:
        raise AssertionError("checks without a table: " + ", ".join(f"{c.table}.{c.name}" for c in missing))
    return check_build(spark, tables)


def check_build(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Run the checks whose tables are present and stop the build on any failure."""
    return quality.gate(quality.run_checks(quality.standard_checks(), tables))
