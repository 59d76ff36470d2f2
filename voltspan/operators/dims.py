"""Dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltspan.functions import scalars as X


def last_per_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the highest ``order`` per key, all columns kept.

    An aggregate, not a window: partial results combine before the shuffle, so a key with a
    third of the rows costs one row per task.
    """
    rest = [c for c in rows.columns if c != key]
    return (
        rows.groupBy(key)
        .agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.col(order)).alias("_row"))
        .select(key, "_row.*")
    )


def unit_seed(registry: DataFrame) -> DataFrame:
    """Registry rows -> one row per unit: blank ids dropped, the last row in file order kept,
    text trimmed, fuel-tech classified."""
    keyed = registry.withColumn("DUID", X.clean_text("DUID")).filter(F.length("DUID") > 0)
    rows = last_per_key(keyed, "DUID", "ordinal")
    fuel, technology = "`Fuel Source - Descriptor`", "`Technology Type - Descriptor`"
    return rows.select(
        F.col("DUID").alias("duid"),
        X.clean_text("`Station Name`").alias("station_name"),
        X.clean_text("Region").alias("region"),
        X.clean_text("`Dispatch Type`").alias("dispatch_type"),
        X.clean_text(fuel).alias("fuel_source"),
        X.clean_text(technology).alias("technology"),
        X.classify_fueltech(fuel, technology).alias("fueltech"),
        F.coalesce("`Reg Cap generation (MW)`", F.lit("")).alias("reg_cap_mw"),
    )


def dim_duid(units: DataFrame) -> DataFrame:
    """Units of the five market regions, capacity as a number where it is one."""
    return units.filter(F.col("region").isin(X.MARKET_REGIONS)).select(
        "duid",
        "station_name",
        "region",
        "dispatch_type",
        "fueltech",
        F.col("reg_cap_mw").try_cast("double").alias("reg_cap_mw"),
    )


def dim_region(seed: DataFrame) -> DataFrame:
    return seed.select("region_id", "region_name", "state", "timezone")


def dim_fueltech(seed: DataFrame) -> DataFrame:
    return seed.select(
        "fueltech",
        "fueltech_label",
        "fuel_group",
        F.col("is_renewable").cast("boolean").alias("is_renewable"),
        F.col("emission_factor_t_co2_per_mwh").cast("double").alias(
            "emission_factor_t_co2_per_mwh"
        ),
    )


def with_region_name(df: DataFrame, regions: DataFrame) -> DataFrame:
    """Inner join that adds ``region_name``. Every left column is kept.

    No hint: the region table's size is known to the planner, which broadcasts it while it
    is below the session's threshold.
    """
    labels = regions.select(F.col("region_id").alias("region"), "region_name")
    return df.join(labels, "region").select(*df.columns, "region_name")
