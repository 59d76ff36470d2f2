"""Coverage and check-up summaries of the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltspan.functions import scalars as X


def price_coverage(raw: DataFrame) -> DataFrame:
    """Per region: rows, first and last stamp, mean price and demand."""
    return raw.groupBy("region").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("settlement_date").alias("first_ts"),
        F.max("settlement_date").alias("last_ts"),
        X.settle("avg(rrp_aud_mwh)", 2).alias("avg_rrp"),
        X.settle("avg(total_demand_mw)", 0).alias("avg_dmd"),
    )


def latest_intervals(raw: DataFrame, region: str, n: int = 3) -> DataFrame:
    return (
        raw.filter(F.col("region") == region)
        .select("settlement_date", "total_demand_mw", "rrp_aud_mwh")
        .orderBy(F.col("settlement_date").desc(), "rrp_aud_mwh", "total_demand_mw")
        .limit(n)
    )


def scada_extent(raw: DataFrame) -> DataFrame:
    """Rows, distinct units, first and last stamp.

    Counting per unit first keeps the exact distinct count on the ordinary two-step
    aggregation: one small row per unit and task is shuffled.
    """
    per_unit = raw.groupBy("duid").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("settlement_date").alias("lo"),
        F.max("settlement_date").alias("hi"),
    )
    return per_unit.agg(
        F.sum("n").alias("n"),
        F.count("duid").alias("duids"),
        F.min("lo").alias("first_ts"),
        F.max("hi").alias("last_ts"),
    )


def unit_energy(raw: DataFrame) -> DataFrame:
    """Positive output per unit: combines on the map side before any join."""
    return raw.filter(F.col("scada_mw") > 0).groupBy("duid").agg(F.sum("scada_mw").alias("mw"))


def top_fueltechs(raw: DataFrame, units: DataFrame, n: int = 8) -> DataFrame:
    """Fuel-techs by generated energy; units missing from the registry count as UNMAPPED.

    Joins per-unit totals, not readings, so both sides have one row per unit and the adaptive
    planner can choose the join from their real sizes.
    """
    return (
        unit_energy(raw)
        .join(units.select("duid", "fueltech"), "duid", "left")
        .groupBy(F.coalesce("fueltech", F.lit("UNMAPPED")).alias("ft"))
        .agg(F.sum("mw").alias("mw"))
        .withColumn("gwh", X.mwh_from_mw("mw") / F.lit(1000.0))
        .select("ft", X.settle("gwh", 1).alias("gwh"))
        .orderBy(F.col("gwh").desc(), "ft")
        .limit(n)
    )


def rows_per_month(raw: DataFrame) -> DataFrame:
    return raw.groupBy("source_month").agg(F.count(F.lit(1)).alias("n"))


def table_extent(df: DataFrame, ts: str) -> DataFrame:
    """Row count with first and last stamp, the check after a write."""
    return df.agg(
        F.count(F.lit(1)).alias("n"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")
    )


def tally(df: DataFrame, label: str) -> DataFrame:
    return (
        df.groupBy(label)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), label)
    )
