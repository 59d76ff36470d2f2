"""The supplied tables seen as market data, so that every operator runs on them whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltspan.functions.scalars import MARKET_REGIONS, settle

# event type -> market region
EVENT_REGION = [
    ("click", "NSW1"), ("error", "QLD1"), ("purchase", "VIC1"), ("signup", "SA1"), ("view", "TAS1"),
]
# region of a registry row by p_size % 12; the last two are foreign and blank
PART_REGION = [*MARKET_REGIONS, *MARKET_REGIONS, "WEM1", ""]
# (fuel text, technology text) of a registry row by p_partkey % 21
DESCRIPTORS = [
    ("Brown Coal", "Steam Sub-Critical"),
    ("Black Coal", "Steam Super Critical"),
    ("Waste Coal Mine Gas", "Compression Reciprocating Engine"),
    ("Grid", "Battery and Inverter"),
    ("Water", "Run of River"),
    ("Waste Water", "Pump Storage"),
    ("Wind", "Wind - Onshore"),
    ("Solar", "Photovoltaic Tracking Flat Panel"),
    ("Biogas", "Spark Ignition"),
    ("Bagasse", "Steam Sub-Critical"),
    ("Natural Gas", "Combined Cycle Gas Turbine (CCGT)"),
    ("Natural Gas", "Open Cycle Gas turbines (OCGT)"),
    ("Natural Gas", "Steam Sub-Critical"),
    ("Natural Gas", "Compression Reciprocating Engine"),
    ("Fuel Oil", None),
    ("Diesel", "Compression Reciprocating Engine"),
    ("Kerosene", "Turbine"),
    ("", "Hydro - Gravity"),
    (None, "Solar PV - Photovoltaic"),
    ("Ethane", "Unknown"),
    ("Coal Seam Methane", "Open Cycle"),
]


# declared schemas of the supplied tables in use; reading without one costs a job per table
SUPPLIED = {
    "region": "r_regionkey int, r_name string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
              "props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SUPPLIED[name]).parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list[str | None], index: str) -> Column:
    """The list's element at a zero-based position given as SQL text."""
    items = ", ".join("cast(null as string)" if v is None else f"'{v}'" for v in values)
    return F.expr(f"element_at(array({items}), cast({index} as int) + 1)")


def event_region() -> Column:
    arms = " ".join(f"when '{event}' then '{region}'" for event, region in EVENT_REGION)
    return F.expr(f"case event_type {arms} end")


def price_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> raw price and demand rows."""
    return price_demand_from(table(spark, sf_dir, "events"))


def price_demand_from(events: DataFrame) -> DataFrame:
    month = F.date_format("ts", "yyyyMM")
    region = event_region()
    return events.select(
        region.alias("region"),
        F.col("ts").alias("settlement_date"),
        (F.lit(5000.0) + F.lit(10.0) * F.col("value")).alias("total_demand_mw"),
        (F.col("value") - F.lit(30.0)).alias("rrp_aud_mwh"),
        F.lit("TRADE").alias("period_type"),
        month.alias("source_month"),
        F.concat(F.lit("PRICE_AND_DEMAND_"), month, F.lit("_"), region, F.lit(".csv")).alias(
            "source_file"
        ),
    )


def dispatch_scada(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem -> raw unit output, whole megawatts, some negative and some missing."""
    slot = (F.lit(7) * F.col("l_orderkey") + F.col("l_linenumber")) % 288
    return table(spark, sf_dir, "lineitem").select(
        (
            F.col("l_shipdate")
            + F.make_dt_interval(mins=(slot * F.lit(5)).cast("int"))
        ).alias("settlement_date"),
        F.concat(F.lit("U"), F.col("l_suppkey").cast("string")).alias("duid"),
        F.when(F.col("l_tax") != 0.08, F.col("l_quantity") - F.lit(10.0)).alias("scada_mw"),
        F.date_format("l_shipdate", "yyyyMM").alias("source_month"),
    )


def unit_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part -> registry rows in file order, about four per unit, some without an id."""
    size, key = F.col("p_size"), F.col("p_partkey")
    unit = F.concat(F.lit(" U"), F.floor(key / F.lit(4)).cast("string"), F.lit(" "))
    return table(spark, sf_dir, "part").select(
        key.alias("ordinal"),
        F.when(size == 50, F.lit("  ")).when(size != 49, unit).alias("DUID"),
        F.concat(F.col("p_name"), F.lit(" ")).alias("Station Name"),
        _pick(PART_REGION, "p_size % 12").alias("Region"),
        F.col("p_brand").alias("Dispatch Type"),
        _pick([f for f, _ in DESCRIPTORS], "p_partkey % 21").alias("Fuel Source - Descriptor"),
        _pick([t for _, t in DESCRIPTORS], "p_partkey % 21").alias("Technology Type - Descriptor"),
        F.when(size % 10 == 0, F.lit(""))
        .when(size % 10 == 1, F.lit("n/a"))
        .otherwise(F.col("p_retailprice").cast("string"))
        .alias("Reg Cap generation (MW)"),
    )


def region_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """region -> region seed rows, joined on nothing: the key picks the market region."""
    from voltspan.sources.reference import REGIONS

    return table(spark, sf_dir, "region").select(
        *[
            _pick([r[i] for r in REGIONS], "r_regionkey").alias(name)
            for i, name in enumerate(["region_id", "region_name", "state", "timezone"])
        ]
    )


def daily_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem -> a long daily table per region with a price and a demand column."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            _pick(MARKET_REGIONS, "l_suppkey % 5").alias("region"),
            F.to_date("l_shipdate").alias("settlement_day"),
        )
        .agg(
            F.count(F.lit(1)).alias("interval_count"),
            settle("avg(l_quantity)", 2).alias("avg_rrp"),
            F.sum("l_quantity").alias("avg_demand_mw"),
        )
    )
