"""Small reference tables with fixed contents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltspan.sources import schemas
from voltspan.sources.landing import STRICT

# fixed values: region_id, region_name, state, timezone
REGIONS = [
    ("NSW1", "New South Wales", "NSW", "Australia/Sydney"),
    ("QLD1", "Queensland", "QLD", "Australia/Brisbane"),
    ("VIC1", "Victoria", "VIC", "Australia/Melbourne"),
    ("SA1", "South Australia", "SA", "Australia/Adelaide"),
    ("TAS1", "Tasmania", "TAS", "Australia/Hobart"),
]

# fixed values: fueltech, label, group, renewable, t CO2 per MWh
FUELTECHS = [
    ("coal_brown", "Brown coal", "fossil", "false", "1.20"),
    ("coal_black", "Black coal", "fossil", "false", "0.90"),
    ("gas_steam", "Gas (steam)", "fossil", "false", "0.70"),
    ("gas_ocgt", "Gas (OCGT)", "fossil", "false", "0.60"),
    ("gas_recip", "Gas (reciprocating)", "fossil", "false", "0.60"),
    ("gas_other", "Gas (other)", "fossil", "false", "0.55"),
    ("gas_ccgt", "Gas (CCGT)", "fossil", "false", "0.37"),
    ("distillate", "Distillate / oil", "fossil", "false", "0.85"),
    ("bioenergy", "Bioenergy", "renewable", "true", "0.0"),
    ("hydro", "Hydro", "renewable", "true", "0.0"),
    ("wind", "Wind", "renewable", "true", "0.0"),
    ("solar", "Solar (utility)", "renewable", "true", "0.0"),
    ("battery", "Battery storage", "storage", "false", "0.0"),
    ("other", "Other / unknown", "other", "false", "0.0"),
]

# fixed values: engine names the published comparison may carry
BENCHMARK_ENGINES = ["Snowflake ML", "Python"]


def _rows(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """An inline table, which the planner knows to be tiny."""
    values = ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in rows)
    return spark.sql(f"select * from values {values} as t({', '.join(names)})")


def region_seed(spark: SparkSession) -> DataFrame:
    return _rows(spark, REGIONS, schemas.REGION.names)


def fueltech_seed(spark: SparkSession) -> DataFrame:
    return _rows(spark, FUELTECHS, schemas.FUELTECH.names)


def seed_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Header CSV with a declared schema; typed casts happen in the dimension or mart."""
    return spark.read.schema(schema).options(**STRICT).csv(path)
