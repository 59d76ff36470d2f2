"""Writers: tables, views, Parquet exports, CSV results, and the check after a write."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMAS = ["raw", "staging", "marts", "forecast"]


def ensure_schemas(
    spark: SparkSession, names: list[str] = SCHEMAS, folder: str | None = None
) -> None:
    """Schema names are used exactly as given, without a prefix; with ``folder`` their tables
    lie there instead of in the warehouse folder."""
    for name in names:
        place = f" LOCATION '{folder}/{name}'" if folder else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")


def _clustered(df: DataFrame, partition_by: list[str] | None) -> DataFrame:
    """Rows of a table partition brought together before the write, so that not every task
    writes a small file into every partition. The rebalance hint lets the adaptive planner
    split a partition that holds most of the rows and merge small ones."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def replace_table(
    df: DataFrame, name: str, partition_by: list[str] | None = None, path: str | None = None
) -> DataFrame:
    """Create or replace a table with the rows of ``df`` and return it. The files lie in a
    folder of their own below ``path``, or below the table's name in its schema's folder.

    The rows are written beside the old table, under a name of their own, and only a complete
    write takes the name over, by two calls to the catalog. A write that fails leaves the old
    table as it was, and ``df`` may read the table it replaces. The old files stay for those
    who are still reading them, until the folder's expiry rule removes them.
    """
    spark, beside = df.sparkSession, f"{name}__next"
    *schema, table = name.split(".")
    path = path or f"{spark.catalog.getDatabase(schema[0] if schema else spark.catalog.currentDatabase()).locationUri}/{table}"
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(beside)}")
    writer = _clustered(df, partition_by).write.format("parquet").option("path", f"{path}/{uuid.uuid4().hex}")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(beside)
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")
    spark.sql(f"ALTER TABLE {_quoted(beside)} RENAME TO {_quoted(name)}")
    return spark.table(name)


def declare_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partition_by: list[str] | None = None,
    path: str | None = None,
) -> None:
    """An empty table of a declared schema, replacing any former one."""
    replace_table(spark.createDataFrame([], schema), name, partition_by, path)


def append_rows(df: DataFrame, name: str) -> None:
    """Append by column name into a declared table."""
    spark = df.sparkSession
    keys = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    rows = df.select(*spark.table(name).columns)
    _clustered(rows, keys).write.mode("append").insertInto(name)


def staging_view(df: DataFrame, name: str) -> DataFrame:
    """Staging stays a view: nothing is stored, readers plan through it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def write_observed(df: DataFrame, path: str, *metrics: Column) -> dict:
    """Write Parquet and return ``rows`` and the ``metrics``, taken while the rows passed by.

    The files' footers must hold as many rows; counting them reads no data.
    """
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *metrics).write.mode("overwrite").parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path).count()
    if seen.get["rows"] != stored:
        raise AssertionError(f"wrote {seen.get['rows']} rows, {path} holds {stored}")
    return seen.get


def export_parquet(frames: dict[str, DataFrame], folder: str) -> DataFrame:
    """Write each frame to ``folder/<name>.parquet`` and report the rows written."""
    counts = [(name, write_observed(df, f"{folder}/{name}.parquet")["rows"]) for name, df in frames.items()]
    return next(iter(frames.values())).sparkSession.createDataFrame(counts, "name string, rows long")


def read_back(df: DataFrame, ts: str) -> DataFrame:
    """Count, first and last stamp of a stored table."""
    return df.agg(
        F.count(F.lit(1)).alias("n"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")
    )


def require_same_count(written: DataFrame, stored: DataFrame) -> int:
    a, b = written.count(), stored.count()
    if a != b:
        raise AssertionError(f"wrote {a} rows, read back {b}")
    return b


def sorted_csv(df: DataFrame, path: str, columns: list[str], order: list[str]) -> None:
    """Header CSV with fixed column order, sorted across the part files."""
    df.select(*columns).orderBy(*order).write.mode("overwrite").option("header", True).csv(path)


UNIT_COLUMNS = [
    "duid", "station_name", "region", "dispatch_type", "fuel_source", "technology", "fueltech",
    "reg_cap_mw",
]
