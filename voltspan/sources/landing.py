"""Readers of the landed files."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltspan.functions import scalars as X
from voltspan.sources import schemas

LINES_PER_BATCH = 50_000
# header files: the names must be those of the schema, in its order, and every value must parse
STRICT = {"header": "true", "enforceSchema": "false", "mode": "FAILFAST"}


def _file_path():
    """Path of the row's file. Spark percent-encodes it, so a '#' arrives as '%23'.

    A literal plus sign must survive the form-style decoder.
    """
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def price_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Monthly price and demand files -> canonical rows with month and file provenance.

    One scan over all files: Spark packs small files into tasks and splits large ones.
    A malformed stamp or number raises, and so does a file whose header names other columns or
    has them in another order: a silently dropped or swapped value would bias every rollup.
    """
    raw = (
        spark.read.schema(schemas.PRICE_FILE)
        .options(**STRICT)
        .option("recursiveFileLookup", True)
        .csv(paths)
        .withColumn("source_file", _file_path())
    )
    return canonical_price(raw)


def canonical_price(raw: DataFrame) -> DataFrame:
    """File columns -> table columns."""
    return raw.select(
        F.col("REGION").alias("region"),
        X.strict_stamp("SETTLEMENTDATE").alias("settlement_date"),
        F.col("TOTALDEMAND").alias("total_demand_mw"),
        F.col("RRP").alias("rrp_aud_mwh"),
        F.col("PERIODTYPE").alias("period_type"),
        F.regexp_extract("source_file", r"PRICE_AND_DEMAND_(\d{6})_", 1).alias("source_month"),
        "source_file",
    )


def _record_reader(reader):
    return (
        reader.schema(schemas.RECORD_FILE)
        .option("header", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")  # short rows are padded, never dropped
        .option("recursiveFileLookup", True)
    )


def record_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Mixed-record files as ten text columns plus the file path."""
    return _record_reader(spark.read).csv(paths).withColumn("source_file", _file_path())


def unit_readings(records: DataFrame) -> DataFrame:
    """Keep the unit-output data records; an unreadable number becomes null."""
    return records.filter((F.col("col0") == "D") & (F.col("col2") == "UNIT_SCADA")).select(
        X.strict_stamp("col4").alias("settlement_date"),
        F.col("col5").alias("duid"),
        F.col("col6").try_cast("double").alias("scada_mw"),
        X.file_month("source_file", "DISPATCH_UNIT_SCADA").alias("source_month"),
    )


def scada_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """All months in one scan, each row tagged with the month in its file's name."""
    return unit_readings(record_csv(spark, paths))


def _first_member_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                with archive.open(archive.namelist()[0]) as member:
                    lines: list[str] = []
                    for line in io.TextIOWrapper(member, encoding="utf-8", newline=""):
                        lines.append(line.rstrip("\r\n"))
                        if len(lines) == LINES_PER_BATCH:
                            yield pd.DataFrame({"source_file": path, "line": lines})
                            lines = []
                    if lines:
                        yield pd.DataFrame({"source_file": path, "line": lines})


def readings_from_archives(archives: DataFrame) -> DataFrame:
    """(path, content) of monthly archives -> unit readings.

    A zip cannot be split, so an archive is one unit of work: Spark packs whole archives into
    tasks by their size, the text inside streams out in batches and is never held whole, and
    the parsed readings follow in the same task without a shuffle.
    """
    lines = archives.select("path", "content").mapInPandas(
        _first_member_lines, "source_file string, line string"
    )
    ddl = ", ".join(f"{f.name} string" for f in schemas.RECORD_FILE)
    parsed = lines.select(
        F.from_csv("line", ddl, {"mode": "PERMISSIVE", "quote": '"', "escape": '"'}).alias("r"),
        F.url_decode(F.replace("source_file", F.lit("+"), F.lit("%2B"))).alias("source_file"),
    ).select("r.*", "source_file")
    return unit_readings(parsed)


def scada_zip(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Zip files of a folder -> unit readings. Archives over 2 GB are refused by the reader."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    return readings_from_archives(files)


def registry_csv(spark: SparkSession, paths: str | list[str], **options) -> DataFrame:
    """Unit registry rows, columns matched by the names in the file's header.

    One column is ``ordinal`` (the row number of the sheet); columns the sheet lacks are null.
    All files must have the header of the first one.
    """
    rows = spark.read.options(**STRICT | options).csv(paths)
    return with_registry_columns(rows.toDF(*[c.strip() for c in rows.columns]))


def with_registry_columns(rows: DataFrame) -> DataFrame:
    """The registry columns by name, null where absent, plus the numeric ordinal."""
    present = set(rows.columns)
    return rows.select(
        F.col("ordinal").cast("bigint").alias("ordinal"),
        *[
            (F.col(f"`{c}`") if c in present else F.lit(None)).cast("string").alias(c)
            for c in schemas.REGISTRY_COLUMNS
        ],
    )


def text_first(df: DataFrame, ts: str = "settlement_date") -> DataFrame:
    """Land the stamp as text and upper-case the names, as a loader of another system would."""
    return df.withColumn(ts, X.stamp_text(ts)).toDF(*[c.upper() for c in df.columns])


def from_text(df: DataFrame, ts: str = "settlement_date") -> DataFrame:
    """Back to canonical names and a typed stamp through an explicit format."""
    named = df.toDF(*[c.lower() for c in df.columns])
    return named.withColumn(ts, F.to_timestamp_ntz(F.col(ts), F.lit("yyyy-MM-dd HH:mm:ss")))
