"""Which files should have landed, and which did."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltspan.functions.dates import recent_months
from voltspan.functions.scalars import MARKET_REGIONS


def expected_files(one_row: DataFrame, end: Column, n: int, regions=MARKET_REGIONS) -> DataFrame:
    """Every (month, region) wanted. The grid comes from two explodes of fixed short lists,
    so no join is involved."""
    return one_row.select(F.explode(recent_months(end, n)).alias("source_month")).select(
        "source_month",
        F.explode(F.array(*[F.lit(r) for r in regions])).alias("region"),
    )


def landing_coverage(expected: DataFrame, landed: DataFrame) -> DataFrame:
    """Status per expected file: ``landed`` with its row count, ``empty`` or ``missing``."""
    counts = landed.groupBy("source_month", "region").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("settlement_date").alias("_usable")
    )
    return expected.join(counts, ["source_month", "region"], "left").select(
        "source_month",
        "region",
        F.when(F.col("n_rows").isNull(), "missing")
        .when(F.col("_usable") == 0, "empty")
        .otherwise("landed")
        .alias("status"),
        F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"),
    )


def status_counts(coverage: DataFrame) -> DataFrame:
    return coverage.groupBy("status").agg(F.count(F.lit(1)).alias("files"))


def require_landed(coverage: DataFrame) -> DataFrame:
    """Stop before the load when nothing at all has landed."""
    if coverage.filter(F.col("status") == "landed").limit(1).count() == 0:
        raise RuntimeError("no expected file has landed; load not started")
    return coverage
