"""Exact median per group without holding any group in one task.

``F.median`` buffers every distinct value of a group in one aggregation state, which is
fine for a day of readings and fatal when one key holds a third of a huge table. Here the
search narrows instead:

1. each value gets a bucket that grows monotonically with it; counting per (group, bucket)
   combines on the map side, so only bucket totals are shuffled;
2. running totals over the buckets of a group tell which bucket holds each middle rank;
3. only rows of those buckets (a few in a hundred) are kept from a second read; where a
   bucket is still large, its rows are counted per value and narrowed once more by 4096
   equal slices;
4. the values left are ranked.

Every row takes part, so the result equals the textbook median, mean of the two middle
values for even counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltspan.session import BROADCAST_MAX_ROWS, stage

SLICES = 4096
RANK_ROWS = 1_000_000  # a bucket up to this size is ranked as it is
_TOP = 2**63 - 1  # NaN sorts above every number; infinity shares its bucket


def value_bucket(x: Column | str) -> Column:
    """Bucket number that never decreases as the value grows; 6 % wide in relative terms."""
    x = F.col(x) if isinstance(x, str) else x
    size = F.floor(F.log1p(F.abs(x)) * F.lit(16.0))
    return (
        F.when(x.isNull(), F.lit(None).cast("bigint"))
        .when(F.isnan(x), F.lit(_TOP).cast("bigint"))
        .when(x < 0, -size)
        .otherwise(size)
    )


def _join(a: DataFrame, b: DataFrame, cols: list[str]) -> DataFrame:
    """Inner join in which null group keys match each other."""
    right = b.select(*[F.col(c).alias(f"_r_{c}") for c in cols],
                     *[F.col(c) for c in b.columns if c not in cols])
    on = reduce(lambda p, q: p & q, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in cols])
    return a.join(right, on).drop(*[f"_r_{c}" for c in cols])


def bucket_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, _bucket) -> _n, _lo, _hi: the only thing the first pass shuffles."""
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, value_bucket(value).alias("_bucket"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    )


def _holding_middle(counts: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Keep the one or two rows per group that hold ranks ``_r1`` and ``_r2`` (1-based), and
    restate the ranks relative to the rows kept."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(w), F.lit(0))
    return (
        counts.withColumn("_before", before)
        .filter((F.col("_before") < F.col("_r2")) & (F.col("_before") + F.col("_n") >= F.col("_r1")))
        .withColumns({c: F.col(c) - F.col("_before") for c in ("_r1", "_r2")})
        .drop("_before")
    )


def _narrow(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One more level: count per value and slice of the bucket, keep the slice in the middle."""
    width = F.col("_hi") - F.col("_lo")
    part = F.when(
        (width > 0) & (width < F.lit(float("inf"))),
        F.floor((F.col("_v") - F.col("_lo")) / width * F.lit(float(SLICES))),
    ).otherwise(F.lit(0).cast("bigint"))
    counted = rows.groupBy(*keys, "_r1", "_r2", part.alias("_slice"), "_v").agg(
        F.count(F.lit(1)).alias("_n")
    )
    slices = counted.groupBy(*keys, "_r1", "_r2", "_slice").agg(F.sum("_n").alias("_n"))
    chosen = _holding_middle(slices, keys, "_slice").drop("_n")
    return _join(counted.drop("_r1", "_r2"), chosen, [*keys, "_slice"])


def middle_buckets(buckets: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, _bucket, _n, _lo, _hi, _r1, _r2): the one or two buckets per group that hold its middle ranks."""
    total = Window.partitionBy(*keys)
    ranked = buckets.withColumn("_all", F.sum("_n").over(total)).select(
        *keys, "_bucket", "_n", "_lo", "_hi",
        F.expr("(_all + 1) div 2").alias("_r1"),
        F.expr("_all div 2 + 1").alias("_r2"),
    )
    # one group has at most a few thousand buckets, so these windows are small per task
    return _holding_middle(ranked, keys, "_bucket")


def median_from_buckets(
    df: DataFrame,
    buckets: DataFrame,
    keys: list[str],
    value: str,
    alias: str,
    rank_rows: int = RANK_ROWS,
) -> DataFrame:
    """Second pass. ``buckets`` must be stored: it is read for sizes first and then for ranks."""
    picks = middle_buckets(buckets, keys)
    # all buckets bound the picks from above; only past that bound are the picks counted
    extent = [F.count(F.lit(1)).alias("rows"), F.max("_n").alias("largest")]
    size = buckets.agg(*extent).first()
    if size["rows"] > BROADCAST_MAX_ROWS or (size["largest"] or 0) > rank_rows:
        size = picks.agg(*extent).first()
    picks = picks.drop("_n")
    if size["rows"] <= BROADCAST_MAX_ROWS:
        picks = F.broadcast(picks)

    rows = df.filter(F.col(value).isNotNull()).select(
        *keys, F.col(value).alias("_v"), value_bucket(value).alias("_bucket")
    )
    group = [*keys, "_bucket"]
    inside = _join(rows, picks, group)
    if (size["largest"] or 0) > rank_rows:
        inside, group = _narrow(inside, group), [*group, "_slice"]
    else:
        inside = inside.withColumn("_n", F.lit(1).cast("bigint"))
    w = Window.partitionBy(*group).orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    placed = inside.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)))

    def at(rank: str) -> Column:
        hit = (F.col("_before") < F.col(rank)) & (F.col("_before") + F.col("_n") >= F.col(rank))
        return F.max(F.when(hit, F.col("_v")))

    return (
        placed.groupBy(*keys)
        .agg(at("_r1").alias("_a"), at("_r2").alias("_b"))
        .select(*keys, ((F.col("_a") + F.col("_b")) / F.lit(2.0)).alias(alias))
    )


def exact_median(
    df: DataFrame,
    keys: list[str],
    value: str,
    alias: str = "median",
    rank_rows: int = RANK_ROWS,
) -> DataFrame:
    """One row per group that has a non-null value."""
    buckets = stage(bucket_counts(df, keys, value), "median-buckets")
    return median_from_buckets(df, buckets, keys, value, alias, rank_rows)
