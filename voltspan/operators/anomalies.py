"""Price anomalies: days outside the band that earlier history makes plausible.

The band is this module's own definition: the expected price of a day is the training mean of
its region, month of the year and weekend flag; the band adds the region's training residual
quantiles; ``distance`` is the surprise in residual standard deviations.

Inputs are daily marts, so a region has at most one row per calendar day: exact percentiles
per region hold a bounded list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltspan.functions import scalars as X

TRAIN_END = "2024-12-31"
LOWER, UPPER = 0.005, 0.995


def _profile() -> list[Column]:
    day = F.col("settlement_day")
    return [
        F.month(day).alias("_month"),
        F.dayofweek(day).isin(1, 7).alias("_weekend"),
    ]


def split_at(daily: DataFrame, train_end: str) -> tuple[DataFrame, DataFrame]:
    """(train, score): days up to and including the cutoff, and the days after it."""
    day, cutoff = F.col("settlement_day"), F.lit(train_end).cast("date")
    return daily.filter(day <= cutoff), daily.filter(day > cutoff)


def score_prices(daily: DataFrame, train_end: str = TRAIN_END) -> DataFrame:
    """Scored days after the cutoff, numbers at two digits, flag from the unrounded band.

    A region without training days keeps its scored days, without a band and never flagged.
    """
    rows = daily.select(
        "region", "settlement_day", F.col("avg_rrp").alias("y"), *_profile()
    )
    train, score = split_at(rows, train_end)
    keys = ["region", "_month", "_weekend"]
    profile = train.groupBy(*keys).agg(
        F.sum("y").alias("_sum"), F.count("y").alias("_n")
    ).withColumn("_mean", F.try_divide("_sum", "_n"))
    # month profiles of a region: at most 24 rows each
    overall = profile.groupBy("region").agg(
        F.try_divide(F.sum("_sum"), F.sum("_n")).alias("_overall")
    )
    residual = train.join(profile.select(*keys, "_mean"), keys).withColumn(
        "_e", F.col("y") - F.col("_mean")
    )
    spread = residual.groupBy("region").agg(
        F.percentile("_e", F.array(F.lit(LOWER), F.lit(UPPER))).alias("_q"),
        F.stddev_samp("_e").alias("_sd"),
    )
    scored = (
        score.join(spread.join(overall, "region"), "region", "left")
        .join(profile.select(*keys, "_mean"), keys, "left")
        .withColumn("_expected", F.coalesce("_mean", "_overall"))
        .withColumns({
            "_low": F.col("_expected") + F.element_at("_q", 1),
            "_high": F.col("_expected") + F.element_at("_q", 2),
        })
    )
    return scored.select(
        "region",
        "settlement_day",
        X.settle("y", 2).alias("avg_rrp"),
        X.settle("_expected", 2).alias("expected_rrp"),
        X.settle("_low", 2).alias("lower_bound"),
        X.settle("_high", 2).alias("upper_bound"),
        F.when(F.col("_q").isNull(), False).otherwise(F.expr("y < _low or y > _high")).alias("is_anomaly"),
        X.settle("(y - _expected) / nullif(_sd, 0d)", 2).alias("distance"),
    )


def flag_rate(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.count_if("is_anomaly").alias("flagged"),
        F.count(F.lit(1)).alias("scored"),
        X.settle("try_divide(100d * count_if(is_anomaly), count(1))", 1).alias("flagged_pct"),
    )


def flags_by_region(scored: DataFrame) -> DataFrame:
    return scored.groupBy("region").agg(F.count_if("is_anomaly").alias("anomalies"))


def top_flagged(scored: DataFrame, n: int) -> DataFrame:
    return (
        scored.filter("is_anomaly")
        .orderBy(F.col("distance").desc(), "settlement_day", "region")
        .limit(n)
    )
