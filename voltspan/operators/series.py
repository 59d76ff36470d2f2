"""Daily series: extraction, gap filling, splits, origins, the seasonal baseline, error scores.

A series row is ``(unique_id, ds, y)`` and unique per day, so everything grouped or ordered
by ``unique_id`` here is bounded by the length of the calendar, whatever the raw volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltspan.functions import scalars as X
from voltspan.functions.dates import latest

HORIZON = 7
WINDOWS = 6
SEASON = 7
Z90 = 1.6448536269514722  # two-sided 90 % normal quantile
MIN_INTERVALS = 40  # fewer readings than this is a partial boundary day


def daily_series(
    daily: DataFrame, min_intervals: int = MIN_INTERVALS, y: str = "avg_demand_mw"
) -> DataFrame:
    return daily.filter(F.col("interval_count") >= min_intervals).select(
        F.col("region").alias("unique_id"), F.col("settlement_day").alias("ds"), F.col(y).alias("y")
    )


def fill_days(series: DataFrame) -> DataFrame:
    """Calendar without gaps: each day is repeated until the next one that has a value."""
    nxt = F.lead("ds").over(Window.partitionBy("unique_id").orderBy("ds"))
    until = F.coalesce(F.date_sub("_next", 1), F.col("ds"))
    return series.withColumn("_next", nxt).select(
        "unique_id", F.explode(F.sequence("ds", until)).alias("ds"), "y"
    )


def seasonal_lag(filled: DataFrame, season: int = SEASON) -> DataFrame:
    """Adds ``y_lag``, the value one season earlier."""
    w = Window.partitionBy("unique_id").orderBy("ds")
    return filled.withColumn("y_lag", F.lag("y", season).over(w))


def holdout_split(series: DataFrame, horizon: int = HORIZON) -> tuple[DataFrame, DataFrame]:
    """(train, holdout) around one cutoff, the newest day of all series less the horizon."""
    cutoff = F.date_sub(latest(series, "ds"), horizon)
    return series.filter(F.col("ds") <= cutoff), series.filter(F.col("ds") > cutoff)


def rolling_origins(
    series: DataFrame, horizon: int = HORIZON, windows: int = WINDOWS
) -> DataFrame:
    """(unique_id, cutoff): ``windows`` origins per series, the last one a horizon before its end."""
    steps = F.sequence(F.lit(1), F.lit(windows))
    return (
        series.groupBy("unique_id")
        .agg(F.max("ds").alias("_last"))
        .select("unique_id", "_last", F.explode(steps).alias("_back"))
        .select(
            "unique_id",
            F.date_sub("_last", (F.col("_back") * F.lit(horizon)).cast("int")).alias("cutoff"),
        )
    )


def final_origin(series: DataFrame) -> DataFrame:
    """(unique_id, cutoff) with the last day of every series."""
    return series.groupBy("unique_id").agg(F.max("ds").alias("cutoff"))


def target_days(origins: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """(unique_id, cutoff, step, ds) for each day to predict."""
    return origins.select(
        "unique_id", "cutoff", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step")
    ).withColumn("ds", F.date_add("cutoff", F.col("step")))


def seasonal_naive(
    filled: DataFrame, origins: DataFrame, horizon: int = HORIZON, season: int = SEASON
) -> DataFrame:
    """(unique_id, cutoff, step, ds, y_hat): the last season before the cutoff, repeated."""
    back = F.lit(season) - F.lit(1) - F.pmod(F.col("step") - 1, F.lit(season))
    wanted = target_days(origins, horizon).withColumn(
        "_source", F.date_sub("cutoff", back.cast("int"))
    )
    source = filled.select("unique_id", F.col("ds").alias("_source"), F.col("y").alias("y_hat"))
    return wanted.join(source, ["unique_id", "_source"]).drop("_source")


def naive_spread(filled: DataFrame, season: int = SEASON) -> DataFrame:
    """(unique_id, sigma): root mean square of the one-season differences."""
    diff = F.col("y") - F.col("y_lag")
    return (
        seasonal_lag(filled, season)
        .groupBy("unique_id")
        .agg(F.sqrt(F.avg(diff * diff)).alias("sigma"))
    )


def naive_forecast(
    filled: DataFrame, horizon: int = HORIZON, season: int = SEASON, z: float = Z90
) -> DataFrame:
    """Next ``horizon`` days per series with a band of ``z * sigma * sqrt(k + 1)``, where k
    counts the full seasons between the target day and the history."""
    point = seasonal_naive(filled, final_origin(filled), horizon, season)
    k = F.floor((F.col("step") - 1) / F.lit(season))
    half = F.lit(z) * F.col("sigma") * F.sqrt(k + F.lit(1.0))
    return point.join(naive_spread(filled, season), "unique_id").select(
        "unique_id", "ds", "y_hat", (F.col("y_hat") - half).alias("lo"),
        (F.col("y_hat") + half).alias("hi"),
    )


def with_truth(predictions: DataFrame, series: DataFrame) -> DataFrame:
    """Adds the observed ``y``; predictions of days without an observation drop out."""
    return predictions.join(series.select("unique_id", "ds", "y"), ["unique_id", "ds"])


def unpivot_models(wide: DataFrame, ids: list[str], models: list[str]) -> DataFrame:
    """One column per model -> long rows ``(ids, model, y_hat)``."""
    return wide.unpivot(ids, models, "model", "y_hat")


def error_scores(scored: DataFrame, keys: list[str]) -> DataFrame:
    """MAE, RMSE (1 digit) and MAPE (2 digits) of ``y`` against ``y_hat`` per key."""
    terms = scored.withColumns({
        "_ae": F.abs(F.col("y") - F.col("y_hat")),
        "_se": X.squared_error("y", "y_hat"),
        "_ape": X.percent_error("y", "y_hat"),
    })
    return terms.groupBy(*keys).agg(
        X.settle("avg(_ae)", 1).alias("mae"),
        X.settle("sqrt(avg(_se))", 1).alias("rmse"),
        X.settle("avg(_ape)", 2).alias("mape"),
    )


def accuracy_table(
    backtest: DataFrame, horizon: int = HORIZON, windows: int = WINDOWS
) -> DataFrame:
    """Backtest rows ``(unique_id, model, y, y_hat)`` -> accuracy per region and model."""
    return error_scores(
        backtest.withColumnRenamed("unique_id", "region"), ["region", "model"]
    ).select(
        "*",
        F.lit(windows).cast("int").alias("n_windows"),
        F.lit(horizon).cast("int").alias("horizon"),
    )


def match_completeness(holdout: DataFrame, predictions: DataFrame, keys: list[str]) -> DataFrame:
    """One row: holdout rows, how many found a prediction, how many did not."""
    found = predictions.select(*keys).distinct().withColumn("_hit", F.lit(1))
    return holdout.join(found, keys, "left").agg(
        F.count(F.lit(1)).alias("expected"),
        F.count("_hit").alias("matched"),
        F.count_if(F.col("_hit").isNull()).alias("unmatched"),
    )


def engine_benchmark(
    holdout: DataFrame, predictions: DataFrame, horizon: int = HORIZON
) -> DataFrame:
    """Any number of prediction sets ``(engine, model, region, ds, pred)`` scored on one
    holdout ``(unique_id, ds, y)``, with the holdout's bounds."""
    truth = holdout.withColumnRenamed("unique_id", "region")
    last = latest(holdout, "ds")
    return (
        error_scores(
            truth.join(predictions.withColumnRenamed("pred", "y_hat"), ["region", "ds"]),
            ["region", "engine", "model"],
        )
        .withColumn("holdout_start", F.date_sub(last, horizon - 1))
        .withColumn("holdout_end", last)
    )


def mape_pivot(scores: DataFrame, models: list[str], how=F.avg) -> DataFrame:
    """Regions down, the given models across. Listing the models saves a pass over the data."""
    return scores.groupBy("region").pivot("model", models).agg(how("mape"))


def best_model(scores: DataFrame, order: list[str]) -> DataFrame:
    """Model with the lowest MAPE per region; a tie goes to the first in ``order``.

    The minimum of a struct is an ordinary aggregate that combines before the shuffle.
    """
    rank = F.lit(len(order))
    for i, model in reversed(list(enumerate(order))):
        rank = F.when(F.col("model") == model, i).otherwise(rank)
    best = F.min(F.struct(F.col("mape"), rank.alias("_rank"), F.col("model")))
    return (
        scores.groupBy("region").agg(best.alias("_best"))
        .select("region", F.col("_best.model").alias("model"), F.col("_best.mape").alias("mape"))
    )


def mean_score(scores: DataFrame) -> DataFrame:
    """Mean MAPE over regions per engine and model, best first."""
    return (
        scores.groupBy("engine", "model")
        .agg(X.settle("avg(mape)", 2).alias("avg_mape"))
        .orderBy("avg_mape", "engine", "model")
    )


def gain_over_baseline(scores: DataFrame, baseline: str = "SeasonalNaive") -> DataFrame:
    """Relative improvement of each model's MAPE on the baseline's, per region."""
    base = F.max(F.when(F.col("model") == baseline, F.col("mape")))
    naive = scores.groupBy("region").agg(base.alias("_base"))
    return scores.filter(F.col("model") != baseline).join(naive, "region").select(
        "region", "model", X.round_half_away("(_base - mape) / nullif(_base, 0d)", 6).alias("gain")
    )
