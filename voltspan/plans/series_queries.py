"""Windows, top-k, set operations, forecasting and anomalies (inventory G to J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltspan.operators import anomalies, forecast, marts, series, summaries
from voltspan.plans import reports
from voltspan.plans.join_queries import _TOP
from voltspan.plans.oracle import r, sql
from voltspan.plans.registry import q6, query


@query("g2_share_of_total", sql("""select region_name, fueltech_label, round(gwh, 6) as gwh,
    round(gwh / nullif(sum(gwh) over (partition by region_name), 0), 6) as share from (
    select region_name, fueltech_label, sum(generation_mwh) / 1000.0::double as gwh
    from generation_named where settlement_day >= (select max(settlement_day) - interval '90 days'
    from generation_named) group by 1, 2)""", "generation_named"))
def _(t):
    return q6(reports.with_region_share(reports.mix_by_region(t.generation_stored)), "gwh", "share")


@query("g3_seasonal_lag", sql("""select unique_id, ds, y, lag(y, 7) over (partition by unique_id
    order by ds) as y_lag from filled""", "filled"))
def _(t):
    return series.seasonal_lag(t.filled)


@query("g4_rolling_origins", sql("select unique_id, cutoff from origins", "origins"))
def _(t):
    return series.rolling_origins(t.series)


@query("h1_ordered", sql("""select region_name, settlement_day, avg_demand_mw from
    region_daily_named order by settlement_day desc, region_name""", "region_daily_named"))
def _(t):
    return t.region_totals_named.select("region_name", "settlement_day", "avg_demand_mw").orderBy(
        F.col("settlement_day").desc(), "region_name"
    )


@query("h2_latest_period", sql("""select cast(date_trunc('month', settlement_day) as date) as
    month, count(*) as n from history group by 1 order by 1 desc limit 1""", "history"))
def _(t):
    from voltspan.functions.scalars import month_of

    return (
        t.history.groupBy(month_of("settlement_day").alias("month"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("month").desc())
        .limit(1)
    )


@query("h3_latest_intervals", sql("""select settlement_date, total_demand_mw, rrp_aud_mwh
    from price_demand where region = 'NSW1' order by settlement_date desc limit 3""",
    "price_demand"))
def _(t):
    return summaries.latest_intervals(t.raw_price, "NSW1")


@query("h4_top_groups", sql(_TOP.replace("limit 8", "limit 5"), "scada", "dim_duid"))
def _(t):
    return summaries.top_fueltechs(t.raw_scada, t.dim_duid, 5)


_FLAGGED = """select * from anomalies where is_anomaly order by distance desc, settlement_day,
    region limit {n}"""


@query("h5_top10_flagged", sql(_FLAGGED.format(n=10), "anomalies"))
def _(t):
    return anomalies.top_flagged(t.scored_prices, 10)


@query("h6_top8_flagged", sql(_FLAGGED.format(n=8), "anomalies"))
def _(t):
    return anomalies.top_flagged(t.scored_prices, 8)


@query("h7_sorted_means", sql("""select region, round(avg(avg_demand_mw), 6) as m from history
    group by 1 order by 2""", "history"))
def _(t):
    df = t.history.groupBy("region").agg(F.avg("avg_demand_mw").alias("m"))
    return q6(df, "m").orderBy("m", "region")


@query("i1_union_all", sql("""select unique_id as region, ds as date, y as demand, 'actual' as
    series from series union all select region, forecast_date, predicted_demand_mw, 'forecast'
    from naive_fc""", "series", "naive_fc"))
def _(t):
    actual = t.series.select(
        F.col("unique_id").alias("region"), F.col("ds").alias("date"),
        F.col("y").alias("demand"), F.lit("actual").alias("series"),
    )
    return actual.unionByName(
        t.naive_forecast.select(
            "region", F.col("forecast_date").alias("date"),
            F.col("predicted_demand_mw").alias("demand"), F.lit("forecast").alias("series"),
        )
    )


@query("i2_wide_to_long", sql("""select unique_id, ds, model, y_hat from (
    select unique_id, ds, lag(y, 1) over w as "DayBefore", lag(y, 7) over w as "SeasonalNaive"
    from filled window w as (partition by unique_id order by ds))
    unpivot include nulls (y_hat for model in ("DayBefore", "SeasonalNaive"))""", "filled"))
def _(t):
    day = series.seasonal_lag(t.filled, 1).withColumnRenamed("y_lag", "DayBefore")
    wide = series.seasonal_lag(day).withColumnRenamed("y_lag", "SeasonalNaive")
    return series.unpivot_models(wide, ["unique_id", "ds"], ["DayBefore", "SeasonalNaive"])


# ------------------------------------------------------------------ time-series jobs
@query("j1_holdout_split", sql("""select 'train' as part, unique_id, count(*) as n, min(ds) as
    first_ds, max(ds) as last_ds from train group by 2 union all select 'holdout', unique_id,
    count(*), min(ds), max(ds) from holdout group by 2""", "train", "holdout"))
def _(t):
    train, holdout = series.holdout_split(t.series)
    both = train.withColumn("part", F.lit("train")).unionByName(
        holdout.withColumn("part", F.lit("holdout"))
    )
    return both.groupBy("part", "unique_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds")
    )


@query("j2_rolling_backtest", sql("""select unique_id, 'SeasonalNaive' as model, cutoff, ds,
    y_hat, y from naive_bt""", "naive_bt"))
def _(t):
    return t.naive_backtest.select("unique_id", "model", "cutoff", "ds", "y_hat", "y")


@query("j3_seasonal_naive", sql("""select region as unique_id, forecast_date as ds,
    predicted_demand_mw as y_hat from naive_fc""", "naive_fc"))
def _(t):
    filled = t.filled
    return series.seasonal_naive(filled, series.final_origin(filled)).select(
        "unique_id", "ds", "y_hat"
    )


@query("j4_smoothing_backtest", sql("""select * replace (round(y_hat, 6) as y_hat)
    from ets_whole_bt""", "ets_whole_bt"))
def _(t):
    return q6(forecast.backtest(t.series, ["AutoETS"], whole=True), "y_hat")


@query("j5_decomposition_backtest", sql("""select * replace (round(y_hat, 6) as y_hat)
    from mstl_bt""", "mstl_bt"))
def _(t):
    return q6(forecast.backtest(t.series, ["MSTL"]), "y_hat")


@query("j6_naive_forecast_band", sql("""select region, model, forecast_date,
    round(predicted_demand_mw, 6) as predicted_demand_mw, round(lo_90, 6) as lo_90,
    round(hi_90, 6) as hi_90 from naive_fc""", "naive_fc"))
def _(t):
    return q6(t.naive_forecast.drop("generated_at"), "predicted_demand_mw", "lo_90", "hi_90")


@query("j6_smoothing_forecast_band", sql("""select region, model, forecast_date,
    round(predicted_demand_mw, 6) as predicted_demand_mw, round(lo_90, 6) as lo_90,
    round(hi_90, 6) as hi_90 from ets_fc""", "ets_fc"))
def _(t):
    ahead = forecast.demand_forecast(t.series, ["AutoETS"]).drop("generated_at")
    return q6(ahead, "predicted_demand_mw", "lo_90", "hi_90")


@query("j6_all_models_forecast", sql(f"""select region, model, forecast_date,
    {r('predicted_demand_mw', 1)} as predicted_demand_mw, {r('lo_90', 1)} as lo_90,
    {r('hi_90', 1)} as hi_90 from (select * from naive_fc union all by name select * from ets_fc
    union all by name select * from mstl_fc)""", "naive_fc", "ets_fc", "mstl_fc"))
def _(t):
    return marts.fct_demand_forecast(forecast.demand_forecast(t.series)).drop("generated_at")


@query("j7_accuracy", sql("select * from accuracy", "accuracy"))
def _(t):
    return t.accuracy


@query("j7_accuracy_two_models", sql("""select * from accuracy union all by name
    select * from ets_whole_accuracy""", "accuracy", "ets_whole_accuracy"))
def _(t):
    return series.accuracy_table(forecast.backtest(t.series, ["SeasonalNaive", "AutoETS"], whole=True))


@query("j7_accuracy_all_models", sql("""select * from accuracy union all by name
    select * from ets_accuracy union all by name select * from mstl_accuracy""",
    "accuracy", "ets_accuracy", "mstl_accuracy"))
def _(t):
    return series.accuracy_table(forecast.backtest(t.series))


@query("j8_engine_benchmark", sql("select * from bench_scores", "bench_scores"))
def _(t):
    return t.benchmark


@query("j8_engine_benchmark_all_models", sql(f"""select * from bench_scores union all by name
    select region, engine, model, {r('avg(abs(y - pred))', 1)} as mae,
    {r('sqrt(avg((y - pred) * (y - pred)))', 1)} as rmse,
    {r('avg(abs(y - pred) / nullif(y, 0) * 100.0::double)', 2)} as mape,
    (select max(ds) - 6 from holdout) as holdout_start, (select max(ds) from holdout) as holdout_end
    from holdout h join (select * from ets_bench union all by name select * from mstl_bench) p
      on h.unique_id = p.region and h.ds = p.ds group by 1, 2, 3""",
    "bench_scores", "holdout", "ets_bench", "mstl_bench"))
def _(t):
    train, holdout = series.holdout_split(t.series)
    sets = t.external.unionByName(forecast.benchmark_predictions(train))
    return series.engine_benchmark(holdout, sets)


@query("j9_winner_and_mean", sql("""select region, model, mape, avg_mape from (select *,
    row_number() over (partition by region order by mape, case model when 'SeasonalNaive' then 0
    else 1 end) as rn from bench_scores) join (select model, round(round(avg(mape), 6), 2) as
    avg_mape from bench_scores group by 1) using (model) where rn = 1""", "bench_scores"))
def _(t):
    mean = series.mean_score(t.benchmark).select("model", "avg_mape")
    return series.best_model(t.benchmark, ["SeasonalNaive", "DayBefore"]).join(mean, "model")


@query("j10_price_anomalies", sql("select * from anomalies", "anomalies"))
def _(t):
    return t.scored_prices


@query("j11_surprise_report", sql("""select region, count(*) filter (is_anomaly) as flagged,
    round(round(max(surprise_aud_mwh), 6), 2) as top_surprise from anomalies_mart group by 1""",
    "anomalies_mart"))
def _(t):
    from voltspan.functions.scalars import settle

    return t.price_anomalies.groupBy("region").agg(
        F.count_if("is_anomaly").alias("flagged"),
        settle("max(surprise_aud_mwh)", 2).alias("top_surprise"),
    )


@query("j12_gain_over_baseline", sql("""select b.region, b.model, round((n.mape - b.mape) /
    nullif(n.mape, 0), 6) as gain from bench_scores b join bench_scores n
    on b.region = n.region and n.model = 'SeasonalNaive' where b.model <> 'SeasonalNaive'""",
    "bench_scores"))
def _(t):
    return series.gain_over_baseline(t.benchmark)


