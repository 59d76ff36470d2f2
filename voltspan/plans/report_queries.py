"""Report queries, labelled sources and exports (inventory L)."""

from __future__ import annotations

from voltspan.operators import forecast, marts
from voltspan.plans import reports
from voltspan.plans.oracle import r, sql
from voltspan.plans.registry import q6, query

_M = "cast(date_trunc('month', settlement_day) as date) as month"
_SHARE = "round(sum(renewable_mwh) / nullif(sum(total_generation_mwh), 0), 6)"
_CARBON = ("round(1000.0::double * sum(est_emissions_tco2) / "
           "nullif(sum(total_generation_mwh), 0), 6)")


def _recent(table: str, days: int) -> str:
    return (f"settlement_day >= (select max(settlement_day) - interval '{days} days' "
            f"from {table})")


@query("l1_nem_latest", sql(f"""select {_M}, {_SHARE} as renewable_share_pct,
    {_CARBON} as carbon_intensity from energy_named group by 1 order by 1 desc limit 1""",
    "energy_named"))
def _(t):
    return q6(reports.nem_latest(t.energy_named), "renewable_share_pct", "carbon_intensity")


@query("l2_price_latest", sql(f"""select round(avg(avg_rrp), 6) as avg_price,
    round(avg(avg_demand_mw), 6) as avg_demand from region_daily_named
    where {_recent('region_daily_named', 30)}""", "region_daily_named"))
def _(t):
    return q6(reports.price_latest(t.region_totals_stored), "avg_price", "avg_demand")


@query("l2_price_latest_week", sql(f"""select round(avg(avg_rrp), 6) as avg_price,
    round(avg(avg_demand_mw), 6) as avg_demand from region_daily_named
    where {_recent('region_daily_named', 7)}""", "region_daily_named"))
def _(t):
    return q6(reports.price_latest(t.region_totals_stored, 7), "avg_price", "avg_demand")


@query("l3_renewable_trend", sql(f"""select {_M}, {_SHARE} as renewable_share_pct
    from energy_named group by 1""", "energy_named"))
def _(t):
    return q6(reports.nem_ren_trend(t.energy_named), "renewable_share_pct")


@query("l4_fuel_mix_recent", sql(f"""select fuel_group, round(sum(generation_mwh) /
    1000.0::double, 6) as gwh from generation_named where {_recent('generation_named', 30)}
    group by 1""", "generation_named"))
def _(t):
    return q6(reports.fuel_mix_recent(t.generation_stored), "gwh")


@query("l5_price_trend", sql(f"""select region_name, {_M}, round(avg(avg_rrp), 6) as avg_rrp
    from region_daily_named group by 1, 2""", "region_daily_named"))
def _(t):
    return q6(reports.price_trend(t.region_totals_named), "avg_rrp")


@query("l6_demand_trend", sql(f"""select region_name, {_M}, round(avg(avg_demand_mw), 6) as
    avg_demand from region_daily_named group by 1, 2""", "region_daily_named"))
def _(t):
    return q6(reports.demand_trend(t.region_totals_named), "avg_demand")


@query("l7_negative_price", sql(f"""select region_name, {_M}, round(avg(negative_price_pct) /
    100.0::double, 6) as negative_price_pct from region_daily_named group by 1, 2""",
    "region_daily_named"))
def _(t):
    return q6(reports.neg_price(t.region_totals_named), "negative_price_pct")


@query("l8_renewable_by_region", sql(f"""select region_name, {_M}, {_SHARE} as
    renewable_share_pct from energy_named group by 1, 2""", "energy_named"))
def _(t):
    return q6(reports.ren_by_region(t.energy_named), "renewable_share_pct")


@query("l9_mix_over_time", sql(f"""select {_M}, fuel_group, round(sum(generation_mwh) /
    1000.0::double, 6) as gwh from generation_named group by 1, 2""", "generation_named"))
def _(t):
    return q6(reports.mix_over_time(t.generation_named), "gwh")


@query("l10_mix_by_region", sql(f"""select region_name, fueltech_label, round(sum(generation_mwh)
    / 1000.0::double, 6) as gwh from generation_named where {_recent('generation_named', 90)}
    group by 1, 2""", "generation_named"))
def _(t):
    return q6(reports.mix_by_region(t.generation_stored), "gwh")


@query("l11_carbon_trend", sql(f"""select region_name, {_M}, {_CARBON} as carbon_intensity
    from energy_named group by 1, 2""", "energy_named"))
def _(t):
    return q6(reports.ci_trend(t.energy_named), "carbon_intensity")


@query("l12_carbon_latest", sql(f"""select region_name, {_CARBON} as carbon_intensity
    from energy_named where {_recent('energy_named', 30)} group by 1""", "energy_named"))
def _(t):
    return q6(reports.ci_latest(t.energy_stored), "carbon_intensity")


@query("l13_regions", sql("select distinct region_name from region_daily_named",
                          "region_daily_named"))
def _(t):
    return reports.regions(t.region_totals_named)


_HISTORY_NAMED = """(select h.*, g.region_name from history h join dim_region g
    on h.region = g.region_id)"""


@query("l14_actual_and_forecast", sql(f"""select settlement_day as date, avg_demand_mw as demand,
    'actual' as series from {_HISTORY_NAMED} where interval_count >= 2 and settlement_day >=
    (select max(settlement_day) - interval '60 days' from history)
    and region_name = 'Victoria' union all
    select forecast_date, predicted_demand_mw, 'forecast' from fc_named
    where model = 'SeasonalNaive' and region_name = 'Victoria'""",
    "history", "dim_region", "fc_named"))
def _(t):
    return reports.actual_vs_fc(
        t.named(t.history), t.named(t.forecast_mart), "Victoria", "SeasonalNaive", 60, 2
    )


@query("l15_forecast_table", sql("""select forecast_date, predicted_demand_mw, lo_90, hi_90
    from fc_named where model = 'SeasonalNaive' and region_name = 'Tasmania'""", "fc_named"))
def _(t):
    return reports.fc_table(t.named(t.forecast_mart), "Tasmania", "SeasonalNaive")


@query("l15_forecast_table_smoothing", sql(f"""select forecast_date,
    {r('predicted_demand_mw', 1)} as predicted_demand_mw, {r('lo_90', 1)} as lo_90,
    {r('hi_90', 1)} as hi_90 from ets_fc where region = 'TAS1'""", "ets_fc"))
def _(t):
    fc = marts.fct_demand_forecast(forecast.demand_forecast(t.series, ["AutoETS"]))
    return reports.fc_table(t.named(fc), "Tasmania")


@query("l16_accuracy", sql("""select g.region_name, a.model, a.mape from accuracy a
    join dim_region g on a.region = g.region_id""", "accuracy", "dim_region"))
def _(t):
    return reports.acc(t.named(t.accuracy))


@query("l17_benchmark", sql("""select g.region_name, b.model, b.engine, b.mape from bench_scores b
    join dim_region g on b.region = g.region_id""", "bench_scores", "dim_region"))
def _(t):
    return reports.bench(t.named(t.benchmark))


@query("l18_benchmark_mean", sql(f"""select model, engine, {r('avg(mape)', 2)} as avg_mape
    from bench_scores group by 1, 2""", "bench_scores"))
def _(t):
    return reports.bench_avg(t.named(t.benchmark))


@query("l19_anomalies_by_region", sql("""select g.region_name, count(*) filter (is_anomaly) as
    anomalies from anomalies_mart a join dim_region g on a.region = g.region_id group by 1""",
    "anomalies_mart", "dim_region"))
def _(t):
    return reports.anom_by_region(t.named(t.price_anomalies))


@query("l20_top_anomalies", sql(f"""select settlement_day, region_name, avg_rrp, expected_rrp,
    {r('surprise_aud_mwh', 2)} as surprise_aud_mwh from (select a.*, g.region_name from
    anomalies_mart a join dim_region g on a.region = g.region_id) where is_anomaly
    order by distance desc, settlement_day, region_name limit 10""",
    "anomalies_mart", "dim_region"))
def _(t):
    from voltspan.functions.scalars import settle

    top = reports.top_anom(t.named(t.price_anomalies))
    return top.withColumn("surprise_aud_mwh", settle("surprise_aud_mwh", 2))


# ------------------------------------------------------------------- labelled sources
@query("l21_source_demand_forecast", sql("""select region, region_name, model, forecast_date,
    predicted_demand_mw, lo_90, hi_90 from fc_named""", "fc_named"))
def _(t):
    return t.named(t.forecast_mart).select(
        "region", "region_name", "model", "forecast_date", "predicted_demand_mw", "lo_90", "hi_90"
    )


@query("l22_source_engine_benchmark", sql("""select b.region, g.region_name, b.engine, b.model,
    b.mae, b.rmse, b.mape from bench_scores b join dim_region g on b.region = g.region_id""",
    "bench_scores", "dim_region"))
def _(t):
    return t.named(t.benchmark).select(
        "region", "region_name", "engine", "model", "mae", "rmse", "mape"
    )


@query("l23_source_forecast_accuracy", sql("""select a.region, g.region_name, a.model, a.mae,
    a.rmse, a.mape from accuracy a join dim_region g on a.region = g.region_id""",
    "accuracy", "dim_region"))
def _(t):
    return t.named(t.accuracy).select("region", "region_name", "model", "mae", "rmse", "mape")


@query("l24_source_generation_daily", sql("""select * replace (round(generation_mwh, 6) as
    generation_mwh) from generation_named""", "generation_named"))
def _(t):
    return q6(t.generation_named, "generation_mwh")


@query("l25_source_price_anomalies", sql(f"""select a.* replace
    ({r('surprise_aud_mwh', 2)} as surprise_aud_mwh), g.region_name from anomalies_mart a
    join dim_region g on a.region = g.region_id""", "anomalies_mart", "dim_region"))
def _(t):
    from voltspan.functions.scalars import settle

    return t.named(t.price_anomalies).withColumn(
        "surprise_aud_mwh", settle("surprise_aud_mwh", 2)
    )


@query("l26_source_region_daily", sql("select * from region_daily_named", "region_daily_named"))
def _(t):
    return t.region_daily_named


@query("l27_source_region_energy_daily", sql("select * from energy_named", "energy_named"))
def _(t):
    return t.energy_named


# ---------------------------------------------------------------------------- exports
def _export(name: str, oracle: str) -> None:
    from voltspan.plans.build import export_frames
    from voltspan.session import stage

    def run(t):
        out = stage(export_frames(t)[name](), f"export-{name}")
        if name == "generation_daily":
            return q6(out, "generation_mwh")
        return out.drop("generated_at")

    query(f"l{28 + _EXPORTS.index(name)}_export_{name}", oracle)(run)


_EXPORTS = ["region_daily", "region_energy_daily", "generation_daily", "demand_forecast",
            "forecast_accuracy", "dim_region", "raw_price_demand"]
_export("region_daily", sql("select * from region_daily", "region_daily"))
_export("region_energy_daily", sql("select * from energy_daily", "energy_daily"))
_export("generation_daily", sql("""select * replace (round(generation_mwh, 6) as generation_mwh)
    from generation_named""", "generation_named"))
_export("demand_forecast", sql("select * from fc_mart", "fc_mart"))
_export("forecast_accuracy", sql("select * from accuracy", "accuracy"))
_export("dim_region", sql("select * from dim_region", "dim_region"))
_export("raw_price_demand", sql("select * from price_demand", "price_demand"))

