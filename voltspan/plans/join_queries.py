"""Joins and aggregations (inventory E and F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltspan.functions import scalars as X
from voltspan.functions.dates import latest
from voltspan.functions.quantiles import exact_median
from voltspan.operators import anomalies, dims, marts, quality, series, summaries
from voltspan.plans import reports
from voltspan.plans.oracle import r, sql
from voltspan.plans.registry import q6, query
from voltspan.session import maybe_broadcast
from voltspan.sources import coverage


@query("e1_units_inner", sql("""select d.region, d.fueltech, count(*) as n from stg_scada s
    join dim_duid d on s.duid = d.duid group by 1, 2""", "stg_scada", "dim_duid"))
def _(t):
    units = maybe_broadcast(t.dim_duid.select("duid", "region", "fueltech"))
    return t.stg_scada.join(units, "duid").groupBy("region", "fueltech").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("e2_fueltech_inner", sql("""select region, settlement_day, is_renewable,
    round(sum(generation_mwh), 6) as mwh from generation_daily join dim_fueltech using (fueltech)
    group by 1, 2, 3""", "generation_daily", "dim_fueltech"))
def _(t):
    fuel = t.dim_fueltech.select("fueltech", "is_renewable")
    df = t.generation_daily.join(fuel, "fueltech").groupBy(
        "region", "settlement_day", "is_renewable"
    ).agg(F.sum("generation_mwh").alias("mwh"))
    return q6(df, "mwh")


_GEN_NAMED = """select * replace (round(generation_mwh, 6) as generation_mwh)
    from generation_named"""


@query("e3_star_join", sql(_GEN_NAMED, "generation_named"))
def _(t):
    return q6(
        marts.generation_labelled(t.generation_daily, t.dim_fueltech, t.dim_region),
        "generation_mwh",
    )


@query("e4_region_label", sql("select * from energy_named", "energy_named"))
def _(t):
    return dims.with_region_name(t.energy_daily, t.dim_region)


@query("e5_keep_unmapped", sql("""select s.duid, u.fueltech, count(*) as n from scada s
    left join dim_duid u on s.duid = u.duid group by 1, 2""", "scada", "dim_duid"))
def _(t):
    # one row per unit meets the dimension, not one per reading
    per_unit = t.raw_scada.groupBy("duid").agg(F.count(F.lit(1)).alias("n"))
    return per_unit.join(t.dim_duid.select("duid", "fueltech"), "duid", "left").select(
        "duid", "fueltech", "n"
    )


@query("e6_predictions_to_actuals", sql("""select h.unique_id as region, h.ds, h.y, p.pred
    from holdout h join external p on h.unique_id = p.region and h.ds = p.ds""",
    "holdout", "external"))
def _(t):
    _, holdout = series.holdout_split(t.series)
    return holdout.withColumnRenamed("unique_id", "region").join(
        t.external.select("region", "ds", "pred"), ["region", "ds"]
    )


@query("e7_match_completeness", sql("""select count(*) as expected, count(p.region) as matched,
    count(*) - count(p.region) as unmatched from series s left join
    (select distinct region, ds from external) p on s.unique_id = p.region and s.ds = p.ds""",
    "series", "external"))
def _(t):
    found = t.external.withColumnRenamed("region", "unique_id")
    return series.match_completeness(t.series, found, ["unique_id", "ds"])


@query("e8_orphans", sql("""select s.duid, count(*) as n_rows from scada s
    where s.duid not in (select duid from dim_duid) group by 1""", "scada", "dim_duid"))
def _(t):
    return quality.relationships(t.raw_scada, "duid", t.dim_duid, "duid")


@query("e9_month_region_grid", sql("""select strftime(m, '%Y%m') as source_month, g.region from (
    select unnest(generate_series(date_trunc('month', e) - interval 72 month,
    date_trunc('month', e) - interval 1 month, interval 1 month)) as m
    from (select max(ts) as e from events)),
    (values ('NSW1'), ('QLD1'), ('VIC1'), ('SA1'), ('TAS1')) g(region)"""))
def _(t):
    end = t.table("events").agg(F.max(F.to_date("ts")).alias("e"))
    return coverage.expected_files(end, F.col("e"), 72)


@query("e10_scalar_subquery", sql("""select region, count(*) as n from history
    where settlement_day = (select max(settlement_day) from history) group by 1""", "history"))
def _(t):
    newest = latest(t.history, "settlement_day")
    return t.history.filter(F.col("settlement_day") == newest).groupBy("region").agg(
        F.count(F.lit(1)).alias("n")
    )


# --------------------------------------------------------------------- aggregations
@query("f1_region_daily", sql("select * from region_daily", "region_daily"))
def _(t):
    return t.region_daily


@query("f2_exact_median", sql("""select l_returnflag, round(median(l_extendedprice), 6) as
    median_price from lineitem group by 1"""))
def _(t):
    return q6(
        exact_median(t.table("lineitem"), ["l_returnflag"], "l_extendedprice", "median_price"),
        "median_price",
    )


@query("f3_conditional_count", sql("""select region, cast(sum(case when is_negative_price then 1
    else 0 end) as bigint) as negative from fct_price group by 1""", "fct_price"))
def _(t):
    return t.fct_price.groupBy("region").agg(F.count_if("is_negative_price").alias("negative"))


@query("f4_row_percentage", sql(f"""select region, {r('''100.0::double * sum(case when
    is_negative_price then 1 else 0 end) / count(*)''', 2)} as pct from fct_price group by 1""",
    "fct_price"))
def _(t):
    return t.fct_price.groupBy("region").agg(
        X.settle("100d * count_if(is_negative_price) / count(1)", 2).alias("pct")
    )


@query("f5_generation_half_hour", sql("""select * replace (round(generation_mwh, 6) as
    generation_mwh, round(generation_avg_mw, 6) as generation_avg_mw) from generation""",
    "generation"))
def _(t):
    return q6(t.generation, "generation_mwh", "generation_avg_mw")


@query("f5_generation_half_hour_shuffled", sql("""select * replace (round(generation_mwh, 6) as
    generation_mwh, round(generation_avg_mw, 6) as generation_avg_mw) from generation""",
    "generation"))
def _(t):
    """The path taken when the unit table is too large to broadcast."""
    return q6(
        marts.fct_generation(t.stg_scada, t.dim_duid, broadcast_units=False),
        "generation_mwh", "generation_avg_mw",
    )


@query("f6_generation_daily", sql("""select * replace (round(generation_mwh, 6) as
    generation_mwh) from generation_daily""", "generation_daily"))
def _(t):
    return q6(marts.fct_generation_daily(t.generation), "generation_mwh")


@query("f6_generation_daily_direct", sql("""select * replace (round(generation_mwh, 6) as
    generation_mwh) from generation_daily""", "generation_daily"))
def _(t):
    """The same table without the 30-minute level in between."""
    return q6(t.generation_daily, "generation_mwh")


@query("f7_region_energy_daily", sql("select * from energy_daily", "energy_daily"))
def _(t):
    return t.energy_daily


@query("f8_weighted_sum", sql("""select region, round(sum(generation_mwh *
    emission_factor_t_co2_per_mwh), 6) as emissions from generation_daily
    join dim_fueltech using (fueltech) group by 1""", "generation_daily", "dim_fueltech"))
def _(t):
    fuel = t.dim_fueltech.select("fueltech", "emission_factor_t_co2_per_mwh")
    weighted = F.sum(F.col("generation_mwh") * F.col("emission_factor_t_co2_per_mwh"))
    df = t.generation_daily.join(fuel, "fueltech").groupBy("region").agg(
        weighted.alias("emissions")
    )
    return q6(df, "emissions")


@query("f9_ratio_of_sums", sql("""select region, cast(date_trunc('month', settlement_day) as date)
    as month, round(sum(renewable_mwh) / nullif(sum(total_generation_mwh), 0), 6) as share
    from energy_daily group by 1, 2""", "energy_daily"))
def _(t):
    share = X.safe_ratio(F.sum("renewable_mwh"), F.sum("total_generation_mwh"))
    df = t.energy_daily.groupBy("region", X.month_of("settlement_day").alias("month")).agg(
        share.alias("share")
    )
    return q6(df, "share")


@query("f10_mean_of_daily_means", sql("""select region, cast(date_trunc('month', settlement_day)
    as date) as month, round(avg(avg_rrp), 6) as avg_rrp from history group by 1, 2""", "history"))
def _(t):
    df = t.history.groupBy("region", X.month_of("settlement_day").alias("month")).agg(
        F.avg("avg_rrp").alias("avg_rrp")
    )
    return q6(df, "avg_rrp")


@query("f11_global_aggregate", sql("""select round(avg(avg_rrp), 6) as avg_price,
    round(avg(avg_demand_mw), 6) as avg_demand, count(*) as days from history""", "history"))
def _(t):
    return q6(
        t.history.agg(
            F.avg("avg_rrp").alias("avg_price"), F.avg("avg_demand_mw").alias("avg_demand"),
            F.count(F.lit(1)).alias("days"),
        ),
        "avg_price", "avg_demand",
    )


@query("f12_count_distinct", sql("""select count(distinct duid) as duids,
    count(distinct source_month) as months from scada""", "scada"))
def _(t):
    # one small row per (unit, month) and task is shuffled, never the readings twice
    pairs = t.raw_scada.select("duid", "source_month").distinct()
    return pairs.agg(
        F.count_distinct("duid").alias("duids"), F.count_distinct("source_month").alias("months")
    )


@query("f13_distinct", sql("select distinct fueltech, region from unit_seed", "unit_seed"))
def _(t):
    return t.unit_seed.select("fueltech", "region").distinct()


@query("f14_price_coverage", sql(f"""select region, count(*) as n, min(settlement_date) as
    first_ts, max(settlement_date) as last_ts, {r('avg(rrp_aud_mwh)', 2)} as avg_rrp,
    {r('avg(total_demand_mw)', 0)} as avg_dmd from price_demand group by 1""", "price_demand"))
def _(t):
    return summaries.price_coverage(t.raw_price)


@query("f14_price_total", sql("select count(*) as n from price_demand", "price_demand"))
def _(t):
    return t.raw_price.agg(F.count(F.lit(1)).alias("n"))


@query("f15_scada_extent", sql("""select count(*) as n, count(distinct duid) as duids,
    min(settlement_date) as first_ts, max(settlement_date) as last_ts from scada""", "scada"))
def _(t):
    return summaries.scada_extent(t.raw_scada)


@query("f16_error_scores", sql(f"""select unique_id, {r('avg(abs(y - l))', 1)} as mae,
    {r('sqrt(avg((y - l) * (y - l)))', 1)} as rmse,
    {r('avg(abs(y - l) / nullif(y, 0) * 100.0::double)', 2)} as mape from (select *, lag(y, 7)
    over (partition by unique_id order by ds) as l from filled) where l is not null group by 1""",
    "filled"))
def _(t):
    rows = series.seasonal_lag(t.filled).filter(F.col("y_lag").isNotNull())
    return series.error_scores(rows.withColumnRenamed("y_lag", "y_hat"), ["unique_id"])


@query("f17_mean_metric", sql(f"""select engine, model, {r('avg(mape)', 2)} as avg_mape
    from bench_scores group by 1, 2""", "bench_scores"))
def _(t):
    return series.mean_score(t.benchmark)


@query("f18_label_tally", sql("select fueltech, count(*) as n from unit_seed group by 1",
                              "unit_seed"))
def _(t):
    return summaries.tally(t.unit_seed, "fueltech")


@query("f19_flag_rate", sql(f"""select count(*) filter (is_anomaly) as flagged, count(*) as scored,
    {r('100.0::double * count(*) filter (is_anomaly) / count(*)', 1)} as flagged_pct
    from anomalies""", "anomalies"))
def _(t):
    return anomalies.flag_rate(t.scored_prices)


@query("f19_flags_by_region", sql("""select region, count(*) filter (is_anomaly) as anomalies
    from anomalies group by 1""", "anomalies"))
def _(t):
    return anomalies.flags_by_region(t.scored_prices)


@query("f20_mape_pivot", sql("""select region, avg(mape) filter (model = 'DayBefore') as
    "DayBefore", avg(mape) filter (model = 'SeasonalNaive') as "SeasonalNaive"
    from bench_scores group by 1""", "bench_scores"))
def _(t):
    return series.mape_pivot(t.benchmark, ["DayBefore", "SeasonalNaive"])


@query("f21_best_model", sql("""select region, model, mape from (select *, row_number() over
    (partition by region order by mape, case model when 'SeasonalNaive' then 0 else 1 end) as rn
    from bench_scores) where rn = 1""", "bench_scores"))
def _(t):
    return series.best_model(t.benchmark, ["SeasonalNaive", "DayBefore"])


@query("f22_last_wins", sql("select * from unit_seed", "unit_seed"))
def _(t):
    return dims.unit_seed(t.registry)


@query("f23_rows_per_month", sql("select source_month, count(*) as n from scada group by 1",
                                 "scada"))
def _(t):
    return summaries.rows_per_month(t.raw_scada)


_TOP = """select coalesce(u.fueltech, 'UNMAPPED') as ft, round(round(sum(s.scada_mw) *
    (5.0::double / 60.0::double) / 1000.0::double, 6), 1) as gwh from scada s
    left join dim_duid u on s.duid = u.duid where s.scada_mw > 0 group by 1
    order by gwh desc, ft limit 8"""


@query("f24_top_fueltechs", sql(_TOP, "scada", "dim_duid"))
def _(t):
    return summaries.top_fueltechs(t.raw_scada, t.dim_duid)


# -------------------------------------------------------------------- stated analyses
@query("l35_negative_share_by_year", sql(f"""select year(settlement_day) as year,
    {r('''100.0::double * count(*) filter (is_negative_price) / count(*)''', 2)} as negative_pct
    from fct_price group by 1""", "fct_price"))
def _(t):
    return reports.negative_share_by_year(t.fct_price)


@query("l35_negative_share_by_region", sql(f"""select year(settlement_day) as year, region,
    {r('''100.0::double * count(*) filter (is_negative_price) / count(*)''', 2)} as negative_pct
    from fct_price group by 1, 2""", "fct_price"))
def _(t):
    return reports.negative_share_by_year(t.fct_price, by_region=True)


@query("l36_transition_ranking", sql("""select region, renewable_share, negative_share,
    rank() over (order by renewable_share desc) as renewable_rank,
    rank() over (order by negative_share desc) as negative_rank from (
      select region, round(sum(renewable_mwh) / nullif(sum(total_generation_mwh), 0), 6)
        as renewable_share from energy_daily group by 1) join (
      select region, round(sum(negative_price_intervals)::double /
        nullif(sum(interval_count), 0), 6) as negative_share from region_daily group by 1)
    using (region)""", "energy_daily", "region_daily"))
def _(t):
    return reports.transition_ranking(t.energy_daily, t.region_totals)


@query("l37_price_cap_by_year", sql("""select year, max_rrp, settlement_date, region from (
    select year(settlement_day) as year, rrp_aud_mwh as max_rrp, settlement_date, region,
    row_number() over (partition by year(settlement_day) order by rrp_aud_mwh desc,
    settlement_date, region) as rn from fct_price where rrp_aud_mwh is not null) where rn = 1""",
    "fct_price"))
def _(t):
    return reports.price_cap_by_year(t.fct_price)
