"""The same tables in plain SQL, used only to check results with another engine.

``sql(body, *names)`` prefixes ``body`` with the named common table expressions and all they
depend on.
"""

from __future__ import annotations

from voltspan.functions.scalars import FUEL_RULES, GAS_RULES, MARKET_REGIONS
from voltspan.plans import oracle_series
from voltspan.sources.adapters import DESCRIPTORS, EVENT_REGION, PART_REGION
from voltspan.sources.reference import FUELTECHS, REGIONS


def _text(v: str | None) -> str:
    return "cast(null as varchar)" if v is None else "'" + v.replace("'", "''") + "'"


def pick(values: list, index: str) -> str:
    return "([" + ", ".join(_text(v) for v in values) + f"])[cast({index} as int) + 1]"


def values(rows: list[tuple], names: str) -> str:
    body = ", ".join("(" + ", ".join(_text(v) for v in r) + ")" for r in rows)
    return f"select * from (values {body}) t({names})"


def r(expr: str, n: int) -> str:
    """Six digits first, then the wanted digits."""
    return f"round(round({expr}, 6), {n})"


EVENT_CASE = (
    "case event_type " + " ".join(f"when '{e}' then '{g}'" for e, g in EVENT_REGION) + " end"
)
IN_REGIONS = "(" + ", ".join(f"'{x}'" for x in MARKET_REGIONS) + ")"


def _any(text: str, words: list[str]) -> str:
    return " or ".join(f"contains({text}, '{w}')" for w in words)


def classify(fuel: str, tech: str) -> str:
    f, t = f"lower(coalesce({fuel}, ''))", f"lower(coalesce({tech}, ''))"
    gas = "case " + " ".join(f"when {_any(t, w)} then '{g}'" for g, w in GAS_RULES)
    gas += " else 'gas_other' end"
    arms = []
    for label, fw, tw in FUEL_RULES:
        cond = _any(f, fw) + (" or " + _any(t, tw) if tw else "")
        arms.append(f"when {cond} then " + (gas if label == "gas" else f"'{label}'"))
    return "case " + " ".join(arms) + " else 'other' end"


ERA = "timestamp '2021-10-01 00:00:00'"
SCADA_TS = "l_shipdate + to_minutes(cast(((7 * l_orderkey + l_linenumber) % 288) * 5 as bigint))"


def staged_price(era: str = ERA) -> str:
    return f"""select region, settlement_date, total_demand_mw, rrp_aud_mwh, period_type,
        case when settlement_date > {era} then 5 else 30 end as resolution_min,
        source_month, source_file from price_demand"""


CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "price_demand": ((), f"""select {EVENT_CASE} as region, ts as settlement_date,
        5000.0::double + 10.0::double * value as total_demand_mw,
        value - 30.0::double as rrp_aud_mwh, 'TRADE' as period_type,
        strftime(ts, '%Y%m') as source_month,
        'PRICE_AND_DEMAND_' || strftime(ts, '%Y%m') || '_' || ({EVENT_CASE}) || '.csv'
            as source_file from events"""),
    "stg_price": (("price_demand",), staged_price()),
    "fct_price": (("stg_price",), """select
        md5(coalesce(region, '_dbt_utils_surrogate_key_null_') || '-' ||
            coalesce(cast(settlement_date as varchar), '_dbt_utils_surrogate_key_null_'))
            as price_demand_id,
        region, settlement_date, cast(settlement_date as date) as settlement_day, rrp_aud_mwh,
        total_demand_mw, resolution_min, rrp_aud_mwh < 0 as is_negative_price from stg_price"""),
    "region_daily": (("fct_price",), f"""select region, settlement_day,
        count(*) as interval_count,
        {r('avg(rrp_aud_mwh)', 2)} as avg_rrp,
        round(min(rrp_aud_mwh), 2) as min_rrp, round(max(rrp_aud_mwh), 2) as max_rrp,
        {r('median(rrp_aud_mwh)', 2)} as median_rrp,
        cast(sum(case when is_negative_price then 1 else 0 end) as bigint)
            as negative_price_intervals,
        {r("100.0::double * sum(case when is_negative_price then 1 else 0 end) / count(*)", 2)}
            as negative_price_pct,
        {r('avg(total_demand_mw)', 1)} as avg_demand_mw,
        round(max(total_demand_mw), 1) as peak_demand_mw,
        round(min(total_demand_mw), 1) as min_demand_mw
        from fct_price group by region, settlement_day"""),
    "dim_region": ((), "select " + ", ".join(
        f"{pick([x[i] for x in REGIONS], 'r_regionkey')} as {n}"
        for i, n in enumerate(["region_id", "region_name", "state", "timezone"])
    ) + " from region"),
    "region_daily_named": (("region_daily", "dim_region"), """select rd.*, g.region_name
        from region_daily rd join dim_region g on rd.region = g.region_id"""),
    "fuel_seed": ((), values(
        FUELTECHS,
        "fueltech, fueltech_label, fuel_group, is_renewable, emission_factor_t_co2_per_mwh")),
    "dim_fueltech": (("fuel_seed",), """select fueltech, fueltech_label, fuel_group,
        cast(is_renewable as boolean) as is_renewable,
        cast(emission_factor_t_co2_per_mwh as double) as emission_factor_t_co2_per_mwh
        from fuel_seed"""),
    "registry": ((), f"""select p_partkey as ordinal,
        case when p_size = 50 then '  '
             when p_size <> 49 then ' U' || cast(p_partkey // 4 as varchar) || ' ' end as duid,
        p_name || ' ' as station_name, {pick(PART_REGION, 'p_size % 12')} as region,
        p_brand as dispatch_type,
        {pick([f for f, _ in DESCRIPTORS], 'p_partkey % 21')} as fuel_source,
        {pick([t for _, t in DESCRIPTORS], 'p_partkey % 21')} as technology,
        case when p_size % 10 = 0 then '' when p_size % 10 = 1 then 'n/a'
             else cast(p_retailprice as varchar) end as reg_cap_mw from part"""),
    "unit_seed": (("registry",), f"""select * exclude (ordinal, rn) from (
        select ordinal, trim(duid) as duid, trim(coalesce(station_name, '')) as station_name,
        trim(coalesce(region, '')) as region, trim(coalesce(dispatch_type, '')) as dispatch_type,
        trim(coalesce(fuel_source, '')) as fuel_source,
        trim(coalesce(technology, '')) as technology,
        {classify('fuel_source', 'technology')} as fueltech,
        coalesce(reg_cap_mw, '') as reg_cap_mw,
        row_number() over (partition by trim(duid) order by ordinal desc) as rn
        from registry where trim(coalesce(duid, '')) <> '') where rn = 1"""),
    "dim_duid": (("unit_seed",), f"""select duid, station_name, region, dispatch_type, fueltech,
        try_cast(reg_cap_mw as double) as reg_cap_mw from unit_seed
        where region in {IN_REGIONS}"""),
    "scada": ((), f"""select {SCADA_TS} as settlement_date, 'U' || cast(l_suppkey as varchar)
        as duid, case when l_tax <> 0.08 then l_quantity - 10 end as scada_mw,
        strftime(l_shipdate, '%Y%m') as source_month from lineitem"""),
    "stg_scada": (("scada",), """select settlement_date, duid, scada_mw, source_month from scada
        where scada_mw is not null and settlement_date <
            date_trunc('month', (select max(settlement_date) from scada))"""),
    "generation": (("stg_scada", "dim_duid"), """select d.region, d.fueltech,
        time_bucket(interval '30 minutes', s.settlement_date) as interval_start,
        sum(greatest(s.scada_mw, 0)) * (5.0::double / 60.0::double) as generation_mwh,
        sum(greatest(s.scada_mw, 0)) * (5.0::double / 60.0::double) * 2.0::double
            as generation_avg_mw
        from stg_scada s join dim_duid d on s.duid = d.duid group by 1, 2, 3"""),
    "generation_daily": (("generation",), """select region, fueltech,
        cast(interval_start as date) as settlement_day, sum(generation_mwh) as generation_mwh
        from generation group by 1, 2, 3"""),
    "energy_daily": (("generation_daily", "dim_fueltech"), f"""select region, settlement_day,
        {r('sum(generation_mwh)', 1)} as total_generation_mwh,
        {r('sum(case when is_renewable then generation_mwh else 0 end)', 1)} as renewable_mwh,
        {r("100.0::double * sum(case when is_renewable then generation_mwh else 0 end) / "
           "nullif(sum(generation_mwh), 0)", 2)} as renewable_share_pct,
        {r('sum(generation_mwh * emission_factor_t_co2_per_mwh)', 1)} as est_emissions_tco2,
        {r("1000.0::double * sum(generation_mwh * emission_factor_t_co2_per_mwh) / "
           "nullif(sum(generation_mwh), 0)", 1)} as est_carbon_intensity_kg_per_mwh
        from generation_daily join dim_fueltech using (fueltech) group by 1, 2"""),
    "energy_named": (("energy_daily", "dim_region"), """select e.*, g.region_name
        from energy_daily e join dim_region g on e.region = g.region_id"""),
    "generation_named": (("generation_daily", "dim_fueltech", "dim_region"), """select g.region,
        n.region_name, g.settlement_day, g.fueltech, f.fueltech_label, f.fuel_group,
        f.is_renewable, g.generation_mwh from generation_daily g
        join dim_fueltech f using (fueltech) join dim_region n on g.region = n.region_id"""),
    "history": ((), f"""select {pick(MARKET_REGIONS, 'l_suppkey % 5')} as region,
        cast(l_shipdate as date) as settlement_day, count(*) as interval_count,
        {r('avg(l_quantity)', 2)} as avg_rrp, sum(l_quantity) as avg_demand_mw
        from lineitem group by 1, 2"""),
    "series": (("history",), """select region as unique_id, settlement_day as ds,
        avg_demand_mw as y from history where interval_count >= 2"""),
    "filled": (("series",), """select unique_id, cast(unnest(generate_series(ds, coalesce(nxt -
        1, ds), interval 1 day)) as date) as ds, y from (select *, lead(ds) over
        (partition by unique_id order by ds) as nxt from series)"""),
    "origins": (("series",), """select unique_id, last - cast(7 * b as int) as cutoff
        from (select unique_id, max(ds) as last from series group by 1), range(1, 7) t(b)"""),
    "targets": (("origins",), """select unique_id, cutoff, cast(h as int) as step,
        cutoff + cast(h as int) as ds, cutoff + cast(h as int) - 7 as src
        from origins, range(1, 8) t(h)"""),
    "naive_bt": (("targets", "filled", "series"), """select o.unique_id, o.cutoff, o.step, o.ds,
        f.y as y_hat, s.y from targets o
        join filled f on f.unique_id = o.unique_id and f.ds = o.src
        join series s on s.unique_id = o.unique_id and s.ds = o.ds"""),
    "anomalies": (("history",), f"""select region, settlement_day, {r('y', 2)} as avg_rrp,
        {r('expected', 2)} as expected_rrp, {r('expected + q[1]', 2)} as lower_bound,
        {r('expected + q[2]', 2)} as upper_bound,
        y < expected + q[1] or y > expected + q[2] as is_anomaly,
        {r('(y - expected) / nullif(sd, 0)', 2)} as distance from (
          select s.*, coalesce(p.m, o.m) as expected, d.q, d.sd from (
            select region, settlement_day, avg_rrp as y, month(settlement_day) as mo,
              dayofweek(settlement_day) in (0, 6) as we from history
            where settlement_day > date '1999-12-31') s
          join (select h.region, quantile_cont(avg_rrp - m, [0.005, 0.995]) as q,
              stddev_samp(avg_rrp - m) as sd from history h join (
                select region, month(settlement_day) as mo,
                  dayofweek(settlement_day) in (0, 6) as we, avg(avg_rrp) as m from history
                where settlement_day <= date '1999-12-31' group by 1, 2, 3) p
              on h.region = p.region and month(settlement_day) = p.mo
                and (dayofweek(settlement_day) in (0, 6)) = p.we
              where settlement_day <= date '1999-12-31' group by 1) d on s.region = d.region
          join (select region, avg(avg_rrp) as m from history
              where settlement_day <= date '1999-12-31' group by 1) o on s.region = o.region
          left join (select region, month(settlement_day) as mo,
                dayofweek(settlement_day) in (0, 6) as we, avg(avg_rrp) as m from history
              where settlement_day <= date '1999-12-31' group by 1, 2, 3) p
            on s.region = p.region and s.mo = p.mo and s.we = p.we)"""),
    "anomalies_mart": (("anomalies",), """select *, avg_rrp - expected_rrp as surprise_aud_mwh
        from anomalies"""),
    "holdout": (("series",), """select * from series
        where ds > (select max(ds) - 7 from series)"""),
    "train": (("series",), """select * from series
        where ds <= (select max(ds) - 7 from series)"""),
    "filled_train": (("train",), """select unique_id, cast(unnest(generate_series(ds,
        coalesce(nxt - 1, ds), interval 1 day)) as date) as ds, y from (select *, lead(ds) over
        (partition by unique_id order by ds) as nxt from train)"""),
    "external": (("history",), """select 'Hosted' as engine, 'DayBefore' as model, region,
        settlement_day + 1 as ds, avg_demand_mw as pred from history"""),
    "naive_bench": (("filled_train",), """select 'Python' as engine, 'SeasonalNaive' as model,
        f.unique_id as region, l.last + 7 - cast(l.last - f.ds as int) as ds, f.y as pred
        from filled_train f join (select unique_id, max(ds) as last from filled_train group by 1) l
        on f.unique_id = l.unique_id and f.ds > l.last - 7"""),
    "bench_scores": (("holdout", "external", "naive_bench"), f"""select region, engine, model,
        {r('avg(abs(y - pred))', 1)} as mae, {r('sqrt(avg((y - pred) * (y - pred)))', 1)} as rmse,
        {r('avg(abs(y - pred) / nullif(y, 0) * 100.0::double)', 2)} as mape,
        (select max(ds) - 6 from holdout) as holdout_start,
        (select max(ds) from holdout) as holdout_end
        from (select h.unique_id as region, p.engine, p.model, h.y, p.pred from holdout h
          join (select * from external union all by name select * from naive_bench) p
          on h.unique_id = p.region and h.ds = p.ds) group by 1, 2, 3"""),
    "accuracy": (("naive_bt",), f"""select unique_id as region, 'SeasonalNaive' as model,
        {r('avg(abs(y - y_hat))', 1)} as mae,
        {r('sqrt(avg((y - y_hat) * (y - y_hat)))', 1)} as rmse,
        {r('avg(abs(y - y_hat) / nullif(y, 0) * 100.0::double)', 2)} as mape,
        6::int as n_windows, 7::int as horizon from naive_bt group by 1"""),
    "spread": (("filled",), """select unique_id, sqrt(avg((y - l) * (y - l))) as sigma from
        (select *, lag(y, 7) over (partition by unique_id order by ds) as l from filled)
        group by 1"""),
    "naive_fc": (("filled", "spread"), """select f.unique_id as region,
        last + 7 - cast(last - f.ds as int) as forecast_date, f.y as predicted_demand_mw,
        f.y - 1.6448536269514722::double * sigma as lo_90,
        f.y + 1.6448536269514722::double * sigma as hi_90, 'SeasonalNaive' as model
        from filled f join (select unique_id, max(ds) as last from filled group by 1) m
          on f.unique_id = m.unique_id and f.ds > last - 7
        join spread s on f.unique_id = s.unique_id"""),
    "fc_mart": (("naive_fc",), f"""select region, model, forecast_date,
        {r('predicted_demand_mw', 1)} as predicted_demand_mw, {r('lo_90', 1)} as lo_90,
        {r('hi_90', 1)} as hi_90 from naive_fc"""),
    "fc_named": (("fc_mart", "dim_region"), """select f.*, g.region_name from fc_mart f
        join dim_region g on f.region = g.region_id"""),
}


# the fitted models at the origins of the backtest, at the end, and at the end of the training part
_Z = "1.6448536269514722::double"
_SCORES = f"""{r('avg(abs(y - y_hat))', 1)} as mae, {r('sqrt(avg((y - y_hat) * (y - y_hat)))', 1)} as rmse,
    {r('avg(abs(y - y_hat) / nullif(y, 0) * 100.0::double)', 2)} as mape"""
for _stops, _filled in (("origins", "filled"), ("last_day", "filled"), ("last_train_day", "filled_train")):
    CTES.update(oracle_series.smoothing(f"ets_{_stops}", _filled, _stops))
    CTES.update(oracle_series.decomposition(f"mstl_{_stops}", _filled, _stops))
CTES.update(oracle_series.smoothing("ets_whole_origins", "filled", "origins", whole=True))
CTES.update({
    "last_day": (("filled",), "select unique_id, max(ds) as cutoff from filled group by 1"),
    "last_train_day": (("filled_train",), "select unique_id, max(ds) as cutoff from filled_train group by 1"),
})
for _pre, _model in (("ets", "AutoETS"), ("ets_whole", "AutoETS"), ("mstl", "MSTL")):
    CTES.update({
        f"{_pre}_bt": ((f"{_pre}_origins", "series"), f"""select b.unique_id, '{_model}' as model,
            b.cutoff, b.ds, b.y_hat, s.y from {_pre}_origins b
            join series s on s.unique_id = b.unique_id and s.ds = b.ds"""),
        f"{_pre}_accuracy": ((f"{_pre}_bt",), f"""select unique_id as region, model, {_SCORES},
            6::int as n_windows, 7::int as horizon from {_pre}_bt group by 1, 2"""),
    })
for _pre, _model in (("ets", "AutoETS"), ("mstl", "MSTL")):
    CTES.update({
        f"{_pre}_fc": ((f"{_pre}_last_day",), f"""select unique_id as region, ds as forecast_date,
            y_hat as predicted_demand_mw, y_hat - {_Z} * error as lo_90, y_hat + {_Z} * error as hi_90,
            '{_model}' as model from {_pre}_last_day"""),
        f"{_pre}_bench": ((f"{_pre}_last_train_day",), f"""select 'Python' as engine, '{_model}' as model,
            unique_id as region, ds, y_hat as pred from {_pre}_last_train_day"""),
    })


def sql(body: str, *names: str) -> str:
    """``body`` with the CTEs it needs, dependencies first."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for dep in CTES[name][0]:
                visit(dep)
            order.append(name)

    for n in names:
        visit(n)
    if not order:
        return body
    head = ",\n".join(f"{n} as ({CTES[n][1]})" for n in order)
    return f"with {'recursive ' if any(f'from {n} r join' in CTES[n][1] for n in order) else ''}{head}\n{body}"
