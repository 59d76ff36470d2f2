"""Data-quality checks, on clean marts and on tables with real faults (inventory K)."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltspan.operators import marts, quality
from voltspan.plans.oracle import IN_REGIONS, sql
from voltspan.plans.registry import query
from voltspan.session import stage
from voltspan.sources import reference


@query("k1_not_null", sql("""select count(*) as n_rows from scada where scada_mw is null
    having count(*) > 0""", "scada"))
def _(t):
    return quality.not_null(t.raw_scada, "scada_mw")


@query("k2_unique", sql("""select "DUID", count(*) as n_rows from (select duid as "DUID" from
    registry) where "DUID" is not null group by 1 having count(*) > 1""", "registry"))
def _(t):
    return quality.unique(t.registry, "DUID")


@query("k3_accepted_values", sql(f"""select region, count(*) as n_rows from registry
    where region not in {IN_REGIONS} group by 1""", "registry"))
def _(t):
    from voltspan.functions.scalars import MARKET_REGIONS

    rows = t.registry.withColumnRenamed("Region", "region")
    return quality.accepted_values(rows, "region", MARKET_REGIONS)


@query("k4_relationships", sql("""select duid, count(*) as n_rows from scada where duid is not
    null and duid not in (select duid from dim_duid) group by 1""", "scada", "dim_duid"))
def _(t):
    return quality.relationships(t.raw_scada, "duid", t.dim_duid, "duid")


@query("k5_unique_combination", sql("""select duid, settlement_date, count(*) as n_rows from scada
    group by 1, 2 having count(*) > 1""", "scada"))
def _(t):
    return quality.unique_combination(t.raw_scada, ["duid", "settlement_date"])


@query("k6_accepted_range", sql("""select rrp_aud_mwh, count(*) as n_rows from fct_price
    where rrp_aud_mwh < 0 or rrp_aud_mwh > 200 group by 1""", "fct_price"))
def _(t):
    return quality.accepted_range(t.fct_price, "rrp_aud_mwh", 0, 200)


def built_tables(t):
    """Every table the standard checks read; model results are stored first, as in the batch build."""
    return {
        "seed_region": reference.region_seed(t.spark),
        "seed_fueltech": reference.fueltech_seed(t.spark),
        "seed_duid_fueltech": t.unit_seed,
        "stg_price_demand": t.stg_price, "stg_dispatch_scada": t.stg_scada,
        "dim_region": t.dim_region, "dim_fueltech": t.dim_fueltech, "dim_duid": t.dim_duid,
        "fct_price_demand": t.fct_price, "fct_region_daily": t.region_daily_stored,
        "fct_generation": t.generation_half_hour_stored,
        "fct_generation_daily": t.generation_stored,
        "fct_region_energy_daily": t.energy_stored,
        "fct_demand_forecast": stage(t.forecast_mart, "forecast"),
        "fct_forecast_accuracy": stage(t.accuracy, "accuracy"),
        "fct_engine_benchmark": stage(t.benchmark, "benchmark"),
        "fct_price_anomalies": stage(t.price_anomalies, "anomalies"),
    }


# The 68 checks once more, written out apart from the operator's list: table, the SQL of its rows, and
# per line a kind with columns. "values" and "range" give the condition of a good value.
SUMMARY = {
    ("seed_region", "dim_region"): ["not_null region_id", "unique region_id"],
    ("seed_fueltech", "fuel_seed"): ["not_null fueltech", "unique fueltech"],
    ("seed_duid_fueltech", "unit_seed"): ["not_null duid", "unique duid"],
    ("stg_price_demand", "stg_price"): [
        "not_null region settlement_date rrp_aud_mwh total_demand_mw",
        f"values region: in {IN_REGIONS}", "values resolution_min: in (5, 30)",
        "combination region settlement_date"],
    ("stg_dispatch_scada", "stg_scada"): ["not_null duid settlement_date"],
    ("dim_region", "dim_region"): ["not_null region_id", "unique region_id"],
    ("dim_fueltech", "dim_fueltech"): ["not_null fueltech is_renewable", "unique fueltech"],
    ("dim_duid", "dim_duid"): [
        "not_null duid region fueltech", "unique duid",
        "relationship region dim_region region_id", "relationship fueltech dim_fueltech fueltech"],
    ("fct_price_demand", "fct_price"): [
        "not_null price_demand_id region settlement_date rrp_aud_mwh", "unique price_demand_id",
        "relationship region dim_region region_id", "range rrp_aud_mwh: between -1000 and 40000"],
    ("fct_region_daily", "region_daily"): [
        "not_null region settlement_day", "relationship region dim_region region_id",
        "combination region settlement_day"],
    ("fct_generation", "generation"): [
        "not_null region fueltech interval_start", "relationship region dim_region region_id",
        "relationship fueltech dim_fueltech fueltech", "combination region fueltech interval_start"],
    ("fct_generation_daily", "generation_daily"): ["combination region fueltech settlement_day"],
    ("fct_region_energy_daily", "energy_daily"): [
        "not_null region", "relationship region dim_region region_id",
        "range renewable_share_pct: between 0 and 100", "combination region settlement_day"],
    ("fct_demand_forecast", "fc_mart"): [
        "not_null region forecast_date predicted_demand_mw",
        "relationship region dim_region region_id",
        "values model: in ('SeasonalNaive', 'AutoETS', 'MSTL')",
        "combination region model forecast_date"],
    ("fct_engine_benchmark", "bench_scores"): [
        "not_null region", "relationship region dim_region region_id",
        "values engine: in ('Snowflake ML', 'Python')", "range mape: between 0 and 100",
        "combination region model"],
    ("fct_price_anomalies", "anomalies_mart"): [
        "not_null region settlement_day is_anomaly", "relationship region dim_region region_id",
        "combination region settlement_day"],
    ("fct_forecast_accuracy", "accuracy"): [
        "not_null region", "relationship region dim_region region_id",
        "range mape: between 0 and 100", "combination region model"],
}


def _counted(source: str, line: str) -> list[tuple[str, str]]:
    """(check name, SQL for its number of failing rows) of one line of the summary."""
    kind, rest = line.split(" ", 1)
    repeats = "select coalesce(sum(n), 0) from (select count(*) as n from {} group by {} having count(*) > 1)"
    if kind == "not_null":
        return [(f"not_null_{c}", f"select count(*) from {source} where {c} is null") for c in rest.split()]
    if kind == "unique":
        known = f"(select * from {source} where {rest} is not null)"
        return [(f"unique_{rest}", repeats.format(known, rest))]
    if kind == "combination":
        cols = rest.split()
        return [("unique_" + "_".join(cols), repeats.format(source, ", ".join(cols)))]
    if kind == "relationship":
        col, parent, key = rest.split()
        return [(f"relationships_{col}_{parent}", f"select count(*) from {source} where {col} is not null "
                 f"and {col} not in (select {key} from {parent})")]
    col, good = rest.split(": ")
    return [(f"accepted_{kind}_{col}", f"select count(*) from {source} where not ({col} {good})")]


def _summary_sql() -> str:
    parts = [
        f"select '{table}' as table_name, '{name}' as check_name, cast(({count}) as bigint) as failures"
        for (table, source), lines in SUMMARY.items()
        for line in lines
        for name, count in _counted(source, line)
    ]
    return sql("\nunion all ".join(parts), *[source for _, source in SUMMARY])


@query("k7_check_summary", _summary_sql())
def _(t):
    return quality.run_checks(quality.standard_checks(), built_tables(t))


@query("k8_build_difference", sql("""select * from (
    (select region, settlement_day, interval_count, 'left' as side from region_daily
     except all select region, settlement_day, count(*), 'left' from fct_price
     where not is_negative_price group by 1, 2)
    union all
    (select region, settlement_day, count(*) as interval_count, 'right' as side from fct_price
     where not is_negative_price group by 1, 2
     except all select region, settlement_day, interval_count, 'right' from region_daily))""",
    "region_daily", "fct_price"))
def _(t):
    """Two builds of one count that differ on days with negative prices."""
    left = t.region_totals.select("region", "settlement_day", "interval_count")
    right = t.fct_price.filter(~F.col("is_negative_price")).groupBy(*marts.REGION_DAY).agg(
        F.count(F.lit(1)).alias("interval_count")
    )
    month = {"month": F.date_trunc("month", "settlement_day")}
    day = {c: F.col(c) for c in marts.REGION_DAY}
    return quality.mart_difference(stage(left, "left-build"), stage(right, "right-build"), [month, day])
