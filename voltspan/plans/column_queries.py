"""Projections, filters and scalar functions (inventory C and D)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from voltspan.functions import scalars as X
from voltspan.functions.dates import look_back
from voltspan.operators import anomalies, staging
from voltspan.plans.oracle import EVENT_CASE, SCADA_TS, classify, r, sql, staged_price
from voltspan.plans.registry import ANOMALY_TRAIN_END, q6, query

MID = "2024-01-15 00:00:00"


@query("c1_rename", sql("""select event_type as region_code, ts as settlement_date,
    value as rrp_aud_mwh, user_id as unit_id from events"""))
def _(t):
    return t.table("events").select(
        F.col("event_type").alias("region_code"), F.col("ts").alias("settlement_date"),
        F.col("value").alias("rrp_aud_mwh"), F.col("user_id").alias("unit_id"),
    )


@query("c2_settlement_era", sql(
    f"select region, settlement_date, resolution_min from ({staged_price(f'''timestamp '{MID}' ''')})",
    "price_demand"))
def _(t):
    return staging.stg_price_demand(t.raw_price, MID).select(
        "region", "settlement_date", "resolution_min"
    )


@query("c3_negative_flag", sql("select price_demand_id, is_negative_price from fct_price",
                               "fct_price"))
def _(t):
    return t.fct_price.select("price_demand_id", "is_negative_price")


@query("c4_not_null", sql("""select source_month, count(*) as n from scada
    where scada_mw is not null group by 1""", "scada"))
def _(t):
    return t.raw_scada.filter(F.col("scada_mw").isNotNull()).groupBy("source_month").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("c5_month_trim", sql("""select source_month, count(*) as n, max(settlement_date) as last_ts
    from stg_scada group by 1""", "stg_scada"))
def _(t):
    return t.stg_scada.groupBy("source_month").agg(
        F.count(F.lit(1)).alias("n"), F.max("settlement_date").alias("last_ts")
    )


@query("c6_region_list", sql("select duid, region, reg_cap_mw from dim_duid", "dim_duid"))
def _(t):
    return t.dim_duid.select("duid", "region", "reg_cap_mw")


@query("c7_partial_day_guard", sql("""select region, settlement_day, interval_count
    from region_daily where interval_count >= 60""", "region_daily"))
def _(t):
    return t.region_totals.filter(F.col("interval_count") >= 60).select(
        "region", "settlement_day", "interval_count"
    )


@query("c8_positive_readings", sql("""select duid, count(*) as n, sum(scada_mw) as mw from scada
    where scada_mw > 0 group by 1""", "scada"))
def _(t):
    return t.raw_scada.filter(F.col("scada_mw") > 0).groupBy("duid").agg(
        F.count(F.lit(1)).alias("n"), F.sum("scada_mw").alias("mw")
    )


@query("c9_look_back", sql("""select region, settlement_day, avg_demand_mw from history
    where settlement_day >= (select max(settlement_day) - interval '30 days' from history)""",
    "history"))
def _(t):
    return look_back(t.history, "settlement_day", 30).select(
        "region", "settlement_day", "avg_demand_mw"
    )


@query("c10_train_score_split", sql(f"""select settlement_day > date '{ANOMALY_TRAIN_END}' as
    scored, region, count(*) as n, min(settlement_day) as first_day, max(settlement_day) as
    last_day from history group by 1, 2""", "history"))
def _(t):
    train, score = anomalies.split_at(t.history, ANOMALY_TRAIN_END)
    both = train.withColumn("scored", F.lit(False)).unionByName(
        score.withColumn("scored", F.lit(True))
    )
    return both.groupBy("scored", "region").agg(
        F.count(F.lit(1)).alias("n"), F.min("settlement_day").alias("first_day"),
        F.max("settlement_day").alias("last_day"),
    )


@query("c11_parameter_filter", sql("""select settlement_day, avg_rrp from region_daily_named
    where region_name = 'South Australia'""", "region_daily_named"))
def _(t):
    t.region_totals_named.createOrReplaceTempView("voltspan_region_daily")
    return t.spark.sql(
        "select settlement_day, avg_rrp from voltspan_region_daily where region_name = :region",
        args={"region": "South Australia"},
    )


@query("c12_blank_key", sql("""select trim(duid) as duid, count(*) as n from registry
    where trim(coalesce(duid, '')) <> '' group by 1""", "registry"))
def _(t):
    key = X.clean_text("DUID")
    return t.registry.filter(F.length(key) > 0).groupBy(key.alias("duid")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query("c13_constant_tag", sql("select region, ds, engine, model from external", "external"))
def _(t):
    return t.external.select("region", "ds", "engine", "model")


@query("c14_all_columns_plus_label", sql("select * from region_daily_named", "region_daily_named"))
def _(t):
    return t.region_daily_named


# ------------------------------------------------------------------------ functions
@query("d1_settlement_day", sql("select event_id, cast(ts as date) as day from events"))
def _(t):
    return t.table("events").select("event_id", X.settlement_day("ts").alias("day"))


@query("d2_strict_casts", sql("""select p_partkey, cast(cast(p_retailprice as varchar) as double)
    as price, cast(case when p_size > 25 then 'true' else 'false' end as boolean) as big,
    cast('2024-01-' || lpad(cast(p_size % 28 + 1 as varchar), 2, '0') as date) as day
    from part"""))
def _(t):
    size = F.col("p_size")
    day = F.lpad((size % 28 + 1).cast("string"), 2, "0")
    return t.table("part").select(
        "p_partkey",
        F.col("p_retailprice").cast("string").cast("double").alias("price"),
        F.when(size > 25, "true").otherwise("false").cast("boolean").alias("big"),
        F.concat(F.lit("2024-01-"), day).cast("date").alias("day"),
    )


@query("d3_tolerant_cast", sql("""select ordinal, try_cast(reg_cap_mw as double) as cap
    from registry""", "registry"))
def _(t):
    return t.registry.select(
        "ordinal", F.col("`Reg Cap generation (MW)`").try_cast("double").alias("cap")
    )


_LINE = "l_orderkey, l_linenumber"


@query("d4_clamp", sql(f"""select {_LINE}, greatest(case when l_tax <> 0.08 then l_quantity - 10
    end, 0) as mw from lineitem"""))
def _(t):
    mw = F.when(F.col("l_tax") != 0.08, F.col("l_quantity") - F.lit(10.0))
    return t.table("lineitem").select("l_orderkey", "l_linenumber", X.positive_part(mw).alias("mw"))


@query("d5_power_to_energy", sql(f"""select {_LINE}, round(l_quantity * (5.0::double /
    60.0::double), 6) as mwh, round(l_quantity * (5.0::double / 60.0::double) * 2.0::double, 6)
    as avg_mw from lineitem"""))
def _(t):
    df = t.table("lineitem").select(
        "l_orderkey", "l_linenumber", X.mwh_from_mw("l_quantity").alias("mwh"),
        (X.mwh_from_mw("l_quantity") * F.lit(2.0)).alias("avg_mw"),
    )
    return q6(df, "mwh", "avg_mw")


@query("d6_half_hour", sql("""select event_id, time_bucket(interval '30 minutes', ts) as bucket
    from events"""))
def _(t):
    return t.table("events").select("event_id", X.half_hour("ts").alias("bucket"))


@query("d7_month", sql(f"""select {_LINE}, cast(date_trunc('month', l_shipdate) as date) as month
    from lineitem"""))
def _(t):
    return t.table("lineitem").select(
        "l_orderkey", "l_linenumber", X.month_of(F.to_date("l_shipdate")).alias("month")
    )


@query("d8_day_of_stamp", sql(f"select {_LINE}, cast({SCADA_TS} as date) as ds from lineitem"))
def _(t):
    slot = ((F.lit(7) * F.col("l_orderkey") + F.col("l_linenumber")) % 288 * 5).cast("int")
    stamp = F.col("l_shipdate") + F.make_dt_interval(mins=slot)
    return t.table("lineitem").select("l_orderkey", "l_linenumber", F.to_date(stamp).alias("ds"))


@query("d9_date_shift", sql("""select o_orderkey, cast(cast(o_orderdate as date) - interval
    '30 days' as date) as back, cast(cast(o_orderdate as date) + interval '1 day' as date) as
    ahead from orders"""))
def _(t):
    day = F.to_date("o_orderdate")
    return t.table("orders").select(
        "o_orderkey", F.date_sub(day, 30).alias("back"), F.date_add(day, 1).alias("ahead")
    )


@query("d10_stamp_text", sql("""select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as txt
    from events"""))
def _(t):
    return t.table("events").select("event_id", X.stamp_text("ts").alias("txt"))


@query("d11_day_to_stamp", sql("""select o_orderkey, cast(cast(o_orderdate as date) as timestamp)
    as ts from orders"""))
def _(t):
    return t.table("orders").select(
        "o_orderkey", F.to_date("o_orderdate").cast("timestamp_ntz").alias("ts")
    )


@query("d12_round", sql("""select l_orderkey, l_linenumber, round(l_extendedprice / 7.0::double,
    1) as r1, round(l_extendedprice * l_discount, 2) as r2, round(5.0::double - l_quantity /
    4.0::double, 0) as r0 from lineitem"""))
def _(t):
    return t.table("lineitem").select(
        "l_orderkey", "l_linenumber",
        X.round_half_away("l_extendedprice / 7d", 1).alias("r1"),
        X.round_half_away("l_extendedprice * l_discount", 2).alias("r2"),
        X.round_half_away("5d - l_quantity / 4d", 0).alias("r0"),
    )


@query("d13_safe_division", sql("""select l_orderkey, l_linenumber, round(l_quantity /
    nullif(l_discount, 0), 6) as ratio from lineitem"""))
def _(t):
    ratio = X.safe_ratio(F.col("l_quantity"), F.col("l_discount"))
    return q6(t.table("lineitem").select("l_orderkey", "l_linenumber", ratio.alias("ratio")),
              "ratio")


@query("d14_default_label", sql("""select ordinal, coalesce(technology, 'UNMAPPED') as label
    from registry""", "registry"))
def _(t):
    label = F.coalesce("`Technology Type - Descriptor`", F.lit("UNMAPPED"))
    return t.registry.select("ordinal", label.alias("label"))


_PART = "_dbt_utils_surrogate_key_null_"


@query("d15_surrogate_key", sql(f"""select event_id, md5(coalesce(case when event_type <> 'view'
    then event_type end, '{_PART}') || '-' || coalesce(cast(ts as varchar), '{_PART}')) as key
    from events"""))
def _(t):
    kind = F.when(F.col("event_type") != "view", F.col("event_type"))
    return t.table("events").select("event_id", X.surrogate_key(kind, "ts").alias("key"))


@query("d16_lower_contains", sql("""select ordinal, lower(technology) as low,
    contains(lower(technology), 'steam') as steam from registry""", "registry"))
def _(t):
    low = F.lower("`Technology Type - Descriptor`")
    return t.registry.select(
        "ordinal", low.alias("low"), F.contains(low, F.lit("steam")).alias("steam")
    )


@query("d17_trim", sql("""select ordinal, trim(coalesce(duid, '')) as duid,
    trim(coalesce(station_name, '')) as station from registry""", "registry"))
def _(t):
    return t.registry.select(
        "ordinal", X.clean_text("DUID").alias("duid"),
        X.clean_text("`Station Name`").alias("station"),
    )


@query("d18_classify_fueltech", sql(f"""select ordinal, {classify('fuel_source', 'technology')}
    as fueltech from registry""", "registry"))
def _(t):
    return t.registry.select(
        "ordinal",
        X.classify_fueltech(
            "`Fuel Source - Descriptor`", "`Technology Type - Descriptor`"
        ).alias("fueltech"),
    )


@query("d19_unquote", sql(f"select event_id, {EVENT_CASE} as region from events"))
def _(t):
    from voltspan.sources.adapters import event_region

    quoted = F.concat(F.lit('"'), event_region(), F.lit('"'))
    return t.table("events").select("event_id", X.unquote(quoted).alias("region"))


@query("d20_error_terms", sql("""select l_orderkey, l_linenumber, abs(l_quantity - l_linenumber)
    as ae, (l_quantity - l_linenumber) * (l_quantity - l_linenumber) as se,
    round(sqrt(l_quantity), 6) as root,
    round(abs(l_quantity - l_linenumber) / nullif(l_quantity, 0) * 100.0::double, 6) as ape
    from lineitem"""))
def _(t):
    y, p = F.col("l_quantity"), F.col("l_linenumber")
    return q6(
        t.table("lineitem").select(
            "l_orderkey", "l_linenumber", F.abs(y - p).alias("ae"),
            X.squared_error(y, p).alias("se"), F.sqrt(y).alias("root"),
            X.percent_error(y, p).alias("ape"),
        ),
        "root", "ape",
    )


@query("d21_surprise", sql(f"""select region, settlement_day, {r('surprise_aud_mwh', 2)} as
    surprise_aud_mwh from anomalies_mart""", "anomalies_mart"))
def _(t):
    return t.price_anomalies.select(
        "region", "settlement_day", X.settle("surprise_aud_mwh", 2).alias("surprise_aud_mwh")
    )


@query("d22_generated_at", sql("""select region, forecast_date, true as stamped_in_run
    from naive_fc""", "naive_fc"))
def _(t):
    """The stamp of a run lies after the query was made, on the UTC clock."""
    made = dt.datetime.now(dt.UTC).replace(tzinfo=None)
    stamp = F.col("generated_at")
    in_run = (stamp >= F.lit(made)) & (stamp < F.lit(made + dt.timedelta(hours=6)))
    return t.naive_forecast.select("region", "forecast_date", in_run.alias("stamped_in_run"))


@query("d23_upper_names", sql("""select region as "REGION", settlement_day as "SETTLEMENT_DAY",
    avg_rrp as "AVG_RRP" from region_daily""", "region_daily"))
def _(t):
    df = t.region_totals.select("region", "settlement_day", "avg_rrp")
    return df.toDF(*[c.upper() for c in df.columns])


@query("d24_regexp_extract", sql(r"""select source_file, regexp_extract(source_file,
    'PRICE_AND_DEMAND_(\d{6})_', 1) as month, regexp_extract(source_file,
    'DISPATCH_(\d{6})', 1) as none, regexp_matches(source_file, '(?i)demand.*\.CSV') as hit
    from price_demand""", "price_demand"))
def _(t):
    f = F.col("source_file")
    return t.raw_price.select(
        f, F.regexp_extract(f, r"PRICE_AND_DEMAND_(\d{6})_", 1).alias("month"),
        F.regexp_extract(f, r"DISPATCH_(\d{6})", 1).alias("none"),
        f.rlike(r"(?i)demand.*\.CSV").alias("hit"),
    )


