"""Sources, landing reports and sinks (inventory A and B)."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from functools import wraps

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltspan.functions import scalars as X
from voltspan.functions.dates import lagged_months, recent_months
from voltspan.operators import marts, series, summaries
from voltspan.plans.oracle import r, sql
from voltspan.plans.registry import SERIES_MIN_INTERVALS, Tables, query
from voltspan.session import folder_state, fresh_path
from voltspan.sinks import tables as sinks
from voltspan.sources import coverage, landing, reference, schemas


def texts_by_file(df: DataFrame, texts: list[Column]) -> DataFrame:
    """``texts`` of the rows and their ``landing`` file name, in its order within each task.

    The typed rows are sorted, not the text: they are what a sort holds or spills.
    """
    return df.sortWithinPartitions("landing").select(*texts, "landing")


def _write_by_file(rows: DataFrame, fmt: str, name: str, **options) -> str:
    """Write rows of ``texts_by_file`` below one folder per ``landing`` file name. Every task writes
    what it reads: nothing is shuffled, and a file with most of the rows is written by many tasks."""
    path = fresh_path(rows.sparkSession, name)
    rows.write.partitionBy("landing").options(**options).format(fmt).save(path)
    return path


def landed(write):
    """The files of a data folder are written once per session and state of the folder."""
    paths: dict[tuple, str] = {}

    @wraps(write)
    def once(t: Tables) -> str:
        key = (t.spark.sparkContext.applicationId, t.sf_dir, folder_state(t.spark, t.sf_dir))
        if key not in paths:
            paths[key] = write(t)
        return paths[key]

    return once


@landed
def land_price_files(t: Tables) -> str:
    rows = t.raw_price.withColumnRenamed("source_file", "landing").drop("source_month")
    texts = [
        F.col("region").alias("REGION"),
        F.date_format("settlement_date", "yyyy/MM/dd HH:mm:ss").alias("SETTLEMENTDATE"),
        F.col("total_demand_mw").alias("TOTALDEMAND"),
        F.col("rrp_aud_mwh").alias("RRP"),
        F.col("period_type").alias("PERIODTYPE"),
    ]
    return _write_by_file(texts_by_file(rows, texts), "csv", "price-files", header="true")


def record_text() -> Column:
    """The lines of a reading: a data record, for some also one of another kind or a short comment."""
    stamp = F.date_format("settlement_date", "yyyy/MM/dd HH:mm:ss")
    value = F.coalesce(F.col("scada_mw").cast("string"), F.lit("n/a"))
    record = F.concat(
        F.lit('D,DISPATCH,UNIT_SCADA,1,"'), stamp, F.lit('",'), F.col("duid"), F.lit(","), value,
        F.lit(',"'), stamp, F.lit('"'),
    )
    comment = F.concat(F.lit("C,"), F.col("duid"))
    other = F.concat(F.lit("I,DISPATCH,UNIT_SCADA,1,"), F.col("duid"))
    return F.when(F.col("scada_mw") > 35, F.array(record, comment)).when(
        F.col("scada_mw") < 0, F.array(record, other)
    ).otherwise(F.array(record))


def record_rows(t: Tables) -> DataFrame:
    """The readings with the name of the file that their month lands in."""
    landing_name = F.concat(F.lit("DISPATCH_UNIT_SCADA_"), F.col("source_month"), F.lit(".csv"))
    return t.raw_scada.select(
        "settlement_date", "duid", "scada_mw", landing_name.alias("landing")
    )


def record_lines(t: Tables) -> DataFrame:
    """One row per line."""
    return record_rows(t).select(F.explode(record_text()).alias("value"), "landing")


@landed
def land_record_files(t: Tables) -> str:
    # the lines of a reading in one value: an explode would lose the order by file
    lines = F.array_join(record_text(), "\n", "").alias("value")
    return _write_by_file(texts_by_file(record_rows(t), [lines]), "text", "record-files")


def _zip_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The lines of one Arrow batch as one archive per month: bounded, whatever a month holds."""
    for batch in batches:
        out = []
        for name, rows in batch.groupby("landing"):
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr(name, "\n".join(rows["value"]) + "\n")
            out.append((name.replace(".csv", ".zip"), buffer.getvalue()))
        yield pd.DataFrame(out, columns=["path", "content"])


def scan_price_files(t: Tables) -> DataFrame:
    return landing.price_csv(t.spark, land_price_files(t))


@query("a1_price_csv_scan", sql("""select region, date_trunc('second', settlement_date) as
    settlement_date, total_demand_mw, rrp_aud_mwh, period_type from price_demand""",
    "price_demand"))
def _(t):
    return scan_price_files(t).select(
        "region", "settlement_date", "total_demand_mw", "rrp_aud_mwh", "period_type"
    )


@query("a2_file_provenance", sql("""select source_file as file, count(*) as n from price_demand
    group by 1""", "price_demand"))
def _(t):
    name = F.regexp_extract("source_file", r"(PRICE_AND_DEMAND_[^/]*\.csv)", 1)
    return scan_price_files(t).groupBy(name.alias("file")).agg(F.count(F.lit(1)).alias("n"))


@query("a3_strict_timestamp", sql("""select event_id, strptime(strftime(ts, '%Y/%m/%d %H:%M:%S'),
    '%Y/%m/%d %H:%M:%S') as settlement_date from events"""))
def _(t):
    text = F.date_format("ts", "yyyy/MM/dd HH:mm:ss")
    return t.table("events").select("event_id", X.strict_stamp(text).alias("settlement_date"))


@query("a4_load_month", sql("""select source_month, region, count(*) as n from price_demand
    group by 1, 2""", "price_demand"))
def _(t):
    return scan_price_files(t).groupBy("source_month", "region").agg(F.count(F.lit(1)).alias("n"))


@query("a5_ragged_record_scan", sql("""select rec, count(*) as n from (
    select 'D' as rec from scada union all select 'C' from scada where scada_mw > 35
    union all select 'I' from scada where scada_mw < 0) group by 1""", "scada"))
def _(t):
    records = landing.record_csv(t.spark, land_record_files(t))
    return records.groupBy(F.col("col0").alias("rec")).agg(F.count(F.lit(1)).alias("n"))


@query("a6_record_filter", sql("""select duid, count(*) as n, min(settlement_date) as first_ts
    from scada group by 1""", "scada"))
def _(t):
    return landing.scada_csv(t.spark, land_record_files(t)).groupBy("duid").agg(
        F.count(F.lit(1)).alias("n"), F.min("settlement_date").alias("first_ts")
    )


@query("a7_tolerant_number", sql("""select duid, count(scada_mw) as numbers,
    count(*) - count(scada_mw) as unreadable, sum(scada_mw) as total from scada group by 1""",
    "scada"))
def _(t):
    return landing.scada_csv(t.spark, land_record_files(t)).groupBy("duid").agg(
        F.count("scada_mw").alias("numbers"),
        F.count_if(F.col("scada_mw").isNull()).alias("unreadable"),
        F.sum("scada_mw").alias("total"),
    )


@query("a8_month_tag", sql("select source_month, count(*) as n from scada group by 1", "scada"))
def _(t):
    return summaries.rows_per_month(landing.scada_csv(t.spark, land_record_files(t)))


@query("a9_zip_archives", sql("""select source_month, duid, count(*) as n, sum(scada_mw) as total
    from scada group by 1, 2""", "scada"))
def _(t):
    archives = record_lines(t).mapInPandas(_zip_batch, "path string, content binary")
    return landing.readings_from_archives(archives).groupBy("source_month", "duid").agg(
        F.count(F.lit(1)).alias("n"), F.sum("scada_mw").alias("total")
    )


@query("a10_registry_scan", sql("""select ordinal, duid as "DUID", station_name as
    "Station Name", region as "Region", cast(null as varchar) as "Dispatch Type",
    fuel_source as "Fuel Source - Descriptor", technology as "Technology Type - Descriptor",
    reg_cap_mw as "Reg Cap generation (MW)" from registry""", "registry"))
def _(t):
    sheet = t.registry.drop("Dispatch Type")  # the sheet lacks one column
    path = fresh_path(t.spark, "registry")
    keep = {"header": "true", "nullValue": "\\N",
            "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    sheet.write.options(**keep).csv(path)
    return landing.registry_csv(t.spark, path, **keep)


@query("a11_dim_region", sql("select * from dim_region", "dim_region"))
def _(t):
    return t.dim_region


@query("a11_benchmark_seed", sql("select * from bench_scores", "bench_scores"))
def _(t):
    """The published comparison as a seed file: all text in a CSV, typed by its mart."""
    path = fresh_path(t.spark, "benchmark-seed")
    names = schemas.ENGINE_BENCHMARK.names
    sinks.sorted_csv(t.benchmark, path, names, ["engine", "model", "region"])
    return marts.fct_engine_benchmark(reference.seed_csv(t.spark, path, schemas.ENGINE_BENCHMARK))


@query("a11_anomaly_seed", sql("select * from anomalies_mart", "anomalies_mart"))
def _(t):
    """The published anomalies as a seed file, with the surprise their mart adds."""
    path = fresh_path(t.spark, "anomaly-seed")
    names = schemas.PRICE_ANOMALY.names
    sinks.sorted_csv(t.scored_prices, path, names, ["region", "settlement_day"])
    return marts.fct_price_anomalies(reference.seed_csv(t.spark, path, schemas.PRICE_ANOMALY))


@query("a11_dim_fueltech_units", sql("""select f.fueltech, f.fueltech_label, f.fuel_group,
    f.is_renewable, f.emission_factor_t_co2_per_mwh, count(u.duid) as units from dim_fueltech f
    left join unit_seed u on f.fueltech = u.fueltech group by all""",
    "dim_fueltech", "unit_seed"))
def _(t):
    units = t.unit_seed.groupBy("fueltech").agg(F.count("duid").alias("units"))
    return t.dim_fueltech.join(units, "fueltech", "left").withColumn(
        "units", F.coalesce("units", F.lit(0))
    )


@query("a12_lookup_csv", sql("""select coalesce(u.fueltech, 'UNMAPPED') as ft, count(*) as n
    from scada s left join unit_seed u on s.duid = u.duid group by 1""", "scada", "unit_seed"))
def _(t):
    path = fresh_path(t.spark, "unit-lookup")
    t.unit_seed.write.option("header", True).csv(path)
    lookup = t.spark.read.schema(schemas.UNIT).option("header", True).csv(path)
    per_unit = t.raw_scada.groupBy("duid").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_unit.join(lookup.select("duid", "fueltech"), "duid", "left")
        .groupBy(F.coalesce("fueltech", F.lit("UNMAPPED")).alias("ft"))
        .agg(F.sum("n").alias("n"))
    )


@query("a13_parquet_scan", sql("""select l_orderkey, l_linenumber, l_quantity from lineitem
    where l_shipdate >= timestamp '2001-01-01'"""))
def _(t):
    return (
        t.table("lineitem")
        .filter(F.col("l_shipdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
        .select("l_orderkey", "l_linenumber", "l_quantity")
    )


@query("a14_named_view", sql("""select region, count(*) as n from stg_price group by 1""",
    "stg_price"))
def _(t):
    view = sinks.staging_view(t.stg_price, "voltspan_stg_price_demand")
    return view.groupBy("region").agg(F.count(F.lit(1)).alias("n"))


@query("a15_series", sql("select * from series", "series"))
def _(t):
    return series.daily_series(t.history, SERIES_MIN_INTERVALS).orderBy("unique_id", "ds")


_MONTHS = """select strftime(m, '%Y%m') as month from (select unnest(generate_series(
    date_trunc('month', e) - interval {n} month, date_trunc('month', e) - interval 1 month,
    interval 1 month)) as m from (select {end} as e from events))"""


@query("a16_recent_months", sql(_MONTHS.format(n=14, end="max(ts)")))
def _(t):
    newest = t.table("events").agg(F.max(F.to_date("ts")).alias("e"))
    return newest.select(F.explode(recent_months(F.col("e"), 14)).alias("month"))


@query("a17_lagged_months", sql(_MONTHS.format(n=24, end="max(ts) - interval 1 month")))
def _(t):
    newest = t.table("events").agg(F.max(F.to_date("ts")).alias("e"))
    return newest.select(F.explode(lagged_months(F.col("e"), 24)).alias("month"))


def _coverage(t: Tables) -> DataFrame:
    end = t.raw_price.agg(F.add_months(F.max(F.to_date("settlement_date")), 1).alias("e"))
    return coverage.landing_coverage(coverage.expected_files(end, F.col("e"), 6), t.raw_price)


_GRID = """select strftime(m, '%Y%m') as source_month, g.region from (
    select unnest(generate_series(date_trunc('month', e) - interval 5 month,
    date_trunc('month', e), interval 1 month)) as m from (select max(ts) as e from events)),
    (values ('NSW1'), ('QLD1'), ('VIC1'), ('SA1'), ('TAS1')) g(region)"""
_COVERAGE = f"""select e.source_month, e.region, case when l.n is null then 'missing'
    else 'landed' end as status, coalesce(l.n, 0) as n_rows from ({_GRID}) e
    left join (select source_month, region, count(*) as n from price_demand group by 1, 2) l
    on e.source_month = l.source_month and e.region = l.region"""


@query("a18_landing_coverage", sql(_COVERAGE, "price_demand"))
def _(t):
    return _coverage(t)


@query("a19_landing_gate", sql(
    f"select status, count(*) as files from ({_COVERAGE}) group by 1", "price_demand"))
def _(t):
    return coverage.status_counts(coverage.require_landed(_coverage(t)))


@query("a20_text_first_load", sql("""select region, date_trunc('second', settlement_date) as
    settlement_date, total_demand_mw, rrp_aud_mwh, period_type, source_month, source_file
    from price_demand""", "price_demand"))
def _(t):
    return landing.from_text(landing.text_first(t.raw_price))


# --------------------------------------------------------------------------- sinks
_FACT_BY_DAY = """select settlement_day, count(*) as n, min(rrp_aud_mwh) as lo from fct_price
    group by 1"""


@query("b1_replace_table", sql(_FACT_BY_DAY, "fct_price"))
def _(t):
    path = fresh_path(t.spark, "table")
    stored = sinks.replace_table(t.fct_price, "voltspan_fct_price_demand", path=path)
    return stored.groupBy("settlement_day").agg(
        F.count(F.lit(1)).alias("n"), F.min("rrp_aud_mwh").alias("lo")
    )


@query("b2_append_by_month", sql("""select source_month, count(*) as n, count(scada_mw) as
    with_value from scada group by 1""", "scada"))
def _(t):
    name, path = "voltspan_dispatch_unit_scada", fresh_path(t.spark, "declared")
    sinks.declare_table(t.spark, name, schemas.DISPATCH_SCADA, ["source_month"], path)
    sinks.append_rows(t.raw_scada, name)
    return t.spark.table(name).groupBy("source_month").agg(
        F.count(F.lit(1)).alias("n"), F.count("scada_mw").alias("with_value")
    )


@query("b3_marts_and_views", sql("""select region, settlement_day, interval_count, median_rrp
    from region_daily""", "region_daily"))
def _(t):
    """Staging as a view, the fact and the daily mart as tables on top of it."""
    view = sinks.staging_view(t.stg_price, "voltspan_staging_price")
    fact = sinks.replace_table(
        marts.fct_price_demand(view), "voltspan_fact", ["settlement_day"],
        fresh_path(t.spark, "fact"),
    )
    daily = sinks.replace_table(
        marts.fct_region_daily(fact), "voltspan_daily", path=fresh_path(t.spark, "daily")
    )
    return daily.select("region", "settlement_day", "interval_count", "median_rrp")


@query("b4_named_schemas", sql("""select 'marts' as schema_name, region, count(*) as n
    from region_daily group by 2 union all select 'raw', region, count(*) from price_demand
    group by 2""", "region_daily", "price_demand"))
def _(t):
    names = ["raw", "marts"]
    sinks.ensure_schemas(t.spark, names, fresh_path(t.spark, "schemas"))
    raw, daily = "raw.voltspan_price_demand", "marts.voltspan_region_daily"
    sinks.replace_table(t.raw_price, raw, path=fresh_path(t.spark, "raw"))
    sinks.replace_table(t.region_daily, daily, path=fresh_path(t.spark, "daily"))
    counts = [
        t.spark.table(f"{schema}.{table}").groupBy("region").agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(schema).alias("schema_name"), "region", "n")
        for schema, table in (n.split(".") for n in (daily, raw))
    ]
    return counts[0].unionByName(counts[1])


@query("b5_exports", sql("""select 'region_daily' as name, (select count(*) from region_daily)
    as rows union all select 'generation_daily', (select count(*) from generation_named)
    union all select 'region_energy_daily', (select count(*) from energy_daily)
    union all select 'demand_forecast', (select count(*) from fc_mart)
    union all select 'forecast_accuracy', (select count(*) from accuracy)
    union all select 'dim_region', (select count(*) from dim_region)
    union all select 'raw_price_demand', (select count(*) from price_demand)""",
    "region_daily", "generation_named", "energy_daily", "fc_mart", "accuracy", "dim_region",
    "price_demand"))
def _(t):
    from voltspan.plans.build import export_frames

    frames = {name: build() for name, build in export_frames(t).items()}
    return sinks.export_parquet(frames, fresh_path(t.spark, "exports"))


@query("b6_read_back", sql("""select count(*) as n, min(settlement_date) as first_ts,
    max(settlement_date) as last_ts from scada""", "scada"))
def _(t):
    """Counted and bounded while written; the footers confirm the count."""
    ts = F.col("settlement_date")
    seen = sinks.write_observed(
        t.raw_scada, fresh_path(t.spark, "scada"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")
    )
    return t.spark.createDataFrame(
        [(seen["rows"], seen["first_ts"], seen["last_ts"])], "n long, first_ts timestamp_ntz, last_ts timestamp_ntz"
    )


@query("b7_sorted_csv", sql("""select duid, station_name, region, dispatch_type, fuel_source,
    technology, fueltech, reg_cap_mw from unit_seed""", "unit_seed"))
def _(t):
    path = fresh_path(t.spark, "unit-csv")
    sinks.sorted_csv(t.unit_seed, path, sinks.UNIT_COLUMNS, ["duid"])
    back = t.spark.read.schema(schemas.UNIT).option("header", True).csv(path)
    return back.na.fill("")  # an empty CSV field reads as null


@query("b8_forecast_table", sql(f"""select region, model, forecast_date,
    {r('predicted_demand_mw', 1)} as predicted_demand_mw from naive_fc""", "naive_fc"))
def _(t):
    path = fresh_path(t.spark, "forecast")
    stored = sinks.replace_table(t.naive_forecast, "voltspan_demand_forecast", path=path)
    return marts.fct_demand_forecast(stored).select(
        "region", "model", "forecast_date", "predicted_demand_mw"
    )
