"""Readers on real text files, landing coverage, sinks."""

import datetime as dt
import zipfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from voltspan.operators import dims, summaries
from voltspan.sinks import tables as sinks
from voltspan.sources import coverage, landing, reference, schemas

HEADER = "REGION,SETTLEMENTDATE,TOTALDEMAND,RRP,PERIODTYPE\n"
RECORDS = (
    "C,created by test\n"
    "I,DISPATCH,UNIT_SCADA,1,SETTLEMENTDATE,DUID,SCADAVALUE,LASTCHANGED\n"
    'D,DISPATCH,UNIT_SCADA,1,"2024/07/01 00:05:00",U1,12.5,"2024/07/01 00:00:03"\n'
    'D,DISPATCH,UNIT_SCADA,1,"2024/07/01 00:05:00",U2,,"2024/07/01 00:00:03"\n'
    'D,DISPATCH,UNIT_SCADA,1,"2024/07/01 00:10:00",U1,bad\n'
    'D,DISPATCH,PRICE,1,"2024/07/01 00:10:00",U1,5\n'
    "D,DISPATCH\n"
    "C,end,4\n"
)


def test_price_csv(spark, tmp_path):
    (tmp_path / "PRICE_AND_DEMAND_202110_SA1.csv").write_text(
        HEADER + "SA1,2021/10/01 00:05:00,1200.5,-30.25,TRADE\nSA1,2021/10/01 00:10:00,,1,TRADE\n"
    )
    (tmp_path / "PRICE_AND_DEMAND_202111_VIC1 #a+b.csv").write_text(
        HEADER + "VIC1,2021/11/01 00:05:00,4000,60,TRADE\n"
    )
    rows = {r.settlement_date: r for r in landing.price_csv(spark, str(tmp_path)).collect()}
    first = rows[dt.datetime(2021, 10, 1, 0, 5)]
    assert (first.total_demand_mw, first.rrp_aud_mwh, first.source_month) == (1200.5, -30.25, "202110")
    assert rows[dt.datetime(2021, 10, 1, 0, 10)].total_demand_mw is None
    other = rows[dt.datetime(2021, 11, 1, 0, 5)]
    assert other.source_file.endswith("PRICE_AND_DEMAND_202111_VIC1 #a+b.csv")


def test_bad_stamp_raises(spark, tmp_path):
    (tmp_path / "PRICE_AND_DEMAND_202110_SA1.csv").write_text(HEADER + "SA1,yesterday,1,1,TRADE\n")
    with pytest.raises(PySparkException):
        landing.price_csv(spark, str(tmp_path)).collect()


WANT = {
    (dt.datetime(2024, 7, 1, 0, 5), "U1", 12.5, "202407"),
    (dt.datetime(2024, 7, 1, 0, 5), "U2", None, "202407"),
    (dt.datetime(2024, 7, 1, 0, 10), "U1", None, "202407"),
}


def test_record_csv(spark, tmp_path):
    (tmp_path / "DISPATCH_UNIT_SCADA_202407.csv").write_text(RECORDS)
    assert {tuple(r) for r in landing.scada_csv(spark, str(tmp_path)).collect()} == WANT
    assert landing.record_csv(spark, str(tmp_path)).count() == 8


def test_zip_archives(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "LINES_PER_BATCH", 3)
    for month in ("202407", "202408"):
        with zipfile.ZipFile(tmp_path / f"DISPATCH_UNIT_SCADA_{month}.zip", "w") as z:
            z.writestr("first.CSV", RECORDS.replace("2024/07", f"2024/{month[4:]}"))
            z.writestr("second.CSV", RECORDS)
    rows = {tuple(r) for r in landing.scada_zip(spark, str(tmp_path)).collect()}
    assert {r for r in rows if r[3] == "202407"} == WANT
    assert len(rows) == 6


def test_registry_csv_fills_missing_columns(spark, tmp_path):
    (tmp_path / "reg.csv").write_text(
        "ordinal,DUID,Region,Fuel Source - Descriptor\n1,U1,SA1,Wind\n2,U1,SA1,Solar\n"
    )
    rows = landing.registry_csv(spark, str(tmp_path))
    seed = dims.unit_seed(rows).collect()
    assert [(r.duid, r.fueltech, r.station_name) for r in seed] == [("U1", "solar", "")]


def test_seed_tables(spark, tmp_path):
    (tmp_path / "r.csv").write_text(
        "region_id,region_name,state,timezone\nSA1,South Australia,SA,Australia/Adelaide\n"
    )
    got = dims.dim_region(reference.seed_csv(spark, str(tmp_path), schemas.REGION)).collect()
    assert tuple(got[0]) == reference.REGIONS[3]
    fuel = dims.dim_fueltech(reference.fueltech_seed(spark)).collect()
    assert len(fuel) == 14 and sum(r.is_renewable for r in fuel) == 4
    assert {r.fueltech: r.emission_factor_t_co2_per_mwh for r in fuel}["coal_brown"] == 1.2


def test_text_first_round_trip(spark):
    rows = [("SA1", dt.datetime(2024, 1, 1, 0, 5), 1.0, 2.0, "TRADE", "202401", "f")]
    df = spark.createDataFrame(rows, schemas.PRICE_DEMAND)
    text = landing.text_first(df)
    assert text.columns[1] == "SETTLEMENT_DATE" and text.schema[1].dataType.simpleString() == "string"
    assert landing.from_text(text).collect() == df.collect()


def test_coverage_and_gate(spark):
    one = spark.sql("select date'2024-02-10' as e")
    grid = coverage.expected_files(one, one.e, 2, ["SA1", "VIC1"])
    rows = [("SA1", dt.datetime(2024, 1, 1), 1.0, 1.0, "T", "202401", "f"),
            ("VIC1", None, 1.0, 1.0, "T", "202401", "f")]
    landed = spark.createDataFrame(rows, schemas.PRICE_DEMAND)
    cov = coverage.landing_coverage(grid, landed)
    got = {(r.source_month, r.region): (r.status, r.n_rows) for r in cov.collect()}
    assert got == {
        ("202312", "SA1"): ("missing", 0), ("202312", "VIC1"): ("missing", 0),
        ("202401", "SA1"): ("landed", 1), ("202401", "VIC1"): ("empty", 1),
    }
    assert coverage.require_landed(cov) is cov
    with pytest.raises(RuntimeError):
        coverage.require_landed(coverage.landing_coverage(grid, landed.limit(0)))


def test_tables_and_exports(spark, tmp_path):
    spark.sql(f"create database if not exists vs_test location '{tmp_path}/db'")
    schema = schemas.DISPATCH_SCADA
    rows = [(dt.datetime(2024, 1, 1), "U1", 1.0, "202401"),
            (dt.datetime(2024, 2, 1), "U1", 2.0, "202402")]
    df = spark.createDataFrame(rows, schema)
    sinks.declare_table(spark, "vs_test.scada", schema, ["source_month"])
    assert spark.table("vs_test.scada").count() == 0
    sinks.append_rows(df, "vs_test.scada")
    sinks.append_rows(df, "vs_test.scada")
    stored = spark.table("vs_test.scada")
    assert sinks.require_same_count(df.unionAll(df), stored) == 4
    with pytest.raises(AssertionError):
        sinks.require_same_count(df, stored)
    again = sinks.replace_table(df, "vs_test.again")
    again = sinks.replace_table(df.filter("duid = 'none'"), "vs_test.again")
    assert again.count() == 0
    assert tuple(summaries.table_extent(stored, "settlement_date").first()) == (
        4, dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1))
    report = sinks.export_parquet({"a": df, "b": df.limit(1)}, f"{tmp_path}/out")
    assert {tuple(r) for r in report.collect()} == {("a", 2), ("b", 1)}
    sinks.sorted_csv(df, f"{tmp_path}/csv", ["duid", "scada_mw"], ["scada_mw"])
    text = "".join(p.read_text() for p in sorted((tmp_path / "csv").glob("part-*")))
    assert [x for x in text.splitlines() if x != "duid,scada_mw"] == ["U1,1.0", "U1,2.0"]
    view = sinks.staging_view(df, "vs_view")
    assert view.count() == 2
    spark.sql("drop database vs_test cascade")


HEADER = "REGION,SETTLEMENTDATE,TOTALDEMAND,RRP,PERIODTYPE\n"


@pytest.mark.parametrize("text", [
    HEADER + "SA1,2024/07/01 00:05:00,abc,75,TRADE\n",
    HEADER.replace("TOTALDEMAND,RRP", "RRP,TOTALDEMAND") + "SA1,2024/07/01 00:05:00,75,8000,TRADE\n",
])
def test_bad_numbers_and_swapped_columns_raise(spark, tmp_path, text):
    (tmp_path / "PRICE_AND_DEMAND_202407_SA1.csv").write_text(text)
    with pytest.raises(Exception):
        landing.price_csv(spark, str(tmp_path)).collect()


def test_registry_columns_go_by_name(spark, tmp_path):
    (tmp_path / "reg.csv").write_text("Region,ordinal,DUID\nSA1,4,U9\n")
    row = landing.registry_csv(spark, str(tmp_path)).first()
    assert (row["ordinal"], row["DUID"], row["Region"]) == (4, "U9", "SA1")


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    for name, path, keys in (("voltspan_kept_a", str(tmp_path / "t"), None), ("voltspan_kept_b", None, ["k"]), ("voltspan_kept_c", str(tmp_path / "p"), ["k"])):
        old = sinks.replace_table(spark.range(5).selectExpr("id", "id % 2 as k"), name, keys, path)
        assert old.count() == 5
        broken = spark.range(100, numPartitions=4).selectExpr("if(id = 99, raise_error('no'), id) as id", "id % 2 as k")
        with pytest.raises(Exception, match="no"):
            sinks.replace_table(broken, name, keys, path)
        assert sorted(r.id for r in spark.table(name).collect()) == list(range(5))
        # a table may be made from itself, and another schema takes over
        new = sinks.replace_table(spark.table(name).selectExpr("id + 1 as id", "k", "'x' as more"), name, keys, path)
        assert sorted(r.id for r in new.collect()) == list(range(1, 6)) and "more" in spark.table(name).columns
        spark.sql(f"drop table {name}")


def test_metrics_of_a_write_are_checked_with_the_footers(spark, tmp_path, monkeypatch):
    seen = sinks.write_observed(spark.range(50), str(tmp_path / "out"), F.max("id").alias("top"))
    assert seen == {"rows": 50, "top": 49}
    monkeypatch.setattr(type(spark.range(1)), "count", lambda self: 49)
    with pytest.raises(AssertionError, match="wrote 50 rows"):
        sinks.write_observed(spark.range(50), str(tmp_path / "out"))


def test_landed_files_follow_the_data(spark, sf_dir, tmp_path):
    import shutil

    import pyarrow.parquet as pq

    from voltspan.plans.registry import Tables
    from voltspan.plans.scan_queries import land_price_files

    for name in ("events", "region"):
        shutil.copy(f"{sf_dir}/{name}.parquet", tmp_path / f"{name}.parquet")
    first = land_price_files(Tables(spark, str(tmp_path)))
    assert land_price_files(Tables(spark, str(tmp_path))) == first
    pq.write_table(pq.read_table(f"{sf_dir}/events.parquet").slice(0, 10), tmp_path / "events.parquet")
    assert land_price_files(Tables(spark, str(tmp_path))) != first


def test_landing_writes_without_a_shuffle(spark, tmp_path):
    from voltspan.plans import scan_queries
    from voltspan.plans.registry import Tables

    rows = [
        (k, k % 5 if k else None, 1, q, 0.0, 0.0, t, "N", "O", dt.datetime(1995, 1 + k % 3, 1) if k != 4 else None)
        for k, (q, t) in enumerate([(50.0, 0.0), (50.0, 0.0), (5.0, 0.0), (20.0, 0.08), (50.0, 0.0), (46.0, 0.01), (50.0, 0.0)])
    ]
    names = "l_orderkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, " \
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    spark.createDataFrame(rows, names).withColumn("l_partkey", F.lit(1).cast("long")).repartition(2).write.parquet(f"{tmp_path}/lineitem.parquet")
    t = Tables(spark, str(tmp_path))
    lines = F.array_join(scan_queries.record_text(), "\n", "").alias("value")
    plan = scan_queries.texts_by_file(scan_queries.record_rows(t), [lines])._jdf.queryExecution().toString()
    assert "Sort [landing" in plan and "Exchange" not in plan
    landed = spark.read.option("recursiveFileLookup", True).text(scan_queries.land_record_files(t)).select(
        "value", F.regexp_extract("_metadata.file_path", "landing=([^/]*)", 1).alias("file"))
    want = scan_queries.record_lines(t).select(F.coalesce("value", F.lit("")), F.coalesce("landing", F.lit("__HIVE_DEFAULT_PARTITION__")))
    assert sorted(map(tuple, landed.collect())) == sorted(map(tuple, want.collect()))
    assert landed.filter("value like 'C,U%'").count() == 4 and landed.filter("value = ''").count() == 3
