"""The daily refresh as incremental jobs: only what is new is read.

Checkpoints and outputs live in the shared folder, so a lost executor or driver resumes
from files. Streams run until the available input is used up and then stop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltspan.functions import scalars as X
from voltspan.functions.quantiles import middle_buckets, value_bucket
from voltspan.operators import marts, staging
from voltspan.session import maybe_broadcast, stage
from voltspan.sources import landing, schemas


def run_available(writer, checkpoint: str) -> None:
    """Start the stream on what is there and wait for its end."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def land_new_records(spark: SparkSession, source: str, target: str, checkpoint: str) -> DataFrame:
    """Append the unit readings of files not seen before to a table partitioned by month.

    The checkpoint remembers the files, so a second run over the same folder adds nothing.
    """
    files = landing._record_reader(spark.readStream).csv(source)
    rows = landing.unit_readings(files.withColumn("source_file", landing._file_path()))
    run_available(
        rows.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("source_month")
        .option("path", target),
        checkpoint,
    )
    return spark.read.schema(schemas.DISPATCH_SCADA).parquet(target)


def file_stream(
    spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int | None = None,
) -> DataFrame:
    """A folder of part files, one file, or any path pattern, as a stream.

    A stream takes a folder or a pattern; the last letter as a pattern of itself stands for either.
    """
    folder = folder if set(folder) & set("*?[{") else f"{folder.rstrip('/')[:-1]}[{folder.rstrip('/')[-1]}]"
    reader = spark.readStream.schema(schema).format("parquet")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def half_hour_energy(scada: DataFrame, units: DataFrame, lateness: str) -> DataFrame:
    """30-minute energy on a stream. A bucket is emitted once no reading within the allowed
    lateness can still change it; state holds open buckets only.

    Watermarks need an instant, so the unzoned stamp is read as session time and the bucket
    start is turned back into an unzoned stamp.
    """
    readings = scada.filter(F.col("scada_mw").isNotNull()).select(
        F.col("settlement_date").cast("timestamp").alias("ts"),
        "duid",
        X.positive_part("scada_mw").alias("mw"),
    )
    return (
        readings.withWatermark("ts", lateness)
        .join(maybe_broadcast(units.select("duid", "region", "fueltech")), "duid")
        .groupBy("region", "fueltech", F.window("ts", "30 minutes"))
        .agg(F.sum("mw").alias("mw"))
        .select(
            "region",
            "fueltech",
            F.col("window.start").cast("timestamp_ntz").alias("interval_start"),
            X.mwh_from_mw("mw").alias("generation_mwh"),
            (X.mwh_from_mw("mw") * F.lit(2.0)).alias("generation_avg_mw"),
        )
    )


BUCKET = ["region", "fueltech", "interval_start"]


def late_ledger(streamed: DataFrame, scada: DataFrame, units: DataFrame, since: str | None = None) -> DataFrame:
    """(region, fueltech, interval_start, generation_mwh, reason): what the stream's buckets lack.

    A watermark drops readings that come too late and leaves the newest buckets open, and neither shows in the
    output. This batch job sums the readings of the days from ``since`` on (all without it) and keeps the
    difference to what the stream has given: ``late`` for buckets it has closed, ``missing`` for those it
    has not given. Both sides are one row per bucket before they meet.
    """
    rows = scada if since is None else scada.filter(F.col("settlement_date") >= F.lit(since).cast("timestamp_ntz"))
    given = streamed if since is None else streamed.filter(F.col("interval_start") >= F.lit(since).cast("timestamp_ntz"))
    whole = marts.fct_generation(rows, units).select(*BUCKET, F.col("generation_mwh").alias("_whole"))
    seen = given.groupBy(*BUCKET).agg(F.sum("generation_mwh").alias("_seen"))
    lack = F.col("_whole") - F.coalesce("_seen", F.lit(0.0))
    return (
        whole.join(seen, BUCKET, "left")
        # sums differ in their last digits by the order of the readings
        .filter(F.col("_seen").isNull() | (F.abs(lack) > 1e-9 * F.greatest(F.abs("_whole"), F.lit(1.0))))
        .select(*BUCKET, lack.alias("generation_mwh"), F.when(F.col("_seen").isNull(), "missing").otherwise("late").alias("reason"))
    )


def with_ledger(streamed: DataFrame, ledger: DataFrame) -> DataFrame:
    """The buckets of stream and ledger together, as a batch would give them."""
    both = streamed.select(*BUCKET, "generation_mwh").unionByName(ledger.select(*BUCKET, "generation_mwh"))
    return both.groupBy(*BUCKET).agg(F.sum("generation_mwh").alias("generation_mwh")).withColumn(
        "generation_avg_mw", F.col("generation_mwh") * F.lit(2.0)
    )


def stream_to_parquet(result: DataFrame, target: str, checkpoint: str) -> DataFrame:
    """Run an append-mode stream over the available input into a Parquet folder."""
    run_available(
        result.writeStream.format("parquet").outputMode("append").option("path", target),
        checkpoint,
    )
    return result.sparkSession.read.schema(result.schema).parquet(target)


def _append_batch(df: DataFrame, folder: str, batch_id: int) -> DataFrame:
    """Add the rows of a batch to a table of batches, and return the whole table.

    A replayed batch replaces itself, since only its own partition is overwritten.
    """
    tagged = df.withColumn("batch", F.lit(batch_id).cast("bigint"))
    tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(folder)
    return df.sparkSession.read.schema(tagged.schema).parquet(folder)


def prices_in_middle(prices: DataFrame, buckets: DataFrame) -> DataFrame:
    """The stored prices that can decide a median of ``buckets``.

    Four numbers bound the days and buckets in the middle; as plain filters they reach the scan, where the files
    of other days and the row groups of other buckets are left out.
    """
    picks = middle_buckets(buckets.filter(F.col("_bucket").isNotNull()), marts.REGION_DAY)
    ends = [f(c) for c in ("settlement_day", "_bucket") for f in (F.min, F.max)]
    first_day, last_day, low, high = picks.agg(*ends).first()
    if low is None:
        return prices.limit(0)
    return prices.filter(F.col("settlement_day").between(first_day, last_day) & F.col("_bucket").between(low, high))


def refresh_region_daily(new_rows: DataFrame, state_folder: str, daily_folder: str, checkpoint: str) -> None:
    """Keep the daily rollup current from a stream of raw price rows, late ones included.

    The state is the table of totals per (region, day, price bucket), which merges: a batch adds its own bucket
    rows, and the touched days are summed up anew from bucket rows alone. For the exact median, prices are kept
    beside it, sorted by bucket, and only those in the middle buckets of touched days are read again. All three
    tables grow by one partition per batch; a day's row is that of its newest batch.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        fact = marts.fct_price_demand(staging.stg_price_demand(batch))
        counts = _append_batch(marts.region_day_buckets(fact), f"{state_folder}/buckets", batch_id)
        price = F.col("rrp_aud_mwh")
        kept = fact.filter(price.isNotNull()).select(*marts.REGION_DAY, value_bucket(price).alias("_bucket"), "rrp_aud_mwh")
        prices = _append_batch(kept.sortWithinPartitions("_bucket", "settlement_day"), f"{state_folder}/prices", batch_id)
        touched = counts.filter(F.col("batch") == batch_id).select("settlement_day").distinct()
        todo = counts.join(maybe_broadcast(touched.withColumnRenamed("settlement_day", "_day")), F.col("settlement_day").eqNullSafe(F.col("_day")))
        merged = stage(marts.merged_buckets(todo), "touched-buckets")
        daily = marts.region_daily_from(merged, prices_in_middle(prices, merged))
        # days of a batch and regions: few rows
        _append_batch(daily, daily_folder, batch_id)

    run_available(new_rows.writeStream.foreachBatch(apply), checkpoint)


def read_daily(spark: SparkSession, folder: str) -> DataFrame:
    """The newest row of every region and day."""
    schema = marts.region_daily_schema().add("batch", T.LongType())
    rows = spark.read.schema(schema).parquet(folder)
    whole = F.struct(*marts.REGION_DAILY_COLUMNS)
    return rows.groupBy(*marts.REGION_DAY).agg(F.max_by(whole, "batch").alias("row")).select("row.*")
