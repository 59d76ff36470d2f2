"""Session set-up and the two things that touch the cluster: shared storage and sizes."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only when a count proves that it has at most this many rows.
# Dimension rows here are under 200 bytes, so the ceiling is about 20 MB per executor.
BROADCAST_MAX_ROWS = 100_000


def local_session(cores: int | str = "*", app: str = "voltspan") -> SparkSession:
    """Session for tests and the bench; on a cluster the submitter configures Spark."""
    partitions = "8" if cores == "*" else str(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # building plans from Python is part of each query's time; skip call-site capture
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="voltspan-")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can read, as named by ``spark.checkpoint.dir``.

    Only a single-machine session may fall back to a folder of its own: on a cluster a
    local path would be lost with the executor that wrote it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has written to yet."""
    return f"{shared_dir(spark)}/voltspan/{name}-{uuid.uuid4().hex}"


def folder_state(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of the files below a folder, by any path Spark can open."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
    found = []
    while files.hasNext():
        file = files.next()
        found.append((file.getPath().toString(), file.getLen(), file.getModificationTime()))
    return tuple(sorted(found))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table once and read it back.

    Used where several consumers follow one expensive scan: the heavy input is read once,
    lost executors restart from files, and the reader knows the true size of the table.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """True when a count shows the table is small enough to copy to every executor.

    A plain count: it adds up per task, where a limit would first gather rows in one task.
    """
    return df.count() <= max_rows


def maybe_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast hint behind the size check; beyond it the join shuffles and AQE splits skew."""
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df
