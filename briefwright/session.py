"""Session settings and lineage cutting."""

from __future__ import annotations

import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Seconds from which on a write has left much behind.
SLOW_WRITE = 2.0


def build_session(app: str = "briefwright", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators count on (UTC, adaptive execution, skew joins)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.legacy.timeParserPolicy": "CORRECTED",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share. Only a local session without that
    setting gets a folder of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running iterative operators")
        root = "file://" + tempfile.mkdtemp(prefix="briefwright-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root}/briefwright-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back: loops keep small plans, a lost executor costs one read, not
    the whole history, and later steps read only the columns that they need."""
    spark, began = df.sparkSession, time.monotonic()
    path = shared_folder(spark)
    df.write.option("compression", "zstd").parquet(path)
    if time.monotonic() - began > SLOW_WRITE:  # else the shuffle files behind it stay until the driver happens to collect its garbage
        spark.sparkContext._jvm.System.gc()
    out = spark.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def release(*frames: DataFrame) -> None:
    """Deletes what ``cut_lineage`` wrote for frames that nothing reads any more."""
    for df in frames:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df._written)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
