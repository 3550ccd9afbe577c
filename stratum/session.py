"""Spark session construction and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every stratum job relies on.  They are defaults: a cluster launcher
# may already have set them, and an existing session keeps its own values.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app: str = "stratum",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with stratum's defaults.

    ``shuffle_partitions`` should be sized so one partition fits an executor
    task comfortably (~128-256 MB of shuffle data per partition at scale);
    AQE coalesces small ones at runtime, so erring high is cheaper than low.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, ``spark.checkpoint.dir`` of the session.

    Driver and executors must both reach it, so a cluster session without the
    setting is refused.  In ``local[...]`` one machine is the whole cluster;
    such a session may go without and gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="stratum-shared-")


#: Generated methods longer than this are not compiled by the JVM.
METHOD_LIMIT, COMPILED_METHOD_BYTES = "spark.sql.codegen.hugeMethodLimit", 8000


def written_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: computed once, columns pruned on read.

    The JVM interprets generated methods of more than 8000 bytes for good, which wide projections exceed; while
    the table is written, such stages run as separate operators instead, whose methods Spark splits.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(METHOD_LIMIT)
    spark.conf.set(METHOD_LIMIT, str(min(int(before), COMPILED_METHOD_BYTES)))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(METHOD_LIMIT, before)
    return spark.read.schema(df.schema).parquet(path)


# Upper bound for an explicit broadcast: a side must be estimated below this
# (Catalyst statistics, no job) or it is joined by shuffle instead.
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def maybe_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast a declared table (fixed code lists, years, slices) whose estimate is within the bound;
    beyond it the join shuffles, and adaptive execution decides by the size it measures."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return F.broadcast(df) if int(str(size)) <= max_bytes else df


def file_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads, by Catalyst's statistics (no job); a file read twice counts twice."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    read = [leaves.apply(i) for i in range(leaves.size())]
    return sum(int(str(x.stats().sizeInBytes())) for x in read if x.getClass().getSimpleName() == "LogicalRelation")


#: File bytes for each task of an aggregation that holds about as many keys as there are rows.
DEALT_BYTES = 8 * 1024 * 1024


def dealt(df: DataFrame, columns, bytes_each: int = DEALT_BYTES) -> DataFrame:
    """``df`` dealt by ``columns`` over a task for each ``bytes_each`` of its files, so what a task holds doesn't grow with
    them; a table of few files' bytes stays as it is."""
    n = -(-file_bytes(df) // bytes_each)
    return df.repartition(n, *columns) if n > 1 else df
