"""Shared helpers: the cluster's shared folder, durable cuts of the lineage, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows handed on at a time, so that a task holds the results of few rows only.
SLICE_ROWS = 256


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, ``spark.checkpoint.dir`` of the session.

    Only a ``local[...]`` session, whose one machine is the whole cluster,
    may go without; any other session without the setting is refused.
    """
    conf = spark.sparkContext.getConf()
    folder = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="stratum-llm-")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, below: str | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: a cut of the lineage that outlives executors.

    Shuffle files that only the finished stages needed go when the driver collects its garbage,
    so it is asked to here; a long chain of operators would otherwise hold them all.  ``below`` is
    a folder of ``scratch`` that the caller removes once all that is read from it is written elsewhere.
    """
    spark = df.sparkSession
    path = f"{below}/{name}-{uuid.uuid4().hex}" if below else scratch(spark, name)
    df.write.parquet(path)
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of ``scratch`` with its tables."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def utf8(column: pa.Array) -> list[bytes | None]:
    """A string column as UTF-8 bytes."""
    return column.cast(pa.binary()).to_pylist()


def kind(df: DataFrame, column: str) -> str:
    """A column's type as it stands in a schema string."""
    return df.schema[column].dataType.simpleString()
