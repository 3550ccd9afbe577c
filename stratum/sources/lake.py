"""Lake layout, readers and writers.

Layout: ``{root}/{layer}/{source}/{key}={value}/.../{sub}/`` with layers
``bronze``, ``silver``, ``quality`` and ``gold`` (Hive-style partitions, so
Spark's partition discovery and ``PartitionFilters`` apply on read).
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

LAYERS = ("bronze", "silver", "quality", "gold")

#: Standard quoting, as other CSV readers expect it: a quote inside a field is doubled, a backslash is a letter.
CSV_FORM = {"sep": ";", "quote": '"', "escape": '"', "encoding": "UTF-8",
            "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
FILE_RECORDS = 1_000_000


def prefix(root: str, layer: str, source: str, partitions: Mapping[str, object] | None = None,
           sub: str | None = None) -> str:
    """``root/layer/source/k=v/.../sub/`` -- the partitioned prefix of a layer."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}; expected one of {LAYERS}")
    parts = [root.rstrip("/"), layer, source]
    parts += [f"{k}={v}" for k, v in (partitions or {}).items()]
    if sub:
        parts.append(sub.strip("/"))
    return "/".join(parts) + "/"


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def export_csv(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Silver CSV export: ``;``-separated, header, nulls as empty, UTF-8; quotes inside a field are doubled.

    A file holds ``FILE_RECORDS`` at most, since a file with line breaks in fields is read by one task.
    """
    writer = df.write.mode(mode).options(**CSV_FORM).option("header", True).option("nullValue", "") \
        .option("emptyValue", "").option("maxRecordsPerFile", FILE_RECORDS)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def read_text_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Silver CSV read back with every column as text (no inference).

    ``enforceSchema=False`` makes Spark check the header against ``columns``
    and fail on a mismatch instead of silently renaming.
    """
    schema = StructType([StructField(c, StringType(), True) for c in columns])
    return (
        spark.read.schema(schema).options(**CSV_FORM).option("header", True).option("multiLine", True)
        .option("enforceSchema", False).csv(path)
    )


MANIFEST_SCHEMA = (
    "year int, kind string, archive string, row_count long, "
    "artifacts array<struct<dataset: string, fund: string, dimension: string, member: string, "
    "encoding: string, source_row_count: long, row_count: long, "
    "invalid_value_counts: map<string, long>, columns: array<string>>>"
)


def manifests(artifacts: DataFrame) -> DataFrame:
    """One manifest row per year from the artifact table (sorted artifacts)."""
    art = F.struct(
        "dataset", "fund", "dimension", "member", "encoding", "source_row_count", "row_count",
        "invalid_value_counts", "columns",
    )
    def by_dataset_member(a, b):
        ka = F.concat_ws("/", a["dataset"], a["member"])
        kb = F.concat_ws("/", b["dataset"], b["member"])
        return F.when(ka < kb, -1).when(ka > kb, 1).otherwise(0)

    # bounded: one entry per member of the year's archive
    return artifacts.groupBy("year", "kind", "archive").agg(
        F.sum("row_count").cast("long").alias("row_count"),
        F.array_sort(F.collect_list(art), by_dataset_member).alias("artifacts"),
    )


def write_json(df: DataFrame, path: str, partition_by: Sequence[str] = ("year",), mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.json(path)


def read_json(spark: SparkSession, path: str, schema: str, years: Sequence[int] | None = None) -> DataFrame:
    """Read manifests / reports back with an explicit schema; ``years`` prunes partitions."""
    df = spark.read.schema(schema).json(path)
    if years is not None:
        df = df.where(F.col("year").isin(*[int(y) for y in years]))
    return df


def save_table(df: DataFrame, name_or_path: str, mode: str = "append", partition_by: Sequence[str] = ()) -> None:
    """DataFrame sink: a catalog table's name (``saveAsTable``) or a path.

    ``mode`` is ``append``, ``overwrite`` or ``error`` (fail if it exists).
    """
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if "/" in name_or_path:
        writer.parquet(name_or_path)
    else:
        writer.saveAsTable(name_or_path)
