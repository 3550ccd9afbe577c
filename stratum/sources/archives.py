"""Archive scan: ZIP archives of delimited members -> raw record frames.

1. :func:`scan_archives` lists archives (Spark's ``binaryFile`` listing, no content).
2. :func:`list_members` and :func:`read_chunks` are the ``zip_members`` data source: one row per
   member, or its decompressed bytes in chunks of whole lines.  Both run in tasks; no member row is on the driver.
3. :func:`read_records` parses written chunks, each in a task of its own however large the member
   is, and numbers records as one reader of the member would.

Record numbers count CSV records (not lines); the header is record 1 and is
emitted as such, data records start at 2 -- exactly what ``spark.read.csv``
cannot provide.  A member is decompressed by one task as a stream (deflate has no entry points); its memory is a
chunk, and what costs time, parsing, is split.
"""

from __future__ import annotations

import json
import shutil
import zipfile
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.sources import csv_split, zip_source


def scan_archives(spark: SparkSession, root: str, year_key: str = "ano_eleicao",
                  provenance: DataFrame | None = None) -> DataFrame:
    """Bronze catalogue: one row per ``*.zip`` below ``root``.

    Uses the ``binaryFile`` source for listing only (``content`` is never
    selected, so archives are not read here).  The partition year comes from
    the Hive-style ``{year_key}=YYYY`` path segment.  ``provenance`` (one row
    per year: source urls, ids, ...) is left-joined on the year.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.zip")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "length", "modificationTime")
    )
    catalogue = files.select(
        F.col("path").alias("archive"),
        F.regexp_extract("path", rf"{year_key}=([0-9]+)", 1).cast("int").alias("year"),
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified_at"),
    )
    return catalogue if provenance is None else catalogue.join(provenance, "year", "left")


def pack_members(spark: SparkSession, folder: str, target: str) -> list[str]:
    """Pack every file of ``folder`` into an archive of its own, ``target/{name}.zip``; a task streams each.  Returns the archives."""
    listed = spark.read.format("binaryFile").load(folder).select("path")
    files = [r["path"] for r in listed.collect()]  # a row a file, as a directory listing has

    def pack(batches):
        for batch in batches:
            for path in batch["path"]:
                name = path.rsplit("/", 1)[1]
                filesystem, inner = zip_source.filesystem_of(f"{target}/{name}.zip")
                filesystem.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                with zip_source.open_file(path) as source, filesystem.open_output_stream(inner) as sink, \
                        zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED) as archive:
                    with archive.open(name, "w", force_zip64=True) as member:
                        shutil.copyfileobj(source, member, 4 << 20)
            yield batch

    work = spark.createDataFrame([(f,) for f in files], "path string").repartition(max(1, len(files)), "path")
    return [f"{target}/{r['path'].rsplit('/', 1)[1]}.zip" for r in work.mapInPandas(pack, "path string").collect()]


def _members(spark: SparkSession, archives: Sequence[str], schema: str, **options) -> DataFrame:
    zip_source.register(spark)
    return spark.read.format("zip_members").schema(schema).options(
        archives=json.dumps(list(archives)), **{k: str(v) for k, v in options.items()}).load()


def list_members(spark: SparkSession, archives: Sequence[str], **options) -> DataFrame:
    """One row per ``.csv`` member (directories skipped, case-insensitive): archive, year, member, member_size."""
    return _members(spark, archives, zip_source.MEMBER_SCHEMA, **options)


def read_chunks(spark: SparkSession, archives: Sequence[str], **options) -> DataFrame:
    """The members' bytes: archive, year, member, member_size, chunk, data."""
    return _members(spark, archives, zip_source.CHUNK_SCHEMA, **options)


def read_records(chunks: DataFrame) -> DataFrame:
    """Raw records of every member from a written table of chunks; record 1 is the header."""
    return csv_split.parsed(chunks)


def headers(records: DataFrame) -> DataFrame:
    """Member headers (record 1): one small row per member."""
    return records.where(F.col("record_no") == 1).select(
        "archive", "year", "member", "encoding", F.col("fields").alias("header"))


def data_records(records: DataFrame) -> DataFrame:
    return records.where(F.col("record_no") > 1)
