"""Writing the lake: partitioned sinks, slice replacement, run folders and an
all-or-nothing publish through a log of versions.

Parquet has no multi-table transaction.  A run writes every table under a
fresh ``run=<id>/`` folder, verifies it, and only then appends one small file to the
log, ``_commits/<version>.json``, which names everything that is current.  The file is
created only if no one else has created that version, so of two runs at once one
is first; the other looks at what the first one touched, is refused if they touched the same slice, and else commits on
top of it.  Readers take the largest version.  A failed
run leaves the log (and data) untouched.  Nothing is written
over a path that the same plan reads.
"""

from __future__ import annotations

import json
import uuid
from typing import Callable, Iterable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The folder of the log, below what it describes.
POINTER = "_commits"


class Conflict(RuntimeError):
    """Another run has published a slice that this run would replace."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str], mode: str = "overwrite",
                      fmt: str = "parquet") -> None:
    """Hive-style partitioned write (``year=2024/...``).

    Rows are dealt by the partition columns with a rebalance hint: adaptive
    execution sizes the tasks by bytes, so small slices share a file's task
    and a slice with a third of the rows is split over as many as it needs.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    df.write.mode(mode).partitionBy(*partition_by).format(fmt).save(path)


def write_slices(df: DataFrame, path: str, slice_cols: Sequence[str]) -> None:
    """Replace exactly the slices present in ``df`` (dynamic partition overwrite).

    Other slices stay untouched.  A slice that became *empty* is not in
    ``df`` and therefore not replaced; a load that may withdraw slices writes
    the table to its run folder instead.
    """
    spark = df.sparkSession
    prev = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_partitioned(df, path, slice_cols, mode="overwrite")
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a staged folder whose contents are written elsewhere."""
    fs, folder = _fs(spark, path)
    fs.delete(folder, True)


def move_all(spark: SparkSession, source: str, target: str) -> None:
    """Rename every file of a folder into another one, over files of the same name."""
    fs, folder = _fs(spark, source)
    if fs.exists(folder):
        jvm = spark.sparkContext._jvm
        fs.mkdirs(jvm.org.apache.hadoop.fs.Path(target))
        for status in fs.listStatus(folder):
            if not status.getPath().getName().startswith("."):
                _replace(spark, fs, status.getPath(), jvm.org.apache.hadoop.fs.Path(target, status.getPath().getName()))


def _replace(spark: SparkSession, fs, source, target) -> None:
    """Rename over an existing file in one step."""
    jvm = spark.sparkContext._jvm
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(source), fs.makeQualified(target), options)


def new_run(base: str) -> str:
    """A fresh run folder below ``base`` (never reused, never overwritten)."""
    return f"{base.rstrip('/')}/run={uuid.uuid4().hex}"


def publish(spark: SparkSession, base: str, run_dir: str, meta: dict | None = None) -> None:
    """Make ``run_dir`` current, whatever is."""
    commit(spark, base, lambda _: {"run": run_dir, **(meta or {})})


def commit(spark: SparkSession, base: str, state: Callable[[dict | None], dict], start: int | None = None,
           touched: Mapping[str, Iterable[str]] | None = None) -> int:
    """Append the next version; returns its number.

    ``state`` makes it from the current one.  With ``start``, the version this run began from, every version since is
    compared: one that ``touched`` a slice (by table) that this run touches too refuses this run with ``Conflict``.  If someone else
    is first with a version, all that is done again on top of theirs.
    """
    mine = {table: sorted(set(slices)) for table, slices in (touched or {}).items()}
    seen = start
    while True:
        version, current = head(spark, base)
        for n in range(seen + 1, version + 1) if seen is not None else ():
            theirs = _read(spark, base, n)["touched"]
            both = {t: sorted(set(s) & set(theirs.get(t, ()))) for t, s in mine.items()}
            if any(both.values()):
                raise Conflict(f"published by another run since version {start}: { {t: s for t, s in both.items() if s} }")
        if seen is not None:
            seen = version
        text = json.dumps({"state": state(current), "touched": mine})
        if _create(spark, base, version + 1, text):
            return version + 1


def _file(base: str, version: int) -> str:
    return f"{base.rstrip('/')}/{POINTER}/{version:012d}.json"


def _create(spark: SparkSession, base: str, version: int, text: str) -> bool:
    """Write a version's file unless it is there: all of it or nothing, under its name in one step."""
    fs, target = _fs(spark, _file(base, version))
    _, temporary = _fs(spark, f"{base.rstrip('/')}/{POINTER}/.{version}-{uuid.uuid4().hex}")
    out = fs.create(temporary, False)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    try:
        return _place(spark, fs, temporary, target)
    finally:
        fs.delete(temporary, False)


def _place(spark: SparkSession, fs, source, target) -> bool:
    """Give a written file its name if the name is free: a rename that doesn't replace; on a local disk, where
    that would look first and rename then, a hard link."""
    jvm = spark.sparkContext._jvm
    try:
        if fs.getScheme() == "file":
            local = [jvm.java.io.File(fs.makeQualified(p).toUri().getPath()).toPath() for p in (target, source)]
            jvm.java.nio.file.Files.createLink(*local)
        else:
            rename = jvm.org.apache.hadoop.fs.Options.Rename
            options = spark.sparkContext._gateway.new_array(rename, 1)
            options[0] = rename.NONE
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
            context.rename(fs.makeQualified(source), fs.makeQualified(target), options)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in str(error.java_exception.toString()):
            return False
        raise
    return True


def head(spark: SparkSession, base: str) -> tuple[int, dict | None]:
    """The current version and what it says; 0 and None before the first."""
    fs, folder = _fs(spark, f"{base.rstrip('/')}/{POINTER}")
    if not fs.exists(folder):
        return 0, None
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    version = max((int(n[:-len(".json")]) for n in names if n.endswith(".json") and not n.startswith(".")), default=0)
    return version, _read(spark, base, version)["state"] if version else None


def _read(spark: SparkSession, base: str, version: int) -> dict:
    fs, path = _fs(spark, _file(base, version))
    stream = fs.open(path)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def pointer(spark: SparkSession, base: str) -> dict | None:
    """What the current version says, or None before the first."""
    return head(spark, base)[1]


def current_run(spark: SparkSession, base: str) -> str | None:
    """The published run folder, or None before the first publish."""
    found = pointer(spark, base)
    return found["run"] if found else None
