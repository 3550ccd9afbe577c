"""Records of delimited files parsed by many tasks, numbered as one reader would number them.

A file comes as chunks of whole lines.  Whether a chunk's first line starts a record or goes on inside a quoted field depends on
all chunks before it, so:

1. each chunk is read for both cases, alone: how many records start in it, and whether its end lies inside a quoted field.
   A chunk is thus a function on {outside, inside};
2. these functions are composed along the file.  A function is constant (one end whatever the start), keeps the state, or flips it;
   the state before a chunk is the last constant one's end, flipped as often as there are flips since.  First record
   numbers are running sums.  Both are window aggregates over rows of some bytes a chunk;
3. each chunk is parsed from its first true record start.  What a chunk starting inside a field holds up to the record's end, its
   head, belongs to the chunk where that record starts, and is joined to it.

Quoting is that of Python's ``csv``: a quote opens a field only at its start, is doubled inside, and line ends are
``\\n``, ``\\r`` and ``\\r\\n``.  A file is UTF-8 (a byte order mark is left out) if all its chunks are, else Latin-1
(then a mark is text, before which no quote may open the first field).
"""

from __future__ import annotations

import csv
import io
import sys
from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.session import maybe_broadcast, written_once

RECORD_SCHEMA = "archive string, year int, member string, encoding string, record_no long, fields array<string>"
FILE = ["archive", "member"]
BATCH_ROWS = 20_000
_END = "end of chunk"  # a line of its own behind a chunk: a record by itself if the chunk ends outside


def _lines(text: str) -> io.StringIO:
    return io.StringIO(text, newline="")


def _records(text: str, delimiter: str) -> Iterator[list[str]]:
    csv.field_size_limit(sys.maxsize)
    return csv.reader(_lines(text), delimiter=delimiter)


def walk(text: str, inside: bool, delimiter: str) -> tuple[bool, int, int]:
    """Of a chunk that starts inside a quoted field or not: whether it ends inside one, how many records start in it,
    and the length of its head (the whole chunk if it has no end)."""
    lines = _lines(text)
    used = 0

    def fed():
        nonlocal used
        first = True
        for line in lines:
            used += len(line)
            yield '"' + line if first and inside else line
            first = False
        if first and inside:
            yield '"'
        yield _END

    csv.field_size_limit(sys.maxsize)
    reader = csv.reader(fed(), delimiter=delimiter)
    n, head, last = 0, 0, None
    for last in reader:
        n += 1
        if n == 1 and inside:
            head = used  # the reader takes a line when it needs one
    ends_inside = last != [_END]
    started = n - (not ends_inside) - inside
    return ends_inside, started, head if inside else 0


def scanned(chunks: DataFrame, delimiter: str = ";") -> DataFrame:
    """A small row for each chunk: for either start its end and records, its head, and whether it is UTF-8."""
    def scan(batches):
        for batch in batches:
            rows = []
            for archive, member, number, data in zip(*(batch.column(c).to_pylist() for c in ("archive", "member", "chunk", "data"))):
                try:
                    data.decode("utf-8")
                    utf8 = True
                except UnicodeDecodeError:
                    utf8 = False
                text = data.decode("latin-1")  # delimiters, quotes and line ends are the same bytes
                if number == 0 and utf8 and data.startswith(b"\xef\xbb\xbf"):
                    text = text[3:]
                if text and not text.endswith(("\n", "\r")):
                    text += "\n"  # the last line of a file
                rows.append((archive, member, number, utf8, *walk(text, False, delimiter)[:2], *walk(text, True, delimiter)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    kinds = [pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()]
    schema = ("archive string, member string, chunk long, utf8 boolean, out_end boolean, out_n long, in_end boolean, in_n long, "
              "head long")
    names = [field.split()[0] for field in schema.split(", ")]
    return chunks.select("archive", "member", "chunk", "data").mapInArrow(scan, schema)


def composed(scan: DataFrame) -> DataFrame:
    """For each chunk its ``start`` (inside a field or not), ``first_no`` (of the first record that starts in it), ``head``,
    ``owner`` (the chunk where the record that its head ends starts) and the file's ``encoding``."""
    along = Window.partitionBy(*FILE).orderBy("chunk")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    constant, flips = F.col("out_end") == F.col("in_end"), (F.col("out_end") & ~F.col("in_end")).cast("int")
    counted = scan.withColumns({"flips": F.sum(flips).over(along), "fixed": F.when(constant, F.col("out_end"))})
    counted = counted.withColumn("at_fixed", F.when(constant, F.col("flips")))
    base = F.coalesce(F.last("fixed", ignorenulls=True).over(before), F.lit(False))
    since = F.coalesce(F.last("flips").over(before), F.lit(0)) - F.coalesce(F.last("at_fixed", ignorenulls=True).over(before), F.lit(0))
    known = counted.withColumn("start", base != (since % 2 == 1))
    n = F.when(F.col("start"), F.col("in_n")).otherwise(F.col("out_n"))
    known = known.withColumn("n", n)
    return known.select(
        *FILE, "chunk", "start", "n", F.when(F.col("start"), F.col("head")).otherwise(0).alias("head"),
        (F.coalesce(F.sum("n").over(before), F.lit(0)) + 1).alias("first_no"),
        F.last(F.when(F.col("n") > 0, F.col("chunk")), ignorenulls=True).over(before).alias("owner"),
        F.when(F.min("utf8").over(Window.partitionBy(*FILE)), F.lit("utf-8-sig")).otherwise(F.lit("latin-1")).alias("encoding"))


def parsed(chunks: DataFrame, delimiter: str = ";") -> DataFrame:
    """``RECORD_SCHEMA`` rows of all files; ``chunks`` (``archive``, ``year``, ``member``, ``chunk``, ``data``) is a written table,
    read three times.  Record 1 is the first of a file."""
    plan = written_once(composed(scanned(chunks, delimiter)), "chunk-starts")
    key = [*FILE, "chunk"]
    # heads are cut where the bytes are, and come together where their record starts: a record's bytes at most
    cut = chunks.select(*key, "data").join(maybe_broadcast(plan.where("start").select(*key, "head", "owner")), key).select(
        *FILE, F.col("owner").alias("chunk"), F.struct("chunk", F.substring("data", F.lit(1), F.col("head").cast("int")).alias("data")).alias("h"))
    heads = cut.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list("h")), lambda h: h["data"]).alias("heads"))
    own = written_once(plan.where("n > 0").select(*key, "head", "first_no", "encoding").join(heads, key, "left"), "record-starts")

    def parse(batches):
        for batch in batches:
            for row in batch.to_pylist():
                file = (row["archive"], row["year"], row["member"], row["encoding"])
                skip = row["head"]
                data = row["data"]
                if row["chunk"] == 0 and row["encoding"] == "utf-8-sig" and data.startswith(b"\xef\xbb\xbf"):
                    data = data[3:]
                codec = "utf-8" if row["encoding"] == "utf-8-sig" else row["encoding"]
                text = b"".join([data[skip:], *(row["heads"] or [])]).decode(codec)
                out, number = [], row["first_no"]
                for fields in _records(text, delimiter):
                    out.append(fields)
                    if len(out) == BATCH_ROWS:
                        yield _records_batch(file, number, out)
                        number, out = number + len(out), []
                if out:
                    yield _records_batch(file, number, out)

    joined = chunks.select(*FILE, "year", "chunk", "data").join(maybe_broadcast(own), key)
    return joined.mapInArrow(parse, RECORD_SCHEMA)


def _records_batch(file: tuple, number: int, out: list[list[str]]) -> pa.RecordBatch:
    n = len(out)
    archive, year, member, encoding = file
    return pa.RecordBatch.from_arrays(
        [pa.array([archive] * n, pa.string()), pa.array([year] * n, pa.int32()), pa.array([member] * n, pa.string()),
         pa.array([encoding] * n, pa.string()), pa.array(range(number, number + n), pa.int64()), pa.array(out, pa.list_(pa.string()))],
        names=[f.split()[0] for f in RECORD_SCHEMA.split(", ")])
