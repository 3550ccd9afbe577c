"""A Spark data source over ZIP archives: ``spark.read.format("zip_members")``.

Options: ``path`` (a folder, searched for ``*.zip``) or ``archives`` (a JSON list of paths), ``yearKey`` (the
Hive-style path segment that gives ``year``), ``splitBytes`` and ``chunkBytes``.

``partitions()`` lists archives, not members: an archive of n bytes gives ``n / splitBytes`` partitions, and a member belongs
to the one in whose byte range its local header lies.  Each task reads the central directory and its own members, so
no member row is ever on the driver and members of one archive are read in parallel.  Without the columns ``chunk`` and
``data`` a row describes a member and nothing is decompressed; with them a member comes as rows
of about ``chunkBytes`` that end at line ends.  Conditions on ``member``, ``archive`` and ``year`` are taken over from Spark: archives and
members that fail them aren't opened or decompressed.
"""

from __future__ import annotations

import json
import re
import zipfile
from typing import Iterator

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, StringContains, StringEndsWith, StringStartsWith)

MEMBER_SCHEMA = "archive string, year int, member string, member_size long"
CHUNK_SCHEMA = MEMBER_SCHEMA + ", chunk long, data binary"
SPLIT_BYTES, CHUNK_BYTES = 64 << 20, 8 << 20
#: Rows describing members are handed over in batches.
_ROWS = 4096


def filesystem_of(path: str):
    """The file system of a path and the path in it; local paths come with or without a scheme and aren't URI-encoded."""
    from pyarrow import fs as pafs

    if path.startswith("file:") or "://" not in path:
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path)


def open_file(path: str):
    filesystem, inner = filesystem_of(path)
    return filesystem.open_input_file(inner)


def archives_below(path: str) -> list[tuple[str, int]]:
    """Path and size of every ``*.zip`` below a folder, or of the file itself."""
    from pyarrow import fs as pafs

    filesystem, inner = filesystem_of(path)
    info = filesystem.get_file_info(inner)
    if info.is_file:
        return [(path, info.size)]
    root = path[:len(path) - len(inner)] if path.endswith(inner) else ""
    found = filesystem.get_file_info(pafs.FileSelector(inner, recursive=True, allow_not_found=True))
    return sorted((root + i.path, i.size) for i in found if i.is_file and i.path.lower().endswith(".zip"))


def line_chunks(raw, size: int) -> Iterator[bytes]:
    """A stream's bytes in chunks of about ``size`` that end at a line's end (the last one where the stream does).

    A carriage return alone ends a line too, but one that ends what has been read may belong to a line feed.
    A chunk grows beyond ``size`` only by a line longer than that.
    """
    held = b""
    while block := raw.read(size):
        held += block
        cut = held.rfind(b"\n") + 1
        if not cut:
            cut = held.rfind(b"\r", 0, -1) + 1
        if cut and len(held) >= size:
            yield held[:cut]
            held = held[cut:]
    if held:
        yield held


class Split(InputPartition):
    """The members of an archive whose headers lie in a byte range."""

    def __init__(self, archive: str, year: int | None, start: int, end: int):
        self.archive, self.year, self.start, self.end = archive, year, start, end


class ZipReader(DataSourceReader):
    def __init__(self, options: dict, columns: list[str]):
        self.columns = columns
        self.year_key = options.get("yearkey", "ano_eleicao")
        self.split_bytes = int(options.get("splitbytes", SPLIT_BYTES))
        self.chunk_bytes = int(options.get("chunkbytes", CHUNK_BYTES))
        self.roots = json.loads(options["archives"]) if "archives" in options else [options["path"]]
        self.conditions: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]):
        names = {EqualTo: "equal", In: "in", StringStartsWith: "starts", StringEndsWith: "ends", StringContains: "contains"}
        for f in filters:
            kind = names.get(type(f))
            if kind and f.attribute[0] in ("archive", "member", "year"):
                self.conditions.append((f.attribute[0], kind, f.value))
            else:
                yield f

    def _passes(self, column: str, value) -> bool:
        for name, kind, wanted in self.conditions:
            if name == column and not (value is not None and (
                    (kind == "equal" and value == wanted) or (kind == "in" and value in wanted)
                    or (kind == "starts" and value.startswith(wanted)) or (kind == "ends" and value.endswith(wanted))
                    or (kind == "contains" and wanted in value))):
                return False
        return True

    def partitions(self):
        out = []
        for root in self.roots:
            for archive, size in archives_below(root):
                found = re.search(rf"{re.escape(self.year_key)}=([0-9]+)", archive)
                year = int(found[1]) if found else None
                if self._passes("archive", archive) and self._passes("year", year):
                    out += [Split(archive, year, at, at + self.split_bytes) for at in range(0, max(1, size), self.split_bytes)]
        return out

    def read(self, split: Split):
        rows: list[tuple] = []
        whole = "data" in self.columns or "chunk" in self.columns
        with open_file(split.archive) as handle, zipfile.ZipFile(handle) as archive:
            for info in archive.infolist():
                if not split.start <= info.header_offset < split.end or info.is_dir():
                    continue
                if not info.filename.lower().endswith(".csv") or not self._passes("member", info.filename):
                    continue
                member = (split.archive, split.year, info.filename, info.file_size)
                if not whole:
                    rows.append(member)
                    if len(rows) == _ROWS:
                        yield self._batch(rows)
                        rows = []
                    continue
                with archive.open(info) as raw:
                    n = -1
                    for n, data in enumerate(line_chunks(raw, self.chunk_bytes)):
                        yield self._batch([(*member, n, data)])
                    if n < 0:  # an empty member has one empty chunk
                        yield self._batch([(*member, 0, b"")])
        if rows:
            yield self._batch(rows)

    def _batch(self, rows: list[tuple]) -> pa.RecordBatch:
        kinds = {"archive": pa.string(), "year": pa.int32(), "member": pa.string(), "member_size": pa.int64(), "chunk": pa.int64(),
                 "data": pa.binary()}
        places = {c: i for i, c in enumerate(kinds)}
        return pa.RecordBatch.from_arrays([pa.array([r[places[c]] for r in rows], kinds[c]) for c in self.columns], names=self.columns)


class ZipMembers(DataSource):
    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return CHUNK_SCHEMA

    def reader(self, schema) -> ZipReader:
        known = [field.split()[0] for field in CHUNK_SCHEMA.split(", ")]
        if other := [f.name for f in schema.fields if f.name not in known]:
            raise ValueError(f"no such columns of ZIP members: {other}; known are {known}")
        return ZipReader(self.options, schema.names)


def register(spark: SparkSession) -> None:
    """Make the format known to a session; conditions are pushed into Python sources only with this setting."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ZipMembers)
