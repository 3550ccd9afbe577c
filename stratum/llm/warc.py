"""WARC archives from legacy ARC archives.

An ARC archive begins with a version block that names the fields of its URL
records; version 1 has five fields, version 2 ten.  A record is its header line,
as many bytes as that declares, and a line feed.  The converter parses header
lines by the archive's version, takes the declared lengths, and synthesises for
every record the equivalent WARC record: an identifier derived from archive,
offset and content, the timestamp in the WARC form, the type, and SHA-1 digests.

Of records with equal payloads (of ``least_bytes`` or more), that with the largest
page id (of equals, one of them) becomes a response, all others
revisit it.  Digests are grouped without their payloads: a partial aggregate in
each task, so a payload with a third of all records is no hot key, then a join of
digests back to record places, whose record side adaptive execution splits.  The
places of revisits go to their archives as one bounded list each: an archive
holds ``archive_bytes`` of records or so.

Archives are gzip files that Spark's text writer puts into the shared folder,
and Spark's binary reader hands to the tasks, one archive at a time.

Null html is the empty payload, a null URL is ``-``; white space and control
characters of a URL are percent-encoded in header lines.  A null page id is
never the largest.  Repeated rows each have a record.  Empty tables give no
records.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import scratch

ARCHIVE_BYTES = 16 << 20
#: Bytes of a smaller payload are stored again rather than revisited.
LEAST_BYTES = 1000
#: Date of the records, which the pages table lacks.
ARCHIVE_DATE = "20240102030405"

#: Fields of the URL records by version; fixed values of the ARC format.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset",
        "Filename", "Archive-length"),
}
_NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:stratum:warc")

REVISITS = "array<struct<at:bigint,refers_to:bigint,uri:string>>"


# -- writing ARC -----------------------------------------------------------

def _version_block(version: int, name: str) -> str:
    body = f"{version} 0 stratum\n{' '.join(ARC_FIELDS[version])}\n"
    rest = f"filedesc://{name} 0.0.0.0 {ARCHIVE_DATE} text/plain"
    if version == 1:
        return f"{rest} {len(body)}\n{body}"
    return f"{rest} 200 - - 0 {name} {len(body)}\n{body}"


def arc_record(version: int, uri: Column, page_id: Column, html: Column) -> Column:
    """A URL record without its last line feed: header line, then the HTTP response as it was fetched."""
    size = F.octet_length(html).cast("string")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
                    F.coalesce(F.concat(F.lit("X-Page-Id: "), page_id.cast("string"), F.lit("\r\n")), F.lit("")),
                    F.lit("Content-Length: "), size, F.lit("\r\n\r\n"))
    length = (F.octet_length(http) + F.octet_length(html)).cast("string")
    head = [uri, F.lit("0.0.0.0"), F.lit(ARCHIVE_DATE), F.lit("text/html")]
    if version == 2:
        head += [F.lit("200"), F.lit("-"), F.lit("-"), F.lit("0"), F.lit("pages")]
    return F.concat(F.concat_ws(" ", *head, length), F.lit("\n"), http, html)


def _encoded(url: Column) -> Column:
    """A URL without white space or control characters."""
    plain = F.coalesce(F.when(url != "", url), F.lit("-"))
    return F.when(plain.rlike(r"[\x00-\x20\x7f\x{80}-\x{a0}\p{Z}]"),
                  F.replace(F.url_encode(plain), F.lit("+"), F.lit("%20"))).otherwise(plain)


def write_arc(pages: DataFrame, path: str, version: int = 1, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> None:
    """``pages`` as gzip ARC archives; every archive begins with its version block."""
    html = F.coalesce(pages[html_col].cast("string"), F.lit(""))
    record = arc_record(version, _encoded(pages[url_col].cast("string")), pages[id_col], html)
    in_task = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)  # the row's number within its task
    block = F.when(in_task == 0, F.lit(_version_block(version, "pages") + "\n")).otherwise("")
    pages.select(F.concat(block, record).alias("value")).write.option("compression", "gzip").text(path)


# -- reading ARC -----------------------------------------------------------

def arc_records(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, header fields and content of an archive's URL records, by its version and the declared lengths."""
    at, fields = 0, None
    while at < len(data):
        end = data.index(b"\n", at)
        values = data[at:end].decode().split(" ")
        content = data[end + 1:end + 1 + int(values[-1])]
        if len(content) != int(values[-1]):
            raise ValueError(f"the record at {at} declares {values[-1]} bytes; the archive has {len(content)} more")
        if fields is None:
            version = int(content.split(b" ", 1)[0])
            fields = ARC_FIELDS.get(version)
            if fields is None or tuple(content.decode().split("\n")[1].split(" ")) != fields:
                raise ValueError(f"version {version} or its fields are not known")
        elif len(values) != len(fields):
            raise ValueError(f"the header line at {at} has {len(values)} fields; the version has {len(fields)}")
        else:
            yield at, dict(zip(fields, values)), content
        at = end + 1 + len(content)
        if data[at:at + 1] != b"\n" and at < len(data):
            raise ValueError(f"the record at {at} is not ended by a line feed")
        at += 1


def http_parts(content: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields (names in lower case), head with its empty line, and payload of an HTTP response."""
    cut = content.find(b"\r\n\r\n")
    cut = len(content) if cut < 0 else cut + 4
    named = (line.split(":", 1) for line in content[:cut].decode("latin-1").split("\r\n")[1:] if ":" in line)
    return {k.strip().lower(): v.strip() for k, v in named}, content[:cut], content[cut:]


def archives(spark, path: str) -> DataFrame:
    """``path`` and gzip ``content`` of each archive of a folder, an archive for each task."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def record_id(archive: str, offset: int, digest: str) -> str:
    return uuid.uuid5(_NAMESPACE, f"{archive.rsplit('/', 1)[-1]}:{offset}:{digest}").urn


def _page_id(head: dict[str, str]) -> int | None:
    return int(head["x-page-id"]) if "x-page-id" in head else None


def _places(batches):
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            rows = []
            for at, _, body in arc_records(gzip.decompress(content.as_py())):
                head, _, payload = http_parts(body)
                digest = hashlib.sha1(payload).hexdigest()
                rows.append((path, at, _page_id(head), len(payload), digest, record_id(path, at, digest)))
            columns = list(zip(*rows)) or [()] * 6
            types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                             ["path", "at", "page_id", "n", "digest", "uri"])


def revisits(records: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``path`` and ``revisits`` (place, page id and identifier of the response) of each archive that has any."""
    large = records.where(F.col("n") >= least_bytes)
    order = F.struct(F.coalesce("page_id", F.lit(-(1 << 63))).alias("k"), F.col("page_id"), F.col("uri"))
    best = large.groupBy("digest").agg(F.max(order).alias("best"), F.count("*").alias("copies")).where("copies > 1")
    lost = large.join(best, "digest").where(F.col("uri") != F.col("best.uri"))
    return lost.groupBy("path").agg(F.collect_list(F.struct(
        F.col("at"), F.col("best.page_id").alias("refers_to"), F.col("best.uri").alias("uri"))).alias("revisits"))


# -- writing and reading WARC ----------------------------------------------

def warc_date(date: str) -> str:
    d = date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(archive: str, at: int, fields: dict[str, str], content: bytes, revisit: dict | None) -> bytes:
    """The equivalent WARC record without its last line break.  A revisit keeps the HTTP head only."""
    _, head, payload = http_parts(content)
    digest = hashlib.sha1(payload).hexdigest()
    block = head if revisit else content
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{record_id(archive, at, digest)}>", f"WARC-Date: {warc_date(fields['Archive-date'])}",
        f"WARC-Target-URI: {fields['URL']}", f"WARC-IP-Address: {fields['IP-address']}",
        f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if revisit:
        refers = "" if revisit["refers_to"] is None else str(revisit["refers_to"])
        lines[5:5] = ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                      f"WARC-Refers-To: <{revisit['uri']}>", f"X-Refers-To-Page-Id: {refers}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n"


def _converted(batches):
    for batch in batches:
        for path, content, found in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
            lost, out, size = {r["at"]: r for r in found or ()}, [], 0
            for at, fields, body in arc_records(gzip.decompress(content.as_py())):
                out.append(warc_record(path, at, fields, body, lost.get(at)))
                size += len(out[-1])
                if size > 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()).cast(pa.string())], ["value"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()).cast(pa.string())], ["value"])


def convert(spark, arc_path: str, warc_path: str, least_bytes: int = LEAST_BYTES) -> None:
    """All ARC archives of a folder as gzip WARC archives in another."""
    legacy = archives(spark, arc_path)
    places = legacy.mapInArrow(
        _places, "path string, at long, page_id long, n long, digest string, uri string")
    lost = revisits(places, least_bytes)
    legacy.join(lost, "path", "left").mapInArrow(_converted, "value string").write.option(
        "compression", "gzip").option("lineSep", "\r\n").text(warc_path)


def warc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of an archive's records, by the declared lengths."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record begins at {at}")
        fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
        n = int(fields["Content-Length"])
        yield fields, data[end + 4:end + 4 + n]
        at = end + 4 + n + 4


def _read(batches):
    for batch in batches:
        for content in batch.column(1):
            rows = []
            for fields, block in warc_records(gzip.decompress(content.as_py())):
                head, _, payload = http_parts(block)
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                kind = fields["WARC-Type"]
                if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"{fields['WARC-Record-ID']}: the payload doesn't have its digest")
                rows.append((_page_id(head), fields["WARC-Record-ID"].strip("<>"), fields["WARC-Target-URI"],
                             fields["WARC-Date"], int(head["content-length"]), digest, kind,
                             int(fields["X-Refers-To-Page-Id"]) if fields.get("X-Refers-To-Page-Id") else None))
            columns = list(zip(*rows)) or [()] * 8
            types = (pa.int64(), *[pa.string()] * 3, pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [
                "page_id", "record_id", "uri", "date", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def read(spark, path: str) -> DataFrame:
    """A row for each record of a folder's WARC archives; ``payload_bytes`` of a revisit as its HTTP head has it."""
    return archives(spark, path).mapInArrow(
        _read, "page_id long, record_id string, uri string, date string, payload_bytes long, "
               "payload_digest string, record_type string, refers_to long")


def round_trip(pages: DataFrame, version: int = 1, archive_bytes: int = ARCHIVE_BYTES,
               least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``pages`` written as ARC archives, converted to WARC archives, which are read back."""
    spark = pages.sparkSession
    base = scratch(spark, "archives")
    size = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    n = max(1, -(-size // archive_bytes))
    dealt = pages.select("page_id", "url", "html").repartition(n, "page_id", "url")
    write_arc(dealt, f"{base}/arc", version)
    convert(spark, f"{base}/arc", f"{base}/warc", least_bytes)
    return read(spark, f"{base}/warc")
