"""One named CSV file for each member, written in parallel and shown all at once.

1. Spark writes the records as headerless parts, range-partitioned by member and record number, so a member's parts in the
   order of their names are its records in order; a member with a third of the rows has as many parts as its rows need.
2. A task for each member streams header and parts into ``{stem}{suffix}.csv`` under a temporary folder, and counts records
   and bytes; bytes are copied, nothing is parsed.
3. When every member's count is the one declared, the files get their names: a rename each.  Until then
   no reader sees any of them; a run that fails leaves the temporary folder only.

Quoting is standard (a quote inside a field is doubled), so any CSV reader takes the files; null and empty are both empty.
"""

from __future__ import annotations

import posixpath
import uuid
from typing import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.operators import publish as P
from stratum.sources.lake import CSV_FORM
from stratum.sources.zip_source import filesystem_of, open_file

FILES_SCHEMA = "member string, path string, records long, bytes long"
#: Records in a part, which one task writes.
PART_RECORDS = 1_000_000
_COPY = 4 << 20


class MemberFileError(RuntimeError):
    """A member's file doesn't have the records it should have; none is shown."""


def _line(fields: Sequence[str], sep: str) -> str:
    def quoted(v: str) -> str:
        return '"' + v.replace('"', '""') + '"' if any(c in v for c in (sep, '"', "\n", "\r")) else v
    return sep.join(quoted(f) for f in fields) + "\n"


def file_name(member: str, suffix: str) -> str:
    """``dir/name.csv`` becomes ``name{suffix}.csv``."""
    return posixpath.splitext(posixpath.basename(member))[0] + suffix + ".csv"


def export_members(df: DataFrame, folder: str, member_col: str, order_col: str, columns: Sequence[str],
                   expected: DataFrame | None = None, suffix: str = "_tratado", part_records: int = PART_RECORDS) -> DataFrame:
    """Write ``columns`` (text) of each member's records by ``order_col`` to ``folder/{stem}{suffix}.csv``.

    ``expected`` has ``member`` and ``rows``; members without records among them get a file with a header alone.
    Returns ``FILES_SCHEMA`` rows, one a member.  Two members whose files would have the same name are refused.
    """
    spark = df.sparkSession
    folder = folder.rstrip("/")
    work = f"{folder}/.members-{uuid.uuid4().hex}"
    columns, sep = list(columns), CSV_FORM["sep"]
    counted = df.groupBy(F.col(member_col).alias("member")).agg(F.count(F.lit(1)).alias("rows"))
    if expected is not None:
        counted = expected.select("member", F.col("rows").alias("declared")).join(counted, "member", "full_outer").fillna(0, ["rows"])
    else:
        counted = counted.withColumn("declared", F.col("rows"))
    counted.write.parquet(f"{work}/counts")  # a row a member
    counted = spark.read.parquet(f"{work}/counts")
    stems = counted.withColumn("stem", F.regexp_extract("member", r"([^/]+?)(\.[^./]*)?$", 1))
    twice = stems.groupBy("stem").agg(F.count(F.lit(1)).alias("n")).where("n > 1").first()
    if twice:
        raise MemberFileError(f"{twice['n']} members would be written to {twice['stem']}{suffix}.csv")
    wrong = counted.where(~F.col("rows").eqNullSafe(F.col("declared"))).first()
    if wrong:
        raise MemberFileError(f"{wrong['member']} has {wrong['rows']} records, {wrong['declared']} were declared")

    total = counted.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    parts = max(1, -(-total // part_records))

    # fields are quoted here, so that a part is lines as they will stand in the file
    def field(c: str):
        v = F.coalesce(F.col(c).cast("string"), F.lit(""))
        return F.when(v.rlike('[;"\n\r]'), F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(v)

    lines = df.select(F.sha1(F.col(member_col)).alias("of"), F.col(order_col).alias("at"), F.concat_ws(sep, *map(field, columns)).alias("line"))
    # sorted by the folder's column first, as the writer wants rows, so it doesn't sort them again
    (lines.repartitionByRange(parts, "of", "at").sortWithinPartitions("of", "at").select("of", "line")
     .write.partitionBy("of").option("compression", "none").text(f"{work}/parts"))

    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*.txt").load(f"{work}/parts")
              .select("path", F.col("length").alias("bytes"), F.regexp_extract("path", "/of=([^/]*)/", 1).alias("of")))
    by_member = listed.groupBy("of").agg(F.array_sort(F.collect_list("path")).alias("paths"))  # some parts a member
    members = counted.select("member", "rows", F.sha1("member").alias("of")).join(by_member, "of", "left")
    header, target = _line(columns, sep).encode(), f"{work}/files"

    def gather(batches):
        for batch in batches:
            out = []
            for member, rows, paths in zip(batch["member"], batch["rows"], batch["paths"]):
                path = f"{target}/{file_name(member, suffix)}"
                files, inner = filesystem_of(path)
                files.create_dir(posixpath.dirname(inner), recursive=True)
                size = len(header)
                with files.open_output_stream(inner) as sink:
                    sink.write(header)
                    for part in paths if paths is not None else ():
                        with open_file(part) as source:
                            while block := source.read(_COPY):
                                sink.write(block)
                                size += len(block)
                out.append((member, f"{folder}/{file_name(member, suffix)}", rows, size))
            yield pd.DataFrame(out, columns=["member", "path", "records", "bytes"])

    n_members = max(1, counted.count())
    done = members.repartition(min(n_members, int(spark.conf.get("spark.sql.shuffle.partitions")) * 8), "member").mapInPandas(gather, FILES_SCHEMA)
    done.write.parquet(f"{work}/done")
    done = spark.read.schema(FILES_SCHEMA).parquet(f"{work}/done")
    P.move_all(spark, target, folder)
    rows = spark.createDataFrame(done.collect(), FILES_SCHEMA)  # a row a file, as a directory listing has
    P.remove(spark, work)
    return rows
