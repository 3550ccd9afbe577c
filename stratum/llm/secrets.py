"""Secret scans over an incremental ledger of blobs.

Every version of every document is content-addressed: a blob is a text, its
address the SHA-256 of its bytes.  The ledger is a Parquet table with one row
per blob and rule version that has been scanned, with the spans found (none for
a clean blob).  A scan reads only the pairs the ledger lacks, each once however
many paths hold it, appends them, and joins findings back to all paths.

Copies are folded before and after the shuffle by blob (a partial and a final
aggregate), so a text with a third of all paths reaches its task once for each
map task.  The join back carries addresses and spans, no texts; a blob with
many paths is a skewed key whose path side adaptive execution splits.

Nulls count as the empty text, which is a blob too.  Repeated rows are each
given their findings.  A very long text is one row's value, read in linear time; spans of one kind don't overlap, and spans that
start at the same place stand in the order of the kinds.  Empty tables give empty results.  ``findings`` returns the id columns
named, ``redact`` all columns of the documents, whatever their names.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import slices

#: Raise it with every change of RULES: blobs are then scanned anew.
RULE_VERSION = "3"

#: A private key from its BEGIN line over the body to the END line; where that is missing, over header lines and the
#: lines of base64 (also in quotes, or with escaped line breaks), of which the last may be short.
_PEM = re.compile(r"""
    -----BEGIN\ [A-Z ]{0,40}PRIVATE\ KEY-----
    (?: [^-]*+ (?:-(?!----)[^-]*+)*+ -{5,}+END\ [A-Z ]{0,40}PRIVATE\ KEY-----
      | (?: (?:\s|\\++[nrt]|[>|\#*])++ [A-Z][A-Za-z]*-[A-Z][A-Za-z]*:[^\r\n\\]*+ )*+
        (?: (?:\s|\\++[nrt]|\\(?=[\r\n])|["'`,>|\#*]|\+(?=\s*["'`]))++ [A-Za-z0-9+/]{16,}+={0,2} )*+
        (?: (?:\s|\\++[nrt]|\\(?=[\r\n])|["'`,>|\#*]|\+(?=\s*["'`]))++ [A-Za-z0-9+/]++={1,2}
          | [\ \t>|\#*]*+ (?:[\r\n]|\\++[nr]|["'`]\s*+(?:\+\s*+)?["'`]) (?:\s|\\++[nrt]|[>|\#*])*+ [A-Za-z0-9+/]++(?=[ \t]*(?:[\r\n\\"'`]|\Z))
          | \s++ [A-Za-z0-9+/]++(?=\s*\Z) )?+
    )""", re.VERBOSE)

#: Kind, pattern, group whose length counts, characters it needs.  The first three are fixed values.
RULES = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                          re.IGNORECASE | re.ASCII), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]{24,}"), 0, 24),
    ("pem", _PEM, 0, 1),
    # from the first eyJ of a run of its letters; a run is looked at once, whether or not two more follow it
    ("jwt", re.compile(r"(?<![A-Za-z0-9_-])(?>(?:(?!eyJ)[A-Za-z0-9_-])*+)"
                       r"(?P<span>eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+)"), 0, 1),
    ("prefixed", re.compile(r"(?:gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,})"), 0, 1),
)
KINDS = tuple(rule[0] for rule in RULES)
BASE_KINDS = ("assign", "access", "hex")

#: Text that any match of a kind holds, sought first; letters of ``assign`` in either case.
_HINTS = {"assign": ("password", "passwd", "secret", "token", "apikey", "api_key"), "access": ("AKIA",),
          "pem": ("-----BEGIN ",), "jwt": ("eyJ",), "prefixed": ("gh", "xox", "sk_live_")}
_LOWER = {c: c + 32 for c in range(65, 91)}

SPANS = "array<struct<kind:string,start:int,end:int>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def spans_of(text: str) -> list[dict]:
    """Spans (code points, end exclusive) of all kinds, by start, then kind as listed."""
    lower, found = text.translate(_LOWER) if not text.isascii() else text.lower(), []
    for order, (name, pattern, group, least) in enumerate(RULES):
        hints = _HINTS.get(name)
        if hints and not any(h in (lower if name == "assign" else text) for h in hints):
            continue
        span = "span" if "span" in pattern.groupindex else 0
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                found.append((m.start(span), order, m.end(span)))
    return [{"kind": KINDS[order], "start": start, "end": end} for start, order, end in sorted(found)]


def _scan(batches):
    for batch in slices(batches):
        spans = [spans_of(text) for text in batch.column("blob_text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("blob"), pa.array(spans, _SPANS)], ["blob", "spans"])


def blob(text) -> F.Column:
    """A text's address."""
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)


class Ledger:
    """The table of blobs scanned, in a folder that all executors share."""

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.schema = f"blob string, spans {SPANS}, rule_version string"

    def rows(self, rule_version: str = RULE_VERSION) -> DataFrame:
        from pyspark.errors import AnalysisException
        try:
            table = self.spark.read.schema(self.schema).parquet(self.path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            table = self.spark.createDataFrame([], self.schema)  # before the first scan
        # two scans at once may both have found a blob unseen: a blob counts once
        return table.where(F.col("rule_version") == rule_version).groupBy("blob").agg(F.any_value("spans").alias("spans"))

    def scan(self, docs: DataFrame, text_col: str = "text", rule_version: str = RULE_VERSION) -> None:
        """Scan the blobs of ``docs`` that this rule version hasn't seen and append them."""
        blobs = docs.select(blob(docs[text_col]).alias("blob"),
                            F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("blob_text"))
        unseen = blobs.groupBy("blob").agg(F.any_value("blob_text").alias("blob_text")).join(
            self.rows(rule_version).select("blob"), "blob", "left_anti")
        unseen.mapInArrow(_scan, f"blob string, spans {SPANS}").withColumn(
            "rule_version", F.lit(rule_version)).write.mode("append").partitionBy("rule_version").parquet(self.path)

    def findings(self, docs: DataFrame, id_cols: list[str], text_col: str = "text",
                 rule_version: str = RULE_VERSION) -> DataFrame:
        """Every path of ``docs`` (its ``id_cols``), its ``blob`` and the blob's ``spans``."""
        paths = docs.select(*id_cols, blob(docs[text_col]).alias("blob"))
        return paths.join(self.rows(rule_version), "blob", "left").select(*id_cols, "blob", "spans")


def redact(docs: DataFrame, ledger: Ledger, text_col: str = "text", n_chars_col: str | None = "n_chars",
           mark: str = "[secret]", rule_version: str = RULE_VERSION) -> DataFrame:
    """``docs`` with its columns, every span found replaced by ``mark`` (overlapping spans by one)
    and ``n_chars_col`` counted anew where the text changed; clean documents are left alone."""
    ledger.scan(docs, text_col, rule_version)
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"),
                       docs[text_col].cast("string").alias("text"), blob(docs[text_col]).alias("blob"))
    joined = rows.join(ledger.rows(rule_version).where(F.size("spans") > 0), "blob", "left").select("row", "text", "spans")

    def masked(batches):
        for batch in slices(batches):
            texts = batch.column(1).to_pylist()
            for i, spans in enumerate(batch.column(2).to_pylist()):
                text, out, end = texts[i], [], 0
                for s in spans:
                    if s["start"] >= end:
                        out += [text[end:s["start"]], mark]
                    end = max(end, s["end"])
                texts[i] = "".join([*out, text[end:]])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["row", "text"])

    def columns(new: bool):
        for field in docs.schema:
            if new and field.name == text_col:
                yield F.col("text").alias(text_col)
            elif new and field.name == n_chars_col:
                yield F.length("text").cast(field.dataType).alias(n_chars_col)
            else:
                yield F.col("row").getField(field.name).alias(field.name)

    clean = joined.where("spans is null").select(*columns(False))
    schema = f"row {joined.schema['row'].dataType.simpleString()}, text string"
    mended = joined.where("spans is not null").select("row", "text", "spans").mapInArrow(masked, schema)
    return clean.unionByName(mended.select(*columns(True)))
