"""The quality engine run over the fixture silver (typed raw orders).

``q_raw`` is the silver output of the raw orders rendered as text (the CSV
form the quality step reads back), plus three raw columns that exercise the
numeric-validity and range rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.contracts import Contract
from stratum.functions import clean as C
from stratum.operators import quality as Q
from stratum.operators import silver as S
from stratum.plans import tables as T
from stratum.session import written_once

SOURCE = "fixture"

QRAW_CONTRACT = Contract(
    name="raw_orders",
    source_columns=(),
    integer_columns=frozenset({"yr", "int_val", "int_raw"}),
    decimal_columns=frozenset({"money_val", "money_raw", "pct_val"}),
    percentage_columns=("pct_val",),
    non_negative=("int_val", "int_raw"),
    required=("yr", "int_val", "date_val", "time_val", "ts_val", "status"),
    null_warning=("money_val",),
    accepted={"status": ("F", "O")},
    datetime_column=("date_val", "time_val", "ts_val"),
    grain=("source_member", "int_val", "status"),
)


def q_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = T.raw_orders(spark, sf_dir).withColumns({
        "int_raw": F.col("INT_TXT"),
        "money_raw": F.replace(F.replace(F.col("MONEY_TXT"), F.lit("."), F.lit("")), F.lit(","), F.lit(".")),
        "pct_val": ((F.col("_record_no") % 120) - 5).cast("string"),
    })
    silver = S.to_silver(raw, T.RAW_CONTRACT, SOURCE, keep_invalid=False,
                         passthrough=("int_raw", "money_raw", "pct_val"))
    cols = S.silver_columns(T.RAW_CONTRACT) + ["int_raw", "money_raw", "pct_val"]
    types = dict(silver.dtypes)
    # the silver CSV read back: every column is text
    return silver.select(*[C.as_text(c, types[c]).alias(c) for c in cols])


def expected_metadata() -> dict[str, Column]:
    return {
        "silver_layer": F.lit("silver"),
        "source_name": F.lit(SOURCE),
        "tipo_fundo": F.lit("raw"),
        "dimensao_agregacao": F.lit("orders"),
        "tipo_eleicao": T.treatment_kind(F.col("yr").try_cast("int")),
    }


def row_issues(q: DataFrame, rules: set[str] | None = None) -> DataFrame:
    found = Q.row_rules(q, QRAW_CONTRACT, expected=expected_metadata())
    if rules is not None:
        found = [r for r in found if r.rule in rules]
    return Q.row_violations(q, found, F.col("source_member"), Q.record_id(q, "source_row_number"))


def artifacts(q: DataFrame) -> DataFrame:
    """(artifact, yr, rows, expected_rows); the 1997 manifest claims one row more."""
    counts = q.groupBy(F.col("source_member").alias("artifact"), F.col("yr").cast("int").alias("yr")) \
        .agg(F.count(F.lit(1)).alias("rows"))
    return counts.withColumn(
        "expected_rows", F.col("rows") + F.when(F.col("yr") == 1997, 1).otherwise(0)
    )


def all_issues(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Every issue of the fixture artifacts, plus the artifact table.

    The silver text is read by four rule families; it is written once to the
    shared folder, so the parse is not repeated per family.
    """
    q = written_once(q_raw(spark, sf_dir), "silver-text")
    arts = artifacts(q)
    issues = row_issues(q)
    qr = q.withColumn("_rec", Q.record_id(q, "source_row_number"))
    issues = issues.unionByName(Q.duplicate_issues(
        qr, ["source_member", "int_val", "status"], ["_rec"],
        F.col("source_member"), F.col("_rec"), "duplicate_grain", None, "record duplicated in the grain"))
    issues = issues.unionByName(Q.duplicate_issues(
        qr, ["source_member", "source_row_number"], ["_rec"],
        F.col("source_member"), F.col("_rec"), "duplicate_source_row", "source_row_number",
        "source row number repeated"))
    issues = issues.unionByName(Q.row_count_issues(arts.select("artifact", "rows"),
                                                   arts.select("artifact", "expected_rows")))
    return written_once(issues, "issues"), written_once(arts, "artifacts")
