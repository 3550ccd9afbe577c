"""Quality reports from stored partial aggregates: a reloaded year replaces its own, the whole report is a merge.

For each year, artifact, rule, severity and column a partial holds the number of findings, the first record with its
message, and the first records' numbers; for each artifact its rows.  These merge (sums, the smallest, the smallest few), so
rollups, samples, profiles and reports of any set of years come from the stored partials alone, some rows a rule and
artifact.  The records themselves are read for the years that are loaded, and no others.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.contracts import MAX_SAMPLES
from stratum.functions import clean as C
from stratum.operators import publish as P
from stratum.operators import quality as Q

FINDING = ("artifact", "rule", "severity", "column")
FINDINGS_SCHEMA = ("artifact string, rule string, severity string, column string, n bigint, first_record bigint, message string, "
                   "records array<bigint>")
ARTIFACTS_SCHEMA = "artifact string, rows bigint, expected_rows bigint"


def findings(issues: DataFrame, by: str, k: int = MAX_SAMPLES) -> DataFrame:
    """Partials of an issue table, one row for each ``by`` value and finding.

    First records are limited before they are shuffled, so a rule that fires on every row sends ``k`` a task.
    """
    key = [by, *FINDING]
    sums = issues.groupBy(*key).agg(
        F.sum("n").cast("bigint").alias("n"), F.min("record_no").alias("first_record"),
        F.coalesce(F.min_by("message", "record_no"), F.min("message")).alias("message"))
    first = Q.samples(issues, k, by=[by, "severity"]).groupBy(*key).agg(F.sort_array(F.collect_list("record_no")).alias("records"))
    cond = Q.null_safe_condition("s", "f", key)
    return sums.alias("s").join(first.alias("f"), cond, "left").select(
        "s.*", F.coalesce("f.records", F.array().cast("array<bigint>")).alias("records"))


def store(partials: DataFrame, path: str, by: str) -> None:
    """Write partials below ``path``; values of ``by`` that come replace what is stored for them, others stay."""
    P.write_slices(partials, path, [by])


def stored(spark: SparkSession, path: str, schema: str, by: str, values: Sequence[int] | None = None) -> DataFrame:
    """Partials of all values of ``by``, or of some (only their folders are read)."""
    found = spark.read.schema(f"{schema}, {by} int").parquet(path)
    return found if values is None else found.where(F.col(by).isin(*values))


def merged(partials: DataFrame, by: Sequence[str] = (), k: int = MAX_SAMPLES) -> DataFrame:
    """Partials added up over everything but ``by`` and the finding; partials of the same finding merge in any order."""
    # every merge is of sorted lists of k at most
    return partials.groupBy(*by, *FINDING).agg(
        F.sum("n").cast("bigint").alias("n"), F.min("first_record").alias("first_record"),
        F.coalesce(F.min_by("message", "first_record"), F.min("message")).alias("message"),
        F.slice(F.sort_array(F.flatten(F.collect_list("records"))), 1, k).alias("records"))


def rollup(partials: DataFrame, artifacts: DataFrame, by: Sequence[str]) -> DataFrame:
    """As ``quality.rollup``, from partials."""
    rows = artifacts.groupBy(*by, "artifact").agg(F.sum("rows").alias("rows"))
    joined = merged(partials, by).join(rows, [*by, "artifact"], "left").fillna(0, ["rows"])
    return joined.select(*by, *FINDING, "n", C.rate("n", "rows").alias("rate"), "message", "records")


def report(partials: DataFrame, artifacts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """As ``quality.report``, from partials; without ``by`` one row over all."""
    group = list(by) or ["_all"]
    if not by:
        partials, artifacts = (d.withColumn("_all", F.lit(1)) for d in (partials, artifacts))
    return Q.report(partials, artifacts, group).drop("_all")
