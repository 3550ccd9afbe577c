"""The quality rule engine.

All findings go into one long *issue table*::

    artifact, rule, severity, column, message, record_no, n

Row rules (required, numeric validity, ranges, domains, conditional columns,
metadata, date-time coherence) are evaluated in **one projection** that
builds an array of violation structs, exploded once -- never a job per rule.
Set rules (duplicates in a grain, duplicate record numbers) use aggregation
plus a join, not a window, so a key holding a third of the rows is reduced
map-side instead of landing in one task.  Table rules (schema, missing
columns, row counts, dataset completeness, parent/child coverage) add one row
each with their count in ``n``.  Rollups, samples, profiles, reports and the
gate all read that one table.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.contracts import MAX_SAMPLES, Conditional, Contract
from stratum.functions import clean as C
from stratum.functions.keys import null_safe_condition
from stratum.operators.skew import is_hot, salted_join

ERROR, WARNING = "error", "warning"

ISSUE_COLUMNS = ("artifact", "rule", "severity", "column", "message", "record_no", "n")
ISSUE_SCHEMA = (
    "artifact string, rule string, severity string, column string, "
    "message string, record_no bigint, n bigint"
)


@dataclass(frozen=True)
class RowRule:
    """``predicate`` is true when the row violates the rule."""

    rule: str
    severity: str
    column: str | None
    message: str
    predicate: Column


def _present(df: DataFrame, cols: Sequence[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in cols if c in have]


def row_rules(
    df: DataFrame,
    contract: Contract,
    *,
    expected: Mapping[str, Column] | None = None,
    record_no_col: str = "source_row_number",
) -> list[RowRule]:
    """The row rules a contract implies, on the columns the frame has.

    Values are judged as text (the silver CSV form): a typed column is first
    rendered with :func:`stratum.functions.clean.as_text`.
    """
    types = dict(df.dtypes)

    def txt(c: str) -> Column:
        return C.as_text(c, types[c])

    rules: list[RowRule] = []
    for c in sorted(set(_present(df, contract.required))):
        rules.append(RowRule("required_not_null", ERROR, c, f"required field {c} is null", C.is_blank(txt(c))))
    for c in _present(df, contract.null_warning):
        rules.append(RowRule("source_numeric_null", WARNING, c, f"{c} is null after an invalid source value",
                             C.is_blank(txt(c))))
    int_cols = sorted(set(_present(df, [*contract.integer_columns, record_no_col])))
    for c in int_cols:
        parsed = C.text_integer(txt(c))
        rules.append(RowRule("invalid_integer", ERROR, c, f"field {c} is not a valid integer",
                             ~C.is_blank(txt(c)) & parsed.isNull()))
        if c in contract.non_negative:
            rules.append(RowRule("negative_value", ERROR, c, f"field {c} cannot be negative",
                                 ~C.is_blank(txt(c)) & (parsed < 0)))
    for c in sorted(_present(df, contract.decimal_columns)):
        parsed = C.text_decimal(txt(c), contract.decimal_type)
        rules.append(RowRule("invalid_decimal", ERROR, c, f"field {c} is not a valid decimal",
                             ~C.is_blank(txt(c)) & parsed.isNull()))
        if c in contract.percentage_columns:
            rules.append(RowRule("percentage_outlier", WARNING, c, f"field {c} is outside 0..100",
                                 (parsed < 0) | (parsed > 100)))
        else:
            rules.append(RowRule("negative_financial_value", WARNING, c, f"amount {c} is negative",
                                 parsed < 0))
    for c, value in (expected or {}).items():
        if c in types:
            rules.append(RowRule("metadata_integrity", ERROR, c, f"field {c} differs from its expected value",
                                 ~txt(c).eqNullSafe(value)))
    for c, domain in contract.accepted.items():
        if c in types:
            rules.append(RowRule("accepted_values", ERROR, c, f"{c} outside the accepted domain",
                                 ~F.coalesce(F.col(c).isin(*domain), F.lit(False))))
    if contract.conditional is not None:
        rules.extend(conditional_rules(df, contract.conditional))
    if contract.datetime_column and all(c in types for c in contract.datetime_column):
        d, t, dt_col = contract.datetime_column
        rules.append(RowRule("datetime_integrity", ERROR, dt_col, "generation date-time invalid or inconsistent",
                             ~datetime_coherent(txt(dt_col), txt(d), txt(t))))
    return rules


def conditional_rules(df: DataFrame, cond: Conditional, rule: str = "geographic_integrity") -> list[RowRule]:
    """Required / forbidden columns by level; unknown levels are not checked."""
    out: list[RowRule] = []
    level = F.col(cond.level_column)
    types = dict(df.dtypes)
    for lvl, (required, forbidden) in cond.rules.items():
        for c in required:
            if c in types:
                out.append(RowRule(rule, ERROR, c, f"{c} required for level {lvl}",
                                   (level == lvl) & C.is_blank(C.as_text(c, types[c]))))
        for c in forbidden:
            if c in types:
                out.append(RowRule(rule, ERROR, c, f"{c} must be null for level {lvl}",
                                   (level == lvl) & ~C.is_blank(C.as_text(c, types[c]))))
    return out


def datetime_coherent(dt_text: Column, date_text: Column, time_text: Column) -> Column:
    """ISO ``yyyy-MM-ddTHH:mm:ss`` that parses and splits back into date and time."""
    parsed = F.when(dt_text.rlike(C.ISO_DATETIME_PATTERN), dt_text.try_cast("timestamp_ntz"))
    return F.coalesce(
        parsed.isNotNull()
        & (F.date_format(parsed, "yyyy-MM-dd") == date_text)
        & (F.date_format(parsed, "HH:mm:ss") == time_text),
        F.lit(False),
    )


def record_id(df: DataFrame, record_no_col: str, fallback: Column | None = None) -> Column:
    """Integer value of the record number field, else the fallback position."""
    value = F.trim(F.col(record_no_col).cast("string")).try_cast("bigint")
    return F.coalesce(value, fallback) if fallback is not None else value


def row_violations(df: DataFrame, rules: Sequence[RowRule], artifact: Column, record_no: Column) -> DataFrame:
    """Evaluate every row rule in one projection and explode once.

    Each rule contributes a struct or null; ``explode`` plus a null filter
    stays inside whole-stage codegen (a higher-order ``filter`` would not).
    """
    structs = [
        F.when(r.predicate, F.struct(
            F.lit(r.rule).alias("rule"), F.lit(r.severity).alias("severity"),
            F.lit(r.column).cast("string").alias("column"), F.lit(r.message).alias("message"),
        ))
        for r in rules
    ]
    return (
        df.select(artifact.alias("artifact"), record_no.cast("bigint").alias("record_no"),
                  F.explode(F.array(*structs)).alias("v"))
        .where(F.col("v").isNotNull())
        .select("artifact", "v.rule", "v.severity", "v.column", "v.message", "record_no",
                F.lit(1).cast("bigint").alias("n"))
    )


def duplicates_after_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Every occurrence of a key after the first in ``order`` (nulls group together).

    Rows that tie on ``order`` are ordered by their other columns, so exactly one
    row of a key is its first whatever the order is.

    1. Keys are counted (narrow, with a partial aggregate); only rows of keys
       seen twice or more go on.
    2. Equal rows among these are counted, so copies of a row, however many,
       are one row from here on; a key's first row is a minimum, again with a
       partial aggregate.
    3. The counted rows are joined to their key's first row and dealt out once
       for each copy, the first one less.  A key with a large share of all rows,
       found by a sketch, is salted by a hash of the row, so its rows stay in
       many tasks; other keys aren't.
    """
    key, order = list(key), list(order)
    rest = [c for c in df.columns if c not in order]
    repeated = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > 1).select(*key)
    rows = df.alias("d").join(repeated.alias("k"), null_safe_condition("d", "k", key), "left_semi")
    counted = rows.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    counted = counted.withColumn("_at", F.struct(*order, *rest))
    first = counted.groupBy(*key).agg(F.min("_at").alias("_first"))
    later = F.col("_copies") - F.when(F.col("_at") == F.col("_first"), 1).otherwise(0)
    return (
        salted_join(counted, first, key, is_hot(df, key))
        .withColumn("_later", later).where("_later > 0")
        .withColumn("_later", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_later"))))
        .select(*df.columns)
    )


def duplicate_issues(
    df: DataFrame, key: Sequence[str], order: Sequence[str], artifact: Column, record_no: Column,
    rule: str, column: str | None, message: str,
) -> DataFrame:
    """One issue for each row of a key after its first in ``order``.

    Only what is compared or told of a row goes through the shuffles, not its other columns.
    """
    told = df.select(*dict.fromkeys([*key, *order]), artifact.alias("_artifact"), record_no.cast("bigint").alias("_record_no"))
    dups = duplicates_after_first(told, key, order)
    return dups.select(
        F.col("_artifact").alias("artifact"), F.lit(rule).alias("rule"), F.lit(ERROR).alias("severity"),
        F.lit(column).cast("string").alias("column"), F.lit(message).alias("message"),
        F.col("_record_no").alias("record_no"), F.lit(1).cast("bigint").alias("n"),
    )


def table_issue(artifact: Column, rule: str, message: Column | str, n: Column, column: str | None = None,
                severity: str = ERROR) -> list[Column]:
    """Columns of one table-level issue row (no record number)."""
    return [
        artifact.alias("artifact"), F.lit(rule).alias("rule"), F.lit(severity).alias("severity"),
        F.lit(column).cast("string").alias("column"),
        (F.lit(message) if isinstance(message, str) else message).alias("message"),
        F.lit(None).cast("bigint").alias("record_no"), n.cast("bigint").alias("n"),
    ]


def missing_columns(df: DataFrame, contract: Contract, artifacts: DataFrame, artifact_col: str = "artifact") -> DataFrame:
    """One issue per required column absent from the frame, per artifact.

    The column set algebra runs on the driver (it is schema metadata); the
    issues attach to every artifact present in the data.
    """
    missing = sorted(set(contract.required) - set(df.columns))
    if not missing:
        return artifacts.sparkSession.createDataFrame([], ISSUE_SCHEMA)
    names = F.explode(F.array(*[F.lit(c) for c in missing])).alias("column")
    base = artifacts.select(F.col(artifact_col).alias("artifact")).distinct().select("artifact", names)
    msg = F.concat(F.lit("required column "), F.col("column"), F.lit(" does not exist"))
    return base.select(
        "artifact", F.lit("missing_column").alias("rule"), F.lit(ERROR).alias("severity"), "column",
        msg.alias("message"), F.lit(None).cast("bigint").alias("record_no"), F.lit(1).cast("bigint").alias("n"),
    )


def schema_issues(artifacts: DataFrame, header: Sequence[str], stored: Sequence[str]) -> DataFrame:
    """``schema_integrity`` per artifact: the declared ``columns`` aren't the contract's ``header`` in its order, or
    aren't those that are ``stored``.  ``artifacts``: (artifact, columns)."""
    due = F.array(*[F.lit(c) for c in header])
    there = F.array(*[F.lit(c) for c in sorted(stored)])
    bad = artifacts.where(~F.col("columns").eqNullSafe(due) | ~F.sort_array("columns").eqNullSafe(there))
    return bad.select(*table_issue(
        F.col("artifact"), "schema_integrity", "stored schema differs from the silver manifest", F.lit(1)))


def row_count_issues(observed: DataFrame, expected: DataFrame) -> DataFrame:
    """``row_count_integrity`` per artifact: observed rows != declared rows.

    ``observed``: (artifact, rows); ``expected``: (artifact, expected_rows).
    """
    j = expected.join(observed, "artifact", "left").fillna(0, ["rows"])
    bad = j.where(F.col("rows") != F.col("expected_rows"))
    msg = F.format_string("observed count %d differs from manifest %d", F.col("rows"), F.col("expected_rows"))
    return bad.select(*table_issue(F.col("artifact"), "row_count_integrity", msg, F.lit(1)))


def completeness(artifacts: DataFrame, expected_datasets: Sequence[str] | Mapping[int, Sequence[str]],
                 year_col: str = "yr", dataset_col: str = "dataset") -> DataFrame:
    """Per year: missing, duplicated and extra datasets (sorted, comma-joined)
    and ``n_issues = #missing + #duplicated`` (the ``artifact_integrity`` count).

    The datasets expected are the same for every year that has an artifact, or
    declared year by year; then a declared year without any artifact lacks all.
    """
    kind = dict(artifacts.dtypes)[year_col]
    if isinstance(expected_datasets, Mapping):
        rows = [(int(y), d) for y, datasets in expected_datasets.items() for d in datasets]
        due = artifacts.sparkSession.createDataFrame(rows, f"{year_col} int, {dataset_col} string")
    else:
        names = F.explode(F.array(*[F.lit(d) for d in expected_datasets]))
        due = artifacts.select(year_col).distinct().select(year_col, names.alias(dataset_col))
    due = due.select(F.col(year_col).cast(kind), dataset_col, F.lit(True).alias("_due"))
    counts = artifacts.groupBy(year_col, dataset_col).agg(F.count(F.lit(1)).alias("_c"))

    def names_where(cond: Column) -> Column:
        return F.sort_array(F.collect_list(F.when(cond, F.col(dataset_col))))

    per_year = counts.join(due, [year_col, dataset_col], "full_outer").groupBy(year_col).agg(
        names_where(F.col("_c").isNull()).alias("_missing"),
        names_where(F.col("_c") > 1).alias("_dup"),
        names_where(F.col("_due").isNull()).alias("_extra"),
    )
    return per_year.select(
        year_col,
        F.array_join("_missing", ",").alias("missing"),
        F.array_join("_dup", ",").alias("duplicated"),
        F.array_join("_extra", ",").alias("extra"),
        (F.size("_missing") + F.size("_dup")).cast("bigint").alias("n_issues"),
    )


#: Bits of a key's presence in the two files.
IN_PARENT, IN_CHILD = 1, 2


def presence(parent: DataFrame, child: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every key of either file (nulls equal) once, with ``presence``, the bits of the files that have it.

    One aggregation over both files: rows meet by key after a partial aggregate, so a key is sent once
    by a task however many rows it has.
    """
    columns = list(columns)
    sides = parent.select(*columns, F.lit(IN_PARENT).alias("presence")).unionByName(
        child.select(*columns, F.lit(IN_CHILD).alias("presence")))
    return sides.groupBy(*columns).agg(F.bit_or("presence").alias("presence"))


def coverage(parent: DataFrame, child: DataFrame, key: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """Parent keys without a child and child keys without a parent, null-safe.

    Both files are read once, and one exchange brings keys together; groups are counted by partial aggregates.
    Output per group: side, n, rate = n / max(parents, 1); sides without any such key give no row.
    """
    group = list(group)
    here = presence(parent, child, [*group, *key])
    sides = {"parent_without_child": IN_PARENT, "child_without_parent": IN_CHILD}
    counted = here.groupBy(*group).agg(
        *[F.count_if(F.col("presence") == bit).alias(side) for side, bit in sides.items()],
        F.count_if(F.col("presence").bitwiseAND(IN_PARENT) > 0).alias("_parents"))
    out = counted.unpivot([*group, "_parents"], list(sides), "side", "n").where("n > 0")
    return out.select(
        *group, "side", F.col("n").cast("bigint").alias("n"),
        F.round(F.col("n") / F.greatest("_parents", F.lit(1)).cast("double"), 6).alias("rate"))


def coverage_issues(parent: DataFrame, child: DataFrame, key: Sequence[str], artifact: str,
                    year_col: str) -> tuple[DataFrame, DataFrame]:
    """``cross_dataset_integrity`` per year (issue columns and ``year_col``), and the parents of each
    year as the rows of ``artifact``, which make the rate of its issue."""
    sides = ("parent_without_child", "child_without_parent")
    found = coverage(parent, child, key, group=[year_col]).groupBy(year_col).pivot("side", list(sides)).agg(
        F.sum("n")).fillna(0)
    message = F.format_string("parent/child coverage inconsistent: without child=%d, orphans=%d", *sides)
    issues = found.select(*table_issue(
        F.lit(artifact), "cross_dataset_integrity", message, F.col(sides[0]) + F.col(sides[1])), year_col)
    parents = parent.select(year_col, *key).distinct().groupBy(year_col).agg(F.count(F.lit(1)).alias("rows"))
    return issues, parents.select(year_col, F.lit(artifact).alias("artifact"), "rows")


def null_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(by..., column, n)``: blank-or-null values per column, n >= 1 only."""
    types = dict(df.dtypes)
    agg = df.groupBy(*by).agg(*[F.count_if(C.is_blank(C.as_text(c, types[c]))).alias(c) for c in columns])
    return agg.unpivot(list(by), list(columns), "column", "n").where(F.col("n") > 0)


def rollup(issues: DataFrame, rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Issue counts per (``by``, artifact, rule, severity, column).

    ``rows``: (``by``, artifact, rows), for an artifact the rows it has, for
    a pair of files the parents they share.  rate = round(n / rows, 6), 1.0
    without rows; message = the message of the first record (table issues: any).
    """
    g = issues.groupBy(*by, "artifact", "rule", "severity", "column").agg(
        F.sum("n").cast("bigint").alias("n"),
        F.coalesce(F.min_by("message", "record_no"), F.min("message")).alias("message"),
    )
    j = g.join(rows, [*by, "artifact"], "left").fillna(0, ["rows"])
    return j.select(*by, "artifact", "rule", "severity", "column", "n", C.rate("n", "rows").alias("rate"), "message")


def samples(issues: DataFrame, k: int = MAX_SAMPLES, by: Sequence[str] = ()) -> DataFrame:
    """First ``k`` record numbers per (``by``, artifact, rule, column) in record order.

    ``row_number() <= k`` is planned with a partial ``WindowGroupLimit``
    before the shuffle, so a rule firing on every row ships only k rows per
    task for its group.
    """
    group = [*by, "artifact", "rule", "column"]
    w = Window.partitionBy(*group).orderBy("record_no")
    return (
        issues.where(F.col("record_no").isNotNull())
        .withColumn("position", F.row_number().over(w))
        .where(F.col("position") <= k)
        .select(*group, F.col("position").cast("bigint").alias("position"), "record_no")
    )


def profiles(issues: DataFrame, artifacts: DataFrame, by: Sequence[str] = (),
             nulls: DataFrame | None = None) -> DataFrame:
    """Per artifact: expected and observed rows, duplicates, errors, warnings.

    ``artifacts``: (``by``, artifact, expected_rows, rows).  ``nulls``
    (``by``, artifact, column, n) adds the map ``null_counts``.
    """
    key = [*by, "artifact"]
    sums = issues.groupBy(*key).agg(
        F.sum(F.when(F.col("rule") == "duplicate_grain", F.col("n")).otherwise(0)).cast("bigint").alias("duplicates"),
        F.sum(F.when(F.col("severity") == ERROR, F.col("n")).otherwise(0)).cast("bigint").alias("errors"),
        F.sum(F.when(F.col("severity") == WARNING, F.col("n")).otherwise(0)).cast("bigint").alias("warnings"),
    )
    out = artifacts.join(sums, key, "left").fillna(0, ["duplicates", "errors", "warnings"])
    if nulls is None:
        return out
    counts = nulls.groupBy(*key).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("column", "n")))).alias("null_counts"))
    return out.join(counts, key, "left")


def report(issues: DataFrame, artifacts: DataFrame, group: Sequence[str]) -> DataFrame:
    """Per group (e.g. year): valid, artifacts, rows, errors, warnings.

    ``issues`` and ``artifacts`` both carry the group columns.  Issues that
    belong to no artifact (cross-dataset, completeness) count as well.
    """
    a = artifacts.groupBy(*group).agg(
        F.count(F.lit(1)).alias("artifacts"), F.sum("rows").cast("bigint").alias("rows")
    )
    i = issues.groupBy(*group).agg(
        F.sum(F.when(F.col("severity") == ERROR, F.col("n")).otherwise(0)).cast("bigint").alias("errors"),
        F.sum(F.when(F.col("severity") == WARNING, F.col("n")).otherwise(0)).cast("bigint").alias("warnings"),
    )
    j = a.join(i, list(group), "full_outer").fillna(0, ["artifacts", "rows", "errors", "warnings"])
    return j.select(*group, (F.col("errors") == 0).alias("valid"), "artifacts", "rows", "errors", "warnings")


class GateClosed(RuntimeError):
    """A quality report is not valid; nothing downstream may load."""


def gate(report_df: DataFrame, group: Sequence[str]) -> DataFrame:
    """Pass-through of valid groups; raises when any requested group is invalid."""
    bad = report_df.where(~F.col("valid")).select(*group).collect()  # one row per group of artifacts
    if bad:
        raise GateClosed(f"quality report invalid for {[r.asDict() for r in bad]}")
    return report_df
