"""Generic record validations: not-empty, required fields, positive fields,
duplicate rows by key, scope, and a one-row validation report."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, NumericType

from stratum.operators.quality import duplicates_after_first
from stratum.session import maybe_broadcast


class ValidationError(ValueError):
    """A data set violated a basic quality rule."""


def ensure_not_empty(df: DataFrame, allow_empty: bool = False) -> None:
    """Refuse a frame without rows, unless it may be empty; one row is looked for, none are counted."""
    if not allow_empty and df.isEmpty():
        raise ValidationError("there are no records to validate")


def positive_field_violations(df: DataFrame, fields: Sequence[str], id_cols: Sequence[str]) -> DataFrame:
    """Every (record, field) whose value is not a number greater than zero.

    A column that is neither integer nor floating point (text, boolean,
    decimal) fails on every row, a null fails, a value <= 0 fails.  Output:
    ids, field, the value received as text, and a message; ordered by ids.
    All fields are judged in one projection and exploded once.
    """
    types = {f.name: f.dataType for f in df.schema.fields}

    def finding(field: str):
        numeric = isinstance(types[field], NumericType) and not isinstance(types[field], DecimalType)
        bad = ~F.coalesce(F.col(field) > 0, F.lit(False)) if numeric else F.lit(True)
        text = F.col(field).cast("string")
        said = F.concat(F.lit(f"{field} must be a number above zero, not "), F.coalesce(text, F.lit("null")))
        return F.when(bad, F.struct(F.lit(field).alias("field"), text.alias("value"), said.alias("message")))

    found = df.select(*id_cols, F.explode(F.array(*map(finding, fields))).alias("v")).where("v is not null")
    return found.select(*id_cols, "v.*").orderBy(*id_cols, "field")


def find_duplicate_rows(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Whole rows whose key was already seen earlier in ``order``."""
    return duplicates_after_first(df, key, order)


def out_of_scope(df: DataFrame, year_col: str, scope: Sequence[int]) -> DataFrame:
    """Partition values outside the declared scope, with their row counts.

    The scope is declared configuration (a handful of years), so it is
    broadcast; rows are counted per year first (partial aggregation).
    """
    spark = df.sparkSession
    allowed = spark.createDataFrame([(int(y),) for y in scope], f"{year_col} int")
    per_year = df.groupBy(year_col).agg(F.count(F.lit(1)).alias("rows"))
    return per_year.join(maybe_broadcast(allowed), year_col, "left_anti")


def validate_records(
    df: DataFrame,
    required: Sequence[str] = (),
    unique: Sequence[str] = (),
    order: Sequence[str] = (),
    allow_empty: bool = False,
) -> DataFrame:
    """One-row report: valid, record_count, duplicate_count, missing_fields, messages.

    A field is missing when any record has it null or empty (whitespace is
    not empty).  Duplicates are rows after the first per unique key, so
    ``duplicate_count = rows - distinct keys`` (nulls equal).  One shuffle:
    per-key partial counts, then a global sum.
    """
    ensure_not_empty(df, allow_empty)
    types = dict(df.dtypes)

    def missing(c: str):
        col = F.col(c)
        return col.isNull() | (col == "") if types.get(c) == "string" else col.isNull()

    absent = [c for c in required if c not in types]
    present = [c for c in required if c in types]
    keys = [c for c in unique if c in types] or [F.lit(1)]
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(missing(c)).alias(f"_m{i}") for i, c in enumerate(present)],
    )
    dup = F.sum(F.col("_n") - 1) if unique else F.lit(0)
    agg = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("record_count"),
        F.coalesce(dup, F.lit(0)).cast("bigint").alias("duplicate_count"),
        *[F.coalesce(F.sum(f"_m{i}"), F.lit(0)).alias(f"_m{i}") for i in range(len(present))],
    )
    flags = [F.when(F.col(f"_m{i}") > 0, F.lit(c)) for i, c in enumerate(present)]
    flags += [F.lit(c) for c in absent]
    missing_arr = F.array_sort(F.array_compact(F.array(*flags))) if flags else F.array().cast("array<string>")
    out = agg.select(
        "record_count", "duplicate_count", missing_arr.alias("_missing")
    ).select(
        ((F.size("_missing") == 0) & (F.col("duplicate_count") == 0)
         | (F.lit(allow_empty) & (F.col("record_count") == 0))).alias("valid"),
        "record_count", "duplicate_count",
        F.array_join("_missing", ",").alias("missing_fields"),
        F.concat_ws("; ",
                    F.transform("_missing", lambda c: F.concat(F.lit("required field "), c, F.lit(" is missing or empty"))),
                    F.when(F.col("duplicate_count") > 0,
                           F.concat(F.col("duplicate_count").cast("string"), F.lit(" rows repeat a key")))).alias("messages"),
        (F.size("_missing") + F.when(F.col("duplicate_count") > 0, 1).otherwise(0)).cast("bigint").alias("n_messages"),
    )
    return out
