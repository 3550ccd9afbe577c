"""Silver: contract-checked, cleaned, typed and lineage-stamped records.

Input is a *raw record* frame: one text column per source column (source
names) plus lineage columns ``_archive``, ``_member``, ``_record_no``,
``_year`` (the partition value) and ``_kind`` (the treatment of that year).
The archive reader (:mod:`stratum.sources.archives`) produces it from ZIP
members; :func:`raw_from_table` produces it from any table of text columns.

Everything is one narrow projection: no shuffle until the writer partitions
the output.  Invalid conversions are flagged per row and column in boolean
``_invalid_<column>`` columns and counted with one ``count_if`` each.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.contracts import MEMBER_PATTERN, SILVER_LAYER, Contract, snake_case
from stratum.functions import clean as C

# Silver metadata columns, in output order (the year column sits after them).
LINEAGE = ("silver_layer", "source_name", "source_row_number", "source_archive", "source_member")
TREATMENT = ("tipo_eleicao", "tipo_fundo", "dimensao_agregacao")
RAW_LINEAGE = ("_archive", "_member", "_record_no", "_year", "_kind")


class ContractViolation(ValueError):
    """Input that breaks the declared contract; nothing may be published."""


def raw_from_table(
    df: DataFrame,
    contract: Contract,
    *,
    archive: Column,
    member: Column,
    record_no: Column,
    year: Column,
    kind: Column,
) -> DataFrame:
    """Raw record frame from a table that already has the source columns."""
    return df.select(
        archive.alias("_archive"),
        member.alias("_member"),
        record_no.cast("bigint").alias("_record_no"),
        year.cast("int").alias("_year"),
        kind.alias("_kind"),
        *[F.col(c).cast("string").alias(c) for c in contract.source_columns],
    )


def check_header(header: Sequence[str], contract: Contract, where: str = "") -> None:
    """Exact header contract: same names, same order."""
    if tuple(header) != tuple(contract.source_columns):
        raise ContractViolation(
            f"unexpected schema in {where or contract.name}: "
            f"expected={tuple(contract.source_columns)}; received={tuple(header)}"
        )


def not_blank_record(contract: Contract) -> Column:
    """False when every source cell cleans to null (the record is skipped)."""
    return F.coalesce(*[C.clean_text(c) for c in contract.source_columns]).isNotNull()


def _clean_name(src: str) -> str:
    return f"_c_{src}"


def invalid_flag(name: str) -> str:
    return f"_invalid_{name}"


def typed_columns(contract: Contract) -> tuple[list[Column], list[Column]]:
    """Typed canonical columns and one boolean ``_invalid_<column>`` flag per
    typed column (plain booleans keep the projection in whole-stage codegen).

    Reads the cleaned cells ``_c_<source>`` produced by the previous
    projection, so each cell is cleaned exactly once.
    """
    out: list[Column] = []
    flags: list[Column] = []
    for src in contract.source_columns:
        name = contract.canonical(src)
        kind = contract.kind(name)
        cell = F.col(_clean_name(src))
        if kind == "integer":
            value, bad = C.parse_integer(cell, contract.integer_type, cleaned=True)
        elif kind == "decimal":
            value, bad = C.parse_decimal(cell, contract.decimal_type, cleaned=True)
        elif kind == "date":
            value, bad = C.parse_date(cell, cleaned=True)
        elif kind == "time":
            value, bad = C.parse_time(cell, cleaned=True)
        else:
            value = F.upper(cell) if name in contract.upper_columns else cell
            bad = None
        out.append(value.alias(name))
        if bad is not None:
            flags.append(bad.alias(invalid_flag(name)))
    return out, flags


def to_silver(raw: DataFrame, contract: Contract, source_name: str, keep_invalid: bool = True,
              passthrough: Sequence[str] = ()) -> DataFrame:
    """Clean, drop blank records, type, stamp lineage and order columns.

    Narrow projections: (1) collapse every cell's white space once and null
    out empty tokens, (2) drop records whose cells are all null, type the
    cells and flag invalid ones, (3) add the derived date-time and fix the
    column order.  Catalyst keeps them
    apart where collapsing would re-evaluate an expensive expression, and
    whole-stage codegen fuses them into one pass.

    Output columns: lineage, year, treatment, data columns (without the
    year), the combined date-time, ``_partition_year`` and the
    ``_invalid_<column>`` flags (when ``keep_invalid``).
    """
    collapsed = raw.select(
        *RAW_LINEAGE,
        *[C.collapse_whitespace(c).alias(_clean_name(c)) for c in contract.source_columns],
        *passthrough,
    )
    cleaned = collapsed.withColumns({
        _clean_name(c): C.without_empty(_clean_name(c)) for c in contract.source_columns})
    present = F.coalesce(*[F.col(_clean_name(c)) for c in contract.source_columns]).isNotNull()
    typed, flags = typed_columns(contract)
    flag_names = [invalid_flag(contract.canonical(s)) for s in contract.source_columns
                  if contract.kind(contract.canonical(s)) != "text"]
    year_col = contract.year_column
    stage = cleaned.where(present).select(
        F.lit(SILVER_LAYER).alias("silver_layer"),
        F.lit(source_name).alias("source_name"),
        F.col("_record_no").alias("source_row_number"),
        F.col("_archive").alias("source_archive"),
        C.base_name("_member").alias("source_member"),
        F.col("_kind").alias("tipo_eleicao"),
        F.lit(contract.fund).alias("tipo_fundo"),
        F.lit(contract.dimension).alias("dimensao_agregacao"),
        F.col("_year").alias("_partition_year"),
        *typed,
        *flags,
        *passthrough,
    )
    derived: list[Column] = []
    if contract.datetime_column:
        d, t, out = contract.datetime_column
        derived.append(C.combine_datetime(d, t).alias(out))
    cols = [*LINEAGE, year_col, *TREATMENT, *contract.data_columns]
    result = stage.select(*cols, *derived, "_partition_year", *flag_names, *passthrough)
    return result if keep_invalid else result.drop(*flag_names)


def silver_columns(contract: Contract) -> list[str]:
    cols = [*LINEAGE, contract.year_column, *TREATMENT, *contract.data_columns]
    if contract.datetime_column:
        cols.append(contract.datetime_column[2])
    return cols


def year_mismatches(silver: DataFrame, year_col: str, expected: Column | str = "_partition_year") -> DataFrame:
    """Rows whose year is not the partition's year (null never matches)."""
    expected = F.col(expected) if isinstance(expected, str) else expected
    return silver.where(~F.col(year_col).eqNullSafe(expected))


def invalid_counts(silver: DataFrame, contract: Contract, by: Sequence[str] = ("source_member",)) -> DataFrame:
    """``(by..., column, n)`` for columns with at least one invalid value.

    One aggregation with a ``count_if`` per typed column (partial aggregation
    makes it one row per task before the shuffle), then an unpivot.
    """
    typed = [
        contract.canonical(s)
        for s in contract.source_columns
        if contract.kind(contract.canonical(s)) != "text"
    ]
    agg = silver.groupBy(*by).agg(*[F.count_if(invalid_flag(c)).alias(c) for c in typed])
    long = agg.unpivot(list(by), typed, "column", "n")
    return long.where(F.col("n") > 0)


def totals(raw: DataFrame, silver: DataFrame, year_col: str = "_year") -> DataFrame:
    """Source records (blank ones included) and kept records per year and in total.

    ``rollup`` gives the per-year rows plus a grand total (year null).
    """
    src = raw.groupBy(F.col(year_col).alias("yr")).agg(F.count(F.lit(1)).alias("source_rows"))
    kept = silver.groupBy(F.col("_partition_year").alias("yr")).agg(F.count(F.lit(1)).alias("rows"))
    per_year = src.join(kept, "yr", "left").fillna(0, ["rows"])
    return per_year.rollup("yr").agg(
        F.sum("source_rows").cast("bigint").alias("source_rows"),
        F.sum("rows").cast("bigint").alias("rows"),
    )


def classify_members(df: DataFrame, name_col: str, partition_year: Column | str,
                     pattern: str = MEMBER_PATTERN) -> DataFrame:
    """Dataset, fund, dimension and year from a member's base name.

    ``status`` is ``ok``, ``unrecognised`` (name does not fully match) or
    ``year_mismatch`` (year differs from the partition's).
    """
    partition_year = F.col(partition_year) if isinstance(partition_year, str) else partition_year
    name = C.base_name(name_col)
    matched = name.rlike(pattern)
    fund = F.when(matched, F.lower(F.regexp_extract(name, pattern, 1)))
    dimension = F.when(matched, F.lower(F.regexp_extract(name, pattern, 2)))
    year = F.when(matched, F.regexp_extract(name, pattern, 3).cast("int"))
    status = (
        F.when(~matched, "unrecognised")
        .when(year != partition_year, "year_mismatch")
        .otherwise("ok")
    )
    return df.withColumns({
        "dataset": F.concat_ws("_", fund, dimension),
        "fund": fund,
        "dimension": dimension,
        "member_year": year,
        "status": status,
    }).withColumn("dataset", F.when(matched, F.col("dataset")))


def normalize_table(df: DataFrame) -> DataFrame:
    """Snake_case column names, cleaned text values; later duplicates win.

    Names are computed on the driver (they are metadata); values stay in
    Spark as one projection.
    """
    chosen: dict[str, str] = {}
    for c in df.columns:
        chosen[snake_case(c)] = c  # later duplicate names overwrite earlier ones
    types = dict(df.dtypes)
    cols = []
    for new, old in chosen.items():
        col = F.col(f"`{old}`")
        cols.append((C.clean_text(col) if types[old] == "string" else col).alias(new))
    return df.select(*cols)
