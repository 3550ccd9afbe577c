"""Dimension maintenance: distinct natural keys, upserts, insert-if-absent,
conflict detection, surrogate keys and uniqueness checks.

Parquet tables have no MERGE, DELETE or identity columns, so every operation
returns the *new* dimension as a DataFrame; :mod:`stratum.operators.publish`
writes it to a fresh run folder (never over a path read in the same plan).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.functions.keys import null_safe_condition, surrogate_key
from stratum.session import dealt, maybe_broadcast, written_once


class DimensionConflict(ValueError):
    """Two different attribute values arrived for one natural key."""


def distinct_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``SELECT DISTINCT`` of the natural key (partial + final aggregation)."""
    return df.select(*columns).distinct()


def with_surrogate(df: DataFrame, id_col: str, key: Sequence[str]) -> DataFrame:
    return df.withColumn(id_col, surrogate_key(*key))


def conflicts(df: DataFrame, key: Sequence[str], attr: str) -> DataFrame:
    """Natural keys that received more than one attribute value.

    One row per conflicting key and distinct value, with the key's number of
    values.  Rows are reduced to distinct pairs first, then counted per key,
    both with map-side partial aggregation; the counts join the pairs back.
    """
    pairs = df.select(*key, attr).distinct()
    many = pairs.groupBy(*key).agg(F.count(F.lit(1)).alias("n_values")).where(F.col("n_values") > 1)
    cond = null_safe_condition("p", "m", tuple(key))
    return pairs.alias("p").join(many.alias("m"), cond).select("p.*", "m.n_values")


def resolve_last_writer(df: DataFrame, key: Sequence[str], attr: str, order: str | Sequence[str]) -> DataFrame:
    """One attribute per key: the one that comes last by ``order`` (columns, the first one first).

    Order columns say who came last, e.g. the load's time, then archive and row; should two rows tie on
    all of them, the larger attribute counts, so the result never depends on how rows lie.
    ``max`` of a struct is a plain aggregate with map-side partial aggregation, so a
    key holding a third of the rows never gathers its rows in one task.  Nulls come first.
    """
    order = [order] if isinstance(order, str) else list(order)
    at = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], F.col(attr).alias("v"))
    return df.groupBy(*key).agg(F.max(at).alias("_last")).select(*key, F.col("_last.v").alias(attr))


def with_dense_ids(existing: DataFrame, incoming: DataFrame, key: Sequence[str], id_col: str) -> DataFrame:
    """``existing`` (key and ``id_col``) with the keys only ``incoming`` has, numbered on from the largest id without gaps.

    As identity columns do, but in the order of the keys (nulls first), so a repeated run gives the same ids.  Ids
    of existing keys stay.  New keys are distinct, so ranges of them are even: they are range-partitioned, sorted and
    written with their place in the partition; a partition's first id is the sum of the counts before it, which is a window
    over one row a partition.  No task sees more than its range, nothing is numbered by one task.
    """
    spark = existing.sparkSession
    known = existing.select(*key, id_col)
    new = incoming.select(*key).distinct().alias("n")
    absent = new.join(known.alias("e"), null_safe_condition("n", "e", tuple(key)), "left_anti")
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = absent.repartitionByRange(ranges, *key).sortWithinPartitions(*key)
    place = F.monotonically_increasing_id()  # partition number above, place in the partition below
    placed = written_once(placed.withColumn("_place", place), "new-keys").withColumns({
        "_part": F.shiftright("_place", 33), "_at": F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))})
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # one row for each partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("_part"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    top = F.coalesce(known.agg(F.max(id_col).alias("m")).scalar(), F.lit(0))
    numbered = placed.join(maybe_broadcast(starts), "_part").select(
        *key, (top + F.col("_start") + F.col("_at") + 1).cast(existing.schema[id_col].dataType).alias(id_col))
    return known.unionByName(numbered)


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    key: Sequence[str],
    attrs: Sequence[str],
    id_col: str | None = None,
    fail_on_conflict: bool = True,
) -> DataFrame:
    """Type-1 upsert: incoming attribute values replace existing ones per key.

    Keys only in ``existing`` stay; ids (if any) are kept for existing keys
    and derived from the natural key for new ones.  With ``fail_on_conflict``
    an incoming batch carrying two values for one key is refused (the
    database refuses to update one row twice in one statement).
    """
    incoming = incoming.select(*key, *attrs).distinct()
    if fail_on_conflict:
        # the rows are distinct, so a key that comes twice differs in some attribute
        bad = duplicate_keys(incoming, key).first()
        if bad:
            raise DimensionConflict(f"conflicting {', '.join(attrs)} for key {bad.asDict()}")
    e = existing.alias("e")
    n = incoming.withColumn("__incoming", F.lit(True)).alias("n")
    cond = null_safe_condition("e", "n", tuple(key))
    came = F.coalesce(F.col("n.__incoming"), F.lit(False))
    cols: list[Column] = [F.when(came, F.col(f"n.{k}")).otherwise(F.col(f"e.{k}")).alias(k) for k in key]
    cols += [F.when(came, F.col(f"n.{a}")).otherwise(F.col(f"e.{a}")).alias(a) for a in attrs]
    if id_col:
        new_id = surrogate_key(*[F.col(f"n.{k}") for k in key])
        cols.append(F.coalesce(F.col(f"e.{id_col}"), new_id).alias(id_col))
    return e.join(n, cond, "full_outer").select(*cols)


def insert_absent(existing: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """``INSERT ... ON CONFLICT DO NOTHING``: add keys not present yet.

    The anti join is null-safe, matching a ``NULLS NOT DISTINCT`` constraint.
    """
    new_rows = incoming.select(*existing.columns).dropDuplicates(list(key)).alias("n")
    cond = null_safe_condition("n", "e", tuple(key))
    absent = new_rows.join(existing.alias("e"), cond, "left_anti")
    return existing.unionByName(absent)


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys appearing more than once, with their count (nulls equal).

    Keys are nearly as many as rows, so they are dealt over as many tasks as the input needs: a task's table of
    keys stays the same size, and isn't held beside the sorts of a join that ``df`` ends with.
    """
    return (
        dealt(df.select(*key), key)
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )


def check_surrogate_keys(dim: DataFrame, id_col: str, key: Sequence[str]) -> DataFrame:
    """One row: distinct natural keys (nulls equal), distinct ids, and whether they agree."""
    pairs = dim.select(F.struct(*key).alias("_key"), F.col(id_col).alias("_id")).distinct()
    return pairs.agg(
        F.count_distinct("_key").alias("n_keys"),
        F.count_distinct("_id").alias("n_ids"),
        F.count(F.lit(1)).alias("_pairs"),
    ).select("n_keys", "n_ids", ((F.col("n_keys") == F.col("_pairs")) & (F.col("n_ids") == F.col("_pairs"))).alias("collision_free"))
