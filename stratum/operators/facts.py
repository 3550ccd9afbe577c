"""Fact loading: dimension lookups, typed projection, reconciliation, slice
replacement and integrity checks (foreign keys, CHECK rules, uniqueness)."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stratum.session import maybe_broadcast

from stratum.functions.keys import null_safe_condition


class LoadError(RuntimeError):
    """A load that cannot be published safely."""


@dataclass(frozen=True)
class Lookup:
    """Resolve ``id_col`` by joining the stage to ``dim`` on ``on``.

    ``null_safe`` joins with ``<=>`` on every column (nullable natural keys
    such as a location); Catalyst still plans it as an equi-join.
    """

    dim: DataFrame
    on: tuple[str, ...]
    id_col: str
    null_safe: bool = False
    small: bool = False


def resolve(stage: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Inner-join the stage to each dimension and add its id column.

    Rows without a dimension match disappear (inner join, as the SQL load);
    :func:`reconcile` compares counts so such losses fail the load.
    """
    out = stage
    for lk in lookups:
        dim = lk.dim.select(*lk.on, lk.id_col)
        if lk.small:
            dim = maybe_broadcast(dim)
        if lk.null_safe:
            d = dim.alias("d")
            o = out.alias("s")
            cond = null_safe_condition(o, d, lk.on)
            out = o.join(d, cond).select("s.*", F.col(f"d.{lk.id_col}"))
        else:
            out = out.join(dim, list(lk.on))
    return out


def reconcile(stage: DataFrame, loaded: DataFrame, key: Sequence[str]) -> DataFrame:
    """Staged vs loaded rows for one load: staged, matched, lost, fanned out.

    ``loaded`` carries the stage key; a staged key matched k times contributes
    k-1 fanned-out rows, an unmatched one is lost.  Both sides are counted per
    key in one aggregate (map-side partial), so there is one shuffle of counts
    and no join.
    """
    sides = stage.select(*key, F.lit(1).alias("_s"), F.lit(0).alias("_l")).unionByName(
        loaded.select(*key, F.lit(0).alias("_s"), F.lit(1).alias("_l")))
    j = sides.groupBy(*key).agg(F.sum("_s").alias("s_n"), F.nullif(F.sum("_l"), F.lit(0)).alias("l_n")).where("s_n > 0")
    l_n = F.coalesce(F.col("l_n"), F.lit(0))
    return j.agg(
        F.sum("s_n").cast("bigint").alias("staged"),
        F.sum(F.least(F.col("s_n"), l_n)).cast("bigint").alias("matched"),
        F.sum(F.when(F.col("l_n").isNull(), F.col("s_n")).otherwise(0)).cast("bigint").alias("lost"),
        F.sum(F.greatest(l_n - F.col("s_n"), F.lit(0))).cast("bigint").alias("fanned_out"),
    )


def observed_write(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row-count observation; it fills in during the write itself."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def orphans(child: DataFrame, parent: DataFrame, fk: Sequence[str], pk: Sequence[str] | None = None) -> DataFrame:
    """Child rows whose foreign key has no parent row (``left_anti``)."""
    pk = pk or fk
    p = parent.select(*[F.col(a).alias(b) for a, b in zip(pk, fk)]).distinct()
    return child.join(p, list(fk), "left_anti")


def check_violations(df: DataFrame, checks: dict[str, Column], id_cols: Sequence[str]) -> DataFrame:
    """Rows violating CHECK-style predicates, long form ``(id..., rule)``.

    A CHECK passes on UNKNOWN, so a row violates ``pred`` only when
    ``coalesce(pred, true)`` is false.  All predicates are evaluated in one
    projection and exploded once.
    """
    broken = F.array(*[F.when(~F.coalesce(check, F.lit(True)), F.lit(name)) for name, check in checks.items()])
    return df.select(*id_cols, F.explode(broken).alias("rule")).where("rule is not null")


def replace_slices(current: DataFrame, incoming: DataFrame, slice_cols: Sequence[str]) -> DataFrame:
    """New content of a sliced table: slices named in ``incoming`` replaced.

    Equivalent to ``DELETE WHERE slice IN (...)`` + ``INSERT``: rows of the
    other slices are kept untouched; rows withdrawn at the source vanish.
    On disk the same effect is one ``partitionOverwriteMode=dynamic`` write
    (see :func:`stratum.operators.publish.write_slices`).
    """
    slices = incoming.select(*slice_cols).distinct()
    kept = current.join(maybe_broadcast(slices), list(slice_cols), "left_anti")
    return kept.unionByName(incoming.select(*current.columns))


def typed_projection(stage: DataFrame, types: dict[str, str]) -> DataFrame:
    """Gold typing of a text stage: ANSI casts that *fail* on bad input.

    Silver already nulled invalid values (``try_cast``); a value that still
    does not cast here is a contract breach, so the load must stop.
    ``nullif(c, '')`` first, as the bulk load treats empty text as null.
    """
    cols = []
    for c in stage.columns:
        if c in types:
            cols.append(F.nullif(F.col(c), F.lit("")).cast(types[c]).alias(c)
                        if dict(stage.dtypes)[c] == "string" else F.col(c).cast(types[c]).alias(c))
        else:
            cols.append(F.col(c))
    return stage.select(*cols)




def audit_rows(results: DataFrame) -> DataFrame:
    """Audit table rows from load results ``(yr, dataset, staged, deleted, inserted)``; where the
    results name the ``source_member``, the ``output_key`` or the time ``loaded_at``, so do the rows."""
    return results.select(
        "yr", "dataset",
        *[c for c in ("source_member", "output_key") if c in results.columns],
        F.col("staged").cast("bigint").alias("source_rows"),
        F.col("deleted").cast("bigint").alias("deleted_rows"),
        F.col("inserted").cast("bigint").alias("inserted_rows"),
        *[c for c in ("loaded_at",) if c in results.columns],
    )


def audit_upsert(existing: DataFrame, incoming: DataFrame, key=("yr", "dataset")) -> DataFrame:
    """Last load wins per (year, dataset); other audit rows stay."""
    from stratum.operators.dims import upsert

    attrs = [c for c in incoming.columns if c not in key]
    return upsert(existing, incoming, list(key), attrs, fail_on_conflict=True)
