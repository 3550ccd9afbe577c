"""Star-schema views and the analytical aggregates over them."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.session import maybe_broadcast


@dataclass(frozen=True)
class DimJoin:
    """A dimension and the columns the fact joins it on (same names)."""

    dim: DataFrame
    on: tuple[str, ...]
    small: bool = False  # bounded by definition: broadcast when its estimate is under the cap


def star_view(fact: DataFrame, dims: Sequence[DimJoin], columns: Sequence[str | Column]) -> DataFrame:
    """Denormalised view: fact joined to every dimension, ids projected away.

    Inner joins, as the views do.  Dimensions marked ``small`` have a size
    bound that does not grow with the data and are broadcast when Catalyst's
    estimate confirms it (:func:`stratum.session.maybe_broadcast`); the
    others are left to Catalyst's size statistics and AQE.
    """
    out = fact
    for d in dims:
        dim = maybe_broadcast(d.dim) if d.small else d.dim
        out = out.join(dim, list(d.on))
    return out.select(*columns)


def aggregate_through_star(
    fact: DataFrame,
    fact_keys: Sequence[str],
    measures: dict[str, Column],
    dims: Sequence[DimJoin],
    group_by: Sequence[str],
    final: dict[str, Column],
) -> DataFrame:
    """Aggregate a fact by dimension attributes, pre-aggregating on ids first.

    1. partial/final aggregation of the fact on its foreign keys (map-side
       combine; a hot key costs one partial row per task),
    2. join the much smaller result to the dimensions,
    3. re-aggregate on the attributes (two ids may share one attribute).
    The result equals aggregating the full join, with the big shuffle of the
    join replaced by an aggregation shuffle of already reduced rows.
    """
    reduced = fact.groupBy(*fact_keys).agg(*[c.alias(n) for n, c in measures.items()])
    joined = reduced
    for d in dims:
        dim = maybe_broadcast(d.dim) if d.small else d.dim
        joined = joined.join(dim, list(d.on))
    return joined.groupBy(*group_by).agg(*[c.alias(n) for n, c in final.items()])


def total_by(view: DataFrame, group_by: Sequence[str], measure: str, alias: str,
             precision: str = "decimal(38,2)") -> DataFrame:
    """``SELECT g..., SUM(measure) AS alias ... GROUP BY g... ORDER BY g...``."""
    return (
        view.groupBy(*group_by)
        .agg(F.sum(measure).cast(precision).alias(alias))
        .orderBy(*group_by)
    )


def rows_per_partition(df: DataFrame, partition_col: str) -> DataFrame:
    """Row count per physical partition value, ordered."""
    return (
        df.groupBy(partition_col)
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(partition_col)
    )
