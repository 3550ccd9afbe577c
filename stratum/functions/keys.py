"""Natural and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def natural_key(*cols: Column | str, trim_first: tuple[int, ...] = ()) -> Column:
    """``a|b|c`` with null parts as empty text (the stored location key).

    Positions in ``trim_first`` are trimmed before joining (a blank-padded
    fixed-width column).  Blank and null coincide and a ``|`` inside a value
    can collide; join on the parts with :func:`null_safe_condition` instead.
    """
    parts = []
    for i, c in enumerate(cols):
        c = F.col(c) if isinstance(c, str) else c
        c = c.cast("string")
        if i in trim_first:
            c = F.trim(c)
        parts.append(F.coalesce(c, F.lit("")))
    return F.concat_ws("|", *parts)


def surrogate_key(*cols: Column | str) -> Column:
    """Stable 64-bit id from the natural key columns (xxhash64).

    Deterministic across runs and executors, so no sequence, no driver-side
    counter and no shuffle is needed.  The hash passes over nulls, so each
    part goes in with a mark of whether it is null.  Uniqueness is verified
    with :func:`stratum.operators.dims.check_surrogate_keys`.
    """
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.xxhash64(*[x for p in parts for x in (p.isNull(), p)])


def null_safe_condition(left, right, columns: tuple[str, ...]) -> Column:
    """Conjunction of ``left.c <=> right.c``; still an equi-join for Catalyst.

    ``left`` / ``right`` are DataFrames or alias names.
    """

    def ref(side, c: str) -> Column:
        return F.col(f"{side}.{c}") if isinstance(side, str) else side[c]

    cond = None
    for c in columns:
        term = ref(left, c).eqNullSafe(ref(right, c))
        cond = term if cond is None else cond & term
    return cond
