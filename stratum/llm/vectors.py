"""Vectors of whole numbers in Arrow batches, their exact squared distances, and sums from tasks.

A component x counts as floor(scale * x).  A vector is kept if it has the wanted number of components, none of
them null or not finite; one that scales to 2^62 or beyond can't be held and counts as not finite.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def selected(vectors: DataFrame, id_col: str, vec_col: str, *others: str) -> DataFrame:
    """The columns that ``whole`` reads: ``id``, ``vec``, and ``others`` under numbers."""
    return vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vec_col].cast("array<double>").alias("vec"),
                          *(vectors[c].alias(f"other_{i}") for i, c in enumerate(others)))


def whole(batch: pa.RecordBatch, dim: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a batch of ``selected`` the places of the rows that are kept, and their vectors (whole numbers, as doubles)."""
    column = batch.column(1)
    right = pc.fill_null(pc.equal(pc.list_value_length(column), dim), False).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(right)
    flat = column.take(pa.array(at)).flatten()
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(at), dim)  # null is nan
    with np.errstate(over="ignore", invalid="ignore"):
        values = np.floor(values * scale)
        held = (np.abs(values) < 2.0**62).all(axis=1)
    return at[held], values[held]


def fitted(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays in the narrowest type that holds sixteen times the squared distance of any two rows exactly."""
    most = max([1, *(int(np.abs(a).max()) for a in arrays if a.size)])
    bound = 64 * arrays[0].shape[-1] * most * most
    if bound < 1 << 53:
        return [a.astype(np.float64) for a in arrays]
    if bound < 1 << 63:
        return [a.astype(np.int64) for a in arrays]
    return [np.array([[int(v) for v in row] for row in a], dtype=object).reshape(a.shape) for a in arrays]


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of paired rows of ``fitted`` arrays."""
    apart = a - b
    return (apart * apart).sum(axis=-1)


def squared_to_all(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Exact squared distances of each row to each centre, of ``fitted`` arrays."""
    if x.dtype == np.float64:  # every term is a whole number below 2^53
        return (x * x).sum(axis=1)[:, None] - 2 * (x @ centres.T) + (centres * centres).sum(axis=1)
    return np.stack([squared(x, c) for c in centres], axis=1) if len(centres) else np.empty((len(x), 0))


def roots(values: np.ndarray) -> np.ndarray:
    return np.sqrt(values.astype(np.float64))


def longs(values: Iterable) -> pa.Array:
    """Whole numbers as longs; null where they don't fit."""
    return pa.array([v if v < 1 << 63 else None for v in map(int, values)], pa.int64())


def added(sums: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Add whole-numbered ``rows`` to the Python integers in ``sums`` at ``at``; a count comes last."""
    for i in np.unique(at):
        mine = rows[at == i]
        exact = mine.astype(np.int64) if not mine.size or np.abs(mine).max() < 1 << 40 else fitted(mine * 1.0)[0]
        sums[i, :-1] += np.array([int(v) for v in exact.sum(axis=0)], dtype=object)
        sums[i, -1] += len(mine)


def no_sums(*shape: int) -> np.ndarray:
    out = np.empty(shape, dtype=object)
    out.fill(0)
    return out


def texts_of(sums: np.ndarray) -> list[str]:
    return [str(v) for v in sums.ravel()]


def totals(tasks: DataFrame, *shape: int) -> np.ndarray:
    """The tasks' ``sums`` (arrays of numbers as text) added up; as many rows come to the driver as a task's sums have."""
    cells = tasks.where("sums is not null").select(F.posexplode("sums").alias("place", "v"))
    out = no_sums(int(np.prod(shape)))
    for row in cells.groupBy("place").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect():
        out[row["place"]] = int(row["v"])
    return out.reshape(shape)


def means(sums: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Componentwise floor(sum / count); without rows what was there before.  Object arrays of Python integers."""
    out = before.copy()
    for i in np.ndindex(sums.shape[:-1]):
        if sums[i][-1]:
            out[i] = [s // sums[i][-1] for s in sums[i][:-1]]
    return out


def integers(rows: Iterable) -> np.ndarray:
    """Rows of whole numbers as an object array of Python integers."""
    rows = [[int(v) for v in row] for row in rows]
    out = np.empty((len(rows), len(rows[0]) if rows else 0), dtype=object)
    for i, row in enumerate(rows):
        out[i] = row
    return out


def numbers(values: np.ndarray) -> Iterator[str]:
    return (str(int(v)) for v in values.ravel())


def smallest(vectors: DataFrame, id_col: str, vec_col: str, dim: int, scale: int, n: int, order) -> np.ndarray:
    """The ``n`` kept vectors that come first by ``order`` (columns over ``id``), ties by the vector."""
    def kept(batches):
        for batch in batches:
            at, values = whole(batch, dim, scale)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(list(values), pa.list_(pa.float64()))],
                                             ["id", "vec"])

    rows = selected(vectors, id_col, vec_col).mapInArrow(kept, "id long, vec array<double>")
    return integers(r["vec"] for r in rows.orderBy(*order, "vec").limit(n).collect())
