"""k-means with exact whole-number arithmetic and Ns-bounds.

Every vector keeps, for each centroid, its distance when it was last evaluated and the round of
that.  All centroids of all rounds stay known (k vectors a round).  A stored distance is
loosened by the norm of the centroid's *total* displacement since its evaluation, which is never more
than the sum of the drifts of the rounds between.  A vector whose own centroid's upper bound
lies below all other lower bounds keeps its centroid unseen; else its own distance is
evaluated, and then just those centroids whose bounds still fail.  Bounds are doubles with a margin
beyond their rounding; what lies within it is evaluated, in whole numbers, so ties go
to the smaller number exactly as in a full scan.

A round is one pass over a table of blocks of vectors with their bounds, which writes the next
one (the last one but it is then removed) together with a row of sums for each task.  Only the sums, k rows of
components, reach the driver.  A lost executor's blocks are read again from the shared folder; blocks are dealt by
place, so no vector, label or cluster however common makes a task larger.

Rows whose vector is null, of another length, or holds a null or a component that isn't finite are left
out.  Repeated rows and ids are vectors of their own; a null id is never a seed unless
too few others are there, and stays null.  With fewer than k vectors there are as many centroids as
vectors; an empty table gives an empty result.  Only the id and the vector are read, other columns may have any name.
A distance that doesn't fit a long is null.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm import vectors as V
from stratum.llm.common import remove, scratch, written

#: Vectors in a block.
BLOCK_ROWS = 4096
#: Margin of the bounds, relative and absolute; their rounding is below 1e-14 of the distances.
MARGIN, LEAST = 1e-9, 1e-6

_STATE = "ids array<long>, data binary, near binary, bound binary, at binary, sums array<string>"


class Bounded:
    """Vectors with their nearest centroid, last evaluated distances and the rounds of these."""

    def __init__(self, x: np.ndarray, near=None, bound=None, at=None):
        self.x, self.near, self.bound, self.at = x, near, bound, at
        self.evaluated = 0

    def reassign(self, history: list[np.ndarray]) -> None:
        """Nearest centroids of the last round in ``history``."""
        now = len(history) - 1
        x, centres = V.fitted(self.x, history[now])
        if self.near is None:
            far = V.squared_to_all(x, centres)
            self.near, self.bound = far.argmin(axis=1).astype(np.int16), V.roots(far)
            self.at = np.full(far.shape, now, dtype=np.int16)
            self.evaluated += far.size
            return
        moved = np.stack([V.roots(V.squared(*V.fitted(c, history[now]))) for c in history])
        loose = moved[self.at, np.arange(len(centres))]
        lower = self.bound - loose - MARGIN * (self.bound + loose) - LEAST
        rows = np.arange(len(x))
        lower[rows, self.near] = np.inf
        upper = self.bound[rows, self.near] + loose[rows, self.near]
        fails = np.flatnonzero((lower <= upper[:, None]).any(axis=1))
        own = V.squared(x[fails], centres[self.near[fails]])
        self.bound[fails, self.near[fails]] = V.roots(own)
        self.at[fails, self.near[fails]] = now
        self.evaluated += len(fails)
        still = lower[fails] <= self.bound[fails, self.near[fails]][:, None]
        some = still.any(axis=1)
        fails, still, own = fails[some], still[some], own[some]
        for k in np.flatnonzero(still.any(axis=0)).tolist():
            mine = fails[still[:, k]]
            far = V.squared(x[mine], centres[k])
            self.bound[mine, k], self.at[mine, k] = V.roots(far), now
            self.evaluated += len(mine)
            best = own[still[:, k]]
            closer = (far < best) | ((far == best) & (k < self.near[mine]))
            self.near[mine[closer]] = k
            best[closer] = far[closer]
            own[still[:, k]] = best

    def packed(self, ids: pa.Array) -> pa.RecordBatch:
        small = not self.x.size or np.abs(self.x).max() < 1 << 31
        data = zstandard.compress(self.x.astype("<i4" if small else "<f8").tobytes(), 3)
        return _row(ids.to_pylist(), data, self.near.tobytes(), self.bound.tobytes(), self.at.tobytes(), None)

    @staticmethod
    def unpacked(row: dict, dim: int) -> Bounded:
        near = np.frombuffer(row["near"], dtype=np.int16).copy()
        raw, n = zstandard.decompress(row["data"]), len(near)
        x = np.frombuffer(raw, dtype="<i4" if len(raw) == 4 * n * dim else "<f8").reshape(n, dim).astype(np.float64)
        return Bounded(x, near, np.frombuffer(row["bound"]).reshape(n, -1).copy(),
                       np.frombuffer(row["at"], dtype=np.int16).reshape(n, -1).copy())


def _row(*values) -> pa.RecordBatch:
    kinds = (pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.string()))
    names = [field.split()[0] for field in _STATE.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)


def _kept_blocks(batches, dim: int, scale: int):
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(start, BLOCK_ROWS)
            at, values = V.whole(part, dim, scale)
            if len(at):
                yield part.column(0).take(pa.array(at)), Bounded(values)


def _written_blocks(batches, dim: int):
    for batch in batches:
        for row in batch.to_pylist():
            yield pa.array(row["ids"], pa.int64()), Bounded.unpacked(row, dim)


def _pass(blocks, history: list[np.ndarray]):
    """A round of one task: its blocks with new bounds, and at the end its sums for each centroid."""
    sums = V.no_sums(len(history[0]), history[0].shape[1] + 1)
    for ids, block in blocks:
        block.reassign(history)
        V.added(sums, block.near, block.x)
        yield block.packed(ids)
    yield _row(None, None, None, None, None, V.texts_of(sums))


def kmeans(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 8, rounds: int = 10, dim: int = 64,
           scale: int = 1024, seed: int = 3) -> tuple[DataFrame, np.ndarray]:
    """``id_col``, ``cluster`` and squared ``distance`` of each kept vector, and the final centroids.

    Centroids start as the k kept vectors with the smallest sha256 of ``<seed>:<id>``.
    """
    spark = vectors.sparkSession
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).asc_nulls_last()
    history = [V.smallest(vectors, id_col, vec_col, dim, scale, k, [order])]
    source = V.selected(vectors, id_col, vec_col)
    if not len(history[0]):
        return spark.createDataFrame([], "id long, cluster int, distance long").withColumnRenamed("id", id_col), history[0]
    work, state = scratch(spark, "kmeans"), None
    for number in range(rounds):
        state = written(_round(source, state, history, dim, scale), "state", f"{work}/{number}")
        remove(spark, f"{work}/{number - 1}")  # it has been read
        centres = V.means(V.totals(state, len(history[0]), dim + 1), history[-1])
        if (centres == history[-1]).all():  # nothing moves from here on
            break
        history.append(centres)

    resumed = state is not None

    def final(batches):
        blocks = _written_blocks(batches, dim) if resumed else _kept_blocks(batches, dim, scale)
        for ids, block in blocks:
            block.reassign(history)
            x, centres = V.fitted(block.x, history[-1])
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(block.near.astype(np.int32)), V.longs(V.squared(x, centres[block.near]))],
                ["id", "cluster", "distance"])

    rows = _blocks_of(state) if resumed else source
    found = written(rows.mapInArrow(final, "id long, cluster int, distance long"), "kmeans-rows")
    remove(spark, work)
    return found.withColumnRenamed("id", id_col), history[-1]


def _blocks_of(state: DataFrame) -> DataFrame:
    return state.where("data is not null").drop("sums")


def _round(source: DataFrame, state: DataFrame | None, history: list[np.ndarray], dim: int, scale: int) -> DataFrame:
    def pass_(batches):
        blocks = _written_blocks(batches, dim) if resumed else _kept_blocks(batches, dim, scale)
        yield from _pass(blocks, history)

    resumed = state is not None
    return (_blocks_of(state) if resumed else source).mapInArrow(pass_, _STATE)


def summarised(found: DataFrame, centres: np.ndarray) -> DataFrame:
    """The rows of ``kmeans`` with ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` (of its components, comma-joined)."""
    spark = found.sparkSession
    sums = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(  # a row for each centroid
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    total = sum(int(s or 0) for s in sums.values())
    rows = [(c, Decimal(int(s or 0)), Decimal(total), hashlib.sha256(",".join(V.numbers(centres[c])).encode()).hexdigest()) for c, s in sums.items()]
    of = spark.createDataFrame(rows, "cluster int, cluster_inertia decimal(38,0), inertia decimal(38,0), centroid_sha256 string")
    joined = found.join(F.broadcast(of), "cluster")  # one row for each centroid
    return joined.select(*found.columns, *(F.col(c).try_cast("long").alias(c) for c in ("cluster_inertia", "inertia")), "centroid_sha256")
