"""Product codes of vectors: a codebook for each part of a vector, searched by Orchard's method.

Every entry of a codebook has a list of the others, sorted by distance.  A search starts at some
entry and goes down its list; an entry that is nearer than the best one is the new best, whose
list is gone down next.  Entries once seen are marked and not evaluated again.  Beyond twice
the best distance no entry of the best one's list can be nearer or as near, so the search ends
there; at twice the distance one may be as near and have the smaller number, so it is still looked at.
All parts of a batch search side by side, a step of each at a time, in whole numbers.

A round of training is one pass over the vectors where they lie; each task returns a row of sums for each entry, and
only these, added up, reach the driver.  Nothing is shuffled but sums, so no vector however common
weighs on one task, and a lost task is read again.

Rows whose vector is null, of another length, or holds a null or a component that isn't finite are left out.
Repeated rows and ids have a code each; null ids come last among the first entries and stay null.  With fewer
vectors than entries there are as many entries as vectors; an empty table gives an empty result.  Labels may be
null, which are added up together.  Other columns may have any name.  Sums that don't fit a long are null.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm import vectors as V
from stratum.llm.common import written


class Orchard:
    """A codebook with its entries' sorted neighbour lists."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        (whole,) = V.fitted(entries)
        gaps = V.squared_to_all(whole, whole)
        own = np.arange(len(entries))
        # an entry's own place is left out of its list, whatever else lies at distance 0
        lists = [sorted((j for j in own.tolist() if j != i), key=lambda j, i=i: (gaps[i, j], j)) for i in own.tolist()]
        self.lists = np.array(lists, dtype=np.int64).reshape(len(entries), max(0, len(entries) - 1))
        self.level = np.argsort(np.array([float(sum(e)) for e in entries]), kind="stable")

    def start(self, x: np.ndarray) -> np.ndarray:
        """An entry with about the same sum of components."""
        sums = np.array([float(sum(self.entries[i])) for i in self.level])
        at = np.clip(np.searchsorted(sums, x.sum(axis=1).astype(np.float64)), 0, len(sums) - 1)
        return self.level[at]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The nearest entry of each row (ties to the smaller number), the squared distance, and how many were evaluated."""
        x, entries = V.fitted(x, self.entries)
        best = self.start(x)
        far = V.squared(x, entries[best])
        seen = np.zeros((len(x), len(entries)), dtype=bool)
        seen[np.arange(len(x)), best] = True
        evaluated, place = len(x), np.zeros(len(x), dtype=np.int64)
        going = np.arange(len(x)) if self.lists.shape[1] else np.empty(0, dtype=np.int64)
        while len(going):
            entry = self.lists[best[going], place[going]]
            gap = V.squared(entries[best[going]], entries[entry])
            within = gap <= 4 * far[going]
            going, entry = going[within], entry[within]
            new = ~seen[going, entry]
            look, of = going[new], entry[new]
            seen[look, of] = True
            evaluated += len(look)
            apart = V.squared(x[look], entries[of])
            nearer = (apart < far[look]) | ((apart == far[look]) & (of < best[look]))
            place[going] += 1
            jumps = look[nearer]
            best[jumps], far[jumps], place[jumps] = of[nearer], apart[nearer], 0
            going = going[place[going] < self.lists.shape[1]]
        return best, far, evaluated


@dataclass(frozen=True)
class Codebooks:
    """A codebook for each of the equal consecutive parts of a vector."""

    entries: np.ndarray  # parts x entries x components, Python integers

    def sha256(self) -> str:
        return hashlib.sha256(",".join(V.numbers(self.entries)).encode()).hexdigest()

    def decoded(self, code: str) -> list[int]:
        """The vector that a code stands for."""
        return [v for p, i in enumerate(bytes.fromhex(code)) for v in self.entries[p][i]]


def _parts(values: np.ndarray, n_parts: int) -> np.ndarray:
    return values.reshape(len(values), n_parts, values.shape[1] // n_parts)


def train(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", n_parts: int = 8, n_entries: int = 16,
          rounds: int = 6, dim: int = 64, scale: int = 4096) -> Codebooks:
    """Codebooks that start as the parts of the vectors with the smallest ids and are moved ``rounds`` times to the
    floored means of the parts nearest to them, over all vectors."""
    if not 0 < n_entries <= 256 or dim % n_parts:
        raise ValueError("a code has a byte for each part, and parts are equal")
    first = V.smallest(vectors, id_col, vec_col, dim, scale, n_entries, [F.col("id").asc_nulls_last()])
    width = dim // n_parts
    entries = first.reshape(len(first), n_parts, width).swapaxes(0, 1)
    source = V.selected(vectors, id_col, vec_col)
    for _ in range(rounds if len(first) else 0):
        sums = V.totals(source.mapInArrow(_summing(entries, n_parts, dim, scale), "sums array<string>"), n_parts, len(first), width + 1)
        moved = V.means(sums, entries)
        if (moved == entries).all():  # nothing moves from here on
            break
        entries = moved
    return Codebooks(entries)


def _summing(entries: np.ndarray, n_parts: int, dim: int, scale: int):
    def sums_of(batches):
        books = [Orchard(e) for e in entries]
        sums = V.no_sums(n_parts, entries.shape[1], entries.shape[2] + 1)
        for batch in batches:
            parts = _parts(V.whole(batch, dim, scale)[1], n_parts)
            for p, book in enumerate(books):
                V.added(sums[p], book.nearest(parts[:, p])[0], parts[:, p])
        yield pa.RecordBatch.from_arrays([pa.array([V.texts_of(sums)], pa.list_(pa.string()))], ["sums"])

    return sums_of


def encode(vectors: DataFrame, books: Codebooks, id_col: str = "vec_id", vec_col: str = "embedding", keep_cols: tuple[str, ...] = (),
           dim: int = 64, scale: int = 4096) -> DataFrame:
    """``id_col``, ``keep_cols``, ``code`` (two hex digits a part) and ``error``, the squared distance to what the code stands for."""
    kinds = [vectors.schema[c].dataType.simpleString() for c in keep_cols]
    entries, n_parts = books.entries, len(books.entries)

    def coded(batches):
        searched = [Orchard(e) for e in entries] if entries.shape[1] else []
        for batch in batches:
            at, values = V.whole(batch, dim, scale)
            rows, parts = batch.take(pa.array(at)), _parts(values, n_parts)
            codes, errors = np.zeros((len(at), n_parts), dtype=np.uint8), np.zeros(len(at), dtype=object)
            for p, book in enumerate(searched):
                codes[:, p], far, _ = book.nearest(parts[:, p])
                errors += np.array([int(v) for v in far], dtype=object)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), *rows.columns[2:], pa.array([c.tobytes().hex() for c in codes], pa.string()), V.longs(errors)],
                names)

    names = ["id", *(f"other_{i}" for i in range(len(kinds))), "code", "error"]
    schema = ", ".join(f"{n} {k}" for n, k in zip(names, ["long", *kinds, "string", "long"]))
    found = V.selected(vectors, id_col, vec_col, *keep_cols).mapInArrow(coded, schema)
    return found.select(F.col("id").alias(id_col), *(F.col(f"other_{i}").alias(c) for i, c in enumerate(keep_cols)), "code", "error")


def error_by(found: DataFrame, column: str) -> DataFrame:
    """The rows of ``encode`` with ``<column>_error``, the error added up over equal values (nulls together).

    Sums come from partial aggregates; the join back is left to adaptive execution, which broadcasts few
    values and splits one with very many rows.
    """
    rows = written(found, "codes")
    sums = written(rows.groupBy(F.col(column).alias("_of")).agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("_sum")), "code-errors")
    return rows.join(sums, F.col(column).eqNullSafe(F.col("_of"))).select(
        *(rows[c] for c in found.columns), F.col("_sum").try_cast("long").alias(f"{column}_error"))
