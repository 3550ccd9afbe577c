"""Blocks of documents, and hashes of their bytes.

A block is some ``BLOCK_BYTES`` of whole texts, written once as a table, so that
later passes over the same block see the same texts under the same number
whatever executor runs them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import slices, utf8, written

#: Bytes of text in a block, unless one text has more.
BLOCK_BYTES = 1 << 20

_RNG = np.random.Generator(np.random.PCG64(20240607))
#: A random value for each byte, and an odd base with its inverse modulo 2^64.
BYTE_VALUES = _RNG.integers(1, 1 << 63, size=256, dtype=np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))

_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """``base`` to the powers 0 to n - 1 modulo 2^64."""
    known = _powers.get(int(base))
    if known is None or len(known) < n:
        size = max(n, BLOCK_BYTES + 4096)
        values = np.full(size, base, dtype=np.uint64)
        values[0] = 1
        known = _powers[int(base)] = np.multiply.accumulate(values)
    return known[:n]


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit integers that spreads them."""
    x = x + np.uint64((salt * 0xD1B54A32D192ED03) & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hashes:
    """Hashes of any ranges of a buffer of bytes, from sums over its beginnings."""

    def __init__(self, buffer: np.ndarray):
        sums = np.empty(len(buffer) + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(BYTE_VALUES[buffer] * powers(BASE, len(buffer)), out=sums[1:])
        self.sums, self.inverse = sums, powers(INVERSE, len(buffer) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.inverse[start])

    def of_all(self, size: int) -> np.ndarray:
        """Of every range of ``size`` bytes."""
        n = len(self.sums) - size
        return mixed((self.sums[size:] - self.sums[:n]) * self.inverse[:n]) if n > 0 else np.empty(0, np.uint64)


def blocks(docs: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The written table of ``block`` (its number), ``ids`` (long; an id's row may repeat), ``sizes``
    (bytes of each text as 64-bit integers) and ``data`` (all texts, compressed).  Null texts are empty."""

    def gathered(batches):
        from pyspark import TaskContext
        first, n = TaskContext.get().partitionId() << 33, 0
        held, size = [], 0
        for batch in slices(batches):
            for row in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                if size and size + len(row[1] or b"") > block_bytes:
                    yield _block(first + n, held)
                    held, size, n = [], 0, n + 1
                held.append(row)
                size += len(row[1] or b"")
        if held:
            yield _block(first + n, held)

    frame = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        gathered, "block long, ids array<long>, sizes binary, data binary")
    return written(frame, "blocks")


def _block(number: int, held: list) -> pa.RecordBatch:
    sizes = np.array([len(text or b"") for _, text in held], dtype=np.int64)
    data = zstandard.compress(b"".join(text or b"" for _, text in held), 3)
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int64()), pa.array([[i for i, _ in held]], pa.list_(pa.int64())),
         pa.array([sizes.tobytes()], pa.binary()), pa.array([data], pa.binary())], ["block", "ids", "sizes", "data"])


class Block:
    """A block's texts in one buffer; ``starts`` has one entry more than there are texts."""

    def __init__(self, ids: list[int | None], sizes: bytes, data: bytes):
        self.ids = ids
        self.starts = np.concatenate([[0], np.cumsum(np.frombuffer(sizes, dtype=np.int64))]).astype(np.int64)
        self.bytes = zstandard.decompress(data, max_output_size=int(self.starts[-1])) if self.starts[-1] else b""
        self.buffer = np.frombuffer(self.bytes, dtype=np.uint8)


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays in one compressed string; ``unpacked`` needs their types."""
    head = np.array([len(a) for a in arrays], dtype=np.int64).tobytes()
    return zstandard.compress(head + b"".join(a.tobytes() for a in arrays), 3)


def unpacked(data: bytes, *types) -> list[np.ndarray]:
    raw = zstandard.decompress(data)
    sizes = np.frombuffer(raw, dtype=np.int64, count=len(types))
    out, at = [], 8 * len(types)
    for n, t in zip(sizes.tolist(), map(np.dtype, types)):
        out.append(np.frombuffer(raw, dtype=t, count=n, offset=at))
        at += n * t.itemsize
    return out
