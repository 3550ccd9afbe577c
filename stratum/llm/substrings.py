"""Exact substring removal by a suffix array that is range-partitioned over the cluster.

Texts are bytes; a *window* is ``length`` bytes inside one document.  A byte is
removed if a window that covers it also starts in a document with a smaller id.

A suffix for every byte would multiply the input, so suffixes are sorted from
*anchors*: of the grams (``GRAM`` bytes) in a window the one whose hash is
smallest.  Equal windows have the same anchor at the same place, so they meet at
it; an anchor serves a run of neighbouring windows, about one anchor for sixteen.

1. Documents are written in blocks.  Each block sends the hashes of its anchors'
   grams, each once, to buckets, which are ranges of the suffixes' leading bytes
   between splitters sampled from some blocks.  A bucket answers which grams other
   documents have too, with a bit each; nothing else of unrepeated text moves.
2. For those, a block sends each distinct context (the bytes of an anchor's
   windows) once, with the smallest id it has there.  So a passage that a third of
   all documents share is one row for each block, not for each copy.
3. A bucket sorts contexts, folds equal ones, and sorts the suffixes that start
   at their windows by multikey quicksort, eight bytes a digit: only suffixes that
   tie so far are sorted on.  Neighbours equal over ``length`` bytes are a group; its
   smallest id goes back to the blocks.  A leading value that is so frequent
   that it takes several buckets is dealt among them by its whole gram, so equal
   windows never lie on two sides of a boundary and nothing is left to compare
   across it.
4. Blocks mark the windows whose smallest id is below their document's and remove
   the bytes these cover.

Null texts are empty.  Rows with equal ids don't remove from each other.  A null
id is neither below nor above another: its row removes nothing and keeps all.
Texts shorter than a window stay whole.  Every row gives a row; other columns
aren't read.  Empty tables give empty results.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.blocks import Block, Hashes, blocks, packed, unpacked
from stratum.llm.common import written

#: Bytes of a window, and of a gram.
LENGTH, GRAM = 50, 20
#: Anchors for a bucket; sampled blocks and values of each; most splitters (their table is broadcast).
BUCKET_ANCHORS = 200_000
SAMPLE_BLOCKS, SAMPLE_VALUES, MAX_SPLITTERS = 64, 1000, 1 << 16

_NO_ID = np.iinfo(np.int64).max


def big_endian(buffer: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes from each place as an integer that sorts like them; the buffer has eight to spare."""
    view = np.lib.stride_tricks.as_strided(buffer, shape=(len(buffer) - 7, 8), strides=(1, 1))
    return view[at].view(">u8").ravel().astype(np.uint64)


class Anchors:
    """The anchors of a block: place, first and last window served, document's row."""

    def __init__(self, block: Block, length: int = LENGTH, gram: int = GRAM):
        self.block, self.length = block, length
        none = np.empty(0, dtype=np.int64)
        self.at = self.first = self.last = self.row = none
        self.hashes = Hashes(block.buffer)
        n = len(block.buffer) - length + 1
        if n <= 0:
            return
        bits = np.uint64(max(1, int(len(block.buffer)).bit_length()))
        values = self.hashes.of_all(gram) >> bits << bits
        values |= np.arange(len(values), dtype=np.uint64)  # of equal hashes the leftmost
        span = length - gram + 1
        width = 1
        while 2 * width <= span:
            values = np.minimum(values[:-width], values[width:])
            width *= 2
        if span > width:
            values = np.minimum(values[:width - span], values[span - width:])
        anchor = (values & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        row = np.repeat(np.arange(len(block.ids)), np.diff(block.starts))[:n]
        known = np.array([i is not None for i in block.ids], dtype=bool)
        inside = (np.arange(n) + length <= block.starts[1:][row]) & known[row]
        places = np.flatnonzero(inside)
        if not len(places):
            return
        anchor, row = anchor[places], row[places]
        new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])]))
        self.at, self.row, self.first = anchor[new], row[new], places[new]
        self.last = places[np.append(new[1:], len(places)) - 1]
        padded = np.concatenate([block.buffer, np.zeros(8, dtype=np.uint8)])
        self.lead = big_endian(padded, self.at)
        self.gram = self.hashes.of(self.at, self.at + gram) & np.uint64((1 << 48) - 1)

    def buckets(self, splitters: np.ndarray, parts: int) -> np.ndarray:
        """Ranges of the leading bytes; a value that is itself a splitter, several times perhaps, is dealt by its gram."""
        low = np.searchsorted(splitters, self.lead, "left")
        high = np.searchsorted(splitters, self.lead, "right")
        spread = (self.gram % (high - low + 1).astype(np.uint64)).astype(np.int64)
        return (low + spread) * parts + (self.gram >> np.uint64(16)).astype(np.int64) % parts


def _ids(block: Block) -> np.ndarray:
    return np.array([_NO_ID if i is None else i for i in block.ids], dtype=np.int64)


class Grams:
    """A block's distinct grams, by bucket and hash, and whether two of its documents have them."""

    def __init__(self, anchors: Anchors, splitters: np.ndarray, parts: int):
        if not len(anchors.at):
            self.bucket = self.inverse = np.empty(0, dtype=np.int64)
            self.hash, self.several = np.empty(0, dtype=np.uint64), np.empty(0, dtype=bool)
            return
        buckets = anchors.buckets(splitters, parts)
        ids = _ids(anchors.block)[anchors.row]
        order = np.lexsort((ids, anchors.gram, buckets))
        b, g, i = buckets[order], anchors.gram[order], ids[order]
        new = np.concatenate([[True], (b[1:] != b[:-1]) | (g[1:] != g[:-1])])
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(b)) - 1
        self.bucket, self.hash, self.several = b[starts], g[starts], i[starts] != i[ends]
        self.inverse = np.empty(len(b), dtype=np.int64)
        self.inverse[order] = np.cumsum(new) - 1

    def parts(self):
        """Bucket and range of its grams."""
        if len(self.bucket):
            starts = np.flatnonzero(np.concatenate([[True], self.bucket[1:] != self.bucket[:-1]]))
            yield from zip(self.bucket[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(self.bucket)])


class Contexts:
    """A block's distinct contexts of the anchors whose gram is repeated, by bucket."""

    def __init__(self, anchors: Anchors, grams: Grams, repeated: np.ndarray):
        self.chosen = np.flatnonzero(repeated[grams.inverse]) if len(grams.inverse) else np.empty(0, dtype=np.int64)
        c = self.chosen
        first, last, at = anchors.first[c], anchors.last[c], anchors.at[c]
        if not len(c):
            self.bucket = self.inverse = np.empty(0, dtype=np.int64)
            return
        key = anchors.hashes.of(first, last + anchors.length)
        ids, bucket = _ids(anchors.block)[anchors.row[c]], grams.bucket[grams.inverse[c]]
        order = np.lexsort((ids, at - first, last - first, key, bucket))
        columns = [x[order] for x in (bucket, key, last - first, at - first)]
        new = np.concatenate([[True], np.any([x[1:] != x[:-1] for x in columns], axis=0)])
        lead = order[new]
        self.bucket, self.first, self.windows = bucket[lead], first[lead], (last - first)[lead] + 1
        self.before, self.least = (at - first)[lead], ids[lead]
        self.inverse = np.empty(len(c), dtype=np.int64)
        self.inverse[order] = np.cumsum(new) - 1

    def parts(self, anchors: Anchors):
        if len(self.bucket):
            starts = np.flatnonzero(np.concatenate([[True], self.bucket[1:] != self.bucket[:-1]]))
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(self.bucket)]):
                sizes = self.windows[a:b] + anchors.length - 1
                text = anchors.block.buffer[_ranges(self.first[a:b], sizes)]
                yield int(self.bucket[a]), packed(self.before[a:b].astype(np.uint8), self.windows[a:b].astype(np.uint8),
                                                  self.least[a:b], text)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of ranges, one range after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def multikey_groups(buffer: np.ndarray, starts: np.ndarray, length: int, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at ``starts`` over ``length`` bytes within ``group``, and the number of each one's
    class of equals in that order.  Digits are eight bytes; each round sorts only suffixes that still tie."""
    order = np.argsort(group, kind="stable")
    tied = np.cumsum(np.concatenate([[0], group[order][1:] != group[order][:-1]])) if len(group) else order
    for digit in range(0, length, 8):
        size = np.bincount(tied) if len(tied) else np.zeros(1, dtype=np.int64)
        loose = np.flatnonzero(size[tied] > 1)
        if not len(loose):
            break
        values = big_endian(buffer, starts[order[loose]] + digit)
        if length - digit < 8:
            values >>= np.uint64(8 * (8 - length + digit))
        again = np.lexsort((values, tied[loose]))
        order[loose] = order[loose[again]]
        values = values[again]
        new = np.concatenate([[0], tied[1:] != tied[:-1]])
        inner = np.flatnonzero((np.diff(loose) == 1) & (tied[loose[1:]] == tied[loose[:-1]]) & (values[1:] != values[:-1]))
        new[loose[inner + 1]] = 1
        tied = np.cumsum(new)
    return order, tied


def least_ids(parts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each block's contexts in a bucket, the smallest id that has each of their windows."""
    read = [unpacked(p, np.uint8, np.uint8, np.int64, np.uint8) for p in parts]
    before, windows, least, text = (np.concatenate(x) for x in zip(*read))
    before, windows = before.astype(np.int64), windows.astype(np.int64)
    sizes = windows + length - 1
    buffer = np.concatenate([text, np.zeros(8, dtype=np.uint8)])
    starts = np.cumsum(sizes) - sizes
    # equal contexts are folded; they are as long as each other and have their anchor at the same place
    shape = before << 8 | windows
    order = np.arange(len(starts))
    same = np.empty(len(starts), dtype=np.int64)
    found = 0
    for s in np.unique(shape):
        of = np.flatnonzero(shape == s)
        ranked, tied = multikey_groups(buffer, starts[of], int(sizes[of[0]]), np.zeros(len(of), dtype=np.int64))
        same[of[ranked]] = tied + found
        found += int(tied[-1]) + 1
    order = np.argsort(same, kind="stable")
    lead = order[np.concatenate([[True], same[order][1:] != same[order][:-1]])]
    folded = np.minimum.reduceat(least[order], np.flatnonzero(np.concatenate([[True], same[order][1:] != same[order][:-1]])))
    # the suffixes at the windows of the distinct contexts; windows that are equal have the anchor at the same place
    n = windows[lead]
    at = _ranges(starts[lead], n)
    offset = np.repeat(before[lead], n) - (at - np.repeat(starts[lead], n))
    owner = np.repeat(np.arange(len(lead)), n)
    ranked, tied = multikey_groups(buffer, at, length, offset)
    edge = np.flatnonzero(np.concatenate([[True], tied[1:] != tied[:-1]]))
    best = np.empty(len(at), dtype=np.int64)
    best[ranked] = np.minimum.reduceat(folded[owner[ranked]], edge)[tied]
    ends = np.cumsum(n)
    whole = best[_ranges((ends - n)[same], windows)]
    cuts = np.cumsum([int(r[1].astype(np.int64).sum()) for r in read])[:-1]
    return np.split(whole, cuts)


def _answers(table: pa.Table) -> tuple[dict[int, bytes], dict[int, bytes]]:
    """A block's answers by bucket: bits of its grams, smallest ids of its contexts."""
    bits, least = {}, {}
    for bucket, kind, data in zip(*(table.column(c).to_pylist() for c in ("bucket", "kind", "data"))):
        (bits if kind == "grams" else least)[bucket] = data
    return bits, least


def _repeated(grams: Grams, bits: dict[int, bytes]) -> np.ndarray:
    out = np.zeros(len(grams.bucket), dtype=bool)
    for bucket, a, b in grams.parts():
        if bucket in bits:
            out[a:b] = np.unpackbits(np.frombuffer(bits[bucket], dtype=np.uint8), count=b - a).astype(bool)
    return out


def _block_of(table: pa.Table) -> tuple[int, Block] | None:
    if not table.num_rows:
        return None
    row = {c: table.column(c)[0].as_py() for c in ("block", "ids", "sizes", "data")}
    return row["block"], Block(row["ids"], row["sizes"], row["data"])


def removal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
            gram: int = GRAM) -> DataFrame:
    """For each row ``id_col``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), ``kept_sha256``
    and the remaining bytes as ``kept`` binary."""
    spark = docs.sparkSession
    texts = blocks(docs, id_col, text_col)
    total = texts.agg(F.count("*").alias("n"), F.sum(F.length("sizes") / 8).alias("rows")).first()
    splitters, parts = _splitters(texts, total["n"], length, gram)
    shared = spark.sparkContext.broadcast((splitters, parts))

    def grams(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                number, block = _block_of(pa.Table.from_batches([batch.slice(i, 1)]))
                found = Grams(Anchors(block, length, gram), *shared.value)
                rows = [(bucket, _six(found.hash[a:b]), np.packbits(found.several[a:b]).tobytes())
                        for bucket, a, b in found.parts()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64()), pa.array([number] * len(rows), pa.int64()),
                     *(pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2))], ["bucket", "block", "hashes", "several"])

    def counted(table):
        hashes = [_from_six(h) for h in table.column("hashes").to_pylist()]
        several = [np.unpackbits(np.frombuffer(s, dtype=np.uint8), count=len(h)) for s, h in
                   zip(table.column("several").to_pylist(), hashes)]
        values, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
        count = np.bincount(inverse, weights=np.concatenate(several) + 1.0, minlength=len(values))
        bits = np.split(count[inverse] > 1, np.cumsum([len(h) for h in hashes])[:-1])
        return _reply(table, "grams", [np.packbits(b).tobytes() for b in bits])

    def contexts(key, left, right):
        found = _block_of(left)
        rows = []
        if found:
            anchors = Anchors(found[1], length, gram)
            own = Grams(anchors, *shared.value)
            rows = list(Contexts(anchors, own, _repeated(own, _answers(right)[0])).parts(anchors))
        return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int64()),
                         "block": pa.array([key[0].as_py()] * len(rows), pa.int64()),
                         "data": pa.array([r[1] for r in rows], pa.binary())})

    def least(table):
        return _reply(table, "least", [packed(ids) for ids in least_ids(table.column("data").to_pylist(), length)])

    def cut(key, left, right):
        found = _block_of(left)
        return _cut(found[1], *_answers(right), shared.value, length, gram) if found else _RESULT.empty_table()

    reply = "block long, bucket long, kind string, data binary"
    bits = written(texts.mapInArrow(grams, "bucket long, block long, hashes binary, several binary")
                   .groupBy("bucket").applyInArrow(counted, reply), "repeated-grams")
    ids = (texts.groupBy("block").cogroup(bits.groupBy("block"))
           .applyInArrow(contexts, "bucket long, block long, data binary")
           .groupBy("bucket").applyInArrow(least, reply))
    return (texts.groupBy("block").cogroup(bits.unionByName(ids).groupBy("block"))
            .applyInArrow(cut, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
            .withColumnRenamed("id", id_col))


def _six(hashes: np.ndarray) -> bytes:
    return np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _from_six(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), dtype=np.uint8)
    out[:, :6] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel().astype(np.uint64)


def _reply(table: pa.Table, kind: str, data: list[bytes]) -> pa.Table:
    n = table.num_rows
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"),
                     "kind": pa.array([kind] * n, pa.string()), "data": pa.array(data, pa.binary())})


def _splitters(texts: DataFrame, n_blocks: int, length: int, gram: int) -> tuple[np.ndarray, int]:
    """Quantiles of the leading bytes of anchors in a bounded sample of blocks, and buckets for each range."""
    every = max(1, n_blocks // SAMPLE_BLOCKS)

    def leads(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                number, block = _block_of(pa.Table.from_batches([batch.slice(i, 1)]))
                anchors = Anchors(block, length, gram)
                n = len(anchors.at)
                chosen = anchors.lead[np.linspace(0, n - 1, min(n, SAMPLE_VALUES)).astype(np.int64)] if n else np.empty(0, np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([chosen.tobytes()], pa.binary())], ["n", "leads"])

    sample = texts.where(F.pmod(F.xxhash64("block"), F.lit(every)) == 0).mapInArrow(leads, "n long, leads binary").collect()
    anchors = sum(r["n"] for r in sample) * n_blocks // max(1, len(sample))
    n_buckets = max(1, -(-anchors // BUCKET_ANCHORS))
    values = np.sort(np.concatenate([np.empty(0, np.uint64), *(np.frombuffer(r["leads"], dtype=np.uint64) for r in sample)]))
    n_ranges = min(n_buckets, MAX_SPLITTERS)
    splitters = values[np.linspace(0, len(values), n_ranges + 1)[1:-1].astype(np.int64)] if len(values) else values
    return splitters, -(-n_buckets // n_ranges)


_RESULT = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                     ("kept_sha256", pa.string()), ("kept", pa.binary())])


def _cut(block: Block, bits: dict[int, bytes], least: dict[int, bytes], shared, length: int, gram: int) -> pa.Table:
    anchors = Anchors(block, length, gram)
    grams = Grams(anchors, *shared)
    contexts = Contexts(anchors, grams, _repeated(grams, bits))
    cover = np.zeros(len(block.buffer) + 1, dtype=np.int64)
    if len(contexts.bucket):
        found = np.concatenate([unpacked(least[b], np.int64)[0] for b in np.unique(contexts.bucket).tolist()])
        ends = np.cumsum(contexts.windows)
        own = contexts.windows[contexts.inverse]
        best = found[_ranges((ends - contexts.windows)[contexts.inverse], own)]
        starts = _ranges(anchors.first[contexts.chosen], own)
        ids = _ids(block)[anchors.row[contexts.chosen]]
        starts = starts[best < np.repeat(ids, own)]
        np.add.at(cover, starts, 1)
        np.add.at(cover, starts + length, -1)
    gone = np.cumsum(cover[:-1]) > 0
    rows = []
    for i, (a, b) in enumerate(zip(block.starts[:-1].tolist(), block.starts[1:].tolist())):
        own = gone[a:b]
        removed = int(own.sum())
        spans = int(own[0]) + int((own[1:] & ~own[:-1]).sum()) if removed else 0
        kept = block.buffer[a:b][~own].tobytes() if removed else block.bytes[a:b]
        rows.append((block.ids[i], b - a, removed, spans, hashlib.sha256(kept).hexdigest(), kept))
    columns = list(zip(*rows))
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, _RESULT)], schema=_RESULT)
