"""Benchmark decontamination by suffix arrays of the training texts.

The training texts are read in shards (an Arrow slice of documents).  A shard's
suffix array holds its word positions, sorted by the words that follow.  Every
benchmark suffix of ``window`` words (or a whole shorter item) is looked up by
binary search, which gives the range of positions where it occurs verbatim.
Occurrences that continue each other in item and document are joined into the
longest verbatim matches, with their places; documents with a match are removed.

Words of the training texts that no benchmark item holds have number 0, which
no benchmark suffix contains, so positions with a 0 inside the shortest suffix
sought can't match and aren't sorted.  Sorting is by words packed into 64-bit
keys, a key column at a time, over those that tie so far.

The benchmark goes to the tasks in blocks of ``block_bytes`` of text at most
(a longer item is a block of its own), one stage after another, so no broadcast
grows with it.  Documents never leave their row: there is no shuffle.

Null texts have no words.  Repeated documents are each judged.  An item without
words matches nothing; a repeated item counts once; an item without id marks
words as hit but names no item.  Empty tables give empty or clean results.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import kind, slices, utf8

#: Bytes of benchmark text in a block, which is broadcast.
BLOCK_BYTES = 8 << 20
#: Bytes of training text in a shard, unless one document has more.  A shard's keys and their order take some 20 times as much,
#: and a worker keeps the memory it had once.
SHARD_BYTES = 1 << 20

#: A-Z become a-z; ASCII characters that are neither letters nor digits become spaces.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
                   for c in range(256))

MATCH = "struct<item_id:string,item_start:bigint,doc_start:bigint,n_words:bigint>"
_MATCH = pa.struct([("item_id", pa.string()), ("item_start", pa.int64()),
                    ("doc_start", pa.int64()), ("n_words", pa.int64())])


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_BYTES).split() if text else []


class TestSuffixes:
    """The suffixes sought, of a block of benchmark items."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.items: list[str | None] = []
        self.places: list[list[tuple[int, int, int]]] = []  # of a suffix: ordinals of items, positions, words
        number: dict[tuple[int, ...], int] = {}
        lengths = defaultdict(list)
        for item, text in dict.fromkeys(items):
            self.items.append(item)
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            for start in range(max(len(ids) - window, 0) + 1 if ids else 0):
                suffix = tuple(ids[start:start + window])
                if suffix not in number:
                    number[suffix] = len(self.places)
                    self.places.append([])
                    lengths[len(suffix)].append(suffix)
                self.places[number[suffix]].append((len(self.items) - 1, start, len(suffix)))
        self.bits = max(len(self.vocabulary).bit_length(), 1)
        self.by_length = {n: (np.array(found, dtype=np.uint64), np.array([number[s] for s in found]))
                          for n, found in lengths.items()}
        self.shortest = min(lengths, default=0)

    def keys(self, word: Callable[[int], np.ndarray], rows: int, words: int, fill: int = 0) -> list[np.ndarray]:
        """Key columns of rows of words, as many words in a key as fit; rows that end early are filled.

        ``word`` gives the rows' k-th words, of ``words``, so no table of all words of all rows is made.
        """
        per, bits, columns = 64 // self.bits, np.uint64(self.bits), []
        filler = np.uint64(((1 << self.bits) - 1) * fill)
        for start in range(0, self.window, per):
            key = np.zeros(rows, dtype=np.uint64)
            for k in range(start, min(start + per, self.window)):
                key <<= bits
                key |= word(k) if k < words else filler
            columns.append(key)
        return columns

    def found(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in a shard's words and the numbers of the suffixes that start there."""
        none = np.empty(0, dtype=np.int64)
        if not self.shortest or not len(ids):
            return none, none
        known = np.concatenate([[0], np.cumsum(ids > 0)])
        last = len(ids) - self.shortest + 1
        if last <= 0:
            return none, none
        places = np.flatnonzero(known[self.shortest:][:last] - known[:last] == self.shortest)
        padded = np.concatenate([ids, np.zeros(self.window, dtype=ids.dtype)])
        columns = self.keys(lambda k: padded[places + k], len(places), self.window)
        order = sorted_suffixes(columns)
        places, columns = places[order], [c[order] for c in columns]
        at, which = [], []
        for n, (suffixes, numbers) in self.by_length.items():
            low, high = (self.keys(lambda k: suffixes[:, k], len(suffixes), n, fill) for fill in (0, 1))
            begin = np.searchsorted(columns[0], low[0], "left")
            end = np.searchsorted(columns[0], high[0], "right")
            for i in np.flatnonzero(begin < end).tolist():
                a, b = int(begin[i]), int(end[i])
                for column, lo, hi in zip(columns[1:], low[1:], high[1:]):
                    part = column[a:b]
                    a, b = (a + int(np.searchsorted(part, lo[i], "left")),
                            a + int(np.searchsorted(part, hi[i], "right")))
                    if a >= b or lo[i] != hi[i]:
                        break
                if a < b:
                    at.append(places[a:b])
                    which.append(np.full(b - a, numbers[i]))
        return (np.concatenate(at), np.concatenate(which)) if at else (none, none)

    def matches(self, ids: np.ndarray, starts: np.ndarray) -> dict[int, list[tuple]]:
        """Longest verbatim matches of a shard, by document; starts: first words of its documents."""
        at, which = self.found(ids)
        doc = np.searchsorted(starts, at, "right") - 1
        lines = defaultdict(list)
        for d, q, s in zip(doc.tolist(), (at - starts[doc]).tolist(), which.tolist()):
            for item, p, n in self.places[s]:
                lines[d, item, q - p, n].append(q)
        out = defaultdict(list)
        for (d, item, diagonal, n), places in lines.items():
            places.sort()
            breaks = [0, *(i for i in range(1, len(places)) if places[i] != places[i - 1] + 1), len(places)]
            for a, b in zip(breaks, breaks[1:]):
                out[d].append((self.items[item], places[a] - diagonal, places[a], b - a - 1 + n))
        return out


def sorted_suffixes(columns: list[np.ndarray]) -> np.ndarray:
    """Order of rows by their key columns: each column sorts only what the ones before left tied."""
    order = np.argsort(columns[0], kind="stable")
    group = columns[0][order]
    tied = np.zeros(len(order), dtype=np.int64)
    for column in columns[1:]:
        new = np.append(True, group[1:] != group[:-1]) if len(group) else np.empty(0, dtype=bool)
        tied = np.cumsum(new | np.append(True, tied[1:] != tied[:-1])) if len(group) else tied
        size = np.bincount(tied) if len(group) else np.zeros(1, dtype=np.int64)
        loose = np.flatnonzero(size[tied] > 1)
        if not len(loose):
            break
        again = np.lexsort((column[order[loose]], tied[loose]))
        order[loose] = order[loose[again]]
        group = column[order]
    return order


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int, block_bytes: int) -> Iterator[TestSuffixes]:
    held, size = [], 0
    rows = benchmark.select(F.col(id_col).cast("string"), F.col(text_col).cast("string")).distinct()
    for item, text in rows.toLocalIterator():
        data = (text or "").encode()
        if held and size + len(data) > block_bytes:
            yield TestSuffixes(held, window)
            held, size = [], 0
        held.append((item, data))
        size += len(data)
    yield TestSuffixes(held, window)


def _shards(batches) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    for batch in slices(batches, 4096):
        texts, start, size = utf8(batch.column("text")), 0, 0
        for i, text in enumerate(texts):
            if size and size + len(text or b"") > SHARD_BYTES:
                yield batch.slice(start, i - start), texts[start:i]
                start, size = i, 0
            size += len(text or b"")
        yield batch.slice(start), texts[start:]


def _searched(suffixes: TestSuffixes, texts: list[bytes | None]) -> tuple[list[int], dict[int, list[tuple]]]:
    get, ids, counts, starts, at = suffixes.vocabulary.get, [], [], [], 0
    for text in texts:
        words = words_of(text)
        counts.append(len(words))
        starts.append(at)
        ids.append(np.fromiter((get(w, 0) for w in words), dtype=np.uint64, count=len(words)))
        ids.append(np.zeros(1, dtype=np.uint64))  # no match crosses documents
        at += len(words) + 1
    return counts, suffixes.matches(np.concatenate(ids), np.array(starts)) if ids else {}


def _covered(matches: list[tuple]) -> int:
    n = end = 0
    for start, stop in sorted((m[2], m[2] + m[3]) for m in matches):
        n += max(0, stop - max(start, end))
        end = max(end, stop)
    return n


def search(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", window: int = 10,
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """For each document ``id_col``, ``n_words``, ``n_hit`` (words inside a match), ``items``
    (ids as strings, sorted, once each) and ``matches`` (item, first word in item and document, words)."""
    spark = docs.sparkSession
    frame = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                        F.array().cast(f"array<{MATCH}>").alias("matches"))
    blocks = [spark.sparkContext.broadcast(b) for b in _blocks(benchmark, item_col, item_text_col, window, block_bytes)]
    for block in blocks[:-1]:
        frame = frame.mapInArrow(_stage(block), f"id {kind(docs, id_col)}, text string, matches array<{MATCH}>")
    return frame.mapInArrow(
        _last(blocks[-1], id_col),
        f"`{id_col}` {kind(docs, id_col)}, n_words long, n_hit long, items array<string>, matches array<{MATCH}>")


def _all(batch: pa.RecordBatch, found: dict[int, list[tuple]]) -> list[list[tuple]]:
    before = [[(m["item_id"], m["item_start"], m["doc_start"], m["n_words"]) for m in row]
              for row in batch.column("matches").to_pylist()]
    return [sorted([*old, *found.get(i, ())], key=lambda m: (m[2], m[3], m[0] or "", m[1]))
            for i, old in enumerate(before)]


def _listed(matches: list[list[tuple]]) -> pa.Array:
    names = [f.name for f in _MATCH]
    return pa.array([[dict(zip(names, m)) for m in row] for row in matches], pa.list_(_MATCH))


def _stage(block):
    def stage(batches):
        for batch, texts in _shards(batches):
            _, found = _searched(block.value, texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text"), _listed(_all(batch, found))], ["id", "text", "matches"])
    return stage


def _last(block, id_col):
    def last(batches):
        for batch, texts in _shards(batches):
            counts, found = _searched(block.value, texts)
            matches = _all(batch, found)
            items = [sorted({m[0] for m in row if m[0] is not None}) for row in matches]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(counts, pa.int64()), pa.array(map(_covered, matches), pa.int64()),
                 pa.array(items, pa.list_(pa.string())), _listed(matches)],
                [id_col, "n_words", "n_hit", "items", "matches"])
    return last


def remove(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", window: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with all its columns, without the documents that hold a match."""
    at = docs.columns.index(text_col)

    def keep(block):
        def kept(batches):
            for batch in slices(batches, 4096):
                named = pa.RecordBatch.from_arrays([batch.column(at).cast(pa.string())], ["text"])
                start = 0
                for shard, texts in _shards([named]):
                    _, found = _searched(block.value, texts)
                    part = batch.slice(start, shard.num_rows)
                    start += shard.num_rows
                    yield part.filter(pa.array([i not in found for i in range(shard.num_rows)], pa.bool_()))
        return kept

    for suffixes in _blocks(benchmark, item_col, item_text_col, window, block_bytes):
        docs = docs.mapInArrow(keep(docs.sparkSession.sparkContext.broadcast(suffixes)), docs.schema)
    return docs
