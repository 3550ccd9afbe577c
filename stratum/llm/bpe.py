"""Byte-level BPE encoding and decoding by a monoid tree reduction.

A text is cut by the vocabulary's pattern; a match of the pattern (a piece)
is encoded on its own.  Pieces form a free monoid, so a text is the
concatenation of its pieces' codes, and a text of any length is read in
stretches cut where the pattern always breaks.

Inside a piece, codes are joined up a binary tree.  Leaves are merged plainly.
Two neighbours are joined by re-encoding a window around their boundary; the
window grows, to the left or right, until the token before it and the token
after it are *compatible* with the window's outermost tokens.  Two adjacent
tokens are compatible if merging their bytes alone gives these two tokens
again.  A row of tokens, each the code of its own bytes, in which all
neighbours are compatible, is the code of its bytes: the first merge that
would cross a boundary sees nothing beyond the two tokens beside it, and that
one the pair's own encoding has ruled out.  So tokens outside the window are
final.  Decoding concatenates the tokens' bytes up the same tree.

Nulls count as the empty text, which has no tokens.  Repeated rows are each
encoded; other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import kind, slices

#: Entries of a vocabulary; it is broadcast, so its size is checked.
MAX_RANKS = 1_000_000
#: A piece of so many bytes is merged plainly.
LEAF_BYTES = 48
#: Entries of a task's table of pieces and codes; it starts anew when full.
CACHE_PIECES = 200_000
#: Characters of a text that are cut into pieces at a time.
STRETCH = 1 << 18
#: Above any rank.
_NEVER = 1 << 62

#: Between a character that is not white space and one space that another such character follows,
#: the pattern always breaks: nothing but a run of white space spans a space from its left.
_BREAK = regex.compile(r"(?<=\S)(?= \S)")


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with a base64 token and its rank on each line."""
    ranks = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
    if len(ranks) > MAX_RANKS:
        raise ValueError(f"a vocabulary of {len(ranks)} entries is over the bound of {MAX_RANKS}")
    return ranks


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split = regex.compile(pattern)
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self._pairs: dict[tuple[int, int], bool] = {}
        self._leaves: _Leaves | None = None

    @property
    def leaves(self) -> _Leaves:
        if self._leaves is None:
            self._leaves = _Leaves(self.ranks)
        return self._leaves

    # -- one piece ---------------------------------------------------------

    def merged(self, data: bytes) -> list[int]:
        """Plain BPE: the pair of the lowest rank first, the leftmost of equals."""
        if len(data) > LEAF_BYTES:
            return self._merged_by_heap(data)
        get = self.ranks.get
        parts = [data[i:i + 1] for i in range(len(data))]
        worth = [get(a + b, _NEVER) for a, b in zip(parts, parts[1:])]
        while worth and (least := min(worth)) != _NEVER:
            i = worth.index(least)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del worth[i]
            if i:
                worth[i - 1] = get(parts[i - 1] + parts[i], _NEVER)
            if i < len(worth):
                worth[i] = get(parts[i] + parts[i + 1], _NEVER)
        return list(map(self.ranks.__getitem__, parts))

    def _merged_by_heap(self, data: bytes) -> list[int]:
        n, ranks = len(data), self.ranks
        after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(data[i:i + 2])) is not None]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or (j := after[i]) >= n or end[j] != stop:
                continue
            alive[j], end[i], after[i] = False, stop, after[j]
            if (k := after[j]) < n:
                before[k] = i
                if (r := ranks.get(data[i:end[k]])) is not None:
                    heapq.heappush(heap, (r, i, end[k]))
            if (k := before[i]) >= 0 and (r := ranks.get(data[k:stop])) is not None:
                heapq.heappush(heap, (r, k, stop))
        return [ranks[data[i:end[i]]] for i in range(n) if alive[i]]

    def compatible(self, a: int, b: int) -> bool:
        known = self._pairs.get((a, b))
        if known is None:
            if len(self._pairs) >= CACHE_PIECES:
                self._pairs.clear()
            known = self._pairs[a, b] = self.merged(self.tokens[a] + self.tokens[b]) == [a, b]
        return known

    def joined(self, left: list[int], right: list[int]) -> list[int]:
        """The monoid's product: the code of two neighbours from their codes."""
        if not left or not right:
            return left or right
        if self.compatible(left[-1], right[0]):
            return left + right
        i = j = 1
        while True:
            window = self.merged(self.decode(left[-i:] + right[:j]))
            left_final = i >= len(left) or self.compatible(left[-i - 1], window[0])
            right_final = j >= len(right) or self.compatible(window[-1], right[j])
            if left_final and right_final:
                return left[:-i] + window + right[j:] if i < len(left) else window + right[j:]
            i = i if left_final else min(2 * i, len(left))
            j = j if right_final else min(2 * j, len(right))

    def reduced(self, data: bytes) -> list[int]:
        """The tree: leaves merged plainly, neighbours joined level by level."""
        level = [self.merged(data[i:i + LEAF_BYTES]) for i in range(0, len(data), LEAF_BYTES)]
        while len(level) > 1:
            level = [self.joined(level[i], level[i + 1]) if i + 1 < len(level) else level[i]
                     for i in range(0, len(level), 2)]
        return level[0] if level else []

    def piece(self, data: bytes) -> list[int]:
        """A piece that is itself a token is this token, whatever its merges."""
        rank = self.ranks.get(data)
        return [rank] if rank is not None else self.reduced(data)

    # -- whole texts -------------------------------------------------------

    def stretches(self, text: str) -> Iterator[str]:
        start = 0
        while len(text) - start > STRETCH:
            cut = _BREAK.search(text, start + STRETCH)
            if cut is None:
                break
            yield text[start:cut.start()]
            start = cut.start()
        yield text[start:] if start else text

    def encoder(self) -> _Pieces:
        return _Pieces(self)

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class _Leaves:
    """Plain BPE of many short pieces side by side: in each round every piece merges its best pair."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = [(ranks[t[:i]], ranks[t[i:]], rank) for t, rank in ranks.items()
                 for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        table = np.array(pairs, dtype=np.int64).reshape(-1, 3)
        keys = table[:, 0] << 32 | table[:, 1]
        order = np.argsort(keys)
        self.keys, self.worths = np.append(keys[order], _NEVER), np.append(table[order, 2], _NEVER)
        self.bytes = np.array([ranks.get(bytes([i]), 0) for i in range(256)], dtype=np.int64)

    def worth(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.worths[at], _NEVER)

    def merged(self, pieces: list[bytes]) -> list[bytes]:
        """Codes as little-endian unsigned 32-bit integers."""
        ids = self.bytes[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), list(map(len, pieces)))
        worth = np.full(len(ids), _NEVER)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        worth[inner] = self.worth(ids[inner], ids[inner + 1])
        final_ids, final_owner = [], []
        while len(ids):
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            best = np.minimum.reduceat(worth, starts)
            sizes = np.diff(np.append(starts, len(ids)))
            ended = np.repeat(best == _NEVER, sizes)
            if ended.any():
                final_ids.append(ids[ended])
                final_owner.append(owner[ended])
                ids, owner, worth = ids[~ended], owner[~ended], worth[~ended]
                live = best != _NEVER
                best, sizes = best[live], sizes[live]
                starts = np.cumsum(sizes) - sizes
                if not len(ids):
                    break
            least = np.flatnonzero(worth == np.repeat(best, sizes))
            least = least[np.searchsorted(least, starts)]  # the leftmost of each piece
            ids[least] = worth[least]
            keep = np.ones(len(ids), dtype=bool)
            keep[least + 1] = False
            at = least - np.arange(len(least))  # where it stands when the others are gone
            ids, owner, worth = ids[keep], owner[keep], worth[keep]
            for left in (at - 1, at):
                left = left[(left >= 0) & (left < len(ids))]
                joint = np.append(owner, -1)[left + 1] == owner[left]
                worth[left[~joint]] = _NEVER
                left = left[joint]
                worth[left] = self.worth(ids[left], ids[left + 1])
        ids, owner = np.concatenate(final_ids or [ids]), np.concatenate(final_owner or [owner])
        order = np.argsort(owner, kind="stable")
        ends = np.cumsum(np.bincount(owner, minlength=len(pieces))) * 4
        whole = ids[order].astype("<u4").tobytes()
        return [whole[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


class _Pieces(dict):
    """Codes of the pieces seen, as little-endian unsigned 32-bit integers."""

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec = codec

    def __missing__(self, piece: str) -> bytes:
        return np.array(self.codec.piece(piece.encode()), dtype="<u4").tobytes()

    def learn(self, pieces: set[str]) -> None:
        """Codes of new pieces; short ones are merged side by side, long ones are never kept."""
        if len(self) + len(pieces) > CACHE_PIECES:
            self.clear()
        ranks, new = self.codec.ranks, {}
        for piece in pieces - self.keys():
            data = piece.encode()
            if data in ranks:
                self[piece] = ranks[data].to_bytes(4, "little")
            elif len(data) <= LEAF_BYTES:
                new[piece] = data
        if new:
            self.update(zip(new, self.codec.leaves.merged(list(new.values()))))

    def coded(self, texts: list[str | None]) -> Iterator[tuple[int, bytes]]:
        """Number of the text and code of its next stretch, in order; every text has one at least."""
        held: list[tuple[int, list[str]]] = []
        chars = 0
        for i, text in enumerate(texts):
            for stretch in self.codec.stretches(text or ""):
                held.append((i, self.codec.split.findall(stretch)))
                chars += len(stretch)
                if chars > 4 * STRETCH:
                    yield from self._flush(held)
                    held, chars = [], 0
        yield from self._flush(held)

    def _flush(self, held):
        self.learn({piece for _, pieces in held for piece in pieces})
        for i, pieces in held:
            yield i, b"".join(map(self.__getitem__, pieces))


#: The encoder that a Python worker keeps from task to task, by its vocabulary's broadcast.
_KEPT: dict[tuple, _Pieces] = {}


def _encoder(shared, pattern: str) -> _Pieces:
    key = (id(shared.value), pattern)
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = Codec(shared.value, pattern).encoder()
    return _KEPT[key]


def _shared(df: DataFrame, ranks: dict[bytes, int]):
    if len(ranks) > MAX_RANKS:
        raise ValueError(f"a vocabulary of {len(ranks)} entries is over the bound of {MAX_RANKS}")
    return df.sparkSession.sparkContext.broadcast(ranks)


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids of every row's whole text: ``id_col``, ``n_tokens``, ``ids`` array<int>,
    and as a check of the way back ``ids_sha256`` and ``decoded_sha256`` of the decoded bytes."""
    return _coded(docs, ranks, pattern, id_col, text_col, with_ids=True)


def digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text encoded and its ids decoded again: ``id_col``, ``n_tokens``,
    ``ids_sha256`` (little-endian unsigned 32-bit ids) and ``decoded_sha256``."""
    return _coded(docs, ranks, pattern, id_col, text_col, with_ids=False)


def _coded(docs, ranks, pattern, id_col, text_col, with_ids):
    shared = _shared(docs, ranks)

    def code(batches):
        pieces = _encoder(shared, pattern)
        codec = pieces.codec
        for batch in slices(batches):
            out: dict[str, list] = {"n_tokens": [], "ids": [], "ids_sha256": [], "decoded_sha256": []}
            for _, parts in groupby(pieces.coded(batch.column(1).to_pylist()), key=itemgetter(0)):
                n, ids_sha, decoded_sha, whole = 0, hashlib.sha256(), hashlib.sha256(), []
                for _, part in parts:
                    ids = np.frombuffer(part, dtype="<u4")
                    n += len(ids)
                    ids_sha.update(part)
                    decoded_sha.update(codec.decode(ids.tolist()))
                    if with_ids:
                        whole.append(ids)
                out["n_tokens"].append(n)
                out["ids"].append(np.concatenate(whole).astype(np.int32) if whole else [])
                out["ids_sha256"].append(ids_sha.hexdigest())
                out["decoded_sha256"].append(decoded_sha.hexdigest())
            columns = [batch.column(0), pa.array(out["n_tokens"], pa.int64())]
            names = [id_col, "n_tokens"]
            if with_ids:
                columns.append(pa.array(out["ids"], pa.list_(pa.int32())))
                names.append("ids")
            for name in ("ids_sha256", "decoded_sha256"):
                columns.append(pa.array(out[name], pa.string()))
                names.append(name)
            yield pa.RecordBatch.from_arrays(columns, names)

    ids = "ids array<int>, " if with_ids else ""
    schema = f"`{id_col}` {kind(docs, id_col)}, n_tokens long, {ids}ids_sha256 string, decoded_sha256 string"
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(code, schema)


def decode(tokens: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The bytes of every row's ids: ``id_col``, ``data`` binary.  Null ids give no bytes;
    an id outside the vocabulary fails the job."""
    shared = _shared(tokens, ranks)

    def back(batches):
        codec = Codec(shared.value, ".")
        for batch in slices(batches):
            data = [codec.decode(ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], [id_col, "data"])

    return tokens.select(id_col, ids_col).mapInArrow(back, f"`{id_col}` {kind(tokens, id_col)}, data binary")
