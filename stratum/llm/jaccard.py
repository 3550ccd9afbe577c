"""Similarity join of documents by the Jaccard index of their word n-grams.

A document's set holds its distinct n-word shingles (fewer words make one, none
make none), as 64-bit hashes.  Two sets link when ``of * |r & s| >= share * |r | s|``.
Links are exact: candidates come from signatures that no linked pair can avoid
sharing, and every candidate is verified on the sets.

*Universe partition.*  Sizes fall into bands; a set works in its own band and, if
a smaller set of the band below can link with it, in that one too.  There its links
differ from it in at most H shingles, H being its own bound.  The universe of shingles is
hashed into m segments; a set's subset in each segment that it occupies is hashed to a key.
A set of k occupied segments shares at least k - H keys with any set it links with.  One
allocation takes these keys, the other fewer segments and the keys of all one-deletions of
each subset, where linked sets agree in one of those segments that hold two shingles or more
unless H / 2 segments and more differ twice.  The cost model takes, for each band, the cheaper of these
by rows and expected false partners.  A set with too few occupied segments for its H
(hardly ever) has one more key, which all such sets of its band share.

*Rarest keys.*  Blocks of documents send their keys, each once, to buckets, which answer how
often each occurs, as a power of two.  A set keeps its H + 1 rarest keys (ties by the key):
of k - H shared keys the rarest is among the H + 1 rarest of both sets.  With one-deletions a
set leaves out frequent keys as long as it has segments enough without them, else it keeps all.

*Verification.*  Kept keys with few sets give pairs.  A kept key with many sets has a hub, its least
set, with which the others are paired.  What is then in one component needs no more pairs; sets of
a frequent key that aren't all in one go, with what their frequent keys connect them to, into a cluster, whose
members are dealt into chunks; chunks meet two at a time, and a pair of chunks gives a
spanning forest of the links between components, not all pairs.  Pairs whose
odd sketches (a bit for each bucket with an odd number of shingles; each shingle
that differs flips one bit) differ in more than H bits can't link; what is left
is counted on the sets.  Equal sets are one class throughout and are never paired.

Null and empty texts have no set and link with nothing, each its own component.
Repeated rows each have a row; rows with the same id and different texts belong to the
components of their texts.  A null id names no component unless no other does.  Empty
tables give empty results; other columns aren't read.  Hashes are 64 bits wide: two
shingles, or the sets of two classes, are taken as equal with a chance near 2^-64.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.blocks import Block, Hashes, blocks, mixed
from stratum.llm.common import remove, scratch, written
from stratum.llm.components import components

#: Keys for a bucket; sets (up to the next power of two) beyond which a key is frequent; sets in a chunk of a cluster.
BUCKET_KEYS, FREQUENT, CHUNK = 500_000, 32, 512
#: Of the cost model: chance that a segment with a single shingle is shared by chance.
SINGLE_SHARED = 0.02

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_TIMES = np.uint64(0xC2B2AE3D27D4EB4F)


# -- sets ------------------------------------------------------------------

def shingle_sets(block: Block, n: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each text; A-Z count as a-z, words end at ASCII white space."""
    buffer = np.frombuffer(block.bytes.translate(_LOWER), dtype=np.uint8)
    empty = np.empty(0, dtype=np.uint64)
    if not len(buffer):
        return [empty] * len(block.ids)
    letter = ~_SPACE[buffer]
    cut = np.zeros(len(buffer) + 1, dtype=bool)
    cut[block.starts] = True
    start = np.flatnonzero(letter & (cut[:-1] | ~np.concatenate([[False], letter[:-1]])))
    end = np.flatnonzero(letter & (cut[1:] | ~np.concatenate([letter[1:], [False]]))) + 1
    words = Hashes(buffer).of(start, end)
    first = np.searchsorted(start, block.starts)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        size = min(n, b - a)
        if not size:
            out.append(empty)
            continue
        shingles = np.zeros(b - a - size + 1, dtype=np.uint64)
        for k in range(size):
            shingles = shingles * _TIMES + mixed(words[a + k:b - size + 1 + k], 7)
        out.append(np.unique(mixed(shingles, size)))
    return out


def class_of(shingles: np.ndarray) -> int:
    """A set's number: equal sets have the same."""
    total = mixed(shingles, 1).sum(dtype=np.uint64, keepdims=True) * _TIMES + np.uint64(len(shingles))
    return int(mixed(total).view(np.int64)[0])


# -- signatures ------------------------------------------------------------

@dataclass(frozen=True)
class Rule:
    """``share`` of ``of`` is the least Jaccard index of a link."""

    share: int
    of: int

    def differ(self, total: int) -> int:
        """Most shingles in which linked sets of ``total`` shingles together differ."""
        return (self.of - self.share) * total // (self.of + self.share)

    def least_partner(self, n: int) -> int:
        return -(-n * self.share // self.of)

    def largest_partner(self, n: int) -> int:
        return n * self.of // self.share

    def bands(self, largest: int) -> list[int]:
        """First sizes of the bands; linked sets lie in the same or in neighbouring bands."""
        out = [1]
        while out[-1] <= largest:
            out.append(max(out[-1] + 1, -(-out[-1] * self.of * self.of // (self.share * self.share))))
        return out


@dataclass(frozen=True)
class Allocation:
    """Of a band: its last size, segments, whether they have one-deletions, sketch bits."""

    rule: Rule
    high: int
    segments: int
    deletions: bool
    sketch: int

    @staticmethod
    def cheapest(rule: Rule, low: int, high: int, n_sets: int) -> Allocation:
        differ = rule.differ(high + rule.largest_partner(high))
        mean = (low + high) / 2
        sketch = 64 * max(1, math.ceil(8 * differ / 64))
        found = []
        for deletions in (False, True):
            allocation = Allocation(rule, high, -(-(differ + 1) // 2) if deletions else differ + 1, deletions, sketch)
            while allocation.segments < 64 * high and not allocation.enough(low):
                allocation = replace(allocation, segments=allocation.segments + 1 + allocation.segments // 50)
            m = allocation.segments
            rate = mean / m
            empty = math.exp(-rate)
            if deletions:
                partners = n_sets * m * (1 + rate) * (empty * (1 + rate)) ** 2
                found.append((m + mean + partners, allocation))
            else:
                partners = n_sets * m * (rate * empty * SINGLE_SHARED) ** 2 if differ else 0
                found.append((m + partners, allocation))
        return min(found, key=lambda f: f[0])[1]

    def differ(self, n: int) -> int:
        """Most shingles in which a set of ``n`` and one that it meets in this band and links with differ."""
        partner = self.rule.largest_partner(n)
        return self.rule.differ(n + (min(partner, self.high) if n > self.high else partner))

    def needed(self, n: int) -> int:
        """Segments (of two shingles or more, with one-deletions) that a set must have to share a key with any it links with."""
        return 1 + (self.differ(n) // 2 if self.deletions else self.differ(n))

    def enough(self, low: int) -> bool:
        """Whether sets of all sizes can be expected to have the segments they need, and some to leave out."""
        for n in (low, (low + self.high) // 2, self.high, self.rule.largest_partner(self.high)):
            m, rate, need = self.segments, n / self.segments, self.needed(n)
            empty = math.exp(-rate)
            if self.deletions:
                used = 1 - empty * (1 + rate)
                variance, wanted = m * used * (1 - used), min(need + 1 + need // 8, max(need, n / 20))
            else:
                used = 1 - empty
                variance, wanted = m * empty * (1 - (1 + rate) * empty), min(need + 2 + need // 8, max(need, n * 3 / 4))
            if m * used - 3 * math.sqrt(max(0, variance)) < wanted - 0.25:
                return False
        return True

    def keys(self, band: int, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys, and the segment of each; -1 is that of the key of sets with too few segments."""
        n = len(shingles)
        if not self.differ(n):  # equal sets only, which are one class
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        tag = np.uint64(band << 32)
        segment = ((mixed(shingles, 2) >> np.uint64(32)) * np.uint64(self.segments) >> np.uint64(32)).astype(np.int64)
        values = mixed(shingles, 3)
        sums = np.zeros(self.segments, dtype=np.uint64)
        np.add.at(sums, segment, values)
        held = np.bincount(segment, minlength=self.segments)
        of = np.flatnonzero(held)
        sums_of = sums[of]
        if self.deletions:
            several = held[segment] > 1
            of = np.concatenate([of, segment[several]])
            sums_of = np.concatenate([sums_of, sums[segment[several]] - values[several]])
        if int((held > self.deletions).sum()) < self.needed(n):
            of, sums_of = np.append(of, -1), np.append(sums_of, np.uint64(0))
        return mixed(sums_of * _TIMES + (tag | (of & 0xFFFFFFFF).astype(np.uint64)), 4), of

    def kept(self, n: int, keys: np.ndarray, segment: np.ndarray, often: np.ndarray, frequent: int) -> np.ndarray:
        """Places of the keys that a set of ``n`` shingles keeps, ``often`` being how often each occurs;
        those beyond ``frequent`` count as frequent."""
        always = segment < 0
        if self.deletions:
            several = np.bincount(segment[~always], minlength=self.segments) > 1  # its subset's key and the one-deletions
            held = np.unique(segment[(often > frequent) & ~always])
            spare = int(several.sum()) - self.needed(n)
            leave = (often > frequent) & ~always if several[held].sum() <= spare else np.zeros(len(keys), bool)
            return np.flatnonzero(~leave)
        order = np.lexsort((keys, np.where(always, -1, often)))
        return order[:self.needed(n) + int(always.any())]

    def odd_sketch(self, shingles: np.ndarray) -> np.ndarray:
        return odd_sketch(shingles, self.sketch)


def odd_sketch(shingles: np.ndarray, bits: int) -> np.ndarray:
    """A bit for each of ``bits`` buckets, set where an odd number of shingles fall; as 64-bit integers."""
    counts = np.bincount((mixed(shingles, 5) % np.uint64(bits)).astype(np.int64), minlength=bits)
    return np.packbits(counts & 1).view("<u8")


class Plan:
    """Bands and their allocations."""

    def __init__(self, rule: Rule, starts: list[int], n_sets: dict[int, int]):
        self.rule, self.starts = rule, starts
        self.allocations = [Allocation.cheapest(rule, a, b - 1, n_sets.get(i, 0) + n_sets.get(i + 1, 0))
                            for i, (a, b) in enumerate(zip(starts, starts[1:]))]

    def bands_of(self, n: int) -> list[int]:
        own = int(np.searchsorted(self.starts, n, "right")) - 1
        below = own > 0 and self.rule.least_partner(n) < self.starts[own]
        return [own - 1, own] if below else [own]


class Signed:
    """A block's classes with their keys: each row is a class in a band."""

    def __init__(self, block: Block, n: int, plan: Plan):
        self.rows: list[tuple[int, int, np.ndarray]] = []  # class, band, shingles
        keys, segments, seen = [], [], set()
        for shingles in shingle_sets(block, n):
            if not len(shingles) or (cls := class_of(shingles)) in seen:
                continue
            seen.add(cls)
            for band in plan.bands_of(len(shingles)):
                self.rows.append((cls, band, shingles))
                own, of = plan.allocations[band].keys(band, shingles)
                keys.append(own)
                segments.append(of)
        self.sizes, self.segments = [len(k) for k in keys], segments
        flat = np.concatenate(keys) if keys else np.empty(0, dtype=np.uint64)
        self.keys, self.inverse, self.counts = np.unique(flat, return_inverse=True, return_counts=True)

    def parts(self, n_buckets: int):
        """Bucket and range of its keys, which are ranges of the hashes."""
        edges = np.searchsorted(self.keys, (np.arange(n_buckets + 1, dtype=object) * (1 << 64) // n_buckets)[:-1].astype(np.uint64))
        edges = [*edges.tolist(), len(self.keys)]
        yield from ((i, a, b) for i, (a, b) in enumerate(zip(edges, edges[1:])) if a < b)


def _block_of(table: pa.Table) -> tuple[int, Block]:
    row = {c: table.column(c)[0].as_py() for c in ("block", "ids", "sizes", "data")}
    return row["block"], Block(row["ids"], row["sizes"], row["data"])


def _each(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield _block_of(pa.Table.from_batches([batch.slice(i, 1)]))


def _five(keys: np.ndarray) -> bytes:
    """Keys of one bucket without their lowest 16 bits."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:]).tobytes()


def _from_five(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), dtype=np.uint8)
    out[:, 2:] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


# -- the join --------------------------------------------------------------

def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, share: int = 80,
         of: int = 100) -> DataFrame:
    """For each row ``id_col``, ``n_shingles`` and ``component_id``, the smallest id that links reach."""
    spark = docs.sparkSession
    rule = Rule(share, of)
    texts = blocks(docs, id_col, text_col)

    def sized(batches):
        for number, block in _each(batches):
            sets = shingle_sets(block, words)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.ids, pa.int64()), pa.array([number] * len(sets), pa.int64()),
                 pa.array(map(len, sets), pa.int64()),
                 pa.array([class_of(s) if len(s) else None for s in sets], pa.int64())], ["id", "block", "n", "cls"])

    rows = written(texts.mapInArrow(sized, "id long, block long, n long, cls long"), "sets")
    classes = rows.where("n > 0").groupBy("cls").agg(F.first("n").alias("n"), F.min("id").alias("least"), F.min("block").alias("block"))
    of_class = linked_classes(texts, classes, words, rule).withColumnsRenamed({"node": "cls"})
    least = classes.join(of_class, "cls").groupBy("component").agg(F.min("least").alias("reached"))
    reached = of_class.join(least, "component").select("cls", "reached")
    # a table of its own, so that adaptive execution can split a class of very many rows
    named = written(classes.join(reached, "cls", "left").select(
        "cls", F.coalesce("reached", "least").alias("component_id")), "named")
    found = rows.where("cls is not null").join(named, "cls").select("id", "n", "component_id")
    alone = rows.where("cls is null").select("id", "n", F.col("id").alias("component_id"))
    return found.unionByName(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def linked_classes(texts: DataFrame, classes: DataFrame, words: int, rule: Rule) -> DataFrame:
    """``node`` and ``component`` of every class that links with another."""
    spark = texts.sparkSession
    largest = classes.agg(F.max("n")).first()[0] or 1
    starts = rule.bands(largest)
    band = F.lit(-1)
    for start in starts:
        band = band + (F.col("n") >= start).cast("int")
    n_sets = {r["band"]: r["sets"] for r in classes.groupBy(band.alias("band")).agg(F.count("*").alias("sets")).collect()}
    plan = Plan(rule, starts, n_sets)
    n_keys = sum(n * (a.segments + (starts[i + 1] if a.deletions else 0)) for i, a in enumerate(plan.allocations)
                 for n in [n_sets.get(i, 0)])
    frequent_from = math.ceil(math.log2(FREQUENT))
    shared = spark.sparkContext.broadcast((plan, max(1, -(-2 * n_keys // BUCKET_KEYS))))
    work = scratch(spark, "jaccard")

    def keyed(batches):
        for number, block in _each(batches):
            plan, n_buckets = shared.value
            signed = Signed(block, words, plan)
            found = [(bucket, number, _five(signed.keys[a:b]), np.minimum(signed.counts[a:b], 255).astype(np.uint8).tobytes())
                     for bucket, a, b in signed.parts(n_buckets)]
            types = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in found], t) for k, t in enumerate(types)], ["bucket", "block", "keys", "counts"])

    def answered(table):
        keys = [_from_five(k) for k in table.column("keys").to_pylist()]
        counts = np.concatenate([np.frombuffer(c, dtype=np.uint8) for c in table.column("counts").to_pylist()])
        values, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(inverse, weights=counts, minlength=len(values))
        code = np.ceil(np.log2(total)).astype(np.uint8)[inverse]
        codes = [zstandard.compress(c.tobytes(), 3) for c in np.split(code, np.cumsum([len(k) for k in keys])[:-1])]
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "codes": pa.array(codes, pa.binary())})

    def signed_rows(key, left, right):
        out: dict[str, list] = {c: [] for c in _SIGNED.names}
        if left.num_rows:
            plan, n_buckets = shared.value
            signed = Signed(_block_of(left)[1], words, plan)
            codes = np.zeros(len(signed.keys), dtype=np.uint8)
            got = dict(zip(right.column("bucket").to_pylist(), right.column("codes").to_pylist()))
            for bucket, a, b in signed.parts(n_buckets):
                codes[a:b] = np.frombuffer(zstandard.decompress(got[bucket]), dtype=np.uint8)
            at = 0
            for (cls, number, shingles), size, segment in zip(signed.rows, signed.sizes, signed.segments):
                of_row = signed.inverse[at:at + size]
                at += size
                keys, often = signed.keys[of_row], codes[of_row]
                allocation = plan.allocations[number]
                kept = allocation.kept(len(shingles), keys, segment, often, frequent_from)
                keys, often = keys[kept], often[kept]
                few, frequent = np.unique(keys[(often > 0) & (often <= frequent_from)]), np.unique(keys[often > frequent_from])
                if len(few) or len(frequent):
                    for name, value in zip(_SIGNED.names, (
                            cls, len(shingles), few.view(np.int64), frequent.view(np.int64),
                            allocation.odd_sketch(shingles).view(np.int64), number)):
                        out[name].append(value)
        return pa.table([pa.array(v, f.type) for v, f in zip(out.values(), _SIGNED)], schema=_SIGNED)

    codes = (texts.mapInArrow(keyed, "bucket long, block long, keys binary, counts binary")
             .groupBy("bucket").applyInArrow(answered, "block long, bucket long, codes binary"))
    signed = written(
        texts.groupBy("block").cogroup(codes.groupBy("block")).applyInArrow(
            signed_rows, "cls long, n long, few array<long>, frequent array<long>, sketch array<long>, band int"),
        "signatures", work).dropDuplicates(["cls", "band"])
    frequent = written(signed.where(F.size("frequent") > 0).select("cls", "n", "band", F.explode("frequent").alias("key")), "frequent", work)
    # a table of its own, so that adaptive execution can split a key of very many sets
    hubs = written(frequent.groupBy("key").agg(F.min_by(F.struct("cls", "n"), "cls").alias("hub")), "hubs", work)
    to_hub = frequent.join(hubs, "key").where("cls <> hub.cls").select(
        "band", F.struct("cls", "n").alias("one"), F.col("hub").alias("other")).distinct()
    pairs = written(_near(_few(signed).unionByName(to_hub), signed, rule), "pairs", work)
    wanted = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
    verified = _verified(pairs, _sets_of(texts, classes, wanted, words, work), rule)
    found = components(verified)
    open_ = written(_open(frequent, found, work), "open", work)
    if not open_.isEmpty():
        members = written(_clusters(open_), "clusters", work)
        more = _cluster_links(members, _sets_of(texts, classes, members.select("cls"), words, work), rule)
        so_far = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
        found = components(so_far.unionByName(more))
    remove(spark, work)
    return found


_SIGNED = pa.schema([("cls", pa.int64()), ("n", pa.int64()), ("few", pa.list_(pa.int64())),
                     ("frequent", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64())), ("band", pa.int32())])


def _few(signed: DataFrame) -> DataFrame:
    """Pairs of sets that share a kept key of few (``FREQUENT`` or the next power of two, so a group is bounded)."""
    members = signed.select(F.explode("few").alias("key"), "band", F.struct("cls", "n").alias("member"))
    groups = members.groupBy("key", "band").agg(F.array_sort(F.collect_set("member")).alias("m")).where(F.size("m") > 1)
    near = F.posexplode("m").alias("i", "one")
    return groups.select("band", "m", near).select(
        "band", "one", F.explode(F.slice("m", F.col("i") + 2, F.size("m"))).alias("other"))


def _near(pairs: DataFrame, signed: DataFrame, rule: Rule) -> DataFrame:
    """Those pairs that are near enough in size and whose sketches don't rule them out."""
    sizes = F.least("one.n", "other.n") * rule.of >= F.greatest("one.n", "other.n") * rule.share
    pairs = pairs.where(sizes).select("band", F.least("one.cls", "other.cls").alias("a"), F.greatest("one.cls", "other.cls").alias("b")).distinct()
    one, other = (signed.select(F.col("cls").alias(c), "band", F.col("sketch").alias(f"s_{c}"), F.col("n").alias(f"n_{c}"))
                  for c in "ab")
    differ = F.aggregate(F.zip_with("s_a", "s_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    most = (rule.of - rule.share) * (F.col("n_a") + F.col("n_b"))
    return pairs.join(one, ["a", "band"]).join(other, ["b", "band"]).where(
        differ * (rule.of + rule.share) <= most).select("a", "b").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    one, other = (sets.withColumnsRenamed({"cls": c, "shingles": f"set_{c}"}) for c in "ab")
    shared = F.size(F.array_intersect("set_a", "set_b")).cast("long")
    joint = F.size("set_a").cast("long") + F.size("set_b")
    return (pairs.join(other, "b").join(one, "a")
            .where(F.lit(rule.of) * shared >= F.lit(rule.share) * (joint - shared)).select("a", "b"))


def _open(frequent: DataFrame, found: DataFrame, work: str) -> DataFrame:
    """``cls``, its component ``label`` so far and a ``hub``, of the sets that share a frequent key (which has the hub) with
    a set of another component."""
    label = found.select(F.col("node").alias("cls"), F.col("component").alias("label"))
    members = frequent.select("cls", "key").distinct().join(label, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    members = written(members, "labelled", work)
    open_ = members.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most"), F.min("cls").alias("hub")) \
        .where("least < most").select("key", "hub")
    open_ = written(open_, "open-keys", work)
    return members.join(open_, "key").select("cls", "label", "hub").distinct()


def _clusters(members: DataFrame) -> DataFrame:
    """``cls``, ``label``, ``cluster`` and its ``chunks``; a cluster is what hubs connect."""
    joined = components(members.select(F.col("cls").alias("a"), F.col("hub").alias("b")))
    chunks = joined.groupBy("component").agg(F.ceil(F.count("*") / CHUNK).cast("long").alias("chunks"))
    labels = members.select("cls", "label").distinct()
    return joined.join(chunks, "component").join(labels, F.col("node") == F.col("cls")).select(
        "cls", "label", F.col("component").alias("cluster"), "chunks")


def _sets_of(texts: DataFrame, classes: DataFrame, wanted: DataFrame, words: int, work: str) -> DataFrame:
    """``cls`` and sorted ``shingles`` of the classes wanted, each from one block that holds it."""
    places = classes.join(wanted, "cls").select("cls", "block")

    def found(key, left, right):
        want, out = set(right.column("cls").to_pylist()), {}
        if left.num_rows and want:
            for shingles in shingle_sets(_block_of(left)[1], words):
                if len(shingles) and (cls := class_of(shingles)) in want:
                    out[cls] = shingles.view(np.int64)
        return pa.table({"cls": pa.array(list(out), pa.int64()), "shingles": pa.array(list(out.values()), pa.list_(pa.int64()))})

    return written(texts.groupBy("block").cogroup(places.groupBy("block")).applyInArrow(
        found, "cls long, shingles array<long>"), "shingles", work)


def _cluster_links(members: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """A spanning forest of the links between each two chunks of a cluster (and within each)."""
    own = F.pmod(F.xxhash64("cls"), F.col("chunks"))
    met = members.withColumn("own", own).withColumn("met", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    tiles = met.select("cls", "label", "cluster", "own", F.least("own", "met").alias("i"), F.greatest("own", "met").alias("j")).distinct()

    def forest(table):
        a, b = spanning_links(table.column("cls").to_pylist(), table.column("label").to_numpy(), table.column("own").to_numpy(),
                              [np.array(s, dtype=np.int64).view(np.uint64) for s in table.column("shingles").to_pylist()], rule)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return tiles.join(sets, "cls").groupBy("cluster", "i", "j").applyInArrow(forest, "a long, b long")


def spanning_links(classes: list[int], label: np.ndarray, chunk: np.ndarray, sets: list[np.ndarray],
                   rule: Rule) -> tuple[list[int], list[int]]:
    """Links between two chunks (or within one) that connect all that their links connect; equal labels are connected."""
    n = np.array([len(s) for s in sets])
    bits = 64 * max(1, math.ceil(8 * rule.differ(2 * int(n.max(initial=1))) / 64))
    sketches = np.stack([odd_sketch(s, bits) for s in sets])
    label = np.unique(label, return_inverse=True)[1]
    one = chunk == chunk.min()
    others = one if one.all() else ~one
    a, b = [], []
    for i in np.flatnonzero(one).tolist():
        open_ = others & (label != label[i]) & (np.minimum(n, n[i]) * rule.of >= np.maximum(n, n[i]) * rule.share)
        at = np.flatnonzero(open_)
        apart = np.bitwise_count(sketches[at] ^ sketches[i]).sum(axis=1)
        near = apart * (rule.of + rule.share) <= (rule.of - rule.share) * (n[at] + n[i])
        for j in at[near][np.argsort(apart[near], kind="stable")].tolist():
            if label[j] == label[i]:
                continue
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if rule.of * both >= rule.share * (n[i] + n[j] - both):
                label[label == label[j]] = label[i]
                a.append(classes[i])
                b.append(classes[j])
    return a, b


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, share: int = 80,
             of: int = 100) -> DataFrame:
    """``docs`` with its columns; of each component the row with the smallest id stays.  Decisions are by
    id: rows that repeat an id stay or go together."""
    found = link(docs, id_col, text_col, words, share, of)
    lost = found.where(~F.col(id_col).eqNullSafe(F.col("component_id"))).select(F.col(id_col).alias("_lost")).distinct()
    return docs.join(lost, docs[id_col] == lost["_lost"], "left_anti")
