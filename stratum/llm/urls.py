"""URL filters by a Bloom filter cascade, in DataFrame functions only.

A rule names a host and a path; it fits its host and all subdomains, if the
URL's path starts with the rule's.  A URL's candidate keys are the ends of its
host (of as many labels as some rule has) with the beginnings of its path (as
long as some rule's).  The cascade is built over the corpus's complete key
universe: its first level encodes the listed keys, the second the universe's
other keys that pass the first, the third the listed keys that pass the second,
and so on until none passes.  A key is listed if the first level it doesn't pass
is an even one (from one), so membership is exact for every key of the corpus
and needs no join.  A second cascade tells listed keys that block from those
that allow.  URLs without a rule are judged by the cascade's default: what isn't
listed is allowed.

The first level's size follows the number of rules and the logarithm of the
universe, which keeps the second level's keys near the number of rules; later
levels are smaller.  So all levels are bounded by the rules (a million rules make some megabytes of bits).  A level's bits
are one row of a written table, which plans read as a scalar subquery.  Keys of up to ``UNROLLED`` shapes of rules are
looked up in a URL's own row; of more shapes they become rows, each looked up by the same expressions, and a
URL's longest listed key comes back by a partial and a final aggregate.  So plans don't grow with the rules.

Null URLs and those without ``://`` have an empty host and path.  Repeated rows are each judged; very long URLs are a
row's value, of which as many beginnings as rules have lengths are looked up.  Longest means most characters of host and path;
of equals, the longer host.  An empty table gives an empty result; without rules all is allowed.  Other columns may have any name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import written

#: Verdict, host, path; fixed values.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: Shapes of rules (labels of the host, length of the path) looked up in a URL's own row.
UNROLLED = 16

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Level:
    """A Bloom filter whose bits are a row of a written table."""

    def __init__(self, number: int, n_keys: int, share: float):
        self.number = number
        self.hashes = max(1, round(-math.log2(share)))
        self.bits = max(64, 64 * math.ceil(n_keys * self.hashes / math.log(2) / 64))

    def _places(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(self.number), F.lit(i)), F.lit(self.bits)) for i in range(self.hashes)]

    def fill(self, keys: DataFrame) -> Level:
        """Encode the keys of column ``key``; the one row of bits is bounded by the level's size."""
        places = keys.select(F.explode(F.array(*self._places(F.col("key")))).alias("p"))
        words = places.groupBy(F.shiftright("p", 6).alias("w")).agg(
            F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("p") % 64).cast("int"))).alias("bits"))
        every = keys.sparkSession.range(self.bits // 64).select(F.col("id").alias("w"))
        row = every.join(words, "w", "left").agg(F.sort_array(F.collect_list(F.struct("w", F.coalesce("bits", F.lit(0)).alias("b")))).alias("of"))
        self.words = written(row.select(F.col("of.b").alias("words")), "bits")
        return self

    def passes(self, key: Column) -> Column:
        words = self.words.scalar()
        out = F.lit(True)
        for place in self._places(key):
            out = out & (F.getbit(F.get(words, F.shiftright(place, 6).cast("int")), (place % 64).cast("int")) == 1)
        return out


class Cascade:
    """Exact membership of ``listed`` among the keys of ``universe`` (both with a column ``key``)."""

    def __init__(self, listed: DataFrame, universe: DataFrame, n_listed: int, n_universe: int):
        share = min(0.5, max(n_listed, 1) / max(n_universe, 1))
        self.levels = [Level(0, n_listed, share).fill(listed)]
        others = universe.where(self.levels[0].passes(F.col("key"))).select("key").distinct()
        encoded, rest = written(others.join(listed, "key", "left_anti"), "cascade"), listed
        while n := encoded.count():
            self.levels.append(Level(len(self.levels), n, 0.5).fill(encoded))
            passing = written(rest.where(self.levels[-1].passes(F.col("key"))), "cascade")
            encoded, rest = passing, encoded

    def has(self, key: Column) -> Column:
        out = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            out = F.when(~level.passes(key), F.lit(level.number % 2 == 1)).otherwise(out)
        return out


def split_url(url: Column) -> tuple[Column, Column]:
    start = F.locate("://", url)
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url)))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def _shapes(rules) -> list[tuple[int, int]]:
    """Labels and path lengths that some rule has."""
    return sorted({(len(h.split(".")), len(p)) for _, h, p in rules})


def _candidate(host: Column, path: Column, labels, length) -> Column:
    """A URL's host end and key for a shape."""
    end = F.call_function("substring_index", host, F.lit("."), -labels)
    return F.struct(end.alias("end"), F.concat(end, F.substring(path, F.lit(1), length)).alias("key"))


def _candidates(host: Column, path: Column, shapes) -> Column:
    """An array of ``_candidate`` for all shapes."""
    listed = F.array(*(F.struct(F.lit(labels).alias("labels"), F.lit(length).alias("length")) for labels, length in shapes))
    return F.transform(listed, lambda s: _candidate(host, path, s["labels"], s["length"]))


def _rank(c: Column) -> Column:
    return F.struct(F.length(c["key"]).alias("n"), F.length(c["end"]).alias("host"), c["key"].alias("key"))


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """For each row ``id_col``, ``host``, ``path``, ``rule`` (host and path of the longest that fits,
    else null) and ``verdict``."""
    rules = list(rules)
    spark = pages.sparkSession
    host, path = split_url(pages[url_col].cast("string"))
    urls = pages.select(pages[id_col].alias("id"), host.alias("host"), path.alias("path"))
    if not rules:
        return urls.select(F.col("id").alias(id_col), "host", "path", F.lit(None).cast("string").alias("rule"),
                           F.lit("allow").alias("verdict"))
    shapes = _shapes(rules)
    candidates = _candidates(F.col("host"), F.col("path"), shapes)
    universe = urls.select(F.explode(candidates).alias("c")).select("c.key")
    listed = spark.createDataFrame([(h + p,) for _, h, p in rules], "key string").distinct()
    blocking = spark.createDataFrame([(h + p,) for v, h, p in rules if v == "block"], "key string").distinct()
    n_universe = universe.agg(F.approx_count_distinct("key")).first()[0]
    known = Cascade(listed, universe, len(rules), n_universe)
    blocks = Cascade(blocking, listed, max(1, blocking.count()), len(rules))
    if len(shapes) <= UNROLLED:
        each = [_candidate(F.col("host"), F.col("path"), F.lit(labels), F.lit(length)) for labels, length in shapes]
        found = urls.withColumn("rule", F.array_max(F.array(*(F.when(known.has(c["key"]), _rank(c)) for c in each)))["key"])
    else:
        rows = written(urls.withColumn("row", F.monotonically_increasing_id()), "urls")
        keys = rows.select("row", F.explode(candidates).alias("c")).where(known.has(F.col("c.key")))
        best = keys.groupBy("row").agg(F.max(_rank(F.col("c")))["key"].alias("rule"))
        found = rows.join(best, "row", "left")
    return found.select(
        F.col("id").alias(id_col), "host", "path", "rule",
        F.when(F.col("rule").isNotNull() & blocks.has(F.col("rule")), "block").otherwise("allow").alias("verdict"))
