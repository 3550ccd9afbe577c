"""Connected components by alternating large and small stars, in DataFrame functions.

Each round every node's larger neighbours go to its smallest neighbour, then
every node with its smaller neighbours does.  Links of a round are written and
read again, so the plan doesn't grow; nothing comes to the driver but a count
and a checksum.  A node with many links is split by adaptive execution, since its
minimum comes from a partial aggregate and is joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node in ``links`` (``a``, ``b``, any
    order, repeats and loops allowed); a node of loops only is left out."""
    links = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "links")
    state = _state(links)
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = written(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), "links")
        before, state = state, _state(links)
        if before == state:
            break
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _state(links: DataFrame):
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
