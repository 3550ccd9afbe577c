"""Frequent keys found by mergeable sketches, and joins whose hot keys alone are salted.

A sketch of frequent items is built by each task over the hashes of its rows' keys and
merged like any partial aggregate, so one narrow pass without a shuffle of rows names every
key that holds a given share of them.  Its size depends on the share only.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions.keys import null_safe_condition

#: A key with at least this share of the rows is hot.
HOT_SHARE = 1 / 512


def key_hash(key: Sequence[str]) -> Column:
    return F.xxhash64(*key)


def hot_hashes(df: DataFrame, key: Sequence[str], share: float = HOT_SHARE) -> DataFrame:
    """One row, one array ``hot``: hashes of all keys with ``share`` of the rows, and perhaps some with less.

    The sketch keeps ``8 / share`` counters, so a count is off by a third of ``share`` at most: a key
    at ``share`` is never missed, and no more than ``2 / share`` keys can seem to reach it.
    """
    top, kept = math.ceil(2 / share), math.ceil(8 / share)
    found = df.select(key_hash(key).alias("h")).agg(
        F.expr(f"approx_top_k(h, {top}, {kept})").alias("top"), F.count(F.lit(1)).alias("n"))
    often = F.filter("top", lambda x: x["count"] >= F.col("n") * share)
    return found.select(F.transform(often, lambda x: x["item"]).alias("hot"))


def is_hot(df: DataFrame, key: Sequence[str], share: float = HOT_SHARE) -> Column:
    """Whether a row's key is hot in ``df`` (a scalar subquery: part of the plan, no job of its own)."""
    return F.array_contains(hot_hashes(df, key, share).scalar(), key_hash(key))


def frequent_keys(df: DataFrame, key: Sequence[str], share: float = HOT_SHARE) -> DataFrame:
    """``key`` columns and exact ``n`` of every key with at least ``share`` of the rows.

    The sketch names the candidates; only their rows are counted.
    """
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    counted = df.where(is_hot(df, key, share)).groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= total * F.lit(share))


def salted_join(rows: DataFrame, per_key: DataFrame, key: Sequence[str], hot: Column) -> DataFrame:
    """``rows`` inner-joined (null-safe) to ``per_key``, which has one row a key; columns of both, the key once.

    Rows whose key is ``hot`` are dealt over as many salts as there are shuffle partitions, by a hash of the whole
    row; their key's row is copied to each.  Other keys stay as they are: one salt, no copies.
    """
    salts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int")
    left = rows.withColumn("_hot", hot).withColumn("_salt", F.when(F.col("_hot"), dealt).otherwise(0)).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = per_key.withColumn("_hot", hot).withColumn("_salt", F.explode(copies)).drop("_hot")
    own = [c for c in per_key.columns if c not in key]
    return left.alias("l").join(right.alias("r"), null_safe_condition("l", "r", (*key, "_salt"))).select(
        *[F.col(f"l.{c}") for c in rows.columns], *[F.col(f"r.{c}") for c in own])
