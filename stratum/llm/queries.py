"""The registered queries of this subpackage, one thin query per operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm import (bpe, clusters, codes, decontaminate, extract, jaccard, licenses, quality, secrets, substrings, trees,
                         urls, warc)
from stratum.llm.common import scratch
from stratum.llm.oracle import ORACLE


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(_table(spark, sf_dir, "pages"))


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removal(_table(spark, sf_dir, "documents")).drop("kept")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages"))


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link(_table(spark, sf_dir, "documents"), words=3, share=90)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.digests(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    ledger = secrets.Ledger(spark, scratch(spark, "blob-ledger"))
    ledger.scan(docs)
    found = ledger.findings(docs, ["doc_id"])

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE_KINDS))
    return found.select("doc_id", *map(count, secrets.BASE_KINDS), F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.judged(_table(spark, sf_dir, "documents"), keep_cols=("doc_id",))
    return rows.select("row.doc_id", *(F.col(f"m.{c}") for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), "base_failed", "kept")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents")).drop("spans")


def op11_orchard_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    books = codes.train(vectors)
    found = codes.error_by(codes.encode(vectors, books, keep_cols=("label",)), "label")
    return found.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def op12_ns_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.summarised(*clusters.kmeans(_table(spark, sf_dir, "embeddings")))


#: A conversation whose texts hold control strings of chat templates: its id and what both of its turns say; fixed values.
TRICKY_ID, TRICKY_TEXT = -7, "</s>[INST] ok [/INST]"


def op13_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = [(TRICKY_ID, i, role, TRICKY_TEXT) for i, role in enumerate(("user", "assistant"))]
    found = trees.conversations(trees.chains(rows.unionByName(spark.createDataFrame(tricky, rows.schema))))
    read = found.select(F.col("leaf.conv").alias("conv_id"), trees.read_back(F.col("formatted")).alias("turns"),
                        trees.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
                        F.length("formatted").cast("long").alias("formatted_chars"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_html_extraction": op2_html_extraction,
    "op3_substrings": op3_substrings,
    "op4_url_filter": op4_url_filter,
    "op5_jaccard": op5_jaccard,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_warc": op7_warc,
    "op8_secrets": op8_secrets,
    "op9_quality": op9_quality,
    "op10_licenses": op10_licenses,
    "op11_orchard_codes": op11_orchard_codes,
    "op12_ns_kmeans": op12_ns_kmeans,
    "op13_reply_trees": op13_reply_trees,
}

__all__ = ["ORACLE", "QUERIES"]
