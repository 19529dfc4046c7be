"""The opN_ queries: each applies its operator to the whole of its table and derives the columns that its contract names."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import alignment, digests, media, mixing, packing, ranked_search, secret_scan, sharding, simhash, substrings, tokens, toxicity, warc
from sluice.llm.common import bounded_batches

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~toxicity.held_out()))
    out = toxicity.score(docs, model, score_col="score")
    return out.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op2_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables hold no pictures, so those of embeddings are drawn: one of each vector, and an edited copy of it."""
    return media.copies(media.gallery(table(spark, sf_dir, "embeddings")))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.sharded(table(spark, sf_dir, "documents").select("doc_id", "text"), limit=sharding.QUERY_LIMIT)
    return out.select("doc_id", F.col("doc_size").alias("size"), "depth", "shard", "shard_size", "oversize")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.resolved(warc.read_archives(*warc.write_archives(table(spark, sf_dir, "pages")), keep_payload=False))
    return read.select(F.col("page").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), F.col("refers_page").alias("refers_to"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", F.col("mix_size").alias("size"), "source_size", "target", (F.col("copies") * F.col("mix_size")).alias("taken"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.read_token_files(*tokens.write_token_files(table(spark, sf_dir, "documents"), TOKENIZER))


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER, keep=1_150_000)


def op10_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = digests.with_edits(table(spark, sf_dir, "documents"))
    text = lambda c: F.lower(F.hex(c))
    return out.select("doc_id", "n_chars", "edited_sha256", text("digest").alias("fingerprint"), text("edited_digest").alias("edited_fingerprint"), "near_edited", "near_next")


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    kinds = [r.kind for r in secret_scan.BASE]
    of = lambda some: F.filter("spans", lambda s: s["kind"].isin(some))
    base, counts = of(kinds), [F.size(of([k])).cast("long").alias(f"n_{k}") for k in kinds]
    return found.select("doc_id", *counts, F.sha2(secret_scan.listed(base), 256).alias("base_sha256"), secret_scan.listed(F.col("spans")).alias("spans"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignments(table(spark, sf_dir, "documents"), BYTE_BPE, PIECES)


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_toxicity, op2_media, op3_sharding, op4_simhash, op5_warc, op6_mixing, op7_token_files, op8_substrings, op9_packing, op10_digests, op11_secrets, op12_alignment, op13_search)}


def oracle_sql() -> dict[str, str]:
    return {"op3_sharding": sharding.ORACLE, "op5_warc": warc.ORACLE, "op6_mixing": mixing.ORACLE, "op8_substrings": substrings.ORACLE, "op11_secrets": secret_scan.ORACLE, "op13_search": ranked_search.ORACLE}
