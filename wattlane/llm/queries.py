"""Registered queries of this subpackage: each applies its operator to the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlane.llm.common import read_table, scratch_path
from wattlane.llm.decontam import contamination
from wattlane.llm.langid import identify
from wattlane.llm.licenses import scan_licenses
from wattlane.llm.line_dedup import dedup_lines
from wattlane.llm.minhash import near_duplicates
from wattlane.llm.mixing import mix_sources
from wattlane.llm.pii import pii_report
from wattlane.llm.prefix_trie import Branching, prefix_trie
from wattlane.llm.quality import rate
from wattlane.llm.resampling import importance_resample
from wattlane.llm.secrets import secret_report
from wattlane.llm.vectors import near_vectors
from wattlane.llm.warc import page_number, read_warc, write_warc


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text of ``documents``."""

    return pii_report(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all ``documents``."""

    return near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its source's boilerplate lines dropped (a source is the site of its documents)."""

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return dedup_lines(docs).select("row.doc_id", "row.source", "n_lines", "n_dropped", "text")


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in every text of ``documents``."""

    found = scan_licenses(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    families = F.array_sort(F.array_distinct(F.transform("spans", lambda s: s["family"])))
    spans = F.transform("spans", lambda s: F.concat_ws(":", s["family"], s["start"], s["end"]))
    return found.select("row.doc_id", "n_paragraphs", F.size("spans").cast("long").alias("n_notices"),
                        F.array_join(families, ",").alias("families"), F.array_join(spans, ",").alias("spans"))


def op5_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all ``embeddings``."""

    return near_vectors(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``pages`` written to WARC archives in the shared folder, and what the archives hold when read back."""

    path = scratch_path(spark, "warc")
    write_warc(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    records = read_warc(spark, path, payloads=False).where("type != 'gap'")
    return records.select(page_number("record_id").alias("page_id"), "payload_bytes",
                          F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"),
                          page_number("refers_to").alias("refers_to"))


def op7_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside windows of the benchmark's items."""

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, read_table(spark, sf_dir, "benchmark"))
    return found.select("row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs).select("row.doc_id", "held_out", "lang_pred", "score", "ambiguous")


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document by the mix of its sources."""

    return mix_sources(read_table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text of ``documents``."""

    return secret_report(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` weighed towards ``benchmark``; a tenth of those with 20 words drawn and ranked."""

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = importance_resample(docs, read_table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return found.select("row.doc_id", "n_features", "weight", "score", "rank")


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return rate(docs, read_table(spark, sf_dir, "labels")).select("row.doc_id", "held_out", "score", "predicted")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all ``conversations``, each rebuilt from the first of its group of five."""

    convs = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return prefix_trie(convs, branching=Branching()).drop("n_ends")


QUERIES = {
    "op1_pii": op1_pii,
    "op2_minhash_dedup": op2_minhash_dedup,
    "op3_line_dedup": op3_line_dedup,
    "op4_licenses": op4_licenses,
    "op5_near_vectors": op5_near_vectors,
    "op6_warc": op6_warc,
    "op7_decontam": op7_decontam,
    "op8_language_id": op8_language_id,
    "op9_mix_sources": op9_mix_sources,
    "op10_secrets": op10_secrets,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_quality": op12_quality,
    "op13_prefix_trie": op13_prefix_trie,
}
