"""One query per operator, over whole tables, with the digests that make their results comparable."""

from __future__ import annotations

import functools
import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import (
    decontamination,
    html_extraction,
    jaccard_join,
    language_id,
    license_scan,
    line_quality,
    merkle_manifest,
    near_vectors,
    packing,
    pii,
    prefix_trie,
    secret_scan,
    token_counts,
)
from tablewright.llm.common import parquet, ship_package

TOKENIZER = "word_bpe_49k.json"
RANKS = "byte_bpe_50k.tiktoken"


def tokenizer_file() -> str:
    """The vocabulary's place in the installed package of public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def spelled(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s.base & (s.kind == kind))).cast("long")


def span_digests(found: DataFrame, kinds: dict[str, str]) -> DataFrame:
    return found.select(
        "doc_id",
        *[counted(F.col("spans"), kind).alias(name) for name, kind in kinds.items()],
        F.sha2(spelled(F.filter("spans", lambda s: s.base)), 256).alias("base_sha256"),
        spelled(F.col("spans")).alias("spans"),
    )


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan_licenses(parquet(spark, folder, "documents"))


def op2_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = parquet(spark, folder, "pages")
    return html_extraction.extract_main_text(pages, html_extraction.fit_labeller(pages))


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(parquet(spark, folder, "documents"), tokenizer_file())


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = parquet(spark, folder, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    field = language_id.fit_word_field(docs, ~held_out)
    found = language_id.identify_language(docs, field)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op5_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = parquet(spark, folder, "documents")
    found = pii.find_pii(docs, pii.fit_pii_trees(docs))
    return span_digests(found, {f"n_{kind}": kind for kind in pii.KINDS})


def op6_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.join_similar(parquet(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


def op7_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = parquet(spark, folder, "documents")
    field = line_quality.fit_line_field(docs, parquet(spark, folder, "labels"))
    return line_quality.judge_quality(docs, field)


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = parquet(spark, folder, "documents")
    return token_counts.count_tokens(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op9_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan_secrets(parquet(spark, folder, "documents"), vocabulary=tokenizer_file())
    return span_digests(found, {"n_assign": "assign", "n_access": "access", "n_hex": "hex"})


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.find_contamination(parquet(spark, folder, "documents"), parquet(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.build_trie(parquet(spark, folder, "conversations"))


def op12_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors.link_vectors(parquet(spark, folder, "embeddings"))


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = parquet(spark, folder, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    made = merkle_manifest.build_manifest(docs, claimed={"text": text})
    return made.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    top = str(Path(__file__).resolve().parents[2])
    if top not in sys.path:
        sys.path.insert(0, top)
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


def shipped(query: Callable) -> Callable:
    """The query, after the library was made known to the workers."""

    @functools.wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship_package(spark)
        return query(spark, folder)

    return run


QUERIES = {
    name: shipped(query)
    for name, query in {
        "op1_license_scan": op1_license_scan,
        "op2_html_extraction": op2_html_extraction,
        "op3_packing": op3_packing,
        "op4_language_id": op4_language_id,
        "op5_pii": op5_pii,
        "op6_jaccard_join": op6_jaccard_join,
        "op7_line_quality": op7_line_quality,
        "op8_token_counts": op8_token_counts,
        "op9_secret_scan": op9_secret_scan,
        "op10_decontamination": op10_decontamination,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_embedding_dedup": op12_embedding_dedup,
        "op13_merkle_manifest": op13_merkle_manifest,
        "pipeline": pipeline,
    }.items()
}
