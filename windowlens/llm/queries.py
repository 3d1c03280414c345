"""One registered query per operator: ``key -> (spark, data_dir) -> DataFrame``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from windowlens.llm import (audit, decontaminate, exact, importance, langid, minhash, packing, preference, quality,
                            sharding, simhash, substring, urls)
from windowlens.sources.tables import read_table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
CHAT_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_simhash_near_dedup(spark, d):
    out = simhash.near_duplicates(read_table(spark, d, "documents"), shingle=3, max_bits=3)
    return out.select("doc_id", "fingerprint", "component_id")


def op2_benchmark_decontamination(spark, d):
    out = decontaminate.decontaminate(read_table(spark, d, "documents"), read_table(spark, d, "benchmark"),
                                      texts=False)
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op3_substring_dedup(spark, d):
    """Every passage that repeats an earlier one, with the document that
    keeps it."""
    return substring.repeated_spans(read_table(spark, d, "documents")).drop("text_hash")


def op4_language_id(spark, d):
    out = langid.identify(read_table(spark, d, "documents"))
    return out.select("doc_id", "held_out", "lang_pred", "score")


def op5_quality_resampling(spark, d):
    out = quality.resample(read_table(spark, d, "documents"), read_table(spark, d, "labels"))
    return out.select("doc_id", "n_ngrams", F.round("log_weight", 6).alias("log_weight"),
                      F.round("gumbel_key", 6).alias("gumbel_key"), "kept")


def op6_url_filters(spark, d):
    out = urls.filter_urls(read_table(spark, d, "pages"))
    return out.select("page_id", "host", "path", "rule", "verdict")


def op7_best_fit_packing(spark, d):
    out = packing.pack_documents(read_table(spark, d, "documents"), TOKENIZER)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op8_preference_formatting(spark, d):
    """Each conversation against itself with another last answer; the ids as
    little-endian CRC-32 of their text, the masks as counts."""
    convs = preference.conversations(read_table(spark, d, "conversations"))
    out = preference.format_pairs(preference.replaced_answers(convs), CHAT_TOKENIZER)

    def crc(c):
        return F.crc32(F.array_join(F.transform(c, lambda x: x.cast("string")), ",").cast("binary"))

    return out.select(
        F.col("pair_id").alias("conv_id"), "n_common", F.sha2("prompt", 256).alias("prompt_sha256"), "chosen",
        "rejected", F.size("prompt_ids").alias("n_prompt"), crc(F.col("prompt_ids")).alias("prompt_crc32"),
        *[x for side in ("chosen", "rejected") for x in (
            F.size(f"{side}_ids").alias(f"n_{side}"), crc(F.col(f"{side}_ids")).alias(f"{side}_crc32"),
            F.aggregate(f"{side}_mask", F.lit(0), lambda a, m: a + m).alias(f"{side}_scored"))], "usable")


def op9_exact_dedup(spark, d):
    out = exact.exact_duplicates(read_table(spark, d, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_sharding(spark, d):
    return sharding.shard_documents(read_table(spark, d, "documents"))


def op11_importance_resampling(spark, d):
    out = importance.resample(read_table(spark, d, "documents"), read_table(spark, d, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def op12_minhash_near_dedup(spark, d):
    out = minhash.near_duplicates(read_table(spark, d, "documents"))
    return out.select("doc_id", "n_shingles", "component_id", "kept")


def op13_filter_audit(spark, d):
    return audit.interactions(read_table(spark, d, "documents"), read_table(spark, d, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_simhash_near_dedup, op2_benchmark_decontamination, op3_substring_dedup, op4_language_id,
    op5_quality_resampling, op6_url_filters, op7_best_fit_packing, op8_preference_formatting, op9_exact_dedup,
    op10_sharding, op11_importance_resampling, op12_minhash_near_dedup, op13_filter_audit)}
