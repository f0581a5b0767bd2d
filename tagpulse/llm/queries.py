"""Registry of the subpackage's queries: name -> function(spark, sf_dir), and DuckDB SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, clusters, decontaminate, html, images, minhash, mixing, negatives, quality, simhash, suffix, tokens, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_benchmark_decontamination": decontaminate.op1_benchmark_decontamination,
    "op2_token_counts": tokens.op2_token_counts,
    "op3_toxicity_bigru": toxicity.op3_toxicity_bigru,
    "op4_image_copies": images.op4_image_copies,
    "op5_suffix_array_dedup": suffix.op5_suffix_array_dedup,
    "op6_chat_prefix_targets": chat.op6_chat_prefix_targets,
    "op7_html_lstm": html.op7_html_lstm,
    "op8_mix_sources": mixing.op8_mix_sources,
    "op9_quality_subword": quality.op9_quality_subword,
    "op10_simhash_near_dedup": simhash.op10_simhash_near_dedup,
    "op11_hard_negatives": negatives.op11_hard_negatives,
    "op12_minhash_near_dedup": minhash.op12_minhash_near_dedup,
    "op13_centroid_clusters": clusters.op13_centroid_clusters,
}
ORACLE_SQL: dict[str, str] = {
    "op6_chat_prefix_targets": chat.OP6_SQL,
    "op8_mix_sources": mixing.OP8_SQL,
    "op11_hard_negatives": negatives.OP11_SQL,
    "op12_minhash_near_dedup": minhash.OP12_SQL,
    "op13_centroid_clusters": clusters.OP13_SQL,
}
